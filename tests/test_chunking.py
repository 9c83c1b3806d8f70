import hashlib
import re
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import items
from pyspark.sql import functions as F

from pressmill.functions.sentences import has_single_spaces, spaced_word_count, word_count
from pressmill.operators.chunking import chunk_items, split_items


def expected(text, limit, overlap):
    """Packing by positions: a span closes before the sentence that would pass
    the limit, the next one reopens with the longest closing run that fits."""
    sentences = re.split(r"(?<=[.!?])\s+", text)
    words = [len(s.split()) for s in sentences]
    spans, lo = [], 0
    for i, n in enumerate(words):
        if i > lo and sum(words[lo:i]) + n > limit:
            spans.append((lo, i))
            lo = min((j for j in range(lo, i + 1) if sum(words[j:i]) <= overlap))
    spans.append((lo, len(words)))
    return [" ".join(sentences[a:b]) for a, b in spans]


def chunks(spark, text, limit=512, overlap=64, **fields):
    df = chunk_items(items(spark, {"content": text, **fields}), limit, overlap)
    return sorted(df.collect(), key=lambda r: r.chunk_index)


def test_short_text_is_one_chunk(spark):
    (only,) = chunks(spark, "One sentence. And another.")
    assert (only.chunk_index, only.total_chunks, only.chunk_text) == (0, 1, "One sentence. And another.")


def test_chunk_id_golden(spark):
    (only,) = chunks(spark, "x")
    assert only.chunk_id == "724c4d50-461d-5ab1-d74f-45d3197153f5"


def test_long_text_has_contiguous_indexes_and_own_ids(spark):
    got = chunks(spark, "This sentence has exactly six words. " * 200, 64, 16, url="u")
    assert len(got) > 1
    assert [c.chunk_index for c in got] == list(range(len(got)))
    assert {c.total_chunks for c in got} == {len(got)}
    assert [c.chunk_id for c in got] == [
        str(uuid.UUID(hashlib.sha1(f"u#{i}".encode()).hexdigest()[:32])) for i in range(len(got))
    ]


def test_text_is_picked_from_content_then_summary_then_title(spark):
    df = items(
        spark,
        {"url": "1", "content": "", "summary": "sum", "title": "tit"},
        {"url": "2", "title": "tit"},
        {"url": "3"},
        {"url": "4", "content": "con", "summary": "sum"},
    )
    assert {r.url: r.chunk_text for r in chunk_items(df).collect()} == {"1": "sum", "2": "tit", "4": "con"}


def test_edge_cases(spark):
    cases = [
        ("a b c d e f g h.", 4, 2),  # longer than the limit, stays whole
        ("a b. c d. e f.", 4, 0),  # no overlap
        ("a b c. d e f. g h i.", 4, 2),  # last sentence too long to overlap
        ("a b. c d.", 4, 2),  # exact fit
        ("a b c. d. e f g h. i.", 4, 3),  # tail plus sentence passes the limit
        ("a. b. ", 1, 1),  # trailing space: an empty last sentence
        ("¿Qué tal? Muy bien! Été fini. Größe zählt.", 3, 2),
        ("no stop at all", 2, 1),
        ("a.b c.d? e", 1, 0),
    ]
    for i, (text, limit, overlap) in enumerate(cases):
        assert [c.chunk_text for c in chunks(spark, text, limit, overlap)] == expected(text, limit, overlap), i


SENTENCE = st.lists(st.sampled_from(["a", "bb", "ccc", "é"]), max_size=6).map(" ".join)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.tuples(SENTENCE, st.sampled_from([". ", "!  ", "?\n", " ", "."])), min_size=1, max_size=25),
        min_size=1,
        max_size=15,
    ),
    st.integers(1, 12),
    st.integers(0, 8),
)
def test_packing_matches_the_rule(spark, docs, limit, overlap):
    texts = ["x" + "".join(a + b for a, b in d) for d in docs]
    df = items(spark, *[{"url": str(i), "content": t} for i, t in enumerate(texts)])
    got = {}
    for r in chunk_items(df, limit, overlap).collect():
        got.setdefault(r.url, {})[r.chunk_index] = r.chunk_text
    for i, t in enumerate(texts):
        assert [got[str(i)][j] for j in range(len(got[str(i)]))] == expected(t, limit, overlap)


def test_sentences_and_words(spark):
    got = [(r.sentence_index, r.sentence, r.words) for r in split_items(items(spark, {"content": "A b. C!  D e? f"})).collect()]
    assert got == [(0, "A b.", 2), (1, "C!", 1), (2, "D e?", 2), (3, "f", 1)]


def test_chunking_has_no_shuffle(spark):
    plan = chunk_items(items(spark, {"content": "a. b."}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_words_of_cleaned_texts_are_counted_by_their_spaces(spark):
    texts = ["a", "a b. c", "é 漢 x.", "", " a", "a ", "a  b", "a\tb", "a\x1cb", "a\u00a0b", "a\u2003b", "a\nb c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", has_single_spaces(F.col("t")), spaced_word_count(F.col("t")), word_count(F.col("t"))).collect()
    assert {t for t, single, *_ in got if single} == {"a", "a b. c", "é 漢 x.", ""}
    assert all(fast == slow for _, single, fast, slow in got if single)
