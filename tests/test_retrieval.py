import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from pressmill.functions.vectors import TopK, hash_vectors, list_matrix, md5_heads
from pressmill.operators.answers import answers, contexts, register_completer
from pressmill.operators.embedding import embed, embed_batch, embedder, register_embedder, require_dimension
from pressmill.operators import retrieval
from pressmill.operators.joins import fits_broadcast, lookup_join
from pressmill.operators.retrieval import _few_tasks, _hit_rows, hit_defaults, search, top_k_ids

VECTORS = "chunk_id string, embedding array<float>, url string, title string, chunk_text string, language string"


def brute(questions, vectors, ids, k, threshold=None):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    out = []
    for q, row in enumerate(np.round(unit(questions) @ unit(vectors).T, 9)):
        order = sorted(range(len(ids)), key=lambda i: (-row[i], ids[i]))
        kept = [i for i in order if threshold is None or row[i] >= threshold][:k]
        out += [(q, rank + 1, ids[i], round(float(row[i]), 6) + 0.0) for rank, i in enumerate(kept)]
    return out


def stored(spark, vectors):
    data = [(f"c{i:04d}", [float(x) for x in v], f"u{i}", None if i % 3 == 0 else f"t{i}", f"text {i}", "en" if i % 2 else "fr")
            for i, v in enumerate(vectors)]
    return spark.createDataFrame(data, VECTORS)


def asked(spark, vectors, **extra):
    names = "".join(f", {n} int" for n in extra)
    rows = [(q, [float(x) for x in v], *[e[q] for e in extra.values()]) for q, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"question_id bigint, embedding array<float>{names}")


def result(df):
    return sorted((r.question_id, r.rank, r.chunk_id, round(r.score, 6) + 0.0) for r in df.collect())


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-2, 3, (300, 8)).astype(float)
    vectors[100:200] = vectors[100]  # a third of all rows are copies
    vectors[7] = 0
    return rng.integers(-2, 3, (9, 8)).astype(float), vectors, [f"c{i:04d}" for i in range(300)]


@pytest.mark.parametrize("k,threshold", [(1, None), (5, None), (100, None), (5, 0.65), (100, 0.3), (5, 2.0)])
def test_both_plans_match_brute_force(spark, data, k, threshold):
    questions, vectors, ids = data
    want = brute(questions, vectors, ids, k, threshold)
    table = stored(spark, vectors).repartition(5)
    assert result(top_k_ids(asked(spark, questions), table, k, threshold)) == want
    blocks = top_k_ids(asked(spark, questions), table, k, threshold, max_questions=4)
    assert result(blocks) == want


def test_own_top_k(spark, data):
    questions, vectors, ids = data
    own = [None, 1, 2, 3, 4, 5, 6, 7, 100]
    got = result(top_k_ids(asked(spark, questions, top_k=own), stored(spark, vectors)))
    want = brute(questions, vectors, ids, 100)
    assert got == [w for w in want if w[1] <= (own[w[0]] or 5)]


@pytest.mark.parametrize("k", [0, 101])
def test_top_k_range(spark, data, k):
    questions, vectors, _ = data
    with pytest.raises(ValueError, match="between 1 and 100"):
        top_k_ids(asked(spark, questions), stored(spark, vectors), k)
    own = [k, 2] + [None] * 7  # a question's own bad top_k refuses that question only
    got = result(top_k_ids(asked(spark, questions, top_k=own), stored(spark, vectors)))
    assert {w[0] for w in got} == set(range(1, 9)) and sum(1 for w in got if w[0] == 1) == 2


def test_a_bad_top_k_is_an_error_row(spark):
    found = hits(spark, (0, 1, "u", "T", "a"), (1, 1, "v", "W", "b"))
    asked = spark.createDataFrame([(0, "q0", 0), (1, "q1", None), (2, "q2", 500)], "question_id bigint, text string, top_k int")
    got = {r.question_id: (r.answer, r.error) for r in answers(asked, found, errors=True).collect()}
    assert got[0] == (None, "top_k must be between 1 and 100, got 0") and got[2] == (None, "top_k must be between 1 and 100, got 500")
    assert got[1][0].startswith("[stub llm]") and got[1][1] is None


def test_search_payload_filter_and_defaults(spark, data):
    questions, vectors, ids = data
    table = stored(spark, vectors)
    english = [i for i in range(300) if i % 2]
    want = brute(questions, vectors[english], [ids[i] for i in english], 5)
    hits = search(asked(spark, questions), table, where=table.language == "en")
    assert result(hits) == want
    assert {r.chunk_text for r in hits.collect()} == {f"text {int(w[2][1:])}" for w in want}
    many = search(asked(spark, questions), table, max_questions=4, where=table.language == "en")
    assert result(many) == want


def test_empty_sides(spark, data):
    questions, vectors, _ = data
    assert search(asked(spark, questions), stored(spark, vectors).limit(0)).count() == 0
    assert search(asked(spark, questions).limit(0), stored(spark, vectors)).count() == 0


def test_wrong_dimension_fails(spark, data):
    questions, vectors, _ = data
    with pytest.raises(Exception, match="8 elements"):
        top_k_ids(asked(spark, questions), stored(spark, vectors[:, :4])).collect()


def test_vectors_are_not_shuffled_or_crossed(spark, data):
    questions, vectors, _ = data
    plan = top_k_ids(asked(spark, questions), stored(spark, vectors))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert all("embedding" not in line for line in plan.splitlines() if "Exchange" in line)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 60), st.integers(1, 7), st.integers(1, 12), st.integers(1, 25))
def test_running_top_k(seed, n, questions, k, batch):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-1, 2, (n, 3)).astype(float)
    asked = rng.integers(-1, 2, (questions, 3)).astype(float)
    ids = rng.permutation(n)
    top = TopK(asked, np.full(questions, k))
    for at in range(0, n, batch):
        top.add(ids[at : at + batch], vectors[at : at + batch])
    got = [(int(q), int(i), round(float(s), 6) + 0.0) for q, i, s in zip(top.q, top.ids, top.score)]
    assert got == [(q, i, s) for q, _, i, s in brute(asked, vectors, list(ids), k)]


def test_tiles_of_a_batch_are_taken_up_together_and_vectors_without_a_number_hide_nothing(monkeypatch):
    rng = np.random.default_rng(8)
    asked = rng.normal(size=(400, 8))
    vectors = rng.normal(size=(9000, 8))
    vectors[:400], vectors[2::7] = asked, np.nan
    vectors[1500:9000:1024] = asked[:8] * 3  # one hit a tile
    ids, merged, plain = np.arange(9000), [], TopK._merge
    monkeypatch.setattr(TopK, "_merge", lambda self, *found: merged.append(len(found[0])) or plain(self, *found))
    top = TopK(asked, np.full(400, 2), threshold=0.999)
    top.add(ids[:400], vectors[:400])
    first = len(merged)
    top.add(ids[400:], vectors[400:])
    assert first == 1 and len(merged) == 2
    got = [(int(q), int(i), round(float(s), 6)) for q, i, s in zip(top.q, top.ids, top.score)]
    good = ~np.isnan(vectors).any(axis=1)
    assert got == [(q, i, round(s, 6)) for q, _, i, s in brute(asked, vectors[good], list(ids[good]), 2) if s >= 0.999] and len(got) > 300


def test_blocks_of_questions_are_filled_up(spark, monkeypatch):
    """Vectors are read once a block, so blocks are few."""
    rng = np.random.default_rng(9)
    questions, vectors = rng.normal(size=(560, 3)), rng.normal(size=(40, 3))
    blocks, plain = [], retrieval._score_in_place
    monkeypatch.setattr(retrieval, "_score_in_place", lambda q, *more: blocks.append(q.num_rows) or plain(q, *more))
    got = top_k_ids(asked(spark, questions), stored(spark, vectors), 3, max_questions=100)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, top_k_ids(asked(spark, questions), stored(spark, vectors), 3).collect()))
    assert len(blocks[:-1]) == 2 and sum(blocks[:-1]) == 560 and max(blocks[:-1]) <= 400


def test_hash_vectors():
    got = hash_vectors(["a b  a", "", "B A a", "c"], 16)
    assert got.shape == (4, 16) and got.dtype == np.float32
    assert np.allclose(np.linalg.norm(got, axis=1), [1, 0, 1, 1])
    assert np.array_equal(got[0], got[2])
    assert hash_vectors([], 4).shape == (0, 4)


def test_embedding_contract(spark):
    with pytest.raises(ValueError, match="unknown embedding provider: nope"):
        embedder("nope")
    assert embed_batch(lambda t: 1 / 0, [], 4).shape == (0, 4)
    with pytest.raises(ValueError, match="expected 2 vectors"):
        embed_batch(lambda t: np.zeros((1, 4)), ["a", "b"], 4)
    rows = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "i int, chunk_text string")
    got = {r.i: r.embedding for r in embed(rows, dim=8).collect()}
    assert got[2] == got[3] == [0.0] * 8 and len(got[1]) == 8
    with pytest.raises(Exception, match="expected vectors of 9 elements, got 8"):
        require_dimension(embed(rows, dim=8), 9).collect()


def test_own_embedder_is_loaded_once_per_process(spark):
    def load(dim):
        import os

        stamp = float(int.from_bytes(os.urandom(2), "big"))
        return lambda texts: np.full((len(texts), dim), stamp)

    register_embedder("stamped", load)
    rows = spark.range(2000).selectExpr("id", "cast(id as string) chunk_text").repartition(40)
    stamps = {r.embedding[0] for r in embed(rows, provider="stamped", dim=2).collect()}
    assert 1 <= len(stamps) <= 4  # one per worker process, not one per task


HITS = "question_id bigint, rank int, url string, title string, chunk_text string, score double"


def hits(spark, *rows):
    return spark.createDataFrame([(*r, 0.5) for r in rows], HITS)


def questions(spark, *rows):
    return spark.createDataFrame([(i, t, p) for i, (t, p) in enumerate(rows)], "question_id bigint, text string, provider string")


def test_context_format(spark):
    df = hits(spark, (1, 2, "u2", None, "b"), (1, 1, "u1", "T", "a"), (2, 1, "u", "", "c"))
    got = {r.question_id: (r.context, r.sources) for r in contexts(df).collect()}
    assert got[1] == ("[1] T\nURL: u1\na\n\n---\n\n[2] Untitled\nURL: u2\nb", ["u1", "u2"])
    assert got[2] == ("[1] Untitled\nURL: u\nc", ["u"])


def test_answers(spark):
    register_completer("shout", lambda system, user: [u.upper() for u in user])
    asked = questions(spark, ("why?", None), ("none", None), ("loud", "shout"))
    found = hits(spark, (0, 1, "u", "T", "a"), (0, 2, "u", "T", "b"), (2, 1, "v", "W", "c"))
    got = {r.question_id: (r.answer, r.sources) for r in answers(asked, found).collect()}
    body = "Context:\n[1] T\nURL: u\na\n\n---\n\n[2] T\nURL: u\nb\n\nQuestion: why?"
    assert got[0] == (f"[stub llm] No LLM was called (LLM_PROVIDER=stub). \n\n{body}", ["u", "u"])
    assert got[1] == ("I don't have enough information.", [])
    assert got[2] == ("CONTEXT:\n[1] W\nURL: V\nC\n\nQUESTION: LOUD", ["v"])
    assert {r.answer[:7] for r in answers(asked, found, provider="shout").collect()} == {"CONTEXT", "I don't"}


def test_unknown_completion_provider(spark):
    found = hits(spark, (0, 1, "u", "T", "a"))
    with pytest.raises(ValueError, match="'nobody'"):
        answers(questions(spark, ("q", None)), found, provider="nobody")
    with pytest.raises(Exception, match="unknown completion provider: 'gone'"):
        answers(questions(spark, ("q", "gone")), found).collect()


def test_hit_defaults(spark):
    df = spark.createDataFrame([(1, 1, "c", None, None, None, None)],
                               "question_id bigint, rank int, chunk_id string, url string, title string, chunk_text string, score double")
    assert tuple(hit_defaults(df).first()) == (1, 1, "c", "", None, "", 0.0)


def test_lookup_join_plans_agree(spark):
    rows = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' else cast(id % 50 as string) end k")
    lookup = rows.select("k").distinct().selectExpr("k", "length(k) n")
    assert fits_broadcast(lookup) and not fits_broadcast(lookup, max_rows=3) and not fits_broadcast(lookup, max_bytes=9)
    small = lookup_join(rows, lookup, "k", ["id"], broadcast=True)
    salted = lookup_join(rows, lookup, "k", ["id"], broadcast=False, salts=8)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, salted.collect()))
    assert salted.count() == 3000


def test_a_lookup_not_measured_small_is_never_broadcast(spark, tmp_path):
    rows = spark.range(300).selectExpr("id", "cast(id % 50 as string) k")
    rows.select("k").distinct().selectExpr("k", "length(k) n").write.parquet(str(tmp_path / "lookup"))
    lookup = spark.read.parquet(str(tmp_path / "lookup"))  # a file far below Spark's own bound
    for how in ("inner", "left"):
        joined = lookup_join(rows, lookup, "k", ["id"], how=how, broadcast=False)
        assert joined.count() == 300
        assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_list_matrix_rejects_nulls():
    import pyarrow as pa

    with pytest.raises(ValueError):
        list_matrix(pa.array([[1.0, 2.0], None]), 2)


def test_a_failing_completion_costs_its_question_only(spark):
    calls = []

    def picky(system, user):
        calls.append(len(user))
        if any("bad" in u for u in user):
            raise RuntimeError("model refused")
        return [f"ok {len(u)}" for u in user]

    register_completer("picky", picky)
    texts = [(f"{'bad' if i in (3, 11, 12) else 'good'} {i}", None) for i in range(20)]
    asked = questions(spark, *texts).coalesce(1)
    found = hits(spark, *[(i, 1, "u", "T", "a") for i in range(20)])
    got = {r.question_id: (r.answer, r.error) for r in answers(asked, found, provider="picky", errors=True).collect()}
    assert {i for i, (a, e) in got.items() if e} == {3, 11, 12}
    assert all(a is None and e == "completion_failed: RuntimeError: model refused" for a, e in (got[i] for i in (3, 11, 12)))
    assert all(a.startswith("ok ") and e is None for i, (a, e) in got.items() if i not in (3, 11, 12))
    assert answers(asked, found, provider="picky").columns == ["question_id", "answer", "sources"]


def test_candidates_grow_with_questions_not_with_splits(spark, data, monkeypatch):
    monkeypatch.setattr("pressmill.operators.retrieval.TASKS_PER_CORE", 1)
    questions, vectors, ids = data
    cores = spark.sparkContext.defaultParallelism
    many = stored(spark, vectors).repartition(5 * cores)
    assert _few_tasks(many).rdd.getNumPartitions() == cores
    plan = _few_tasks(many)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" in plan
    assert result(top_k_ids(asked(spark, questions), many, 7)) == brute(questions, vectors, ids, 7)


def test_scores_that_single_precision_confuses_are_told_apart():
    """Candidates closer than a float tells apart rank by their scores in double precision."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=16)
    other = np.linalg.norm(base) * np.eye(16)[0]
    vectors = np.array([base + other * 1e-4 * (1 + 1e-3 * i) for i in range(3000)])
    ids = rng.permutation(3000)
    top = TopK(base[None], np.array([5]))
    for at in range(0, 3000, 700):
        top.add(ids[at : at + 700], vectors[at : at + 700])
    assert [(int(q), int(i)) for q, i in zip(top.q, top.ids)] == [(q, i) for q, _, i, _ in brute(base[None], vectors, list(ids), 5)]
    assert top._coarse.dtype == np.float32


def test_payload_of_many_hits_is_filtered_where_it_lies(spark):
    payload = spark.range(1000).select(F.col("id").cast("string").alias("chunk_id"), F.lit("u").alias("url"))
    ranked = spark.createDataFrame([(q, str(c)) for q in range(3) for c in (5, 7, q)], "question_id int, chunk_id string")
    kept = _hit_rows(payload, ranked)
    assert sorted(r.chunk_id for r in kept.collect()) == ["0", "1", "2", "5", "7"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    assert _hit_rows(payload, ranked, most=4).count() == 1000


def test_md5_heads_of_short_and_long_words():
    words = ["", "a", "é" * 27, "é" * 28, "x" * 55, "x" * 56, "y" * 500, "Ω" * 9]
    head, fifth = md5_heads(pa.array(["skipped", *words]).slice(1))
    digests = [hashlib.md5(w.encode()).digest() for w in words]
    assert head.tolist() == [int.from_bytes(d[:4], "big") for d in digests] and fifth.tolist() == [d[4] for d in digests]
    assert len(md5_heads(pa.array([], pa.string()))[0]) == 0
