import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import items, values
from pressmill.operators.dedup import dedup_by_url
from pressmill.operators.embedding import embed, register_embedder
from pressmill.operators.language import allow_languages, detect_language
from pressmill.operators.records import embedded_chunks, ingest_summary, items_per_source, summary_json, to_records
from pressmill.operators.chunking import chunk_items
from pressmill.operators.vector_table import VectorTable
from pressmill.plans.ask import ask
from pressmill.plans.ingest import IngestOptions, ingest_items, ingest_records, refine_items
from pressmill.schemas import EMBEDDED_CHUNK
from pressmill.session import materialize, work_dir
from pressmill.sources.records import stream_records
from pressmill.streaming.dedup import dedup_stream, first_in_batch
from pressmill.streaming.ingest import decode_stream, ingest_stream, print_stream, reject_stream

SMALL = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8)


@pytest.fixture
def table(spark, tmp_path):
    return VectorTable(spark, str(tmp_path / "vectors")).ensure(8)


def texts(table):
    return sorted((r.url, r.chunk_index, r.chunk_text) for r in table.read().collect())


def doc(url, content, at=1, **more):
    return {"url": url, "content": content, "fetched_at": at, **more}


# -- dedup, language, summaries ----------------------------------------------


def test_dedup_keeps_the_first(spark, rows):
    df = items(spark, doc("a", "late", 9), doc("a", "first", 1), doc("b", "only", 5), *[doc("hot", "x", i) for i in range(200)])
    got = {(r.url, r.content, r.fetched_at) for r in dedup_by_url(df.repartition(7)).collect()}
    assert got == {("a", "first", 1), ("b", "only", 5), ("hot", "x", 0)}
    plan = dedup_by_url(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_language(spark):
    df = spark.createDataFrame(
        [("The cat is on the mat.", None), ("Le chat est sur la table et dans une boîte.", None),
         ("El gato y los perros en la casa.", None), ("Der Hund und die Katze mit dem Ball.", None),
         ("xyzzy", None), ("", None), (None, None)],
        "text string, language string",
    )
    got = [r.language for r in detect_language(df, "text").collect()]
    assert got == ["en", "fr", "es", "de", None, None, None]
    assert allow_languages(detect_language(df, "text"), ["fr", "de"]).count() == 2
    known = detect_language(df.withColumn("language", F.lit("it")), "text", keep_known=True)
    assert {r.language for r in known.collect()} == {"it"}


def test_summaries(spark):
    df = items(spark, doc("a", "One. Two. Three.", 1), doc("a", "One.", 2), doc("b", "x", 1, source_id="t"))
    chunks = chunk_items(df, 1, 0, carry=("fetched_at",))
    summary = ingest_summary(chunks, ["fetched_at"])
    assert sorted((r.url, r.fetched_at, r.chunks) for r in summary.collect()) == [("a", 1, 3), ("a", 2, 1), ("b", 1, 1)]
    assert json.loads(summary_json(summary.where("chunks = 3")).first().value) == {"url": "a", "chunks": 3}
    assert {r.source_id: r["items"] for r in items_per_source(df).collect()} == {"s": 2, "t": 1}


# -- vector table ------------------------------------------------------------


def test_round_trip_of_one_record(spark, tmp_path):
    store = VectorTable(spark, str(tmp_path / "v")).ensure(4)
    row = ("id-1", "https://x.test/a", "t", "text", 0, 1, "en", None, "s", ["x"], [0.1, 0.2, 0.3, 0.4])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EMBEDDED_CHUNK.fields)
    assert store.upsert(spark.createDataFrame([row], schema)) == 1
    (got,) = store.read().collect()
    assert (got.chunk_id, got.url, got.tags) == ("id-1", "https://x.test/a", ["x"])


def test_collection_is_created_once_and_checked(spark, table, tmp_path):
    table.ensure(8)
    assert table.read().count() == 0
    with pytest.raises(ValueError, match="8 elements, not 9"):
        table.ensure(9)
    wrong = embed(chunk_items(items(spark, doc("a", "x"))), dim=3)
    with pytest.raises(Exception, match="expected vectors of 8 elements, got 3"):
        table.upsert(wrong)
    assert table.read().count() == 0


def test_upsert_last_write_wins_and_tails(spark, table):
    assert ingest_items(items(spark, doc("a", "1 a b c. 2 d e f. 3 g h i."), doc("b", "keep it.")), table, SMALL) == 4
    assert ingest_items(items(spark, doc("a", "new one two three.", 2)), table, SMALL) == 1
    assert texts(table) == [
        ("a", 0, "new one two three."), ("a", 1, "2 d e f."), ("a", 2, "3 g h i."), ("b", 0, "keep it."),
    ]
    before = texts(table)
    table.compact()
    assert texts(table) == before and table.snapshot()["deltas"] == []
    ingest_items(items(spark, doc("b", "b again now.", 3)), table, SMALL)
    assert ("b", 0, "b again now.") in texts(table) and len(texts(table)) == 4
    table.compact()
    table.compact()
    assert len(texts(table)) == 4


def test_same_batch_versions(spark, table):
    versions = [doc("a", f"version {i} of it.", i) for i in range(50)] + [doc("a", "zz long one two. more of the same. x.", 7)]
    ingest_items(items(spark, *versions), table, SMALL)
    assert texts(table)[0] == ("a", 0, "version 49 of it.")
    assert len(texts(table)) == 3  # version 7 was longer; its tail stays


@pytest.mark.parametrize("compacted", [False, True])
def test_replace_url(spark, table, compacted):
    replace = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8, replace_url=True)
    ingest_items(items(spark, doc("a", "1 a b c. 2 d e f. 3 g h i."), doc("b", "b 1 2 3. b 4 5 6.")), table, SMALL)
    if compacted:
        table.compact()
    again = [doc("a", "old 1 2 3. old 4 5 6.", 2), doc("a", "only one left.", 3)]
    ingest_items(items(spark, *again), table, replace)
    want = [("a", 0, "only one left."), ("b", 0, "b 1 2 3."), ("b", 1, "b 4 5 6.")]
    assert texts(table) == want
    table.compact()
    assert texts(table) == want
    ingest_items(items(spark, doc("a", "1 a b c. 2 d e f.", 4)), table, replace)
    assert [t for t in texts(table) if t[0] == "a"] == [("a", 0, "1 a b c."), ("a", 1, "2 d e f.")]


def test_replayed_batch_is_a_no_op(spark, table):
    batch = items(spark, doc("a", "first."))
    assert ingest_items(batch, table, SMALL, writer="w", batch_id=0) == 1
    assert ingest_items(items(spark, doc("a", "other.")), table, SMALL, writer="w", batch_id=0) == 0
    table.compact()
    assert ingest_items(items(spark, doc("a", "other.")), table, SMALL, writer="w", batch_id=0) == 0
    assert texts(table) == [("a", 0, "first.")]
    assert ingest_items(items(spark, doc("a", "other.")), table, SMALL, writer="w", batch_id=1) == 1
    assert ingest_items(items(spark, doc("c", "c.")), table, SMALL, writer="v", batch_id=0) == 1


def test_uncommitted_data_is_invisible(spark, table):
    ingest_items(items(spark, doc("a", "seen.")), table, SMALL)
    table._write(table._stored(table.read().withColumn("chunk_text", F.lit("unseen")), 99, False))
    assert texts(table) == [("a", 0, "seen.")]


def test_upkeep_merges_small_deltas_and_compacts_large_ones(spark, table, monkeypatch):
    monkeypatch.setattr("pressmill.operators.vector_table.MAX_DELTAS", 3)
    ingest_items(items(spark, *[doc(f"u{i}", "x.") for i in range(200)]), table, SMALL)
    table.compact()
    replace = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8, replace_url=True)
    for version in range(2, 5):
        ingest_items(items(spark, doc("u1", f"version {version}.", version)), table, replace)
        table.maintain()
    now = table.snapshot()
    assert now["base_rows"] == 200 and len(now["deltas"]) == 1 and now["deltas"][0]["rows"] == 1
    assert len(texts(table)) == 200 and ("u1", 0, "version 4.") in texts(table)
    for i in range(2):
        ingest_items(items(spark, *[doc(f"v{j}", f"y{i}.", i) for j in range(20)]), table, SMALL)
        table.maintain()
    assert table.snapshot()["deltas"] == [] and table.snapshot()["base_rows"] == 220


def test_items_the_embedder_fails_on(spark, table):
    def load(dim):
        def run(texts):
            if any("poison" in t for t in texts):
                raise RuntimeError("model failed")
            return [[1.0] * dim for _ in texts]

        return run

    register_embedder("fragile", load)
    df = items(spark, doc("a", "fine text here. poison and more words."), doc("b", "all good."), doc("c", "also good."))
    strict = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8, provider="fragile")
    with pytest.raises(Exception, match="model failed"):
        ingest_items(df, table, strict)
    assert table.read().count() == 0
    lenient = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8, provider="fragile", drop_failed=True)
    assert ingest_items(df, table, lenient) == 2
    assert [t[0] for t in texts(table)] == ["b", "c"] and table.snapshot()["failed_urls"] == 1


def test_second_of_two_racing_writers_fails(spark, table):
    stale = table.snapshot()
    ingest_items(items(spark, doc("a", "one.")), table, SMALL)
    with pytest.raises(Exception, match="already exists"):
        table._publish(stale, deltas=[])
    assert texts(table) == [("a", 0, "one.")]


def test_batch_ingest_counts(spark, table, tmp_path):
    records = to_records(items(spark, doc("a", "One two three four. Five."), doc("b", "<p> </p>"))).select("value")
    refused = str(tmp_path / "refused")
    assert ingest_records(records.union(values(spark, "bad", None)), table, refused, SMALL) == 2
    assert sorted(r.reason for r in spark.read.parquet(refused).collect()) == ["invalid_json", "null_value"]
    assert ingest_records(values(spark, "bad"), table, None, SMALL) == 0


def test_rejects_of_a_retried_batch_are_written_once(spark, table, tmp_path):
    refused = str(tmp_path / "refused")
    records = to_records(items(spark, doc("a", "One."))).select("value").union(values(spark, "bad"))
    assert ingest_records(records, table, refused, SMALL, writer="w", batch_id=0) == 1
    assert ingest_records(records, table, refused, SMALL, writer="w", batch_id=0) == 0
    assert ingest_records(values(spark, "[1]"), table, refused, SMALL, writer="w", batch_id=1) == 0
    got = sorted((r.reason, r.writer, r.batch) for r in spark.read.parquet(refused).collect())
    assert got == [("invalid_json", "w", 0), ("not_object", "w", 1)] and texts(table) == [("a", 0, "One.")]


def test_stored_language_is_filtered_in_the_scan(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = [doc(" a ", "x.", language="en"), doc("a", "y.", 2, language="fr"), doc("b", "z.", language="fr"), doc("c", "z.")]
    items(spark, *rows).write.parquet(path)
    stored = spark.read.parquet(path)
    found = refine_items(stored, IngestOptions(languages=("en", "es")))
    assert [(r.url, r.content) for r in found.collect()] == [("a", "x.")]
    assert "In(language, [en,es])" in found._jdf.queryExecution().executedPlan().toString()
    first = refine_items(stored, IngestOptions(languages=("fr",), dedup=True))
    assert [r.url for r in first.collect()] == ["b"]


def test_ingest_options(spark, table):
    full = IngestOptions(max_tokens=50, overlap_tokens=0, dim=8, dedup=True, detect=True)
    df = items(
        spark,
        doc(" a ", "The first of the two is kept.", 1), doc("a", "The second of the two is not.", 2),
        doc("b", "xyzzy plugh", 1), doc("c", "Der Hund und die Katze.", 1, language="en"),
    )
    ingest_items(df, table, full)
    got = {(r.url, r.chunk_text, r.language) for r in table.read().collect()}
    assert got == {("a", "The first of the two is kept.", "en"), ("c", "Der Hund und die Katze.", "de")}


def test_ingest_then_ask(spark, table):
    news = "Harvests were good this year. Prices of wheat fell. Farmers store grain. Rain helped. Mills are busy."
    ingest_items(items(spark, doc("https://x.test/wheat", news), doc("https://x.test/other", "Trams and trains.")), table, SMALL)
    asked = spark.createDataFrame([(1, "Did prices of wheat fell or rise?")], "question_id bigint, text string")
    (got,) = ask(asked, table.read(), k=2, dim=8).collect()
    assert "https://x.test/wheat" in got.sources and got.answer.endswith("Question: Did prices of wheat fell or rise?")
    (none,) = ask(asked, table.read(), threshold=1.1, dim=8).collect()
    assert (none.answer, none.sources) == ("I don't have enough information.", [])


def test_embedded_output_schema(spark, table):
    rows = embedded_chunks(embed(chunk_items(items(spark, doc("a", "x"))), dim=8))
    assert rows.columns == EMBEDDED_CHUNK.fieldNames() and len(rows.columns) == 11


def test_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(root) and work_dir(spark, "x") != work_dir(spark, "x")
    assert materialize(spark, spark.range(3), "three").count() == 3


# -- streams -----------------------------------------------------------------


def drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.tmp", "w") as f:
        f.write("\n".join(json.dumps(x) if isinstance(x, dict) else x for x in lines))
    os.rename(f"{folder}/{name}.tmp", f"{folder}/{name}.json")


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def record(url, content, at=1):
    return {"source_id": "s", "url": url, "content": content, "fetched_at": at}


def test_stream_equals_batch_across_restarts(spark, table, tmp_path):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")

    def once():
        stream = stream_records(spark, inbox, pathGlobFilter="*.json")
        return run(ingest_stream(stream, table, checkpoint, SMALL, summaries=str(tmp_path / "sums"), once=True))

    first = [record("a", "One two three four. Five."), "bad", record("b", "B."), "[1]", record("e", "<p> </p>")]
    drop(inbox, "1", first)
    progress = [p.observedMetrics for p in once().recentProgress if "decode" in p.observedMetrics]

    def counted(name, field):
        return sum(m[name][field] for m in progress)

    assert counted("decode", "accepted") == 3
    assert counted("decode", "schema_invalid") == 1 and counted("decode", "decode_failed") == 1
    assert counted("normalize", "kept") == 2 and counted("refine", "kept") == 2 and counted("chunk", "chunks") == 3
    drop(inbox, "2", [record("a", "New text.", 2)])
    once()
    once()  # nothing new
    drop(inbox, "3", [record("c", "C.", 3)])
    once()
    want = [("a", 0, "New text."), ("a", 1, "Five."), ("b", 0, "B."), ("c", 0, "C.")]
    assert texts(table) == want
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "sums")).collect()]
    assert sorted((s["url"], s["chunks"]) for s in lines) == [("a", 1), ("a", 2), ("b", 1), ("c", 1)]
    batch = VectorTable(spark, str(tmp_path / "batch"))
    ingest_records(spark.read.option("pathGlobFilter", "*.json").text(inbox), batch, None, SMALL)
    assert texts(batch) == want


def test_summaries_and_failures_survive_a_replay(spark, table, tmp_path):
    def load(dim):
        def run(texts):
            if any("poison" in t for t in texts):
                raise RuntimeError("model failed")
            return [[1.0] * dim for _ in texts]

        return run

    register_embedder("brittle", load)
    options = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8, provider="brittle")
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    long = "One two three four. Five six seven eight. Nine."
    drop(inbox, "1", [record("a", long), record("a", "New.", 2), record("b", "All fine."), record("c", "Some poison here.")])

    def once(n):
        sums, failures = str(tmp_path / f"sums{n}"), str(tmp_path / f"failures{n}")
        run(ingest_stream(stream_records(spark, inbox), table, checkpoint, options, summaries=sums, failures=failures, once=True))
        lines = [json.loads(r.value) for r in spark.read.text(sums).collect()]
        failed = spark.read.parquet(failures).collect()
        return sorted((s["url"], s["chunks"]) for s in lines), [(r.url, r.reason) for r in failed]

    want = [("a", 1), ("a", 3), ("b", 1)], [("c", "embedding_failed")]
    assert once(1) == want
    stored = texts(table)
    assert {t[0] for t in stored} == {"a", "b"}
    for name in ("0", ".0.crc"):  # as if the query had stopped before its commit
        os.remove(f"{checkpoint}/commits/{name}")
    assert once(2) == want and texts(table) == stored


def test_rejects_do_not_stop_the_stream(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    drop(inbox, "1", ["bad", record("a", "ok"), '{"url":"x"}'])
    run(reject_stream(stream_records(spark, inbox), out, str(tmp_path / "cp"), once=True))
    drop(inbox, "2", ["[]"])
    run(reject_stream(stream_records(spark, inbox), out, str(tmp_path / "cp"), once=True))
    assert sorted(r.reason for r in spark.read.parquet(out).collect()) == ["invalid_json", "missing_key", "not_object"]


def test_stream_dedup_by_batch_clock(spark, table, tmp_path):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")

    def once():
        run(ingest_stream(stream_records(spark, inbox), table, checkpoint, SMALL, ttl="72 hours", once=True))

    drop(inbox, "1", [record(" a ", "first."), record("a", "first."), record("b", "old article.", 1)])
    once()
    drop(inbox, "2", [record("a", "repeat."), record("c", "later.", 0)])
    once()
    assert texts(table) == [("a", 0, "first."), ("b", 0, "old article."), ("c", 0, "later.")]


def test_stream_language_step_follows_dedup(spark, table, tmp_path):
    inbox = str(tmp_path / "in")
    options = IngestOptions(max_tokens=50, overlap_tokens=0, dim=8, detect=True, languages=("de",))
    drop(inbox, "1", [record("a", "Der Hund und die Katze."), record("a", "Der Hund und die Katze."), record("b", "It is the end of it.")])
    stream = stream_records(spark, inbox)
    run(ingest_stream(stream, table, str(tmp_path / "cp"), options, ttl="1 hour", once=True))
    assert texts(table) == [("a", 0, "Der Hund und die Katze.")]
    with pytest.raises(ValueError, match="ttl"):
        ingest_stream(stream, table, str(tmp_path / "cp2"), IngestOptions(dim=8, dedup=True))


def test_stream_dedup_expires_by_event_time(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    hour = 3600

    def once():
        decoded = decode_stream(stream_records(spark, inbox)).select("url", "content", "fetched_at")
        kept = dedup_stream(decoded, "72 hours", event_time="fetched_at")
        run(
            kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        return sorted(r.content for r in spark.read.parquet(out).collect())

    drop(inbox, "1", [record("a", "a1", 1000 * hour)])
    assert once() == ["a1"]
    drop(inbox, "2", [record("a", "a2", 1010 * hour), record("b", "b1", 1050 * hour)])
    assert once() == ["a1", "b1"]
    drop(inbox, "3", [record("c", "c1", 1200 * hour)])
    assert once() == ["a1", "b1", "c1"]
    drop(inbox, "4", [record("a", "a3", 1201 * hour)])
    assert once() == ["a1", "a3", "b1", "c1"]


def test_first_in_batch_keeps_row_order(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("c", 4), ("b", 5)], "k string, v int").coalesce(1)
    assert [tuple(r) for r in first_in_batch(df, "k").collect()] == [("a", 1), ("b", 2), ("c", 4)]


def test_many_batches_compact_themselves(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr("pressmill.operators.vector_table.MAX_DELTAS", 2)
    inbox = str(tmp_path / "in")
    for i in range(3):
        drop(inbox, str(i), [record(f"u{i}", f"text {i}.", i)])
    stream = stream_records(spark, inbox, maxFilesPerTrigger="1")
    run(ingest_stream(stream, table, str(tmp_path / "cp"), SMALL, once=True))
    now = table.snapshot()
    assert len(texts(table)) == 3 and now["base_rows"] == 3 and now["deltas"] == []


def test_print_stream(spark, tmp_path):
    drop(str(tmp_path / "in"), "1", ["x"])
    run(print_stream(stream_records(spark, str(tmp_path / "in")), str(tmp_path / "cp"), once=True))


def test_a_torn_snapshot_is_not_seen(spark, tmp_path):
    from pressmill.operators.files import Files

    files = Files(spark, str(tmp_path))
    files.create(f"{tmp_path}/s/1.json", {"a": 1})
    (tmp_path / "s" / ".2.json.torn").write_text("")
    assert files.names(f"{tmp_path}/s") == ["1.json"]
    with pytest.raises(FileExistsError):
        files.create(f"{tmp_path}/s/1.json", {"a": 2})
    assert files.load(f"{tmp_path}/s/1.json") == {"a": 1}


def test_a_new_registration_replaces_a_cached_model(spark):
    import numpy as np

    from pressmill.operators.embedding import embed, register_embedder

    rows = spark.createDataFrame([("x",), ("y",), ("z",)], "chunk_text string").coalesce(1)
    for value in (1.0, 2.0):
        register_embedder("constant", lambda dim, value=value: lambda texts: np.full((len(texts), dim), value if len(texts) <= 2 else -1.0))
        got = embed(rows, provider="constant", dim=3, batch_size=2).collect()
        assert [list(r.embedding) for r in got] == [[value] * 3] * 3


def test_unregistered_sources_are_refused(spark):
    from pressmill.sources.feeds import feed_rejects

    feed = "<rss><channel><item><link>https://a.test</link></item></channel></rss>"
    payloads = spark.createDataFrame([("known", feed), ("strange", feed), ("known", "no xml")], "source_id string, payload string")
    sources = spark.createDataFrame([("known",)], "id string")
    assert sorted(r.reason for r in feed_rejects(payloads, sources).collect()) == ["invalid_feed", "unknown_source"]


def test_stream_dedup_passes_old_times_of_new_urls(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    hour, schema = 3600, "url string, content string, fetched_at long"

    def once(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(inbox)
        kept = dedup_stream(spark.readStream.schema(schema).parquet(inbox), "72 hours", event_time="fetched_at")
        query = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        run(query.trigger(availableNow=True).start())
        return sorted(r.content for r in spark.read.parquet(out).collect())

    assert once(("a", "a1", 1000 * hour)) == ["a1"]
    assert once(("b", "b1", 1001 * hour)) == ["a1", "b1"]
    assert once(("c", "c1", 10 * hour), ("c", "c2", 20 * hour), ("c", "c3", 90 * hour), ("d", "d1", None)) == ["a1", "b1", "c1", "c3", "d1"]
    assert once(("a", "a2", 1071 * hour), ("b", "b2", 1073 * hour), ("c", "c4", 100 * hour)) == ["a1", "b1", "b2", "c1", "c3", "d1"]


# -- bucketed layout and url index ------------------------------------------------


def test_reads_above_the_broadcast_bound_pair_buckets_without_moving_the_base(spark, table, monkeypatch):
    monkeypatch.setattr("pressmill.operators.vector_table.BROADCAST_DELTA_ROWS", 40)
    ingest_items(items(spark, *[doc(f"u{i}", f"first {i}.") for i in range(300)]), table, SMALL)
    ingest_items(items(spark, *[doc(f"u{i}", f"second {i}.", 2) for i in range(0, 300, 2)]), table, SMALL)
    ingest_items(items(spark, *[doc(f"u{i}", f"third {i}.", 3) for i in range(0, 300, 3)]), table, SMALL)
    now = table.snapshot()
    groups = table._groups(now, table.buckets()[0])
    assert len(groups) > 1 and all(fits for _, fits in groups)
    assert sorted(b for g, _ in groups for b in g) == list(range(table.buckets()[0]))
    got = {r.url: r.chunk_text for r in table.read().collect()}
    want = {f"u{i}": f"{'third' if i % 3 == 0 else 'second' if i % 2 == 0 else 'first'} {i}." for i in range(300)}
    assert got == want
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "BroadcastExchange" in plan
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan


def test_deltas_above_the_total_bound_are_not_broadcast(spark, table, monkeypatch):
    monkeypatch.setattr("pressmill.operators.vector_table.BROADCAST_DELTA_ROWS", 40)
    monkeypatch.setattr("pressmill.operators.vector_table.BROADCAST_TOTAL_ROWS", 100)
    ingest_items(items(spark, *[doc(f"u{i}", f"first {i}.") for i in range(300)]), table, SMALL)
    ingest_items(items(spark, *[doc(f"u{i}", f"second {i}.", 2) for i in range(0, 300, 2)]), table, SMALL)
    ingest_items(items(spark, *[doc(f"u{i}", f"third {i}.", 3) for i in range(0, 300, 3)]), table, SMALL)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    got = {r.url: r.chunk_text for r in table.read().collect()}
    assert "BroadcastExchange" not in plan
    assert got == {f"u{i}": f"{'third' if i % 3 == 0 else 'second' if i % 2 == 0 else 'first'} {i}." for i in range(300)}


def test_replace_url_follows_extents_through_every_kind_of_upsert(spark, table):
    replace = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8, replace_url=True)

    def version(tag, n):
        return " ".join(f"{tag}{k} x y z." for k in range(n))

    def chunks(url):
        return [t for t in texts(table) if t[0] == url]

    ingest_items(items(spark, doc("a", version("c", 5)), doc("b", version("c", 5))), table, SMALL)
    ingest_items(items(spark, doc("a", version("d", 3), 2)), table, replace)
    assert [t[1] for t in chunks("a")] == [0, 1, 2]
    ingest_items(items(spark, doc("a", version("e", 4), 3)), table, SMALL)
    assert [t[1] for t in chunks("a")] == [0, 1, 2, 3]
    table.compact()
    ingest_items(items(spark, doc("a", version("f", 2), 4), doc("c", version("g", 1), 4)), table, replace)
    assert chunks("a") == [("a", 0, "f0 x y z."), ("a", 1, "f1 x y z.")]
    assert [t[1] for t in chunks("b")] == [0, 1, 2, 3, 4] and chunks("c") == [("c", 0, "g0 x y z.")]
    table.fold_urls()
    assert len(table.snapshot()["urls"]) == 1
    ingest_items(items(spark, doc("b", version("h", 1), 5)), table, replace)
    assert chunks("b") == [("b", 0, "h0 x y z.")]


def test_replace_url_opens_only_the_index_buckets_of_its_urls(spark, table):
    replace = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8, replace_url=True)
    ingest_items(items(spark, *[doc(f"u{i}", "a0 x y z. a1 x y z.") for i in range(200)]), table, SMALL)
    batch = table.spark.createDataFrame([("u7", 1)], "url string, _total int")
    mine = [r[0] for r in batch.select(F.pmod(F.xxhash64("url"), F.lit(table.buckets()[1]))).collect()]
    scan = table._scan_urls(table.snapshot()["urls"]).where(F.col("_ubucket").isin(mine))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_ubucket" in plan and 0 < scan.count() < 200 and scan.where("url = 'u7'").count() == 1
    ingest_items(items(spark, doc("u7", "b0 x y z.", 2)), table, replace)
    assert [t for t in texts(table) if t[0] == "u7"] == [("u7", 0, "b0 x y z.")] and len(texts(table)) == 399


def test_two_items_of_one_url_and_time_get_two_lines_also_in_a_replay(spark, table, tmp_path):
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    three = "One two three four. Five six seven eight. Nine."
    items_ = [{"source_id": "s", "url": "x", "content": three}, {"source_id": "s", "url": "x", "content": "Short."}]
    drop(inbox, "1", [*items_, items_[1]])

    def once(n):
        sums = str(tmp_path / f"sums{n}")
        run(ingest_stream(stream_records(spark, inbox), table, checkpoint, SMALL, summaries=sums, once=True))
        return sorted((s["url"], s["chunks"]) for s in (json.loads(r.value) for r in spark.read.text(sums).collect()))

    assert once(1) == [("x", 1), ("x", 3)]
    stored = texts(table)
    for name in ("0", ".0.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    assert once(2) == [("x", 1), ("x", 3)] and texts(table) == stored


def test_ties_of_fetch_time_go_to_one_item_for_all_its_chunks(spark, tmp_path):
    for parts in (1, 7):
        store = VectorTable(spark, str(tmp_path / f"t{parts}"))
        versions = [doc(f"u{i}", f"v{k}a x y z. v{k}b x y z. v{k}c x y z.", 5) for i in range(30) for k in range(3)]
        ingest_items(items(spark, *versions).repartition(parts), store, SMALL)
        got = {}
        for url, _, text in texts(store):
            got.setdefault(url, set()).add(text[:2])
        assert all(len(v) == 1 for v in got.values()) and len(got) == 30


def test_counters_per_batch_survive_a_replay(spark, table, tmp_path):
    def load(dim):
        def run(texts):
            if any("poison" in t for t in texts):
                raise RuntimeError("model failed")
            return [[1.0] * dim for _ in texts]

        return run

    register_embedder("brittle2", load)
    options = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8, provider="brittle2")
    inbox, checkpoint, counted = str(tmp_path / "in"), str(tmp_path / "cp"), str(tmp_path / "counters")
    drop(inbox, "1", [record("a", "One two three four. Five."), record("b", "All fine."), record("c", "Some poison here.")])

    def once():
        query = run(ingest_stream(stream_records(spark, inbox), table, checkpoint, options, counters=counted, once=True))
        rows = [tuple(r) for r in spark.read.parquet(counted).select("chunks", "items", "written", "embedding_failed", "upsert_failed").collect()]
        dropped = [p.observedMetrics["refine"]["chunked_dropped"] for p in query.recentProgress if "refine" in p.observedMetrics]
        return rows, dropped

    rows, dropped = once()
    assert rows == [(4, 3, 3, 1, 0)] and dropped == [0]
    for name in ("0", ".0.crc"):
        os.remove(f"{checkpoint}/commits/{name}")
    assert once()[0] == [(4, 3, 3, 1, 0)]


def test_jobs_set_the_embedding_batch_size(spark, table):
    def load(dim):
        def run(texts):  # each vector tells how many texts came at once
            return [[float(len(texts))] * dim for _ in texts]

        return run

    register_embedder("counted", load)
    options = IngestOptions(max_tokens=4, overlap_tokens=0, dim=8, provider="counted", batch_size=3)
    assert ingest_items(items(spark, *[doc(f"u{i}", "a b c d.") for i in range(20)]).coalesce(1), table, options) == 20
    assert len(texts(table)) == 20
    assert {r.embedding[0] for r in table.read().collect()} <= {1.0, 2.0, 3.0}


def test_stream_dedup_calls_its_state_function_by_group_not_by_url(spark, tmp_path):
    """Urls of one group keep their own times; a null url is a url; state goes url by url."""
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    hour = 3600

    def once(*rows):
        spark.createDataFrame(list(rows), "url string, content string, at bigint").coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema("url string, content string, at bigint").parquet(inbox)
        kept = dedup_stream(stream, "72 hours", event_time="at", groups=1)
        assert kept.columns == ["url", "content", "at"]
        run(
            kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        return sorted(r.content for r in spark.read.parquet(out).collect())

    assert once(("a", "a1", 1000 * hour), ("a", "a2", 1001 * hour), ("b", "b1", 900 * hour), (None, "n1", 5 * hour)) == ["a1", "b1", "n1"]
    assert once(("b", "b2", 971 * hour), (None, "n2", 6 * hour), ("c", "c1", hour)) == ["a1", "b1", "c1", "n1"]
    assert once(("b", "b3", 972 * hour), (None, "n3", 77 * hour), ("a", "a3", 1071 * hour)) == ["a1", "b1", "b3", "c1", "n1", "n3"]
    state = spark.read.format("statestore").load(checkpoint)
    assert state.count() == 1


def test_only_chunks_of_repeated_urls_are_ranked(spark):
    from pressmill.operators.vector_table import latest_per_chunk
    from pressmill.plans.ingest import chunked_items, latest_chunks, newest_first

    options = IngestOptions(max_tokens=3, overlap_tokens=0, dim=4)
    long, short = "A b c. D e f. G h i.", "New one here."
    once = [{"url": f"https://x.test/{i}", "content": long} for i in range(6)]
    twice = [{"url": "https://x.test/t", "content": long}, {"url": " https://x.test/t ", "content": short, "fetched_at": 5}]
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    alone = latest_chunks(items(spark, *once), options)
    assert "Window" not in plan(alone) and "Exchange" not in plan(alone) and alone.count() == 18
    for entries in (once + twice, once + [{"url": None, "content": long}], twice + twice[:1], []):
        every = chunked_items(items(spark, *entries), options)
        want = latest_per_chunk(every, newest_first(every.columns))
        got = latest_chunks(items(spark, *entries), options)
        assert got.columns == want.columns
        key = lambda df: sorted((str(r.chunk_id), str(r.url), r.total_chunks) for r in df.collect())
        if any(e["url"] is None for e in entries):
            assert len(key(got)) == len(key(want)) == 19
        else:
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert {r.chunk_text for r in latest_chunks(items(spark, *once, *twice), options).where("url like '%/t' and chunk_index = 0").collect()} == {short}
