import json

import pytest
from pyspark.sql import functions as F

from helpers import items, values
from pressmill.operators.records import to_records
from pressmill.operators.validate import accepted, decode_records, rejects, sample
from pressmill.plans.ingest import stage_counts

GOOD = {"source_id": "s", "url": "u"}
CASES = [
    (GOOD, None),
    ({**GOOD, "tags": []}, None),
    ({**GOOD, "tags": ["x,null,y", "]", "}]"]}, None),
    ({**GOOD, "title": 'quote " brace } ] {'}, None),
    ({"source_id": None, "url": "u"}, None),
    (None, "null_value"),
    ("bad", "invalid_json"),
    ("", "invalid_json"),
    ("  ", "invalid_json"),
    ("{'source_id':'s','url':'u'}", "invalid_json"),
    ('{"source_id":"s","url":"u"} trailing', "invalid_json"),
    ('{"source_id":"s","url":"u"}{}', "invalid_json"),
    ('{"source_id":"s","url":"u"},{"a":1}', "invalid_json"),
    ('{"source_id":"s","url":"u"},null', "invalid_json"),
    ('{"source_id":"s","url":"u"}] [1', "invalid_json"),
    ('{"source_id":"s","url":"u"}],[{}', "invalid_json"),
    ('{"source_id":"s","url":"u","title":"a","title":"b"}', None),
    ('{"source_id":"s","url":"u","tags":["a"],"tags":[null]}', "normalize_failed"),
    ('{"source_id":"s","url":"u","title":"a","title":5}', "bad_type"),
    ('{"source_id":"s","url":"u","title":5,"title":"a"}', None),
    ('{"source_id":"s","url":"u","x":1,"x":2}', "unknown_key"),
    ('{"url":"u","url":"v"}', "missing_key"),
    ('{"source_id":"s","url":"u","url":"v"} trailing', "invalid_json"),
    ('{"source_id":"s","url":"u","url":"v"}] [1', "invalid_json"),
    ('{"source_id":"s","url":"u","url":"v"},{"source_id":"s","url":"u"}', "invalid_json"),
    ([1], "not_object"),
    ('"text"', "not_object"),
    ("5", "not_object"),
    ("null", "not_object"),
    ({"url": "u"}, "missing_key"),
    ({}, "missing_key"),
    ({**GOOD, "extra": 1}, "unknown_key"),
    ({**GOOD, "a, url: STRING": 1}, "unknown_key"),
    ({**GOOD, "published_at": "abc"}, "bad_type"),
    ({**GOOD, "published_at": 1.5}, "bad_type"),
    ({**GOOD, "title": 5}, "bad_type"),
    ({**GOOD, "title": {"a": 1}}, "bad_type"),
    ({**GOOD, "tags": "x"}, "bad_type"),
    ({**GOOD, "tags": [1]}, "bad_type"),
    ({"source_id": "s", "url": None}, "normalize_failed"),
    ({**GOOD, "tags": None}, "normalize_failed"),
    ({**GOOD, "tags": ["a", None]}, "normalize_failed"),
]


def text(value):
    return value if value is None or isinstance(value, str) else json.dumps(value)


def test_every_outcome(spark):
    rows = [(i, text(v)) for i, (v, _) in enumerate(CASES)]
    df = decode_records(spark.createDataFrame(rows, "i int, value string"))
    got = {r.i: r.reason for r in df.collect()}
    assert [(CASES[i][0], got[i]) for i in range(len(CASES))] == CASES


def test_defaults_and_values(spark):
    full = {
        "source_id": "s", "url": "u", "title": "t", "summary": None, "content": "cé\n", "author": "a",
        "published_at": 17, "language": "en", "tags": ["A", "b"], "fetched_at": 5,
    }
    minimal, given = accepted(decode_records(values(spark, json.dumps(GOOD), json.dumps(full)))).collect()
    assert (minimal.title, minimal.published_at, minimal.tags, minimal.fetched_at) == (None, None, [], 0)
    assert given.asDict() == full


def test_rejects_do_not_lose_rows_and_samples_are_bounded(spark):
    long = "x" * 500
    df = decode_records(values(spark, long, None, json.dumps(GOOD)))
    got = {(r.reason, r.value_sample) for r in rejects(df).collect()}
    assert got == {("invalid_json", "x" * 200 + "..."), ("null_value", None)}
    assert accepted(df).count() == 1


@pytest.mark.parametrize("length,want", [(200, 200), (201, 203)])
def test_sample_border(spark, length, want):
    assert len(values(spark, "y" * length).select(sample(F.col("value")).alias("s")).first().s) == want


def test_wrapped_values(spark):
    good = json.dumps(GOOD)
    for df in (
        spark.createDataFrame([([good, "rest"],)], "value array<string>"),
        spark.createDataFrame([((good, 1),)], "value struct<a:string,b:int>"),
        spark.createDataFrame([(good.encode(),)], "value binary"),
    ):
        assert [r.url for r in accepted(decode_records(df)).collect()] == ["u"]


def test_of_repeated_keys_the_last_counts(spark):
    row = accepted(decode_records(values(spark, '{"source_id":"s","url":"u","title":"a","title":"b","title":"c"}'))).first()
    assert (row.title, row.url, row.tags, row.fetched_at) == ("c", "u", [], 0)


@pytest.mark.parametrize("mebibytes", [25, 130])
def test_records_of_any_size(spark, mebibytes):
    # The id keeps the optimizer from folding the text into the plan.
    body = F.expr(f"repeat(concat('word', left(cast(id as string), 0)), {mebibytes << 18})")
    record = F.concat(F.lit('{"source_id":"s","url":"u","fetched_at":7,"content":"é\\n'), body, F.lit('"}'))
    records = spark.range(1).select(record.alias("value"))
    row = accepted(decode_records(records)).select("url", "fetched_at", F.length("content").alias("n"), F.left("content", F.lit(3)).alias("c")).first()
    assert tuple(row) == ("u", 7, 2 + (mebibytes << 20), "é\nw")
    if mebibytes < 100:
        refused = rejects(decode_records(records.select(F.concat("value", F.lit("x")).alias("value")))).first()
        assert refused.reason == "invalid_json"


def test_a_map_is_a_record(spark):
    df = spark.createDataFrame([({"source_id": "s", "url": "u", "title": None},)], "value map<string,string>")
    assert [(r.url, r.title) for r in accepted(decode_records(df)).collect()] == [("u", None)]


def test_roundtrip(spark):
    df = items(
        spark,
        {"title": 'q" \\ é\n', "tags": ["A", ""], "published_at": 1, "fetched_at": 2},
        {"url": "b", "content": "  \x0b </script>"},
    )
    back = accepted(decode_records(to_records(df))).drop("key")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    keys = {r.key: json.loads(r.value) for r in to_records(df).collect()}
    assert keys["b"]["title"] is None and set(keys) == {"https://x.test/a", "b"}


def test_stage_counts(spark):
    empty = json.dumps({**GOOD, "content": "<p> </p>"})
    full = json.dumps({**GOOD, "content": "text"})
    bad_url = json.dumps({"source_id": "s", "url": None})
    df = values(spark, None, "x", "[1]", empty, full, full, bad_url)
    assert {r.stage: r.records for r in stage_counts(df).collect()} == {
        "schema_invalid": 2, "decode_failed": 1, "normalized_dropped": 1, "ingested": 2, "normalize_failed": 1,
    }


def test_accepting_parses_each_record_once(spark):
    plan = accepted(decode_records(values(spark, "x")))._jdf.queryExecution().executedPlan().toString()
    # Once for the value, once more in braces for suspicious text only.
    assert plan.count("parse_json") + plan.count("parseJson") <= 4


def test_one_decode_gives_both_outputs(spark):
    from pressmill.operators.validate import accepted, decode_records, rejects
    from pressmill.plans.ingest import split_outcomes

    good = '{"source_id":"s","url":"u%d","content":"text %d"}'
    records = spark.createDataFrame([(good % (i, i),) for i in range(50)] + [("bad",), ('{"url":"x"}',), (None,)], "value string")
    decoded = decode_records(records)
    ok, refused = split_outcomes(decoded)
    assert sorted(map(tuple, ok.collect())) == sorted(map(tuple, accepted(decoded).collect()))
    assert sorted(map(tuple, refused.collect()), key=repr) == sorted(map(tuple, rejects(decoded).collect()), key=repr)
    for df in (ok, refused):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "parse_json" not in plan and "from_json" not in plan and "PartitionFilters: [isnotnull(_outcome" in plan
