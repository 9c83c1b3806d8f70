"""The registered queries against SQL over whole tables, and the pipeline's stages in turn."""

import os

import pytest

import corpus_pipeline
from compare import connect, difference
from pressmill.llm.oracle import ORACLE
from pressmill.llm.queries import QUERIES
from pressmill.session import materialize

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    want = connect(FOLDER).sql(ORACLE[name]).to_arrow_table()
    assert difference(QUERIES[name](spark, FOLDER).toArrow(), want) is None


def test_pipeline_stages(spark):
    from test_operators import linked, spans_by_rule

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(materialize(spark, stage(spark, kept[-1], FOLDER), "stage"))
        assert len(kept) > 5 or kept[-1].columns == docs.columns
    rows = [{r.doc_id: r.text for r in df.collect()} for df in kept[1:5]]
    assert 0 < len(rows[0]) < docs.count()
    part = linked(rows[0])[1]
    assert set(rows[1]) == {i for i, c in part.items() if i == c}
    assert set(rows[2]) == set(rows[1]) and not any(spans_by_rule(t or "") for t in rows[2].values())
    assert set(rows[3]) <= set(rows[2]) and kept[5].count() == kept[4].count()
    assert all(r.ids_sha256 for r in kept[5].collect())


def test_pipeline_stages_on_odd_rows(spark, documents):
    """Clashing names, nulls, repeated rows and rows without an id pass every stage; an empty table gives an empty one."""
    from pyspark.sql import functions as F
    from test_operators import ODD, prose

    rows = [(i, prose(80, i) + ".", "ab"[i % 2]) for i in range(100, 140)]
    docs = documents(*ODD, *rows, rows[0], (None, prose(80, 1), "a"), (None, prose(80, 2), None))
    docs = docs.withColumns({"lang": F.lit(None).cast("string"), "n_chars": F.length("text").cast("bigint"), "_copies": F.lit(0)})
    for table in (docs, docs.limit(0)):
        kept = table
        for name, stage in corpus_pipeline.STAGES[1:]:
            after = materialize(spark, stage(spark, kept, FOLDER), "odd")
            if name == "n-gram Jaccard join":
                assert after.where("doc_id is null").count() == table.where("doc_id is null").count()
            if name == "mixing sources" and table is docs:
                assert after.where("doc_id is null and length(text) > 99").count() > 0
            kept = after
        scored = corpus_pipeline.keep_quality(spark, table, FOLDER)
        assert scored.columns == table.columns and scored.count() <= table.count()


def test_one_row_of_each_near_copy_stays(spark, documents):
    """Repeated rows are one document, also where their id is the smallest of a group; rows without an id stay."""
    from test_operators import prose

    rows = [(i, prose(80, i), "a") for i in range(100, 110)]
    copies = [(200, rows[0][1], "a"), (None, rows[0][1], "a"), (None, rows[0][1], "a")]
    docs = documents(*rows, rows[0], rows[0], rows[3], *copies, (300, None, None), (300, None, None))
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.source) for r in kept.collect()), key=repr)
    assert got == sorted([*rows, (None, rows[0][1], "a"), (None, rows[0][1], "a"), (300, None, None)], key=repr)


def test_mixing_targets_sql_where_targets_stop(spark, tmp_path):
    """A source far larger than the others: its share stops at three times its size and the rest is reshared."""
    import duckdb

    from pressmill.llm import mixing
    from pressmill.llm.oracle import OP7_MIXING_TARGETS

    rows = [(i, " ".join(["w"] * (5 + i % 7)), src) for i, src in enumerate(["b"] * 30 + ["a"] * 3 + ["c"] * 200 + [None] * 4 + ["d"] * 2)]
    rows += [(500, None, "a"), (501, "", None), (None, "x y", "b")]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1).write.parquet(path)
    got = mixing.mix_sources(spark.read.parquet(path)).select("doc_id", "size", "source_size", "target").toArrow()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = con.sql(OP7_MIXING_TARGETS).to_arrow_table()
    assert difference(got, want) is None
    capped = {r["source_size"] * 3 for r in want.to_pylist()} & {r["target"] for r in want.to_pylist()}
    assert capped  # the case is met
