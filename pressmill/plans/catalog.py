"""Registered queries: every operator over the whole stored tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressmill.functions.text import clean_text
from pressmill.functions.vectors import hash_vectors
from pressmill.operators.answers import answers, contexts, prompts, register_completer
from pressmill.operators.chunking import chunk_items, split_items
from pressmill.operators.dedup import dedup_by_url
from pressmill.operators.embedding import embed, register_embedder
from pressmill.operators.joins import fits_broadcast
from pressmill.operators.language import allow_languages, detect_language, language_scores
from pressmill.operators.normalize import normalize_items
from pressmill.operators.records import (
    embedded_chunk_records,
    embedded_chunks,
    ingest_summary,
    items_per_source,
    summary_json,
    to_records,
)
from pressmill.operators.retrieval import hit_defaults, search, top_k_ids
from pressmill.operators.validate import accepted, decode_records, rejects
from pressmill.operators.vector_table import VectorTable
from pressmill.plans.adapters import document_items, spread, table
from pressmill.plans.ask import ask
from pressmill.plans.ingest import IngestOptions, embedded_items, ingest_items, ingest_records, stage_counts
from pressmill.schemas import EMBEDDED_CHUNK
from pressmill.session import work_dir
from pressmill.sources.feeds import feed_rejects, parse_feeds
from pressmill.sources.pages import page_items
from pressmill.sources.records import read_records, stream_records
from pressmill.sources.registry import check_sources
from pressmill.streaming.dedup import dedup_stream
from pressmill.streaming.ingest import ingest_stream, reject_stream

DIM = 64
SMALL = {"max_tokens": 64, "overlap_tokens": 16}
OPTIONS = IngestOptions(**SMALL, dim=DIM)
LABEL_ROWS = 500_000  # three numbers each; more labels are not broadcast
CHUNK_COLUMNS = ["chunk_id", "url", "title", "chunk_text", "chunk_index", "total_chunks", "language", "source_id"]


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return document_items(_documents(spark, folder))


def _flat_tags(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", F.array_join("tags", ","))


# -- items -------------------------------------------------------------------


def normalize_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_tags(normalize_items(_items(spark, folder))).select(
        "source_id", "url", "title", "content", "language", "tags"
    )


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages")).select(
        F.parse_url("url", F.lit("HOST")).alias("source_id"),
        "url",
        "html",
        F.lit(None).cast("string").alias("language"),
        F.array(F.lit("Web"), F.lit("web")).alias("tags"),
    )


def clean_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Page extraction, then the normal item cleaning."""
    items = normalize_items(page_items(_pages(spark, folder), fetched_at=0))
    return _flat_tags(items).select("source_id", "url", "title", "content", "tags")


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    """All visible text of each page, as the cleaning step sees raw HTML."""
    return clean_text(spread(table(spark, folder, "pages")).select("page_id", F.col("html").alias("text")), ["text"])


def dedup_url(spark: SparkSession, folder: str) -> DataFrame:
    """Content-addressed urls: exact copies of a text share one url."""
    items = _items(spark, folder).withColumn("url", F.concat(F.lit(" https://docs.example/"), F.md5("content")))
    items = items.withColumn("fetched_at", F.regexp_extract("title", r"(\d+)", 1).cast("bigint"))
    return dedup_by_url(normalize_items(items)).select("url", "title", "source_id", "content", "fetched_at")


def language_hits(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text")
    return language_scores(docs, "text").drop("text")


def language_detected(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text", F.col("lang").alias("labelled"))
    found = detect_language(docs.withColumn("language", F.lit(None).cast("string")), "text")
    return found.select("doc_id", "labelled", "language")


def language_filter(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text").withColumn("language", F.lit(None).cast("string"))
    return allow_languages(detect_language(docs, "text"), ["es", "fr", "de"]).select("doc_id", "language")


# -- records -----------------------------------------------------------------


def _raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """Good and bad record texts, each kind made from a whole table."""
    docs = _documents(spark, folder)
    url = F.concat(F.lit("https://docs.example/"), F.col("doc_id"))
    named = [F.col("source").alias("source_id"), url.alias("url")]
    kinds = [
        to_records(document_items(docs)).select("value"),
        docs.select(F.col("text").alias("value")),
        docs.select(F.concat(F.lit("["), F.col("doc_id"), F.lit("]")).alias("value")),
        docs.select(F.to_json(F.struct(url.alias("url"))).alias("value")),
        docs.select(F.to_json(F.struct(*named, F.col("lang").alias("published_at"))).alias("value")),
        docs.select(
            F.to_json(
                F.struct(named[0], F.lit(None).cast("string").alias("url")), {"ignoreNullFields": "false"}
            ).alias("value")
        ),
        docs.select(F.to_json(F.struct(*named, F.lit("<b> </b>").alias("content"))).alias("value")),
        table(spark, folder, "events").select(F.col("props").alias("value")),
        table(spark, folder, "labels").select(F.lit(None).cast("string").alias("value")),
    ]
    out = kinds[0]
    for kind in kinds[1:]:
        out = out.unionByName(kind)
    return out


def validate_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return rejects(decode_records(_raw_records(spark, folder)))


def validate_accepted(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_tags(accepted(decode_records(_raw_records(spark, folder))))


def _record_files(spark: SparkSession, folder: str) -> str:
    """All documents as JSON lines in a shared work folder."""
    path = work_dir(spark, "records")
    to_records(_items(spark, folder)).select("value").write.text(path)
    return path


_ROUNDTRIP = ("key", "source_id", "url", "title", "content", "language", "tags", "fetched_at")


def records_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """The batch source: JSON-line files read back and decoded (the key is the url)."""
    decoded = accepted(decode_records(read_records(spark, _record_files(spark, folder))))
    return _flat_tags(decoded.withColumn("key", F.col("url"))).select(*_ROUNDTRIP)


def records_from_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The file stream source: the same files as a stream, decoded into a table."""
    out, checkpoint = work_dir(spark, "decoded"), work_dir(spark, "checkpoint")
    decoded = accepted(decode_records(stream_records(spark, _record_files(spark, folder))))
    query = decoded.withColumn("key", F.col("url")).writeStream.format("parquet").option("path", out)
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return _flat_tags(spark.read.parquet(out)).select(*_ROUNDTRIP)


def record_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    records = to_records(_items(spark, folder))
    return _flat_tags(accepted(decode_records(records))).select(
        "key", "source_id", "url", "title", "content", "language", "tags", "fetched_at"
    )


def outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stage_counts(_raw_records(spark, folder))


def source_counts(spark: SparkSession, folder: str) -> DataFrame:
    return items_per_source(_items(spark, folder))


# -- feeds -------------------------------------------------------------------


def _escaped(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def _registry(spark: SparkSession, folder: str) -> DataFrame:
    """One registry row per source that occurs in the documents."""
    found = table(spark, folder, "documents").groupBy("source").agg(F.min("lang").alias("language"))
    return check_sources(
        found.select(
            F.col("source").alias("id"),
            F.lit("rss").alias("type"),
            F.concat(F.lit("https://"), F.col("source"), F.lit(".example/feed")).alias("url"),
            "language",
            F.array(F.col("source")).alias("tags"),
        )
    )


def _rss(docs: DataFrame) -> DataFrame:
    """Each document as a feed whose entries are its lines."""
    link = F.concat(F.lit("https://docs.example/"), F.col("doc_id"), F.lit("#"))
    utc = F.to_utc_timestamp(F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")), F.current_timezone())
    when = F.date_format(utc, "d MMM yyyy HH:mm:ss")
    entries = F.transform(
        F.split(_escaped(F.col("text")), "\n", -1),
        lambda line, i: F.concat(
            F.lit("<item><title>Line &lt;b&gt;"),
            i.cast("string"),
            F.lit("&lt;/b&gt;</title><link>"),
            link,
            i.cast("string"),
            F.lit("</link><author>"),
            F.col("lang"),
            F.lit("</author><description>"),
            line,
            F.lit("</description><pubDate>Mon, "),
            when,
            F.lit(" GMT</pubDate></item>"),
        ),
    )
    payload = F.concat(
        F.lit('<?xml version="1.0"?><rss version="2.0"><channel>'), F.array_join(entries, ""), F.lit("</channel></rss>")
    )
    return docs.select(F.col("source").alias("source_id"), payload.alias("payload"))


def _atom(docs: DataFrame) -> DataFrame:
    """Each document as an Atom feed of one entry."""
    payload = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="html">Doc '),
        F.col("doc_id").cast("string"),
        F.lit('</title><link href="https://docs.example/'),
        F.col("doc_id").cast("string"),
        F.lit('"/><id>urn:doc</id><updated>2024-01-01T00:00:00Z</updated><author><name>'),
        F.col("lang"),
        F.lit("</name></author><summary>"),
        F.col("source"),
        F.lit("</summary><content>"),
        _escaped(F.col("text")),
        F.lit("</content></entry></feed>"),
    )
    return docs.select(F.col("source").alias("source_id"), payload.alias("payload"))


def parse_rss(spark: SparkSession, folder: str) -> DataFrame:
    payloads = _rss(_documents(spark, folder))
    return _flat_tags(parse_feeds(payloads, _registry(spark, folder), fetched_at=9))


def parse_atom(spark: SparkSession, folder: str) -> DataFrame:
    payloads = _atom(_documents(spark, folder))
    return _flat_tags(parse_feeds(payloads, _registry(spark, folder), fetched_at=9))


def feeds_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Atom feeds of all documents in two stream batches; between them the registry changes the language of every source."""
    from pressmill.streaming.feeds import feed_stream

    inbox, registry, out, checkpoint = (work_dir(spark, n) for n in ("feeds", "registry", "items", "checkpoint"))
    docs = _documents(spark, folder)
    _registry(spark, folder).write.parquet(registry)
    schema = "source_id string, payload string"
    for half, language in ((0, None), (1, "xx")):
        if language:
            changed = spark.read.parquet(registry).withColumn("language", F.lit(language))
            changed.write.mode("overwrite").parquet(registry + "-next")
            spark.read.parquet(registry + "-next").write.mode("overwrite").parquet(registry)
        _atom(docs.where(F.col("doc_id") % 2 == half)).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).parquet(inbox)
        feed_stream(stream, registry, out, checkpoint, fetched_at=9, once=True).awaitTermination()
    return _flat_tags(spark.read.parquet(out).drop("batch"))


def refused_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Document texts are no feeds; every one goes to the dead-letter table."""
    docs = _documents(spark, folder)
    plain = docs.select(F.col("source").alias("source_id"), F.col("text").alias("payload"))
    return feed_rejects(plain.unionByName(_atom(docs)))


# -- chunks and vectors ------------------------------------------------------


def sentence_split(spark: SparkSession, folder: str) -> DataFrame:
    return split_items(normalize_items(_items(spark, folder)))


def chunk_documents(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_tags(chunk_items(normalize_items(_items(spark, folder)))).drop("published_at")


def chunk_overlap(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_items(normalize_items(_items(spark, folder)), **SMALL).select(*CHUNK_COLUMNS)


def chunk_pages(spark: SparkSession, folder: str) -> DataFrame:
    items = normalize_items(page_items(_pages(spark, folder), fetched_at=0))
    return chunk_items(items, **SMALL).select(*CHUNK_COLUMNS)


def hash_embedding(spark: SparkSession, folder: str) -> DataFrame:
    """Non-zero weights of each document's vector.

    The outer form of explode: for the inner one Catalyst adds a filter on the
    array's size below the embedding, which would embed every text twice.
    """
    vectors = embed(_documents(spark, folder).select("doc_id", "text"), "text", dim=DIM)
    weights = vectors.select("doc_id", F.posexplode_outer("embedding").alias("bucket", "weight"))
    return weights.where(F.col("weight") != 0).withColumn("weight", F.round(F.col("weight").cast("double"), 6))


def _vector_rows(spark: SparkSession, folder: str) -> DataFrame:
    return embedded_items(_items(spark, folder), OPTIONS)


def embedded_output(spark: SparkSession, folder: str) -> DataFrame:
    """Embedded chunks as written for consumers; the vector's elements as whole ten-thousandths."""
    rows = embedded_chunks(_vector_rows(spark, folder))
    whole = F.transform("embedding", lambda x: F.round(x.cast("double") * 10_000).cast("bigint").cast("string"))
    return _flat_tags(rows).withColumn("embedding", F.array_join(whole, " ")).drop("published_at")


def embedded_records(spark: SparkSession, folder: str) -> DataFrame:
    """Embedded chunks as JSON records, read back; the vector as its number of elements."""
    records = embedded_chunk_records(_vector_rows(spark, folder))
    rows = records.select("key", F.from_json("value", EMBEDDED_CHUNK).alias("r")).select("key", "r.*")
    return _flat_tags(rows).withColumn("embedding", F.size("embedding"))


def chunk_summary(spark: SparkSession, folder: str) -> DataFrame:
    """One summary per processed item, two versions of each url."""
    docs = _items(spark, folder)
    later = docs.withColumn("fetched_at", F.lit(1).cast("bigint")).withColumn("content", F.col("title"))
    chunks = chunk_items(normalize_items(docs.unionByName(later)), **SMALL, carry=("fetched_at",))
    summary = ingest_summary(chunks, ["fetched_at"])
    return summary


def chunk_summary_json(spark: SparkSession, folder: str) -> DataFrame:
    chunks = chunk_items(normalize_items(_items(spark, folder)), carry=("fetched_at",))
    return summary_json(ingest_summary(chunks, ["fetched_at"]))


# -- vector table ------------------------------------------------------------


def _new_table(spark: SparkSession, name: str) -> VectorTable:
    return VectorTable(spark, work_dir(spark, name)).ensure(DIM)


def _reviewed(spark: SparkSession, folder: str, fetched_at: int, text: Column) -> DataFrame:
    """A short second version of every labelled document."""
    labels = table(spark, folder, "labels")
    labels = F.broadcast(labels) if fits_broadcast(labels, LABEL_ROWS) else labels.hint("merge")
    labelled = table(spark, folder, "documents").join(labels, "doc_id")
    items = document_items(labelled.withColumn("text", text))
    return items.withColumn("fetched_at", F.lit(fetched_at).cast("bigint"))


def _two_loads(spark: SparkSession, folder: str, name: str, replace_url: bool) -> VectorTable:
    store = _new_table(spark, name)
    ingest_items(_items(spark, folder), store, OPTIONS)
    grade = F.concat(F.lit("Quality "), F.col("quality"), F.lit(". Toxic "), F.col("toxic"), F.lit("."))
    older = _reviewed(spark, folder, 1, F.concat_ws(" ", grade, F.col("text")))
    newer = _reviewed(spark, folder, 2, grade)
    again = IngestOptions(**SMALL, dim=DIM, replace_url=replace_url)
    ingest_items(older.unionByName(newer), store, again)
    return store


def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Last write wins per chunk id; tails of longer versions stay."""
    return _two_loads(spark, folder, "upsert", False).read().select(*CHUNK_COLUMNS)


def upsert_replace_url(spark: SparkSession, folder: str) -> DataFrame:
    """As above, and a url's chunks beyond its new total go away."""
    return _two_loads(spark, folder, "replace", True).read().select(*CHUNK_COLUMNS)


def compacted_table(spark: SparkSession, folder: str) -> DataFrame:
    store = _two_loads(spark, folder, "compact", False)
    store.compact()
    return store.read().select(*CHUNK_COLUMNS)


def ingested_count(spark: SparkSession, folder: str) -> DataFrame:
    """JSON records through the whole batch job: chunks written, rows refused."""
    refused = work_dir(spark, "rejects")
    written = ingest_records(_raw_records(spark, folder), _new_table(spark, "records"), refused, OPTIONS)
    return spark.read.parquet(refused).agg(F.count("*").alias("refused")).select(
        F.lit(written).cast("bigint").alias("written"), "refused"
    )


# -- retrieval ---------------------------------------------------------------

_tables: dict[tuple[str, str], VectorTable] = {}


def document_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The stored vector table of all documents, built once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        store = _new_table(spark, "documents")
        ingest_items(_items(spark, folder), store, OPTIONS)
        _tables[key] = store
    return _tables[key].read()


def index_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Normalize, chunk, embed and store all documents; read the table back."""
    store = _new_table(spark, "index")
    ingest_items(_items(spark, folder), store, OPTIONS)
    return store.read().select(*CHUNK_COLUMNS)


def _benchmark_questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("question_id"), "text")


def _turn_questions(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").where(F.col("role") == "user")
    return turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("question_id"), "text")


def _hits(hits: DataFrame) -> DataFrame:
    return hits.withColumn("score", F.round("score", 6))


def retrieve_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    asked = embed(_benchmark_questions(spark, folder), "text", dim=DIM)
    return _hits(search(asked, document_vectors(spark, folder)))


def retrieve_turns(spark: SparkSession, folder: str) -> DataFrame:
    asked = embed(_turn_questions(spark, folder), "text", dim=DIM)
    return _hits(search(asked, document_vectors(spark, folder))).drop("title")


def retrieve_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """Only English chunks, and only scores from 0.65 up."""
    asked = embed(_benchmark_questions(spark, folder), "text", dim=DIM)
    vectors = document_vectors(spark, folder)
    return _hits(search(asked, vectors, threshold=0.65, where=F.col("language") == "en"))


def _centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Mean vector of each label; a label's own number also sets its top_k."""
    weights = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("i", "w"))
    means = weights.groupBy("label", "i").agg(F.avg(F.col("w").cast("double")).alias("w"))
    pairs = F.array_sort(F.collect_list(F.struct("i", "w")))
    return means.groupBy("label").agg(F.transform(pairs, lambda p: p["w"]).alias("embedding")).select(
        F.col("label").cast("bigint").alias("question_id"), "embedding", (F.col("label") + 1).alias("top_k")
    )


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding", "label")


def topk_cosine(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(top_k_ids(_centroids(spark, folder).drop("top_k"), _embeddings(spark, folder)))


def topk_per_question(spark: SparkSession, folder: str) -> DataFrame:
    return _hits(top_k_ids(_centroids(spark, folder), _embeddings(spark, folder)))


def topk_threshold(spark: SparkSession, folder: str) -> DataFrame:
    asked = _centroids(spark, folder).drop("top_k")
    return _hits(top_k_ids(asked, _embeddings(spark, folder), k=100, threshold=0.35))


def topk_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The same answer by the block plan that serves very many questions."""
    asked = _centroids(spark, folder).drop("top_k")
    return _hits(top_k_ids(asked, _embeddings(spark, folder), max_questions=4))


def hit_projection(spark: SparkSession, folder: str) -> DataFrame:
    """Defaults of a sparse payload: url and text ``''``, score 0, title null."""
    pages = table(spark, folder, "pages")
    text = F.lit(None).cast("string")
    return hit_defaults(
        pages.select(
            F.col("page_id").alias("question_id"),
            F.lit(1).alias("rank"),
            F.md5("url").alias("chunk_id"),
            text.alias("url"),
            text.alias("title"),
            F.nullif(F.col("url"), F.lit("")).alias("chunk_text"),
            F.lit(None).cast("double").alias("score"),
        )
    )


# -- answers -----------------------------------------------------------------


def context_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Contexts of three hits per question; the second one has no title."""
    asked = embed(_benchmark_questions(spark, folder), "text", dim=DIM)
    hits = search(asked, document_vectors(spark, folder), k=3).withColumn("title", F.when(F.col("rank") != 2, F.col("title")))
    return contexts(hits).withColumn("sources", F.array_join("sources", " "))


def prompt_texts(spark: SparkSession, folder: str) -> DataFrame:
    asked = _benchmark_questions(spark, folder)
    hits = search(embed(asked, "text", dim=DIM), document_vectors(spark, folder), k=2)
    return prompts(asked, hits).withColumn("sources", F.array_join("sources", " "))


def stub_answers(spark: SparkSession, folder: str) -> DataFrame:
    found = ask(_benchmark_questions(spark, folder), document_vectors(spark, folder), dim=DIM)
    return found.withColumn("sources", F.array_join("sources", " "))


def turn_answers(spark: SparkSession, folder: str) -> DataFrame:
    """Every user turn answered, English context only, weak hits left out."""
    found = ask(
        _turn_questions(spark, folder),
        document_vectors(spark, folder),
        k=3,
        threshold=0.65,
        where=F.col("language") == "en",
        dim=DIM,
    )
    return found.withColumn("sources", F.array_join("sources", " "))


def _odd_fails(system: list[str], prompts_: list[str]) -> list[str]:
    """A completer that fails on any batch holding a prompt of odd length."""
    if any(len(p) % 2 for p in prompts_):
        raise ValueError("odd prompt")
    return [f"answered {len(p)}" for p in prompts_]


register_completer("odd_fails", _odd_fails)


def failing_answers(spark: SparkSession, folder: str) -> DataFrame:
    """A completer that fails on some prompts: those questions get an error, the others their answers."""
    found = ask(_benchmark_questions(spark, folder), document_vectors(spark, folder), dim=DIM, provider="odd_fails", errors=True)
    return found.withColumn("sources", F.array_join("sources", " "))


def no_hit_answers(spark: SparkSession, folder: str) -> DataFrame:
    """A threshold nothing reaches: the fixed answer for every question."""
    asked = _benchmark_questions(spark, folder)
    hits = search(embed(asked, "text", dim=DIM), document_vectors(spark, folder), threshold=1.5)
    return answers(asked, hits).withColumn("sources", F.array_join("sources", " "))


# -- streams -----------------------------------------------------------------


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table as a file stream. The pattern makes the same call serve
    a table in one file and a table in a folder."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a stream of JSON records into a vector table."""
    documents = _stream(spark, folder, "documents").repartition(spark.sparkContext.defaultParallelism)
    records = to_records(document_items(documents)).select("value")
    store = _new_table(spark, "stream")
    query = ingest_stream(records, store, work_dir(spark, "checkpoint"), OPTIONS, once=True)
    query.awaitTermination()
    return store.read().select(*CHUNK_COLUMNS)


def stream_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """The line of each item of a stream with two versions of each url."""
    items = document_items(_stream(spark, folder, "documents"))
    later = items.withColumn("fetched_at", F.lit(1).cast("bigint")).withColumn("content", F.col("title"))
    records = to_records(items.unionByName(later)).select("value")
    lines = work_dir(spark, "summaries")
    query = ingest_stream(
        records, _new_table(spark, "summed"), work_dir(spark, "checkpoint"), OPTIONS, summaries=lines, once=True
    )
    query.awaitTermination()
    return spark.read.text(lines).select(F.from_json("value", "url string, chunks bigint").alias("s")).select("s.*")


def stream_summaries_same_time(spark: SparkSession, folder: str) -> DataFrame:
    """Two records of each url with one fetch time: each gets its own line."""
    items = document_items(_stream(spark, folder, "documents"))
    records = to_records(items.unionByName(items.withColumn("content", F.col("title")))).select("value")
    lines = work_dir(spark, "summaries")
    query = ingest_stream(
        records, _new_table(spark, "same"), work_dir(spark, "checkpoint"), OPTIONS, summaries=lines, once=True
    )
    query.awaitTermination()
    return spark.read.text(lines).select(F.from_json("value", "url string, chunks bigint").alias("s")).select("s.*")


def stream_counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of a stream run over all documents: per batch rows added up, and items that gave no chunk."""
    records = to_records(document_items(_stream(spark, folder, "documents"))).select("value")
    counted = work_dir(spark, "counters")
    query = ingest_stream(
        records, _new_table(spark, "counted"), work_dir(spark, "checkpoint"), OPTIONS, counters=counted, once=True
    )
    query.awaitTermination()
    dropped = sum(p.observedMetrics["refine"]["chunked_dropped"] for p in query.recentProgress if "refine" in p.observedMetrics)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("chunks", "items", "written", "embedding_failed", "upsert_failed")]
    return spark.read.parquet(counted).agg(*sums).withColumn("chunked_dropped", F.lit(dropped).cast("bigint"))


def _no_sevens(dim: int) -> Callable:
    """A provider that fails on texts with a 7."""

    def run(texts: list[str]):
        if any("7" in t for t in texts):
            raise ValueError("a text holds a 7")
        return hash_vectors(texts, dim)

    return run


def stream_failures(spark: SparkSession, folder: str) -> DataFrame:
    """A stream whose embedder fails on some texts: each url with its reason, null where it is stored."""
    register_embedder("no_sevens", _no_sevens)
    store, failures = _new_table(spark, "failing"), work_dir(spark, "failures")
    records = to_records(document_items(_stream(spark, folder, "documents"))).select("value")
    options = replace(OPTIONS, provider="no_sevens")
    query = ingest_stream(records, store, work_dir(spark, "checkpoint"), options, failures=failures, once=True)
    query.awaitTermination()
    stored = store.read().select("url", F.lit(None).cast("string").alias("reason")).distinct()
    return stored.unionByName(spark.read.schema("url string, reason string").parquet(failures).select("url", "reason"))


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Stream dedup of content-addressed documents."""
    items = document_items(_stream(spark, folder, "documents"))
    unique = dedup_stream(items.withColumn("url", F.md5("content"))).select("url", "content")
    out, checkpoint = work_dir(spark, "dedup"), work_dir(spark, "checkpoint")
    query = (
        unique.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(unique.schema).parquet(out)


def stream_dedup_expiry(spark: SparkSession, folder: str) -> DataFrame:
    """Each document seen again 71, 73 and 140 hours after its first sight, a batch each, with 72 hours to live."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("url"), "doc_id")
    inbox, out, checkpoint = work_dir(spark, "sightings"), work_dir(spark, "expiry"), work_dir(spark, "checkpoint")
    for hours in (0, 71, 73, 140):
        at = (F.lit((1000 + hours) * 3600) + F.pmod("doc_id", F.lit(1800))).cast("bigint")
        sighted = docs.select("url", F.lit(hours).alias("after"), at.alias("fetched_at"))
        sighted.write.mode("append").parquet(inbox)
        unique = dedup_stream(spark.readStream.schema(sighted.schema).parquet(inbox), "72 hours", event_time="fetched_at")
        query = unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(unique.schema).parquet(out)


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Event properties are JSON but no items; all are refused."""
    records = _stream(spark, folder, "events").select(F.col("props").alias("value"))
    out = work_dir(spark, "refused")
    reject_stream(records, out, work_dir(spark, "checkpoint"), once=True).awaitTermination()
    return spark.read.parquet(out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        normalize_documents,
        clean_pages,
        page_text,
        dedup_url,
        language_hits,
        language_detected,
        language_filter,
        validate_rejects,
        validate_accepted,
        record_roundtrip,
        records_from_files,
        records_from_stream,
        outcome_counts,
        source_counts,
        parse_rss,
        parse_atom,
        feeds_stream,
        refused_feeds,
        sentence_split,
        chunk_documents,
        chunk_overlap,
        chunk_pages,
        hash_embedding,
        embedded_output,
        embedded_records,
        chunk_summary,
        chunk_summary_json,
        index_documents,
        upsert_latest,
        upsert_replace_url,
        compacted_table,
        ingested_count,
        retrieve_benchmark,
        retrieve_turns,
        retrieve_filtered,
        topk_cosine,
        topk_per_question,
        topk_threshold,
        topk_blocks,
        hit_projection,
        context_blocks,
        prompt_texts,
        stub_answers,
        turn_answers,
        failing_answers,
        no_hit_answers,
        stream_ingest,
        stream_summaries,
        stream_summaries_same_time,
        stream_counters,
        stream_failures,
        stream_dedup,
        stream_dedup_expiry,
        stream_rejects,
    )
}
