"""Feed payloads to items: RSS 2.0, RSS 1.0 and Atom in one XML parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressmill.functions.text import empty_to_null, first_filled, strip_html, trim_space
from pressmill.operators.joins import lookup_join
from pressmill.operators.validate import sample
from pressmill.schemas import ITEM

# The elements a feed entry is read from.
_COMMON = [
    "title:array<string>",
    "link:array<struct<_VALUE:string,_href:string,_rel:string>>",
    "published:array<string>",
    "updated:array<string>",
]
_RSS_ITEM = ",".join([
    *_COMMON,
    "guid:array<struct<_VALUE:string,_isPermaLink:string>>",
    "description:array<string>",
    "`content:encoded`:array<string>",
    "author:array<string>",
    "`dc:creator`:array<string>",
    "pubDate:array<string>",
    "`dc:date`:array<string>",
])
_ATOM_ENTRY = ",".join([
    *_COMMON,
    "id:array<string>",
    "summary:array<string>",
    "content:array<string>",
    "author:array<struct<name:array<string>>>",
])
FEED_XML = (
    f"channel struct<item:array<struct<{_RSS_ITEM}>>>, "
    f"item array<struct<{_RSS_ITEM}>>, "
    f"entry array<struct<{_ATOM_ENTRY}>>, "
    "_malformed string"
)

_CDATA_BORDER = r"(?=<!\[CDATA\[)|(?<=\]\]>)"

# Zone names of RFC 822. They are fixed offsets, also in summer.
_ZONES = {
    "UT": "+0000", "GMT": "+0000", "UTC": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}

_BARE_AMPERSAND = r"&(?!(?:amp|lt|gt|quot|apos|#\d+|#x[0-9A-Fa-f]+);)"


def escape_ampersands(xml: Column) -> Column:
    """Escape ``&`` that starts no XML reference, outside CDATA sections, so
    that HTML entities such as ``&nbsp;`` do not break the document."""
    segments = F.split(xml, _CDATA_BORDER, -1)
    escaped = F.transform(
        segments,
        lambda s: F.when(F.startswith(s, F.lit("<![CDATA[")), s).otherwise(
            F.regexp_replace(s, _BARE_AMPERSAND, "&amp;")
        ),
    )
    return F.when(F.contains(xml, F.lit("&")), F.array_join(escaped, "")).otherwise(xml)


def epoch_seconds(text: Column) -> Column:
    """RFC 822 or ISO 8601 date text to epoch seconds, read as UTC where no
    zone is given; null where it is no date."""
    rfc = F.regexp_replace(text, "^[A-Za-z]+, *", "")
    names = F.create_map(*[F.lit(x) for pair in _ZONES.items() for x in pair])
    name = F.upper(F.regexp_extract(rfc, "([A-Za-z]+)$", 1))
    zoned = (
        F.when(F.rlike(rfc, F.lit(r"\d:\d\d$")), F.concat(rfc, F.lit(" +0000")))
        .when(name != "", F.concat(F.regexp_replace(rfc, "[A-Za-z]+$", ""), F.try_element_at(names, name)))
        .otherwise(rfc)
    )
    tries = [
        F.try_to_timestamp(zoned, F.lit(f"d MMM {year} {time} Z")) for year in ("yyyy", "yy") for time in ("H:mm:ss", "H:mm")
    ]
    iso = (
        F.when(F.rlike(text, F.lit(r"^\d{4}-\d\d-\d\d$")), F.concat(text, F.lit("T00:00:00Z")))
        .when(F.rlike(text, F.lit(r"(?:Z|[+-]\d\d:?\d\d)$")), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    by_iso = F.when(F.rlike(text, F.lit(r"^\d{4}-")), iso.try_cast("timestamp"))
    return F.unix_timestamp(F.coalesce(by_iso, F.when(~F.rlike(text, F.lit(r"^\d{4}-")), F.coalesce(*tries))))


def _value(leaf: Column) -> Column:
    """Text of the first element of that name."""
    return F.get(leaf, F.lit(0))["_VALUE"]


def _entry(url: Column, title: Column, summary: Column, content: Column, author: Column, *dates: Column) -> Column:
    return F.struct(
        url.alias("url"),
        title.alias("title"),
        summary.alias("summary"),
        first_filled(content, summary).alias("content"),
        author.alias("author"),
        first_filled(*dates).alias("date"),
    )


def _first(texts: Column) -> Column:
    return F.get(texts, F.lit(0))


def _rss(i: Column) -> Column:
    permalink = F.filter(i["guid"], lambda g: F.coalesce(F.lower(g["_isPermaLink"]), F.lit("true")) == "true")
    url = first_filled(trim_space(_value(i["link"])), trim_space(_value(permalink)))
    author = first_filled(_first(i["author"]), _first(i["dc:creator"]))
    dates = [_first(i[n]) for n in ("pubDate", "published", "dc:date", "updated")]
    return _entry(
        url, _first(i["title"]), _first(i["description"]), _first(i["content:encoded"]), author, *dates
    )


def _atom(e: Column) -> Column:
    page = F.filter(e["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    url = first_filled(
        trim_space(_first(page)["_href"]), trim_space(_value(e["link"])), trim_space(_first(e["id"]))
    )
    author = _first(_first(e["author"])["name"])
    dates = [_first(e[n]) for n in ("published", "updated")]
    return _entry(url, _first(e["title"]), _first(e["summary"]), _first(e["content"]), author, *dates)


def _parse(payloads: DataFrame) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed", "attributePrefix": "_"}
    return payloads.withColumn("_xml", escape_ampersands(F.col("payload"))).withColumn(
        "_feed", F.from_xml("_xml", FEED_XML, options)
    )


def parse_feeds(payloads: DataFrame, sources: DataFrame, fetched_at: int) -> DataFrame:
    """``(source_id, payload)`` to items.

    Entries without a link are skipped. Source id, language and tags come from
    the registry. Texts lose their HTML; the author is taken as it is. The
    fetch time is an argument, so a repeated run gives the same rows.
    """
    feed = F.col("_feed")

    def each(entries: Column, shape) -> Column:
        return F.coalesce(F.transform(entries, shape), F.array())

    entries = F.concat(
        each(feed["channel"]["item"], _rss), each(feed["item"], _rss), each(feed["entry"], _atom)
    )
    rows = (
        _parse(payloads)
        .select("source_id", F.explode(entries).alias("e"))
        .select("source_id", F.xxhash64("e.url").alias("_row"), "e.*")
        .where(F.col("url").isNotNull())
    )
    registry = sources.select(F.col("id").alias("source_id"), "language", "tags")
    joined = lookup_join(rows, registry, "source_id", ["_row"])
    stripped = strip_html(joined, ["title", "summary", "content"]).withColumn("date", trim_space(F.col("date")))
    return stripped.withColumns(
        {
            "author": empty_to_null(F.col("author")),
            "published_at": epoch_seconds(F.col("date")),
            "fetched_at": F.lit(fetched_at).cast("bigint"),
        }
    ).select(*ITEM.fieldNames())


def feed_rejects(payloads: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Payloads that are no XML document, or come from a source that ``sources`` lacks: ``value_sample, reason``."""
    if sources is not None:
        known = sources.select(F.col("id").alias("source_id")).distinct()
        strange = payloads.join(known, "source_id", "left_anti")
        unknown = strange.select(sample(F.col("payload")).alias("value_sample"), F.lit("unknown_source").alias("reason"))
        return feed_rejects(payloads.join(known, "source_id", "left_semi")).unionByName(unknown)
    malformed = F.col("payload").isNull() | F.col("_feed")["_malformed"].isNotNull()
    return (
        _parse(payloads)
        .where(malformed)
        .select(
            sample(F.col("payload")).alias("value_sample"),
            F.when(F.col("payload").isNull(), "null_value").otherwise("invalid_feed").alias("reason"),
        )
    )
