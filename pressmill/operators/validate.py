"""Decode JSON records into items; name the reason for every refusal.

One parse per record: the text becomes a variant, whose schema string tells
validity, keys and types at once, and the fields are read from the variant. The
variant parser refuses repeated keys and very long strings; such texts alone are
looked at again, their shape with long strings cut, their fields by ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressmill.operators.filters import keep_where
from pressmill.schemas import ITEM, ITEM_REQUIRED

SAMPLE_CHARS = 200
SCHEMA_REASONS = ["null_value", "invalid_json"]
DECODE_REASONS = ["not_object", "unknown_key", "missing_key", "bad_type"]

_SHAPES = {
    T.StringType(): "(?:STRING|VOID)",
    T.LongType(): "(?:BIGINT|VOID)",
    T.ArrayType(T.StringType()): "(?:ARRAY<(?:STRING|VOID)>|VOID)",
}


def _well_typed() -> str:
    """Pattern of the variant schema of an object whose known keys fit their types."""
    fields = "|".join(f"{f.name}: {_SHAPES[f.dataType]}" for f in ITEM.fields)
    return f"^ARRAY<OBJECT<(?:(?:{fields})(?:, )?)*>>$"


def _parse(value: Column) -> Column:
    """The value as the only element of a variant array, null if it is no JSON.

    The parser stops at the end of the first value; the brackets make it look
    at what follows. Text that could close the bracket itself is parsed in
    braces as well: nothing but the end of the text passes both.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), value, F.lit("]")))
    braced = F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit("}")))
    return F.when(F.rlike(value, F.lit(r"\}\s*\]")) & braced.isNull(), F.lit(None)).otherwise(listed)


#: A string literal of more than 256 characters; the group holds what is kept of it.
_LONG_STRING = r'"((?:[^"\\]|\\u[0-9A-Fa-f]{4}|\\[^u]){256}+)[^"\\]*+(?:\\.[^"\\]*+)*+"'
_WIDE = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in ITEM.fields]))
_STRICT = {"maxStringLen": "2147483647", "allowSingleQuotes": "false"}


def _shape_of_repeats(value: Column) -> Column:
    """The variant schema of an object with repeated keys, of which the last counts; null for anything else."""
    listed = F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<map<string,variant>>", _STRICT)
    braced = F.from_json(F.concat(F.lit('{"v":'), value, F.lit("}")), "v map<string,variant>", _STRICT)
    entries = F.map_entries(listed[0])
    kind = lambda n: F.schema_of_variant(F.try_element_at(F.filter(entries, lambda e: e["key"] == n), F.lit(-1))["value"])
    known = [F.concat(F.lit(f"{f.name}: "), kind(f.name)) for f in ITEM.fields]
    other = F.exists(entries, lambda e: ~e["key"].isin(ITEM.fieldNames()))
    parts = F.array_compact(F.array(*known, F.when(other, F.lit("`?`: VOID"))))
    return F.when(
        (F.size(listed) == 1) & braced["v"].isNotNull(),
        F.concat(F.lit("ARRAY<OBJECT<"), F.array_join(parts, ", "), F.lit(">>")),
    )


def record_value(records: DataFrame, column: str = "value") -> Column:
    """The record text, whatever wrapper it came in.

    Text and bytes are taken as they are, a list gives its first element and a
    row-like value its first field. A map is the record itself.
    """
    kind = records.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.ArrayType):
        value = F.get(value, F.lit(0))
    elif isinstance(kind, T.StructType):
        value = value[kind.fields[0].name]
    elif isinstance(kind, T.MapType):
        value = F.to_json(value, {"ignoreNullFields": "false"})
    return value.cast("string")


def sample(value: Column, limit: int = SAMPLE_CHARS) -> Column:
    """At most ``limit`` characters, with ``...`` where something was cut."""
    return F.when(F.length(value) > limit, F.concat(F.left(value, F.lit(limit)), F.lit("..."))).otherwise(value)


def decode_records(records: DataFrame, column: str = "value") -> DataFrame:
    """Item columns plus ``value`` and ``reason`` (null = accepted).

    Keys left out take their defaults (null, ``[]``, 0). Refused rows keep
    null fields. Records may be of any size Spark can hold; of repeated keys the
    last counts.
    """
    others = [c for c in records.columns if c != column]
    shaped = (
        records.select(*others, record_value(records, column).alias("value"))
        .withColumn("_v", _parse(F.col("value")))
        .withColumn("_cut", F.when(F.col("_v").isNull(), F.regexp_replace("value", _LONG_STRING, '"$1"')))
        .withColumn("_s", F.when(F.col("_cut").isNotNull(), _parse(F.col("_cut"))).otherwise(F.col("_v")))
        .withColumn("_repeats", F.when(F.col("_s").isNull(), _shape_of_repeats(F.col("_cut"))))
        .withColumn("_shape", F.coalesce(F.schema_of_variant("_s"), F.col("_repeats")))
        .withColumn("_wide", F.when(F.col("_v").isNull() & F.col("_shape").isNotNull(), _wide(F.col("value"))))
    )
    shape, value = F.col("_shape"), F.col("value")
    keys = F.json_object_keys(value)
    unknown = F.size(F.array_except(keys, F.array(*[F.lit(n) for n in ITEM.fieldNames()]))) > 0
    missing = F.size(F.array_except(F.array(*[F.lit(n) for n in ITEM_REQUIRED]), keys)) > 0
    has_required = F.lit(True)
    for name in ITEM_REQUIRED:
        has_required = has_required & F.rlike(shape, F.lit(f"[<,] ?{name}: "))
    null_tag = F.rlike(shape, F.lit("tags: VOID")) | F.exists(_field("tags", "array<string>"), F.isnull)
    one_value = F.try_variant_get("_s", "$[0]", "variant").isNotNull() & F.try_variant_get(
        "_s", "$[1]", "variant"
    ).isNull()
    one_value = one_value | F.col("_repeats").isNotNull()
    unread = F.col("_v").isNull() & F.col("_wide").isNull()
    # The reasons that need the key list come last and are only reached by
    # refused rows, so accepted rows are not parsed a second time.
    reason = (
        F.when(value.isNull(), "null_value")
        .when(~one_value, "invalid_json")
        .when(~F.startswith(shape, F.lit("ARRAY<OBJECT<")), "not_object")
        .when(
            F.rlike(shape, F.lit(_well_typed())) & has_required,
            F.when(unread, "invalid_json").when(F.rlike(shape, F.lit("[<,] ?url: VOID")) | null_tag, "normalize_failed"),
        )
        .when(unknown, "unknown_key")
        .when(missing, "missing_key")
        .otherwise("bad_type")
    )
    judged = shaped.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    fields = {
        "tags": F.coalesce(_field("tags", "array<string>"), F.array().cast("array<string>")),
        "fetched_at": F.when(F.rlike(shape, F.lit("fetched_at: ")), _field("fetched_at", "bigint")).otherwise(0),
    }
    return judged.select(
        *others,
        "value",
        "reason",
        *[
            F.when(ok, fields.get(f.name, _field(f.name, f.dataType.simpleString()))).alias(f.name)
            for f in ITEM.fields
        ],
    )


def _wide(value: Column) -> Column:
    """The fields of a record the variant parser refuses."""
    return F.from_json(F.concat(F.lit("["), value, F.lit("]")), _WIDE, _STRICT)[0]


def _field(name: str, kind: str) -> Column:
    return F.when(F.col("_v").isNotNull(), F.try_variant_get("_v", f"$[0].{name}", kind)).otherwise(F.col("_wide")[name])


def accepted(decoded: DataFrame) -> DataFrame:
    return keep_where(decoded, F.col("reason").isNull()).drop("reason", "value")


def rejects(decoded: DataFrame) -> DataFrame:
    """The dead-letter table: ``value_sample, reason``."""
    refused = keep_where(decoded.select("value", "reason"), F.col("reason").isNotNull())
    return refused.select(sample(F.col("value")).alias("value_sample"), "reason")
