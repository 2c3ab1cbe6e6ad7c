"""Flag records <-> keyed JSON topic messages.

``to_payload``: key = user_id, value = ``to_json(struct(*))`` of every column
(nulls left out, ``window`` nested as ``{"start","end"}``).
``flagged_topic``: both flag flows in one topic (union by name).
``parse_flags``: JSON text back to the superset flag schema; undecodable or
non-object messages are kept apart (``_corrupt_record``) instead of lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas

SHAPE_TRANSACTION = "transaction"
SHAPE_WINDOW = "window"


def to_payload(flags: DataFrame) -> DataFrame:
    return flags.select(F.col("user_id").cast("string").alias("key"),
                        F.to_json(F.struct("*")).alias("value"))


def flagged_topic(*payloads: DataFrame) -> DataFrame:
    """Union of ``(key, value)`` payload frames; no shuffle, no dedup."""
    out = payloads[0]
    for p in payloads[1:]:
        out = out.unionByName(p)
    return out


def record_key(value: Column, user_id: Column) -> Column:
    """Output key of an explained record: the user id as text; ``''`` when
    the object has no ``user_id`` field and ``'None'`` when it is JSON null
    (how the reference's consumer renders them)."""
    has_field = F.array_contains(F.json_object_keys(value), "user_id")
    return (F.when(user_id.isNotNull(), user_id)
            .when(F.coalesce(has_field, F.lit(False)), F.lit("None"))
            .otherwise(F.lit("")))


def parse_flags_variant(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """``parse_flags`` by one parse into VARIANT, which stays in the column
    ``record``: fields outside the flag schema, and those of another type than
    the schema's (null in their column), are kept there as they came."""
    keep = keep or []
    text = F.col(value_col).cast("string")
    key = F.col("key").cast("string") if "key" in messages.columns else F.lit(None).cast("string")
    record = F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text))
    df = messages.select(text.alias("_value"), key.alias("message_key"), record.alias("_record"), *keep)
    v = F.col("_record")

    def field(name: str, kind: T.DataType) -> Column:
        if isinstance(kind, T.StructType):
            inner = F.struct(*[F.try_variant_get(v, f"$.{name}.{f.name}", f.dataType.simpleString()).alias(f.name)
                               for f in kind.fields])
            whole = F.try_variant_get(v, f"$.{name}", "variant")
            return F.when(whole.isNotNull() & ~F.is_variant_null(whole), inner).alias(name)
        return F.try_variant_get(v, f"$.{name}", kind.simpleString()).alias(name)

    cols = [field(f.name, f.dataType) for f in schemas.FLAG_SUPERSET.fields]
    user = F.try_variant_get(v, "$.user_id", "variant")
    corrupt = F.when(v.isNull(), F.coalesce("_value", F.lit("")))
    flags = df.select(*cols, user.alias("_user"), "message_key", corrupt.alias(schemas.CORRUPT_COLUMN),
                      F.col("_value").alias("raw_value"), F.col("_record").alias("record"), *keep)
    is_flag = F.col(schemas.CORRUPT_COLUMN).isNull()
    named = (F.when(F.col("user_id").isNotNull(), F.col("user_id"))
             .when(F.col("_user").isNotNull(), F.lit("None")).otherwise(F.lit("")))
    return flags.select(
        *[f.name for f in schemas.FLAG_SUPERSET.fields],
        F.when(is_flag, F.when(F.col("window").isNotNull(), F.lit(SHAPE_WINDOW)).otherwise(F.lit(SHAPE_TRANSACTION))).alias("shape"),
        named.alias("record_key"), "message_key", schemas.CORRUPT_COLUMN, "raw_value", "record", *keep)


def shape(flag: Column) -> Column:
    """Which of the two flag shapes a parsed record has."""
    return F.when(flag["window"].isNotNull(), F.lit(SHAPE_WINDOW)).otherwise(F.lit(SHAPE_TRANSACTION))


def parse_flags(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """``(key, value)`` messages -> superset flag columns + ``shape``,
    ``record_key``, ``message_key`` and ``_corrupt_record`` (non-null =
    undecodable, e.g. ``{"a":``, not a JSON object, e.g. ``[1]``, or a null
    message, which is marked with an empty string).  A field of another type
    than the schema's becomes null; the object is still a flag.  ``keep``:
    further columns of the messages to carry along."""
    text = F.col(value_col).cast("string")
    parsed = F.from_json(text, schemas.FLAG_SUPERSET, {"mode": "PERMISSIVE"})
    key = F.col("key").cast("string") if "key" in messages.columns else F.lit(None).cast("string")
    keep = keep or []
    df = messages.select(text.alias("_value"), key.alias("message_key"), parsed.alias("_flag"), *keep)
    is_object = F.trim(F.col("_value")).startswith("{") & F.try_parse_json(F.col("_value")).isNotNull()
    corrupt = F.when(~F.coalesce(is_object, F.lit(False)), F.coalesce("_value", F.lit("")))
    cols = [F.col("_flag")[f.name].alias(f.name) for f in schemas.FLAG_SUPERSET.fields]
    return df.select(
        *cols,
        F.when(corrupt.isNull(), shape(F.col("_flag"))).alias("shape"),
        record_key(F.col("_value"), F.col("_flag")["user_id"]).alias("record_key"),
        "message_key",
        corrupt.alias(schemas.CORRUPT_COLUMN),
        F.col("_value").alias("raw_value"),
        *keep,
    )
