"""Messages of several schema versions in one topic.

Each frame names the schema it was written with.  ``registered`` joins frames
with the registry table on that id, and ``decode_registered`` decodes by version and
resolves every record to the reader's schema: fields that a version does not have
take the reader's defaults, fields that the reader does not have are skipped.  Frames
of an id that the registry does not know are told apart, not lost.  The registry is
read when the plan is made: at the start of a query, or with every batch inside
``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions import wire
from riskflow.operators import avro
from riskflow.sources.registry import writer_schemas

#: Registered versions that may be broadcast; beyond, the join shuffles.
MAX_VERSIONS = 10_000


def registered(frames: DataFrame, registry: DataFrame, subject: str, value_col: str = "value") -> DataFrame:
    """Frames with ``schema_id`` and ``version`` (null where the registry does not know the id)."""
    versions = registry.filter(F.col("subject") == subject).select(F.col("schema_id").cast("long").alias("_id"), "version")
    versions = versions.groupBy("_id").agg(F.max("version").alias("version"))
    if versions.count() <= MAX_VERSIONS:
        versions = F.broadcast(versions)
    ids = frames.withColumn("schema_id", wire.schema_id(F.col(value_col)))
    return ids.join(versions, F.col("schema_id") == F.col("_id"), "left").drop("_id")


def decode_registered(frames: DataFrame, registry: DataFrame, subject: str, reader_schema: str,
                      value_col: str = "value", mode: str = "PERMISSIVE") -> DataFrame:
    """The reader schema's fields of each frame with ``schema_id``, ``version``
    and ``raw`` (the frame itself where it gave no record, else null).

    Rows without a record: an unknown id (``version`` null) or a damaged body."""
    known = registered(frames, registry, subject, value_col)
    body = known.withColumns({"_body": wire.strip_header(F.col(value_col)), "_raw": F.col(value_col)})
    decoded = avro.decode(body, "_body", reader_schema, alias="_record", mode=mode,
                          writer_schemas=writer_schemas(registry, subject), id_col="schema_id",
                          keep=["schema_id", "version", "_raw"])
    required = next(f.name for f in avro.parse_schema(reader_schema) if f.null_branch is None)
    whole = F.col("_record").isNotNull() & F.col(f"_record.{required}").isNotNull()
    return decoded.select("schema_id", "version", F.when(~whole, F.col("_raw")).alias("raw"), "_record.*")


def rejected(decoded: DataFrame) -> DataFrame:
    """Frames without a record, with the reason."""
    reason = F.when(F.col("version").isNull(), "unknown schema id").otherwise("damaged body")
    return decoded.filter(F.col("raw").isNotNull()).select("schema_id", reason.alias("reason"), "raw")
