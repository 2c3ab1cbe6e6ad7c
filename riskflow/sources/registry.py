"""Schema lookup by subject (S3).

The reference asks a registry service once at start-up for the latest
version of its value subject and decodes every message with it.  Here the
registry is a table of ``(subject, version, schema_id, schema)`` rows — a
DataFrame read from wherever the deployment keeps it (JSON lines, parquet,
a catalog table).  Lookups are one small aggregate (``max_by``), and the
result is the schema string handed to ``decode``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType([
    T.StructField("subject", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("schema_id", T.IntegerType(), False),
    T.StructField("schema", T.StringType(), False),
])


def read_registry(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).format(fmt).load(path)


def latest_versions(registry: DataFrame) -> DataFrame:
    """One row per subject: latest version, its id and schema."""
    return (registry.groupBy("subject")
            .agg(F.max("version").alias("version"),
                 F.max_by("schema_id", "version").alias("schema_id"),
                 F.max_by("schema", "version").alias("schema")))


def latest_schema(registry: DataFrame, subject: str) -> tuple[int, str]:
    """(schema id, schema JSON) of the latest version of ``subject``.

    Returns one row of metadata to the driver, as a registry client would.
    """
    rows = latest_versions(registry.filter(F.col("subject") == subject)).take(1)
    if not rows:
        raise KeyError(f"subject {subject!r} not found")
    return int(rows[0]["schema_id"]), rows[0]["schema"]


def writer_schemas(registry: DataFrame, subject: str) -> dict[int, str]:
    """All schema ids of ``subject`` -> schema JSON (for per-message decode).

    Bounded by the number of registered versions, not by data size.
    """
    rows = registry.filter(F.col("subject") == subject).select("schema_id", "schema").collect()
    return {int(r["schema_id"]): r["schema"] for r in rows}
