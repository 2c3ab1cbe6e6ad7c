"""Transactions derived from the ``events`` table (batch or stream).

The driver's ``events`` table is a 30-day click stream.  Squeezing time by
1000x (one real second becomes one millisecond, 30 days become 43 minutes)
puts several events of a user into every 2-minute window, and scaling values
by 25 reaches every rule branch.  Amounts end up multiples of 0.25, so sums
are exact doubles in any order and match any other engine bit for bit.

Everything is a column expression: the adapter is a projection, it keeps the
scan's column pruning and filter pushdown, and works on a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the fixture mapping (shared with the DuckDB oracle SQL).
EPOCH_MS = 1704067200000                      # 2024-01-01T00:00:00Z
AMOUNT_SCALE = 25
CURRENCIES = ["USD", "EUR", "MXN", "GBP"]
CATEGORIES = ["electronics", "groceries", "travel", "entertainment", None]
COUNTRIES = ["US", "MX", "GB", "DE", "CN", "RU"]
DEVICE_TYPES = ["mobile", "desktop", "tablet"]
MERCHANTS = ["Northwind", "Contoso", "Globex", "Initech", "Umbrella", "Hooli", "Vandelay"]

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def _pick(values: list, key: Column) -> Column:
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def transaction_columns() -> list[Column]:
    """Projection ``events`` -> transaction (schema ``schemas.TRANSACTION``)."""
    eid = F.col("event_id")
    ms = F.lit(EPOCH_MS) + F.expr(
        "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts) div 1000000")
    return [
        eid.cast("string").alias("transaction_id"),
        # at least 4 digits, never truncated (lpad would cut ids >= 10000)
        F.when(F.col("user_id").isNotNull(),
               F.concat(F.lit("user-"), F.format_string("%04d", F.col("user_id")))).alias("user_id"),
        F.round(F.col("value") * AMOUNT_SCALE, 2).alias("amount"),
        _pick(CURRENCIES, eid).alias("currency"),
        _pick(MERCHANTS, eid).alias("merchant"),
        _pick(CATEGORIES, eid).alias("category"),
        ms.cast("long").alias("timestamp"),
        _pick(COUNTRIES, eid).alias("country"),
        _pick(DEVICE_TYPES, eid).alias("device_type"),
        (F.col("event_type") == "error").alias("is_fraud"),
    ]


def events_to_transactions(events: DataFrame) -> DataFrame:
    return events.select(*transaction_columns())


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(*EVENT_COLUMNS)


def read_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch scan of transactions (epoch-ms ``timestamp``) from ``events``."""
    return events_to_transactions(read_events(spark, sf_dir))


def stream_events(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` as a streaming file source (new files in ``sf_dir`` named
    ``events*.parquet`` become new micro-batches)."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(sf_dir).select(*EVENT_COLUMNS)


def stream_transactions(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return events_to_transactions(stream_events(spark, sf_dir, **kw))
