"""Windows that are still open, read from a query's state store.

Append mode tells a window only when it has ended.  What has been counted so
far stands in the state of the window query's checkpoint; Spark's state data
source reads it as a table, one task per state partition, without touching the
query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.config import DEFAULT, FraudConfig
from riskflow.schemas import FEATURE_COLUMNS

# The aggregation buffers of the features in their order; the source names
# them after the functions, so names repeat and the cast goes by position.
_BUFFERS = [("amount", T.DoubleType()), ("count", T.LongType()), ("avg_sum", T.DoubleType()),
            ("avg_count", T.LongType()), ("max", T.DoubleType())]


def open_windows(spark: SparkSession, checkpoint: str, cfg: FraudConfig = DEFAULT,
                 batch_id: int | None = None) -> DataFrame:
    """Velocity features of the (window, user) groups in the state that
    ``checkpoint``'s window query had after its last batch, or after
    ``batch_id`` while the state store still keeps that version."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    kept = state.schema["value"].dataType.fields
    if [f.dataType for f in kept[:len(_BUFFERS)]] != [t for _, t in _BUFFERS]:
        raise ValueError(f"{checkpoint}: not the state of a window query")
    named = T.StructType([T.StructField(n, t) for n, t in _BUFFERS]
                         + [T.StructField(f"more_{i}", f.dataType) for i, f in enumerate(kept[len(_BUFFERS):])])
    v = F.col("v")
    rows = state.select("key.window", "key.user_id", F.col("value").cast(named).alias("v"))
    return rows.select(
        "window", "user_id", v["amount"].alias("window_amount"), v["count"].alias("window_count"),
        F.try_divide(v["avg_sum"], v["avg_count"]).alias("avg_amount"), v["max"].alias("max_amount"),
        (v["amount"] / F.lit(cfg.window_minutes)).alias("velocity")).select(*FEATURE_COLUMNS)
