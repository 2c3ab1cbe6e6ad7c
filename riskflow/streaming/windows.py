"""The window flow with its late rows kept.

Spark drops a row's share in a (window, user) group when the window had ended
by the watermark of the batch before; it counts those groups but does not say
which rows they were.  ``start_windows`` runs the window aggregate and passes
the batch's own rows along in the same query, so one micro-batch holds both the
windows it emits and the rows it read.  Inside ``foreachBatch`` the rows are
judged by the very watermark that the aggregate used (``Ledger.late_watermark``),
and what it dropped goes to a table of late rows: nothing is lost, and
``repaired`` adds the late rows to the emitted windows again.

Outputs under ``out``: ``features`` and ``late`` (one part per batch) and
``ledger`` (written last; see there).  A restarted query replays an unfinished
batch over its own parts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow import schemas
from riskflow.config import DEFAULT, FraudConfig
from riskflow.functions.eventtime import to_event_time
from riskflow.operators import ingest, velocity
from riskflow.streaming.ledger import Ledger
from riskflow.streaming.pipeline import default_trigger
from riskflow.streaming.sinks import TableSink

#: Fields kept of a row, late or not.
ROW_FIELDS = ["transaction_id", "user_id", "amount", "timestamp"]

LATE = T.StructType([
    T.StructField("transaction_id", T.StringType()), T.StructField("user_id", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("window", schemas.WINDOW), T.StructField("batch_id", T.LongType())])

FEATURES = T.StructType([
    T.StructField("window", schemas.WINDOW), T.StructField("user_id", T.StringType()),
    T.StructField("window_amount", T.DoubleType()), T.StructField("window_count", T.LongType()),
    T.StructField("avg_amount", T.DoubleType()), T.StructField("max_amount", T.DoubleType()),
    T.StructField("velocity", T.DoubleType()), T.StructField("amount_count", T.LongType())])


def late_windows(rows: DataFrame, watermark, cfg: FraudConfig = DEFAULT) -> DataFrame:
    """(row, window) for every window of a row that had ended by ``watermark``
    (a timestamp, or None while there is no watermark)."""
    mark = F.lit(watermark).cast("timestamp")
    # A window ends after each of its rows, so only rows before the mark are expanded.
    early = rows.filter(F.col("timestamp") < mark)
    spread = early.select("*", F.window("timestamp", cfg.window_duration, cfg.slide_duration).alias("window"))
    return spread.filter(F.col("window.end") <= mark).withColumn(
        "window", F.struct(F.col("window.start").alias("start"), F.col("window.end").alias("end")))


def start_windows(source: DataFrame, out: str, checkpoint: str, cfg: FraudConfig = DEFAULT,
                  trigger: dict | None = None, name: str = "windows", decoded: bool = False,
                  state_partitions: int | None = None, on_step: Callable[[str, int], None] | None = None,
                  **decode_kw) -> StreamingQuery:
    """Start the window flow over raw messages (or transactions when ``decoded``).

    ``on_step(step, batch_id)`` is called after each output of a batch
    (``features``, ``late``, ``ledger``): monitoring, or a fault in a test.
    ``state_partitions`` is fixed by the checkpoint at the first start."""
    timed = to_event_time(source) if decoded else ingest.timed_transactions(source, columns=ROW_FIELDS, **decode_kw)
    timed = timed.select(*ROW_FIELDS)
    features = velocity.velocity_features(timed.withWatermark("timestamp", cfg.watermark_delay), cfg,
                                          extra=[F.count("amount").alias("amount_count")])
    window = F.struct(F.col("window.start").alias("start"), F.col("window.end").alias("end")).alias("window")
    features = features.select(window, *features.columns[1:])
    row = T.StructType([T.StructField(c, timed.schema[c].dataType) for c in ROW_FIELDS])
    both = (features.select(F.struct("*").alias("feature"), F.lit(None).cast(row).alias("row"))
            .unionByName(timed.select(F.lit(None).cast(features.schema).alias("feature"), F.struct("*").alias("row"))))
    ledger, step = Ledger(f"{out}/ledger"), on_step or (lambda step, batch_id: None)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if ledger.has(spark, batch_id):
            return          # whole already; the checkpoint did not get to note it
        part = ledger.part(batch_id)     # the same after a restart, whatever the query is called
        batch = batch.persist()
        try:
            TableSink(f"{out}/features").write_batch(batch.filter("feature IS NOT NULL").select("feature.*"), part)
            step("features", batch_id)
            rows = batch.filter("row IS NOT NULL").select("row.*")
            late = late_windows(rows, ledger.late_watermark(spark, batch_id, cfg.watermark_delay), cfg)
            late = late.withColumn("batch_id", F.lit(batch_id).cast("long"))
            TableSink(f"{out}/late").write_batch(late, part)
            step("late", batch_id)
            late = TableSink(f"{out}/late").read_part(spark, part, LATE)
            # Scalar subqueries: three small aggregates, one row.
            facts = rows.agg(F.count(F.lit(1)).alias("rows"), F.max("timestamp").alias("max_event_time"))
            facts = facts.select(
                "*", batch.filter("feature IS NOT NULL").agg(F.count(F.lit(1))).scalar().alias("emitted"),
                late.agg(F.count_distinct("transaction_id")).scalar().alias("late_rows"),
                late.groupBy("window", "user_id").agg(F.lit(1).alias("one")).agg(F.count("one")).scalar().alias("late_windows"))
            ledger.commit(spark, facts, batch_id)
            step("ledger", batch_id)
        finally:
            batch.unpersist()

    spark = source.sparkSession
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        return (both.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
                .trigger(**(trigger or default_trigger(cfg))).foreachBatch(write).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def emitted_windows(spark, out: str) -> DataFrame:
    """Features of whole batches."""
    return Ledger(f"{out}/ledger").committed(spark, f"{out}/features", FEATURES)


def late_rows(spark, out: str) -> DataFrame:
    """Late (row, window) pairs of whole batches."""
    return Ledger(f"{out}/ledger").committed(spark, f"{out}/late", LATE)


def repaired(features: DataFrame, late: DataFrame, cfg: FraudConfig = DEFAULT) -> DataFrame:
    """Emitted windows with their late rows added, windows of late rows alone
    included: the features that on-time rows would have given."""
    again = late.groupBy("window", "user_id").agg(
        F.sum("amount").alias("window_amount"), F.count(F.lit(1)).alias("window_count"),
        F.max("amount").alias("max_amount"), F.count("amount").alias("amount_count"))
    parts = features.select("window", "user_id", "window_amount", "window_count", "max_amount", "amount_count")
    total = parts.unionByName(again.select(*parts.columns)).groupBy("window", "user_id").agg(
        F.sum("window_amount").alias("window_amount"), F.sum("window_count").alias("window_count"),
        F.max("max_amount").alias("max_amount"), F.sum("amount_count").alias("amount_count"))
    return total.select(
        "window", "user_id", "window_amount", "window_count",
        F.try_divide("window_amount", "amount_count").alias("avg_amount"), "max_amount",
        (F.col("window_amount") / F.lit(cfg.window_minutes)).alias("velocity"))
