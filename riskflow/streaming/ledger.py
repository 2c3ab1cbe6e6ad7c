"""Commit manifest of a streaming query's file outputs.

A batch's outputs are written first, each to its own part; the ledger's entry
for the batch is written last.  Readers that go through ``committed`` take
only parts of batches with an entry, so a batch that was cut off half way is
never seen, and a batch that was whole before the query could note it in its
checkpoint is not written a second time (``has``).

An entry also keeps what later batches need to know of this one: its rows and
its greatest event time, from which ``late_watermark`` gives the watermark
that Spark judges late rows by.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.streaming.sinks import TableSink

ENTRY = ("batch_id long, rows long, max_event_time timestamp, emitted long, late_rows long, late_windows long")


@dataclass
class Ledger:
    """One row per whole batch under ``path``."""
    path: str

    def part(self, batch_id: int) -> str:
        return f"batch-{batch_id:012d}"

    def commit(self, spark: SparkSession, entry: DataFrame, batch_id: int) -> None:
        """``entry``: one row of ``ENTRY`` columns but the id, a small aggregate."""
        row = entry.select(F.lit(batch_id).cast("long").alias("batch_id"), *[c for c in entry.columns])
        TableSink(self.path).write_batch(row.coalesce(1), self.part(batch_id))

    def read(self, spark: SparkSession) -> DataFrame:
        """Entries so far (none before the first batch)."""
        if self.missing(spark, self.path):
            return spark.createDataFrame([], ENTRY)
        return TableSink(self.path).read(spark, schema=ENTRY)

    def has(self, spark: SparkSession, batch_id: int) -> bool:
        return not self.read(spark).filter(F.col("batch_id") == batch_id).isEmpty()

    def late_watermark(self, spark: SparkSession, batch_id: int, delay: str):
        """The watermark below which batch ``batch_id`` drops rows: the
        greatest event time of all batches before the previous one, less the
        delay (rows of the previous batch move it one batch later).  None
        until there is one."""
        before = self.read(spark).filter(F.col("batch_id") <= batch_id - 2)
        return before.agg((F.max("max_event_time") - F.expr(f"INTERVAL {delay}")).alias("w")).first()["w"]

    def committed(self, spark: SparkSession, table: str, schema=None) -> DataFrame:
        """Rows of a ``TableSink`` folder whose batch has an entry.  The batch
        id is the number at the end of the part's name."""
        rows = TableSink(table).read(spark, schema)
        columns = rows.columns
        part = F.regexp_extract(F.col("_metadata.file_path"), r"-(\d+)/[^/]*$", 1).cast("long")
        whole = self.read(spark).select(F.col("batch_id").alias("_whole"))
        return rows.withColumn("_batch", part).join(whole, F.col("_batch") == F.col("_whole"), "left_semi").select(*columns)

    @staticmethod
    def missing(spark: SparkSession, path: str) -> bool:
        """Whether a folder is not there or holds no file, asked of its file system through a listing."""
        from pyspark.errors import AnalysisException
        try:
            return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").isEmpty()
        except AnalysisException:
            return True
