"""Sinks (K3, K5): keyed topic, parquet table, console, memory.

Every sink can take one micro-batch (``write_batch(df, part)``), so one
streaming query can fan out to several outputs inside ``foreachBatch``, and
can also run as its own streaming query (``start``).  File outputs go to a
sub-folder named by query and batch id with overwrite: a batch replayed
after a failure replaces its own output, so a reader of the folder as a table
sees each batch once (a streaming reader may already have taken the first
attempt's files: at-least-once, like the Kafka sink).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskflow.sources.topic import FileTopic, KafkaTopic


def _writer(df: DataFrame, name: str, checkpoint: str | None, trigger: dict | None,
            output_mode: str = "append"):
    w = df.writeStream.queryName(name).outputMode(output_mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w


class _BatchSink:
    def write_batch(self, df: DataFrame, part: str) -> None:  # pragma: no cover - interface
        raise NotImplementedError

    def start(self, df: DataFrame, name: str, checkpoint: str | None, trigger: dict | None,
              output_mode: str = "append") -> StreamingQuery:
        def write(batch: DataFrame, batch_id: int) -> None:
            self.write_batch(batch, f"{name}-{batch_id:012d}")
        return _writer(df, name, checkpoint, trigger, output_mode).foreachBatch(write).start()


@dataclass
class TopicSink(_BatchSink):
    """Keyed ``(key, value)`` messages to a Kafka or file-backed topic."""
    topic: FileTopic | KafkaTopic

    kind = "kafka"

    def write_batch(self, df: DataFrame, part: str) -> None:
        self.topic.write_batch(df, part)

    def start(self, df, name, checkpoint, trigger, output_mode="append"):
        if isinstance(self.topic, KafkaTopic):
            return (_writer(df, name, checkpoint, trigger, output_mode).format("kafka")
                    .options(**self.topic.write_options()).start())
        return super().start(df, name, checkpoint, trigger, output_mode)


@dataclass
class TableSink(_BatchSink):
    """Rows as parquet under ``path/<query>-<batch id>/``."""
    path: str

    kind = "table"

    def write_batch(self, df: DataFrame, part: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.path.rstrip('/')}/{part}")

    def read(self, spark: SparkSession, schema=None) -> DataFrame:
        """All batches written so far.  Give ``schema`` when every batch may
        have been empty (nothing to infer it from)."""
        return self.read_part(spark, "*", schema)

    def read_part(self, spark: SparkSession, part: str, schema=None) -> DataFrame:
        """One batch's rows."""
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(f"{self.path.rstrip('/')}/{part}")


@dataclass
class ConsoleSink(_BatchSink):
    """Development output: ``num_rows`` rows per batch, not truncated."""
    num_rows: int = 20
    truncate: bool = False

    kind = "console"

    def write_batch(self, df: DataFrame, part: str) -> None:
        print(f"-------- {part} --------")
        df.show(self.num_rows, truncate=self.truncate)


@dataclass
class MemorySink:
    """In-driver table named like the query (tests and notebooks only)."""

    kind = "memory"

    def start(self, df: DataFrame, name: str, checkpoint: str | None, trigger: dict | None,
              output_mode: str = "append") -> StreamingQuery:
        return _writer(df, name, checkpoint, trigger, output_mode).format("memory").start()
