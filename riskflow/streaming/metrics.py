"""Progress and observed metrics of streaming queries as a table.

``BatchMetrics`` is a ``StreamingQueryListener``: for every finished batch of the
queries it watches it appends one row per metric, the progress report's own
(input rows, rows dropped by the watermark, state rows) and those that the plan
observes (``observed``).  Progress events come after their batch; ``drain`` waits
for those of batches that have ended.
"""

from __future__ import annotations

import json
import threading
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

ROW = "query string, batch_id long, metric string, value double"


def observed(df: DataFrame, name: str, **metrics: Column) -> DataFrame:
    """``df`` with named aggregates that each batch reports (``DataFrame.observe``)."""
    return df.observe(name, *[c.alias(n) for n, c in metrics.items()])


class BatchMetrics(StreamingQueryListener):
    """Rows of ``ROW`` for the watched queries, written under ``path`` by ``flush``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.names: dict[str, str] = {}
        self.rows: list[tuple] = []
        self.last: dict[str, int] = {}
        self.lock = threading.Lock()
        self.flushed = 0
        spark.streams.addListener(self)

    def watch(self, name: str, query: StreamingQuery) -> None:
        """Take the reports of ``query`` under ``name``, from its first batch if called before it ends."""
        self.names[str(query.runId)] = name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = [("input_rows", float(p.numInputRows))]
        for operator in p.stateOperators:
            found += [("state_rows", float(operator.numRowsTotal)),
                      ("dropped_by_watermark", float(operator.numRowsDroppedByWatermark))]
        for name, row in (p.observedMetrics or {}).items():
            found += [(f"{name}.{metric}", float(value)) for metric, value in row.asDict().items() if value is not None]
        with self.lock:
            self.last[str(p.runId)] = p.batchId
            self.rows += [(str(p.runId), p.batchId, metric, value) for metric, value in found]

    def drain(self, queries: list[StreamingQuery], timeout: float = 60) -> None:
        """Wait for the reports of every batch the queries have finished."""
        until = time.monotonic() + timeout
        for query in queries:
            report = query.lastProgress
            want = -1 if report is None else int(report["batchId"] if isinstance(report, dict) else json.loads(report.json)["batchId"])
            while self.last.get(str(query.runId), -1) < want:
                if time.monotonic() > until:
                    raise TimeoutError(f"no report of batch {want}")
                time.sleep(0.05)

    def flush(self) -> None:
        """Append the rows taken so far; a long-lived application calls it now and then."""
        with self.lock:
            some = [(self.names[run], batch, metric, value) for run, batch, metric, value in self.rows if run in self.names]
            self.rows = [r for r in self.rows if r[0] not in self.names]
        if some:
            self.spark.createDataFrame(some, ROW).coalesce(1).write.mode("append").parquet(self.path)
            self.flushed += len(some)

    def close(self) -> None:
        self.flush()
        self.spark.streams.removeListener(self)

    def read(self) -> DataFrame:
        """The rows; a batch that was replayed after a restart counts once, by its last report."""
        rows = self.spark.read.schema(ROW).parquet(self.path) if self.flushed else self.spark.createDataFrame([], ROW)
        return rows.groupBy("query", "batch_id", "metric").agg(F.last("value").alias("value"))
