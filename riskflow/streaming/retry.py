"""The explainer with retries in later batches instead of sleeping tasks.

A call that fails with a retryable error does not hold its task: the flag goes
to a retry topic with the number of the next attempt and the time before which
it should not be tried.  The same query reads the retry topic back through a
keyed delay queue (``transformWithState`` with processing-time timers): a flag
that is due passes on, one that is not waits in state until its timer fires in
a later batch.  First attempts never enter state, and every attempt is made
with the bounded concurrency of ``explain_flags``.

    flagged topic ────────────────┐
                                  ├─> explain once ─> explained topic
    retry topic ─> delay queue ───┘        │       └> dead letters
         ^─────────────────────────────────┘  (retryable, attempts left)

Outputs are written per batch id with overwrite, so a replayed batch replaces
its own; a flag is offered at least once for each attempt.  State holds the
waiting flags only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskflow import schemas
from riskflow.config import DEFAULT, FraudConfig
from riskflow.operators import explain, payload
from riskflow.sources.topic import FileTopic, KafkaTopic, produce
from riskflow.streaming.pipeline import ROCKSDB_PROVIDER

#: A flag waiting for its next attempt, as the retry topic's JSON.  Flags of one ``slot`` wait together.
WAITING = T.StructType([
    T.StructField("offer_id", T.StringType()), T.StructField("message_key", T.StringType()),
    T.StructField("message", T.StringType()), T.StructField("attempt", T.IntegerType()),
    T.StructField("not_before_ms", T.LongType()), T.StructField("slot", T.StringType())])
#: Flags of a slot at most: a slot's calls to the state store and its timer are shared by them.
SLOT_FLAGS = 1000


class DelayQueue(StatefulProcessor):
    """Hands rows of a slot on at their time: at once if that has come, else by a timer for each time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        for some in rows:
            due = some["not_before_ms"] <= now
            if due.any():
                yield some[due]
            held = some[~due]
            if len(held):
                self.waiting.appendList([tuple(row) for row in held.itertuples(index=False)])
            for at in held["not_before_ms"].unique():
                self.handle.registerTimer(int(at))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held = list(self.waiting.get())
        self.waiting.clear()
        later = [tuple(r) for r in held if r[4] > now]
        if later:                           # their own timers are still to come
            self.waiting.appendList(later)
        due = [r for r in held if r[4] <= now]
        if due:
            yield pd.DataFrame([tuple(r) for r in due], columns=[f.name for f in WAITING.fields])

    def close(self) -> None:
        pass


def delayed(messages: DataFrame) -> DataFrame:
    """Messages of the retry topic, each from its time on.  One without a slot waits alone."""
    waiting = messages.select(F.from_json(F.col("value").cast("string"), WAITING).alias("w")).select("w.*")
    waiting = waiting.withColumn("slot", F.coalesce("slot", "offer_id"))
    return waiting.groupBy("slot").transformWithStateInPandas(DelayQueue(), WAITING, "Append", "ProcessingTime")


def start_retrying_explainer(flag_stream: DataFrame, retry_topic: FileTopic | KafkaTopic, explained_sink, dlq_sink,
                             checkpoint: str, explainer: Callable, cfg: FraudConfig = DEFAULT,
                             trigger: dict | None = None, retryable: tuple = (explain.RetryableError,),
                             name: str = "retrying-explainer", pass_attempt: bool = False,
                             max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the explainer over ``flag_stream`` (``key``, ``value``).

    Records on the sinks carry ``attempts``, one batch each.  The wait before
    attempt n + 1 is ``explain.backoff_wait(n, ...)`` of ``cfg``."""
    spark = flag_stream.sparkSession
    if isinstance(retry_topic, FileTopic):
        # The topic exists before it is read.
        produce(spark.createDataFrame([], "key string, value string"), retry_topic, part="batch-created")
        again = retry_topic.read_stream(spark, max_files_per_trigger=max_files_per_trigger)
    else:
        again = retry_topic.read_stream(spark)
    first = flag_stream.select(F.col("key").cast("string").alias("message_key"), F.col("value").cast("string").alias("message"),
                               F.lit(1).alias("attempt"))
    offers = first.unionByName(delayed(again).select("message_key", "message", "attempt"))
    waits = F.array(*[F.lit(int(1000 * explain.backoff_wait(n, cfg.explain_wait_min, cfg.explain_wait_max)))
                      for n in range(1, cfg.explain_attempts + 1)])

    def run(batch: DataFrame, batch_id: int) -> None:
        part = f"{name}-{batch_id:012d}"
        messages = batch.select(F.col("message_key").alias("key"), F.col("message").alias("value"), "attempt")
        parsed = payload.parse_flags(messages, keep=["attempt"]).persist()
        good = parsed.filter(F.col(schemas.CORRUPT_COLUMN).isNull())
        results = explain.explain_flags(good, explainer, cfg, retryable=retryable, pass_attempt=pass_attempt,
                                        attempt="attempt").persist()       # one call per flag, three outputs
        try:
            again = F.col("status") == explain.STATUS_RETRY
            waiting = results.filter(again).select(
                F.sha2("raw_value", 256).alias("offer_id"), F.col("record_key").alias("message_key"),
                F.col("raw_value").alias("message"), (F.col("attempts") + 1).alias("attempt"),
                (F.unix_millis(F.current_timestamp()) + F.get(waits, F.col("attempts") - 1)).alias("not_before_ms"),
                # runs of a task's rows; the batch's id keeps slots of different batches apart
                F.concat(F.lit(f"{batch_id}-"), F.expr(f"monotonically_increasing_id() div {SLOT_FLAGS}")).alias("slot"))
            retry_topic.write_batch(waiting.select(F.col("message_key").alias("key"), F.to_json(F.struct("*")).alias("value")), part)
            done = results.filter(~again)
            explained_sink.write_batch(explain.to_output_payload(explain.explained(done), ("attempts",)), part)
            bad = explain.undecodable_dead_letters(parsed)
            bad = bad.select(F.col("record_key").alias("key"), F.to_json(F.struct(
                "status", "error", "attempts", "message_key", "raw_value")).alias("value"))
            dead = explain.to_output_payload(explain.dead_letters(done), ("attempts",))
            dlq_sink.write_batch(dead.unionByName(bad), part)
        finally:
            results.unpersist()
            parsed.unpersist()

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    try:
        return (offers.writeStream.queryName(name).outputMode("append").option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "2 seconds"})).foreachBatch(run).start())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
