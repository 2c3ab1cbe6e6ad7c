"""The explanation job as a Structured Streaming query.

``flagged topic -> foreachBatch(parse -> explain -> split) -> explained
topic / dead-letter topic``.  The checkpoint advances only after
``foreachBatch`` returns, so every message is processed at least once
(the reference commits consumer offsets after flushing, with the same
guarantee); file outputs are keyed by batch id and overwritten on replay.
Messages that are not JSON objects (or are null) become dead letters
instead of being lost or stopping the consumer.  The number of messages per
batch is published with ``observe`` and appears in the query's progress;
``explain.summary`` gives counts per status.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.config import DEFAULT, FraudConfig
from riskflow.operators import explain, payload


def explain_batch(messages: DataFrame, explainer: Callable | None, cfg: FraudConfig = DEFAULT,
                  retryable: tuple = (explain.RetryableError,), sleep=None,
                  max_tasks: int | None = None, pass_attempt: bool = False) -> tuple[DataFrame, DataFrame]:
    """(results with a status per flag, undecodable dead letters) for one
    batch of flagged-topic messages.  Persist ``results`` before reading it
    twice: each flag must reach the explainer once."""
    return explain_parsed(payload.parse_flags(messages), explainer, cfg, retryable, sleep, max_tasks, pass_attempt)


def explain_parsed(parsed: DataFrame, explainer: Callable | None, cfg: FraudConfig = DEFAULT,
                   retryable: tuple = (explain.RetryableError,), sleep=None,
                   max_tasks: int | None = None, pass_attempt: bool = False) -> tuple[DataFrame, DataFrame]:
    """``explain_batch`` of messages that ``parse_flags`` has parsed.  Both
    results read ``parsed``: persist it, and each message is parsed once."""
    good = parsed.filter(F.col("_corrupt_record").isNull())
    # max_tasks: exactly that many balanced tasks call the service
    results = explain.explain_flags(good, explainer, cfg, retryable=retryable, sleep=sleep,
                                    partitions=max_tasks, pass_attempt=pass_attempt)
    return results, explain.undecodable_dead_letters(parsed)


def start_explainer(flag_stream: DataFrame, explained_sink, dlq_sink, checkpoint: str,
                    explainer: Callable | None = None, cfg: FraudConfig = DEFAULT,
                    trigger: dict | None = None, retryable: tuple = (explain.RetryableError,),
                    sleep=None, max_tasks: int | None = None,
                    name: str = "flag-explainer", pass_attempt: bool = False) -> StreamingQuery:
    """Start the explainer query over ``flag_stream`` (``key``, ``value``).

    Bound the batch on the source (the topics' ``read_stream``); ``max_tasks`` bounds how many tasks call the
    explainer at once, each with ``cfg.explain_batch_size`` threads.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = payload.parse_flags(batch).persist()
        try:
            results, undecodable = explain_parsed(parsed, explainer, cfg, retryable, sleep, max_tasks, pass_attempt)
            results = results.persist()      # one explainer call per flag, two outputs
            try:
                part = f"{name}-{batch_id:012d}"
                explained_sink.write_batch(explain.to_output_payload(explain.explained(results)), part)
                dead = explain.to_output_payload(explain.dead_letters(results))
                bad = undecodable.select(F.col("record_key").alias("key"),
                                         F.to_json(F.struct("status", "error", "message_key", "raw_value")).alias("value"))
                dlq_sink.write_batch(dead.unionByName(bad), part)
            finally:
                results.unpersist()
        finally:
            parsed.unpersist()

    counted = flag_stream.observe(
        "explain_input", F.count(F.lit(1)).alias("messages"))
    w = (counted.writeStream.queryName(name)
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"processingTime": "2 seconds"})))
    return w.foreachBatch(run).start()
