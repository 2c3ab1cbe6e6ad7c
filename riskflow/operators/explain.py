"""Explained records and dead letters from parsed flags.

A user-supplied ``explainer(record: dict, prompt: str) -> str`` (for example a
call to a hosted model) runs inside ``mapInPandas``: each task handles its
Arrow batches with a small thread pool (the reference's 10 concurrent calls
per batch), and each call is retried with exponential backoff only for the
error types the caller marks as retryable.  Without an explainer a fixed
template is built JVM-side and every flag succeeds.

Side effects: Spark may run a task twice (retry, speculation), so an external
call can be made more than once — at-least-once, like the reference's
consumer.  Sinks keyed by batch id keep the *output* repeatable.
"""

from __future__ import annotations

import itertools
import json
import threading
import time
from typing import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas
from riskflow.config import DEFAULT, FraudConfig

STATUS_OK = "SUCCESS"
STATUS_FAILED = "FAILED"
#: One attempt failed and another may be made later (``explain_flags`` with ``attempt``).
STATUS_RETRY = "RETRY"

#: Default prompt around each flag record; ``explain_flags`` takes another.
PROMPT_HEAD = ("The rules of a payment monitor have marked the record below; 'fraud_reason' names the rule. "
               "In two sentences, tell a reviewer which of its values point to fraud and why.\n\nRecord: ")
PROMPT_TAIL = "\n\nReview note:"

RECORD_COLUMNS = [f.name for f in schemas.FLAG_SUPERSET.fields]

EXPLAINED_SCHEMA = T.StructType(
    schemas.FLAG_SUPERSET.fields
    + [T.StructField("shape", T.StringType(), True),
       T.StructField("record_key", T.StringType(), True),
       T.StructField("raw_value", T.StringType(), True),
       T.StructField("status", T.StringType(), False),
       T.StructField("llm_explanation", T.StringType(), True),
       T.StructField("error", T.StringType(), True),
       T.StructField("attempts", T.IntegerType(), False)]
)


class RetryableError(Exception):
    """Raise (or subclass) from an explainer for errors worth retrying."""


def backoff_wait(attempt: int, wait_min: float, wait_max: float, multiplier: float = 1.0) -> float:
    """Seconds to wait after failed attempt ``attempt`` (1-based):
    ``multiplier * 2**(attempt-1)`` clamped to ``[wait_min, wait_max]``."""
    return max(wait_min, min(multiplier * 2 ** (attempt - 1), wait_max))


def attempt_with_retry(fn: Callable[[int], str], attempts: int, retryable: tuple,
                       wait_min: float, wait_max: float,
                       sleep: Callable[[float], None] = time.sleep):
    """Run ``fn(attempt)`` up to ``attempts`` times -> (result, error, attempts used).

    Only ``retryable`` errors are retried, with ``backoff_wait`` between
    tries; any other error ends at once."""
    for attempt in range(1, attempts + 1):
        try:
            return fn(attempt), None, attempt
        except retryable as e:
            if attempt == attempts:
                return None, e, attempt
            sleep(backoff_wait(attempt, wait_min, wait_max))
        except Exception as e:  # noqa: BLE001 - non-retryable: fail now
            return None, e, attempt
    raise ValueError("attempts must be >= 1")


def prompt_column(raw: "F.Column | None" = None, head: str = PROMPT_HEAD, tail: str = PROMPT_TAIL) -> "F.Column":
    """Prompt text per flag: head + the record as JSON + tail.  ``raw`` is
    the message text as received (no second serialization); without it the
    record's non-null fields are rendered with ``to_json``."""
    record = raw if raw is not None else F.to_json(F.struct(*[F.col(c) for c in RECORD_COLUMNS]))
    return F.concat(F.lit(head), record, F.lit(tail))


def template_explanation() -> "F.Column":
    """Default explanation, built without leaving the JVM."""
    subject = F.when(F.col("shape") == "window",
                     F.concat(F.lit("user "), F.col("user_id"), F.lit(" in a sliding window")))
    subject = subject.otherwise(F.concat(F.lit("transaction "), F.col("transaction_id")))
    return F.concat(F.lit("Flagged "), subject, F.lit(" as "), F.col("fraud_reason"),
                    F.lit(" with rule score "), F.col("rule_score").cast("string"), F.lit("."))


def explain_flags(flags: DataFrame, explainer: Callable[[dict, str], str] | None = None,
                  cfg: FraudConfig = DEFAULT, retryable: tuple = (RetryableError,),
                  sleep: Callable[[float], None] | None = None,
                  concurrency: int | None = None, partitions: int | None = None,
                  pass_attempt: bool = False, prompt_head: str = PROMPT_HEAD,
                  prompt_tail: str = PROMPT_TAIL, attempt: str | None = None) -> DataFrame:
    """Parsed flags (``parse_flags`` output without corrupt rows) ->
    ``EXPLAINED_SCHEMA`` rows with ``status`` SUCCESS or FAILED.

    With ``raw_value`` the explainer gets the message's whole object, fields
    outside the flag schema included; without it the schema's fields.
    ``pass_attempt``: the explainer takes the attempt number as well.

    ``attempt``: a column with the number of each flag's attempt.  Then only
    this one is made, without waiting; a retryable error gives ``STATUS_RETRY``
    while attempts are left, for the caller to offer the flag again.

    ``partitions``: spread the flags evenly (round robin, stable on retry)
    over that many tasks before calling the explainer.  Each call may take a
    network round trip, so balance matters more than the small shuffle of the
    flags; it also bounds the tasks calling the service at once.
    """
    has_raw = "raw_value" in flags.columns
    base = flags.select(*RECORD_COLUMNS, "shape", "record_key",
                        (F.col("raw_value") if has_raw else F.lit(None).cast("string")).alias("raw_value"),
                        *([F.col(attempt).cast("int").alias("_attempt")] if attempt and explainer else []))
    if explainer is None:
        return base.select("*", F.lit(STATUS_OK).alias("status"),
                           template_explanation().alias("llm_explanation"),
                           F.lit(None).cast("string").alias("error"),
                           F.lit(1).alias("attempts"))

    if partitions:
        base = base.repartition(partitions)
    attempts = cfg.explain_attempts
    wait_min, wait_max = cfg.explain_wait_min, cfg.explain_wait_max
    workers = concurrency or cfg.explain_batch_size
    do_sleep = sleep or time.sleep
    out_names = [f.name for f in EXPLAINED_SCHEMA.fields]

    pass_names = RECORD_COLUMNS + ["shape", "record_key", "raw_value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(record: dict, asked: tuple):
            prompt, number = asked

            def call(attempt: int):
                return explainer(record, prompt, attempt) if pass_attempt else explainer(record, prompt)
            if number is not None:
                text, error, _ = attempt_with_retry(lambda _: call(number), 1, (), 0, 0)
                used = number
                if isinstance(error, tuple(retryable)) and number < attempts:
                    return STATUS_RETRY, None, str(error) or type(error).__name__, number
            else:
                text, error, used = attempt_with_retry(call, attempts, tuple(retryable), wait_min, wait_max, do_sleep)
            if error is None and text is None:
                error = ValueError("empty explanation")
            if error is not None:
                return STATUS_FAILED, None, str(error) or type(error).__name__, used
            return STATUS_OK, str(text), None, used

        for batch in batches:
            prompts = batch.column("_prompt").to_pylist()
            records = ([_clean(json.loads(r)) for r in batch.column("raw_value").to_pylist()] if has_raw
                       else [_clean(r) for r in batch.select(RECORD_COLUMNS).to_pylist()])
            tries = batch.column("_attempt").to_pylist() if attempt else [None] * len(prompts)
            results = run_bounded(one, records, list(zip(prompts, tries, strict=True)), workers)
            arrays = [batch.column(n) for n in pass_names] + [
                pa.array([r[0] for r in results], pa.string()),
                pa.array([r[1] for r in results], pa.string()),
                pa.array([r[2] for r in results], pa.string()),
                pa.array([r[3] for r in results], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=out_names)

    prompt = prompt_column(F.col("raw_value") if has_raw else None, prompt_head, prompt_tail)
    return base.withColumn("_prompt", prompt).mapInArrow(run, EXPLAINED_SCHEMA)


def run_bounded(fn, records: list, prompts: list, workers: int) -> list:
    """``[fn(r, p) ...]`` in input order with at most ``workers`` calls in
    flight.  Each thread takes the next index from a shared counter, so a
    slow record (retrying) never holds up the others, and there is no
    per-record future."""
    n = len(records)
    results = [None] * n
    if n == 0:
        return results
    counter = itertools.count()

    def work():
        while True:
            i = next(counter)   # atomic under the GIL
            if i >= n:
                return
            results[i] = fn(records[i], prompts[i])

    threads = [threading.Thread(target=work, daemon=True) for _ in range(min(workers, n))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return results


def _clean(record: dict) -> dict:
    """Arrow row -> JSON-able dict without missing fields (as the record
    arrived on the topic: nulls left out, times as ISO text)."""
    out = {}
    for k, v in record.items():
        if v is None:
            continue
        if isinstance(v, dict):
            v = _clean(v)
        elif hasattr(v, "isoformat"):
            v = v.isoformat()
        out[k] = v
    return out


def explained(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == STATUS_OK).drop("error")


def dead_letters(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") != STATUS_OK).drop("llm_explanation")


def undecodable_dead_letters(parsed: DataFrame) -> DataFrame:
    """Messages that are not a JSON object become dead letters too (the
    reference logs and drops them, or stops on a non-object)."""
    return parsed.filter(F.col(schemas.CORRUPT_COLUMN).isNotNull()).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.FLAG_SUPERSET.fields],
        F.lit(None).cast("string").alias("shape"),
        F.col("record_key"),
        F.col("message_key"),
        F.lit(STATUS_FAILED).alias("status"),
        F.lit("decode: not a JSON object").alias("error"),
        F.lit(0).alias("attempts"),
        F.col(schemas.CORRUPT_COLUMN).alias("raw_value"),
    )


def summary(results: DataFrame) -> DataFrame:
    """Per-status counts of a batch."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def to_output_payload(results: DataFrame, more: tuple = ()) -> DataFrame:
    """Explained records / dead letters as keyed JSON: the message's object
    as it came, unknown fields included, with status and explanation or error
    added at its end.  (Of a key that was there already readers take the last.)
    Without the raw message the record is built from the flag schema.
    ``more``: further columns to add, for example ``attempts``."""
    added = [c for c in ("status", "llm_explanation", "error", *more) if c in results.columns]
    known = [c for c in results.columns if c in (*RECORD_COLUMNS, *added)]
    value = F.to_json(F.struct(*known))
    if "raw_value" in results.columns:
        text = F.rtrim(F.col("raw_value"))
        body = F.rtrim(F.substring(text, F.lit(1), F.length(text) - 1))
        extra = F.substring(F.to_json(F.struct(*added)), 2, 1 << 30)
        joined = F.concat(body, F.when(F.endswith(body, F.lit("{")), F.lit("")).otherwise(F.lit(",")), extra)
        value = F.coalesce(joined, value)
    return results.select(F.col("record_key").alias("key"), value.alias("value"))
