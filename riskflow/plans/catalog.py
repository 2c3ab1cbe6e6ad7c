"""Named queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads ``events`` (or data Spark derives from it) in full; outputs
go through ``comparable`` so they can be checked against the DuckDB oracle.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow import workspace
from riskflow.config import DEFAULT
from riskflow.functions import wire
from riskflow.functions.eventtime import to_event_time
from riskflow.operators import explain, immediate, ingest, payload, velocity
from riskflow.plans.compare import comparable, null_safe
from riskflow.sources.fixtures import read_transactions
from riskflow.sources.topic import FileTopic, produce
from riskflow.streaming.pipeline import start_pipeline
from riskflow.streaming.sinks import TableSink, TopicSink

Query = Callable[[SparkSession, str], DataFrame]


def timed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_event_time(read_transactions(spark, sf_dir))


def q_transactions(spark, sf_dir):
    return read_transactions(spark, sf_dir)


def wire_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions framed as registry-Avro topic messages (key = user_id)."""
    return ingest.to_wire(read_transactions(spark, sf_dir))


def q_header_fields(spark, sf_dir):
    v = F.col("value")
    return wire_messages(spark, sf_dir).select(
        F.col("key").cast("string").alias("key"), wire.magic_byte(v).alias("magic_byte"),
        wire.schema_id(v).alias("schema_id"), F.length(v).alias("wire_length"))


def q_strip_header(spark, sf_dir):
    body = wire.strip_header(F.col("value"))
    return wire_messages(spark, sf_dir).select(
        F.col("key").cast("string").alias("key"), F.length(body).alias("body_length"),
        F.hex(F.substring(body, 1, 1)).alias("first_byte"),
        F.hex(F.substring(body, -1, 1)).alias("last_byte"))


def q_wire_roundtrip(spark, sf_dir):
    return ingest.decode_transactions(wire_messages(spark, sf_dir))


def q_wire_decode_permissive(spark, sf_dir):
    """Every frame plus a copy missing its last byte, decoded PERMISSIVE:
    each damaged copy becomes an all-null row, kept, not lost."""
    copies = F.array("value", F.expr("substring(value, 1, length(value) - 1)"))
    msgs = wire_messages(spark, sf_dir).select("key", F.explode(copies).alias("value"))
    return null_safe(ingest.decode_transactions(msgs, mode="PERMISSIVE"))


def q_event_time(spark, sf_dir):
    return comparable(timed_transactions(spark, sf_dir).select("transaction_id", "timestamp"))


def q_score_immediate(spark, sf_dir):
    return comparable(immediate.score_immediate(timed_transactions(spark, sf_dir), DEFAULT))


def q_flag_immediate(spark, sf_dir):
    return comparable(immediate.flag_immediate(timed_transactions(spark, sf_dir), DEFAULT))


def q_velocity_features(spark, sf_dir):
    return comparable(velocity.velocity_features(timed_transactions(spark, sf_dir), DEFAULT))


def q_velocity_features_panes(spark, sf_dir):
    """R2: the same features from 30-second panes per user."""
    return comparable(velocity.velocity_features(timed_transactions(spark, sf_dir), DEFAULT,
                                                 strategy="panes"))


def q_score_windowed(spark, sf_dir):
    feats = velocity.velocity_features(timed_transactions(spark, sf_dir), DEFAULT)
    return comparable(velocity.score_windowed(feats, DEFAULT))


def q_flag_windowed(spark, sf_dir):
    feats = velocity.velocity_features(timed_transactions(spark, sf_dir), DEFAULT)
    return comparable(velocity.flag_windowed(feats, DEFAULT))


def q_closed_windows(spark, sf_dir):
    return comparable(velocity.closed_velocity_features(timed_transactions(spark, sf_dir), DEFAULT))


def q_flag_windowed_closed(spark, sf_dir):
    closed = velocity.closed_velocity_features(timed_transactions(spark, sf_dir), DEFAULT)
    return comparable(velocity.flag_windowed(closed, DEFAULT))


def flag_payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(transaction-flag payloads, closed-window-flag payloads) as (key, value)."""
    timed = timed_transactions(spark, sf_dir)
    imm = payload.to_payload(immediate.flag_immediate(timed, DEFAULT))
    win = payload.to_payload(velocity.flag_windowed(
        velocity.closed_velocity_features(timed, DEFAULT), DEFAULT))
    return imm, win


def _parsed_back(messages: DataFrame, columns: list[str]) -> DataFrame:
    parsed = payload.parse_flags(messages)
    return comparable(parsed.select(F.col("record_key").alias("key"), *columns))


def q_payload_immediate(spark, sf_dir):
    imm, _ = flag_payloads(spark, sf_dir)
    return _parsed_back(imm, immediate.FLAGGED_IMMEDIATE_COLUMNS)


def q_payload_windowed(spark, sf_dir):
    _, win = flag_payloads(spark, sf_dir)
    return _parsed_back(win, velocity.FLAGGED_WINDOWED_COLUMNS)


def parsed_flagged_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payload.parse_flags(payload.flagged_topic(*flag_payloads(spark, sf_dir)))


def q_flagged_topic(spark, sf_dir):
    parsed = parsed_flagged_topic(spark, sf_dir)
    return null_safe(comparable(parsed.drop("raw_value", "message_key", "_corrupt_record")))


def half_cut(payloads: DataFrame) -> DataFrame:
    return payloads.select("key", F.expr("substring(value, 1, length(value) div 2)").alias("value"))


def q_parse_flagged(spark, sf_dir):
    """The flagged topic plus a damaged copy of every window flag (its JSON
    cut in half): good messages parse back, damaged ones are marked corrupt
    with all fields null and kept, not lost."""
    imm, win = flag_payloads(spark, sf_dir)
    copies = F.array("value", F.expr("substring(value, 1, length(value) div 2)"))
    win = win.select("key", F.explode(copies).alias("value"))        # one pass over the windows
    parsed = payload.parse_flags(payload.flagged_topic(imm, win))
    return null_safe(comparable(parsed.select(
        *[c for c in parsed.columns if c not in ("raw_value", "message_key", "_corrupt_record")],
        F.col("_corrupt_record").isNotNull().alias("corrupt"))))


def q_dead_letters_undecodable(spark, sf_dir):
    """Half-cut copies of all flags become dead letters with the message's key and its raw text."""
    messages = half_cut(payload.flagged_topic(*flag_payloads(spark, sf_dir)))
    dead = explain.undecodable_dead_letters(payload.parse_flags(messages))
    return dead.select("message_key", "status", "error", "attempts",
                       F.startswith(F.col("raw_value"), F.lit("{")).alias("has_raw_text"))


def demo_explainer(record: dict, prompt: str, attempt: int) -> str:
    """Deterministic stand-in for a model call: a one-line template; a
    refusal (non-retryable error) for HIGH_AVERAGE flags, so the dead-letter
    route carries rows; and a retryable "throttled" error on the first call
    for each RAPID_TRANSACTIONS flag, so those succeed on attempt 2."""
    reason = record.get("fraud_reason")
    if reason == "HIGH_AVERAGE":
        raise ValueError("explainer refused HIGH_AVERAGE")
    if reason == "RAPID_TRANSACTIONS" and attempt == 1:
        raise explain.RetryableError("throttled")
    if "window" in record:
        subject = f"user {record.get('user_id')} in a sliding window"
    else:
        subject = f"transaction {record.get('transaction_id')}"
    return f"Flagged {subject} as {reason} with rule score {record.get('rule_score')}."


def explain_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flags' own partitions call the explainer: as many tasks as the
    scan and the window shuffle have, so a lost one repeats a small share."""
    parsed = parsed_flagged_topic(spark, sf_dir)
    good = parsed.filter(F.col("_corrupt_record").isNull())
    return explain.explain_flags(good, demo_explainer, DEFAULT, sleep=lambda s: None, pass_attempt=True)


EXPLAIN_VIEW = ["record_key", "shape", "transaction_id", "user_id", "window",
                "fraud_reason", "rule_score", "status", "attempts"]


def q_explained(spark, sf_dir):
    out = explain.explained(explain_results(spark, sf_dir))
    return null_safe(comparable(out.select(*EXPLAIN_VIEW, "llm_explanation")))


def q_dead_letters(spark, sf_dir):
    out = explain.dead_letters(explain_results(spark, sf_dir))
    return null_safe(comparable(out.select(*EXPLAIN_VIEW, "error")))


def q_explained_template(spark, sf_dir):
    """Default explainer: the template is built JVM-side, every flag succeeds."""
    good = parsed_flagged_topic(spark, sf_dir).filter(F.col("_corrupt_record").isNull())
    out = explain.explained(explain.explain_flags(good))
    return null_safe(comparable(out.select(*EXPLAIN_VIEW, "llm_explanation")))


def q_explain_summary(spark, sf_dir):
    return explain.summary(explain_results(spark, sf_dir))


_RUNS: dict[tuple, str] = {}
STREAM_PROGRESS: dict[tuple, dict] = {}


def run_key(spark: SparkSession, sf_dir: str) -> tuple:
    """This application and the very files it reads, with their sizes and times."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf_dir}/events.parquet")
             .select("path", "length", "modificationTime"))      # a listing; no file is opened
    seen = files.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
    return spark.sparkContext.applicationId, sf_dir, *seen


def cached_run(spark: SparkSession, sf_dir: str, name: str, make: Callable[[str], None]) -> str:
    """The folder of run ``name`` over these files, made by ``make(folder)`` if there is none yet."""
    key = (name, *run_key(spark, sf_dir))
    if key not in _RUNS:
        run = workspace.new_run(spark, name)
        make(run)
        _RUNS[key] = run
    return _RUNS[key]


def stream_run(spark: SparkSession, sf_dir: str) -> str:
    """Run the streaming application once over the whole input.

    The transactions are framed onto a raw topic (the load generator's
    part), then the application's queries consume it with an
    ``availableNow`` trigger: both flag flows to the flagged topic, plus row
    tables of features and flags for checking.  Returns the run folder.
    """
    def make(run: str) -> None:
        raw = FileTopic(run, DEFAULT.raw_topic)
        parts = workspace.parallelism(spark)
        t0 = time.perf_counter()
        produce(wire_messages(spark, sf_dir), raw)
        produce_sec = time.perf_counter() - t0
        p = start_pipeline(raw.read_stream(spark), TopicSink(FileTopic(run, DEFAULT.flagged_topic)),
                           f"{run}/checkpoints", DEFAULT, trigger={"availableNow": True},
                           feature_sink=TableSink(f"{run}/features"),
                           immediate_sink=TableSink(f"{run}/flagged_immediate"),
                           windowed_sink=TableSink(f"{run}/flagged_windowed"),
                           name_suffix="-" + run.rsplit("-", 1)[-1], state_partitions=parts)
        p.await_termination()
        key = run_key(spark, sf_dir)
        STREAM_PROGRESS[key] = {
            name: [(pr["batchId"], pr["numInputRows"], pr["durationMs"].get("triggerExecution", 0))
                   for pr in q.recentProgress]
            for name, q in p.queries.items()}
        STREAM_PROGRESS[key]["_produce_sec"] = produce_sec
    return cached_run(spark, sf_dir, "stream", make)


#: Parts of the raw topic in the many-batch run, one for each micro-batch.
BATCH_PARTS = 8
#: Files in a part at least, and rows for each further file.
PART_FILES, FILE_ROWS = 2, 5000


def part_files(spark: SparkSession, rows: int) -> int:
    """Files of each part of a topic whose least part holds ``rows`` rows: one
    for each task slot, as long as dealing the rows out leaves none empty
    (an empty one would not be written, and a batch would end in the next part)."""
    return max(PART_FILES, min(rows // FILE_ROWS, workspace.parallelism(spark)))


def stream_run_batches(spark: SparkSession, sf_dir: str) -> str:
    """The streaming application over a raw topic in ``BATCH_PARTS`` parts in
    the order of event time, one per trigger: window state is carried from
    batch to batch.  Returns the run folder."""
    def make(run: str) -> None:
        raw = FileTopic(run, DEFAULT.raw_topic)
        tx = read_transactions(spark, sf_dir)
        shares = [k / BATCH_PARTS for k in range(1, BATCH_PARTS)]
        cuts = tx.agg(F.percentile_approx("timestamp", shares).alias("c")).first()["c"] or []
        ends, at = [None, *cuts, None], F.col("timestamp")
        within = [(F.lit(True) if low is None else at >= low) & (F.lit(True) if high is None else at < high)
                  for low, high in zip(ends, ends[1:], strict=False)]
        files = part_files(spark, min(tx.agg(*[F.count_if(some).alias(f"n{k}") for k, some in enumerate(within)]).first()))
        for k, some in enumerate(within):
            produce(ingest.to_wire(tx.filter(some).repartition(files)), raw, part=f"batch-{k:04d}")
        p = start_pipeline(raw.read_stream(spark, max_files_per_trigger=files),
                           TopicSink(FileTopic(run, DEFAULT.flagged_topic)), f"{run}/checkpoints", DEFAULT,
                           trigger={"availableNow": True}, feature_sink=TableSink(f"{run}/features"),
                           windowed_sink=TableSink(f"{run}/flagged_windowed"),
                           name_suffix="-" + run.rsplit("-", 1)[-1], state_partitions=workspace.parallelism(spark))
        p.await_termination()
    return cached_run(spark, sf_dir, "stream-batches", make)


def q_stream_closed_windows_batches(spark, sf_dir):
    return comparable(TableSink(f"{stream_run_batches(spark, sf_dir)}/features").read(spark))


def q_stream_flag_windowed_batches(spark, sf_dir):
    return comparable(TableSink(f"{stream_run_batches(spark, sf_dir)}/flagged_windowed").read(spark))


def q_stream_flag_immediate(spark, sf_dir):
    return comparable(TableSink(f"{stream_run(spark, sf_dir)}/flagged_immediate").read(spark))


def q_stream_closed_windows(spark, sf_dir):
    return comparable(TableSink(f"{stream_run(spark, sf_dir)}/features").read(spark))


def q_stream_flag_windowed(spark, sf_dir):
    return comparable(TableSink(f"{stream_run(spark, sf_dir)}/flagged_windowed").read(spark))


def q_stream_flagged_topic(spark, sf_dir):
    topic = FileTopic(stream_run(spark, sf_dir), DEFAULT.flagged_topic)
    parsed = payload.parse_flags(topic.read(spark))
    return null_safe(comparable(parsed.drop("raw_value", "message_key", "_corrupt_record")))


def queries() -> dict[str, Query]:
    return {
        "transactions": q_transactions,
        "header_fields": q_header_fields,
        "strip_header": q_strip_header,
        "wire_roundtrip": q_wire_roundtrip,
        "wire_decode_permissive": q_wire_decode_permissive,
        "event_time": q_event_time,
        "score_immediate": q_score_immediate,
        "flag_immediate": q_flag_immediate,
        "velocity_features": q_velocity_features,
        "velocity_features_panes": q_velocity_features_panes,
        "score_windowed": q_score_windowed,
        "flag_windowed": q_flag_windowed,
        "closed_windows": q_closed_windows,
        "flag_windowed_closed": q_flag_windowed_closed,
        "payload_immediate": q_payload_immediate,
        "payload_windowed": q_payload_windowed,
        "flagged_topic": q_flagged_topic,
        "parse_flagged": q_parse_flagged,
        "explained": q_explained,
        "dead_letters": q_dead_letters,
        "explained_template": q_explained_template,
        "explain_summary": q_explain_summary,
        "dead_letters_undecodable": q_dead_letters_undecodable,
        "stream_flag_immediate": q_stream_flag_immediate,
        "stream_closed_windows": q_stream_closed_windows,
        "stream_flag_windowed": q_stream_flag_windowed,
        "stream_flagged_topic": q_stream_flagged_topic,
        "stream_closed_windows_batches": q_stream_closed_windows_batches,
        "stream_flag_windowed_batches": q_stream_flag_windowed_batches,
    }
