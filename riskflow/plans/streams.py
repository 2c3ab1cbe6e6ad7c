"""Registered queries over streams that come late, are cut off, replayed or chained.

Each runs the streaming code over the whole ``events`` table, framed onto a raw
topic, and returns what the run wrote.  Runs that several queries read are made
once for the same files (``catalog.cached_run``).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas, workspace
from riskflow.config import DEFAULT
from riskflow.functions import wire
from riskflow.operators import avro, evolution, explain, ingest, payload
from riskflow.plans import catalog
from riskflow.plans.compare import comparable, null_safe
from riskflow.sources.fixtures import read_transactions
from riskflow.sources.registry import REGISTRY_SCHEMA
from riskflow.sources.topic import FileTopic, produce
from riskflow.streaming import once, retry, state, windows
from riskflow.streaming.explainer import start_explainer
from riskflow.streaming.ledger import Ledger
from riskflow.streaming.metrics import BatchMetrics
from riskflow.streaming.pipeline import start_pipeline
from riskflow.streaming.retry import start_retrying_explainer
from riskflow.streaming.sinks import TableSink, TopicSink
from riskflow.streaming.union import start_union

NOW = {"availableNow": True}
#: Parts of a replayed topic, one for each micro-batch.
PARTS = 8
# Fixed values of the out-of-order replay (shared with the DuckDB SQL): by the
# transaction's number modulo DELAY_OF, how many parts late it comes.
DELAY_OF, DELAYS = 20, {7: 1, 13: 2, 17: 4}


def replay(spark: SparkSession, sf_dir: str, topic: FileTopic, out_of_order: bool) -> int:
    """The transactions onto ``topic`` in ``PARTS`` parts of equal spans of
    event time, some of them parts late when ``out_of_order``.  Returns the
    number of files in a part, which a stream takes for a batch."""
    tx = read_transactions(spark, sf_dir)
    lo, hi = tx.agg(F.min("timestamp"), F.max("timestamp")).first()
    at = F.expr(f"(timestamp - {lo or 0}L) * {PARTS} div {(hi or 0) - (lo or 0) + 1}L")
    if out_of_order:
        late, key = F.lit(0), F.col("transaction_id").cast("long") % DELAY_OF
        for rest, parts in DELAYS.items():
            late = F.when(key == rest, parts).otherwise(late)
        at = F.least(at + late, F.lit(PARTS - 1))
    files = catalog.part_files(spark, min(tx.agg(*[F.count_if(at == k).alias(f"n{k}") for k in range(PARTS)]).first()))
    for k in range(PARTS):
        part = tx.filter(at == k).repartition(files)
        produce(ingest.to_wire(part), topic, part=f"batch-{k:04d}")
    return files


def start_replayed(spark: SparkSession, run: str, files: int, on_step: Callable | None = None):
    """The window flow over a replayed topic, one part (of ``files`` files) a batch."""
    raw = FileTopic(run, DEFAULT.raw_topic).read_stream(spark, max_files_per_trigger=files)
    return windows.start_windows(raw, f"{run}/windows", f"{run}/checkpoints/windows", DEFAULT, trigger=NOW,
                                 name="windows-" + run.rsplit("-", 1)[-1], on_step=on_step,
                                 state_partitions=workspace.parallelism(spark))


def late_run(spark: SparkSession, sf_dir: str) -> str:
    def make(run: str) -> None:
        files = replay(spark, sf_dir, FileTopic(run, DEFAULT.raw_topic), out_of_order=True)
        start_replayed(spark, run, files).awaitTermination()
    return catalog.cached_run(spark, sf_dir, "stream-late", make) + "/windows"


def q_stream_windows_out_of_order(spark, sf_dir):
    """T4: windows from out-of-order parts; shares behind the previous batch's watermark are left out."""
    return comparable(windows.emitted_windows(spark, late_run(spark, sf_dir)).select(*schemas.FEATURE_COLUMNS))


def q_stream_late_rows(spark, sf_dir):
    """T4: every (row, window) that the aggregate dropped, with the batch it came in."""
    return comparable(windows.late_rows(spark, late_run(spark, sf_dir)))


def q_stream_late_counts(spark, sf_dir):
    """T4: rows, late rows and dropped (window, user) groups of every batch, from the ledger."""
    entries = Ledger(f"{late_run(spark, sf_dir)}/ledger").read(spark).filter("rows > 0")
    return entries.select("batch_id", "rows", "late_rows", "late_windows", F.unix_seconds("max_event_time").alias("max_event_time"))


def q_stream_windows_repaired(spark, sf_dir):
    """T4: emitted windows plus late rows give the windows of rows in order; nothing is lost."""
    out = late_run(spark, sf_dir)
    return comparable(windows.repaired(windows.emitted_windows(spark, out), windows.late_rows(spark, out), DEFAULT))


class Interrupted(Exception):
    """The fault that ``q_stream_restart_windows`` puts into its first run."""


def interrupted_run(spark: SparkSession, sf_dir: str, batch: int = 3) -> str:
    """A run cut off between the outputs of ``batch`` and its ledger entry, then restarted on the same checkpoint."""
    def fault(step: str, batch_id: int) -> None:
        if step == "features" and batch_id == batch:
            raise Interrupted(f"cut off in batch {batch_id}")

    def make(run: str) -> None:
        files = replay(spark, sf_dir, FileTopic(run, DEFAULT.raw_topic), out_of_order=False)
        first = start_replayed(spark, run, files, fault)
        try:
            first.awaitTermination()
        except Exception as e:  # noqa: BLE001 - Spark wraps the fault
            if "cut off in batch" not in str(e):
                raise
        start_replayed(spark, run, files).awaitTermination()
    return catalog.cached_run(spark, sf_dir, "stream-restart", make) + "/windows"


def q_stream_restart_windows(spark, sf_dir):
    """An interrupted and restarted run gives every window once."""
    return comparable(windows.emitted_windows(spark, interrupted_run(spark, sf_dir)).select(*schemas.FEATURE_COLUMNS))


def q_stream_open_windows(spark, sf_dir):
    """After the last batch, the state holds the windows that have not ended."""
    checkpoint = f"{catalog.stream_run_batches(spark, sf_dir)}/checkpoints/flagged-windowed-kafka"
    return comparable(state.open_windows(spark, checkpoint))


def once_run(spark: SparkSession, sf_dir: str) -> str:
    """The flagged topic published twice, consumed in two batches with flags told once."""
    def make(run: str) -> None:
        flags = FileTopic(catalog.stream_run(spark, sf_dir), DEFAULT.flagged_topic).read(spark)
        topic, files = FileTopic(run, DEFAULT.flagged_topic), catalog.part_files(spark, flags.count())
        for attempt in range(2):
            produce(flags.repartition(files), topic, part=f"batch-{attempt:04d}")
        stream = once.once(topic.read_stream(spark, max_files_per_trigger=files))
        TableSink(f"{run}/once").start(stream, "once-" + run.rsplit("-", 1)[-1], f"{run}/checkpoints/once", NOW).awaitTermination()
    return catalog.cached_run(spark, sf_dir, "stream-once", make) + "/once"


def q_stream_flagged_topic_once(spark, sf_dir):
    """A topic that holds every flag twice, read effectively once."""
    rows = TableSink(once_run(spark, sf_dir)).read(spark)
    return null_safe(comparable(rows.drop("raw_value", "message_key", "_corrupt_record", "flag_id")))


#: An explained record or dead letter as it stands on its topic.
OUTPUT = T.StructType(schemas.FLAG_SUPERSET.fields + [
    T.StructField(c, T.StringType()) for c in ("status", "llm_explanation", "error")])


def chained_run(spark: SparkSession, sf_dir: str) -> str:
    """Flag queries and the explainer at once: the explainer follows the
    flagged topic, a few files a batch, while the flag queries write it."""
    def make(run: str) -> None:
        suffix = "-" + run.rsplit("-", 1)[-1]
        raw, flagged = FileTopic(run, DEFAULT.raw_topic), FileTopic(run, DEFAULT.flagged_topic)
        files = replay(spark, sf_dir, raw, out_of_order=False)
        # The topic exists before its first reader.
        produce(spark.createDataFrame([], "key string, value string"), flagged, part="batch-created")
        flows = start_pipeline(raw.read_stream(spark, max_files_per_trigger=files), TopicSink(flagged), f"{run}/checkpoints",
                               DEFAULT, trigger=NOW, name_suffix=suffix, state_partitions=workspace.parallelism(spark))
        follower = start_explainer(
            flagged.read_stream(spark, max_files_per_trigger=8), TopicSink(FileTopic(run, "explained")),
            TopicSink(FileTopic(run, "dead-letters")), f"{run}/checkpoints/explainer", catalog.demo_explainer, DEFAULT,
            trigger={"processingTime": "0 seconds"}, sleep=lambda s: None, name=f"explainer{suffix}", pass_attempt=True)
        try:
            flows.await_termination()
            follower.processAllAvailable()
        finally:
            flows.stop()
            follower.stop()
    return catalog.cached_run(spark, sf_dir, "stream-chain", make)


def throttled(record: dict, prompt: str, attempt: int) -> str:
    """The demo explainer, refusing one kind of flag for good: window flags scored 0.85 for their velocity."""
    if record.get("fraud_reason") == "HIGH_VELOCITY" and record.get("rule_score") == 0.85:
        raise explain.RetryableError("throttled")
    return catalog.demo_explainer(record, prompt, attempt)


def retry_run(spark: SparkSession, sf_dir: str) -> str:
    """The flagged topic through the retrying explainer, until no flag waits."""
    def make(run: str) -> None:
        flagged = FileTopic(catalog.stream_run(spark, sf_dir), DEFAULT.flagged_topic)
        sinks = FileTopic(run, "explained"), FileTopic(run, "dead-letters")
        total = flagged.read(spark).count()
        query = start_retrying_explainer(
            flagged.read_stream(spark), FileTopic(run, "retry"), TopicSink(sinks[0]), TopicSink(sinks[1]),
            f"{run}/checkpoints/retry", throttled, DEFAULT.with_(explain_wait_min=0.5, explain_wait_max=1.0),
            trigger={"processingTime": "0 seconds"}, name="retry-" + run.rsplit("-", 1)[-1], pass_attempt=True)
        try:
            while not query.awaitTermination(1):
                parts = [t for t in sinks if not Ledger.missing(spark, t.path)]
                if len(parts) == 2 and sum(t.read(spark).count() for t in parts) >= total:
                    break
        finally:
            query.stop()
    return catalog.cached_run(spark, sf_dir, "stream-retry", make)


def q_stream_explained_retry(spark, sf_dir):
    """Attempts in batches of their own; ``batches`` counts those a flag was offered in."""
    run = retry_run(spark, sf_dir)
    shape = T.StructType(OUTPUT.fields + [T.StructField("attempts", T.IntegerType())])
    outputs = FileTopic(run, "explained").read(spark).unionByName(FileTopic(run, "dead-letters").read(spark))
    rows = outputs.select(F.col("key").cast("string").alias("record_key"), F.from_json(F.col("value").cast("string"), shape).alias("r"))
    rows = rows.withColumn("flag", flag_key(F.col("r")))
    # The retry topic's parts are the batches in which an attempt failed.
    failed = FileTopic(run, "retry").read(spark).withColumn("batch", F.regexp_extract("_metadata.file_path", r"-(\d+)/[^/]*$", 1))
    waiting = F.from_json(F.col("value").cast("string"), retry.WAITING)
    failed = (failed.select(flag_key(F.from_json(waiting["message"], shape)).alias("flag"), "batch")
              .groupBy("flag").agg(F.count_distinct("batch").alias("failed")))
    r = F.col("r")
    return null_safe(comparable(rows.join(failed, "flag", "left").select(
        "record_key", *[r[c].alias(c) for c in ("transaction_id", "user_id", "window", "fraud_reason", "rule_score", "status",
                                                "error", "attempts")],
        (F.coalesce("failed", F.lit(0)) + 1).cast("int").alias("batches"))))


def flag_key(flag: Column) -> Column:
    return F.coalesce(flag["transaction_id"], F.concat_ws("|", flag["user_id"], F.unix_seconds(flag["window"]["start"])))


def _output(spark: SparkSession, run: str, topic: str, added: str) -> DataFrame:
    messages = FileTopic(run, topic).read(spark)
    out = messages.select(F.col("key").cast("string").alias("record_key"),
                          F.from_json(F.col("value").cast("string"), OUTPUT).alias("r"))
    rows = out.select("record_key", *[F.col("r")[c].alias(c) for c in (
        "transaction_id", "user_id", "window", "fraud_reason", "rule_score", "status", added)])
    return null_safe(comparable(rows))


def q_stream_explained(spark, sf_dir):
    """Explained records of the chained stream."""
    return _output(spark, chained_run(spark, sf_dir), "explained", "llm_explanation")


def q_stream_dead_letters(spark, sf_dir):
    """Dead letters of the chained stream."""
    return _output(spark, chained_run(spark, sf_dir), "dead-letters", "error")


def metrics_run(spark: SparkSession, sf_dir: str) -> str:
    def make(run: str) -> None:
        raw = FileTopic(run, DEFAULT.raw_topic)
        files = replay(spark, sf_dir, raw, out_of_order=False)
        metrics = BatchMetrics(spark, f"{run}/metrics")
        flows = start_pipeline(raw.read_stream(spark, max_files_per_trigger=files), TopicSink(FileTopic(run, DEFAULT.flagged_topic)),
                               f"{run}/checkpoints", DEFAULT, trigger=NOW, name_suffix="-" + run.rsplit("-", 1)[-1],
                               state_partitions=workspace.parallelism(spark), metrics=metrics)
        flows.await_termination()
        metrics.drain(list(flows.queries.values()))
        metrics.close()
        metrics.read().write.parquet(f"{run}/batch-metrics")
    return catalog.cached_run(spark, sf_dir, "stream-metrics", make)


def q_stream_batch_metrics(spark, sf_dir):
    """The observed metrics of all batches add up to the results' counts."""
    rows = spark.read.parquet(f"{metrics_run(spark, sf_dir)}/batch-metrics")
    wanted = ["input_rows", "immediate.flags", "windowed.flags", "windowed.windows"]
    return (rows.filter(F.col("metric").isin(wanted)).groupBy("query", "metric")
            .agg(F.sum("value").alias("total"), F.count_if(F.col("value") > 0).alias("batches")))


def _versions() -> tuple[str, str]:
    """The message's second version (no ``device_type``, a ``channel`` instead) and the reader's schema."""
    record = json.loads(schemas.TRANSACTION_AVRO)
    fields = [f for f in record["fields"] if f["name"] != "device_type"]
    second = {**record, "fields": [*fields, {"name": "channel", "type": "string"}]}
    reader = {**record, "fields": [*fields, {"name": "device_type", "type": "string", "default": "unknown"},
                                   {"name": "channel", "type": "string", "default": "web"}]}
    return json.dumps(second), json.dumps(reader)


def q_wire_evolution(spark, sf_dir):
    """Frames of two schema versions and of an id that nobody registered."""
    second, reader = _versions()
    tx = read_transactions(spark, sf_dir).withColumns({
        "channel": F.lit("app"), "kind": F.pmod(F.col("transaction_id").cast("long"), F.lit(3))})
    first_fields = [f.name for f in schemas.TRANSACTION.fields]
    second_fields = [f["name"] for f in json.loads(second)["fields"]]

    def frames(kind: int, schema: str, fields: list[str], schema_id: int) -> DataFrame:
        bodies = avro.encode(tx.filter(F.col("kind") == kind).select(*fields), schema, alias="body", keep=[])
        return bodies.select(wire.frame(F.col("body"), schema_id).alias("value"))
    topic = (frames(0, schemas.TRANSACTION_AVRO, first_fields, 1).unionByName(frames(1, second, second_fields, 2))
             .unionByName(frames(2, schemas.TRANSACTION_AVRO, first_fields, 99)))
    subject = "transactions-raw-value"
    registry = spark.createDataFrame([(subject, 1, 1, schemas.TRANSACTION_AVRO), (subject, 2, 2, second), ("other", 1, 99, second)],
                                     REGISTRY_SCHEMA)
    decoded = evolution.decode_registered(topic, registry, subject, reader)
    return null_safe(decoded.select("schema_id", F.col("version").cast("double").alias("version"), *first_fields, "channel",
                                    F.col("raw").isNotNull().alias("rejected")))


def q_parse_flagged_variant(spark, sf_dir):
    """``parse_flagged`` by one parse into VARIANT."""
    imm, win = catalog.flag_payloads(spark, sf_dir)
    copies = F.array("value", F.expr("substring(value, 1, length(value) div 2)"))
    win = win.select("key", F.explode(copies).alias("value"))
    parsed = payload.parse_flags_variant(payload.flagged_topic(imm, win))
    return null_safe(comparable(parsed.select(
        *[c for c in parsed.columns if c not in ("raw_value", "message_key", "_corrupt_record", "record")],
        F.col("_corrupt_record").isNotNull().alias("corrupt"))))


def union_run(spark: SparkSession, sf_dir: str, policy: str) -> str:
    """Two topics, even and odd transactions; the second falls behind: its
    first seven parts hold a sixteenth of the time each."""
    def make(run: str) -> None:
        tx = read_transactions(spark, sf_dir)
        lo, hi = tx.agg(F.min("timestamp"), F.max("timestamp")).first()
        topics = []
        for odd, spans in enumerate((PARTS, 2 * PARTS)):
            topic = FileTopic(run, f"raw-{odd}")
            at = F.least(F.expr(f"(timestamp - {lo or 0}L) * {spans} div {(hi or 0) - (lo or 0) + 1}L"), F.lit(PARTS - 1))
            some = tx.filter(F.pmod(F.col("transaction_id").cast("long"), F.lit(2)) == odd)
            for k in range(PARTS):
                produce(ingest.to_wire(some.filter(at == k).repartition(1)), topic, part=f"batch-{k:04d}")
            topics.append(topic.read_stream(spark, max_files_per_trigger=1))
        start_union(topics, TopicSink(FileTopic(run, DEFAULT.flagged_topic)), f"{run}/checkpoints/union", policy, DEFAULT, NOW,
                    "union-" + run.rsplit("-", 1)[-1], workspace.parallelism(spark)).awaitTermination()
    return catalog.cached_run(spark, sf_dir, f"stream-union-{policy}", make)


def q_stream_flagged_union(spark, sf_dir):
    """Both flows of two topics as one stream, under either watermark policy."""
    out = None
    for policy in ("min", "max"):
        messages = FileTopic(union_run(spark, sf_dir, policy), DEFAULT.flagged_topic).read(spark)
        parsed = payload.parse_flags(messages).drop("raw_value", "message_key", "_corrupt_record").withColumn("policy", F.lit(policy))
        out = parsed if out is None else out.unionByName(parsed)
    return null_safe(comparable(out))


def queries() -> dict[str, catalog.Query]:
    return {n.removeprefix("q_"): f for n, f in globals().items() if n.startswith("q_")}
