"""The streaming application: raw topic -> two flag flows -> flagged topic.

``build_flows`` declares the plan once; ``start_pipeline`` starts one
streaming query per flow (T1, T3), each with its own checkpoint (T6) and
name (T7).  ``Pipeline.await_termination`` watches *all* its queries and raises
the first failure (T8; the reference waits on one console query and never
sees the others die).

Event time goes through ``to_event_time`` (a ``timestamp``, never
``timestamp_ntz``, which a watermark rejects).  Windows come out once, in
append mode, when the watermark (max event time - delay) reaches their end;
rows later than the previous batch's watermark are dropped per
(window, user) — Spark's built-in late-data rule (T2, T4).
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.config import DEFAULT, FraudConfig
from riskflow.functions.eventtime import to_event_time
from riskflow.operators import immediate, ingest, payload, velocity
from riskflow.streaming.metrics import BatchMetrics, observed


@dataclass
class Flows:
    timed: DataFrame
    features: DataFrame
    flagged_immediate: DataFrame
    flagged_windowed: DataFrame

    def payloads(self) -> dict[str, DataFrame]:
        return {"immediate": payload.to_payload(self.flagged_immediate),
                "windowed": payload.to_payload(self.flagged_windowed)}


# Record fields each path reads (the decoder skips the rest).
IMMEDIATE_INPUT = ["transaction_id", "user_id", "amount", "currency", "merchant", "timestamp", "is_fraud"]
WINDOW_INPUT = ["user_id", "amount", "timestamp"]


def build_flows(source: DataFrame, cfg: FraudConfig = DEFAULT, decoded: bool = False,
                **decode_kw) -> Flows:
    """``source``: raw framed messages (``value`` column), or transaction rows
    with an epoch-ms ``timestamp`` when ``decoded``.  Each path decodes only
    the fields it reads; ``timed`` is the whole record.  Windows are expanded:
    the pane strategy aggregates twice, which a stream in append mode refuses."""
    if decoded:
        timed = timed_imm = timed_win = to_event_time(source)
    else:
        timed = ingest.timed_transactions(source, **decode_kw)
        timed_imm = ingest.timed_transactions(source, columns=IMMEDIATE_INPUT, **decode_kw)
        timed_win = ingest.timed_transactions(source, columns=WINDOW_INPUT, **decode_kw)
    features = velocity.velocity_features(
        timed_win.withWatermark("timestamp", cfg.watermark_delay), cfg)
    return Flows(timed=timed, features=features,
                 flagged_immediate=immediate.flag_immediate(timed_imm, cfg),
                 flagged_windowed=velocity.flag_windowed(features, cfg))


@dataclass
class Pipeline:
    queries: dict[str, StreamingQuery] = field(default_factory=dict)

    def await_termination(self, timeout: float | None = None) -> bool:
        """Wait until every query of this pipeline has stopped (True) or the
        timeout is over (False).  The first failure of any of them stops the
        others and is raised with the query's name; a query that stops
        cleanly leaves the others running."""
        return self._watch(lambda: not any(q.isActive for q in self.queries.values()), timeout)

    def await_any(self, timeout: float | None = None) -> bool:
        """Wait until one query of this pipeline has stopped; raise if one failed."""
        return self._watch(lambda: not all(q.isActive for q in self.queries.values()), timeout)

    def _watch(self, done, timeout: float | None, every: float = 0.3) -> bool:
        until = None if timeout is None else time.monotonic() + timeout
        while True:
            stopped = done()
            self.raise_if_failed()
            if stopped:
                return True
            if until is not None and time.monotonic() >= until:
                return False
            time.sleep(every)

    def raise_if_failed(self) -> None:
        for name, q in self.queries.items():
            err = q.exception()
            if err is not None:
                self.stop()
                raise RuntimeError(f"streaming query {name!r} failed: {err}")

    def process_all_available(self) -> None:
        for q in self.queries.values():
            q.processAllAvailable()

    def stop(self) -> None:
        for q in self.queries.values():
            if q.isActive:
                q.stop()

    def progress(self) -> dict[str, dict | None]:
        return {n: q.lastProgress for n, q in self.queries.items()}


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark) -> None:
    """Keep window state in RocksDB (off-heap, spills to local disk, snapshots
    to the checkpoint) instead of executor heap maps; set before a query's
    first start.  Worth it when live (window, user) state outgrows memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def default_trigger(cfg: FraudConfig = DEFAULT) -> dict:
    return {"processingTime": cfg.flag_trigger}


def _fan_out(outputs: list[tuple[object, "callable"]]):
    """``foreachBatch`` function writing one micro-batch to several sinks.

    ``outputs``: (sink, batch -> DataFrame).  The batch is persisted only
    when more than one output reads it, so the upstream plan (decode,
    aggregation) runs once per batch.
    """
    def write(batch: DataFrame, batch_id: int, query_name: str) -> None:
        shared = len(outputs) > 1
        if shared:
            batch = batch.persist()
        try:
            for sink, make in outputs:
                sink.write_batch(make(batch), f"{query_name}-{batch_id:012d}")
        finally:
            if shared:
                batch.unpersist()
    return write


def start_pipeline(source: DataFrame, flag_sink, checkpoint_root: str,
                   cfg: FraudConfig = DEFAULT, trigger: dict | None = None,
                   feature_sink=None, immediate_sink=None, windowed_sink=None, reject_sink=None,
                   decoded: bool = False, name_suffix: str = "",
                   state_partitions: int | None = None, metrics: BatchMetrics | None = None,
                   **decode_kw) -> Pipeline:
    """Start the application's streaming queries.

    * ``flagged-immediate-<kind>`` (stateless): transaction flags -> JSON
      payloads on ``flag_sink``, and the flag rows on ``immediate_sink``.
    * ``flagged-windowed-<kind>`` (stateful): closed windows' features ->
      ``feature_sink`` (the debug output), window flags -> payloads on
      ``flag_sink`` and rows on ``windowed_sink``.
    * ``rejected-<kind>``, with ``mode="PERMISSIVE"``: messages that cannot be
      decoded -> ``reject_sink`` as they came.  Without a sink that mode is
      refused: the messages would be lost.

    The reference runs four queries that each decode the raw topic and two
    that each keep the same window state; here each path decodes once and
    keeps one state store, and fans out inside ``foreachBatch``.  Every
    query has its own checkpoint under ``checkpoint_root``.

    ``state_partitions``: width of the window query's shuffle and state store.
    It is fixed by the checkpoint at the first start, so size it for the peak
    number of live (window, user) keys, not for today's load.

    ``metrics``: takes each batch's report and the numbers of windows and
    flags, observed as they are computed, under the flow's name.
    """
    permissive = decode_kw.get("mode", "FAILFAST").upper() == "PERMISSIVE" and not decoded
    if permissive and reject_sink is None:
        raise ValueError("mode PERMISSIVE needs a reject_sink: undecodable messages would be lost")
    flows = build_flows(source, cfg, decoded=decoded, **decode_kw)
    trig = trigger or default_trigger(cfg)
    kind = getattr(flag_sink, "kind", "sink")
    root = checkpoint_root.rstrip("/")
    p = Pipeline()

    imm_out = [(flag_sink, payload.to_payload)]
    if immediate_sink is not None:
        imm_out.append((immediate_sink, lambda b: b))
    win_out = [(flag_sink, lambda b: payload.to_payload(velocity.flag_windowed(b, cfg)))]
    if feature_sink is not None:
        win_out.append((feature_sink, lambda b: b))
    if windowed_sink is not None:
        win_out.append((windowed_sink, lambda b: velocity.flag_windowed(b, cfg)))

    def start(flow: str, df: DataFrame, outputs) -> None:
        # The checkpoint is keyed by the flow, not the (suffixed) query name,
        # so a restarted query resumes its own offsets and state.
        name = f"{flow}{name_suffix}"
        fn = _fan_out(outputs)
        w = df.writeStream.queryName(name).outputMode("append").option(
            "checkpointLocation", f"{root}/{flow}").trigger(**trig)
        p.queries[name] = w.foreachBatch(lambda b, i: fn(b, i, flow)).start()
        if metrics is not None:
            metrics.watch(flow, p.queries[name])

    flags, features = flows.flagged_immediate, flows.features
    if metrics is not None:
        flags = observed(flags, "immediate", flags=F.count(F.lit(1)))
        high = velocity.score_rules(cfg).chain() > cfg.flag_threshold
        features = observed(features, "windowed", windows=F.count(F.lit(1)), flags=F.count_if(high))
    try:
        start(f"flagged-immediate-{kind}", flags, imm_out)
        if permissive:
            kw = {k: v for k, v in decode_kw.items() if k != "mode"}
            start(f"rejected-{kind}", ingest.rejects(source, **kw), [(reject_sink, lambda b: b)])
        spark = source.sparkSession
        prev = spark.conf.get("spark.sql.shuffle.partitions")
        if state_partitions:
            spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        try:
            start(f"flagged-windowed-{kind}", features, win_out)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", prev)
    except Exception:
        p.stop()
        raise
    return p
