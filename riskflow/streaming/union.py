"""Several raw topics and both flag flows as one stream.

Each topic carries its own watermark.  Spark takes the least of them (``min``:
the windows wait for the slowest topic, no row of it is late) or the greatest
(``max``: windows end with the fastest topic, rows of a slow one that fall behind
are dropped).  The policy is fixed by the checkpoint at the first start.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from riskflow.config import DEFAULT, FraudConfig
from riskflow.operators import immediate, ingest, payload, velocity
from riskflow.streaming.pipeline import IMMEDIATE_INPUT

_POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def union_flags(sources: list[DataFrame], cfg: FraudConfig = DEFAULT, **decode_kw) -> DataFrame:
    """Keyed JSON flags, of transactions and of windows over all topics together."""
    timed = [ingest.timed_transactions(s, columns=IMMEDIATE_INPUT, **decode_kw).withWatermark("timestamp", cfg.watermark_delay)
             for s in sources]
    timed = functools.reduce(DataFrame.unionByName, timed)
    windows = velocity.flag_windowed(velocity.velocity_features(timed, cfg), cfg)
    return payload.flagged_topic(payload.to_payload(immediate.flag_immediate(timed, cfg)), payload.to_payload(windows))


def start_union(sources: list[DataFrame], flag_sink, checkpoint: str, policy: str = "min", cfg: FraudConfig = DEFAULT,
                trigger: dict | None = None, name: str = "flagged-union", state_partitions: int | None = None,
                **decode_kw) -> StreamingQuery:
    """One query from all ``sources`` to ``flag_sink`` under the watermark ``policy`` (``min`` or ``max``)."""
    if policy not in ("min", "max"):
        raise ValueError("policy is min or max")
    spark = sources[0].sparkSession
    settings = {_POLICY: policy}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return flag_sink.start(union_flags(sources, cfg, **decode_kw), name, checkpoint, trigger)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
