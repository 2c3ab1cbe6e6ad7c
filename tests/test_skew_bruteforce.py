"""Window features with one user holding a third of all rows, checked
against a brute-force computation in plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskflow.functions.eventtime import to_event_time
from riskflow.operators import velocity
from tests.helpers import tx_df, tx_row

T0 = 1_704_067_200_000


def _rows(n=3000, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if i % 3 == 0 else f"u{rnd.randrange(200)}"
        ts = T0 + rnd.randrange(0, 1_800_000)            # 30 minutes
        amount = rnd.choice([0.25, 10.0, 150.5, 999.75, 3100.0, 4999.5, 7000.25])
        rows.append(tx_row(f"t{i}", user, amount, ts))
    return rows


def _brute(rows):
    groups = defaultdict(list)
    for r in rows:
        sec = r[6] // 1000
        last = sec - sec % 30
        for k in range(4):
            start = last - 30 * k
            groups[(start, r[1])].append(r[2])
    out = {}
    for (start, user), amts in groups.items():
        s, c = sum(amts), len(amts)
        v = s / 2
        reason = ("HIGH_VELOCITY" if v > 2500 else "RAPID_TRANSACTIONS" if c > 3
                  else "HIGH_AVERAGE" if s / c > 3000 else "PATTERN_DETECTED")
        score = (0.95 if v > 5000 else 0.85 if (v > 2500 or c > 5)
                 else 0.70 if (v > 1000 or c > 3 or s / c > 3000) else 0.1)
        out[(start, user)] = (s, c, max(amts), reason, score)
    return out


@pytest.mark.parametrize("strategy", ["expand", "panes"])
def test_hot_user_matches_brute_force(spark, strategy):
    rows = _rows()
    want = _brute(rows)
    feats = velocity.velocity_features(to_event_time(tx_df(spark, rows)), strategy=strategy)
    scored = velocity.score_windowed(feats).select(
        F.unix_seconds("window.start").alias("s"), "user_id", "window_amount", "window_count",
        "max_amount", "fraud_reason", "rule_score")
    got = {(r["s"], r["user_id"]): (r["window_amount"], r["window_count"], r["max_amount"],
                                    r["fraud_reason"], r["rule_score"]) for r in scored.collect()}
    assert got == want
    hot = sum(c for (s, u), (_, c, *_r) in want.items() if u == "hot")
    assert hot == 4 * 1000


def test_rocksdb_state_store_gives_same_windows(spark, scratch):
    from riskflow import schemas
    from riskflow.config import DEFAULT
    from riskflow.streaming.pipeline import build_flows, use_rocksdb_state
    rows = _rows(600, seed=3)
    tx_df(spark, rows).write.parquet(f"{scratch}/in")
    prev = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        use_rocksdb_state(spark)
        stream = spark.readStream.schema(schemas.TRANSACTION).parquet(f"{scratch}/in")
        flows = build_flows(stream, DEFAULT, decoded=True)
        q = (flows.features.writeStream.format("memory").queryName("rocks_w")
             .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start())
        q.awaitTermination()
        streamed = spark.sql("SELECT * FROM rocks_w")
        batch = velocity.closed_velocity_features(to_event_time(tx_df(spark, rows)))
        assert streamed.count() == batch.count() > 0
        assert streamed.exceptAll(batch).count() == 0
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", prev)


def test_hot_user_does_not_make_a_hot_reducer(spark):
    """Rows per reducer partition of the window aggregation stay balanced
    although one user has a third of all rows: the shuffle key is
    (window, user), and the hot user's rows spread over its windows."""
    rows = _rows(6000, seed=5)
    timed = to_event_time(tx_df(spark, rows).repartition(8))
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        feats = velocity.velocity_features(timed)
        per_part = [r["n"] for r in feats.groupBy(F.spark_partition_id().alias("p"))
                    .agg(F.sum("window_count").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert sum(per_part) == 4 * len(rows)
    assert max(per_part) < 2.0 * (sum(per_part) / 8)      # hot user's third is spread out
