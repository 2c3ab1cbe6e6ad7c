import pytest
from pyspark.sql import functions as F

from riskflow.functions.eventtime import to_event_time
from riskflow.operators import velocity
from riskflow.sources.fixtures import read_transactions
from tests.conftest import SF_SMALL
from tests.helpers import ms, tx_df, tx_row

T0 = ms("2024-01-01 00:00:00")


def _window_rows(spark, rows, strategy="expand"):
    timed = to_event_time(tx_df(spark, rows))
    return velocity.velocity_features(timed, strategy=strategy)


def test_each_row_in_four_windows_epoch_aligned(spark):
    feats = _window_rows(spark, [tx_row("a", "u1", 100.0, ms("2024-01-01 00:00:30"))])
    starts = sorted(r[0] for r in feats.select(F.date_format("window.start", "HH:mm:ss")).collect())
    assert starts == sorted(["23:59:00", "23:59:30", "00:00:00", "00:00:30"])
    ends = {r[0] - r[1] for r in feats.select(F.unix_seconds("window.end"), F.unix_seconds("window.start")).collect()}
    assert ends == {120}


def test_golden_example(spark):
    # 5 transactions summing to 38750.50 in one window -> velocity 19375.25.
    amounts = [7750.10, 7750.10, 7750.10, 7750.10, 7750.10]
    rows = [tx_row(f"t{i}", "user-0042", a, T0 + 61_000 + i * 1000) for i, a in enumerate(amounts)]
    scored = velocity.score_windowed(_window_rows(spark, rows))
    r = scored.filter(F.col("window.start") == F.to_timestamp(F.lit("2024-01-01 00:00:00"))).first()
    assert r["window_count"] == 5
    assert r["window_amount"] == pytest.approx(38750.50)
    assert r["velocity"] == pytest.approx(19375.25)
    assert (r["fraud_reason"], r["rule_score"]) == ("HIGH_VELOCITY", 0.95)


@pytest.mark.parametrize("amounts,expected", [
    ([10001.0], ("HIGH_VELOCITY", 0.95)),             # velocity 5000.5
    ([5001.0, 10.0], ("HIGH_VELOCITY", 0.85)),         # velocity 2505.5
    ([1.0] * 6, ("RAPID_TRANSACTIONS", 0.85)),         # count 6
    ([1.0] * 4, ("RAPID_TRANSACTIONS", 0.70)),         # count 4
    ([3500.0], ("HIGH_AVERAGE", 0.70)),                # avg 3500, velocity 1750
    ([2100.0, 100.0], ("PATTERN_DETECTED", 0.70)),     # velocity 1100
    ([100.0, 100.0], ("PATTERN_DETECTED", 0.1)),
    ([5000.0], ("HIGH_AVERAGE", 0.70)),                # velocity exactly 2500 is not > 2500
    ([1.0] * 3, ("PATTERN_DETECTED", 0.1)),            # count exactly 3
])
def test_reason_score_pairs(spark, amounts, expected):
    rows = [tx_row(f"t{i}", "u", a, T0 + 5000 + i) for i, a in enumerate(amounts)]
    scored = velocity.score_windowed(_window_rows(spark, rows))
    got = {(r["fraud_reason"], r["rule_score"]) for r in scored.collect()}
    assert got == {expected}
    flagged = velocity.flag_windowed(_window_rows(spark, rows)).count()
    assert flagged == (4 if expected[1] > 0.5 else 0)


def test_properties_on_fixture(spark):
    timed = to_event_time(read_transactions(spark, SF_SMALL))
    feats = velocity.velocity_features(timed)
    n = timed.count()
    agg = feats.agg(F.sum("window_count"), F.min(F.col("max_amount") - F.col("avg_amount"))).first()
    assert agg[0] == 4 * n
    assert agg[1] >= 0
    scored = velocity.score_windowed(feats)
    bad = scored.filter(((F.col("fraud_reason") == "HIGH_VELOCITY") != (F.col("velocity") > 2500))
                        | ((F.col("fraud_reason") == "HIGH_VELOCITY") & ~F.col("rule_score").isin(0.85, 0.95)))
    assert bad.count() == 0


def test_panes_equal_expand(spark):
    timed = to_event_time(read_transactions(spark, SF_SMALL))
    a = velocity.velocity_features(timed, strategy="expand")
    b = velocity.velocity_features(timed, strategy="panes")
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_closed_windows_counts(spark):
    timed = to_event_time(read_transactions(spark, SF_SMALL))
    feats = velocity.velocity_features(timed)
    assert feats.count() == 1253
    closed = velocity.closed_velocity_features(timed)
    assert closed.count() == 1152
    assert velocity.flag_windowed(closed).count() == 862
    assert velocity.flag_windowed(feats).count() == 918


def test_closed_windows_plan_has_no_cross_join(spark):
    timed = to_event_time(read_transactions(spark, SF_SMALL))
    plan = velocity.closed_velocity_features(timed)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Subquery" in plan


def test_null_event_time_and_duplicates(spark):
    from riskflow import schemas
    rows = [("n1", "u", 6000.0, "USD", "m", None, None, "US", "mobile", False),
            ("d1", "u", 10.0, "USD", "m", None, T0 + 1000, "US", "mobile", False),
            ("d1", "u", 10.0, "USD", "m", None, T0 + 1000, "US", "mobile", False)]
    schema = schemas.TRANSACTION.fromJson(schemas.TRANSACTION.jsonValue())
    for f in schema.fields:
        f.nullable = True
    timed = to_event_time(spark.createDataFrame(rows, schema))
    from riskflow.operators import immediate
    assert [r["transaction_id"] for r in immediate.flag_immediate(timed).collect()] == ["n1"]
    feats = velocity.velocity_features(timed).collect()
    assert len(feats) == 4 and all(r["window_count"] == 2 for r in feats)   # duplicate kept, null skipped


def test_panes_equal_expand_with_null_amounts(spark):
    from riskflow import schemas
    schema = schemas.TRANSACTION.fromJson(schemas.TRANSACTION.jsonValue())
    for f in schema.fields:
        f.nullable = True
    rows = [tx_row("a", "u", None, T0 + 1000), tx_row("b", "u", 10.0, T0 + 2000),
            tx_row("c", "v", None, T0 + 3000)]
    timed = to_event_time(spark.createDataFrame(rows, schema))
    a = velocity.velocity_features(timed, strategy="expand")
    b = velocity.velocity_features(timed, strategy="panes")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    got = {(r["user_id"], r["window_count"], r["avg_amount"]) for r in a.collect()}
    assert got == {("u", 2, 10.0), ("v", 1, None)}


def test_fixture_user_ids_are_never_truncated(spark):
    from riskflow.sources.fixtures import events_to_transactions
    ev = spark.createDataFrame([(1, 7), (2, 1234), (3, 12345), (4, 123456)], "event_id long, user_id long") \
        .selectExpr("event_id", "TIMESTAMP_NTZ'2024-01-01 00:00:01' AS ts", "user_id",
                    "'view' AS event_type", "1.0 AS value")
    got = [r["user_id"] for r in events_to_transactions(ev).orderBy("transaction_id").collect()]
    assert got == ["user-0007", "user-1234", "user-12345", "user-123456"]
