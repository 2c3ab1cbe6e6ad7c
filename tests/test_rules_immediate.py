import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.eventtime import to_event_time
from riskflow.functions.rules import RuleSet
from riskflow.operators import immediate
from tests.helpers import ms, tx_df, tx_row

T0 = ms("2024-01-01 00:00:00")


def _flags(spark, rows, pushdown=True):
    timed = to_event_time(tx_df(spark, rows))
    return {r["transaction_id"]: (r["fraud_reason"], r["rule_score"])
            for r in immediate.flag_immediate(timed, pushdown=pushdown).collect()}


def test_reason_and_score_first_match(spark):
    rows = [
        tx_row("hi", "u", 5000.01, T0),
        tx_row("hi_fraud", "u", 9000.0, T0, is_fraud=True),    # amount rule wins
        tx_row("fraud", "u", 10.0, T0, is_fraud=True),
        tx_row("normal", "u", 10.0, T0),
        tx_row("edge", "u", 5000.0, T0),                        # strict >
    ]
    timed = to_event_time(tx_df(spark, rows))
    got = {r["transaction_id"]: (r["fraud_reason"], r["rule_score"])
           for r in immediate.score_immediate(timed).collect()}
    assert got == {
        "hi": ("HIGH_AMOUNT", 0.9), "hi_fraud": ("HIGH_AMOUNT", 0.9),
        "fraud": ("LABELED_FRAUD", 0.8), "normal": ("NORMAL", 0.1), "edge": ("NORMAL", 0.1),
    }
    assert set(_flags(spark, rows)) == {"hi", "hi_fraud", "fraud"}


def test_flag_columns_in_order(spark):
    timed = to_event_time(tx_df(spark, [tx_row("a", "u", 6000.0, T0)]))
    assert immediate.flag_immediate(timed).columns == [
        "transaction_id", "user_id", "amount", "currency", "merchant",
        "timestamp", "fraud_reason", "rule_score", "is_fraud"]


def test_null_and_nan_amounts(spark):
    schema = T.StructType([T.StructField("transaction_id", T.StringType()),
                           T.StructField("amount", T.DoubleType()),
                           T.StructField("is_fraud", T.BooleanType()),
                           T.StructField("user_id", T.StringType()),
                           T.StructField("currency", T.StringType()),
                           T.StructField("merchant", T.StringType()),
                           T.StructField("timestamp", T.LongType())])
    df = spark.createDataFrame([("null_fraud", None, True, "u", "USD", "m", T0),
                                ("null_ok", None, False, "u", "USD", "m", T0),
                                ("nan", float("nan"), False, "u", "USD", "m", T0),
                                ("inf", float("inf"), False, "u", "USD", "m", T0)], schema)
    timed = to_event_time(df)
    for push in (True, False):
        got = {r["transaction_id"]: r["fraud_reason"]
               for r in immediate.flag_immediate(timed, pushdown=push).collect()}
        assert got == {"null_fraud": "LABELED_FRAUD", "nan": "HIGH_AMOUNT", "inf": "HIGH_AMOUNT"}


def test_selects_equals_chain_on_random_rows(spark):
    """The pushable filter keeps exactly the rows the CASE chain keeps,
    including rule orders where a low score precedes a high one."""
    rnd = random.Random(7)
    vals = [None, float("nan"), -1.0, 0.0, 1.0, 2.0, 3.0, 5.0]
    rows = [(rnd.choice(vals), rnd.choice(vals), rnd.choice([None, True, False])) for _ in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, c boolean").withColumn("id", F.monotonically_increasing_id())
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    rule_sets = [
        RuleSet([(a > 2, 0.9), (c == True, 0.8)], 0.1),  # noqa: E712
        RuleSet([(a > 2, 0.2), (b > 1, 0.9), (c == True, 0.3)], 0.1),  # noqa: E712
        RuleSet([(a > 2, 0.2), (b > 1, 0.9)], 0.7),
        RuleSet([(a.isNull(), 0.1), (b < 3, 0.6)], 0.0),
    ]
    for rs in rule_sets:
        want = {r.id for r in df.filter(rs.chain() > 0.5).collect()}
        got = {r.id for r in df.filter(rs.selects(lambda s: s > 0.5)).collect()}
        assert got == want


def test_pushdown_reaches_parquet_scan(spark, scratch):
    rows = [tx_row(i, "u", float(i * 100), T0, is_fraud=(i % 7 == 0)) for i in range(100)]
    path = f"{scratch}/tx.parquet"
    tx_df(spark, rows).write.parquet(path)
    timed = to_event_time(spark.read.parquet(path))
    plan = immediate.flag_immediate(timed, pushdown=True)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThan(amount,5000.0),EqualTo(is_fraud,true))]" in plan
    assert (immediate.flag_immediate(timed, pushdown=True).count()
            == immediate.flag_immediate(timed, pushdown=False).count())


def test_event_time_truncates_toward_zero_and_ignores_zone(spark):
    df = spark.createDataFrame([(1700000000999,), (-1500,), (None,)], "timestamp long")
    for tz in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        got = [r[0] for r in to_event_time(df).select(F.unix_seconds("timestamp")).collect()]
        assert got == [1700000000, -1, None]
    # DST overlap: 1699165800 is 01:30 EST, a repeated local hour.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    one = spark.createDataFrame([(1699165800000,)], "timestamp long")
    assert to_event_time(one).select(F.unix_seconds("timestamp")).first()[0] == 1699165800
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_selects_equals_chain_for_generated_rule_tables(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    rnd = random.Random(3)
    vals = [None, float("nan"), -1.0, 0.0, 1.0, 2.0, 3.0, 5.0]
    rows = [(rnd.choice(vals), rnd.choice(vals), rnd.choice([None, True, False])) for _ in range(300)]
    df = (spark.createDataFrame(rows, "a double, b double, c boolean")
          .withColumn("id", F.monotonically_increasing_id()).cache())
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    preds = [a > 2, a < 1, b > 1, b.isNull(), c == True, (a > 0) & (b < 3), (a > 3) | c]  # noqa: E712
    rule = st.tuples(st.integers(0, len(preds) - 1), st.sampled_from([0.1, 0.3, 0.6, 0.9]))

    @settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(rule, min_size=0, max_size=5), st.sampled_from([0.0, 0.1, 0.7]))
    def check(table, default):
        rs = RuleSet([(preds[i], v) for i, v in table], default)
        want = {r.id for r in df.filter(rs.chain() > 0.5).select("id").collect()}
        got = {r.id for r in df.filter(rs.selects(lambda s: s > 0.5)).select("id").collect()}
        assert got == want

    check()
    df.unpersist()


def test_nan_rows_of_a_file_with_statistics_are_flagged(spark, scratch):
    """A writer that leaves NaN out of the row group's statistics: the default reads the group all the same."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from riskflow.functions.eventtime import to_event_time
    from riskflow.operators.immediate import flag_immediate
    from riskflow import schemas
    rows = {"transaction_id": ["x", "y"], "user_id": ["u", "u"], "amount": [1.0, float("nan")], "currency": ["USD"] * 2,
            "merchant": ["m"] * 2, "category": [None, None], "timestamp": [1000, 2000], "country": ["US"] * 2,
            "device_type": ["d"] * 2, "is_fraud": [False, False]}
    kinds = {"amount": pa.float64(), "timestamp": pa.int64(), "is_fraud": pa.bool_()}
    pq.write_table(pa.table({k: pa.array(v, kinds.get(k, pa.string())) for k, v in rows.items()}), f"{scratch}/nan.parquet")
    timed = to_event_time(spark.read.schema(schemas.TRANSACTION).parquet(f"{scratch}/nan.parquet"))
    flags = flag_immediate(timed).collect()
    assert [(r["transaction_id"], r["fraud_reason"]) for r in flags] == [("y", "HIGH_AMOUNT")]
