"""Path 2: per-user sliding-window velocity features and window flags.

Physical shape (batch and stream alike): ``Expand`` puts each row into its 4
overlapping windows, a partial hash aggregate combines map-side, and only one
row per (window, user) and map task crosses the shuffle on
``hashpartitioning(window, user_id)``.  Because the key includes the window,
a user with a third of all rows is still spread over all its windows, and the
partial aggregate bounds what any single (window, user) can send.

``strategy="panes"`` is the alternative plan: aggregate 30-second panes per
user first, then combine 4 panes per window (sums, counts and max add up;
avg is the sum over the count of non-null amounts).  It trades the 4x Expand for a second, smaller shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.config import DEFAULT, FraudConfig
from riskflow.functions.rules import RuleSet
from riskflow.schemas import FEATURE_COLUMNS, FLAGGED_WINDOWED_COLUMNS


def _interval(text: str) -> Column:
    return F.expr(f"INTERVAL {text}")


def _parse_seconds(text: str) -> int:
    n, unit = text.split()
    unit = unit.lower().rstrip("s")
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]
    return int(float(n) * scale)


def _aggregates() -> list[Column]:
    return [
        F.sum("amount").alias("window_amount"),
        F.count(F.lit(1)).alias("window_count"),
        F.avg("amount").alias("avg_amount"),
        F.max("amount").alias("max_amount"),
    ]


def _velocity(cfg: FraudConfig) -> Column:
    return F.col("window_amount") / F.lit(cfg.window_minutes)


def velocity_features(timed: DataFrame, cfg: FraudConfig = DEFAULT,
                      strategy: str = "expand", extra: list[Column] | None = None) -> DataFrame:
    """(window, user_id) -> window_amount, window_count, avg_amount,
    max_amount, velocity.  ``timed.timestamp`` must be a timestamp column.
    ``extra``: more aggregates of the expand strategy, with their names."""
    extra = extra or []
    if extra and strategy != "expand":
        raise ValueError("more aggregates need the expand strategy")
    if strategy == "expand":
        out = (timed
               .groupBy(F.window("timestamp", cfg.window_duration, cfg.slide_duration).alias("window"),
                        "user_id")
               .agg(*_aggregates(), *extra))
    elif strategy == "panes":
        out = _features_by_panes(timed, cfg)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    more = [c for c in out.columns if c not in FEATURE_COLUMNS] if extra else []
    out = out.withColumn("velocity", _velocity(cfg))
    return out.select(*FEATURE_COLUMNS, *more)


def _features_by_panes(timed: DataFrame, cfg: FraudConfig) -> DataFrame:
    slide = _parse_seconds(cfg.slide_duration)
    size = _parse_seconds(cfg.window_duration)
    if size % slide:
        raise ValueError("pane strategy needs the window length to be a multiple of the slide")
    n = size // slide
    secs = F.unix_seconds(F.col("timestamp"))
    panes = (timed
             .filter(F.col("timestamp").isNotNull())
             .withColumn("_pane", secs - F.pmod(secs, F.lit(slide)))
             .groupBy("_pane", "user_id")
             .agg(F.sum("amount").alias("_s"), F.count(F.lit(1)).alias("_c"),
                  F.count("amount").alias("_n"), F.max("amount").alias("_m")))
    starts = F.transform(F.sequence(F.lit(0), F.lit((n - 1) * slide), F.lit(slide)),
                         lambda k: F.col("_pane") - k)
    expanded = panes.select("*", F.explode(starts).alias("_start"))
    aggs = [F.sum("_s").alias("window_amount"), F.sum("_c").alias("window_count"),
            # avg ignores null amounts, like ``avg`` in the expand plan
            F.try_divide(F.sum("_s"), F.sum("_n")).alias("avg_amount"), F.max("_m").alias("max_amount")]
    out = expanded.groupBy("_start", "user_id").agg(*aggs)
    window = F.struct(F.timestamp_seconds("_start").alias("start"),
                      F.timestamp_seconds(F.col("_start") + F.lit(size)).alias("end"))
    return out.withColumn("window", window).drop("_start")


def reason_rules(cfg: FraudConfig = DEFAULT) -> RuleSet:
    v, c, a = F.col("velocity"), F.col("window_count"), F.col("avg_amount")
    return RuleSet([
        (v > cfg.velocity_high, "HIGH_VELOCITY"),
        (c > cfg.count_rapid, "RAPID_TRANSACTIONS"),
        (a > cfg.avg_high, "HIGH_AVERAGE"),
    ], "PATTERN_DETECTED")


def score_rules(cfg: FraudConfig = DEFAULT) -> RuleSet:
    v, c, a = F.col("velocity"), F.col("window_count"), F.col("avg_amount")
    s1, s2, s3, s0 = cfg.windowed_scores
    return RuleSet([
        (v > cfg.velocity_very_high, s1),
        ((v > cfg.velocity_high) | (c > cfg.count_very_rapid), s2),
        ((v > cfg.velocity_medium) | (c > cfg.count_rapid) | (a > cfg.avg_high), s3),
    ], s0)


def score_windowed(features: DataFrame, cfg: FraudConfig = DEFAULT) -> DataFrame:
    return (features
            .withColumn("fraud_reason", reason_rules(cfg).chain())
            .withColumn("rule_score", score_rules(cfg).chain()))


def flag_windowed(features: DataFrame, cfg: FraudConfig = DEFAULT) -> DataFrame:
    """Windows whose score passes the threshold; 9 columns, window nested."""
    return (score_windowed(features, cfg)
            .filter(F.col("rule_score") > cfg.flag_threshold)
            .select(*FLAGGED_WINDOWED_COLUMNS))


def watermark_of(timed: DataFrame, cfg: FraudConfig = DEFAULT) -> Column:
    """Final watermark of a batch as a scalar subquery (max event time -
    delay).  One aggregate job, nothing collected to the driver."""
    return timed.select(F.max("timestamp") - _interval(cfg.watermark_delay)).scalar()


def closed_windows(features: DataFrame, watermark: Column) -> DataFrame:
    """Batch equal of append-mode output: windows whose end the watermark has
    reached (``end <= watermark``, equality included)."""
    return features.filter(F.col("window.end") <= watermark)


def closed_velocity_features(timed: DataFrame, cfg: FraudConfig = DEFAULT,
                             strategy: str = "expand") -> DataFrame:
    """Velocity features of closed windows only.

    The watermark is a scalar subquery over the event-time column alone (a
    pruned scan and a partial max, no shuffle of any size), and the
    ``window.end <= watermark`` filter is on a grouping key, so Catalyst moves
    it below the aggregate: windows that are still open never reach the
    shuffle.

    The subquery reads ``timed`` a second time.  From parquet that is one
    pruned column; when ``timed`` is expensive to recompute (decoded from
    wire messages by the Python fallback, which cannot prune), write it to a
    table under the shared checkpoint folder first and pass the re-read table.
    """
    return closed_windows(velocity_features(timed, cfg, strategy), watermark_of(timed, cfg))
