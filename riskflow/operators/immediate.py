"""Path 1: per-transaction threshold rules (no shuffle, one codegen stage).

``timed`` input = transaction columns with ``timestamp`` already event time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.config import DEFAULT, FraudConfig
from riskflow.functions.rules import RuleSet
from riskflow.schemas import FLAGGED_IMMEDIATE_COLUMNS  # noqa: F401 - re-exported


def reason_rules(cfg: FraudConfig = DEFAULT) -> RuleSet:
    return RuleSet([
        (F.col("amount") > cfg.high_amount, "HIGH_AMOUNT"),
        (F.col("is_fraud") == F.lit(True), "LABELED_FRAUD"),
    ], "NORMAL")


def score_rules(cfg: FraudConfig = DEFAULT) -> RuleSet:
    return RuleSet([
        (F.col("amount") > cfg.high_amount, cfg.high_amount_score),
        (F.col("is_fraud") == F.lit(True), cfg.labeled_fraud_score),
    ], cfg.normal_score)


def score_immediate(timed: DataFrame, cfg: FraudConfig = DEFAULT) -> DataFrame:
    """Add ``fraud_reason`` and ``rule_score`` to every transaction."""
    return (timed
            .withColumn("fraud_reason", reason_rules(cfg).chain())
            .withColumn("rule_score", score_rules(cfg).chain()))


def flag_immediate(timed: DataFrame, cfg: FraudConfig = DEFAULT, pushdown: bool = False) -> DataFrame:
    """Transactions whose rule score passes the flag threshold, 9 columns.

    With ``pushdown`` the score filter is restated on the raw columns
    (``amount > 5000 OR is_fraud = true`` for the default rules), so it
    reaches the parquet scan as a pushed filter and row groups whose
    statistics exclude it are skipped.  Only for files whose ``amount`` holds
    no NaN: NaN exceeds every limit, but some writers leave it out of a row
    group's statistics, and such a group would be skipped with its NaN rows.
    """
    thr = cfg.flag_threshold
    if pushdown:
        kept = timed.filter(score_rules(cfg).selects(lambda s: s > thr))
        return score_immediate(kept, cfg).select(*FLAGGED_IMMEDIATE_COLUMNS)
    return (score_immediate(timed, cfg)
            .filter(F.col("rule_score") > thr)
            .select(*FLAGGED_IMMEDIATE_COLUMNS))
