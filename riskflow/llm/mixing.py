"""Mixing sources to target weights by capped water-filling (operator 5).

Every step is a DataFrame expression.  Sizes are summed per source with
partial aggregation; sources are ranked by code point and given their weights;
the water level is raised round by round: sources whose share exceeds
``max_epochs`` times their size are clamped there and the excess is shared
again by weight among the rest, until no source is above its cap.  A round is
one aggregate over the table of sources and moves three numbers to the driver.

A source's epochs are target / size.  Each document is taken whole as often as
the epochs' integer part says; for the fraction, documents are taken once more
in the order of a seeded hash until the fraction of the source's words is
reached, and then the one remaining document whose size comes nearest to what
is still missing.  The order is cut in two levels: sums per hash bucket locate the
bucket where the target falls, and only that bucket is ranked, so a source
with a third of all rows is never sorted in one task.

Defined results: a null text has size 0; a null source comes last; rows alike
in every input are ranked by the seeded hash and interchangeable; a document
of size 0 takes 0 words; a source of size 0 has target 0; an empty input gives
no rows; other columns are kept out of the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm import common

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Hash buckets per source: the ranked share of a source is 1 in this many.
BUCKETS = 1024


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS, total: int | None = None) -> DataFrame:
    """``sources(source, weight, source_size)`` with ``target`` added.

    The targets share ``total`` words (default: all) by weight, none above
    ``max_epochs`` times its source's size."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    if total is None:
        total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, clamped = 0.0, -1
    while True:
        above = cap <= F.col("weight") * F.lit(level)
        row = sources.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("held"),
                          F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("open"),
                          F.count_if(above).alias("n")).first()
        if row["n"] == clamped or not row["open"]:
            break
        clamped = row["n"]
        level = max(0.0, (total - row["held"]) / row["open"])
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)).cast("double"))


def weigh_sources(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Sources by code point, null last, with the repeating weights.  The rank
    is counted in two levels, ranges of names and names within a range, so
    many sources are not sorted in one task either."""
    by_name = [F.col("source").isNull(), F.col("source").cast("binary")]
    ranged = common.stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
                           .repartitionByRange(*by_name).withColumn("range", F.spark_partition_id()), "mix-ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(     # one row a range
        "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("range").orderBy(*by_name)) - 1
    repeating = F.array(*[F.lit(int(w)) for w in weights])
    return (ranged.withColumn("nth", nth).join(before, "range")
            .select("source", "source_size", F.element_at(
                repeating, ((F.col("nth") + F.col("before")) % len(weights) + 1).cast("int")).alias("weight")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 42,
        buckets: int = BUCKETS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target,
    repeats (how often the mix takes it whole) and taken (= repeats x size)."""
    raw = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                      F.col(text_col).cast("string").alias("text"))
    sizes = common.stored(
        raw.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                   F.xxhash64(F.lit(seed), "doc_id", "source", "text").alias("order"))
        .withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    targets = common.stored(water_fill(common.stored(weigh_sources(sizes, weights), "mix-sources"),
                                       max_epochs), "mix-targets")
    plan = targets.select(
        "source", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("long").alias("whole"))
    plan = plan.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    rows = sizes.withColumn("bucket", F.pmod(F.col("order"), F.lit(buckets)))

    # Level 1: the bucket of each source in which the fraction's last word falls.
    in_order = Window.partitionBy("source").orderBy("bucket")
    sums = (rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
            .withColumn("upto", F.sum("words").over(in_order)))
    cut = (sums.join(plan, sums["source"].eqNullSafe(plan["source"]))
           .select(sums["source"], "bucket", "words", "upto", "rest")
           .filter(F.col("upto") > F.col("rest")).groupBy("source")
           .agg(F.min_by(F.struct("bucket", (F.col("rest") - (F.col("upto") - F.col("words"))).alias("left")),
                         "bucket").alias("cut")))
    plan = common.stored(
        plan.join(cut.withColumnRenamed("source", "cut_source"),
                  F.col("source").eqNullSafe(F.col("cut_source")), "left")
        .select("source", "source_size", "target", "whole", "rest",
                F.coalesce("cut.bucket", F.lit(buckets)).alias("cut_bucket"),
                F.coalesce("cut.left", F.lit(0.0)).alias("left")), "mix-plan")
    with_plan = rows.join(plan.withColumnRenamed("source", "plan_source"),
                          F.col("source").eqNullSafe(F.col("plan_source"))).drop("plan_source")

    # Level 2: rank that bucket alone.
    ranked = Window.partitionBy("source").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, 0)
    shape = ["row", "doc_id", "source", "size", "source_size", "target", "whole", "left", "order"]
    edge = (with_plan.filter(F.col("bucket") == F.col("cut_bucket"))
            .withColumn("upto", F.sum("size").over(ranked))
            .withColumn("extra", (F.col("upto") <= F.col("left")).cast("long")))
    below = with_plan.filter(F.col("bucket") != F.col("cut_bucket")).withColumn(
        "extra", (F.col("bucket") < F.col("cut_bucket")).cast("long"))
    taken = common.stored(below.select(*shape, "extra", F.lit(0).cast("long").alias("upto"))
                          .unionByName(edge.select(*shape, "extra", "upto")), "mix-taken")

    # What is still missing goes to the one document left whose size comes nearest.
    gaps = (taken.groupBy(F.col("source").alias("gap_source"))
            .agg((F.first("left") - F.max(F.col("upto") * F.col("extra"))).alias("gap")).filter("gap > 0"))
    off = F.abs(F.col("size") - F.col("gap"))
    pick = (taken.filter("extra = 0").join(common.stored(gaps, "mix-gaps"),
                                           F.col("source").eqNullSafe(F.col("gap_source")))
            .filter(off < F.col("gap")).groupBy("source")
            .agg(F.min(F.struct(off.alias("off"), "order", "row")).alias("best")).select("best.row"))
    pick = pick.withColumn("picked", F.lit(1).cast("long"))
    return (taken.join(pick, "row", "left")
            .withColumn("repeats", F.col("whole") + F.col("extra") + F.coalesce("picked", F.lit(0)))
            .select("doc_id", "source", "size", "source_size", "target", "repeats",
                    (F.col("repeats") * F.col("size")).alias("taken")))
