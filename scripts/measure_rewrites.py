"""Time the optional plan rewrites (R1 filter restatement, R2 pane windows).

    python scripts/measure_rewrites.py [sf_dir] [copies]

``copies`` > 1 replicates the fixture (new user ids and shifted times per
copy, via ``explode(sequence)``) to see how a plan behaves on more rows.
Writes its inputs under the session's checkpoint folder; prints JSON.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def timed_run(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    copies = int(argv[2]) if len(argv) > 2 else 1
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from riskflow import workspace
    from riskflow.functions.eventtime import to_event_time
    from riskflow.operators import immediate, velocity
    from riskflow.sources.fixtures import read_transactions

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    tx = read_transactions(spark, sf_dir)
    if copies > 1:
        c = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy")
        tx = (tx.select("*", c)
              .withColumn("user_id", F.concat(F.col("user_id"), F.lit("-"), F.col("_copy").cast("string")))
              .withColumn("timestamp", F.col("timestamp") + F.col("_copy") * F.lit(3_000_000))
              .drop("_copy"))
    path = workspace.new_run(spark, "rewrites") + "/transactions"
    tx.write.option("parquet.block.size", 1 << 20).parquet(path)
    stored = spark.read.parquet(path)
    timed = to_event_time(stored)
    rows = stored.count()

    out = {"rows": rows}
    for _ in range(2):   # second round is the warm one
        out["R1_on"] = timed_run(immediate.flag_immediate(timed, pushdown=True))
        out["R1_off"] = timed_run(immediate.flag_immediate(timed, pushdown=False))
        out["R2_expand"] = timed_run(velocity.velocity_features(timed, strategy="expand"))
        out["R2_panes"] = timed_run(velocity.velocity_features(timed, strategy="panes"))
        out["closed_flags"] = timed_run(velocity.flag_windowed(velocity.closed_velocity_features(timed)))
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv)
