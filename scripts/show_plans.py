"""Summarise the physical plan of every registered query (writes PLANS.md).

    python scripts/show_plans.py [sf_dir] > PLANS.md

For each query: shuffle exchanges, Python stages, joins/broadcasts, and
every parquet scan's read schema and pushed filters, taken from the
executed plan (the stream queries show the plan of reading their output).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict:
    scans = []
    for m in re.finditer(r"FileScan parquet \[(?P<cols>[^\]]*)\].*?PushedFilters: \[(?P<pf>[^\]]*)\]", plan):
        cols = [c.split("#")[0] for c in m.group("cols").split(",") if c]
        scans.append((cols, m.group("pf")))
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|SinglePartition|RoundRobin|rangepartitioning)", plan)),
        "hash_keys": sorted({re.sub(r"#\d+", "", k) for k in re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)}),
        "python": len(re.findall(r"MapInArrow|MapInPandas|ArrowEvalPython|BatchEvalPython", plan)),
        "joins": len(re.findall(r"Join|CartesianProduct|BroadcastExchange", plan)),
        "subqueries": len(re.findall(r"Subquery subquery", plan)) // 2 or len(re.findall(r"Subquery subquery", plan)),
        "scans": scans,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from riskflow.plans import catalog

    print("# Physical plans of the registered queries\n")
    print(f"Generated by `scripts/show_plans.py` on `{sf_dir}` (local[8], 16 shuffle partitions, AQE on).")
    print("Exchanges counts shuffles in the main plan and its subqueries; `python` counts Arrow-batched")
    print("Python stages. Scans list the columns read and the filters pushed into parquet.")
    print("No query but the `stream_*` ones writes anything before its plan runs.\n")
    print("| query | exchanges (keys) | python | joins | scans: columns read / pushed filters |")
    print("| --- | --- | --- | --- | --- |")
    for name, fn in catalog.queries().items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        keys = "; ".join(s["hash_keys"]) if s["hash_keys"] else ""
        scans = "<br>".join(f"{','.join(c)} / [{pf}]" for c, pf in s["scans"]) or "—"
        print(f"| `{name}` | {s['exchanges']}{' (' + keys + ')' if keys else ''} | {s['python']} | "
              f"{s['joins']} | {scans} |")
    stream_section(spark)
    spark.stop()


def stream_section(spark) -> None:
    """Executed plans of the two streaming queries (last micro-batch with data)."""
    from riskflow import workspace
    from riskflow.config import DEFAULT
    from riskflow.operators import ingest
    from riskflow.sources.fixtures import read_transactions
    from riskflow.sources.topic import FileTopic, produce
    from riskflow.streaming.pipeline import start_pipeline
    from riskflow.streaming.sinks import TopicSink

    run = workspace.new_run(spark, "plans")
    raw = FileTopic(run, "raw")
    produce(ingest.to_wire(read_transactions(spark, "/root/testdata/sf0.001")), raw)
    p = start_pipeline(raw.read_stream(spark), TopicSink(FileTopic(run, "flagged")), f"{run}/ck", DEFAULT,
                       trigger={"availableNow": True}, name_suffix="-plans", state_partitions=8)
    p.await_termination()
    print("\n## Streaming queries\n")
    print("Plans of the two streaming queries' micro-batches (sf0.001 raw topic, 8 state partitions).\n")
    print("| query | exchanges (keys) | state store ops | python | joins |")
    print("| --- | --- | --- | --- | --- |")
    for name, q in p.queries.items():
        plan = q._jsq.streamingQuery().lastExecution().executedPlan().toString()  # noqa: SLF001
        s = summarize(plan)
        state = len(re.findall(r"StateStoreRestore|StateStoreSave", plan))
        keys = "; ".join(s["hash_keys"])
        print(f"| `{name}` | {s['exchanges']}{' (' + keys + ')' if keys else ''} | {state} | "
              f"{s['python']} | {s['joins']} |")


if __name__ == "__main__":
    main(sys.argv)
