import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskflow.llm.mixing import mix, water_fill, weigh_sources


def fill(sizes, weights, epochs):
    """Capped water-filling by brute force."""
    total, held = sum(sizes), set()
    while True:
        rest = total - sum(epochs * sizes[i] for i in held)
        open_ = [i for i in range(len(sizes)) if i not in held]
        level = rest / sum(weights[i] for i in open_) if open_ else 0
        over = {i for i in open_ if weights[i] * level >= epochs * sizes[i]}
        if not over:
            return [epochs * sizes[i] if i in held else weights[i] * level for i in range(len(sizes))]
        held |= over


def rows_of(n=900):
    names = ["b", "a", "ä", None, "A"]
    return [(i, "w " * (1 + i * 7 % 40), names[0 if i % 3 == 0 else i % 5]) for i in range(n)] + [
        (n, "lone words here", "tiny"), (n + 1, None, "void"), (n + 2, "", "void")]


def test_targets_and_taken(docs_of):
    rows = rows_of()
    out = mix(docs_of(rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = dict(zip(names, fill([sizes[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 3), strict=True))
    assert len(out) == len(rows)
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["repeats"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    largest = 40
    for s in names:
        assert abs(taken[s] - want[s]) <= largest / 2 + 1


def test_reruns_agree_and_seed_matters(docs_of):
    docs = docs_of(rows_of(300))
    key = lambda df: sorted((r["doc_id"], r["taken"]) for r in df.collect())
    assert key(mix(docs)) == key(mix(docs.repartition(5)))
    assert key(mix(docs)) != key(mix(docs, seed=43))


def test_few_buckets_give_the_same_targets(docs_of):
    out = mix(docs_of(rows_of(200)), buckets=2).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w"))
    assert all(abs(r["t"] - r["w"]) <= 21 for r in out.collect())


def test_odd_rows(odd_docs, clashing):
    for docs in (odd_docs, clashing):
        out = mix(docs).collect()
        assert len(out) == docs.count()
        assert all(r["taken"] == 0 for r in out if r["size"] == 0)


def test_empty_table(docs_of):
    assert mix(docs_of([])).collect() == []


def test_water_fill_clamps_in_rounds(spark):
    sources = spark.createDataFrame([("a", 1, 10), ("b", 5, 40), ("c", 5, 400), ("d", 1, 0)],
                                    "source string, weight int, source_size long")
    got = [r["target"] for r in water_fill(sources, 2).orderBy("source").collect()]
    assert got == pytest.approx(fill([10, 40, 400, 0], [1, 5, 5, 1], 2))


def test_many_sources_are_ranked_by_code_point(spark):
    names = [None, "", *{f"{c}{i}" for i in range(60) for c in "aAzé日\U0001F600"}]
    sizes = spark.createDataFrame([(n, 1) for n in names], "source string, size long")
    got = {r["source"]: r["weight"] for r in weigh_sources(sizes).collect()}
    order = sorted((n for n in names if n is not None)) + [None]
    assert got == {n: (5, 2, 1)[i % 3] for i, n in enumerate(order)}


def test_plan_runs_no_python(docs_of):
    plan = mix(docs_of(rows_of(50)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
