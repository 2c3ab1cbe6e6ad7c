"""Operator 13 against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import hard_negatives
from riskflow.llm.hard_negatives import Tree, bounds, dots, mine, str_order

SHAPE = "vec_id long, embedding array<float>, label int"


def plain(rows, chosen, positives=5, negatives=10, low=30, high=90):
    """rows: (id, components, label); every pair scored."""
    good = []
    for vec_id, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        good.append((vec_id, [math.floor(256 * float(np.float32(c))) for c in x], label))
    out = []

    def dot(a, b):
        return sum(p * q for p, q in zip(a, b, strict=False))

    def order(pair):
        score, vec_id = pair
        return -score, vec_id is None, vec_id or 0
    for i, (a_id, a, label) in enumerate(good):
        if a_id is None or not chosen(a_id):
            continue
        same = sorted(((dot(a, x), n) for j, (n, x, other) in enumerate(good) if j != i and other == label), key=order)
        others = sorted(((dot(a, x), n) for n, x, other in good if other != label), key=order)
        for p_score, p in same[:positives]:
            fit = [(s, n) for s, n in others if low * p_score <= 100 * s <= high * p_score][:negatives]
            out += [(a_id, p, rank, n, p_score, s) for rank, (s, n) in enumerate(fit, 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                                               "negative_score").collect()), key=str)


def random_rows(n, width=8, seed=1, ties=False):
    rng = random.Random(seed)

    def c():
        return rng.choice([-0.25, 0.0, 0.25]) if ties else rng.gauss(0, 0.3)
    return [(i, [c() for _ in range(width)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("tile_rows", [40, 65_536])
def test_against_all_pairs(spark, monkeypatch, ties, tile_rows):
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", 8)
    monkeypatch.setattr(hard_negatives, "FAN", 3)
    rows = random_rows(400, ties=ties)
    table = spark.createDataFrame(rows, SHAPE)
    want = plain(rows, lambda i: i % 10 == 0)
    assert got(mine(table, F.col("vec_id") % 10 == 0, tile_rows=tile_rows, block=7)) == want
    assert len(want) > 100


ODD = [(0, [0.5, 0.5, 0.0], 1), (1, [0.5, 0.4, 0.0], 1), (1, [0.5, 0.4, 0.0], 1), (2, [0.4, 0.1, 0.0], 2),
       (2, [0.4, 0.1, 0.0], 2), (None, [0.4, 0.1, 0.0], 2), (3, None, 1), (4, [0.1, None, 0.3], 2), (5, [float("nan")] * 3, 2),
       (6, [float("inf"), 0.0, 0.0], 2), (7, [0.3, 0.2, 0.1], None), (8, [0.2], 2), (9, [], 2), (10, [-0.5, -0.5, 0.0], 3),
       (20, [0.0, 0.0, 0.0], 5), (30, [0.3, 0.0, 0.0], 6), (31, [-0.3, 0.0, 0.0], 6), (0, [0.5, 0.5, 0.0], 1)]


def test_odd_rows(spark):
    table = spark.createDataFrame(ODD, SHAPE)
    assert got(mine(table, F.col("vec_id") % 10 == 0)) == plain(ODD, lambda i: i % 10 == 0)


def test_other_columns_and_names(spark):
    rows = [(*r, "t", 1, 2) for r in ODD]
    table = spark.createDataFrame(rows, "`my.id` long, `the vec` array<float>, `c l` int, row string, anchor int, x int")
    assert got(mine(table, F.col("`my.id`") % 10 == 0, "my.id", "the vec", "c l")) == plain(ODD, lambda i: i % 10 == 0)


def test_components_too_large_take_no_part(spark):
    rows = [*ODD, (40, [1e30, 0.0, 0.0], 1)]
    assert got(mine(spark.createDataFrame(rows, SHAPE), F.col("vec_id") % 10 == 0)) == plain(ODD, lambda i: i % 10 == 0)


def test_empty_table_and_no_anchors(spark):
    assert got(mine(spark.createDataFrame([], SHAPE), F.col("vec_id") % 10 == 0)) == []
    assert got(mine(spark.createDataFrame(ODD, SHAPE), F.lit(False))) == []


def test_large_exact_scores():
    a = np.array([[1 << 27, -(1 << 27), 3]])
    b = np.array([[1 << 27], [5], [7]])
    assert dots(a, b)[0, 0] == (1 << 54) - 5 * (1 << 27) + 21


def test_bounds_hold():
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (200, 6))
    order = str_order(x, 16)
    assert sorted(order.tolist()) == list(range(200))
    for part in np.array_split(x[order], 12):
        low, high = part.min(0)[None], part.max(0)[None]
        q = rng.integers(-50, 50, (30, 6))
        least, greatest = bounds(q, low, high)
        scores = q @ part.T
        assert (least[:, 0] <= scores.min(1)).all() and (greatest[:, 0] >= scores.max(1)).all()


def test_search_opens_few_boxes_when_they_part_well():
    rng = np.random.default_rng(4)
    x = rng.integers(-1000, 1000, (20_000, 2))
    n = len(x)
    tree = Tree(np.arange(n), np.arange(n), np.ones(n, bool), np.zeros(n, np.int64), x.astype(np.int32))
    q = np.array([[3, 1]])
    opened = []

    def scores(leaf):
        opened.append(leaf)
        return dots(tree.vectors[tree.leaf(leaf)], q.T)[:, 0]
    found = tree.first(0, tree.bounds(q), scores, lambda here: np.ones(here.stop - here.start, bool), 5, -(1 << 62), 1 << 62)
    best = sorted((-int(v), False, i, i) for i, v in enumerate(x @ q[0]))[:5]
    assert found == best and len(opened) < len(tree.levels[0][0]) / 4


def test_query_against_all_pairs(spark, tmp_path):
    from riskflow.llm.queries import op13_hard_negatives
    rows = [(i, x, label % 10) for i, x, label in random_rows(600, seed=8)] + [(None, [0.1] * 8, 3), (700, None, 2)]
    spark.createDataFrame(rows, SHAPE).write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, x, (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, x, label in rows]
    assert got(op13_hard_negatives(spark, str(tmp_path))) == plain(moved, lambda i: i % 100 == 0)
