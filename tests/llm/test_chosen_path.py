"""Operator 12 against the Jaccard similarity of all pairs."""

import random

import numpy as np
import pytest

from riskflow.llm import chosen_path
from riskflow.llm.chosen_path import Shingles, linked, minhash_dedup, minwise, near, spread_join


def plain_set(text, shingle=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) <= shingle:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + shingle]) for i in range(len(words) - shingle + 1)}


def plain(rows, similarity=85):
    sets = [plain_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= similarity * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (n, _) in enumerate(rows):
        if n is not None:
            least[root(i)] = min(n, least.get(root(i), n))
    out = []
    for i, (n, _) in enumerate(rows):
        c = least.get(root(i)) if sets[i] else n
        out.append((n, len(sets[i]), c, n == c))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        at = rng.randrange(len(words))
        if rng.random() < 0.5:
            words[at] = f"w{rng.randrange(10_000)}"
        else:
            del words[at]
    return words


def corpus(seed, groups=25, copies=8, length=150, changes=5):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(20, length))]
        for _ in range(rng.randrange(1, copies)):
            rows.append((len(rows) * 3 % 1009, " ".join(edited(rng, base, rng.randrange(changes)))))
    return rows


def test_random_groups(spark):
    rows = corpus(1)
    want = plain(rows)
    assert got(minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"))) == want
    assert 10 < sum(not kept for *_, kept in want)


@pytest.mark.parametrize("small", [2, 6])
def test_large_nodes_branch_and_are_dealt_into_blocks(spark, small):
    """Near copies that chains only link: nodes stay large at every level."""
    rng = random.Random(7)
    words = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = edited(rng, words, 1 + (i % 9 == 0) * 6)
    rows += [(100 + n, t) for n, t in corpus(2, groups=5)]
    assert got(minhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"), small=small, levels=2)) == plain(rows)


ODD = [(1, "a b c d e f g"), (2, "A  B\tC d\ne f g"), (1, "a b c d e f g"), (None, "a b c d e f g"), (None, "x y"), (3, "x y"),
       (4, "X Y "), (5, "y x"), (6, None), (7, ""), (8, " \r\n"), (9, "one"), (10, "É\xa0e a b c d e"), (11, "é\xa0e a b c d e"),
       (None, "lonely text of its own with words"), (None, None), (12, "a a a a a a a a a a"), (13, "a a a a a"), (14, "a a a a")]


def test_odd_rows(spark):
    assert got(minhash_dedup(spark.createDataFrame(ODD, "doc_id long, text string"))) == plain(ODD)


def test_other_columns_and_names(spark):
    rows = [(*r, "s", "t", 1, b"u") for r in ODD]
    docs = spark.createDataFrame(rows, "`my.id` long, `the text` string, set string, node string, _salt int, u binary")
    assert got(minhash_dedup(docs, "my.id", "the text")) == plain(ODD)


def test_empty_table(spark):
    assert minhash_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_threshold_is_exact():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 1 << 63, 100, dtype=np.uint64) * np.uint64(2))
    assert linked([a, a[:85]], matches=0) == [(0, 1)] and linked([a, a[:84]], matches=0) == []


def test_links_of_a_node_against_all_pairs():
    rng = np.random.default_rng(2)
    for labelled in (False, True):
        base = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2))
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(150, 200), replace=False),
                                          rng.integers(0, 1 << 63, rng.integers(0, 20), dtype=np.uint64) * np.uint64(2)]))
                for _ in range(60)]
        labels = [str(i % 20) if i % 3 else str(i) for i in range(60)] if labelled else None
        want, got_ = list(range(60)), list(range(60))

        def join(c, i, j):
            c[:] = [c[i] if x == c[j] else x for x in c]
        for i in range(60):
            for j in range(i):
                if labels and labels[i] == labels[j]:
                    join(want, i, j), join(got_, i, j)
                n = len(np.intersect1d(sets[i], sets[j]))
                if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                    join(want, i, j)
        pairs = linked(sets, labels)
        for i, j in pairs:
            assert got_[i] != got_[j]       # a forest
            join(got_, i, j)
        assert [[x == y for y in want] for x in want] == [[x == y for y in got_] for x in got_]


def test_minwise_tokens_estimate_similarity():
    rng = np.random.default_rng(5)
    for n in (8, 40, 900):
        off = []
        for _ in range(40):
            pool = np.unique(rng.integers(0, 1 << 63, n * 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            rng.shuffle(pool)
            a, b = np.sort(pool[:n]), np.sort(pool[n // 8:n])
            off.append((minwise(a) == minwise(b)).mean() - len(b) / len(a))
        assert abs(np.mean(off)) < 0.04 and np.min(off) > -0.2


def test_pairs_at_the_threshold_pass_the_count_of_tokens():
    rng = np.random.default_rng(6)
    for n in (20, 100, 1000):
        for _ in range(100):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            b = np.sort(rng.choice(a, int(np.ceil(0.85 * len(a))), replace=False))
            tokens = np.stack([minwise(a), minwise(b)])
            assert len(near(np.array([len(a), len(b)]), tokens, 0, np.array([1]), 85, chosen_path.MATCHES)) == 1


def test_trees_find_pairs_at_the_threshold():
    """Recall of the branching alone, at the first level, against all pairs."""
    rng = np.random.default_rng(8)
    missed = 0
    for _ in range(400):
        a = np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64) * np.uint64(2))
        b = np.sort(rng.choice(a, 170, replace=False))
        missed += not (chosen_path.root_nodes(minwise(a)) == chosen_path.root_nodes(minwise(b))).any()
    assert missed == 0


def test_shingles_count():
    make = Shingles()
    for _, text in ODD:
        assert len(make((text or "").encode())) == len(plain_set(text))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join(spark, how):
    left = spark.createDataFrame([(i % 3 if i < 90 else i, i) for i in range(100)], "k long, x long")
    right = spark.createDataFrame([(i, f"r{i}") for i in range(95)], "k long, y string")
    want = sorted(map(tuple, left.join(right, "k", how).select("k", "x", "y").collect()), key=str)
    for per in (7, 1000):
        assert sorted(map(tuple, spread_join(left, right, "k", how, per).select("k", "x", "y").collect()), key=str) == want
