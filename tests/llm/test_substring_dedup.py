import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from riskflow.llm import substring_dedup as sd
from riskflow.llm.bwt_merge import repeated
from tests.llm.conftest import ODD_ROWS


def brute(rows):
    """By comparing all windows, in the order of the rows."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - 99):
            window = data[at:at + 100]
            if window in seen:
                gone[at:at + 100] = True
            seen.add(window)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((doc_id, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def sample(n, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé\0", k=rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 40)))
                 for _ in range(rng.randint(0, 6))]
        if i % 9 == 0:
            parts.append("ab" * rng.randint(0, 120))
        if i % 10 == 3 and rows:
            parts = [rows[rng.randrange(len(rows))][1]]
        rows.append((i, " ".join(parts)))
    return rows


def result(df):
    return sorted(tuple(r)[:5] for r in df.collect())


@pytest.mark.parametrize("seed,buckets,hot", [(1, 1, sd.HOT), (2, 5, sd.HOT), (4, 3, 1), (5, 4, 3)])
def test_against_brute_force(docs_of, seed, buckets, hot):
    rows = sample(120, seed)
    assert result(sd.remove_repeats(docs_of(rows), buckets=buckets, hot=hot)) == brute(rows)


def test_a_line_in_every_document(docs_of):
    """One line with other text around it in each document, over and under the hot limit."""
    rng = random.Random(3)
    line = " ".join("".join(rng.choices("abcdefg", k=7)) for _ in range(12))
    rows = [(i, f"{rng.random()} {line[:90 + i % 9]} {rng.random()} " + "x" * (i % 40) * 5) for i in range(90)]
    for hot in (10, 1000):
        assert result(sd.remove_repeats(docs_of(rows, 5), buckets=3, hot=hot)) == brute(rows)


def test_texts_cut_into_slices(docs_of, monkeypatch):
    monkeypatch.setattr(sd, "SLICE", 150)
    rows = [(k, t.encode()) for k, t in sample(40, 3)]
    pieces = list(sd._slices([(k, 0, t) for k, t in rows]))
    whole = defaultdict(set)
    for group in pieces:
        for r in sd._table(group):
            for w in range(r["windows"]):
                whole[int(r["doc"])].add(int(r["start"]) + w)
    assert whole == {k: set(range(len(t) - 99)) for k, t in rows if len(t) >= 100}


def test_equal_windows_have_equal_anchors():
    rng = random.Random(8)
    text = bytes(rng.choices(b"abc", k=60)) * 5
    first, windows, anchor, hashes = sd.segments(np.frombuffer(text, np.uint8), np.array([len(text)]))
    at = {}
    for f, n, a, h in zip(first, windows, anchor, hashes, strict=True):
        for w in range(f, f + n):
            assert at.setdefault(text[w:w + 100], (a - w, h)) == (a - w, h)


def test_merge_by_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        strings = [bytes(rng.choices(b"ab", k=rng.randint(0, 30))) for _ in range(rng.randint(1, 20))]
        want, got = defaultdict(set), defaultdict(set)
        for i, s in enumerate(strings):
            for o in range(len(s) - 7):
                want[s[o:o + 8]].add((i, o))
        for s, o, b in zip(*map(np.ndarray.tolist, repeated(strings, 8, shard=rng.choice([1, 3, 64]))), strict=True):
            got[b].add((s, o))
        assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values() if len(v) > 1}


def test_odd_rows(odd_docs, clashing):
    order = sorted(ODD_ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    want = {(r[1], r[2]) for r in brute([(r[0], r[1]) for r in order])}
    for docs in (odd_docs, clashing):
        out = sd.remove_repeats(docs, buckets=3).collect()
        assert len(out) == len(ODD_ROWS)
        assert {(r["n_bytes"], r["n_removed"]) for r in out} == want
        assert all(sum(r["spans"][1::2]) - sum(r["spans"][::2]) == r["n_removed"] for r in out)


def test_repeated_rows_stay_once(docs_of):
    text = "".join(random.Random(2).choices("abcdefgh ", k=300))
    out = sorted(r["n_removed"] for r in sd.remove_repeats(docs_of([(4, text)] * 3), buckets=2).collect())
    assert out == [0, 300, 300]


def test_empty_table(docs_of):
    assert sd.remove_repeats(docs_of([])).collect() == []


def test_null_ids_whose_texts_clash_in_32_bits_keep_their_bytes(spark, docs_of):
    """Rows without an id are told apart by more than Spark's 32-bit hash."""
    from pyspark.sql import functions as F
    made = spark.range(120_000).select(F.sha2(F.col("id").cast("string"), 512).alias("h"))
    made = made.select(F.concat("h", F.sha2("h", 256)).alias("t")).withColumn("k", F.hash("t"))
    pair = made.groupBy("k").agg(F.collect_list("t").alias("ts")).filter(F.size("ts") > 1).first()
    assert pair is not None
    got = sd.remove_repeats(docs_of([(None, t) for t in pair["ts"]])).collect()
    assert [(r["n_bytes"], r["n_removed"]) for r in got] == [(192, 0)] * len(pair["ts"])
