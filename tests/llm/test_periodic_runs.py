"""Operator 11 against runs found by definition."""

import hashlib
import random
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import periodic_runs
from riskflow.llm.periodic_runs import collapsed, find_runs, lyndon_lengths, stretch_runs, strongest, text_runs


def runs_by_definition(word, min_length=6, min_exponent=4):
    n, out, spans = len(word), set(), {}
    for q in range(1, n // 2 + 1):
        s = 0
        while s + q < n:
            e = s
            while e + q < n and word[e] == word[e + q]:
                e += 1
            if e - s >= q:              # [s, e + q) has period q
                spans.setdefault((s, e + q), q)     # the smallest period comes first
            s = max(e, s) + 1
    for (s, e), q in spans.items():
        if e - s >= max(min_length, min_exponent * q):
            out.add((s, e - s, q))
    return out


def longest_lyndon(word):
    out = []
    for i in range(len(word)):
        j = i + 1
        while j < len(word) and word[i:] < word[j:]:
            j += 1
        out.append(j - i)
    return out


words = st.lists(st.integers(0, 2), max_size=40)


@given(words)
@settings(max_examples=300, deadline=None)
def test_lyndon_lengths(word):
    assert lyndon_lengths(word) == longest_lyndon(word)


@given(words, st.sampled_from([(6, 4), (2, 2), (6, 3), (1, 2), (9, 5)]))
@settings(max_examples=300, deadline=None)
def test_runs(word, strength):
    assert stretch_runs(np.array(word, np.int64), *strength) == runs_by_definition(word, *strength)


@given(st.lists(words, max_size=4), st.sampled_from([(6, 4), (2, 2), (6, 3)]))
@settings(max_examples=200, deadline=None)
def test_runs_of_texts_laid_end_to_end(texts, strength):
    got = text_runs([[str(c).encode() for c in t] for t in texts], *strength)
    assert [set(r) for r in got] == [runs_by_definition(t, *strength) for t in texts]
    assert all(r == sorted(r, key=lambda x: (x[0], x[2])) for r in got)


@pytest.mark.parametrize("period", [1, 2, 3, 7, 40])
def test_cycles_inside_random_words(period):
    rng = random.Random(period)
    for _ in range(20):
        word = [rng.randrange(5) for _ in range(rng.randrange(40))]
        cycle = [rng.randrange(3) for _ in range(period)]
        word += (cycle * 12)[:rng.randrange(3 * period, 12 * period)] + [rng.randrange(5) for _ in range(rng.randrange(40))]
        got = text_runs([[str(c).encode() for c in word]])[0]
        assert set(got) == runs_by_definition(word)


def test_long_single_letter_and_fibonacci_words_are_not_quadratic():
    assert text_runs([[b"a"] * 200_000])[0] == [(0, 200_000, 1)]
    a, b = [0], [0, 1]
    while len(b) < 60_000:
        a, b = b, b + a
    assert text_runs([[str(c).encode() for c in b]])[0] == []      # no fourth power in it


def plain_row(doc_id, text, min_length=6, min_exponent=4):
    tokens = (text or "").encode().split()
    number = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
    runs = sorted(runs_by_definition([number[w] for w in tokens], min_length, min_exponent), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    left = b" ".join(w for i, w in enumerate(tokens) if i not in gone).decode()
    return doc_id, len(tokens), runs, best, left


ODD = [(1, "a a a a a a a"), (2, None), (3, ""), (4, " \t\n "), (None, "x y x y x y x y z"), (1, "a a a a a a a"),
       (5, "É\xa0e é É\xa0e é É\xa0e é É\xa0e é"), (6, "b a a a a a a c a a a a a a"), (7, "one"),
       (8, "  lead " + "p q r " * 5 + "tail\r\n"), (9, "w " * 30 + "u v " * 4)]


def rows(df):
    return sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]],
                    tuple(r["strongest"]) if r["strongest"] else None, r["collapsed"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk", [1, 10, 1000])
def test_documents(spark, chunk):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    want = sorted((plain_row(*r) for r in ODD), key=str)
    assert rows(find_runs(docs, chunk_words=chunk)) == want


def test_other_columns_and_names(spark):
    docs = spark.createDataFrame([(n, t, 0, "s", [1]) for n, t in ODD], "`a.b` long, `my text` string, runs int, doc_id string, collapsed array<int>")
    assert rows(find_runs(docs, "a.b", "my text")) == sorted((plain_row(*r) for r in ODD), key=str)


def test_empty_table(spark):
    assert find_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_weak_limits_are_refused(spark):
    with pytest.raises(ValueError):
        find_runs(spark.createDataFrame([], "doc_id long, text string"), min_exponent=1)


def test_strongest_and_collapsed():
    assert strongest([]) is None
    assert strongest([(0, 8, 2), (9, 4, 1), (20, 12, 3)]) == (0, 8, 2)
    assert collapsed([b"a", b"a", b"a", b"b"], [(0, 3, 1)]) == b"a b"


def test_query_against_brute_force(spark, tmp_path):
    """The registered query over a small folder, from the contract alone."""
    from riskflow.llm.queries import op11_periodic_runs
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60))) or None, "en", "s", 1) for i in range(150)]
    docs += [(None, "a b a b a b a b a b", "en", "s", 1), (200, "  ", "en", "s", 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc_id, text, *_ in docs:
        tokens = (text or "").split()
        h = 1 if doc_id is None else crc32(str(doc_id).encode())
        n, g = len(tokens), h // 10
        if doc_id is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            tokens = tokens[:a] + [tokens[a + (i - a) % p] for i in range(a, n)]
        _, _, runs, best, left = plain_row(doc_id, " ".join(tokens))
        start, length, period = best or (None, None, None)
        want.append((doc_id, len(runs), start, length, period, best and 1000 * length // period,
                     hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                     hashlib.sha256(left.encode()).hexdigest()))
    got = op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 5


def test_cut_is_exact_for_any_counter(monkeypatch):
    """Shared counters only keep more."""
    rng = random.Random(4)
    texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(80)] for _ in range(30)]
    full = [runs_by_definition([w[0] for w in t]) for t in texts]
    assert [set(r) for r in text_runs(texts)] == full
    monkeypatch.setattr(periodic_runs, "stretches", lambda codes, ends, *_: [
        (int(e) - len(t), int(e)) for e, t in zip(ends, texts, strict=True)])
    assert [set(r) for r in text_runs(texts)] == full
