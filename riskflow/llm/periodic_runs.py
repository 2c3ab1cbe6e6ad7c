"""Periodic runs of words (operator 11): Lyndon arrays from phase one of
Baier's suffix sorter, Lyndon roots extended through LCE into runs.

A run is a longest stretch of words with smallest period q.  By the runs
theorem every run has a Lyndon root that is the longest Lyndon word starting at
its place, under the order of the words or under the reverse order.  Phase one
of Baier's suffix sorter groups suffixes by exactly that word: ``lyndon_lengths``
runs it under both orders and reads the lengths off the groups.  Every root is
then extended to both sides by the longest common extension of its place and
the place one root further (``_common``), which gives the run.

``stretches`` first cuts a text where no run of the asked strength can pass.  In
a run of length at least e * q every three successive words come back at least
floor(e) - 1 times, so words that no such triple covers lie in no run.  The cut
is exact: a run lies in one stretch, with both its ends (tests compare with brute
force over the whole text).  Triples are counted in hashed counters, and a shared
counter can only keep more.

Everything is local to a document: no shuffle, memory bounded by a chunk of
documents (``CHUNK_WORDS``) or one document that is longer.

Defined results: a null, empty or wordless text has no words and no runs and
collapses to the empty text; a null id is carried through; repeated rows each give
their own row; an empty table gives no rows; other columns are not read, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Words of documents that are searched together.
CHUNK_WORDS = 400_000
#: Words of a triple.
_GRAM = 3


def lyndon_lengths(word: list[int]) -> list[int]:
    """Length of the longest Lyndon word starting at each place.

    Groups of suffixes start as the symbols and are taken from the highest
    down.  Taking a group of context u, each suffix looks for the nearest place
    before it in a lower group; a place met by k suffixes has u to the k-th
    behind its own context, and moves with its like to a new group directly
    above the rest of its old one."""
    n = len(word)
    number = {c: g for g, c in enumerate(sorted(set(word)))}
    group = [number[c] for c in word]
    members: list[list[int]] = [[] for _ in number]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [1] * len(members)
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))
    top = len(members) - 1
    if top >= 0:
        above[top] = -1
    before = list(range(-1, n - 1))     # of a place taken: some earlier place, nearest ones not taken lie at or before it
    taken = bytearray(n)
    lengths = [0] * n
    g = top
    while g >= 0:
        here = [s for s in members[g] if group[s] == g]
        members[g] = here
        own = size[g]
        for s in here:
            taken[s] = 1
            lengths[s] = own
        met: dict[int, int] = {}
        for s in here:
            p = before[s]
            if p >= 0 and taken[p]:
                path = [s]
                while p >= 0 and taken[p]:
                    path.append(p)
                    p = before[p]
                for q in path:
                    before[q] = p
            if p >= 0:
                met[p] = met.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, k in met.items():
            moved.setdefault((k, group[p]), []).append(p)
        for k, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:
            new, places = len(members), moved[k, old]
            members.append(places)
            size.append(size[old] + k * own)
            over = above[old]
            above.append(over)
            below.append(old)
            above[old] = new
            below[over] = new
            for p in places:
                group[p] = new
        g = below[g]
    return lengths


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common prefix of two arrays, in growing blocks."""
    n, at, step = min(len(a), len(b)), 0, 32
    while at < n:
        differ = a[at:min(n, at + step)] != b[at:min(n, at + step)]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at += step
        step *= 2
    return n


def stretch_runs(codes: np.ndarray, min_length: int = MIN_LENGTH,
                 min_exponent: int = MIN_EXPONENT) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``min_length`` words
    and ``min_exponent`` (at least 2) periods."""
    n = len(codes)
    word = codes.tolist()
    found = set()
    for order in (word, [-c for c in word]):
        period = np.array(lyndon_lengths(order), np.int64)
        at = np.arange(n)
        last = at + period - 1
        grows = (last + 1 < n) & (codes == codes[np.minimum(last + 1, n - 1)])     # to the right
        grows[1:] |= codes[:-1] == codes[last[1:]]                                 # to the left
        at = at[grows]
        start = end = found_q = -1
        for i in at[np.argsort(period[at], kind="stable")].tolist():
            q = int(period[i])
            if q == found_q and start <= i and i + q <= end:
                continue                 # a root of the run just found
            e = i + q + _common(codes[i:], codes[i + q:])
            s = i - _common(codes[:i][::-1], codes[:i + q][::-1])
            if e - s >= 2 * q:
                start, end, found_q = s, e, q
                if e - s >= max(min_length, min_exponent * q):
                    found.add((s, e - s, q))
    return found


def stretches(codes: np.ndarray, ends: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int]]:
    """[start, end) of the parts of texts laid end to end (text k ends before
    ``ends[k]``) that may hold a run; they may share border words."""
    begin = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    end = ends.astype(np.int64)
    again = min_exponent - 1
    long_enough = end - begin >= min_length
    begin, end = begin[long_enough], end[long_enough]
    if min_length < again + _GRAM - 1:
        return list(zip(begin.tolist(), end.tolist(), strict=True))
    words = -1
    while len(begin) and words != (words := int((end - begin).sum())):
        length = end - begin
        owner = np.repeat(np.arange(len(begin)), length)
        at = np.arange(words) + np.repeat(begin - (np.cumsum(length) - length), length)
        c = codes[at].astype(np.uint64) + np.uint64(1)
        h = owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        inside = np.ones(words, bool)
        for k in range(_GRAM):
            h[:words - k] = (h[:words - k] ^ c[k:]) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            if k:
                inside[:words - k] &= owner[:words - k] == owner[k:]
                inside[words - k:] = False
        bits = max(10, int(words).bit_length() + 3)
        slot = (h >> np.uint64(64 - bits)).astype(np.int64)
        counts = np.bincount(slot[inside], minlength=1 << bits)
        kept = inside & (counts[slot] >= again)
        edge = np.diff(np.concatenate([[False], kept, [False]]).astype(np.int8))
        # Starts of triples in one text follow each other; the last two words of a text start none.
        first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        begin, end = at[first] if len(first) else first, at[after - 1] + _GRAM if len(after) else after
        keep = end - begin >= min_length
        begin, end = begin[keep], end[keep]
    return list(zip(begin.tolist(), end.tolist(), strict=True))


def text_runs(texts: list[list[bytes]], min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words, by start, then period."""
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for words in texts for w in words], np.int64)
    ends = np.cumsum([len(words) for words in texts], dtype=np.int64)
    found: list[set] = [set() for _ in texts]
    for begin, end in stretches(codes, ends, min_length, min_exponent):
        text = int(np.searchsorted(ends, begin, "right"))
        base = begin - int(ends[text]) + len(texts[text])
        found[text].update((base + s, length, q)
                           for s, length, q in stretch_runs(codes[begin:end], min_length, min_exponent))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words left when every run keeps its first period only."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    gone = np.cumsum(step[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties: smallest start, then period."""
    best = None
    for run in runs:        # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
              chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period by
    start, then period), strongest (a run or null), collapsed (its text with
    every run reduced to its first period)."""
    if min_exponent < 2 or min_length < 1:
        raise ValueError("a run has at least two periods and one word")
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()
    run_type = "struct<start: bigint, length: bigint, period: bigint>"

    def search(batches: Iterable) -> Iterator:
        import pyarrow as pa
        run_arrow = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

        def as_run(run: tuple) -> dict:
            return dict(zip(("start", "length", "period"), run, strict=True))

        def chunk(ids: object, texts: list[list[bytes]]) -> pa.RecordBatch:
            runs = text_runs(texts, min_length, min_exponent)
            best = [strongest(r) for r in runs]
            left = pa.array([collapsed(w, r) for w, r in zip(texts, runs, strict=True)], pa.binary())
            return pa.RecordBatch.from_arrays(
                [ids, pa.array([len(w) for w in texts], pa.int64()),
                 pa.array([[as_run(r) for r in some] for some in runs], pa.list_(run_arrow)),
                 pa.array([b and as_run(b) for b in best], run_arrow), left.cast(pa.string(), safe=False)],
                names=["doc_id", "n_words", "runs", "strongest", "collapsed"])

        for rows in batches:
            ids, texts, count, at = rows.column(0), [], 0, 0
            for i, text in enumerate(rows.column(1).cast(pa.binary())):
                texts.append((text.as_py() or b"").split())
                count += len(texts[-1])
                if count >= chunk_words:
                    yield chunk(ids.slice(at, i + 1 - at), texts)
                    texts, count, at = [], 0, i + 1
            if texts:
                yield chunk(ids.slice(at), texts)

    return narrow.mapInArrow(search, f"doc_id {id_type}, n_words long, runs array<{run_type}>, "
                                     f"strongest {run_type}, collapsed string")
