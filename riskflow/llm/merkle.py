"""Document fingerprints: Merkle trees over sections and paragraphs (operator 2).

A paragraph is a line; a section ends at a blank line or at a paragraph whose
hash says so, so that an edit moves no border elsewhere.  A paragraph's hash is
that of its line, a section's that of its paragraphs' hashes and the root's that
of the sections' hashes, so equal roots mean equal texts.  Below a paragraph
stand its phrases, cut at spaces after certain characters, and below a phrase
its words, in paragraphs of every length; two trees are compared from the root
down: children are aligned in their order by equal digests (phrases and words by
themselves, being little longer than a digest) and only the branches between
aligned ones are opened, which locates the edit and tells how many characters
both share in the same order.  So only equal texts are alike to the degree 1.

Documents are paired with the next one by id without a global sort of one
task: quantiles of the ids cut the order into buckets, each bucket is one
sorted partition, and the first document of a bucket is sent to the one before
as well.  The text is shuffled once.

Ids are integers.  Defined results: a null text is empty; a null id sorts
before all others; rows that share an id follow each other in the order of
length and hash of their text; a single row is its own next one; two empty
texts are alike to the degree 1; an empty input gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import common

#: A phrase ends with a space after one of these.
_PHRASE = re.compile(r"(?<=[.,;:!?|adkoszéñßü] )(?!\Z)")
#: A word with the space after it; longer words are cut, so that their likeness is not all or nothing.
_WORD = re.compile(r"[^ \n]{1,8}[ \n]?|[ \n]")
#: One paragraph in this many ends a section.
SECTION = 8
_SIZE = 16


def _hash(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=_SIZE).digest()


class Node:
    """A root, section or paragraph; ``chars`` counts the characters below.
    A paragraph is opened into its phrases only when a comparison gets there;
    phrases and words are compared as they are."""
    __slots__ = ("chars", "digest", "line", "nodes")

    def __init__(self, digest: bytes, chars: int, nodes: list[Node] | None, line: str | None = None):
        self.digest, self.chars, self.nodes, self.line = digest, chars, nodes, line

    def children(self) -> list[Node] | list[str]:
        return _pieces(self.line) if self.nodes is None else self.nodes


def _pieces(line: str) -> list[str]:
    """Phrases with the space after them, the last with the line's end."""
    return _PHRASE.split(line + "\n")


def _parent(nodes: list[Node], mark: bytes) -> Node:
    return Node(_hash(mark + b"".join([n.digest for n in nodes])), sum([n.chars for n in nodes]), nodes)


def tree(text: str, known: dict[str, Node] | None = None) -> Node:
    """The root; ``known`` holds paragraphs met before."""
    known = {} if known is None else known
    sections, held = [], []
    for line in text.split("\n"):
        node = known.get(line)
        if node is None:
            node = known[line] = Node(_hash(b"l" + line.encode("utf-8", "surrogatepass")), len(line) + 1, None, line)
        held.append(node)
        if node.digest[0] % SECTION == 0 or not line or line.isspace():
            sections.append(_parent(held, b"s"))
            held = []
    if held:
        sections.append(_parent(held, b"s"))
    return _parent(sections, b"r")


def _gaps(ours: list, theirs: list) -> Iterator[tuple[int, int, int, int]]:
    """Stretches (from, to, from, to) of two sequences of digests that lie
    between their aligned elements, in order.  Equal ends are aligned first; of
    the rest the n-th of a digest may meet the n-th on the other side, and of
    those pairs the longest run that rises on both sides is aligned."""
    for i, n, j, m in _stretches(ours, theirs):
        i, n, j, m = _trimmed(ours, theirs, i, n, j, m)
        if i < n or j < m:
            yield i, n, j, m


def _trimmed(ours: list, theirs: list, i: int, n: int, j: int, m: int) -> tuple[int, int, int, int]:
    while i < n and j < m and ours[i] == theirs[j]:
        i, j = i + 1, j + 1
    while i < n and j < m and ours[n - 1] == theirs[m - 1]:
        n, m = n - 1, m - 1
    return i, n, j, m


def _stretches(ours: list, theirs: list) -> list[tuple[int, int, int, int]]:
    i, n, j, m = _trimmed(ours, theirs, 0, len(ours), 0, len(theirs))
    both = set(ours[i:n]).intersection(theirs[j:m])
    if not both:
        return [(i, n, j, m)]
    where: dict = {}
    for at in range(m - 1, j - 1, -1):
        if theirs[at] in both:
            where.setdefault(theirs[at], []).append(at)
    # Longest rising run: ``tails`` holds the least end of a run of each length.
    tails: list[int] = []
    ends: list[tuple] = []           # (at, meets, run before)
    for at in range(i, n):
        spare = where.get(ours[at])
        if spare:
            meets = spare.pop()
            k = bisect_left(tails, meets)
            link = (at, meets, ends[k - 1] if k else None)
            if k == len(tails):
                tails.append(meets)
                ends.append(link)
            else:
                tails[k], ends[k] = meets, link
    link, out = ends[-1], []
    while link:
        at, meets, link = link
        out.append((at + 1, n, meets + 1, m))
        n, m = at, meets
    out.append((i, n, j, m))
    return out[::-1]


def differences(a: Node, b: Node) -> Iterator[tuple[int, int, int, int]]:
    """Spans (start, end, start, end) of the two texts, a line end after each,
    whose words lie under no aligned branch: from the roots down the children
    of branches that differ are aligned in order and only the gaps are opened.
    What stands outside the spans is the same sequence of characters in both."""
    if a.digest != b.digest:
        yield from _opened([a], [b], 0, 0, _ROOT)


#: Levels of the tree; paragraphs and all above are nodes, phrases and words are strings.
_ROOT, _PARAGRAPH, _WORDS = 0, 2, 4


def _opened(left: list, right: list, at: int, to: int, level: int) -> Iterator[tuple[int, int, int, int]]:
    if level > _PARAGRAPH:
        keys, others, sizes, widths = left, right, map(len, left), map(len, right)
    else:
        keys, others = [n.digest for n in left], [n.digest for n in right]
        sizes, widths = [n.chars for n in left], [n.chars for n in right]
    starts, places = list(accumulate(sizes, initial=at)), list(accumulate(widths, initial=to))
    for i, n, j, m in _gaps(keys, others):
        if i == n or j == m or level == _WORDS:
            yield starts[i], starts[n], places[j], places[m]
        else:
            yield from _opened(_children(left[i:n]), _children(right[j:m]), starts[i], places[j], level + 1)


def _children(nodes: list) -> list:
    if isinstance(nodes[0], str):
        return _WORD.findall("".join(nodes))
    return [child for n in nodes for child in n.children()]


def shared(a: Node, b: Node) -> int:
    """Characters under aligned branches of two trees."""
    return a.chars - sum([end - start for start, end, _, _ in differences(a, b)])


def likeness(a: Node, b: Node) -> float:
    """Share of the longer text's characters that stand under aligned branches,
    in order; 1 for equal roots only, and the same both ways."""
    if b.digest < a.digest:
        a, b = b, a
    return shared(a, b) / max(a.chars, b.chars)


def edits(a: Node, b: Node) -> list[tuple[int, int]]:
    """Character spans of ``a`` whose words lie under no aligned branch of
    ``b``; a span without length stands where ``b`` alone has words."""
    found: list[tuple[int, int]] = []
    for start, end, _, _ in differences(a, b):
        if found and found[-1][1] == start:
            start = found.pop()[0]
        found.append((start, end))
    return found


def _rows(batches: Iterable) -> Iterator:
    """Rows of one bucket after the other, in order, each followed by copies of the next bucket's first."""
    import pyarrow as pa

    def judged(a: tuple, b: tuple) -> tuple:
        (doc_id, text, root, paragraphs), (_, following, other, _) = a, b
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[:cut]
        known = dict(paragraphs)
        again = root if edited == text else tree(edited, known)
        return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                root.digest.hex(), again.digest.hex(), likeness(root, again), likeness(root, other))

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield values

    kind, out, last, bucket_of_last = pa.int64(), [], None, None
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    done = None
    for bucket, copied, doc_id, text in rows():
        if copied and done == bucket:
            continue       # one copy is enough
        known: dict[str, Node] = {}
        here = (doc_id, text, tree(text, known), known)
        if last is not None and bucket_of_last == bucket:
            out.append(judged(last, here))
        last, bucket_of_last = (None, None) if copied else (here, bucket)
        if copied:
            done = bucket
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def _bucketed(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame | None:
    """Rows with their bucket in the order of ids, the first of each bucket also in the one before."""
    lowest = -(1 << 63)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(lowest)))
    cuts = rows.agg(F.percentile_approx("key", [i / buckets for i in range(1, buckets)] or [0.5]).alias("c")).first()["c"]
    if cuts is None:
        return None
    guess = np.array(sorted(set(cuts)), np.int64)

    def place(starts: np.ndarray):
        @F.pandas_udf("long")
        def found(key: pd.Series) -> pd.Series:
            at = np.searchsorted(starts, key.to_numpy(), "right")
            # Odd: the key that starts its bucket.
            first = (at > 0) & (starts[np.maximum(at, 1) - 1] == key.to_numpy())
            return pd.Series(2 * at + first)
        return found

    # The least id that really stands in each bucket: one row a bucket.
    starts = np.array(sorted(r["s"] for r in rows.select("key", (place(guess)("key") / 2).cast("long").alias("b"))
                             .groupBy("b").agg(F.min("key").alias("s")).collect()), np.int64)
    n = len(starts)
    placed = rows.withColumn("place", place(starts)("key"))
    bucket = (F.col("place") / 2).cast("long") - 1
    own = F.struct(bucket.cast("int").alias("bucket"), F.lit(False).alias("copied"))
    before = F.struct(F.pmod(bucket - 1, F.lit(n)).cast("int").alias("bucket"), F.lit(True).alias("copied"))
    spread = placed.withColumn("to", F.explode(F.when(F.col("place") % 2 == 1, F.array(own, before))
                                               .otherwise(F.array(own))))
    return (spread.select("to.bucket", "to.copied", "key", "doc_id", "text")
            .repartitionById(n, F.col("bucket"))
            .sortWithinPartitions("bucket", "copied", "key", F.length("text"), F.xxhash64("text"))
            .select("bucket", "copied", "doc_id", "text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 buckets: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    shape = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
    rows = _bucketed(docs, id_col, text_col, buckets or common.shuffle_partitions(docs.sparkSession))
    if rows is None:
        return docs.sparkSession.createDataFrame([], shape)
    return rows.mapInArrow(_rows, shape)
