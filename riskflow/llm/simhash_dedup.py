"""SimHash near-dedup by meet-in-the-middle ball hashing (operator 4).

Two fingerprints within three bits of each other have a value between them
that lies within two bits of one and one bit of the other.  Every distinct
fingerprint therefore emits the variants of the ball of half the radius, and
fingerprints that emit the same variant are verified bit by bit.  Half of
three is rounded up for fingerprints with an even number of set bits and down
for those with an odd number, since two fingerprints three bits apart differ
in parity; and of the two-bit variants only those whose two bits lie in the
same half of the word are needed, since of three differing bits two always do.
Both rules lose no pair (see ``masks``).

The variants of a batch are dealt to buckets by a hash of the variant and
shuffled as packed arrays; a bucket sorts its variants and links the members of
each one to a hub, never all to all.  Links, components and fingerprints stay
in tables.

Defined results: a null or wordless text has fingerprint zero and is linked
like any other; a null id takes part but is never a component's id unless all
its members lack one; equal texts and repeated rows share a fingerprint and so
a component; an empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import common
from riskflow.llm.components import components

BITS = 64
SHINGLE = 3
MAX_DISTANCE = 3
SEED = 42
#: Variants one bucket holds, on average.
BUCKET_VARIANTS = 2_000_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the word shingles of the ASCII-lower-cased text."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.array([xxh64_intdigest(g, seed) for g in grams], dtype="<u8")
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):      # very long texts: bounded memory
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and its fingerprint as a signed 64-bit integer."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        for rows in batches:
            prints = np.array([fingerprint(t.as_py(), shingle, seed) for t in rows.column(1)], "<u8")
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(prints.view("<i8"), pa.int64())],
                                             names=["doc_id", "print"])
    return narrow.mapInArrow(run, f"doc_id {id_type}, print long")


def masks() -> tuple[np.ndarray, np.ndarray]:
    """Bits flipped by fingerprints of even and of odd parity.

    Distance 1: the variant is the even one itself, one flip of the odd one.
    Distance 2: one flip of each.  Distance 3: two of the three bits lie in the
    same half of the word; the even one flips those, the odd one the third."""
    one = [0] + [1 << i for i in range(BITS)]
    half = BITS // 2
    two = [1 << i | 1 << j for i, j in combinations(range(BITS), 2) if i // half == j // half]
    return np.array(one + two, np.uint64), np.array(one, np.uint64)


def _emit(buckets: int):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        even, odd = masks()
        for rows in batches:
            prints = rows.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(prints), 2048):
                some = prints[at:at + 2048]
                is_odd = (np.bitwise_count(some) & 1).astype(bool)
                variant = np.concatenate([(some[~is_odd, None] ^ even).ravel(), (some[is_odd, None] ^ odd).ravel()])
                flip = np.concatenate([np.tile(np.arange(len(even), dtype=np.uint16), (~is_odd).sum()),
                                       np.tile(np.arange(len(odd), dtype=np.uint16), is_odd.sum())])
                bucket = ((variant * _SPREAD) >> np.uint64(32)) % np.uint64(buckets)
                order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
                edge = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
                here = np.flatnonzero(np.diff(edge))
                packed = [(variant[order[edge[b]:edge[b + 1]]].tobytes(), flip[order[edge[b]:edge[b + 1]]].tobytes())
                          for b in here]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(here, pa.int32()), pa.array([v for v, _ in packed], pa.binary()),
                     pa.array([f for _, f in packed], pa.binary())], names=["bucket", "variants", "flips"])
    return run


def meet(variant: np.ndarray, flip: np.ndarray, max_distance: int = MAX_DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Verified links (hub, member) of the fingerprints that share a variant.

    Members at most one flip away are pairwise within two bits; members two
    flips away (even parity) are within three of every member one flip away.
    So a hub with the fewest flips reaches every member it must link."""
    even, _ = masks()
    order = np.argsort(variant, kind="stable")
    variant, flip = variant[order], flip[order]
    same = variant[1:] == variant[:-1]
    shared = np.zeros(len(variant), bool)
    shared[1:] |= same
    shared[:-1] |= same
    variant, flip = variant[shared], flip[shared]
    if not len(variant):
        return variant, variant
    member = variant ^ even[flip]
    flips = np.bitwise_count(even[flip])
    odd = (np.bitwise_count(member) & 1).astype(np.int64)
    # Where the variant's parity is even: odd members (one flip) first, then the variant itself.
    rank = np.where(flips == 2, 2, 1 - odd)
    order = np.lexsort((member, rank, variant))
    variant, member, rank = variant[order], member[order], rank[order]
    first = np.concatenate([[True], variant[1:] != variant[:-1]])
    at = np.maximum.accumulate(np.where(first, np.arange(len(variant)), 0))
    hub, linked = member[at], (rank[at] < 2) & ~first
    linked &= np.bitwise_count(hub ^ member) <= max_distance
    return hub[linked], member[linked]


def _collide(batches: Iterable) -> Iterator:
    """A bucket's blobs, all in one partition, to links."""
    import pyarrow as pa
    variants, flips = [], []
    for rows in batches:
        variants += [np.frombuffer(x.as_py(), "<u8") for x in rows.column(1)]
        flips += [np.frombuffer(x.as_py(), "<u2") for x in rows.column(2)]
    if variants:
        hub, member = meet(np.concatenate(variants), np.concatenate(flips))
        pairs = np.unique(np.stack([np.minimum(hub, member), np.maximum(hub, member)]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0].view("<i8"), pa.int64()),
                                          pa.array(pairs[1].view("<i8"), pa.int64())], names=["u", "v"])


def links(prints: DataFrame, bucket_variants: int = BUCKET_VARIANTS) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``print`` at most three bits
    apart: enough of them that every such pair is connected through them."""
    distinct = prints.count()
    buckets = max(1, -(-distinct * 560 // bucket_variants))
    spread = prints.select("print").repartition(max(buckets, 8), "print")
    packed = spread.mapInArrow(_emit(buckets), "bucket int, variants binary, flips binary")
    met = packed.repartitionById(buckets, F.col("bucket")).mapInArrow(_collide, "u long, v long")
    return met.distinct()


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = common.stored(fingerprints(docs, id_col, text_col), "simhash-prints")
    distinct = common.stored(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = common.stored(components(links(distinct)), "simhash-roots")
    root = F.coalesce("root", "print")
    labelled = distinct.join(roots, F.col("print") == F.col("node"), "left").withColumn("root", root)
    least = common.stored(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    ids = common.stored(labelled.select("print", "root").join(least, "root").select("print", "component_id"),
                        "simhash-ids")
    return prints.join(ids, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
