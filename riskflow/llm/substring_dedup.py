"""Removal of repeated 100-byte strings by merged Burrows-Wheeler transforms (operator 7).

Every string of ``LENGTH`` bytes (a window) has one anchor: of its K-byte
grams the one with the smallest hash, the leftmost of equals.  Equal windows
have equal anchors at equal places, so all that must meet is what stands
around equal anchors, and the whole work is dealt out by anchor:

1. Documents are cut into segments, the runs of windows with one anchor.
   Hashes of anchor and segment are shuffled as packed arrays.  Segments alike
   stay once, the others are repeats of it as a whole; they are told on the
   map side too, so a passage that a third of all documents share reaches its
   bucket as one entry per task and batch.
2. Where one anchor stands in segments that differ, their bytes are fetched
   and dealt out again, by the anchor and the bytes beside it.
3. A bucket builds Burrows-Wheeler transforms of shards of its segments and
   merges them (see ``bwt_merge``); the repeated intervals at depth 100 are the
   windows that segments share.  The earliest start of each stays.
   Where one anchor stands in more than ``HOT`` different segments, as in a
   frequent line, its windows are dealt out one by one instead, by a digest of
   their bytes, each told once per task, so no bucket grows with such a line.
4. The starts found are gathered per document, and its bytes without what they
   cover are hashed.

Defined results: a null text is empty; a null id sorts before all others; rows
that share an id stand in the order of a hash of their text, and of rows alike
in both all but one are repeats as a whole; texts under 100 bytes lose nothing;
an empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm import common
from riskflow.llm.bwt_merge import repeated

LENGTH, K = 100, 32
_SPAN = LENGTH - K                # places of an anchor in a window, less one
#: Bytes hashed at once in a task.
SLICE = 1 << 20
#: Bytes of segments merged at once, unless one anchor has more.
MERGE_BYTES = 2 << 20
#: Different segments around one anchor beyond which its windows are compared by digest.
HOT = 5_000
_DIGEST = 16
_LOW = (1 << 24) - 1
_BASE = 0x9E3779B97F4A7C15
_FIRST = np.dtype([("hash", "<u4"), ("segment", "<u8"), ("doc", "<i8"), ("text", "<i8"), ("start", "<u4"),
                   ("windows", "u1"), ("before", "u1")])
_SECOND = np.dtype([("hash", "<u4"), ("doc", "<i8"), ("text", "<i8"), ("start", "<u4"), ("windows", "u1"),
                    ("before", "u1"), ("size", "<u2")])


def _byte_table() -> np.ndarray:
    """A fixed odd 64-bit number for each byte."""
    x = (np.arange(1, 257, dtype=np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    return (x ^ x >> np.uint64(29)) | np.uint64(1)


_BYTES = _byte_table()


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the K bytes from each position, by doubling."""
    h, size, power = _BYTES[data], 1, _BASE
    while size < K:
        h = h[:-size] * np.uint64(power) + h[size:]
        power = power * power % (1 << 64)
        size *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor, anchor's hash) of each segment of the
    texts laid end to end; no window crosses an end."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.astype(np.uint64)
    h = gram_hashes(data)
    least = (h & np.uint64(~_LOW & (1 << 64) - 1)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= _SPAN + 1:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < _SPAN + 1:
        least = np.minimum(least[:-(_SPAN + 1 - size)], least[_SPAN + 1 - size:])
    anchor = (least & np.uint64(_LOW)).astype(np.int64)
    inside = np.ones(len(anchor), bool)
    for e in ends[:-1]:
        inside[max(0, e - LENGTH + 1):e] = False
    change = np.ones(len(anchor) + 1, bool)
    change[1:-1] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first = np.flatnonzero(change[:-1] & inside)
    stop = np.ones(len(anchor), bool)
    stop[:-1] = (anchor[1:] != anchor[:-1]) | ~inside[1:]
    last = np.flatnonzero(stop & inside)
    return first, last - first + 1, anchor[first], h[anchor[first]]


def _slices(docs: Iterable[tuple[int, int, bytes]]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Lists of (doc, text hash, offset, bytes) of about SLICE bytes; long texts are cut with 99 bytes over."""
    held, size = [], 0
    for doc, text, data in docs:
        for at in range(0, max(1, len(data) - LENGTH + 1), SLICE):
            piece = data[at:at + SLICE + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            held.append((doc, text, at, piece))
            size += len(piece)
            if size >= SLICE:
                yield held
                held, size = [], 0
    if held:
        yield held


def _documents(batch) -> Iterator[tuple[int, int, bytes]]:
    for doc, text, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
        yield doc, text, data.as_py().encode("utf-8", "surrogatepass")


def _table(pieces: list[tuple[int, int, int, bytes]]) -> np.ndarray:
    """The segments of the pieces as _FIRST rows, with 64-bit anchor hashes apart."""
    from xxhash import xxh3_64_intdigest
    joined = b"".join(p[3] for p in pieces)
    ends = np.cumsum([len(p[3]) for p in pieces])
    begins = ends - np.array([len(p[3]) for p in pieces])
    first, windows, anchor, hashes = segments(np.frombuffer(joined, np.uint8), ends)
    out = np.zeros(len(first), _FIRST)
    which = np.searchsorted(ends, first, "right")
    before = anchor - first
    out["doc"] = np.array([p[0] for p in pieces], np.int64)[which]
    out["text"] = np.array([p[1] for p in pieces], np.int64)[which]
    out["start"] = np.array([p[2] for p in pieces], np.int64)[which] + first - begins[which]
    # An anchor's hash is the least of many, so its upper bits are mostly 0: mix them anew.
    out["windows"], out["before"], out["hash"] = windows, before, hashes * np.uint64(_BASE) >> np.uint64(32)
    view = memoryview(joined)
    out["segment"] = [xxh3_64_intdigest(view[s:s + n + LENGTH - 1], b)
                      for s, n, b in zip(first.tolist(), windows.tolist(), before.tolist(), strict=True)]
    return out


def _same(rows: np.ndarray, *names: str) -> np.ndarray:
    """Where a row equals the one before in all the columns."""
    same = np.zeros(len(rows), bool)
    if len(rows):
        same[1:] = np.logical_and.reduce([rows[n][1:] == rows[n][:-1] for n in names])
    return same


def _firsts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segments alike once, their earliest; the others, repeats)."""
    rows = rows[np.lexsort((rows["start"], rows["text"], rows["doc"], rows["segment"], rows["hash"]))]
    rows = rows[~_same(rows, "hash", "segment", "doc", "text", "start")]
    again = _same(rows, "hash", "segment")
    return rows[~again], rows[again]


_OUT = "bucket int, packed binary, doc_id long, text long, start long, windows int, before int, around int"


def _batch(bucket, packed, rows: np.ndarray | None, around: np.ndarray | None = None):
    import pyarrow as pa
    n = len(bucket) if rows is None else len(rows)
    empty = pa.nulls(n, pa.int32())
    columns = [pa.array(bucket, pa.int32()) if rows is None else pa.array(np.asarray(bucket, np.int32)),
               pa.array(packed, pa.binary()) if rows is None else pa.nulls(n, pa.binary())]
    if rows is None:
        none = pa.nulls(n, pa.int64())
        columns += [none, none, none, empty, empty, empty]
    else:
        columns += [pa.array(rows["doc"], pa.int64()), pa.array(rows["text"], pa.int64()),
                    pa.array(rows["start"].astype(np.int64)), pa.array(rows["windows"].astype(np.int32)),
                    empty if around is None else pa.array(rows["before"].astype(np.int32)),
                    empty if around is None else pa.array(around.astype(np.int32))]
    names = ["bucket", "packed", "doc_id", "text", "start", "windows", "before", "around"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _told(rows: np.ndarray, buckets: int):
    """Repeats, spread by place: one passage may be repeated in very many documents."""
    place = (rows["doc"].view(np.uint64) * np.uint64(_BASE) + rows["start"].astype(np.uint64)) >> np.uint64(32)
    return _batch(_bucket_of(place, buckets), None, rows)


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes.astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _dealt(rows: np.ndarray, buckets: int, tails: list[bytes] | None = None):
    """One packed array per bucket."""
    bucket = _bucket_of(rows["hash"], buckets)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    here = np.flatnonzero(np.diff(edges))
    packed = []
    for b in here:
        at = order[edges[b]:edges[b + 1]]
        part = rows[at]
        body = b"".join(np.ascontiguousarray(part[n]).tobytes() for n in part.dtype.names)
        if tails is not None:
            body += b"".join(tails[i] for i in at)
        packed.append(len(part).to_bytes(4, "little") + body)
    return _batch(here.astype(np.int32), packed, None)


def _unpacked(blob: bytes, kind: np.dtype) -> tuple[np.ndarray, bytes]:
    n, at = int.from_bytes(blob[:4], "little"), 4
    rows = np.zeros(n, kind)
    for name in kind.names:
        size = n * kind[name].itemsize
        rows[name] = np.frombuffer(blob[at:at + size], kind[name])
        at += size
    return rows, blob[at:]


def _cut(buckets: int) -> Callable:
    """Step 1, map side: packed segments, and the repeats inside a batch."""
    def run(batches: Iterable) -> Iterator:
        for batch in batches:
            tables = [_table(p) for p in _slices(_documents(batch))]
            if tables:
                stay, again = _firsts(np.concatenate(tables))
                yield _dealt(stay, buckets)
                if len(again):
                    yield _told(again, buckets)
    return run


def _meet(batches: Iterable) -> Iterator:
    """Step 1, a bucket: repeats as a whole, and segments whose anchor stands in others too, with
    ``before`` and the number of different segments around the anchor."""
    tables = []
    for batch in batches:
        blobs = batch.column(1)
        if blobs.null_count < len(blobs):
            tables += [_unpacked(x.as_py(), _FIRST)[0] for x in blobs if x.is_valid]
        passed = batch.filter(blobs.is_null())
        if len(passed):
            yield passed
    if not tables:
        return
    stay, again = _firsts(np.concatenate(tables))
    del tables
    _, group, sizes = np.unique(stay["hash"], return_inverse=True, return_counts=True)
    around = sizes[group]
    mixed, around = stay[around > 1], around[around > 1]
    for rows, sizes in ((again, None), (mixed, around)):
        for at in range(0, len(rows), 50_000):
            part = rows[at:at + 50_000]
            yield _batch(np.zeros(len(part)), None, part, None if sizes is None else sizes[at:at + 50_000])


def _fetch(buckets: int, hot: int) -> Callable:
    """Step 2: the bytes of the segments, cut in windows that reach left and
    windows that reach right of the anchor, dealt out with the bytes beside
    it; or, around a hot anchor, the digest of each window."""
    def run(batches: Iterable) -> Iterator:
        from xxhash import xxh3_64_intdigest, xxh3_128_digest
        beside = _SPAN // 2
        for batch in batches:
            rows, tails = [], []
            wanted = batch.column(3).to_pylist()
            for (doc, text, data), some in zip(_documents(batch), wanted, strict=True):
                for s in some:
                    start, windows, before = s["start"], s["windows"], s["before"]
                    if s["around"] > hot:
                        for at in range(start, start + windows):
                            digest = xxh3_128_digest(data[at:at + LENGTH])
                            rows.append((int.from_bytes(digest[:4], "little"), doc, text, at, 1, 0, _DIGEST))
                            tails.append(digest)
                        continue
                    left = min(windows, before - beside + 1)
                    for low, high in ((0, left), (max(0, left), windows)):
                        if low < high:
                            anchor = start + before
                            key = (data[anchor - beside:anchor + K] if high == left and low == 0 and left > 0
                                   else data[anchor:anchor + K + beside])
                            body = data[start + low:start + high + LENGTH - 1]
                            rows.append((xxh3_64_intdigest(key, len(key) if high == left else 1) >> 32, doc, text,
                                         start + low, high - low, before - low if before >= low else 0, len(body)))
                            tails.append(body)
            if rows:
                table = np.array(rows, _SECOND)
                stay, again = _by_digest(table, tails)
                if len(again):
                    yield _told(table[again], buckets)
                yield _dealt(table[stay], buckets, [tails[i] for i in stay])
    return run


def _by_digest(rows: np.ndarray, tails: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(rows to keep: all segments, and the earliest row of each digest; the later rows of a digest)."""
    least: dict[bytes, tuple] = {}
    digests = np.flatnonzero(rows["size"] == _DIGEST).tolist()
    for i in digests:
        place = (int(rows["doc"][i]), int(rows["text"][i]), int(rows["start"][i]), i)
        if tails[i] not in least or place < least[tails[i]]:
            least[tails[i]] = place
    first = {p[3] for p in least.values()}
    # A window met twice at one place is one start.
    again = [i for i in digests if i not in first
             and (rows["doc"][i], rows["text"][i], rows["start"][i]) != least[tails[i]][:3]]
    keep = np.ones(len(rows), bool)
    keep[digests] = False
    keep[list(first)] = True
    return np.flatnonzero(keep), np.array(again, np.int64)


def _merge(batches: Iterable) -> Iterator:
    """Step 3, a bucket: the windows that segments share, but for the earliest of each."""
    tables, bodies = [], []
    for batch in batches:
        passed = batch.filter(batch.column(1).is_null())
        if len(passed):
            yield passed
        for x in batch.column(1).drop_null():
            rows, tail = _unpacked(x.as_py(), _SECOND)
            tables.append(rows)
            ends = np.cumsum(rows["size"].astype(np.int64)).tolist()
            bodies += [tail[e - n:e] for e, n in zip(ends, rows["size"].tolist(), strict=True)]
    if not tables:
        return
    rows = np.concatenate(tables)
    stay, again = _by_digest(rows, bodies)
    if len(again):
        yield _batch(np.zeros(len(again)), None, rows[again])
    stay = stay[rows["size"][stay] != _DIGEST]
    rows, bodies = rows[stay], [bodies[i] for i in stay]
    order = np.lexsort((rows["start"], rows["text"], rows["doc"], rows["hash"]))
    rows, bodies = rows[order], [bodies[i] for i in order]
    twin = _same(rows, "hash", "doc", "text", "start", "windows")
    keep = np.flatnonzero(~twin)
    rows, bodies = rows[keep], [bodies[i] for i in keep]
    borders = np.flatnonzero(~_same(rows, "hash")).tolist() + [len(rows)]
    held, size = [], 0
    for a, b in zip(borders, borders[1:], strict=False):
        if b - a > 1:
            held += range(a, b)
            size += sum(len(bodies[i]) for i in range(a, b))
        if held and (size >= MERGE_BYTES or b == len(rows)):
            yield from _shared(rows[held], [bodies[i] for i in held])
            held, size = [], 0
    if held:
        yield from _shared(rows[held], [bodies[i] for i in held])


def _shared(rows: np.ndarray, bodies: list[bytes]) -> Iterator:
    # UTF-8 has no byte 0xFF; it stands for 0, which ends strings in the transform.
    string, offset, block = repeated([b.replace(b"\0", b"\xff") for b in bodies], LENGTH)
    if not len(string):
        return
    doc, text, start = rows["doc"][string], rows["text"][string], rows["start"][string].astype(np.int64) + offset
    order = np.lexsort((start, text, doc, block))
    doc, text, start, block = doc[order], text[order], start[order], block[order]
    again = np.zeros(len(order), bool)
    again[1:] = block[1:] == block[:-1]
    # A window met twice at one place is one start.
    same = np.zeros(len(order), bool)
    same[1:] = again[1:] & (doc[1:] == doc[:-1]) & (text[1:] == text[:-1]) & (start[1:] == start[:-1])
    first = np.maximum.accumulate(np.where(again, 0, np.arange(len(order))))
    later = again & ~same & ~((doc == doc[first]) & (text == text[first]) & (start == start[first]))
    doc, text, start = doc[later], text[later], start[later]
    if not len(doc):
        return
    order = np.lexsort((start, text, doc))
    doc, text, start = doc[order], text[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (start[1:] > start[:-1] + 1)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(doc)) - 1
    out = np.zeros(len(begin), [("doc", "<i8"), ("text", "<i8"), ("start", "<i8"), ("windows", "<i8")])
    out["doc"], out["text"], out["start"] = doc[begin], text[begin], start[begin]
    out["windows"] = start[end] - start[begin] + 1
    yield _batch(np.zeros(len(out)), None, out)


def covered(spans: np.ndarray, size: int) -> np.ndarray:
    """Maximal runs (begin, end) of bytes under the windows (start, windows)."""
    if not len(spans):
        return np.zeros((0, 2), np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    begin, end = spans[:, 0], np.maximum.accumulate(np.minimum(spans[:, 0] + spans[:, 1] + LENGTH - 1, size))
    new = np.ones(len(spans), bool)
    new[1:] = begin[1:] > end[:-1]
    at = np.flatnonzero(new)
    return np.stack([begin[at], end[np.append(at[1:], len(spans)) - 1]], axis=1)


def kept_bytes(data: bytes, runs: np.ndarray) -> bytes:
    out, at = [], 0
    for begin, end in runs.tolist():
        out.append(data[at:begin])
        at = end
    return b"".join([*out, data[at:]])


def _judge(batches: Iterable) -> Iterator:
    """Step 4: a document with the starts found in it."""
    import pyarrow as pa
    for batch in batches:
        out = []
        starts, windows = batch.column(4), batch.column(5)
        for i, (doc, data, nth) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1),
                                                 batch.column(3).to_pylist(), strict=True)):
            raw = data.as_py().encode("utf-8", "surrogatepass")
            if nth > 1 and len(raw) >= LENGTH:
                runs = np.array([[0, len(raw)]])
            elif starts[i].is_valid:
                runs = covered(np.stack([starts[i].values.to_numpy(), windows[i].values.to_numpy().astype(np.int64)],
                                        axis=1), len(raw))
            else:
                runs = np.zeros((0, 2), np.int64)
            removed = int((runs[:, 1] - runs[:, 0]).sum())
            kept = kept_bytes(raw, runs)
            out.append((doc, len(raw), removed, len(runs), hashlib.sha256(kept).hexdigest(), runs.ravel().tolist()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [batch.column(0).type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   buckets: int | None = None, hot: int = HOT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256
    and spans, the removed runs as begin and end in turn."""
    buckets = buckets or common.shuffle_partitions(docs.sparkSession)
    text = common.text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("data")).select(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64("data").alias("text"), "data",
        "doc_id")
    key = ["doc", "text"]
    first = common.stored(
        rows.select("doc", "text", "data").mapInArrow(_cut(buckets), _OUT)
        .repartitionById(buckets, F.col("bucket")).mapInArrow(_meet, _OUT)
        .select("doc_id", "text", "start", "windows", "before", "around"), "repeats-first")
    mixed = (first.filter("before is not null").groupBy(F.col("doc_id").alias("doc"), "text")
             .agg(F.collect_list(F.struct("start", "windows", "before", "around")).alias("wanted")))
    second = common.stored(
        rows.select("doc", "text", "data").join(mixed, key).select("doc", "text", "data", "wanted")
        .mapInArrow(_fetch(buckets, hot), _OUT).repartitionById(buckets, F.col("bucket")).mapInArrow(_merge, _OUT)
        .select("doc_id", "text", "start", "windows"), "repeats-second")
    spans = (first.filter("before is null").select("doc_id", "text", "start", "windows").unionByName(second)
             .groupBy(F.col("doc_id").alias("doc"), "text")
             .agg(F.collect_list("start").alias("starts"), F.collect_list("windows").alias("windows")))
    # Rows alike have all three hashes and the length in common.
    alike = Window.partitionBy(*key, F.hash("data"), F.length("data")).orderBy(F.lit(0))
    judged = (rows.join(spans, key, "left").withColumn("nth", F.row_number().over(alike))
              .select("doc_id", "data", "text", "nth", "starts", "windows"))
    return judged.mapInArrow(_judge, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                     "spans array<bigint>")
