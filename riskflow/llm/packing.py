"""Harmonic packing of token sequences (operator 3).

Lengths are partitioned into reciprocal-capacity classes: class k holds pieces
that fill a bin of ``capacity`` tokens when exactly k of them lie in it.  A
document is cut into full bins and a rest; a rest that k copies would fill to
within ``slack`` goes to class k whole, any other gives class k + 1 a piece of
``capacity // (k + 1)`` tokens and what remains is classed again.  Every worker
fills the bins of every class by the fixed count, on its own, without a
shuffle.  At its end a worker holds less than one bin per class; those pieces
are laid end to end, cut at the capacity, and the last tokens are cut at
powers of two, which need no padding.

Tokens are found per unit: a text is cut before spaces, where the byte-level
pre-tokenizer always cuts too, and the ids of a unit are kept as bytes, so a
task encodes a repeated word once.  The ranks file holds the vocabulary of
the tokenizer's JSON file and gives the same ids; the JSON's added tokens, such
as ``<|endoftext|>``, are matched in the text first, and what stands between
them is encoded by itself.

Defined results: a null text is empty and gives the end id alone; rows alike
are packed each; a null id stays null; very long texts give many full bins; an
empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

import array
import base64
import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.llm import common

CAPACITY = 2048
END_ID = 1
#: A rest goes to its class whole if k of them leave at most capacity // SLACK tokens
#: free, or fewer than the next class would.
SLACK = 128
#: Distinct units whose ids a task keeps; beyond, it starts anew.
CACHE_UNITS = 500_000
#: Pieces per output batch.
OUT_ROWS = 20_000

#: A space inside a run of white space, where a text must not be cut.
_INSIDE_RUN = re.compile(r"\s \s")


def added_tokens(tokenizer_file: str) -> dict[str, int]:
    """Ids of the tokens that a tokenizer's JSON file adds to the vocabulary, as literals of the text."""
    with open(tokenizer_file, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    for token in added:
        if any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {token['content']!r} is no plain literal")
    return {token["content"]: token["id"] for token in added}


class UnitEncoder(dict):
    """Texts to token ids as little-endian unsigned 32-bit bytes.

    A text is cut before every space.  The pre-token pattern takes a space
    only as the first character of a token or inside a run of white space, so
    the cut changes no id as long as no space lies inside such a run; texts
    with one are encoded whole.  The dict holds a unit's ids without its
    leading space.  ``added`` tokens are matched before all that, the longest first."""

    def __init__(self, ranks_file: str, pattern: str, added: dict[str, int] | None = None):
        import tiktoken
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.ordinary = tiktoken.Encoding("units", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={}).encode_ordinary
        self.added = {token: array.array("I", [i]).tobytes() for token, i in (added or {}).items()}
        self.split = re.compile("({})".format("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))))).split

    def ids(self, text: str) -> bytes:
        return array.array("I", self.ordinary(text)).tobytes()

    def __missing__(self, unit: str) -> bytes:
        found = self[unit] = self.ids(" " + unit)
        return found

    def encode(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            # Every other part is an added token.
            return b"".join(self.added[part] if i % 2 else self.plain(part) for i, part in enumerate(self.split(text)))
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if _INSIDE_RUN.search(text):
            return self.ids(text)
        first, *units = text.split(" ")
        if len(self) > CACHE_UNITS:
            self.clear()
        return self.ids(first) + b"".join(map(self.__getitem__, units))


def class_of(length: int, capacity: int = CAPACITY) -> tuple[int, int]:
    """(class, tokens to cut) for a rest shorter than ``capacity``."""
    k = capacity // length
    part = capacity // (k + 1)
    if k * length >= min(capacity - capacity // SLACK, (k + 1) * part):
        return k, length
    return k + 1, part


class Packer:
    """The bins of one worker.  ``add`` and ``close`` yield pieces
    (document key, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, worker: int, capacity: int = CAPACITY):
        self.capacity, self.next_id, self.open = capacity, worker << 33, {}

    def _bin(self, pieces: list) -> Iterator[tuple]:
        sequence, offset = self.next_id, 0
        self.next_id += 1
        for key, start, ids, total in pieces:
            yield key, start, ids, total, sequence, offset
            offset += len(ids) // 4

    def add(self, key, ids: bytes) -> Iterator[tuple]:
        size, total, at = self.capacity, len(ids) // 4, 0
        while total - at >= size:
            yield from self._bin([(key, at, ids[4 * at:4 * (at + size)], total)])
            at += size
        while at < total:
            k, length = class_of(total - at, size)
            held = self.open.setdefault(k, [])
            held.append((key, at, ids[4 * at:4 * (at + length)], total))
            at += length
            if len(held) == k:
                yield from self._bin(held)
                self.open[k] = []

    def close(self) -> Iterator[tuple]:
        """Pieces of bins that stayed open, end to end."""
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        tokens = sum(len(p[2]) // 4 for p in left)
        while left:
            room = self.capacity if tokens >= self.capacity else 1 << (tokens.bit_length() - 1)
            tokens -= room
            taken = []
            while room:
                key, start, ids, total = left.pop(0)
                length = min(room, len(ids) // 4)
                taken.append((key, start, ids[:4 * length], total))
                if 4 * length < len(ids):
                    left.insert(0, (key, start + length, ids[4 * length:], total))
                room -= length
            yield from self._bin(taken)


def pack(docs: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True,
         added: dict[str, int] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if ``with_ids``, the token ids themselves.
    ``added`` holds the tokenizer's ``added_tokens``."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [T.StructField("doc_id", narrow.schema["doc_id"].dataType)]
    fields += [T.StructField(n, T.LongType()) for n in names]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    return narrow.mapInArrow(_worker(ranks_file, pattern, capacity, end_id, with_ids, added), T.StructType(fields))


def _worker(ranks_file: str, pattern: str, capacity: int, end_id: int, with_ids: bool,
            added: dict[str, int] | None) -> Callable:
    def run(batches: Iterable) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        units, packer = UnitEncoder(ranks_file, pattern, added), Packer(TaskContext.get().partitionId(), capacity)
        end = np.asarray([end_id], "<u4").tobytes()
        kind, out = None, []

        def batch() -> pa.RecordBatch:
            key, start, ids, total, sequence, offset = zip(*out, strict=True)
            columns = [pa.array(key, kind), pa.array(start, pa.int64()),
                       pa.array([len(x) // 4 for x in ids], pa.int64()),
                       pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(total, pa.int64()),
                       pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4") for x in ids], pa.list_(pa.int64())))
                names.append("ids")
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for rows in batches:
            kind = rows.column(0).type
            for key, text in zip(rows.column(0).to_pylist(), rows.column(1), strict=True):
                out.extend(packer.add(key, units.encode(text.as_py()) + end))
                if len(out) >= OUT_ROWS:
                    yield batch()
        out.extend(packer.close())
        if out:
            yield batch()
    return run
