"""Repeated substrings by merging shard Burrows-Wheeler transforms.

A collection of byte strings is cut into shards.  Each shard's suffixes are
sorted once and give its transform: for every rank the ``STEP`` bytes in front
of the suffix and the rank one step back (the last-to-first mapping).  The
shards are merged without sorting suffixes again: starting from all shards end
to end, one round carries the interleaving at depth h to depth h + STEP by one
stable distribution of the bytes in front, as Holt and McMillan's merge does
byte by byte.  Borders between blocks that appear in a round are the common
prefixes of that depth.  A block of one suffix stays one, so it is left out of
the later rounds; the blocks left at the last depth are the repeated intervals.
"""

from __future__ import annotations

import numpy as np

#: Bytes a round goes back.
STEP = 4
#: Strings per shard.
SHARD = 64


class Shard:
    """Transform of a few strings.  Ranks count from ``base``."""

    def __init__(self, text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, base: int):
        longest = int(lengths.max()) + 1          # the empty suffix counts
        rows = np.zeros((len(starts), 2 * longest), np.uint8)
        at = np.arange(longest)
        filled = at < lengths[:, None]
        rows[:, :longest][filled] = text[(starts[:, None] + at)[filled]]
        string, offset = np.nonzero(at <= lengths[:, None])
        suffixes = np.lib.stride_tricks.sliding_window_view(rows, longest, axis=1)[string, offset]
        order = np.argsort(np.ascontiguousarray(suffixes).view(f"S{longest}").ravel(), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        first = np.cumsum(lengths + 1) - lengths - 1       # of each string, among the suffixes in text order
        self.string, self.offset = string[order], offset[order]
        self.has = self.offset >= STEP
        back = np.where(self.has, first[self.string] + self.offset - STEP, 0)
        self.back = rank[back] + base
        place = starts[self.string] + np.where(self.has, self.offset - STEP, 0)
        self.grams = np.zeros(len(order), np.uint32)
        for k in range(STEP):
            self.grams = self.grams << 8 | text[np.minimum(place + k, len(text) - 1)]


def _stable(grams: np.ndarray) -> np.ndarray:
    """Stable order of 32-bit keys by two distributions of 16 bits."""
    low = np.argsort((grams & 0xFFFF).astype(np.uint16), kind="stable")
    return low[np.argsort((grams[low] >> 16).astype(np.uint16), kind="stable")]


def repeated(strings: list[bytes], depth: int, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, block) of every substring of ``depth`` bytes (a
    multiple of STEP) that stands more than once in the collection; equal
    substrings share a block.  Bytes are nonzero."""
    empty = np.zeros(0, np.int64)
    if not strings:
        return empty, empty, empty
    text = np.frombuffer(b"".join(strings), np.uint8)
    lengths = np.array([len(s) for s in strings], np.int64)
    starts = np.cumsum(lengths) - lengths
    if not len(text):
        return empty, empty, empty
    shards, base = [], 0
    for at in range(0, len(strings), shard):
        shards.append((at, Shard(text, starts[at:at + shard], lengths[at:at + shard], base)))
        base += len(shards[-1][1].string)
    string = np.concatenate([s.string + at for at, s in shards])
    offset = np.concatenate([s.offset for _, s in shards])
    back, has = np.concatenate([s.back for _, s in shards]), np.concatenate([s.has for _, s in shards])
    grams = np.concatenate([s.grams for _, s in shards])
    order = np.arange(base)                 # the interleaving: global ranks
    block = np.zeros(base, np.int64)
    for _ in range(depth // STEP):
        kept = has[order]
        order, block = order[kept], block[kept]
        if not len(order):
            return empty, empty, empty
        gram = grams[order]
        moved = _stable(gram)
        gram, old, order = gram[moved], block[moved], back[order[moved]]
        border = np.empty(len(order), bool)
        border[0] = True
        border[1:] = (gram[1:] != gram[:-1]) | (old[1:] != old[:-1])
        block = np.cumsum(border)
        alone = border.copy()
        alone[:-1] &= border[1:]
        order, block = order[~alone], block[~alone]
    return string[order], offset[order], block
