"""Hard negatives by an STR-packed R-tree (operator 13).

Vectors become integers, floor(scale * x), so scores are exact inner products.
The rows are packed by sort-tile-recursive: slabs of equal counts along the three
widest coordinates give tiles (``_tiled``; cut points from distributed percentiles,
and a tile that equal coordinates make too large is dealt into several).  A tile is
packed again by the same rule into leaves and inner boxes (``Tree``).  Of each box
only the least and greatest value of every coordinate are kept; with an anchor's
coordinates they bound from both sides the score of everything inside (``bounds``).

An anchor goes to the tiles whose bounds meet its score windows, and each tile is
searched best first: a queue gives the box with the greatest bound, boxes outside the
window are dropped, and the search ends when that bound lies strictly below the kth
score found.  A tile answers with at most k rows, merged by score and id.  First
pass: the first positives of the same label; second pass: for every positive the
first negatives of other labels inside its window of scores.

Anchors are a stated query set against all rows: they stream through a tile in
blocks next to its tree, so memory holds one tile (``TILE_ROWS``, ``TILE_BYTES``) and
one block.  The directory of tile boxes on the driver has one entry for that many rows.

Defined results: rows with a null label or vector, or with a null, NaN, infinite
component or one beyond ``largest`` after scaling (2**28 for 64 coordinates: its scores
would not fit a long) take no part; shorter vectors are padded with zeros, an empty one is all zeros; a null id is
never chosen as an anchor by a condition on it, and comes last among ties; repeated rows are
rows of their own, so a copy is a positive of its twin; anchors without positives and
positives without negatives give no rows; ids and labels are integers; other columns
are not read, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm import common

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative scores between these hundredths of the positive's score.
LOW, HIGH = 30, 90
#: Tiles are made for this many parts of the rows, until a tile reaches its limits.
TILES = 48
TILE_ROWS, TILE_BYTES = 65_536, 1 << 25
LEAF_ROWS, FAN = 128, 16
#: Anchors in one block.
BLOCK = 256
_LONG = 1 << 62


def largest(width: int) -> int:
    """Scaled components up to this keep every score of that many coordinates in a long."""
    return min(math.isqrt(_LONG // max(width, 1)), (1 << 31) - 1)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b of integer arrays: in doubles where every sum fits their mantissa."""
    top = max(int(np.abs(a).max(initial=0)), 1) * max(int(np.abs(b).max(initial=0)), 1) * max(b.shape[0], 1)
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible score of each query inside each box."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return dots(up, low.T) + dots(down, high.T), dots(up, high.T) + dots(down, low.T)


def str_order(vectors: np.ndarray, capacity: int) -> np.ndarray:
    """Rows in the order of sort-tile-recursive packing along the three widest coordinates."""
    n = len(vectors)
    if n <= capacity or not vectors.shape[1]:
        return np.arange(n)
    widest = np.argsort(-vectors.var(axis=0), kind="stable")[:3]
    slabs = int(np.ceil((n / capacity) ** (1 / len(widest))))
    parts = [np.arange(n)]
    for c in widest:
        parts = [p for part in parts
                 for p in np.array_split(part[np.argsort(vectors[part, c], kind="stable")], slabs)]
    return np.concatenate(parts)


class Tree:
    """The R-tree of one tile: ``levels[0]`` are the leaves' boxes, the last level is the root."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, known: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = str_order(vectors, LEAF_ROWS)
        self.rows, self.ids, self.known, self.labels = rows[order], ids[order], known[order], labels[order]
        self.vectors = vectors[order].astype(np.int64)
        starts = np.arange(0, len(order), LEAF_ROWS)
        boxes = np.minimum.reduceat(self.vectors, starts), np.maximum.reduceat(self.vectors, starts)
        self.levels = [boxes]
        while len(boxes[0]) > 1:
            starts = np.arange(0, len(boxes[0]), FAN)
            boxes = np.minimum.reduceat(boxes[0], starts), np.maximum.reduceat(boxes[1], starts)
            self.levels.append(boxes)

    def bounds(self, queries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        return [bounds(queries, low, high) for low, high in self.levels]

    def leaf(self, at: int) -> slice:
        return slice(at * LEAF_ROWS, min((at + 1) * LEAF_ROWS, len(self.rows)))

    def first(self, query: int, limits: list, scores: Callable[[int], np.ndarray],
              allowed: Callable[[slice], np.ndarray], k: int, low: int, high: int) -> list[tuple]:
        """The first ``k`` (-score, id is null, id, row) among allowed rows that score in [low, high]."""
        found: list[tuple] = []
        top = len(limits) - 1
        queue = [(-int(limits[top][1][query, i]), top, i) for i in range(limits[top][1].shape[1])]
        heapq.heapify(queue)
        while queue:
            most, level, at = heapq.heappop(queue)
            most = -most
            if most < low or len(found) == k and most < -found[-1][0]:
                break                                   # and so is every box left
            if level:
                least, greatest = limits[level - 1]
                for child in range(at * FAN, min((at + 1) * FAN, greatest.shape[1])):
                    bound = int(greatest[query, child])
                    if int(least[query, child]) <= high and bound >= low:
                        heapq.heappush(queue, (-bound, level - 1, child))
                continue
            here = self.leaf(at)
            got = scores(at)
            kth = max(low, -found[-1][0]) if len(found) == k else low
            good = np.flatnonzero((got >= kth) & (got <= high) & allowed(here))
            if len(good):
                good = good[np.argsort(-got[good], kind="stable")]
                if len(good) > k:                       # the first k and their ties
                    good = good[got[good] >= got[good[k - 1]]]
                place = here.start + good
                found += zip((-got[good]).tolist(), (~self.known[place]).tolist(), self.ids[place].tolist(),
                             self.rows[place].tolist(), strict=True)
                found = sorted(found)[:k]
        return found


def _prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchors: Column, scale: int,
              width: int) -> DataFrame:
    x = F.transform(F.col(f"`{vector_col}`"), lambda c: c.cast("double") * scale)
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("anchor"), x.alias("x"))
    most = float(largest(width))
    good = F.forall("x", lambda c: F.coalesce(c.between(-most, most), F.lit(False)))     # NaN is above all
    return (rows.filter(F.col("label").isNotNull() & F.col("x").isNotNull() & F.coalesce(good, F.lit(False)))
            .select(F.monotonically_increasing_id().alias("row"), "id", "label", "anchor",
                    F.transform("x", lambda c: F.floor(c).cast("int")).alias("x")))


def _matrix(column: object, width: int) -> np.ndarray:
    """An Arrow list column as a matrix, shorter lists padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int32)
    out[np.repeat(np.arange(len(column)), lengths), np.concatenate([np.arange(n) for n in lengths])] = flat
    return out


def _widest(rows: DataFrame, width: int) -> list[int]:
    """The three coordinates of greatest variance: sums per task, one row a coordinate to the driver."""
    def sums(batches: Iterable) -> Iterator:
        import pyarrow as pa
        total, squares, n = np.zeros(width), np.zeros(width), 0
        for batch in batches:
            x = _matrix(batch.column(0), width).astype(np.float64)
            total, squares, n = total + x.sum(0), squares + (x * x).sum(0), n + len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width), pa.int32()), pa.array(total), pa.array(squares), pa.array(np.full(width, n))],
            names=["c", "s", "q", "n"])
    parts = rows.select("x").mapInArrow(sums, "c int, s double, q double, n long")
    got = parts.groupBy("c").agg((F.sum("q") / F.sum("n") - F.pow(F.sum("s") / F.sum("n"), 2)).alias("v")).collect()
    return [r["c"] for r in sorted(got, key=lambda r: (-r["v"], r["c"]))[:3]]


def _tiled(rows: DataFrame, width: int, tiles: int, tile_rows: int) -> tuple[DataFrame, int]:
    """Rows with their tile, and the number of tiles."""
    coordinates = _widest(rows, width) if tiles > 1 else []
    slabs = int(np.ceil(tiles ** (1 / len(coordinates)))) if coordinates else 1
    levels: list[np.ndarray] = []
    values = [F.get("x", F.lit(c)) for c in coordinates]

    def slab_of(known: list[np.ndarray]):
        @F.pandas_udf("long")
        def place(*columns: pd.Series) -> pd.Series:
            at = np.zeros(len(columns[0]), np.int64)
            for cuts, column in zip(known, columns, strict=True):
                v = column.fillna(0).to_numpy()
                at = at * slabs + (cuts[at] < v[:, None]).sum(axis=1)
            return pd.Series(at)
        return place(*values[:len(known)]) if known else F.lit(0).cast("long")

    shares = [i / slabs for i in range(1, slabs)]
    for value in values if slabs > 1 else []:
        got = (rows.select(slab_of(levels).alias("slab"), F.coalesce(value, F.lit(0)).alias("v"))
               .groupBy("slab").agg(F.percentile_approx("v", shares).alias("cuts")).collect())
        cuts = np.full((slabs ** len(levels), slabs - 1), _LONG, np.int64)
        for r in got:
            cuts[r["slab"]] = r["cuts"]
        levels = [*levels, cuts]
    placed = rows.withColumn("slab", slab_of(levels))
    counts = {r["slab"]: r["count"] for r in placed.groupBy("slab").count().collect()}
    pieces = np.ones(max(counts) + 1, np.int64)
    for slab, count in counts.items():
        pieces[slab] = -(-count // tile_rows)
    base = np.cumsum(pieces) - pieces

    @F.pandas_udf("int")
    def tile(slab: pd.Series, spread: pd.Series) -> pd.Series:
        at = slab.to_numpy()
        return pd.Series(base[at] + spread.to_numpy() % pieces[at], dtype="int32")
    spread = F.pmod(F.xxhash64("row"), F.lit(1 << 40))
    return placed.withColumn("tile", tile("slab", spread)).drop("slab"), int(pieces.sum())


_TILE = "tile int, low binary, high binary, rows binary, ids binary, known binary, labels binary, vectors binary"


def _index(tiled: DataFrame, tiles: int, width: int) -> DataFrame:
    """One row per tile: its box and its packed rows."""
    def pack(batches: Iterable) -> Iterator:
        import pyarrow as pa

        def packed(tile: int, parts: list) -> pa.RecordBatch:
            rows, ids, known, labels, x = (np.concatenate(c) for c in zip(*parts, strict=True))
            cells = (x.min(0).astype("<i8"), x.max(0).astype("<i8"), rows, ids, known, labels, x)
            return pa.RecordBatch.from_arrays(
                [pa.array([tile], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
                names=["tile", "low", "high", "rows", "ids", "known", "labels", "vectors"])

        tile, parts = None, []
        for batch in batches:
            at = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for b, e in zip(edges, edges[1:], strict=False):
                if b == e:
                    continue
                if parts and at[b] != tile:
                    yield packed(tile, parts)
                    parts = []
                tile, some = int(at[b]), batch.slice(b, e - b)
                ids = some.column(2)
                parts.append((some.column(1).to_numpy(), ids.fill_null(0).to_numpy(),
                              ids.is_valid().to_numpy(zero_copy_only=False), some.column(3).to_numpy(),
                              _matrix(some.column(4), width)))
        if parts:
            yield packed(tile, parts)

    rows = tiled.select("tile", "row", "id", "label", "x").repartitionById(tiles, F.col("tile")).sortWithinPartitions("tile", "row")
    return rows.mapInArrow(pack, _TILE)


_ASK = "tile int, rows binary, labels binary, vectors binary, windows binary"


def _asked(anchors: DataFrame, directory: np.ndarray, width: int, block: int) -> DataFrame:
    """Blocks of anchors for every tile whose bounds meet one of their windows.

    ``anchors``: row, label, x, windows (array of [low, high] pairs, flat)."""
    low, high = directory

    def send(batches: Iterable) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                some = batch.slice(at, block)
                rows, labels = some.column(0).to_numpy(), some.column(1).to_numpy()
                x = _matrix(some.column(2), width)
                windows = some.column(3).to_pylist()
                least, greatest = bounds(x, low, high)
                lo = np.array([min(w[::2]) for w in windows])[:, None]
                hi = np.array([max(w[1::2]) for w in windows])[:, None]
                meets = (least <= hi) & (greatest >= lo)
                for tile in np.flatnonzero(meets.any(axis=0)):
                    who = np.flatnonzero(meets[:, tile])
                    flat = np.array([v for i in who for v in (len(windows[i]), *windows[i])], "<i8")
                    cells = (rows[who], labels[who], x[who], flat)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tile], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in cells)],
                        names=["tile", "rows", "labels", "vectors", "windows"])
    return anchors.select("row", "label", "x", "windows").mapInArrow(send, _ASK)


def _searched(index: DataFrame, asked: DataFrame, tiles: int, width: int, k: int, same_label: bool) -> DataFrame:
    """(anchor, nth window, score, id, row): the first k of every window in every tile."""
    empty = F.lit(None).cast("binary")
    trees = index.select("tile", F.lit(0).alias("kind"), "rows", "ids", "known", "labels", "vectors", empty.alias("windows"))
    asks = asked.select("tile", F.lit(1).alias("kind"), "rows", empty.alias("ids"), empty.alias("known"), "labels",
                        "vectors", "windows")
    both = trees.unionByName(asks).repartitionById(tiles, F.col("tile")).sortWithinPartitions("tile", "kind")

    def answers(tree: Tree, rows: np.ndarray, labels: np.ndarray, x: np.ndarray, windows: np.ndarray) -> Iterator[tuple]:
        limits = tree.bounds(x)
        at = 0
        for q in range(len(rows)):
            mine, label, known = x[q].astype(np.int64)[:, None], labels[q], {}

            def scores(leaf: int, mine=mine, known=known) -> np.ndarray:
                if leaf not in known:
                    known[leaf] = dots(tree.vectors[tree.leaf(leaf)], mine)[:, 0]
                return known[leaf]

            def allowed(here: slice, q=q, label=label) -> np.ndarray:
                if same_label:
                    return (tree.labels[here] == label) & (tree.rows[here] != rows[q])
                return tree.labels[here] != label

            own, at = windows[at + 1:at + 1 + windows[at]].tolist(), at + 1 + int(windows[at])
            for nth in range(len(own) // 2):
                if own[2 * nth] > own[2 * nth + 1]:
                    continue
                for score, unknown, found, row in tree.first(q, limits, scores, allowed, k, own[2 * nth], own[2 * nth + 1]):
                    yield int(rows[q]), nth, -score, None if unknown else found, row

    def search(batches: Iterable) -> Iterator:
        import pyarrow as pa
        kinds, names = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()], ["anchor", "nth", "score", "id", "row"]
        tree, of = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                tile, kind = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()

                def cell(c: int, dtype: str, batch=batch, i=i) -> np.ndarray:
                    return np.frombuffer(batch.column(c)[i].as_py(), dtype)
                x = cell(6, "<i4").reshape(-1, width)
                if not kind:
                    tree, of = Tree(cell(2, "<i8"), cell(3, "<i8"), cell(4, "?"), cell(5, "<i8"), x), tile
                elif of == tile:
                    out = list(answers(tree, cell(2, "<i8"), cell(5, "<i8"), x, cell(7, "<i8")))
                    if out:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
    return both.mapInArrow(search, "anchor long, nth int, score long, id long, row long")


def _first(found: DataFrame, k: int) -> DataFrame:
    """The tiles' answers merged, with their rank."""
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, scale: int = SCALE, tiles: int = TILES, tile_rows: int = TILE_ROWS,
         block: int = BLOCK) -> DataFrame:
    """For every row chosen by the condition ``anchors`` and each of its first
    ``positives`` the first ``negatives`` rows of other labels that score
    between ``low`` and ``high`` hundredths of the positive's score:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    width = max(vectors.agg(F.max(F.size(F.col(f"`{vector_col}`")))).first()[0] or 0, 1)
    rows = common.stored(_prepared(vectors, id_col, vector_col, label_col, anchors, scale, width), "negatives-rows")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], out)
    most = max(1, min(tile_rows, TILE_BYTES // (4 * width)))
    tiled, count = _tiled(rows, width, max(-(-n // most), min(tiles, -(-n // LEAF_ROWS))), most)
    index = common.stored(_index(tiled, count, width), "negatives-index")
    boxes = index.select("tile", "low", "high").collect()          # one a tile
    directory = np.zeros((2, count, width), np.int64)       # a tile without rows answers nothing
    for r in boxes:
        directory[:, r["tile"]] = np.frombuffer(r["low"], "<i8"), np.frombuffer(r["high"], "<i8")

    asking = rows.filter("anchor").select("row", "id", "label", "x")
    everything = F.array(F.lit(-_LONG), F.lit(_LONG))
    near = _searched(index, _asked(asking.withColumn("windows", everything), directory, width, block),
                     count, width, positives, True)
    chosen = common.stored(_first(near, positives).select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"),
                                                          F.col("score").alias("positive_score")), "negatives-positives")
    # Bounds of 100 * score in whole scores; a positive below zero leaves an empty window.
    score = F.col("positive_score").cast("decimal(20,0)")
    lower, upper = F.ceil(score * F.lit(low) / 100).cast("long"), F.floor(score * F.lit(high) / 100).cast("long")
    windows = (chosen.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", lower.alias("l"), upper.alias("u")))).alias("w"))
               .select(F.col("anchor").alias("row"), F.flatten(F.transform("w", lambda w: F.array(w["l"], w["u"]))).alias("windows")))
    far = _searched(index, _asked(asking.join(windows, "row"), directory, width, block), count, width, negatives, False)
    best = _first(far, negatives).select("anchor", (F.col("nth") + 1).alias("place"), "rank",
                                         F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return best.join(chosen, ["anchor", "place"]).join(named, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
