"""MinHash near-dedup by chosen paths (operator 12).

A document is the set of its distinct word shingles.  Equal sets are one set with many
documents (told by a 128-bit digest), so copies never meet each other.  A set has
``COORDINATES`` minwise tokens: the least shingle hash of each coordinate, from one
permutation cut into as many parts, empty parts filled from others by fixed draws.

Every tree branches recursively: a node chooses ``BRANCH`` coordinates by its own path and
hands each set on to the child named by the set's minwise token there, so two sets of
similarity s stay together in s * BRANCH children on average and are seldom parted.  Nodes
of at most ``SMALL`` sets are compared exhaustively; larger ones branch again.  With two
branches a tree finds a pair of similarity 0.85 with probability 0.97 or more at any depth
(the fixed point of f = 1 - (1 - 0.85 f)^2), and ``TREES`` independent trees all miss it
with probability about 1e-6.

A comparison counts equal minwise tokens and drops pairs below ``MATCHES`` of them, six
deviations under the threshold (a loss below 1e-8 a pair).  Sets with a pair left go on with
their text, and the node counts the shared shingles of every such pair (``linked``).  A node
tells a spanning forest of its confirmed links, never all pairs: two sets that a forest
connects are in one component anyhow, so the components are those of all links.

Nodes that stay large after ``LEVELS`` levels (sets too alike to part) are dealt into blocks
with one shared member (``_residue``); once components are known, the members outside the
node's largest component meet every block (``_strangers``).  That is the exact way for the
rest: no cap.

Joins on keys that may be hot are salted by the key's count (``spread_join``).

Defined results: a null or wordless text has an empty set, no links and its own id as
component; a null id takes part but names a component only if all members lack one (then
null, and kept is true by null-safe equality); repeated rows share a component; an empty
table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm import common
from riskflow.llm.components import components

SHINGLE = 5
#: Hundredths of the union that two linked sets share at least.
SIMILARITY = 85
COORDINATES = 128
TREES, BRANCH = 4, 2
SMALL = 4000
LEVELS = 3
#: Equal minwise tokens of a pair worth confirming, at a similarity of 0.85.
MATCHES = 84
#: Rows of a key that one task may meet before the key is salted, and keys a salt table may broadcast.
PER_SALT, BROADCAST_KEYS = 20_000, 500_000
#: Words whose hashes a task remembers.
KNOWN_WORDS = 400_000

_RNG = np.random.default_rng(12)
#: Coordinates in the order the trees' roots take them, and where an empty coordinate looks for a token.
_ORDER = _RNG.permutation(COORDINATES)
_DRAWS = _RNG.integers(0, COORDINATES, (COORDINATES, 96))
_EDGES = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(64 - COORDINATES.bit_length() + 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _ODD
    return h ^ (h >> np.uint64(32))


class Shingles:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, shingle: int = SHINGLE):
        self.shingle, self.known = shingle, {}

    def words(self, raw: bytes) -> np.ndarray:
        from xxhash import xxh64_intdigest
        if len(self.known) > KNOWN_WORDS:
            self.known = {}
        known, words = self.known, raw.lower().split()
        for w in words:
            if w not in known:
                known[w] = xxh64_intdigest(w)
        return np.array([known[w] for w in words], np.uint64)

    def __call__(self, raw: bytes | None) -> np.ndarray:
        words = self.words(raw or b"")
        width = min(len(words), self.shingle)
        if not width:
            return words
        n = len(words) - width + 1
        h = np.full(n, width, np.uint64)
        for k in range(width):
            h = _mixed(h ^ words[k:k + n])
        return np.unique(h)


def digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def minwise(hashes: np.ndarray) -> np.ndarray:
    """The minwise token of every coordinate of a set that is not empty."""
    first = np.searchsorted(hashes, _EDGES)
    after = np.append(first[1:], len(hashes))
    has = first < after
    token = hashes[np.minimum(first, len(hashes) - 1)]
    lacking = np.flatnonzero(~has)
    if len(lacking):
        met = has[_DRAWS[lacking]]
        drawn = _DRAWS[lacking, met.argmax(axis=1)]
        full = np.flatnonzero(has)
        following = full[np.searchsorted(full, lacking) % len(full)]     # all draws empty
        token[lacking] = token[np.where(met.any(axis=1), drawn, following)]
    return token


def root_nodes(tokens: np.ndarray, trees: int = TREES, branch: int = BRANCH) -> np.ndarray:
    """The first level's nodes of a set, ``branch`` for each tree."""
    some = _ORDER[np.arange(trees * branch) % COORDINATES]
    return _mixed(_mixed(np.arange(1, trees * branch + 1, dtype=np.uint64) * _ODD) ^ tokens[some]).view(np.int64)


def sets_of(docs: DataFrame, id_col: str, text_col: str, shingle: int, trees: int) -> DataFrame:
    """doc_id, mark (a hash of the text), n_shingles, set (digest, null if empty), nodes, tokens."""
    narrow = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    narrow = narrow.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    id_type = narrow.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        shingles = Shingles(shingle)
        for rows in batches:
            sizes, digests, nodes, tokens = [], [], [], []
            for text in rows.column(2).cast(pa.binary()):
                hashes = shingles(text.as_py())
                sizes.append(len(hashes))
                if not len(hashes):
                    digests.append(None), nodes.append(None), tokens.append(None)
                    continue
                least = minwise(hashes)
                digests.append(digest(hashes))
                nodes.append(root_nodes(least, trees))
                tokens.append((_mixed(least) >> np.uint64(48)).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(nodes, pa.list_(pa.int64())), pa.array(tokens, pa.binary())],
                names=["doc_id", "mark", "n_shingles", "set", "nodes", "tokens"])
    return narrow.mapInArrow(run, f"doc_id {id_type}, mark long, n_shingles long, set binary, nodes array<long>, tokens binary")


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", per_salt: int = PER_SALT) -> DataFrame:
    """Join on ``key``, unique in ``right``: keys with many rows in ``left`` are
    dealt to several tasks, their row of ``right`` copied to each."""
    hot = left.groupBy(key).count().filter(F.col("count") > per_salt).select(
        F.col(key).alias("_hot"), F.ceil(F.col("count") / per_salt).cast("int").alias("_salts"))
    hot = common.stored(hot, "hot-keys")
    found = hot.count()
    if not found:
        return left.join(right, key, how)
    if found <= BROADCAST_KEYS:
        hot = F.broadcast(hot)

    def salted(df: DataFrame, salt: Column) -> DataFrame:
        return df.join(hot, F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt).drop("_hot", "_salts")
    many = F.coalesce("_salts", F.lit(1))
    others = [c for c in left.columns if c != key]
    dealt = salted(left, F.pmod(F.xxhash64(*others), many).cast("int"))
    copied = salted(right, F.explode(F.sequence(F.lit(0), many - 1)))
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """(node, set, size): rows of nodes with two sets or more."""
    sizes = common.stored(rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"), f"{name}-sizes")
    return common.stored(spread_join(rows, sizes, "node"), name)


def _children(rows: DataFrame, branch: int = BRANCH) -> DataFrame:
    """(node, set, tokens) of large nodes to the next level: the path chooses the coordinates."""
    one = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(COORDINATES))
    steps = [F.pmod(one + k * (1 + 2 * F.pmod(F.xxhash64("node", F.lit(2)), F.lit(COORDINATES // 4))), F.lit(COORDINATES))
             for k in range(branch)]
    children = F.array(*[F.xxhash64("node", c, F.substring(F.col("tokens"), (2 * c + 1).cast("int"), F.lit(2))) for c in steps])
    return rows.select(F.explode(children).alias("node"), "set")


def near(sizes: np.ndarray, tokens: np.ndarray, i: int, others: np.ndarray, similarity: int, matches: int) -> np.ndarray:
    """Those of ``others`` that may be similar to set ``i`` by size and by minwise tokens."""
    least, most = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
    others = others[100 * least >= similarity * most]
    return others[(tokens[others] == tokens[i]).sum(axis=1) >= matches] if len(others) else others


def linked(sets: list[np.ndarray], labels: list | None = None, similarity: int = SIMILARITY,
           matches: int = MATCHES) -> list[tuple[int, int]]:
    """Confirmed links of one node's sets that connect whatever all its similar
    pairs connect; sets of one label count as connected.  Set after set is
    counted against those of other components only."""
    sizes = np.array([len(h) for h in sets])
    tokens = np.stack([minwise(h) for h in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    number: dict = {}
    component = np.array([number.setdefault(x, len(number)) for x in (labels or range(len(sets)))])
    mark = np.zeros(codes.max() + 1, bool)
    out = []
    for i in range(len(sets) - 1):
        others = i + 1 + np.flatnonzero(component[i + 1:] != component[i])
        others = near(sizes, tokens, i, others, similarity, matches)
        if not len(others):
            continue
        n = sizes[others]
        at = np.cumsum(n) - n
        mine = slice(ends[i] - sizes[i], ends[i])
        mark[codes[mine]] = True
        theirs = codes[np.arange(n.sum()) + np.repeat(ends[others] - n - at, n)]
        shared = np.add.reduceat(mark[theirs], at, dtype=np.int64)
        mark[codes[mine]] = False
        for j in others[100 * shared >= similarity * (n + sizes[i] - shared)].tolist():
            if component[j] != component[i]:
                out.append((i, j))
                component[component == component[j]] = component[i]
    return out


def _nodes(batches: Iterable, read: object) -> Iterator[tuple]:
    """(node, columns of its rows) of rows sorted by node, read from Arrow by ``read``."""
    held: list = []
    of = None
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        edge = [0, *(np.flatnonzero(np.diff(nodes)) + 1).tolist(), len(nodes)]
        for b, e in zip(edge, edge[1:], strict=False):
            if b == e:
                continue
            if held and nodes[b] != of:
                yield of, [x for part in held for x in part]
                held = []
            of = int(nodes[b])
            held.append(read(batch.slice(b, e - b)))
    if held:
        yield of, [x for part in held for x in part]


def _active(similarity: int, matches: int):
    """Rows (node, set, size, tokens, label) sorted by node to the (node, set, label)
    that have a near set of another label in their node."""
    def read(rows: object) -> list:
        return list(zip(*(c.to_pylist() for c in rows.columns[1:]), strict=True))

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        kinds = (pa.int64(), pa.binary(), pa.binary())

        def told(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                              names=["node", "set", "label"])
        out: list = []
        for node, rows in _nodes(batches, read):
            sizes = np.array([r[1] for r in rows])
            tokens = np.frombuffer(b"".join([r[2] for r in rows]), "<u2").reshape(len(rows), -1)
            number: dict = {}
            label = np.array([number.setdefault(r[3] or r[0], len(number)) for r in rows])
            hit = np.zeros(len(rows), bool)
            for i in range(len(rows) - 1):
                met = near(sizes, tokens, i, i + 1 + np.flatnonzero(label[i + 1:] != label[i]), similarity, matches)
                hit[met] = True
                hit[i] |= len(met) > 0
            out += [(node, rows[i][0], rows[i][3]) for i in np.flatnonzero(hit).tolist()]
            if len(out) > 5000:
                yield told(out)
                out = []
        if out:
            yield told(out)
    return run


def _confirm(shingle: int, similarity: int, matches: int):
    """Rows (node, set, label, text) sorted by node to confirmed links (u, v)."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        shingles = Shingles(shingle)

        def read(rows: object) -> list:
            texts = rows.column(3).cast(pa.binary())
            return [(s, x, shingles(t.as_py())) for s, x, t in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(),
                                                                   texts, strict=True)]
        for _, rows in _nodes(batches, read):
            labels = None if rows[0][1] is None else [r[1] for r in rows]
            pairs = linked([r[2] for r in rows], labels, similarity, matches)
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([rows[p[k]][0] for p in pairs], pa.binary()) for k in (0, 1)],
                                                 names=["u", "v"])
    return run


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.select(F.col("node").alias("set"), F.col("root").alias("label"))
    return rows.join(named, "set", "left").withColumn("label", F.coalesce("label", "set"))


def _residue(large: DataFrame, small: int) -> tuple[DataFrame, DataFrame]:
    """Large nodes' rows in blocks, (node, set, of, block, blocks): every block also holds the node's least set."""
    blocks = F.ceil(F.col("size") / (small / 2)).cast("int")
    dealt = large.select(F.col("node").alias("of"), "set", blocks.alias("blocks"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("of", "set"), F.col("blocks")).cast("int"))
    hubs = dealt.groupBy("of").agg(F.min("set").alias("set"), F.first("blocks").alias("blocks"))
    hubs = hubs.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    both = dealt.unionByName(hubs.select(*dealt.columns)).dropDuplicates(["of", "set", "block"])
    return dealt, both.select(F.xxhash64("of", "block").alias("node"), "set")


def _strangers(dealt: DataFrame, labels: DataFrame, small: int) -> DataFrame:
    """Groups (node, set) in which the sets outside their node's largest component meet every block of it."""
    rows = common.stored(_labelled(dealt, labels), "residue-labels")
    counts = common.stored(rows.groupBy("of", "label").count(), "residue-counts")
    main = common.stored(counts.groupBy("of").agg(F.max_by("label", F.struct("count", "label")).alias("main"),
                                                  (F.sum("count") - F.max("count")).alias("others")).filter("others > 0"),
                         "residue-main")
    rows = spread_join(rows, main, "of").withColumn("chunks", F.ceil(F.col("others") / (small / 2)).cast("int"))
    own = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    guests = (rows.filter("label <> main").withColumn("chunk", F.pmod(F.xxhash64("set", "of"), F.col("chunks")).cast("int"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    keys = [F.xxhash64("of", "block", "chunk").alias("node"), "set"]
    return own.select(*keys).unionByName(guests.select(*keys)).distinct()


def _texts(active: DataFrame, reps: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(set, text) of the sets in ``active``: one of the documents that have it."""
    wanted = common.stored(active.select("set").distinct().join(reps.select("set", "rep"), "set"), "path-wanted")
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    rows = docs.select(id_.alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    # Rows meet by the text's hash, so that a null id can be compared null-safe.
    named = wanted.select("set", F.col("rep.mark").alias("of"), F.col("rep.doc_id").alias("id"))
    if wanted.count() <= BROADCAST_KEYS:
        named = F.broadcast(named)
    met = rows.join(named, (F.col("mark") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")))
    return common.stored(met.groupBy("set").agg(F.min("text").alias("text")), "path-texts")


def links(docs: DataFrame, sets: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
          similarity: int = SIMILARITY, matches: int = MATCHES, small: int = SMALL, levels: int = LEVELS) -> DataFrame:
    """Confirmed links (u, v) between distinct sets that connect whatever all similar pairs connect."""
    reps = common.stored(sets.filter("set is not null").groupBy("set").agg(
        F.min(F.struct("doc_id", "mark")).alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("nodes").alias("nodes"), F.first("tokens").alias("tokens")), "path-sets")

    def confirmed(members: DataFrame, labels: DataFrame | None) -> DataFrame:
        rows = members.join(reps.select("set", "n_shingles", "tokens"), "set")
        rows = rows.withColumn("label", F.lit(None).cast("binary")) if labels is None else _labelled(rows, labels)
        rows = rows.select("node", "set", "n_shingles", "tokens", "label").repartition("node").sortWithinPartitions("node", "set")
        active = common.stored(rows.mapInArrow(_active(similarity, matches), "node long, set binary, label binary"), "path-active")
        # Trees often meet the same sets again: one node of each group is enough.
        alike = active.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("set")).alias("x"),
                                           F.bit_xor(F.xxhash64("set", F.lit(1))).alias("y"))
        once = common.stored(alike.groupBy("n", "x", "y").agg(F.min("node").alias("node")).select("node"), "path-once")
        texts = _texts(active, reps, docs, id_col, text_col)
        full = spread_join(active.join(once, "node", "left_semi"), texts, "set", per_salt=1000)
        full = full.select("node", "set", "label", "text").repartition("node").sortWithinPartitions("node", "set")
        return common.stored(full.mapInArrow(_confirm(shingle, similarity, matches), "u binary, v binary"), "path-links")

    rows, members, large = reps.select(F.explode("nodes").alias("node"), "set"), [], None
    for level in range(levels):
        counted = _counted(rows, f"path-level-{level}")
        members.append(counted.filter(F.col("size") <= small).select("node", "set"))
        large = counted.filter(F.col("size") > small)
        if large.isEmpty():
            large = None
            break
        if level + 1 < levels:
            rows = _children(large.join(reps.select("set", "tokens"), "set"))
    if large is not None:
        dealt, blocks = _residue(large, small)
        members.append(common.stored(blocks, "path-blocks"))
    found = confirmed(functools.reduce(DataFrame.unionByName, members), None)
    if large is None:
        return found
    labels = common.stored(components(found), "path-labels")
    return found.unionByName(confirmed(common.stored(_strangers(dealt, labels, small), "path-strangers"), labels))


def minhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                  similarity: int = SIMILARITY, matches: int = MATCHES, trees: int = TREES, small: int = SMALL,
                  levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id
    reachable over linked sets), kept (doc_id = component_id)."""
    sets = common.stored(sets_of(docs, id_col, text_col, shingle, trees), "path-documents")
    met = links(docs, sets, id_col, text_col, shingle, similarity, matches, small, levels)
    roots = common.stored(components(met), "path-roots")
    least = sets.filter("set is not null").groupBy("set").agg(F.min("doc_id").alias("least"))
    labelled = common.stored(least.join(roots, F.col("set") == F.col("node"), "left")
                             .select("set", "least", F.coalesce("root", "set").alias("root")), "path-labelled")
    named = common.stored(labelled.groupBy("root").agg(F.min("least").alias("component_id")), "path-named")
    ids = common.stored(spread_join(labelled.select("set", "root"), named, "root").select("set", "component_id"), "path-ids")
    full = spread_join(sets.filter("set is not null").select("doc_id", "n_shingles", "set"), ids, "set")
    rows = full.select("doc_id", "n_shingles", "component_id").unionByName(
        sets.filter("set is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
