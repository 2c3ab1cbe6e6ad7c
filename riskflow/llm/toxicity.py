"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks (operator 1).

The kernel of two words counts their common subsequences of ``ORDER`` letters,
each occurrence weighed by ``DECAY`` to the power of its span, spans up to
``SPAN`` characters; so an insult keeps most of its kernel value when letters
are inserted into it or left out.  Characters that are no letters only widen
spans.  Letters written apart ("i d i o t", over any white space) and
neighbouring short words ("id iot") are read as one word as well, and so is a
word without one letter that stands at every second place ("ixdxixoxt").  A
sentence's kernel with a landmark is its best word's.

Training is bounded (``MAX_TOXIC`` and ``MAX_CLEAN`` labelled documents, the
first by a hash, equal texts once; of a text above ``MAX_CHARS`` characters
sentences drawn by a hash, at most twice as many characters; ``MAX_WORDS``
distinct words, the most telling, the most frequent and a spread of the rest)
and runs on the driver.  The texts are cut into sentences.  Those of a clean
document are labelled clean.  A toxic document's are labelled toxic to the
degree that their worst word comes near the document's worst: over a few rounds
the votes of the label move to the sentences, and in a sentence to the words,
that the model finds toxic; a word that only one toxic document has gets none.
The SVM (squared hinge) is fitted on
Nystroem features of the kernel, whose landmarks are the words that tell most
and frequent ones.  Because a word has few subsequences, landmarks and their
weights fold into one weight per subsequence; with that table of fixed size
the tasks value every distinct word of every whole text once.  A document's
score is a logistic of the largest and the mean of the three largest word
values, and of its length.

Defined results: null and empty texts score as a text without words; a null id
is kept and is never used for training; labels that are null, or whose document
is missing, are not used; if a training label is missing altogether every
score is 0; of rows that share an id one is trained on; repeated rows are scored
each; other columns are not read.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

ORDER, SPAN, DECAY = 4, 7, 0.7
#: Letter codes: 1-26 for a-z, then classes of other letters; 0 is no letter.
CODES = 40
#: Subsequences are hashed to this many features.
FEATURE_BITS = 16
FEATURES = 1 << FEATURE_BITS
#: Longer words are read in windows of this length, half overlapping.
WINDOW = 16
LANDMARKS = 256
MAX_TOXIC, MAX_CLEAN = 2000, 3000
#: Characters of a training document; of longer ones some sentences are drawn.
MAX_CHARS = 10_000
#: Distinct words of the training sentences that the SVM is fitted on.
MAX_WORDS = 12_000
#: Neighbouring words up to this length are read together as well.
SHORT = 3
ROUNDS = 3
#: Distinct words whose value a task keeps.
CACHE_WORDS = 500_000

#: A sentence ends at a line end or at white space after one of these.
SENTENCE_END = r"(?<=[.!?])\s+|\n+"
_SENTENCE = re.compile(SENTENCE_END)
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def _codes() -> np.ndarray:
    """Letter code of every character of the basic plane; the last is for all others."""
    table = np.zeros(0x10001, np.uint32)
    for char in range(0x10000):
        if chr(char).isalpha():
            table[char] = char - 96 if 97 <= char <= 122 else 27 + char % (CODES - 27)
    return table


_CODE = _codes()


def sentences(text: str | None) -> list[str]:
    return [part for part in _SENTENCE.split(text or "") if part.strip()]


def words(text: str | None) -> list[str]:
    """Lower-case words of a text, runs of four or more single characters
    joined, and short neighbours that are four letters or more together."""
    found = (text or "").lower().split()
    joined, run = [], []
    before = 0
    for at, word in enumerate(found):
        size = len(word)
        if size <= SHORT:
            if 0 < before and before + size >= ORDER:
                joined.append(found[at - 1] + word)
            if size == 1:
                run.append(word)
        if run and size != 1:
            if len(run) >= ORDER:
                joined.append("".join(run))
            run = []
        before = size if size <= SHORT else 0
    if len(run) >= ORDER:
        joined.append("".join(run))
    return found + joined


def windows(word: str) -> list[str]:
    """The word between its first and last letter, cut to overlapping windows;
    also without the one letter that stands at every second place."""
    kept = word if word.isalpha() else _EDGES.sub("", word)
    odd = kept[1::2]
    if len(kept) >= 2 * ORDER - 1 and odd == odd[0] * len(odd):
        return _cut(kept) + _cut(kept[::2])
    return _cut(kept)


def _cut(kept: str) -> list[str]:
    if len(kept) <= WINDOW:
        return [kept]
    return [kept[at:at + WINDOW] for at in range(0, len(kept) - WINDOW // 2, WINDOW // 2)]


_PICKS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _picks(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all subsequences within the span, and their weights."""
    if length not in _PICKS:
        found = [(i, *(i + x for x in rest)) for i in range(length)
                 for rest in combinations(range(1, min(SPAN, length - i)), ORDER - 1)]
        at = np.array(found, np.int64).reshape(-1, ORDER)
        _PICKS[length] = at, (DECAY ** (at[:, -1] - at[:, 0] + 1 - ORDER)).astype(np.float32)
    return _PICKS[length]


def subsequences(same_length: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, weights, norms) of words of one length: a row per word.  A
    word's norm is that of its occurrences, as if no subsequence came twice."""
    length = len(same_length[0])
    chars = np.frombuffer("".join(same_length).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, length)
    letters = _CODE[np.minimum(chars, 0x10000)]
    at, weight = _picks(length)
    code = letters[:, at[:, 0]]
    lacks = code == 0
    for k in range(1, ORDER):
        letter = letters[:, at[:, k]]
        lacks |= letter == 0
        code = code * np.uint32(CODES) + letter
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURE_BITS)
    if not lacks.any():
        norm = math.sqrt(float((weight ** 2).sum())) or 1.0
        return code, np.broadcast_to(weight, code.shape), np.full(len(code), norm, np.float32)
    weights = np.where(lacks, np.float32(0), weight)
    norms = np.sqrt((weights ** 2).sum(axis=1))
    return code, weights, np.where(norms > 0, norms, np.float32(1))


def _by_length(items: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    by: dict[int, list[int]] = {}
    for i, w in enumerate(items):
        by.setdefault(len(w), []).append(i)
    for length, at in sorted(by.items()):
        if length >= ORDER:
            for k in range(0, len(at), 2048):
                yield np.array(at[k:k + 2048]), [items[i] for i in at[k:k + 2048]]


def explicit(items: list[str]) -> np.ndarray:
    """Normalised subsequence features, a column per word (landmarks only)."""
    out = np.zeros((FEATURES, len(items)), np.float32)
    for rows, some in _by_length(items):
        code, weights, norms = subsequences(some)
        for r, c, w, n in zip(rows, code, weights, norms, strict=True):
            np.add.at(out[:, r], c, w / n)
    return out


def kernel(items: list[str], table: np.ndarray) -> np.ndarray:
    """Normalised features of ``items`` times ``table`` (features x columns)."""
    out = np.zeros((len(items), *table.shape[1:]), np.float32)
    for rows, some in _by_length(items):
        code, weights, norms = subsequences(some)
        if table.ndim == 1:
            out[rows] = (table[code] * weights).sum(axis=1) / norms
        else:
            for t in range(code.shape[1]):
                out[rows] += table[code[:, t]] * (weights[:, t] / norms)[:, None]
    return out


@dataclass(frozen=True)
class Model:
    table: np.ndarray      # one weight per subsequence
    bias: float
    logistic: tuple        # weights of the document's features, and offset

    def values(self, distinct: list[str]) -> np.ndarray:
        """Decision value of each word: its best window's."""
        if len(distinct) > 50_000:
            return np.concatenate([self.values(distinct[at:at + 50_000]) for at in range(0, len(distinct), 50_000)])
        parts = [windows(w) for w in distinct]
        flat = [p for ps in parts for p in ps]
        if not flat:
            return np.zeros(0, np.float32)
        edges = np.cumsum([0] + [len(p) for p in parts])[:-1]
        return np.maximum.reduceat(kernel(flat, self.table), edges) + np.float32(self.bias)

    def score(self, values: list[float]) -> float:
        """Score of a document from the values of its distinct words."""
        z = self.logistic[-1] + sum(a * b for a, b in zip(self.logistic, document_features(values), strict=False))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def document_features(values: list[float]) -> tuple[float, float, float]:
    """The largest value, the mean of the three largest, and log2 of the number of words."""
    distinct = set(values)       # a word with and without a comma counts once
    top = heapq.nlargest(3, distinct)
    if not top:
        return -1.0, -1.0, 0.0
    return top[0], sum(top + [-1.0] * (3 - len(top))) / 3, math.log2(1 + len(distinct))


def train(toxic: list[str], clean: list[str], max_words: int = MAX_WORDS) -> Model:
    """Fit on the sentences of toxic and clean documents."""
    number: dict[str, int] = {}

    def ids(text: str) -> np.ndarray:
        return np.unique([number.setdefault(p, len(number)) for w in words(text) for p in windows(w)
                          if len(p) >= ORDER]).astype(np.int64)

    parts = [[ids(part) for part in sentences(t)] for t in [*toxic, *clean]]
    docs = [np.unique([np.zeros(0, np.int64)] if not ps else np.concatenate(ps)).astype(np.int64) for ps in parts]
    owner = np.repeat(np.arange(len(parts)), [len(ps) for ps in parts])
    rows = [part for ps in parts for part in ps]
    pieces = list(number)
    is_toxic = np.arange(len(docs)) < len(toxic)

    def count(bags: list[np.ndarray], of: np.ndarray) -> np.ndarray:
        return np.bincount(np.concatenate([bags[i] for i in np.flatnonzero(of)] or [np.zeros(0, np.int64)]),
                           minlength=len(pieces))

    votes, against = count(rows, is_toxic[owner]), count(rows, ~is_toxic[owner])
    if not votes.any() or not against.any():
        return Model(np.zeros(FEATURES, np.float32), 0.0, (0.0, 0.0, 0.0, -700.0))
    # How far a word's share of toxic sentences exceeds chance, in standard errors.
    n = np.count_nonzero(is_toxic[owner])
    p, q = votes / n, against / np.count_nonzero(~is_toxic[owner])
    telling = (p - q) / np.sqrt((p + q) / 2 / n + 1 / n ** 2)
    first, common = np.argsort(-telling, kind="stable"), np.argsort(-against, kind="stable")
    common = common[:np.count_nonzero(against)]

    def some(ids: np.ndarray, most: int) -> list[int]:
        return ids[::max(1, -(-len(ids) // most))].tolist()

    marks = list(dict.fromkeys(first[:LANDMARKS // 2].tolist() + common[:LANDMARKS // 4].tolist()
                               + some(common, LANDMARKS // 4)))[:LANDMARKS]
    items = np.array(list(dict.fromkeys(first[:max_words // 4].tolist() + common[:max_words // 4].tolist()
                                        + some(first, max_words // 2))), np.int64)[:max_words]
    table = explicit([pieces[i] for i in marks])               # features x landmarks
    spectrum, vectors = np.linalg.eigh((table.T @ table).astype(np.float64))
    root = (vectors / np.sqrt(np.maximum(spectrum, 1e-3))).astype(np.float32)      # Nystroem: K_mm^(-1/2)
    x = np.hstack([kernel([pieces[i] for i in items], table) @ root, np.ones((len(items), 1), np.float32)])
    place = np.full(len(pieces), -1)
    place[items] = np.arange(len(items))

    def fitted(of: np.ndarray) -> Model:
        """A model from the documents ``of``."""
        minus = count(rows, (of & ~is_toxic)[owner])[items].astype(np.float32)
        seen = count(docs, of & is_toxic)[items]
        plus = np.where(seen > 1, count(rows, (of & is_toxic)[owner])[items], 0).astype(np.float32)
        bags, whose = [], []
        for i in np.flatnonzero((of & is_toxic)[owner]):
            at = place[rows[i]]
            at = at[at >= 0]
            at = at[plus[at] > 0]
            if len(at):
                bags.append(at)
                whose.append(owner[i])
        w = np.zeros(x.shape[1], np.float32)
        for turn in range(ROUNDS + 1):
            w = _fit_svm(x, plus, minus, w)
            if turn < ROUNDS and bags:
                plus = _moved(x @ w, bags, np.array(whose), len(items))
        return Model(table @ (root @ w[:-1]), float(w[-1]), (0.0, 0.0, 0.0, 0.0))

    # The logistic is fitted on documents that the word values were not fitted on.
    features = np.zeros((len(docs), 3))
    fold = np.arange(len(docs)) % 2
    for k in (0, 1):
        values = fitted(fold != k).values(pieces)
        for i in np.flatnonzero(fold == k):
            features[i] = document_features(values[docs[i]].tolist())
    model = fitted(np.ones(len(docs), bool))
    return Model(model.table, model.bias, _logistic(features[is_toxic], features[~is_toxic]))


def _moved(value: np.ndarray, bags: list[np.ndarray], whose: np.ndarray, n: int) -> np.ndarray:
    """Votes of toxic documents by word: a document's move to its most toxic
    sentences (``bags``, in the order of ``whose``), a sentence's to its most toxic words."""
    flat, sizes = np.concatenate(bags), np.array([len(at) for at in bags])
    edges, first = np.cumsum(sizes) - sizes, np.flatnonzero(np.diff(whose, prepend=-1))
    of_doc = np.diff(np.append(first, len(bags)))
    worst = np.maximum.reduceat(value[flat], edges)
    weight = np.exp(6 * (worst - np.repeat(np.maximum.reduceat(worst, first), of_doc)))
    weight *= np.repeat(np.minimum(3, of_doc) / np.add.reduceat(weight, first), of_doc)
    share = np.exp(6 * (value[flat] - np.repeat(worst, sizes)))
    share *= np.repeat(weight / np.add.reduceat(share, edges), sizes)
    return np.bincount(flat, share, n).astype(np.float32)


def _fit_svm(x: np.ndarray, plus: np.ndarray, minus: np.ndarray, start: np.ndarray, ridge: float = 2e-3) -> np.ndarray:
    """Squared-hinge SVM by Newton steps.  Each row of x is a word with a
    weight as a toxic and one as a clean example; its last column is the bias."""
    plus, minus = (a / max(a.sum(), 1e-9) for a in (plus, minus))
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-8
    w = start.astype(np.float64)
    for _ in range(12):
        margin = x @ w.astype(np.float32)
        up, down = np.where(margin < 1, plus, 0), np.where(margin > -1, minus, 0)
        use = (up > 0) | (down > 0)
        some = x[use]
        new = np.linalg.solve((some.T @ (some * (up + down)[use, None])).astype(np.float64) + np.diag(penalty),
                              some.T @ (up - down)[use])
        if np.abs(new - w).max() < 1e-4:
            break
        w = new
    return w.astype(np.float32)


def _logistic(toxic: np.ndarray, clean: np.ndarray) -> tuple:
    """Platt's sigmoid, with his target values, over the document features."""
    x = np.concatenate([toxic, clean])
    target = np.concatenate([np.full(len(toxic), (len(toxic) + 1) / (len(toxic) + 2)),
                             np.full(len(clean), 1 / (len(clean) + 2))])
    use = np.ones(x.shape[1], bool)
    while True:
        middle, scale = x[:, use].mean(axis=0), x[:, use].std(axis=0) + 1e-9
        design, beta = np.hstack([(x[:, use] - middle) / scale, np.ones((len(x), 1))]), np.zeros(use.sum() + 1)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            gradient = design.T @ (p - target) + 0.1 * beta
            hessian = design.T @ (design * (p * (1 - p))[:, None]) + 0.1 * np.eye(len(beta))
            beta -= np.clip(np.linalg.solve(hessian, gradient), -4, 4)
        slopes = np.zeros(x.shape[1])
        slopes[use] = beta[:-1] / scale
        wrong = use & (slopes < 0) & [True, True, False]      # a larger word value never speaks for a clean text
        if not wrong.any():
            return (*map(float, slopes), float(beta[-1] - slopes[use] @ middle))
        use &= ~wrong


def held_out(id_col: str) -> Column:
    """True where crc32 of the id as text is divisible by five."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN,
                   max_chars: int = MAX_CHARS):
    """A bounded sample of labelled texts outside the held-out fifth, equal texts
    once: (toxic, clean).  Of a text above ``max_chars`` characters the sentences
    are drawn by a hash, ``2 * max_chars`` characters of them at most."""
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    label = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label"))
             .filter("label is not null and doc_id is not null").filter(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    ids = label.withColumn("order", F.xxhash64(F.lit(7), "doc_id"))
    chosen = (ids.filter("label = 1").orderBy("order", "doc_id").limit(max_toxic)
              .unionByName(ids.filter("label = 0").orderBy("order", "doc_id").limit(max_clean)))
    share = F.lit(1000 * max_chars) / F.length("text")
    drawn = F.filter(F.split("text", SENTENCE_END), lambda part: F.pmod(F.xxhash64(part), F.lit(1000)) < share)
    bounded = F.when(F.length("text") <= max_chars, F.col("text")).otherwise(
        F.substring(F.concat_ws("\n", drawn), 1, 2 * max_chars))
    rows = (text.join(F.broadcast(chosen.select("doc_id", "label")), "doc_id")
            .groupBy("doc_id", "label").agg(F.min(bounded).alias("text"))
            .select("label", "text").collect())     # at most max_toxic + max_clean texts of 2 * max_chars
    toxic = {r["text"] or "" for r in rows if r["label"] == 1}
    clean = {r["text"] or "" for r in rows if r["label"] == 0} - toxic
    return sorted(toxic), sorted(clean)


def scored_rows(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, the whole row as the struct ``row``, and its score."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("id"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return _scored(rows, model)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    narrow = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).alias("doc_id"))
    return _scored(narrow, model).select(
        "doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """Replace the first column, the text, by its score."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)     # fixed size: one weight per subsequence

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        model, known = shipped.value, {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                found = [words(t.as_py()) for t in some.column(0)]
                if len(known) > CACHE_WORDS:
                    known.clear()
                new = list({w for ws in found for w in ws if w not in known})
                known.update(zip(new, model.values(new).tolist(), strict=True))
                scores = [model.score([known[w] for w in ws]) for ws in found]
                yield pa.RecordBatch.from_arrays([pa.array(scores, pa.float64()), *some.columns[1:]],
                                                 names=["score", *some.schema.names[1:]])
    return rows.mapInArrow(run, StructType([StructField("score", DoubleType()), *rows.schema.fields[1:]]))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_chars: int = MAX_CHARS,
             max_words: int = MAX_WORDS) -> DataFrame:
    texts = training_texts(docs, labels, id_col, text_col, max_toxic=max_toxic, max_clean=max_clean,
                           max_chars=max_chars)
    return score(docs, train(*texts, max_words=max_words), id_col, text_col)
