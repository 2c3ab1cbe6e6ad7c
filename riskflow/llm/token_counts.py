"""Token counts by trie-shared dynamic programming (operator 10).

A unigram tokenizer splits a pre-token into the pieces with the largest sum of
scores.  The forward scores of a prefix do not depend on what follows, so the
distinct pre-tokens of a batch are put into a trie and the forward step is done
once per trie node; a node where pre-tokens end stores their token count.  A
task keeps the counts of the pre-tokens it has met, and a document's count is
the sum over its pre-tokens.

Pieces come from a public sentencepiece vocabulary file.  None of the public
files is of the unigram kind, so a piece's score is taken from its rank by
Zipf's law, -log(rank + ``SHIFT``), and the result is the unigram model's count
over that vocabulary, not that of the file's own merges.  Characters outside
every piece cost ``UNKNOWN`` and count one token per UTF-8 byte, as byte
fallback does.

Defined results: a null or wordless text has 0 tokens; of splits with equal
scores the one with fewer tokens counts; rows alike count alike; a null id is
kept; pre-tokens of any length are in the trie, a step looks back as far as the
longest piece; an empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks the start of a word in the vocabulary.
START = "▁"
SHIFT = 10.0
UNKNOWN = -25.0
#: Distinct pre-tokens, and their characters, whose counts a task keeps from batch to batch.
CACHE_WORDS, CACHE_CHARS = 700_000, 20_000_000


def load_pieces(model_file: str) -> dict[str, float]:
    """Scores of the vocabulary's ordinary pieces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return {model.id_to_piece(i): -math.log(i + SHIFT) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}

#: Characters that Python splits at but the pre-token rule ``[^\x20\x09-\x0D]+`` does not.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def shared(a: str, b: str) -> int:
    """Length of the longest common prefix, by halving: pre-tokens may be very long."""
    same, differ = 0, min(len(a), len(b)) + 1
    while differ - same > 1:
        middle = (same + differ) // 2
        if a[same:middle] == b[same:middle]:
            same = middle
        else:
            differ = middle
    return same


class Counter:
    """Token counts of pre-tokens under a unigram vocabulary."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces, self.longest = pieces, max(map(len, pieces), default=1)
        self.known: dict[str, int] = {}
        self.chars = 0     # of the words in ``known``
        self.nodes = 0     # forward steps done

    def _step(self, full: str, end: int, scores: list[float], counts: list[int]) -> None:
        """Forward score and token count of ``full[:end]`` from those of its own prefixes."""
        self.nodes += 1
        pieces, last = self.pieces, full[end - 1]
        best, fewest = scores[end - 1] + UNKNOWN, counts[end - 1] + len(last.encode("utf-8", "surrogatepass"))
        for start in range(max(0, end - self.longest), end):
            score = pieces.get(full[start:end])
            if score is not None:
                total = scores[start] + score
                if total > best or total == best and counts[start] + 1 < fewest:
                    best, fewest = total, counts[start] + 1
        scores.append(best)
        counts.append(fewest)

    def learn(self, words: set[str]) -> None:
        """Walk the trie of the words depth first.  Sorted words are that walk:
        what a word shares with the one before is the path already stood on."""
        path, scores, counts = START, [0.0], [0]
        self._step(path, 1, scores, counts)
        for word in sorted(words):
            full = START + word
            stay = shared(path, full)
            del scores[stay + 1:], counts[stay + 1:]
            for end in range(stay + 1, len(full) + 1):
                self._step(full, end, scores, counts)
            path = full
            self.known[word] = counts[-1]
            self.chars += len(word)

    def texts(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(words, tokens) of each text."""
        split = [[w.decode("utf-8", "surrogatepass") for w in (t or "").encode("utf-8", "surrogatepass").split()]
                 if _OTHER_SPACE.search(t or "") else (t or "").split() for t in texts]
        # Before the new words are told from the known ones, all of which are looked up below.
        if len(self.known) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.known.clear()
            self.chars = 0
        self.learn({w for ws in split for w in ws if w not in self.known})
        known = self.known
        return [(len(ws), sum(known[w] for w in ws)) for ws in split]


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        counts = Counter(load_pieces(model_file))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                found = counts.texts(some.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([w for w, _ in found], pa.int64()),
                     pa.array([n for _, n in found], pa.int64())], names=["doc_id", "n_words", "n_tokens"])
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_words long, n_tokens long")
