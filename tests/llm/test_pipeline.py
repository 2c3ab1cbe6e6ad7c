import re

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tests.llm.test_simhash_dedup import plain, roots
from tests.llm.test_toxicity import corpus


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents and labels with toxic texts, exact copies and near copies."""
    out = str(tmp_path_factory.mktemp("corpus"))
    rows = corpus(400, 11)
    docs = [(i, t, "en", f"s{i % 4}", len(t)) for i, t, _ in rows]
    docs += [(1000 + i, docs[i][1].replace(" ", "  "), "en", "s1", 0) for i in range(1, 60)]     # copies but for white space
    long = " ".join(t for _, t, y in rows[:60] if not y)
    docs += [(2000 + i, long + f" extra{i}", "en", "s2", 0) for i in range(5)]
    docs += [(3000, None, None, None, None), (None, "no id here", "en", "s0", 10), (3001, "", "en", "s0", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{out}/documents.parquet")
    labels = [(i, 1, y) for i, _, y in rows if i % 5]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out, docs, {i for i, _, y in rows if y}


def test_stages(spark, folder):
    path, rows, toxic = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in cp.STAGES[:-1]:
        docs = cp.common.stored(stage(spark, docs, path), f"test-{name}")
        assert docs.columns == columns
        kept[name] = docs.collect()
    texts = {r[0]: r[1] for r in rows}

    ids = {r["doc_id"] for r in kept["toxicity"]}
    bad = toxic | {1000 + i for i in toxic}
    assert len(ids & bad) <= 0.1 * len(bad)
    assert len(ids - bad) >= 0.97 * (len({r[0] for r in rows}) - len(bad & set(texts)))

    squeeze = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for r in kept["toxicity"]:
        groups.setdefault(squeeze(r["text"]), []).append((-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0, r["doc_id"]))
    assert sorted(r["doc_id"] or -1 for r in kept["exact_dedup"]) == sorted(min(g)[3] or -1 for g in groups.values())

    prints = {r["doc_id"]: plain(r["text"]) for r in kept["exact_dedup"]}
    group = roots(set(prints.values()))
    least = {}
    for i, p in prints.items():
        least[group[p]] = min(least.get(group[p], 10**9), i if i is not None else 10**9 - 1)
    assert sorted(r["doc_id"] if r["doc_id"] is not None else 10**9 - 1 for r in kept["simhash_dedup"]) == sorted(least.values())

    words, taken = {}, {}
    for r in kept["simhash_dedup"]:
        words[r["source"]] = words.get(r["source"], 0) + len((r["text"] or "").split())
    for r in kept["mixing"]:
        taken[r["source"]] = taken.get(r["source"], 0) + len((r["text"] or "").split())
    total = sum(words.values())
    assert abs(sum(taken.values()) - total) <= 150 * len(words)
    assert {r["doc_id"] for r in kept["mixing"]} <= {r["doc_id"] for r in kept["simhash_dedup"]}
    assert all(texts[r["doc_id"]] == r["text"] for r in kept["mixing"])

    pieces = cp.STAGES[-1][1](spark, docs, path).collect()
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    want = sum(len(tokenizer.encode(r["text"] or "").ids) + 1 for r in kept["mixing"])
    assert sum(r["length"] for r in pieces) == want
    used = np.unique([r["sequence_id"] for r in pieces])
    assert len(used) * 2048 <= 1.3 * want + 2048 * 30


def test_run_gives_the_last_stage(spark, folder):
    out = cp.run(spark, folder[0])
    assert out.columns[0] == "doc_id" and "sequence_id" in out.columns and out.count() > 0


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


CLASHES = ["row", "score", "kept", "print", "repeats", "id", "_id", "_digest", "_size", "_key", "_nth", "_times", "key", "times",
           "nth", "digest", "size", "kept_id", "c0", "a.b", "my col", "x:y", "a-b", "back`tick"]


def test_clashing_columns_pass_through(spark, folder):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(60)
    # Every further column tells the row it belongs to.
    docs = docs.select("*", *[F.concat(F.lit(f"{i}:"), F.coalesce("doc_id", F.lit(-1))).alias(c) for i, c in enumerate(CLASHES)])
    for _, stage in cp.STAGES[:-1]:
        docs = cp.common.stored(stage(spark, docs, folder[0]), "test-clash")
        assert docs.columns[-len(CLASHES):] == CLASHES
        rows = docs.collect()
        assert rows
        for r in rows:
            assert list(r[-len(CLASHES):]) == [f"{i}:{-1 if r[0] is None else r[0]}" for i in range(len(CLASHES))]


def test_last_stage_keeps_the_token_ids(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(40)
    tokenizer = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    pieces = {}
    for r in cp.pack_sequences(spark, docs, folder[0]).collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], list(r["ids"])))
    for r in docs.collect():
        assert [t for _, ids in sorted(pieces[r["doc_id"]]) for t in ids] == [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
