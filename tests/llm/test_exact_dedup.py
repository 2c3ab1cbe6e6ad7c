import re
from collections import defaultdict

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from riskflow.llm import sql
from riskflow.llm.exact_dedup import _differing, exact_dedup, normalised
from tests.llm.conftest import ODD_ROWS


def expected(rows):
    """keep_id and group size per (id, text) by brute force."""
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


def check(out, rows):
    want = expected(rows)
    per_id = defaultdict(list)
    for doc_id, text, *_ in rows:
        per_id[doc_id].append(want[re.sub(r"[\x20\x09-\x0D]", "", text or "")])
    got = defaultdict(list)
    for r in out:
        got[r["doc_id"]].append((r["keep_id"], r["group_size"]))
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert {k: sorted(v, key=key) for k, v in got.items()} == {k: sorted(v, key=key) for k, v in per_id.items()}
    assert sum(r["kept"] for r in out) == len(want)


def test_odd_rows_match_brute_force(odd_docs):
    check(exact_dedup(odd_docs).collect(), ODD_ROWS)


def test_clashing_columns(clashing):
    out = exact_dedup(clashing)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    check(out.collect(), ODD_ROWS)


def test_state_is_carried_over_many_batches(docs_of):
    rows = [(i, f"text {i % 7}" + " " * (i % 3), "a") for i in range(60)]
    check(exact_dedup(docs_of(rows, 8), max_files=1).collect(), rows)


def test_weak_digest_merges_no_texts(docs_of):
    rows = [(i, f"word{i % 11} tail" + " " * (i % 2), "a") for i in range(50)]
    weak = exact_dedup(docs_of(rows), digest=lambda normal: (F.crc32(normal.cast("binary")) % 3).cast("string"))
    check(weak.collect(), rows)


def test_bytes_are_compared_when_digest_and_locator_clash(docs_of, monkeypatch):
    """Both hashes alike for all texts: nothing but the bytes tells them apart."""
    rows = [(1, "one text"), (2, "another"), (3, "onetext"), (4, "a third"), (5, "another")]
    monkeypatch.setattr(F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    weak = exact_dedup(docs_of(rows), digest=lambda normal: F.lit("same"))
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in weak.collect()) == [
        (1, 1, 2), (2, 2, 2), (3, 1, 2), (4, 4, 1), (5, 2, 2)]


def test_beyond_the_broadcast_bound(docs_of, monkeypatch):
    """Without broadcast keys the same rows come out, also where digests clash."""
    monkeypatch.setattr("riskflow.llm.exact_dedup.HIT_KEYS", 0)
    check(exact_dedup(docs_of(ODD_ROWS)).collect(), ODD_ROWS)
    rows = [(i, f"word{i % 11} tail" + " " * (i % 2), "a") for i in range(50)]
    weak = exact_dedup(docs_of(rows), digest=lambda normal: (F.crc32(normal.cast("binary")) % 3).cast("string"))
    check(weak.collect(), rows)


def test_only_hits_leave_their_tasks(spark):
    """Texts of a single row are dropped before the exchange."""
    text = spark.createDataFrame([(i, f"t{i % 90}", f"d{i % 90}") for i in range(100)],
                                 "doc_id long, normal string, digest string").withColumn("locator", F.lit(0))
    classes = text.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    found = _differing(text, classes)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi") and found.count() == 0


def test_empty_table(docs_of):
    assert exact_dedup(docs_of([])).collect() == []


def test_oracle_sql_agrees(odd_docs):
    rows = [(i, t, "a", "b", 0) for i, t in enumerate(["a b", "ab", "a\x0bb ", "", None, "c", "ab  "])]
    docs = odd_docs.sparkSession.createDataFrame(rows, odd_docs.schema)
    documents = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    con = duckdb.connect()
    con.register("documents", documents)
    want = {r[0]: r[1:] for r in con.execute(sql.OP8).fetchall()}
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup(docs).collect()}
    assert got == want


def test_normalised_deletes_the_six_characters_only(spark):
    row = spark.createDataFrame([("a \t\n\x0b\x0c\r\xa0\x1fb",)], "t string").select(normalised(F.col("t"))).first()
    assert row[0] == "a\xa0\x1fb"
