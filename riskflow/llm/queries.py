"""The package's registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.chosen_path import minhash_dedup
from riskflow.llm.common import table
from riskflow.llm.exact_dedup import exact_dedup
from riskflow.llm.hard_negatives import mine
from riskflow.llm.html_text import extract
from riskflow.llm.merkle import fingerprints
from riskflow.llm.mixing import mix
from riskflow.llm.packing import added_tokens, pack
from riskflow.llm.periodic_runs import find_runs
from riskflow.llm.simhash_dedup import simhash_dedup
from riskflow.llm.substring_dedup import remove_repeats
from riskflow.llm.token_counts import count_tokens
from riskflow.llm.toxicity import toxicity
from riskflow.llm.url_filter import filter_urls, path_of


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public
    return pack(table(spark, sf_dir, "documents"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN,
                with_ids=False, added=added_tokens(public.path("byte_bpe_50k.json")))


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels: the verdicts of the listed rules, and for other urls the document that the last number of the path
    names, blocked if its quality is 0 or it is toxic."""
    pages = table(spark, sf_dir, "pages")
    number = F.regexp_extract(path_of(F.col("url")), r"(\d{1,18})\D*$", 1).try_cast("long")
    verdict = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow")
    labels = table(spark, sf_dir, "labels").select("doc_id", verdict.alias("verdict"))
    labelled = pages.select("url", number.alias("doc_id")).join(labels, "doc_id").select("url", "verdict")
    return filter_urls(pages, labelled)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public
    return count_tokens(table(spark, sf_dir, "documents"), public.path("piece_bpe_32k.model"))


def _cycled(docs: DataFrame) -> DataFrame:
    """Every tenth document by the crc32 of its id, from some word on a cycle of its own words."""
    split = F.array_remove(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), "")
    hashed = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", F.floor(hashed / 10).alias("g"),
                       F.when(hashed % 10 == 0, split).alias("words"))
    n, g, words = F.size("words"), F.col("g"), F.col("words")
    rows = rows.withColumn("a", F.when(n > 0, g % n).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    head, cycle = F.slice(words, F.lit(1), F.col("a")), F.slice(words, F.col("a") + 1, F.col("p"))
    times = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), n - F.col("a"))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.concat(head, tail), " "))
                       .otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(_cycled(table(spark, sf_dir, "documents")))
    line = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]),
                                                               F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {n: f for n, f in globals().items() if n.startswith("op") and n[2:3].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
