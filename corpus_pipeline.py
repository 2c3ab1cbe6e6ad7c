"""The corpus pipeline: documents to packed training sequences.

``STAGES`` are applied in order to ``documents``; each takes every row its
predecessor kept and all but the last return the columns of ``documents``, whatever
further columns there are and whatever they are called.  Empty tables give no rows.
A stage that must find its decisions' rows again keys them by the id and a
hash of the text, so rows that share an id are told apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import common
from riskflow.llm.exact_dedup import exact_dedup, normalised, sha256
from riskflow.llm.mixing import mix
from riskflow.llm.packing import added_tokens, pack
from riskflow.llm.simhash_dedup import simhash_dedup
from riskflow.llm.toxicity import scored_rows, train, training_texts

#: Words, tokens and packed sequences are no rows that SQL can give; tests compare with a brute-force version.
ORACLE_SQL = None


def _rows(docs: DataFrame) -> DataFrame:
    """The whole row as the struct ``row``: names of stages and of columns cannot meet."""
    return docs.select(F.struct(*[F.col(_quoted(c)) for c in docs.columns]).alias("row"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay, null and empty texts by the score
    of no words; repeated rows all stay or all go."""
    names = docs.columns
    model = train(*training_texts(docs.select("doc_id", "text"), common.table(spark, sf_dir, "labels")))
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    scored = scored_rows(plain, model, f"c{names.index('doc_id')}", f"c{names.index('text')}")
    return scored.filter("score < 0.5").select("row.*").toDF(*names)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space one row stays, null counting as empty:
    the longest, then the smallest id; of repeated rows one."""
    kept = exact_dedup(docs.select("doc_id", "text")).filter("kept").select(
        F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_digest"))
    text = F.coalesce(F.col("row")["text"].cast("string"), F.lit(""))
    keyed = _rows(docs).select("row", F.col("row")["doc_id"].alias("id"), sha256(normalised(text)).alias("digest"),
                               (-F.length(text)).alias("size"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    rows = keyed.join(kept, same, "left_semi")
    # Of rows that share id and normalised text the longest stays.
    return rows.groupBy("id", "digest").agg(F.min_by("row", "size").alias("row")).select("row.*")


def _keyed(docs: DataFrame) -> DataFrame:
    """``row``, its ``text`` and ``source``, and ``key``: the id and a hash of both, so rows that share an id differ."""
    row = F.col("row")
    key = F.struct(row["doc_id"].alias("id"), F.xxhash64(row["text"], row["source"]).alias("text"))
    return _rows(docs).select("row", key.alias("key"), row["text"].alias("text"), row["source"].alias("source"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays;
    null and wordless texts are one component like any other."""
    groups = simhash_dedup(_keyed(docs).select("key", "text"), id_col="key")
    kept = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("key")).distinct()
    return _keyed(docs).join(kept, "key", "left_semi").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; repeated rows count as one
    document taken as often as all of them."""
    times = (mix(_keyed(docs).select("key", "text", "source"), id_col="key").groupBy(F.col("doc_id").alias("key"))
             .agg(F.sum("repeats").cast("int").alias("times")).filter("times > 0"))
    rows = _keyed(docs).dropDuplicates(["key"]).join(times, "key")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("nth")).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document row with their ids, in sequences of at
    most 2048; a null or empty text is its end token alone."""
    import public_tokenizers as public
    return pack(docs, public.path("byte_bpe_50k.tiktoken"), public.PATTERN, with_ids=True,
                added=added_tokens(public.path("byte_bpe_50k.json")))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact_copies), ("simhash_dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
