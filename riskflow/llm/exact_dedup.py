"""Exact dedup as a stateful stream (operator 8).

Documents arrive as narrow rows (digest of the normalised text, stable id,
content locator).  A Structured Streaming aggregation keyed by digest, without
watermark, keeps for every digest ever seen the row that stays and the number
of rows: its state lives on disk in RocksDB, is checkpointed in the shared
folder and never expires.  Partial aggregation runs before the shuffle, so a
digest held by a third of all rows reaches its state as one row per task.

On a hit (a digest with more than one row) the full normalised bytes are read
and compared, whatever the locators say: the least and the greatest of a digest
must be the same.  Short keys of the hit digests are broadcast up to ``HIT_KEYS``
of them, so that only the hits' texts leave their tasks; beyond that all texts do.
Either way a task sends the least and the greatest text of a digest only, however
often it holds it.  A digest whose rows differ is regrouped by its full bytes,
so even a weak digest cannot merge two texts.

Defined results: a null text is the empty text; a null id sorts after every
other id; among rows alike in length and id the first to arrive stays; an
empty input gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow import workspace
from riskflow.llm import common

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER_KEY = "spark.sql.streaming.stateStore.providerClass"
PREALLOCATE_KEY = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
#: Arrivals for one state partition, up to the session's shuffle partitions.
STATE_ROWS = 20_000
#: Bytes of arrivals in one micro-batch.
BATCH_BYTES = 512 << 20
#: Hit digests whose 64-bit keys are broadcast, some 30 bytes each.
HIT_KEYS = 1_000_000


def normalised(text: Column) -> Column:
    """The text without any character of ``[\\x20\\x09-\\x0D]``."""
    return F.translate(text, common.SPACES, "")


def sha256(normal: Column) -> Column:
    return F.sha2(normal.cast("binary"), 256)


def _arrivals(docs: DataFrame, id_col: str, text_col: str,
              digest: Callable[[Column], Column]) -> DataFrame:
    """One narrow row per document: digest, id and locator, without the text."""
    text = common.text_or_empty(text_col)
    return (docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
            .select("doc_id", F.length("text").cast("long").alias("n_chars"),
                    normalised(F.col("text")).alias("normal"))
            .select("doc_id", "n_chars", digest(F.col("normal")).alias("digest"),
                    sha256(F.col("normal")).alias("text_sha256"),
                    F.xxhash64("normal").alias("locator")))


def _rank() -> Column:
    """Smallest wins: longest original text, then smallest id (nulls last), then first arrival."""
    return F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"),
                    F.col("doc_id").alias("doc_id"), F.col("locator").alias("locator"),
                    F.col("arrival").alias("arrival"))


def run_state(spark: SparkSession, arrivals: str, schema, work: str, partitions: int,
              batch_bytes: int = BATCH_BYTES, max_files: int | None = None) -> DataFrame:
    """Feed the arrivals to the keyed state; the state's rows after the last batch."""
    session = spark.newSession()     # the caller's settings stay as they are
    session.conf.set(PROVIDER_KEY, ROCKSDB)
    session.conf.set(PREALLOCATE_KEY, "false")     # else 4 MB of disk per state partition, however small
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    reader = session.readStream.schema(schema).option("maxFileAge", "36500d")
    reader = (reader.option("maxFilesPerTrigger", max_files) if max_files
              else reader.option("maxBytesPerTrigger", batch_bytes))
    state = (reader.parquet(arrivals).groupBy("digest")
             .agg(F.min(_rank()).alias("best"), F.count(F.lit(1)).alias("group_size")))
    changes = f"{work}/changes"

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch_id={batch_id}")

    query = (state.writeStream.outputMode("update").foreachBatch(keep)
             .option("checkpointLocation", f"{work}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    found = (spark.read.schema("digest string, best struct<less:long,no_id:boolean,doc_id:"
                               + schema["doc_id"].dataType.simpleString()
                               + ",locator:long,arrival:long>, group_size long, batch_id int")
             .option("basePath", changes).parquet(f"{changes}/batch_id=*"))
    return (found.groupBy("digest").agg(F.max_by(F.struct("best", "group_size"), "batch_id").alias("last"))
            .select("digest", "last.best", "last.group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES,
                max_files: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    work = workspace.new_run(spark, "exact-dedup")
    narrow = _arrivals(docs, id_col, text_col, digest)
    narrow.withColumn("arrival", F.monotonically_increasing_id()).write.parquet(f"{work}/arrivals")
    arrivals = spark.read.parquet(f"{work}/arrivals")
    rows = arrivals.count()
    if not rows:
        return arrivals.select("doc_id", F.col("doc_id").alias("keep_id"),
                               F.lit(0).cast("long").alias("group_size"),
                               F.lit(True).alias("kept"), "text_sha256")
    partitions = min(common.shuffle_partitions(spark), -(-rows // STATE_ROWS))
    classes = common.stored(run_state(spark, f"{work}/arrivals", arrivals.schema, work, partitions,
                                      batch_bytes, max_files), "exact-classes")
    text = _texts(docs, id_col, text_col, digest)
    differing = common.stored(_differing(text, classes), "exact-differing")
    alike = arrivals
    if not differing.isEmpty():
        alike = arrivals.join(differing, "digest", "left_anti")
    out = alike.join(classes, "digest").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("arrival") == F.col("best.arrival")).alias("kept"), "text_sha256")
    if differing.isEmpty():
        return out
    return out.unionByName(_by_bytes(arrivals.join(differing, "digest", "left_semi"),
                                     text.join(differing, "digest", "left_semi")))


def _texts(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    return (docs.select(F.col(id_col).alias("doc_id"), normalised(common.text_or_empty(text_col)).alias("normal"))
            .select("doc_id", "normal", digest(F.col("normal")).alias("digest"),
                    F.xxhash64("normal").alias("locator")))


def _differing(text: DataFrame, classes: DataFrame) -> DataFrame:
    """Digests of several rows whose full bytes are not all the same: the least and the greatest differ."""
    hits = classes.filter("group_size > 1").select(F.xxhash64("digest").alias("hit"))
    if hits.count() <= HIT_KEYS:     # rows of another digest with a hit's key come along, and are alike
        text = text.join(F.broadcast(hits), F.xxhash64("digest") == F.col("hit"), "left_semi")
    ends = text.groupBy("digest").agg(F.min("normal").alias("least"), F.max("normal").alias("greatest"))
    return ends.filter(F.col("least") != F.col("greatest")).select("digest")


def _by_bytes(arrivals: DataFrame, text: DataFrame) -> DataFrame:
    """Group the rows of clashing digests by their full normalised bytes."""
    same_row = ((F.col("a.digest") == F.col("t.digest")) & (F.col("a.locator") == F.col("t.locator"))
                & F.col("a.doc_id").eqNullSafe(F.col("t.doc_id")))
    rows = common.stored(arrivals.alias("a").join(text.distinct().alias("t"), same_row)
                         .select("a.*", "t.normal"), "exact-clashing")
    best = rows.groupBy("digest", "normal").agg(F.min(_rank()).alias("best"),
                                                F.count(F.lit(1)).alias("group_size"))
    return rows.join(best, ["digest", "normal"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("arrival") == F.col("best.arrival")).alias("kept"), "text_sha256")
