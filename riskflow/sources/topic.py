"""Topics: Kafka (the caller names brokers) or folders of files.

A ``Topic`` gives the same DataFrame shape either way — binary ``key`` and
``value`` plus Kafka's metadata columns where they exist — as a stream
(``read_stream``) or a table (``read``).  The file-backed topic is a folder
of parquet parts; each writer batch lands in its own sub-folder, written
through the output committer, so readers never see half a batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
])


#: Row groups of a file topic: a reader's tasks share a file by its row groups, so that they are
#: as small as the least split Spark makes (``spark.sql.files.openCostInBytes``).
ROW_GROUP_BYTES = 4 << 20
#: File streams take every file, however old it is next to the newest one.
MAX_FILE_AGE = "36500d"


@dataclass
class KafkaTopic:
    bootstrap_servers: str
    name: str
    #: Passed to reads and writes alike, for example ``kafka.security.protocol``.
    options: dict = field(default_factory=dict)

    def _base(self) -> dict:
        return {"kafka.bootstrap.servers": self.bootstrap_servers, **self.options}

    def read_options(self, starting_offsets: str = "earliest", fail_on_data_loss: bool = False,
                     max_per_trigger: int | None = None, min_partitions: int | None = None) -> dict:
        """``min_partitions``: split each batch's offset ranges into at least
        that many tasks; a topic with few partitions (the reference's has 3)
        would otherwise decode on as many cores.  ``fail_on_data_loss``: stop
        at a gap in the offsets instead of going on behind it."""
        out = {**self._base(), "subscribe": self.name, "startingOffsets": starting_offsets,
               "failOnDataLoss": str(fail_on_data_loss).lower()}
        if max_per_trigger:
            out["maxOffsetsPerTrigger"] = str(max_per_trigger)
        if min_partitions:
            out["minPartitions"] = str(min_partitions)
        return out

    def write_options(self) -> dict:
        return {**self._base(), "topic": self.name}

    def read_stream(self, spark: SparkSession, **kw) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.read_options(**kw)).load()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("kafka").options(**self._base(), subscribe=self.name).load()

    def write_batch(self, df: DataFrame, part: str = "") -> None:
        _messages(df).write.format("kafka").options(**self.write_options()).save()


def _messages(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))


@dataclass
class FileTopic:
    """A topic kept as parquet parts under ``root/name``.

    One produce call is one sub-folder of evenly split parts, all covering the
    same span of event time.  A Kafka consumer reads every partition in each
    micro-batch; to keep that property, read a file topic without a file limit
    or with ``max_files_per_trigger`` a multiple of the producer's parts —
    otherwise later parts of the same span can arrive behind the watermark.
    """
    root: str
    name: str

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.name}"

    def read_options(self, max_per_trigger: int | None = None) -> dict:
        out = {"maxFileAge": MAX_FILE_AGE}
        if max_per_trigger:
            out["maxFilesPerTrigger"] = str(max_per_trigger)
        return out

    def read_stream(self, spark: SparkSession, max_files_per_trigger: int | None = None,
                    schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
        return (spark.readStream.schema(schema).options(**self.read_options(max_files_per_trigger))
                .parquet(f"{self.path}/*"))

    def read(self, spark: SparkSession, schema: T.StructType = MESSAGE_SCHEMA) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.path}/*")

    def write_batch(self, df: DataFrame, part: str) -> None:
        """Write one batch as sub-folder ``part`` (overwrite: a replayed
        batch replaces its own output instead of adding to it)."""
        _messages(df).write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(f"{self.path}/{part}")


def produce(df: DataFrame, topic: FileTopic | KafkaTopic, part: str = "batch-000000000000") -> None:
    """Batch-write ``(key, value)`` messages to a topic (the load generator's
    role: encoded transactions onto the raw topic).

    Kafka assigns partitions by key itself (per-key order, as the reference's
    producers rely on).  A file topic gets one part per task of ``df``, so
    consumers read in parallel; Spark consumers order by event time, not by
    offset."""
    topic.write_batch(df, part)
