"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow import workspace

#: The characters of ``[\x20\x09-\x0D]``, the white space of every word and equality rule here.
SPACES = " \t\n\x0b\x0c\r"
#: A word, as a Java and Python regular expression.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there
    and every later read meets the same rows, whatever executor is lost."""
    spark = df.sparkSession
    folder = workspace.new_run(spark, name)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
