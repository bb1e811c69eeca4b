"""Column helpers and staging shared by the pipeline operators."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import shared_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\x0c\r"

# internal columns carry this prefix; input columns must not
P = "_tw_"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII text takes the fast built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def text_or_empty(df: DataFrame) -> Column:
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def text_hash(c: Column) -> Column:
    """64-bit text fingerprint that tells apart rows sharing a doc_id."""
    return F.xxhash64(c)


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_path(spark: SparkSession, name: str) -> str:
    return shared_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
