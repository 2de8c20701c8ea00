"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rank import checkpoint_folder

#: The texts that problems 1 and 3 deal with: (table, key column, text column).
TEXTS = (("raw_log", "raw_row_id", "query_text"), ("unique_questions_freq", "unique_q_id", "representative_question"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of a frame through the shared checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table_name, key, text) of both question tables, blank texts left out."""
    parts = [
        read(spark, sf_dir, t).select(F.lit(t).alias("table_name"), F.col(k).cast("string").alias("key"), F.col(c).alias("text"))
        for t, k, c in TEXTS
    ]
    return parts[0].unionByName(parts[1]).where(F.col("key").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"[\p{L}\p{N}]"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staged(df: DataFrame) -> DataFrame:
    """Write a frame as a compressed table into the shared checkpoint folder and read it back; it is removed when Python ends."""
    spark = df.sparkSession
    checkpoint_folder(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # the session has ended; the folder is the cluster's to clean
        pass


def spread(df: DataFrame) -> DataFrame:
    """The same rows over as many tasks as there are cores, where the files would give fewer (one small file is one task)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
