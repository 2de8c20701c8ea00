"""Ranks over a whole table without one task that holds it."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def checkpoint_folder(spark: SparkSession) -> None:
    """Use the folder in spark.checkpoint.dir. Where that is unset, set a local one if Spark itself is local (tests); on a cluster it is an error,
    as no other executor could read it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "askmill-checkpoints"))


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Row numbers from 1 in an order that must be unique: range partitions, sorted each, with the sizes of those before added.

    The ranged table is checkpointed, so the sizes and the rows come from one and the same partitioning, also after a lost executor.
    """
    spark = df.sparkSession
    checkpoint_folder(spark)
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = ranged.groupBy("_part").count().orderBy("_part").collect()  # one row per partition
    before, total = [], 0
    for r in sizes:
        before.append((r["_part"], total))
        total += r["count"]
    start = spark.createDataFrame(before or [(0, 0)], "_part int, _before long")
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(F.broadcast(start), "_part").withColumn(name, F.col("_before") + inner).drop("_part", "_before")


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in an explicit order; combined on the map side, so a hot group is no hot task."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min(F.struct(*[o.alias(f"_o{k}") for k, o in enumerate(order)], F.struct(*rest).alias("_row"))).alias("_b"))
    return best.select(*keys, *[F.col(f"_b._row.{c}").alias(c) for c in rest]).select(*df.columns)
