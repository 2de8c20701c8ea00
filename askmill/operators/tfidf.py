"""TF-IDF as DataFrames: terms, weights, keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens


def counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf)."""
    return docs.select(key, F.explode(tokens(text)).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(docs: DataFrame, key: str, text: str, max_features: int = 1000, max_df: float = 0.95, min_df: int = 2) -> DataFrame:
    """(term, df, tf, idf): terms of min_df documents or more and of max_df of all at most; of these the most used ones, ties by term."""
    tf = counts(docs, key, text)
    n = docs.count()
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf")).where((F.col("df") >= min_df) & (F.col("df") <= max_df * n))
    top = stats.orderBy(F.desc("tf"), "term").limit(max_features)
    return top.withColumn("idf", F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1)


def weights(docs: DataFrame, key: str, text: str, vocab: DataFrame) -> DataFrame:
    """(key, term, weight), rows of length 1. The vocabulary has max_features rows at most, so it is broadcast."""
    w = counts(docs, key, text).join(F.broadcast(vocab.select("term", "idf")), "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("w"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))  # keywords() needs the same partitioning
    return w.select(key, "term", (F.col("w") / length).alias("weight"))


def keywords(weighted: DataFrame, key: str, k: int = 5) -> DataFrame:
    """(key, top_keywords): the k heaviest terms (ties by term), sorted, joined by a comma."""
    r = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(F.round("weight", 9)), "term"))
    top = weighted.withColumn("_r", r).where(F.col("_r") <= k)
    return top.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list("term")), ", ").alias("top_keywords"))


def cluster_keywords(members: DataFrame, cluster: str, keyword_column: str = "top_keywords", k: int = 5) -> DataFrame:
    """The k commonest keywords of each cluster's members, ties by word."""
    words = members.select(cluster, F.explode(F.split(keyword_column, ", ")).alias("kw")).where("kw <> ''").groupBy(cluster, "kw").agg(F.count(F.lit(1)).alias("n"))
    r = F.row_number().over(Window.partitionBy(cluster).orderBy(F.desc("n"), "kw"))
    return words.withColumn("position", r).where(F.col("position") <= k)


def shared_keyword_pairs(words: DataFrame, cluster: str, top: int = 3, n: int = 30) -> DataFrame:
    """Pairs of clusters that share one of their first keywords; the first n pairs in order."""
    w = words.where(F.col("position") <= top).select(cluster, "kw")
    b = w.select(F.col(cluster).alias("cluster_b"), "kw")
    return w.withColumnRenamed(cluster, "cluster_a").join(b, "kw").where("cluster_a < cluster_b").select("cluster_a", "cluster_b").distinct().orderBy("cluster_a", "cluster_b").limit(n)
