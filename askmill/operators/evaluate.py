"""Evaluation of clusterings from a judge's replies."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import replies
from ..functions.text import clean
from . import tfidf
from .freq import unique_in_cluster
from .models import Judge, judged


def composite(separation: Column, coherence: Column, outlier: Column, merge: Column) -> Column:
    return 0.45 * separation + 0.30 * coherence + 0.25 * (1 - outlier) - 0.20 * merge


def weighted_mean(value: str, weight: str) -> Column:
    """By weight; the plain mean if the weights are all 0, 0 without rows."""
    return F.coalesce(F.when(F.sum(weight) > 0, F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).otherwise(F.avg(value)), F.lit(0.0))


def scores(clusters: DataFrame, pairs: DataFrame, by: str) -> DataFrame:
    """Per configuration: weighted coherence and outlier rate of (by, coherence, outlier, weight), plain separation and merge rate of
    (by, separation, merge), population deviations, and the composite score."""
    c = clusters.groupBy(by).agg(weighted_mean("coherence", "weight").alias("coherence_mean"), F.coalesce(F.stddev_pop("coherence"), F.lit(0.0)).alias("coherence_std"), weighted_mean("outlier", "weight").alias("outlier_rate"))
    p = pairs.groupBy(by).agg(F.coalesce(F.avg("separation"), F.lit(0.0)).alias("separation_mean"), F.coalesce(F.stddev_pop("separation"), F.lit(0.0)).alias("separation_std"), F.coalesce(F.avg("merge"), F.lit(0.0)).alias("merge_rate"))
    both = c.join(p, by, "left").na.fill(0.0)
    return both.withColumn("composite", composite(F.col("separation_mean"), F.col("coherence_mean"), F.col("outlier_rate"), F.col("merge_rate")))


def sized_pairs(ids: list[int], sizes: list[int], most: int = 50, seed: int = 42) -> list[tuple[int, int]]:
    """Half as many pairs as clusters, ``most`` at most: first all left ones, then all right ones, drawn by size with replacement (evenly if
    all sizes are 0); a cluster drawn with itself is paired with the next one."""
    n = min(most, len(ids) // 2)
    if not n:
        return []
    rng, all_ = np.random.default_rng(seed), sum(sizes)
    p = np.array(sizes, float) / all_ if all_ > 0 else None
    left, right = (rng.choice(len(ids), size=n, replace=True, p=p) for _ in range(2))
    right = np.where(left == right, (right + 1) % len(ids), right)
    return [(ids[a], ids[b]) for a, b in zip(left, right)]


def evaluate(members: DataFrame, judge: Judge, most_pairs: int = 50, cluster: str = "cluster_id", whole: DataFrame | None = None, most_merges: int = 30) -> DataFrame:
    """Coherence, separation and outliers of one clustering given as (cluster, question, count): one row of scores.

    Coherence is judged on all distinct questions of a cluster, outliers on the first ten; pairs are drawn among all clusters (a list of
    ids and sizes). Merges are asked for among the clusters of ``whole`` (the members before the coverage cap; all if not given) that share
    a keyword.
    """
    spark = members.sparkSession
    once = unique_in_cluster(members, cluster, "question", [-F.col("count"), F.col("question")])
    qs = F.transform(F.sort_array(F.collect_list(F.struct("position", "question"))), lambda s: s["question"])
    lists = once.groupBy(cluster).agg(qs.alias("qs"), F.count(F.lit(1)).alias("n")).join(members.groupBy(cluster).agg(F.sum("count").alias("weight")), cluster)
    coherent = judged(lists.where("n >= 2").withColumn("prompt", replies.ask_coherence(F.col("qs"))), "prompt", judge)
    coherent = coherent.select(cluster, replies.score(replies.letter(F.col("reply")), replies.COHERENCE, 0.5).alias("coherence"))
    odd = judged(lists.where("n >= 4").withColumn("prompt", replies.ask_outlier(F.slice("qs", 1, 10))), "prompt", judge)
    odd = odd.select(cluster, (replies.outlier(F.col("reply"), F.size("qs")) >= 0).cast("double").alias("outlier"))
    clusters = lists.join(coherent, cluster, "left").join(odd, cluster, "left").withColumn("k", F.lit(1))
    known = [(r[0], r[1]) for r in lists.select(cluster, "weight").orderBy(cluster).collect()]
    drawn = sized_pairs([k for k, _ in known], [int(v) for _, v in known], most_pairs)
    chosen = spark.createDataFrame([(a, b) for a, b in drawn] or [(-1, -1)], f"a {dict(lists.dtypes)[cluster]}, b {dict(lists.dtypes)[cluster]}")
    pairs = chosen.join(lists.select(F.col(cluster).alias("a"), F.col("qs").alias("qa")), "a").join(lists.select(F.col(cluster).alias("b"), F.col("qs").alias("qb")), "b")
    apart = judged(pairs.withColumn("prompt", replies.ask_separation(F.col("qa"), F.col("qb"))), "prompt", judge)
    none = F.lit(None).cast("double")
    apart = apart.select(F.lit(1).alias("k"), replies.score(replies.letter(F.col("reply")), replies.SEPARATION, 0.5).alias("separation"), none.alias("merge"))
    merges = judged(merge_pairs(members if whole is None else whole, cluster, most_merges).withColumn("prompt", replies.ask_merge(F.col("qa"), F.col("qb"))), "prompt", judge)
    merges = merges.select(F.lit(1).alias("k"), none.alias("separation"), replies.score(replies.letter(F.col("reply"), "B"), replies.MERGE, 0.0).alias("merge"))
    return scores(clusters, apart.unionByName(merges), "k").drop("k")


def merge_pairs(members: DataFrame, cluster: str = "cluster_id", most: int = 30) -> DataFrame:
    """(cluster_a, cluster_b, qa, qb): pairs of clusters that share one of their first keywords, with three questions of each."""
    docs = members.select("question").where("question is not null").distinct().withColumn("cleaned", clean("question"))
    kw = tfidf.keywords(tfidf.weights(docs, "question", "cleaned", tfidf.vocabulary(docs, "question", "cleaned")), "question")
    pairs = tfidf.shared_keyword_pairs(tfidf.cluster_keywords(members.select(cluster, "question").join(kw, "question"), cluster), cluster, n=most)
    first = unique_in_cluster(members, cluster, "question", [-F.col("count"), F.col("question")], 3)
    first = first.groupBy(cluster).agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "question"))), lambda s: s["question"]).alias("q"))
    return pairs.join(first.select(F.col(cluster).alias("cluster_a"), F.col("q").alias("qa")), "cluster_a").join(first.select(F.col(cluster).alias("cluster_b"), F.col("q").alias("qb")), "cluster_b")
