"""Repair of clusters: representatives, contamination, splits, merges, and the way back to the rows.

Clusters are kept in long form, (cluster_id, question, count). Work on single clusters is grouped (a cluster is bounded by the limit
of questions per run); greedy merges run over a bounded list of candidate pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import unit
from .rank import first_per_group, global_rank


def pick_diverse(x: np.ndarray, k: int) -> list[int]:
    """The member nearest to the centroid, then k - 1 times the one farthest from those picked (first on ties)."""
    u = unit(x)
    picked = [int(np.round(u @ u.mean(0), 12).argmax())]
    gap = 1 - u @ u[picked[0]]
    while len(picked) < min(k, len(x)):
        gap[picked] = -np.inf
        picked.append(int(np.round(gap, 12).argmax()))
        gap = np.minimum(gap, 1 - u @ u[picked[-1]])
    return picked


def diverse(members: DataFrame, cluster: str, key: str, vector: str, k: int = 3) -> DataFrame:
    """(cluster, position, key): k members of each cluster that are far apart; position 1 is the representative."""
    kinds = dict(members.dtypes)

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key)
        at = pick_diverse(np.array(pdf[vector].tolist(), np.float64), k)
        return pd.DataFrame({cluster: pdf[cluster].iloc[at].to_numpy(), "position": np.arange(1, len(at) + 1), key: pdf[key].iloc[at].to_numpy()})

    return members.select(cluster, key, vector).where(F.col(vector).isNotNull()).groupBy(cluster).applyInPandas(of, f"{cluster} {kinds[cluster]}, position int, {key} {kinds[key]}")


def without_flagged(members: DataFrame, flagged: DataFrame, drop_contaminated: bool = False) -> DataFrame:
    """Members without the flagged (cluster_id, question), but for clusters that would keep fewer than two: these stay as they are,
    or with drop_contaminated are removed."""
    bad = flagged.select("cluster_id", "question").distinct().withColumn("_bad", F.lit(True))
    marked = members.join(bad, ["cluster_id", "question"], "left")
    left = marked.groupBy("cluster_id").agg(F.count(F.when(F.col("_bad").isNull(), 1)).alias("_left"))
    joined = marked.join(left, "cluster_id")
    keep = F.col("_bad").isNull() & (F.col("_left") >= 2) if drop_contaminated else F.col("_bad").isNull() | (F.col("_left") < 2)
    return joined.where(keep).drop("_bad", "_left")


def split(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Apply splits given as (cluster_id, group_no, question). Groups of one join the largest group; new ids follow the largest id.

    Adds parent_cluster (null if not split). Questions not named in any group go to the largest one; clusters of one group stay.
    """
    given = members.join(groups.select("cluster_id", "question", "group_no").dropDuplicates(["cluster_id", "question"]), ["cluster_id", "question"], "left")
    touched = groups.select("cluster_id").distinct()
    sizes = given.where("group_no is not null").groupBy("cluster_id", "group_no").agg(F.count(F.lit(1)).alias("n"))
    largest = first_per_group(sizes, ["cluster_id"], [-F.col("n"), F.col("group_no")]).select("cluster_id", F.col("group_no").alias("_big"))
    small = sizes.where("n < 2").select("cluster_id", "group_no", F.lit(True).alias("_small"))
    fixed = given.join(small, ["cluster_id", "group_no"], "left").join(largest, "cluster_id", "left")
    fixed = fixed.withColumn("group_no", F.when(F.col("_small") | F.col("group_no").isNull(), F.col("_big")).otherwise(F.col("group_no"))).drop("_small", "_big")
    several = fixed.join(touched, "cluster_id", "left_semi").groupBy("cluster_id").agg(F.count_distinct("group_no").alias("_k")).where("_k > 1").select("cluster_id")
    top = members.agg(F.coalesce(F.max("cluster_id"), F.lit(-1)).alias("_top"))  # one row
    new = global_rank(fixed.join(several, "cluster_id", "left_semi").select("cluster_id", "group_no").distinct(), [F.col("cluster_id").asc(), F.col("group_no").asc()], "_new").crossJoin(F.broadcast(top)).select("cluster_id", "group_no", (F.col("_top") + F.col("_new")).alias("_id"))
    out = fixed.join(new, ["cluster_id", "group_no"], "left")
    return out.withColumns({"parent_cluster": F.when(F.col("_id").isNotNull(), F.col("cluster_id")), "cluster_id": F.coalesce("_id", "cluster_id")}).drop("_id", "group_no")


def greedy_merges(pairs: list[tuple[int, int, float]], sizes: dict[int, int], approved=lambda a, b: True) -> dict[int, int]:
    """absorbed -> absorbing cluster. Pairs by similarity; the larger absorbs (the first on a tie); absorbed ones are skipped, so merges
    are not passed on through a cluster that is gone."""
    gone: dict[int, int] = {}
    now = dict(sizes)
    for a, b, _ in sorted(pairs, key=lambda p: (-round(p[2], 9), p[0], p[1])):
        if a in gone or b in gone or not approved(a, b):
            continue
        keep, drop = (a, b) if now[a] >= now[b] else (b, a)
        now[keep] += now[drop]
        gone[drop] = keep
    return gone


def merge(members: DataFrame, candidates: DataFrame, approved=lambda a, b: True, most: int = 100) -> DataFrame:
    """Merge clusters by the best ``most`` candidate pairs (a, b, similarity); adds merged_from (sorted ids, null if none)."""
    spark = members.sparkSession
    pairs = [(r["a"], r["b"], r["similarity"]) for r in candidates.orderBy(F.desc("similarity"), "a", "b").limit(most).collect()]
    ids = sorted({x for a, b, _ in pairs for x in (a, b)})
    sizes = {r["cluster_id"]: r["s"] for r in members.where(F.col("cluster_id").isin(ids)).groupBy("cluster_id").agg(F.sum("count").alias("s")).collect()}
    gone = greedy_merges([p for p in pairs if p[0] in sizes and p[1] in sizes], sizes, approved)
    kind = dict(members.dtypes)["cluster_id"]
    moves = spark.createDataFrame([(k, v) for k, v in sorted(gone.items())], f"cluster_id {kind}, _to {kind}")  # fewer than ``most``
    came = moves.groupBy(F.col("_to").alias("cluster_id")).agg(F.sort_array(F.collect_list("cluster_id")).alias("merged_from"))
    moved = members.join(F.broadcast(moves), "cluster_id", "left").withColumn("cluster_id", F.coalesce("_to", "cluster_id")).drop("_to")
    return moved.join(F.broadcast(came), "cluster_id", "left")


def back_map(log: DataFrame, clusters: DataFrame, question: str = "query_text") -> DataFrame:
    """Rows of the log with final_cluster_id, cluster_label and is_representative; clusters: (cluster_id, question, label, representative).

    A question in several clusters goes to the lowest id. A question in a large share of all rows is one row on the cluster side; the
    row side of such a key is split by AQE. Null questions are mapped to nothing.
    """
    one = clusters.groupBy("question").agg(F.min(F.struct("cluster_id", "label")).alias("_m"))
    to = one.select(F.col("question").alias(question), F.col("_m.cluster_id").alias("final_cluster_id"), F.col("_m.label").alias("cluster_label"))
    reps = clusters.select(F.col("representative").alias(question), F.lit(True).alias("_rep")).where(F.col(question).isNotNull()).distinct()
    out = log.join(to, question, "left").join(reps, question, "left")
    return out.withColumn("is_representative", F.coalesce("_rep", F.lit(False))).drop("_rep")


def repaired(members: DataFrame) -> DataFrame:
    """One row per cluster of (cluster_id, question, count, label, representative, parent_cluster, merged_from)."""
    order = F.transform(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("c"), F.col("question").alias("q")))), lambda s: s["q"])
    c = members.groupBy("cluster_id").agg(
        F.min("label").alias("label"), F.min("representative").alias("representative"), F.count(F.lit(1)).alias("n_unique_questions"), F.sum("count").alias("query_volume"),
        F.min("parent_cluster").alias("parent_cluster"), F.min(F.array_join("merged_from", ",")).alias("merged_from"), order.alias("all_unique_questions"),
    )
    w = Window.orderBy(F.desc("query_volume"), F.asc("cluster_id"))
    return c.withColumns({"rank": F.row_number().over(w), "pct_of_total": F.round(F.try_divide("query_volume", F.sum("query_volume").over(Window.partitionBy())) * 100, 2), "was_split": F.col("parent_cluster").isNotNull()})


def refreshed(representatives: DataFrame, members: DataFrame) -> DataFrame:
    """Representatives (cluster_id, position, question) that are still members; a cluster left without one gets its first member."""
    still = representatives.join(members.select("cluster_id", "question").distinct(), ["cluster_id", "question"], "left_semi")
    first = first_per_group(members.select("cluster_id", "question", "count"), ["cluster_id"], [-F.col("count"), F.col("question")])
    lone = first.join(still.select("cluster_id").distinct(), "cluster_id", "left_anti").select("cluster_id", F.lit(1).alias("position"), "question")
    return still.select("cluster_id", "position", "question").unionByName(lone)
