"""Answer-distinct questions: groups from replies, roll-up, merges across clusters, checks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.replies import ask_same, json_list, label_cut
from ..functions.vectors import unit
from .models import Judge
from .rank import checkpoint_folder, first_per_group
from .similarity import similar_pairs


def parse_groups(replies: DataFrame, key: str = "cluster_id", repeats: bool = False) -> DataFrame:
    """(key, group_no, answer_label, idx) of replies (key, raw, n): each index from 0 to n - 1 in one group.

    The first group that claims an index has it; what is no index is left out; missed indices are groups of their own, '(unclassified)',
    after the others. A broken reply leaves all of them. With ``repeats`` an index that a group names twice is in it twice.
    """
    all_ = replies.select(key, F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("idx")).where("idx >= 0")
    g = replies.select(key, "n", F.posexplode(F.coalesce(json_list(F.col("raw")), F.expr("cast(array() as array<struct<group:string,label:string,indices:array<string>>>)"))).alias("g", "x"))
    i = g.select(key, "n", "g", F.col("x.label").alias("label"), F.posexplode(F.coalesce("x.indices", F.expr("cast(array() as array<string>)"))).alias("p", "i"))
    i = i.withColumn("idx", F.col("i").try_cast("int") - 1).where("idx >= 0 and idx < n")
    claimed = first_per_group(i.select(key, "idx", "g", "p", "label"), [key, "idx"], [F.col("g"), F.col("p")])
    if repeats:
        claimed = i.join(claimed.select(key, "idx", "g"), [key, "idx", "g"], "left_semi")
    named = claimed.select(key, F.col("g").alias("_g"), label_cut(F.col("label")).alias("answer_label"), "idx")
    lone = all_.join(claimed.select(key, "idx").distinct(), [key, "idx"], "left_anti").select(key, (F.col("idx") + 1_000_000).alias("_g"), F.lit("(unclassified)").alias("answer_label"), "idx")
    out = named.unionByName(lone)
    return out.withColumn("group_no", F.dense_rank().over(Window.partitionBy(key).orderBy("_g"))).drop("_g").select(key, "group_no", "answer_label", "idx")


def split_groups(replies: DataFrame, key: str = "cluster_id") -> DataFrame:
    """The same for splits: missed indices join the largest group (the first on a tie); a broken reply is one group."""
    g = parse_groups(replies, key, repeats=True)
    sizes = g.where("answer_label <> '(unclassified)'").groupBy(key, "group_no", "answer_label").agg(F.count(F.lit(1)).alias("_n"))
    big = first_per_group(sizes, [key], [-F.col("_n"), F.col("group_no")]).select(key, F.col("group_no").alias("_b"), F.col("answer_label").alias("_l"))
    j = g.join(big, key, "left")
    lost = F.col("answer_label") == "(unclassified)"
    return j.select(key, F.when(lost, F.coalesce("_b", F.lit(1))).otherwise(F.col("group_no")).alias("group_no"), F.when(lost, F.coalesce("_l", F.lit(""))).otherwise(F.substring("answer_label", 1, 100)).alias("answer_label"), "idx")


def roll_up(members: DataFrame) -> DataFrame:
    """Per (cluster_id, group_no) of (cluster_id, group_no, position, question, freq): sum, size, first most frequent member, share."""
    best = F.min(F.struct((-F.col("freq")).alias("f"), "position", "question"))
    g = members.groupBy("cluster_id", "group_no").agg(F.sum("freq").alias("raw_frequency"), F.count(F.lit(1)).alias("n_questions_in_group"), best.alias("_b"))
    total = F.sum("raw_frequency").over(Window.partitionBy("cluster_id"))
    return g.select("cluster_id", "group_no", F.col("_b.question").alias("representative_question"), "raw_frequency", "n_questions_in_group", F.coalesce(F.round(F.try_divide(F.col("raw_frequency") * 100, total), 2), F.lit(0.0)).alias("pct_of_cluster_volume"))


def cross_cluster(pairs: DataFrame, freq: DataFrame) -> DataFrame:
    """(key, _to): what each dropped key is merged into, by pairs (a, b, similarity) and frequencies (key, freq).

    Pairs count from the most similar one on (ties by ids); the key with the higher frequency as it stands then is kept (a on a tie), and
    pairs of a key that is gone are skipped. A pair depends on earlier ones of its two keys only, so each round takes all pairs that come
    before every other one of both their keys, and the outcome is that of the serial walk. Nothing of it goes to the driver but one
    number a round.
    """
    ends = lambda e: e.select(F.col("a").alias("key"), "o").unionByName(e.select(F.col("b").alias("key"), "o"))
    spark = pairs.sparkSession
    checkpoint_folder(spark)
    edges = pairs.select("a", "b", F.struct((-F.round("similarity", 9)).alias("s"), "a", "b").alias("o")).checkpoint()
    now = freq.select("key", "freq").join(ends(edges).select("key").distinct(), "key", "left_semi").checkpoint()
    parts: list[DataFrame] = []
    while edges.limit(1).count():
        first = ends(edges).groupBy("key").agg(F.min("o").alias("o"))
        best = edges.join(first.select(F.col("key").alias("a"), "o"), ["a", "o"], "left_semi").join(first.select(F.col("key").alias("b"), "o"), ["b", "o"], "left_semi")
        sized = best.join(now.select(F.col("key").alias("a"), F.col("freq").alias("fa")), "a").join(now.select(F.col("key").alias("b"), F.col("freq").alias("fb")), "b")
        keep_a = F.coalesce(F.col("fa"), F.lit(0)) >= F.coalesce(F.col("fb"), F.lit(0))
        moves = sized.select(F.when(keep_a, F.col("b")).otherwise(F.col("a")).alias("key"), F.when(keep_a, F.col("a")).otherwise(F.col("b")).alias("_to"), F.least("fa", "fb").alias("more")).checkpoint()
        parts.append(moves.select("key", "_to"))
        gone = moves.select("key")
        now = now.join(gone, "key", "left_anti").join(moves.select(F.col("_to").alias("key"), "more"), "key", "left").select("key", (F.col("freq") + F.coalesce("more", F.lit(0))).alias("freq")).checkpoint()
        # a pair that was taken has lost a key, so it goes as well
        edges = edges.join(gone.withColumnRenamed("key", "a"), "a", "left_anti").join(gone.withColumnRenamed("key", "b"), "b", "left_anti").select("a", "b", "o").checkpoint()
    out = freq.select("key", F.col("key").alias("_to")).where("false")
    for p in parts:
        out = out.unionByName(p)
    return out


def cross_cluster_dedup(rows: DataFrame, key: str, vector: str, cluster: str, freq: str, threshold: float = 0.92, also: tuple[str, ...] = ()) -> DataFrame:
    """Rows with the near-identical ones of other clusters merged: frequencies (and the columns ``also``) added up, merged_cross_cluster set."""
    pairs = similar_pairs(rows, key, vector, threshold, cluster)
    moves = cross_cluster(pairs, rows.select(F.col(key).alias("key"), F.col(freq).alias("freq"))).withColumnRenamed("key", key)
    moved = rows.join(moves, key, "left").withColumn("_k", F.coalesce("_to", key))
    sums = moved.groupBy("_k").agg(*[F.sum(c).alias(c) for c in (freq, *also)], F.count(F.lit(1)).alias("_n"))
    return rows.drop(freq, *also).join(sums, rows[key] == sums["_k"]).withColumn("merged_cross_cluster", F.col("_n") > 1).drop("_k", "_n")


def merge_groups(vectors: np.ndarray, threshold: float, same=lambda i, j: True) -> list[list[int]]:
    """Groups merged in order: a group takes each later one that is near its own first member and approved; no chains."""
    sim, gone, out = unit(vectors) @ unit(vectors).T, set(), []
    for i in range(len(vectors)):
        if i in gone:
            continue
        mine = [i]
        for j in range(i + 1, len(vectors)):
            if j not in gone and sim[i, j] >= threshold and same(i, j):
                mine.append(j)
                gone.add(j)
        out.append(mine)
    return out


def chunks(members: DataFrame, cluster: str, size: int = 12) -> DataFrame:
    """Add chunk_no: positions of a cluster cut into parts of ``size`` for one call each."""
    return members.withColumn("chunk_no", F.floor((F.col("position") - 1) / size).cast("int"))


def merge_chunk_groups(groups: DataFrame, cluster: str, vector: str, threshold: float = 0.88, judge: Judge | None = None, text: str = "question", crop: str = "") -> DataFrame:
    """(cluster, group_no, merged_no): groups of a cluster's chunks (with the vector and text of their first member) that are one answer.

    With a judge, near ones are merged only if it says so.
    """
    kind = dict(groups.dtypes)[cluster]

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("group_no")
        to = np.zeros(len(pdf), int)

        def same(i: int, j: int) -> bool:
            if judge is None:
                return True
            reply = judge.reply([ask_same(crop, pdf[text].iloc[i], pdf[text].iloc[j])])[0]
            return next((c for c in (reply or "").upper() if c in "ABC"), "B") == "A"

        for k, mine in enumerate(merge_groups(np.array(pdf[vector].tolist(), np.float64), threshold, same), 1):
            to[mine] = k
        return pd.DataFrame({cluster: pdf[cluster], "group_no": pdf["group_no"], "merged_no": to})

    return groups.groupBy(cluster).applyInPandas(of, f"{cluster} {kind}, group_no int, merged_no int")


def verification(groups: DataFrame, log_rows: int, questions: int) -> DataFrame:
    """One row of checks over (cluster_id, raw_frequency, n_questions_in_group)."""
    return groups.agg(
        F.count_distinct("cluster_id").alias("n_clusters"), F.count(F.lit(1)).alias("n_groups"), F.sum("raw_frequency").alias("sum_frequency"), F.sum("n_questions_in_group").alias("n_questions"),
    ).select(
        "n_clusters", "n_groups", "n_questions", "sum_frequency", F.lit(log_rows).cast("long").alias("log_rows"), (F.col("sum_frequency") <= log_rows).alias("frequency_ok"),
        F.round(1 - F.try_divide(F.col("n_groups").cast("double"), F.lit(float(questions))), 6).alias("reduction"), F.round(F.try_divide(F.col("n_groups").cast("double"), F.col("n_clusters")), 6).alias("groups_per_cluster"),
    )


def distribution(groups: DataFrame) -> DataFrame:
    """How many clusters have one, two or three, and more groups."""
    n = groups.groupBy("cluster_id").agg(F.max("group_no").alias("k"))
    return n.agg(F.count_if(F.col("k") == 1).alias("one"), F.count_if(F.col("k").between(2, 3)).alias("two_or_three"), F.count_if(F.col("k") >= 4).alias("four_or_more"))
