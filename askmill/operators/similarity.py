"""Similarity of vectors: threshold joins, nearest neighbours, hybrid distance.

Pairs over a threshold come from block products: the vectors are cut into blocks by the hash of their id, each pair of blocks is one task
that multiplies two bounded matrices. With b blocks every vector is sent to b tasks, so the work is spread evenly, nothing is broadcast,
and no matrix of all pairs exists; only pairs over the threshold leave a task.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import cosine, jaccard_distance, unit

BLOCK = 4096


def similar_pairs(vectors: DataFrame, key: str, vector: str, threshold: float, group: str | None = None, block: int = BLOCK) -> DataFrame:
    """(a, b, similarity), a < b: pairs with a cosine of the threshold or more; with group, only pairs of different groups."""
    n = vectors.count()
    blocks = max(1, -(-n // block))
    v = vectors.select(F.col(key).alias("id"), F.col(vector).alias("v"), (F.col(group) if group else F.lit(0)).cast("long").alias("g")).where(F.col("v").isNotNull())
    v = v.withColumn("h", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    tasks = v.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("id", "v", "g", "h", F.least("h", "o").alias("p"), F.greatest("h", "o").alias("q"))

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = int(pdf["p"].iloc[0]), int(pdf["q"].iloc[0])
        left = pdf[pdf["h"] == p]
        right = pdf[pdf["h"] == q]
        out = []
        if len(left) and len(right):
            a, b = (unit(np.array(x["v"].tolist(), np.float64)) for x in (left, right))
            for at in range(0, len(a), 1024):
                i, j = np.nonzero(a[at : at + 1024] @ b.T >= threshold - 1e-12)
                s = np.einsum("ij,ij->i", a[at + i], b[j])
                out.append(pd.DataFrame({"x": left["id"].to_numpy()[at + i], "y": right["id"].to_numpy()[j], "s": s, "d": left["g"].to_numpy()[at + i] != right["g"].to_numpy()[j]}))
        r = pd.concat(out) if out else pd.DataFrame({"x": [], "y": [], "s": [], "d": []})
        r = r[(r["x"] < r["y"]) | ((r["y"] < r["x"]) & (p != q))]
        if group:
            r = r[r["d"].astype(bool)]
        lo, hi = np.minimum(r["x"], r["y"]), np.maximum(r["x"], r["y"])
        return pd.DataFrame({"a": lo, "b": hi, "similarity": r["s"]})

    kind = dict(vectors.dtypes)[key]
    return tasks.groupBy("p", "q").applyInPandas(of, f"a {kind}, b {kind}, similarity double")


def merge_candidates(vectors: DataFrame, key: str, vector: str, threshold: float = 0.82, n: int = 100) -> DataFrame:
    """The n most similar pairs over a threshold, ties by ids."""
    return similar_pairs(vectors, key, vector, threshold).orderBy(F.desc(F.round("similarity", 9)), "a", "b").limit(n)


def nearest(points: DataFrame, targets: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, nearest_id, label, distance): for each point the closest target (Euclidean, ties by id).

    Points and targets meet in blocks of bounded size; each task keeps the best of its block, an aggregation the best of all.
    """
    blocks = max(1, -(-targets.count() // BLOCK))
    parts = max(1, -(-points.count() // BLOCK))
    kind, lab = dict(points.dtypes)[key], dict(targets.dtypes)[label]
    t = targets.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.col(label).alias("l"), F.lit(True).alias("is_target"), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p"))
    p = points.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.lit(None).cast(lab).alias("l"), F.lit(False).alias("is_target"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("q"), F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("p")).select("id", "v", "l", "is_target", "q", "p")

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[~pdf["is_target"]], pdf[pdf["is_target"]].sort_values("id")
        if not len(a) or not len(b):
            return pd.DataFrame({"id": a["id"].head(0), "nearest_id": b["id"].head(0), "l": b["l"].head(0), "distance": np.zeros(0)})
        x, y = np.array(a["v"].tolist(), np.float64), np.array(b["v"].tolist(), np.float64)
        d = np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * x @ y.T, 0)
        k = np.round(d, 12).argmin(1)
        exact = np.linalg.norm(x - y[k], axis=1)
        return pd.DataFrame({"id": a["id"].to_numpy(), "nearest_id": b["id"].to_numpy()[k], "l": b["l"].to_numpy()[k], "distance": exact})

    best = t.unionByName(p).groupBy("p", "q").applyInPandas(of, f"id {kind}, nearest_id {kind}, l {lab}, distance double")
    top = best.groupBy("id").agg(F.min(F.struct(F.round("distance", 9).alias("d"), "nearest_id", "l", "distance")).alias("m"))
    return top.select(F.col("id").alias(key), "m.nearest_id", F.col("m.l").alias(label), "m.distance")


def pair_distances(pairs: DataFrame, docs: DataFrame, key: str, vector: str, terms: str, alphas: list[float]) -> DataFrame:
    """Cosine, Jaccard and hybrid distances of given pairs (a, b), one row per alpha."""
    a = docs.select(F.col(key).alias("a"), F.col(vector).alias("_va"), F.col(terms).alias("_ta"))
    b = docs.select(F.col(key).alias("b"), F.col(vector).alias("_vb"), F.col(terms).alias("_tb"))
    d = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", (1 - cosine(F.col("_va"), F.col("_vb"))).alias("cosine_distance"), jaccard_distance(F.col("_ta"), F.col("_tb")).alias("jaccard_distance"))
    out = d.withColumn("alpha", F.explode(F.array(*[F.lit(float(x)) for x in alphas])))
    return out.withColumn("hybrid_distance", F.col("alpha") * F.col("cosine_distance") + (1 - F.col("alpha")) * F.col("jaccard_distance"))


def centroid_nearest(vectors: DataFrame, key: str, vector: str, cluster: str) -> DataFrame:
    """Per cluster the member closest to the mean of the normalised vectors (ties by id): a sum by position, then one pass."""
    length = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    u = vectors.select(key, cluster, F.transform(vector, lambda x: x.cast("double") / F.when(length == 0, F.lit(1e-9)).otherwise(length)).alias("u"))
    mean = u.select(cluster, F.posexplode("u").alias("p", "x")).groupBy(cluster, "p").agg(F.avg("x").alias("x")).groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "x"))), lambda s: s["x"]).alias("c"))
    scored = u.join(mean, cluster).select(cluster, key, F.aggregate(F.zip_with("u", "c", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x).alias("s"))
    best = scored.groupBy(cluster).agg(F.min(F.struct((-F.round("s", 9)).alias("s"), F.col(key).alias("id"))).alias("m"), F.count(F.lit(1)).alias("members"))
    return best.select(cluster, F.col("m.id").alias("centre_id"), "members")


