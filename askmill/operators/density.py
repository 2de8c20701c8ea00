"""Density clustering of one bounded set of vectors (HDBSCAN), and the search over a grid.

A set of questions is limited before it is clustered (``max_queries``), so all configurations that share coordinates are one task; tasks are
independent and run in parallel. Clusters are formed on coordinates that come from the graph of nearest neighbours in the hybrid distance, so
alpha and the number of neighbours count. Distances are computed by rows: memory is linear in the number of questions.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import unit


def hdbscan(x: np.ndarray, min_cluster_size: int = 5, min_samples: int = 5) -> np.ndarray:
    """Labels from 0, noise -1: core distances, minimum spanning tree of the mutual reachability, condensed tree, excess of mass."""
    n = len(x)
    if n < max(2, min_cluster_size):
        return np.full(n, -1)
    k = min(max(1, min_samples), n - 1)
    core = np.empty(n)
    sq = (x * x).sum(1)
    for at in range(0, n, 512):
        d = np.sqrt(np.maximum(sq[at : at + 512, None] + sq[None] - 2 * x[at : at + 512] @ x.T, 0))
        core[at : at + 512] = np.partition(d, k, axis=1)[:, k]
    inside, near, via = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)
    edges, now = [], 0
    for _ in range(n - 1):
        inside[now] = True
        d = np.maximum(np.sqrt(np.maximum(sq + sq[now] - 2 * x @ x[now], 0)), np.maximum(core, core[now]))
        closer = (d < near) & ~inside
        near[closer], via[closer] = d[closer], now
        now = int(np.where(inside, np.inf, near).argmin())
        edges.append((near[now], int(via[now]), now))
    edges.sort(key=lambda e: e[0])

    parent, size = list(range(2 * n - 1)), [1] * n + [0] * (n - 1)
    left, right, height = [0] * (n - 1), [0] * (n - 1), [0.0] * (n - 1)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for m, (w, a, b) in enumerate(edges):
        a, b = root(a), root(b)
        parent[a] = parent[b] = n + m
        left[m], right[m], height[m], size[n + m] = a, b, w, size[a] + size[b]

    def leaves(i: int) -> list[int]:
        out, todo = [], [i]
        while todo:
            j = todo.pop()
            if j < n:
                out.append(j)
            else:
                todo += [left[j - n], right[j - n]]
        return out

    # condensed tree: clusters with birth, stability and children; points fall out of them
    birth, stable, children, points = [0.0], [0.0], [[]], [[]]
    todo = [(2 * n - 2, 0)]
    while todo:
        node, c = todo.pop()
        if node < n:
            points[c].append(node)
            continue
        lam = 1 / height[node - n] if height[node - n] > 0 else np.inf
        a, b = left[node - n], right[node - n]
        big = [s for s in (a, b) if size[s] >= min_cluster_size]
        gain = (min(lam, 1e12) - birth[c]) if np.isfinite(lam) or birth[c] < 1e12 else 0.0
        if len(big) == 2:
            stable[c] += gain * size[node]
            for s in big:
                birth.append(min(lam, 1e12))
                stable.append(0.0)
                children.append([])
                points.append([])
                children[c].append(len(birth) - 1)
                todo.append((s, len(birth) - 1))
        else:
            for s in (a, b):
                if s not in big:
                    fallen = leaves(s)
                    points[c] += fallen
                    stable[c] += gain * len(fallen)
            if big:
                todo.append((big[0], c))
    chosen = [False] * len(birth)
    for c in range(len(birth) - 1, 0, -1):
        below = sum(stable[d] for d in children[c])
        if stable[c] >= below:
            chosen[c] = True
            drop = list(children[c])
            while drop:
                d = drop.pop()
                chosen[d] = False
                drop += children[d]
        else:
            stable[c] = below
    labels, number = np.full(n, -1), 0
    for c in range(1, len(birth)):
        if chosen[c]:
            members, todo = [], [c]
            while todo:
                d = todo.pop()
                members += points[d]
                todo += children[d]
            labels[members] = number
            number += 1
    return labels


def neighbour_graph(x: np.ndarray, terms: list[list[str]], alpha: float, k: int, most_terms: int = 1000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, distances) of the k nearest others of each item in the hybrid distance alpha * cosine + (1 - alpha) * Jaccard.

    Terms are the ``most_terms`` commonest ones. Distances are computed for 512 rows at a time, so there is no matrix of all pairs.
    """
    n = len(x)
    k = min(k, n - 1)
    u = unit(x)
    count = Counter(t for ts in terms for t in set(ts))
    at = {t: i for i, (t, _) in enumerate(sorted(count.items(), key=lambda c: (-c[1], c[0]))[:most_terms])}
    b = np.zeros((n, max(1, len(at))), np.float32)
    for i, ts in enumerate(terms):
        b[i, [at[t] for t in set(ts) if t in at]] = 1
    size = b.sum(1)
    rows, cols, dist = [], [], []
    for i in range(0, n, 512):
        both = b[i : i + 512] @ b.T
        either = size[i : i + 512, None] + size[None] - both
        sparse = np.where(either > 0, 1 - both / np.maximum(either, 1), 0.0)
        d = alpha * (1 - u[i : i + 512] @ u.T) + (1 - alpha) * sparse
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        near = np.argsort(np.round(d, 9), axis=1, kind="stable")[:, :k]
        rows.append(np.repeat(np.arange(i, i + len(d)), k))
        cols.append(near.ravel())
        dist.append(np.maximum(np.take_along_axis(d, near, 1), 0).ravel())
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dist)


def reduce(graph: tuple[np.ndarray, np.ndarray, np.ndarray], n: int, components: int, rounds: int = 60, steps: int = 4) -> np.ndarray:
    """Coordinates from a neighbour graph: the smoothest vectors on it, less smooth ones shrunk (a diffusion map of ``steps`` steps, by
    subspace iteration).

    Weights fall with the distance beyond the nearest neighbour, on the scale of each item's own neighbours, and are made symmetric as the
    probability that either end keeps the edge. A stand-in where no manifold reducer is at hand: it starts from the same kind of graph.
    """
    rows, cols, dist = graph
    k = max(1, len(rows) // max(1, n))
    d = dist.reshape(n, k)
    beyond = np.maximum(d - d.min(1, keepdims=True), 0)
    w = np.exp(-beyond / np.maximum(beyond.mean(1, keepdims=True), 1e-9)).ravel()
    key, back = np.unique(np.minimum(rows, cols) * n + np.maximum(rows, cols), return_inverse=True)
    total, times = np.bincount(back, w), np.bincount(back)
    product = np.exp(np.bincount(back, np.log(np.maximum(w, 1e-300))))
    s = total - np.where(times > 1, product, 0.0)
    i, j = key // n, key % n
    degree = np.maximum(np.bincount(i, s, n) + np.bincount(j, s, n), 1e-12)
    s = s / np.sqrt(degree[i] * degree[j])
    m = max(1, min(components, n - 1))
    flat = np.sqrt(degree) / np.sqrt(degree.sum())  # the vector that tells nothing
    v = np.random.default_rng(42).normal(size=(n, m))
    for _ in range(rounds):
        v = np.linalg.qr(v - np.outer(flat, flat @ v))[0]
        y = v.copy()  # (1 + W) v has the largest eigenvalues first
        for c in range(m):
            y[:, c] += np.bincount(i, s * v[j, c], n) + np.bincount(j, s * v[i, c], n)
        v = y
    v = np.linalg.qr(v - np.outer(flat, flat @ v))[0]
    value = np.array([2 * (s * v[i, c] * v[j, c]).sum() for c in range(m)])  # how smooth each vector is, 1 at most
    v = v * np.maximum(value, 0) ** steps
    v = v * np.where(v[np.abs(v).argmax(0), np.arange(m)] < 0, -1.0, 1.0)  # one sign at any platform
    return np.round(v * np.sqrt(n) / np.sqrt(degree / degree.mean())[:, None], 9)


def grid_labels(items: DataFrame, grid: DataFrame, key: str, vector: str, terms: str, most: int = 20_000) -> DataFrame:
    """(config_id, key, cluster_id): labels of every configuration of a grid.

    All configurations of one alpha, number of neighbours and number of components share the graph and the coordinates: they are one task.
    A task holds all items, so more than ``most`` of them are an error (a run limits its questions first).
    """
    if items.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} items; take a sample first")
    kind = dict(items.dtypes)[key]
    shared = ["alpha", "n_neighbors", "n_components"]
    configs = grid.groupBy(*shared).agg(F.sort_array(F.collect_list(F.struct("config_id", "min_cluster_size", "min_samples"))).alias("configs"))
    rows = items.select(F.col(key).alias("id"), F.col(vector).alias("v"), F.coalesce(terms, F.array().cast("array<string>")).alias("t")).crossJoin(F.broadcast(configs))  # a grid has a few thousand rows at most

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        c = pdf.iloc[0]
        x = np.array(pdf["v"].tolist(), np.float64)
        if len(x) > 2:
            x = reduce(neighbour_graph(x, [list(t) for t in pdf["t"]], float(c["alpha"]), int(c["n_neighbors"])), len(x), int(c["n_components"]))
        out = [pd.DataFrame({"config_id": k["config_id"], "id": pdf["id"], "cluster_id": hdbscan(x, int(k["min_cluster_size"]), int(k["min_samples"]))}) for k in c["configs"]]
        return pd.concat(out)

    return rows.groupBy(*shared).applyInPandas(of, f"config_id int, id {kind}, cluster_id long").withColumnRenamed("id", key)
