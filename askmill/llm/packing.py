"""Problem 6: items of varying length in containers of fixed capacity.

Method: first-fit decreasing with a tournament tree of the containers' room, run independently in randomised groups of documents.

The size of a document is its number of tokens, one for each UTF-8 byte (the text decides; columns with counts are not used). Sizes are
computed in the JVM, so no text is shuffled. A document that is larger than the capacity is cut into pieces of exactly the capacity,
each a container of its own, and a rest that is packed like any item; nothing else is split. Documents are spread over
``ceil(n / GROUP)`` groups by the hash of their id, so a group is a bounded task at any n, and each group leaves at most one container
that could be merged with another group's.

Null and empty texts have size 0 and are placed like the others. Ties are broken by the id, so the result does not depend on the
partitioning. Repeated ids are items of their own. No documents or no capacities: no rows. A capacity that is null or below 1 is left out.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = 20_000


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    """The container of each size, in the given order: the first one with room for it. The tree holds the most room below each node."""
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    out = []
    for size in sizes:
        k = 1
        while k < leaves:
            k *= 2
            if tree[k] < size:
                k += 1
        out.append(k - leaves)
        tree[k] -= size
        k //= 2
        while k:
            best = tree[2 * k] if tree[2 * k] >= tree[2 * k + 1] else tree[2 * k + 1]
            if tree[k] == best:
                break
            tree[k] = best
            k //= 2
    return out


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    """One group of documents at one capacity."""
    capacity = int(pdf["capacity_tokens"].iloc[0])
    pdf = pdf.sort_values(["tokens", "doc_id"], ascending=[False, True], kind="stable")
    whole: list[tuple] = []
    rest: list[tuple] = []
    for doc, size in zip(pdf["doc_id"], pdf["tokens"]):
        full, left = (divmod(int(size), capacity)) if size > capacity else (0, int(size))
        whole += [(doc, p, capacity) for p in range(1, full + 1)]
        if left or not full:
            rest.append((doc, full + 1, left))
    rest.sort(key=lambda x: -x[2])
    place = first_fit([x[2] for x in rest], capacity)
    rows = [(k, *x) for k, x in enumerate(whole)] + [(len(whole) + k, *x) for k, x in zip(place, rest)]
    out = pd.DataFrame(rows, columns=["container_no", "doc_id", "piece_no", "tokens"])
    out["doc_id"] = out["doc_id"].astype(pdf["doc_id"].dtype)
    out.insert(0, "capacity_id", pdf["capacity_id"].iloc[0])
    out.insert(1, "group_no", pdf["group_no"].iloc[0])
    return out


def pack(documents: DataFrame, capacities: DataFrame, group: int = GROUP) -> DataFrame:
    """(capacity_id, group_no, container_no, doc_id, piece_no, tokens): where every piece of every document goes, at every capacity.

    A container is named by the first three columns.
    """
    items = documents.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("tokens"))
    groups = max(1, -(-documents.count() // group))
    items = items.withColumn("group_no", F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(groups)).cast("int"))
    wanted = capacities.select("capacity_id", F.col("capacity_tokens").cast("long").alias("capacity_tokens")).where("capacity_tokens >= 1").distinct()
    known = [(r["capacity_id"], r["capacity_tokens"]) for r in wanted.collect()]  # a short list of settings
    each = items.withColumn("c", F.explode(F.array(*[F.struct(F.lit(i).cast("int").alias("capacity_id"), F.lit(c).cast("long").alias("capacity_tokens")) for i, c in known]) if known else F.expr("cast(array() as array<struct<capacity_id:int,capacity_tokens:bigint>>)")))
    each = each.select("c.capacity_id", "c.capacity_tokens", "group_no", "doc_id", "tokens")
    kind = dict(documents.dtypes)["doc_id"]
    return each.groupBy("capacity_id", "group_no").applyInPandas(_pack, f"capacity_id int, group_no int, container_no int, doc_id {kind}, piece_no int, tokens long")


def filling(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """Per capacity: containers, tokens, the share of room used, and the fewest containers that could hold the tokens."""
    used = packed.groupBy("capacity_id", "group_no", "container_no").agg(F.sum("tokens").alias("t")).groupBy("capacity_id").agg(F.count(F.lit(1)).alias("containers"), F.sum("t").alias("tokens"), F.max("t").alias("fullest"))
    return used.join(capacities.distinct(), "capacity_id").select(
        "capacity_id", "capacity_tokens", "containers", "tokens", "fullest",
        F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("share_used"), F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"),
    )
