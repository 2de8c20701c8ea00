"""Problem 7: documents of several sources, mixed to target shares of tokens.

Method: Efraimidis-Spirakis sampling. A source's budget is served by complete epochs first; what is left is drawn without replacement: each
document gets the exponential key -ln(u)/weight, u from the hash of mix and id, and documents are taken in the order of their keys as
long as the running sum of tokens stays within the budget. One more document, the one whose size is closest to the gap, closes it.

* Budgets: the total T of a mix is the tokens of all documents of its sources. A source can give at most ``max_repeats`` times its tokens.
  The budgets closest to the target shares in the least-squares sense under these limits are target + L, cut at the limits, with the
  one L for which they add up to T; so what a small or missing source cannot give is spread evenly.
* Prefix sums need no task that holds a source: keys are cut into slices of about ``SLICE`` documents (a monotone function of the key),
  the slices' sums are added up, and only the slice in which the budget ends is ordered document by document.
* Only totals by source and the budgets (one row per line of ``mix_targets``) are on the driver.

The weight of a document is the share of letters times the share of different words (kept between 0.05 and 1). Source names are compared
trimmed and in lower case; null sources belong to no mix. Null and empty texts have no tokens and the least weight. Ties of keys are
broken by the id. A source without documents gets nothing. No targets or no documents: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import staged

SLICE = 20_000
_KEY = ("mix_id", "source")


def budgets(total: float, targets: list[float], limits: list[float]) -> list[float]:
    """The amounts nearest to the targets' shares of the total that respect the limits and add up to it (as far as the limits allow)."""
    wanted = [t * total for t in targets]
    total = min(total, sum(limits))
    lo, hi = -total, total + max([0.0, *limits])
    for _ in range(200):
        mid = (lo + hi) / 2
        if sum(min(max(w + mid, 0.0), x) for w, x in zip(wanted, limits)) < total:
            lo = mid
        else:
            hi = mid
    return [min(max(w + hi, 0.0), x) for w, x in zip(wanted, limits)]


def weight(text: Column) -> Column:
    """A quality weight between 0.05 and 1."""
    words = F.split(F.lower(text), r"\s+")
    letters = F.try_divide(F.length(F.regexp_replace(text, r"[^\p{L}\p{M}]", "")), F.length(text))
    return F.coalesce(F.greatest(F.lit(0.05), F.least(F.lit(1.0), letters * F.try_divide(F.size(F.array_distinct(words)), F.size(words)))), F.lit(0.05))


def mix(documents: DataFrame, targets: DataFrame, slice_size: int = SLICE) -> DataFrame:
    """(mix_id, source, doc_id, times, tokens, target_share, reached_share): each document used, and how often."""
    spark = documents.sparkSession
    name = F.lower(F.trim("source"))
    lines = targets.select("mix_id", name.alias("source"), F.col("target_share").cast("double").alias("target_share"), F.greatest("max_repeats", F.lit(0)).alias("max_repeats"))
    lines = [r.asDict() for r in lines.where("mix_id is not null and source is not null").groupBy("mix_id", "source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).orderBy("mix_id", "source").collect()]
    named = sorted({x["source"] for x in lines})
    docs = documents.select("doc_id", name.alias("source"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("tokens"), weight(F.col("text")).alias("w")).where(F.col("source").isin(named))
    docs = staged(docs)  # a few numbers per document, so that the texts are read once
    sums = {r["source"]: (r["t"], r["n"]) for r in docs.groupBy("source").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    slices = max(8, -(-sum(n for _, n in sums.values()) // slice_size))

    for m in {x["mix_id"] for x in lines}:
        own = [x for x in lines if x["mix_id"] == m]
        have = [sums.get(x["source"], (0, 0))[0] or 0 for x in own]
        for x, h, b in zip(own, have, budgets(sum(have), [x["target_share"] or 0.0 for x in own], [h * (x["max_repeats"] or 0) for x, h in zip(own, have)])):
            x["have"], x["epochs"] = h, int(b // h) if h else 0
            x["left"] = round(b - x["epochs"] * h) if h and x["epochs"] < (x["max_repeats"] or 0) else 0
    kind = "mix_id string, source string, target_share double, epochs int, `left` long, have long"
    rows = [(x["mix_id"], x["source"], x["target_share"], x["epochs"], int(x["left"]), int(x["have"])) for x in lines]
    plan = spark.createDataFrame(rows, kind)

    u = (F.pmod(F.xxhash64("mix_id", "doc_id", F.lit(7)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    keyed = docs.join(F.broadcast(plan), "source").withColumn("key", -F.log(u) / F.col("w"))  # as many rows as mix_targets has lines
    keyed = keyed.withColumn("slice", F.floor((1 - F.exp(-F.col("key") / 4)) * slices).cast("int"))

    of_slice = keyed.where("`left` > 0").groupBy(*_KEY, "slice").agg(F.sum("tokens").alias("t"), F.first("left").alias("left"))
    upto = of_slice.withColumn("upto", F.sum("t").over(Window.partitionBy(*_KEY).orderBy("slice")))
    last = upto.where("upto > `left`").groupBy(*_KEY).agg(F.min("slice").alias("last"), F.min_by(F.col("upto") - F.col("t"), "slice").alias("before"))
    last = {(r["mix_id"], r["source"]): (r["last"], r["before"]) for r in last.collect()}  # a row per line of mix_targets at most
    ends = spark.createDataFrame([(x["mix_id"], x["source"], *last.get((x["mix_id"], x["source"]), (slices + 1, 0))) for x in lines], "mix_id string, source string, last int, before long")
    keyed = keyed.join(F.broadcast(ends), list(_KEY))

    inside = keyed.where("`left` > 0 and slice = last").withColumn("sum", F.col("before") + F.sum("tokens").over(Window.partitionBy(*_KEY).orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
    stop = inside.where("sum <= `left`").groupBy(*_KEY).agg(F.max(F.struct("key", "doc_id")).alias("stop"), F.max("sum").alias("sum"))
    stop = {(r["mix_id"], r["source"]): r for r in stop.collect()}  # likewise
    rows = []
    for x in lines:
        k = (x["mix_id"], x["source"])
        end = last.get(k)
        s = stop.get(k)
        taken = s["sum"] if s else end[1] if end else x["have"] if x["left"] else 0
        rows.append((*k, s["stop"]["key"] if s else None, s["stop"]["doc_id"] if s else None, int(x["left"] - taken) if x["left"] else 0, int(taken)))
    stops = spark.createDataFrame(rows, f"mix_id string, source string, stop_key double, stop_doc {dict(documents.dtypes)['doc_id']}, gap long, taken long")
    keyed = keyed.join(F.broadcast(stops), list(_KEY))
    drawn = (F.col("left") > 0) & ((F.col("slice") < F.col("last")) | ((F.col("slice") == F.col("last")) & F.col("stop_key").isNotNull() & (F.struct("key", "doc_id") <= F.struct(F.col("stop_key").alias("key"), F.col("stop_doc").alias("doc_id")))))
    keyed = keyed.withColumn("drawn", drawn)

    off = F.abs(F.col("tokens") - F.col("gap"))
    closing = keyed.where((F.col("left") > 0) & ~F.col("drawn") & (off < F.col("gap"))).groupBy(*_KEY).agg(F.min_by(F.struct("doc_id", "tokens"), F.struct(off, "key", "doc_id")).alias("extra"))
    closing = {(r["mix_id"], r["source"]): r["extra"] for r in closing.collect()}  # likewise
    used = {}
    for x, r in zip(lines, rows):
        e = closing.get((x["mix_id"], x["source"]))
        used[(x["mix_id"], x["source"])] = x["epochs"] * x["have"] + r[5] + (e["tokens"] if e else 0)
    total = {m: sum(v for (n, _), v in used.items() if n == m) for m in {x["mix_id"] for x in lines}}
    final = [(*k, closing[k]["doc_id"] if k in closing else None, v / total[k[0]] if total[k[0]] else 0.0) for k, v in used.items()]
    final = spark.createDataFrame(final, f"mix_id string, source string, extra {dict(documents.dtypes)['doc_id']}, reached_share double")
    times = (F.col("epochs") + F.when(F.col("drawn") | F.coalesce(F.col("doc_id") == F.col("extra"), F.lit(False)), 1).otherwise(0)).alias("times")
    return keyed.join(F.broadcast(final), list(_KEY)).select("mix_id", "source", "doc_id", times, "tokens", "target_share", "reached_share").where("times > 0")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Per line of the targets: tokens used, the share reached and the most often used document's times."""
    used = mixed.groupBy("mix_id", "source").agg(F.sum(F.col("tokens") * F.col("times")).alias("tokens"), F.max("times").alias("most_times"), F.count(F.lit(1)).alias("documents"))
    lines = targets.select("mix_id", F.lower(F.trim("source")).alias("source"), "target_share", "max_repeats")
    both = lines.join(used, ["mix_id", "source"], "left").na.fill(0, ["tokens", "most_times", "documents"])
    return both.withColumn("reached_share", F.round(F.try_divide("tokens", F.sum("tokens").over(Window.partitionBy("mix_id"))), 6))
