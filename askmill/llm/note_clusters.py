"""Problem 5: clusters of notes on the same matter, with their true sizes and most typical notes.

Method: parallel pivot correlation clustering, all of it as tables.

1. *Core of a note.* Its content words: those whose distribution over the crops differs from that of all rows by more than chance explains,
   and that are in ``LEAST_SHARE`` of the rows or more (names of places, seed and products are too rare to differ surely; the words of the
   phrasing go with any crop). Counts cover all rows. Notes with the same core are one node, so nodes are few however many rows there are.
2. *Graph.* Nodes with a cosine of ``NEAR`` or more are neighbours. Pairs come from an inverted index on the words: a node is listed under its
   rarest words until the rest of its vector is too short for a neighbour, lists longer than ``BLOCK`` are cut into pairs of blocks, and
   a task multiplies the vectors of one list. Only neighbours leave a task.
3. *Pivots.* In rounds, every active node that comes before all its active neighbours in hash order is a local minimum and becomes a pivot;
   its active neighbours join their first pivot. Rounds go on until no node is active; as in the serial algorithm the pivots are the first
   maximal independent set of that order.
4. *Higher levels.* The clusters, as weighted sums of their nodes, are nodes again (heaviest first instead of hash order, neighbours from
   ``NEAR_AGAIN`` on, each joins its closest pivot), until their number does not fall any more: names of one trouble that never stand
   in one note meet through the signs they share.
5. *Reassignment.* Every node goes to its closest cluster; the clusters' sums, and with them the medoid (the node nearest to the sum), are
   computed anew, twice. Closeness is to the sum, not to the medoid, which as a single core holds only some of a matter's words.

Sizes that reach the driver: the content words (bounded by mean words of a note / ``LEAST_SHARE``), the crops (250) and one number a round.
Nodes, neighbours, clusters and their words stay tables; Spark broadcasts one only below its own size limit, and the rows of a core with
a thousandth of all rows are spread over several keys.

Nulls, blanks and notes without content words (garbled ones) are in no cluster. Repeated rows count each; an empty table gives no rows.
Columns besides those named are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut, staged

LEAST_SHARE = 1 / 5000
LEAST_SPREAD = 0.6
BLOCK = 2048
#: Similarity from which a node joins a pivot (first level, higher levels), and a note its closest cluster;
#: and from which an unmatched cluster goes with a matched one.
NEAR, NEAR_AGAIN, CLOSE = 0.45, 0.38, 0.35
AKIN = 0.25
CROP_WEIGHT = 0.6
#: Texts of one note: near duplicates make that many distinct texts count as one when a word's spread over the crops is judged.
ALIKE = 2.5
#: Over how many keys the rows of a hot core are spread, and the share of all rows that makes it hot.
SALTS, HOT = 64, 1 / 1000
_find = re.compile(r"[^\W_]+").findall


class Words:
    """The content words with their weights; some of them are crops."""

    def __init__(self, weights: dict[str, float], crops: frozenset[str]):
        self.weights = {w: v * (CROP_WEIGHT if w in crops else 1.0) for w, v in weights.items()}
        self.crops = crops

    def core(self, text: str | None) -> str:
        """The content words of a text, sorted; '' if there is none besides crops."""
        words = sorted({w for w in _find((text or "").lower()) if w in self.weights})
        return " ".join(words) if any(w not in self.crops for w in words) else ""

    def vector(self, core: str) -> tuple[list[str], list[float]]:
        """Words and weights of a core, of unit length."""
        words = core.split()
        x = np.array([self.weights[w] for w in words])
        return words, (x / max(float(np.linalg.norm(x)), 1e-12)).tolist()


def counted(notes: DataFrame, text: str = "query_text", key: str = "raw_row_id") -> DataFrame:
    """(text, n, first_key): the distinct notes with their numbers of rows, written to the shared folder as they are read several times."""
    least = [F.min(key).alias("first_key")] if key in notes.columns else []
    return staged(notes.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.count(F.lit(1)).alias("n"), *least))


def content_words(notes: DataFrame, texts: DataFrame, crop: str = "crop") -> Words:
    """Count words over all notes, and with the crop that the note names; keep those of content."""
    clean = F.regexp_replace(F.lower(F.coalesce(crop, F.lit(""))), r"[^\p{L}]+", " ")
    names = notes.groupBy(crop).count().select(F.explode(F.array_distinct(F.split(F.trim(clean), " "))).alias("w"), "count").where("length(w) > 3").groupBy("w").agg(F.sum("count").alias("n"))
    sums = texts.agg(F.sum("n").alias("rows")).crossJoin(notes.agg(F.count(F.lit(1)).alias("total"))).first()  # one row each
    total, all_ = sums["total"], sums["rows"] or 1
    crops = sorted({r["w"] for r in names.where(F.col("n") >= max(3, total * 0.004)).collect()} - {"others", "other", "crop", "none", "null"})  # at most 250 by the share asked for
    low = F.lower("text")
    first = F.regexp_extract(low, rf"(?<![\p{{L}}\p{{N}}])({'|'.join(crops)})(?![\p{{L}}\p{{N}}])", 1) if crops else F.lit("")
    named = texts.select(low.alias("t"), "n", first.alias("c"))
    base = named.groupBy("c").agg(F.sum("n").alias("b"))  # 251 rows at most
    words = named.select(F.explode(F.array_distinct(F.regexp_extract_all("t", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))).alias("w"), "c", "n")
    pairs = words.groupBy("w", "c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d")).join(F.broadcast(base), "c")
    each = pairs.groupBy("w").agg(F.sum("n").alias("total"), F.sum("d").alias("d"), F.sum(F.when(F.col("c") == "", F.col("n")).otherwise(0)).alias("bare"), F.sum(F.col("n") * F.log(F.col("n") / F.col("b"))).alias("x"))
    # how much the word's shares of the crops tell beside those of all rows
    spread = F.col("x") / F.col("total") - F.log("total") + F.lit(float(np.log(all_)))
    # a word seen in d distinct texts seems uneven by chance; the rows of one text count only where it names no crop (a request)
    seen = F.when(F.col("bare") >= 0.8 * F.col("total"), F.col("total")).otherwise(F.col("d") / ALIKE)
    kept = each.where((F.col("total") >= max(4.0, total * LEAST_SHARE)) & (spread - F.lit(len(crops) / 2) / seen >= LEAST_SPREAD) & (F.length("w") > 2) & ~F.col("w").rlike(r"^\p{N}+$"))
    weights = {r["w"]: float(r["x"]) for r in kept.select("w", F.log(F.lit(float(all_)) / F.col("total")).alias("x")).collect()}  # bounded: see the module's text
    return Words(weights, frozenset(c for c in crops if c in weights))


def cores(texts: DataFrame, words: Words) -> DataFrame:
    """(core, n, id, ws, xs): the distinct cores with their numbers of rows, a hash of the core, and the unit vector as words and weights."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pd.DataFrame({"core": [words.core(t) for t in pdf["text"]], "n": pdf["n"]})
            yield out[out["core"] != ""].groupby("core", as_index=False)["n"].sum()

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                both = [words.vector(c) for c in pdf["core"]]
                yield pdf.assign(ws=[b[0] for b in both], xs=[b[1] for b in both])

    nodes = texts.mapInPandas(of, "core string, n long").groupBy("core").agg(F.sum("n").alias("n")).withColumn("id", F.xxhash64("core"))
    return nodes.mapInPandas(vectors, "core string, n long, id long, ws array<string>, xs array<double>")


# --- graph and pivots ------------------------------------------------------------------------------------------------------------------


def neighbours(items: DataFrame, near: float, block: int = BLOCK) -> DataFrame:
    """(a, b, s), in both directions: the items (id, ws, xs; unit vectors) with a cosine of near or more."""
    flat = items.select("id", F.explode(F.arrays_zip(F.col("ws").alias("w"), F.col("xs").alias("x"))).alias("e")).select("id", "e.w", "e.x").withColumn("f", F.count(F.lit(1)).over(Window.partitionBy("w")))
    by = Window.partitionBy("id").orderBy("f", "w").rowsBetween(Window.unboundedPreceding, -1)
    # what is left of the vector from this word on must be able to give the similarity with a vector of unit length
    listed = flat.withColumn("left", 1 - F.coalesce(F.sum(F.col("x") * F.col("x")).over(by), F.lit(0.0))).where(F.col("left") >= near * near - 1e-9).select("w", "f", "id")
    b = F.ceil(F.col("f") / block)
    own = F.pmod(F.xxhash64("id"), b)
    lists = listed.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), b - 1))).select("w", "id", F.least(own, "o").alias("p"), F.greatest(own, "o").alias("q"))
    lists = lists.join(items.select("id", "ws", "xs"), "id")

    def of(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) < 2:
            return pd.DataFrame({"a": [], "b": [], "s": []}).astype({"a": "int64", "b": "int64", "s": "float64"})
        at: dict[str, int] = {}
        rows = np.repeat(np.arange(len(pdf)), [len(w) for w in pdf["ws"]])
        cols = np.array([at.setdefault(w, len(at)) for ws in pdf["ws"] for w in ws])
        ids = pdf["id"].to_numpy()
        m = np.zeros((len(pdf), len(at)), np.float32)  # a block pair of items by its own words
        m[rows, cols] = np.concatenate(pdf["xs"].to_numpy())
        i, j, v = [], [], []
        for k in range(0, len(m), 512):
            s = m[k : k + 512] @ m.T
            x, y = np.nonzero(s >= near - 1e-6)
            i.append(x + k)
            j.append(y)
            v.append(s[x, y])
        i, j, v = np.concatenate(i), np.concatenate(j), np.concatenate(v)
        ok = ids[i] != ids[j]
        return pd.DataFrame({"a": ids[i[ok]], "b": ids[j[ok]], "s": np.round(v[ok].astype(np.float64), 5)})

    return lists.groupBy("w", "p", "q").applyInPandas(of, "a long, b long, s double").groupBy("a", "b").agg(F.max("s").alias("s"))


def pivots(items: DataFrame, near: float, heaviest: bool = False) -> DataFrame:
    """(id, pivot): the items (id, weight, ws, xs) with their pivots, in rounds of local minima.

    The order is that of the hash ids or, with ``heaviest``, by falling weight; an item joins its first pivot, or its closest one.
    """
    order = F.struct((-F.round("weight", 6) if heaviest else F.lit(0.0)).alias("w"), F.col("id").alias("id"))
    state = cut(items.select("id", order.alias("o"), F.lit(None).cast("long").alias("pivot")))
    edges = neighbours(items, near).join(state.select(F.col("id").alias("a"), F.col("o").alias("oa")), "a").join(state.select(F.col("id").alias("b"), F.col("o").alias("ob")), "b")
    edges = staged(edges)
    while state.where("pivot is null").limit(1).count():  # one number a round
        later = edges.where("ob < oa").select(F.col("a").alias("id")).distinct()
        new = state.where("pivot is null").join(later, "id", "left_anti").select("id")  # before all its active neighbours
        best = F.max_by("b", F.struct("s", (-F.col("b")).alias("t"))) if heaviest else F.min_by("b", "ob")
        joined = edges.join(new.select(F.col("id").alias("b")), "b", "left_semi").groupBy(F.col("a").alias("id")).agg(best.alias("now"))
        now = joined.unionByName(new.select("id", F.col("id").alias("now")))
        state = cut(state.join(now, "id", "left").select("id", "o", F.coalesce("pivot", "now").alias("pivot")))
        gone = state.where("pivot is not null").select("id")
        edges = cut(edges.join(gone.withColumnRenamed("id", "a"), "a", "left_anti").join(gone.withColumnRenamed("id", "b"), "b", "left_anti"))
    return state.select("id", "pivot")


def summed_up(members: DataFrame) -> DataFrame:
    """(id, weight, ws, xs): the sums of the vectors of (k, weight, ws, xs), as unit vectors with their lengths as weights."""
    flat = members.select("k", "weight", F.explode(F.arrays_zip(F.col("ws").alias("w"), F.col("xs").alias("x"))).alias("e"))
    by = flat.groupBy("k", "e.w").agg(F.sum(F.col("weight") * F.col("e.x")).alias("v"))
    rows = by.groupBy("k").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("weight"), F.sort_array(F.collect_list(F.struct("w", "v"))).alias("e"))
    return rows.select(F.col("k").alias("id"), "weight", F.transform("e", lambda e: e["w"]).alias("ws"), F.transform("e", lambda e: e["v"] / F.col("weight")).alias("xs"))


def similarities(items: DataFrame, centres: DataFrame) -> DataFrame:
    """(id, k, s): the cosines of items and centres (id, ws, xs; unit vectors) that share a word."""
    one = items.select("id", F.explode(F.arrays_zip(F.col("ws").alias("w"), F.col("xs").alias("x"))).alias("e")).select("id", "e.w", "e.x")
    two = centres.select(F.col("id").alias("k"), F.explode(F.arrays_zip(F.col("ws").alias("w"), F.col("xs").alias("x"))).alias("e")).select("k", "e.w", F.col("e.x").alias("y"))
    return one.join(two, "w").groupBy("id", "k").agg(F.round(F.sum(F.col("x") * F.col("y")), 9).alias("s"))


def _closest(sims: DataFrame) -> DataFrame:
    """(id, k, s): the closest centre of each item, ties by the smaller k."""
    return sims.groupBy("id").agg(F.max(F.struct("s", (-F.col("k")).alias("t"))).alias("m")).select("id", (-F.col("m.t")).alias("k"), F.col("m.s").alias("s"))


def clusters(nodes: DataFrame) -> DataFrame:
    """(id, weight, ws, xs, medoid): the final clusters as unit vectors, with their most typical core."""
    items = nodes.select("id", F.col("n").cast("double").alias("weight"), "ws", "xs")
    found = pivots(items, NEAR)
    count = -1
    while True:
        sums = cut(summed_up(items.join(found, "id").select(F.col("pivot").alias("k"), "weight", "ws", "xs")))
        now = sums.count()
        if now in (0, 1, count):
            break
        items, count = sums, now
        found = pivots(items, NEAR_AGAIN, heaviest=True)
    for _ in range(2):
        close = _closest(similarities(nodes, sums)).where(F.col("s") >= CLOSE)
        home = cut(nodes.join(close, "id").select("id", "k", F.col("n").cast("double").alias("weight"), "ws", "xs", "core"))
        sums = cut(summed_up(home))
        near = home.join(sums.select(F.col("id").alias("k"), F.col("ws").alias("w2"), F.col("xs").alias("x2")), "k")
        dot = F.aggregate(F.zip_with("ws", "xs", lambda w, x: x * F.coalesce(F.try_element_at(F.map_from_arrays("w2", "x2"), w), F.lit(0.0))), F.lit(0.0), lambda a, b: a + b)
        medoid = near.groupBy("k").agg(F.max_by("core", F.struct(F.round(dot, 9), "weight", "core")).alias("medoid"))
        sums = cut(sums.join(medoid.withColumnRenamed("k", "id"), "id"))
    return sums


# --- representatives and rows ----------------------------------------------------------------------------------------------------------


def _reps(representatives: DataFrame, words: Words) -> DataFrame:
    """(id, rep, ws, xs): the cores of the representatives; id is that of the cluster on file and its text."""
    rows = representatives.select(F.col("cluster_id").cast("long").alias("rep"), "representative").where("rep is not null and representative is not null").distinct()

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [words.vector(words.core(t)) for t in pdf["representative"]]
            yield pdf.assign(ws=[m[0] for m in made], xs=[m[1] for m in made])

    made = rows.mapInPandas(of, "rep long, representative string, ws array<string>, xs array<double>").where("size(ws) > 0")
    return made.select(F.xxhash64("rep", "representative").alias("id"), "rep", "ws", "xs")


def places(nodes: DataFrame, centres: DataFrame, reps: DataFrame) -> DataFrame:
    """(id, cluster_no, cluster_id): the cluster of each node, and the id on file that it is matched with (null if none).

    A cluster holds the representatives whose closest cluster it is. One without any goes with the cluster that is akin to it, if that is
    plainly nearer than the next one, or with the representative that is near enough; a node of a cluster that is still unmatched
    goes with the closest matched one that is nearly as close. Of several representatives the closest to the node decides.
    """
    close = staged(similarities(reps, centres))
    home = _closest(close).where(F.col("s") >= CLOSE)
    own = cut(home.join(reps.select("id", "rep"), "id").select("k", F.col("id").alias("r"), "rep"))
    has = cut(own.select("k").distinct())
    bare = centres.select("id").join(has.withColumnRenamed("k", "id"), "id", "left_anti")
    between = similarities(centres.join(bare, "id", "left_semi"), centres).join(has, "k", "left_semi")
    top = between.groupBy("id").agg(F.slice(F.sort_array(F.collect_list(F.struct("s", (-F.col("k")).alias("t"))), False), 1, 2).alias("m"))  # matched clusters that share a word
    best = close.join(reps.select("id", "rep"), "id").groupBy(F.col("k").alias("id")).agg(F.max("s").alias("rs"), F.max_by(F.struct("id", "rep"), F.struct("s", (-F.col("rep")).alias("t"))).alias("r"))
    m = bare.join(top, "id", "left").join(best, "id", "left").select("id", F.coalesce("rs", F.lit(0.0)).alias("rs"), "r", F.col("m").getItem(0).alias("one"), F.try_element_at("m", F.lit(2)).alias("two"))
    akin = (F.col("one.s") >= F.greatest(F.lit(AKIN), F.col("rs"))) & (F.col("two").isNull() | (F.col("one.s") >= 1.5 * F.col("two.s")))
    m = cut(m.withColumn("via", F.when(akin, -F.col("one.t"))))
    by_akin = m.where("via is not null").select(F.col("id").alias("k2"), F.col("via").alias("k")).join(own, "k").select(F.col("k2").alias("k"), "r", "rep")
    by_rep = m.where(F.col("via").isNull() & (F.col("rs") >= CLOSE)).select(F.col("id").alias("k"), F.col("r.id").alias("r"), F.col("r.rep").alias("rep"))
    full = staged(own.unionByName(by_akin).unionByName(by_rep))  # (cluster, representative)
    sims = staged(similarities(nodes, centres).where(F.col("s") > 0))
    at = cut(_closest(sims).where(F.col("s") >= CLOSE))
    other = sims.join(full.select("k").distinct(), "k", "left_semi")
    other = _closest(other).select("id", F.col("k").alias("k2"), F.col("s").alias("s2"))
    matched = full.select("k", F.lit(True).alias("is_matched")).distinct()
    at = at.join(matched, "k", "left").join(other, "id", "left")
    use = F.when(F.col("is_matched"), F.col("k")).when(F.col("s2") >= F.greatest(F.lit(CLOSE), 0.6 * F.col("s")), F.col("k2"))
    at = cut(at.select("id", F.col("k").alias("cluster_no"), use.alias("k")))
    pairs = at.where("k is not null").join(full, "k").select("id", "r", "rep")
    single = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.min("rep").alias("rep"))
    several = pairs.join(single.where("c > 1").select("id"), "id", "left_semi")
    dots = similarities(nodes.join(several.select("id").distinct(), "id", "left_semi"), reps).withColumnRenamed("k", "r")
    chosen = several.join(dots, ["id", "r"], "left").groupBy("id").agg(F.max_by("rep", F.struct(F.coalesce("s", F.lit(0.0)), -F.col("rep"))).alias("best"))
    named = single.join(chosen, "id", "left").select("id", F.coalesce("best", "rep").alias("cluster_id"))
    return at.select("id", "cluster_no").join(named, "id", "left")


def fitted(notes: DataFrame, representatives: DataFrame) -> tuple[DataFrame, DataFrame, Words, DataFrame]:
    """(distinct texts, nodes, words, places of the nodes) for the notes of a log."""
    texts = counted(notes)
    words = content_words(notes, texts)
    nodes = staged(cores(texts, words))
    return texts, nodes, words, staged(places(nodes, clusters(nodes), _reps(representatives, words)))


def _core_ids(rows: DataFrame, words: Words, text: str) -> DataFrame:
    """Add id, the hash of the core of a text; rows without a core are left out."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            code, distinct = pd.factorize(pdf[text])
            found = np.array([words.core(t) for t in distinct], object)
            pdf = pdf.assign(_core=found[code] if len(distinct) else "")
            yield pdf[pdf["_core"] != ""]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.where(F.col(text).isNotNull()).mapInPandas(of, f"{schema}, _core string").withColumn("id", F.xxhash64("_core")).drop("_core")


def clustered(notes: DataFrame, representatives: DataFrame, key: str = "raw_row_id", text: str = "query_text") -> DataFrame:
    """(cluster_no, cluster_id, key): the cluster of each note and the id it is matched with (null if none)."""
    _, nodes, words, placed = fitted(notes, representatives)
    rows = _core_ids(notes.select(key, text), words, text).drop(text)
    total = nodes.agg(F.sum("n")).first()[0] or 0
    hot = F.col("n") >= max(1.0, total * HOT)
    known = nodes.where(hot).select("id", F.lit(True).alias("_hot"))  # 1 / HOT cores at most
    left = rows.join(F.broadcast(known), "id", "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(key), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))).drop("_hot")
    right = placed.join(nodes.select("id", "n"), "id").withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long"))))).drop("n")
    return left.join(right, ["id", "_salt"]).select("cluster_no", "cluster_id", key)


def summed(notes: DataFrame, representatives: DataFrame, most: int = 3, key: str = "raw_row_id", text: str = "query_text") -> DataFrame:
    """(cluster_id, cluster_no, size, notes): each matched id, and each cluster matched with none (cluster_no), with its number of rows and
    its ``most`` most typical distinct notes as (position, key, text).

    Typical is near to the middle of all the notes of the id, be they of several clusters; ties go by the smallest key of a note.
    """
    texts, nodes, words, placed = fitted(notes, representatives)
    group = F.when(F.col("cluster_id").isNull(), F.struct(F.lit(None).cast("long").alias("i"), F.col("cluster_no").alias("c"))).otherwise(F.struct(F.col("cluster_id").alias("i"), F.lit(None).cast("long").alias("c")))
    home = cut(nodes.join(placed, "id").select("id", F.xxhash64(group).alias("k"), group.alias("g"), F.col("n").cast("double").alias("weight"), "ws", "xs"))
    middles = summed_up(home)
    near = similarities(home, middles).join(home.select("id", "k", "g"), ["id", "k"]).select("id", "g", "s")
    each = _core_ids(texts.select("text", "n", "first_key"), words, "text").join(near, "id")
    each = staged(each.select("g", "n", "s", "first_key", "text"))
    sizes = each.groupBy("g").agg(F.sum("n").alias("size"))
    place = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("s"), "first_key"))
    first = each.withColumn("position", place).where(F.col("position") <= most)  # cut down on the map side
    named = F.sort_array(F.collect_list(F.struct(F.col("position").cast("int").alias("position"), F.col("first_key").alias(key), F.col("text").alias(text))))
    return sizes.join(first.groupBy("g").agg(named.alias("notes")), "g").select(F.col("g.i").alias("cluster_id"), F.col("g.c").alias("cluster_no"), "size", "notes")
