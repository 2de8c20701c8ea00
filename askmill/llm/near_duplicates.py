"""Problem 1: records that differ by small edits.

Two records are near duplicates if their sets of distinct words (runs of letters and digits, in any case) have a Jaccard similarity of
``SIMILARITY`` or more and they are not mere formatting copies of one another (problem 3).

Method: byte-position inverted index with count filtering.

1. *Signature.* The words of a record are hashed into ``POSITIONS`` positions; each position holds one byte, the sum of its words' hashes.
   Sets that differ in d words differ in at most d positions, so a pair of sizes a and b with the similarity wanted shares at least
   ``POSITIONS - (a+b)(1-s)/(1+s)`` positional bytes: the guaranteed minimum.
2. *Index.* Within the posting list of an index key, the shared positional bytes of each pair are tallied (vectorised) and only pairs with
   the guaranteed minimum are kept. Lists of single positional bytes, or of groups of them, hold a fixed share of all records, as texts of
   one phrasing agree in whole groups (figures in the README), so the keys are hashed words, chosen by the prefix filter: in an order
   common to all records (rarest words first) two records with the needed overlap share one of their first ``a - ceil(sa) + 1`` words, two
   of one more, three of two more. The key is the first shared word if its list is expected to hold ``RARE`` entries at most, else the first
   two if theirs is, else the first three; a record is listed under all that can be it. This rule is the same at any number of texts. The
   smaller record of a pair shares more of its words, so for it the first ``a - ceil(2sa/(1+s)) + 1`` do; only pairs with one such
   entry are looked at. Records of more than ``LARGE`` words would have too many triples; they, and those of up to a quarter fewer, which can
   be their partners, are listed under single words among themselves. Words go together more often than by
   chance, so a list can be longer than expected: the lists that hold more than ``BLOCK`` entries (counted for those whose rarest word is in
   more texts than that) are cut into blocks, and each pair of blocks is a list of its own, so no task holds or compares more.
3. *Verify.* The exact similarity is computed from the texts of the pairs left.

All filters are exact: no pair is lost, whatever the data. The only table sent to all tasks is the number of texts by hash of the word: it
has ``BUCKETS`` entries at most at any number of texts and words. (Words that share a hash count as one more frequent word, which changes
lists, not results.) Everything before the last step works on distinct word sets, so a text in a third of all rows is one entry; the
rows of hot texts are spread over several keys when the keys of records are listed.

Nulls and texts without a word are in no pair; texts of one or two words only pair with the same words in other order. Repeated rows of
one text are copies, not pairs. An empty table gives no rows. Columns besides those named are not looked at.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import partitions, staged
from .format_duplicates import digest, distinct_texts, encode, identifier, spread_join

SIMILARITY = 0.75
POSITIONS = 16
#: A key is extended by a further word if its list is expected to hold more texts than RARE; longer ones than BLOCK are cut into blocks.
RARE, BLOCK = 200, 32_768
LARGE = 96
#: Size of the table of numbers of texts by hash of the word.
BUCKETS = 1 << 20
_MIX = 0x9E3779B97F4A7C15
_OFTEN = np.uint64(1 << 63)


def frequent_words(texts: DataFrame, rare: int = RARE) -> tuple[dict[int, int], int]:
    """(hash of the word -> number of texts, for those of more than RARE; number of texts). At most BUCKETS entries."""
    words = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))).alias("word"))
    rows = words.groupBy(F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).alias("b")).count().where(F.col("count") > rare).collect()
    return {r["b"]: r["count"] for r in rows}, texts.count()


def _tokeniser(frequent: dict[int, int], similarity: float, total: int = 0, rare: int = RARE, block: int = BLOCK):
    import re

    import xxhash

    find = re.compile(r"[^\W_]+").findall

    def order(word: str) -> tuple[int, int]:
        """(place, hash): rare words first, by hash; then by number of texts (31 bits at most), ties by hash."""
        h = xxhash.xxh64_intdigest(word, 42)
        n = frequent.get(h % BUCKETS)
        return h >> 1 if n is None else (1 << 63) | min(n, (1 << 31) - 1) << 32 | h >> 32, h

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple[int, int]] = {}
        salts: dict[str, int] = {}
        for pdf in batches:
            if len(known) > 500_000:
                known.clear()
            flat, sizes, nodes = array("Q"), [], []
            for table, text in zip(pdf["table_name"], pdf["text"]):
                mine = []
                for w in set(find(text.lower())):
                    o = known.get(w)
                    if o is None:
                        o = known[w] = order(w)
                    mine.append(o)
                mine.sort()
                if table not in salts:
                    salts[table] = xxhash.xxh64_intdigest(table)
                sizes.append(len(mine))
                flat.extend(o for o, _ in mine)
                nodes.append(xxhash.xxh3_64_intdigest(array("Q", [h for _, h in mine]).tobytes(), salts[table]))
            size, orders = np.array(sizes, np.int64), np.array(flat, np.uint64)
            row = np.repeat(np.arange(len(size)), size)
            h = orders * np.uint64(_MIX)
            sig = np.zeros((len(sizes), POSITIONS), np.uint8)
            np.add.at(sig, (row, ((h >> np.uint64(40)) % np.uint64(POSITIONS)).astype(np.int64)), (h >> np.uint64(52)).astype(np.uint8) | np.uint8(1))
            two = sig.view(np.int64)
            salt = np.array([salts[t] for t in pdf["table_name"]], np.uint64)
            yield pdf.assign(node=np.array(nodes, np.uint64).view(np.int64), words=size.astype(np.int32), sig_a=two[:, 0], sig_b=two[:, 1], keys=_keys(orders, size, salt, similarity, total, rare, block))

    return of


def _keys(orders: np.ndarray, size: np.ndarray, salt: np.ndarray, similarity: float, total: int, rare: int, block: int) -> list[np.ndarray]:
    """The index keys of records whose words have these (within a record ascending) places in the common order.

    The lowest bit of a key tells whether the record may be the smaller one of a pair under it, the next one whether its list may hold more
    than BLOCK entries.
    """
    if similarity <= 2 / 3:
        raise ValueError("a similarity of more than 2/3 is needed: pairs must share three words")
    if not len(size):
        return []
    start = np.cumsum(size) - size
    first = np.where(size < 3, 0, size - np.ceil(similarity * size - 1e-9).astype(np.int64) + 1)
    short = size - np.ceil(2 * similarity / (1 + similarity) * size - 1e-9).astype(np.int64) + 1
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(orders)) - np.repeat(start, size)
    often = orders >= _OFTEN
    share = np.where(often, ((orders >> np.uint64(32)) & np.uint64((1 << 31) - 1)).astype(np.float64), 1.0) / max(total, 1)
    mix = np.uint64(_MIX)
    rows, keys, small, hold = [], [], [], []  # hold: the list has no more entries than that

    def add(r, k, is_small, most):
        rows.append(r)
        keys.append(k ^ salt[r])
        small.append(is_small)
        hold.append(np.broadcast_to(most, r.shape))

    single = (place < first[row]) & ~often
    add(row[single], orders[single], place[single] < short[row[single]], 1.0)
    large = (place < first[row]) & (size[row] > LARGE * similarity)  # see the module's text
    add(row[large], orders[large] * mix + np.uint64(1), place[large] < short[row[large]], share[large] * total)
    last = np.where(first > 0, np.minimum(first + 2, size), 0)
    window = (place < last[row]) & often
    m = np.where(size > LARGE, 0, np.bincount(row[window], minlength=len(size)))
    for n in np.unique(m[m > 2]):  # of fewer the first cannot be the first shared word
        at = np.flatnonzero(m == n)
        from_ = last[at] - n  # the frequent words are the last ones of the window
        where = (start[at] + from_)[:, None] + np.arange(n)
        tail, p = orders[where], share[where]
        i, j = np.triu_indices(n, 1)
        both = p[:, i] * p[:, j] * total
        r, c = np.nonzero((both <= rare) & (from_[:, None] + j < first[at][:, None] + 1))
        add(at[r], (tail[r, i[c]] * mix + tail[r, j[c]]) * mix, from_[r] + j[c] < short[at[r]] + 1, p[r, i[c]] * total)
        i, j, k = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3).T
        r, c = np.nonzero(p[:, i] * p[:, j] * total > rare)
        add(at[r], ((tail[r, i[c]] * mix + tail[r, j[c]]) * mix + tail[r, k[c]]) * mix, from_[r] + k[c] < short[at[r]] + 2, p[r, i[c]] * total)
    row, key, small, hold = (np.concatenate(x) for x in (rows, keys, small, hold))
    key = ((key & ~np.uint64(3)) | small.astype(np.uint64) | (hold > block).astype(np.uint64) << np.uint64(1)).view(np.int64)
    order = np.argsort(row, kind="stable")
    return np.split(key[order], np.cumsum(np.bincount(row, minlength=len(size)))[:-1])


_LOW, _HIGH = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def _equal_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight bytes of each number are 0."""
    return np.bitwise_count(~(((x & _LOW) + _LOW) | x) & _HIGH)


def _tally(similarity: float):
    """Pairs of one posting list that share the guaranteed number of positional bytes. Input: sorted by key and, falling, small."""
    apart = (1 - similarity) / (1 + similarity)

    def pairs(a: dict[str, np.ndarray]) -> pd.DataFrame:
        key, node, words, small, one, two = a["key"], a["node"], a["words"], a["small"], a["sig_a"].view(np.uint64), a["sig_b"].view(np.uint64)
        left, right = [], []
        i, k = np.flatnonzero(small[:-1]), 1  # those that may be the smaller one come first in each list
        while len(i):
            i = i[i + k < len(key)]
            i = i[key[i] == key[i + k]]
            for at in range(0, len(i), 1 << 18):
                x = i[at : at + (1 << 18)]
                y = x + k
                same = _equal_bytes(one[x] ^ one[y]) + _equal_bytes(two[x] ^ two[y])
                both = words[x] + words[y]
                ok = (same >= POSITIONS - np.floor(both * apart + 1e-9)) & (np.minimum(words[x], words[y]) >= similarity * np.maximum(words[x], words[y]) - 1e-9) & (node[x] != node[y]) & (small[y] | (words[x] <= words[y]))
                left.append(node[x[ok]])
                right.append(node[y[ok]])
            k += 1
        l, r = (np.concatenate(z) if z else np.zeros(0, np.int64) for z in (left, right))
        return pd.DataFrame({"node_a": np.minimum(l, r), "node_b": np.maximum(l, r)}).drop_duplicates()

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: dict[str, np.ndarray] | None = None
        for pdf in batches:
            now = {c: pdf[c].to_numpy() for c in pdf.columns}
            if rest is not None:
                now = {c: np.concatenate([rest[c], now[c]]) for c in now}
            cut = int(np.searchsorted(now["key"], now["key"][-1]))  # the last list may go on
            rest = {c: v[cut:] for c, v in now.items()}
            if cut:
                yield pairs({c: v[:cut] for c, v in now.items()})
        if rest is not None:
            yield pairs(rest)

    return of


@F.pandas_udf(T.DoubleType())
def jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
    """Exact similarity of the word sets of two texts."""
    import re

    find = re.compile(r"[^\W_]+").findall
    out = []
    for x, y in zip(a, b):
        p, q = set(find(x.lower())), set(find(y.lower()))
        k = len(p & q)
        out.append(k / (len(p) + len(q) - k) if p or q else 0.0)
    return pd.Series(out, dtype="float64")


def index(records: DataFrame, similarity: float = SIMILARITY, rare: int = RARE, block: int = BLOCK) -> DataFrame:
    """Each distinct text of (table_name, key, text) with its word set (``node``), signature and keys; written to the shared folder."""
    texts = staged(distinct_texts(records).select("table_name", "text", "n"))  # read three times, shuffled once
    frequent, total = frequent_words(texts, rare)
    spec = "table_name string, text string, n long, node long, words int, sig_a long, sig_b long, keys array<long>"
    return staged(texts.mapInPandas(_tokeniser(frequent, similarity, total, rare, block), spec))


def _posted(indexed: DataFrame, block: int = BLOCK) -> DataFrame:
    """(key, small, node, words, sig_a, sig_b): the entries of all posting lists, long lists cut into pairs of blocks."""
    k = F.col("k")
    all_ = indexed.select(F.explode("keys").alias("k"), "node", "words", "sig_a", "sig_b").select(
        F.shiftright(k, 2).alias("key"), (k.bitwiseAND(1) != 0).alias("small"), (k.bitwiseAND(2) != 0).alias("_may"), "node", "words", "sig_a", "sig_b")
    may = all_.where("_may").drop("_may")
    long_ = may.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select("key", F.ceil(F.col("n") / block).alias("b"))
    own = F.pmod(F.xxhash64("node"), F.col("b"))
    other = F.explode(F.when(F.col("b").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("b") - 1)))
    cut = may.join(long_, "key", "left").withColumn("_o", other)
    cut = cut.withColumn("key", F.when(F.col("b").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.least(own, "_o"), F.greatest(own, "_o")))).drop("b", "_o")
    return all_.where("not _may").drop("_may").unionByName(cut)


def lists(indexed: DataFrame) -> DataFrame:
    """One row: (texts, entries, longest, compared): distinct texts, entries of all posting lists, the longest list, pairs compared at most."""
    each = _posted(indexed).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if("small").alias("s"))
    return each.agg(F.sum("n").alias("entries"), F.max("n").alias("longest"), F.sum(F.col("s") * (F.col("n") - 1)).alias("compared")).crossJoin(indexed.agg(F.count(F.lit(1)).alias("texts")))  # one row each


def node_pairs(indexed: DataFrame, similarity: float = SIMILARITY, block: int = BLOCK) -> DataFrame:
    """(node_a, node_b, similarity), node_a < node_b: all pairs of different word sets that are similar."""
    spark = indexed.sparkSession
    ordered = _posted(indexed, block).repartition(max(partitions(spark), 24), "key").sortWithinPartitions("key", F.desc("small"))
    found = ordered.mapInPandas(_tally(similarity), "node_a long, node_b long").distinct()
    text = indexed.groupBy("node").agg(F.min("text").alias("text"))
    both = found.join(text.select(F.col("node").alias("node_a"), F.col("text").alias("text_a")), "node_a").join(
        text.select(F.col("node").alias("node_b"), F.col("text").alias("text_b")), "node_b"
    )
    return both.withColumn("similarity", jaccard("text_a", "text_b")).where(F.col("similarity") >= similarity - 1e-9).select("node_a", "node_b", "similarity")


def pairs(records: DataFrame, similarity: float = SIMILARITY, rare: int = RARE, block: int = BLOCK) -> DataFrame:
    """(table_name, key_a, key_b), key_a < key_b: all pairs of near-duplicate records."""
    indexed = index(records, similarity, rare, block)
    near = node_pairs(indexed, similarity, block).select("node_a", "node_b")
    # one word set in several texts: other order of the same words, unless they are copies
    turned = indexed.groupBy("node").count().where("count > 1").select(F.col("node").alias("node_a"), F.col("node").alias("node_b"))
    near = staged(near.unionByName(turned))
    wanted = near.select(F.explode(F.array("node_a", "node_b")).alias("node")).distinct()
    texts = indexed.select("table_name", "text", "n", "node").join(wanted, "node", "left_semi")
    texts = staged(encode(texts).select("table_name", "node", "n", identifier(F.col("tuple")).alias("canon"), digest(F.col("text")).alias("_digest")))
    several = texts.groupBy("node").agg(F.min("canon").alias("lo"), F.max("canon").alias("hi")).where("lo <> hi").select(F.col("node").alias("node_a"))
    near = near.where("node_a <> node_b").unionByName(near.where("node_a = node_b").join(several, "node_a", "left_semi"))
    rows = records.select("table_name", "key", digest(F.col("text")).alias("_digest"))
    rows = staged(spread_join(rows, texts, indexed.agg(F.sum("n")).first()[0] or 0, "key"))  # read from either side
    a = rows.select("table_name", F.col("node").alias("node_a"), F.col("canon").alias("canon_a"), F.col("key").alias("_a"))
    b = rows.select(F.col("node").alias("node_b"), F.col("canon").alias("canon_b"), F.col("key").alias("_b"))
    out = near.join(a, "node_a").join(b, "node_b").where("canon_a <> canon_b and (node_a <> node_b or _a < _b)")
    return out.select("table_name", F.least("_a", "_b").alias("key_a"), F.greatest("_a", "_b").alias("key_b"))
