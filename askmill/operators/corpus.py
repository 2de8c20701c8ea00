"""Removal of questions by keywords."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import edge_tokens

#: Most keywords that are written into the plan; a longer list is joined.
INLINE = 5_000
COLUMNS = ("representative_question", "cluster_label", "answer_label")


def split_terms(terms: DataFrame, most: int = INLINE) -> tuple[list[str], list[str]] | None:
    """(phrases, words) of a keyword table; None if there are more than ``most``."""
    rows = terms.select("term", "is_phrase").limit(most + 1).collect()
    if len(rows) > most:
        return None
    return sorted(r["term"] for r in rows if r["is_phrase"]), sorted(r["term"] for r in rows if not r["is_phrase"])


def texts_with_terms(texts: DataFrame, terms: DataFrame, least: int = 3) -> DataFrame:
    """The distinct texts (column text) that hold a keyword, by joins: words meet tokens, phrases meet the places in a text where their first
    three signs stand."""
    one = texts.select("text").where("text is not null").distinct()
    words = terms.where("not is_phrase").select("term").distinct()
    by_word = one.select("text", F.explode(F.array_distinct(edge_tokens("text"))).alias("term")).where(F.length("term") >= least).join(words, "term", "left_semi").select("text")
    phrases = terms.where("is_phrase and length(term) >= 3").select("term", F.substring("term", 1, 3).alias("head")).distinct()
    low = F.lower("text")
    places = one.where(F.length("text") >= 3).select("text", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("text") - 2), lambda i: F.substr(low, i, F.lit(3))))).alias("head"))
    by_phrase = places.join(phrases, "head").where(low.contains(F.col("term"))).select("text")
    return by_word.unionByName(by_phrase).distinct()


def irrelevant(question: Column, phrases: list[str], words: list[str], least: int = 3, near: DataFrame | None = None) -> Column:
    """Does a question hold one of the phrases anywhere, or one of the words as a token of the least length? Null is False."""
    low = F.lower(question)
    hit = F.lit(False)
    if phrases:
        hit = hit | F.exists(F.array(*[F.lit(p) for p in phrases]), lambda p: low.contains(p))
    if words:
        long = F.filter(edge_tokens(question), lambda t: F.length(t) >= least)
        hit = hit | F.arrays_overlap(long, F.array(*[F.lit(w) for w in words]))
    return F.coalesce(hit, F.lit(False))


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * LCS / (len a + len b)."""
    if not a and not b:
        return 100.0
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return 200.0 * row[-1] / (len(a) + len(b))


def near_tokens(tokens: DataFrame, words: list[str], threshold: float, least: int = 3) -> DataFrame:
    """The distinct tokens (column token) that are near enough to a keyword whose length differs by 2 at most.

    Tokens meet the words in a join on the length. The Levenshtein distance (in the JVM, with a bound) is never above the Indel distance, and
    the ratio asks for an Indel distance of (1 - threshold / 100) times both lengths at most, so only pairs within that bound are
    compared further.
    """
    spark = tokens.sparkSession
    known = spark.createDataFrame([(w, len(w)) for w in sorted(set(words))], "word string, n int")  # INLINE words at most

    one = tokens.where(F.length("token") >= least).select("token").distinct()
    pairs = one.select("token", F.explode(F.sequence(F.length("token") - 2, F.length("token") + 2)).alias("n")).join(F.broadcast(known), "n")
    bound = F.floor((F.length("token") + F.col("n")) * (100 - threshold) / 100 + 1e-9).cast("int")
    most = max([len(w) for w in words] or [0]) * 2 + 2
    pairs = pairs.withColumn("d", F.levenshtein("token", "word", int(most * (100 - threshold) / 100) + 1)).where((F.col("d") >= 0) & (F.col("d") <= bound))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keep = [indel_ratio(t, w) >= threshold - 1e-9 for t, w in zip(pdf["token"], pdf["word"])]
            yield pdf[pd.Series(keep, index=pdf.index, dtype=bool)][["token"]]

    return pairs.select("token", "word").mapInPandas(of, "token string").distinct()


def mark(faq: DataFrame, terms: DataFrame, least: int = 3, threshold: float = 100.0, columns: tuple[str, ...] = COLUMNS, inline: int = INLINE) -> DataFrame:
    """Add ``irrelevant``: one of the columns that are there holds a keyword, or (below a threshold of 100) a word like one."""
    there = [c for c in columns if c in faq.columns]
    if not there:
        raise ValueError(f"none of {', '.join(columns)} is a column")
    split = split_terms(terms, inline)
    if split is None:
        if threshold < 100:
            raise ValueError(f"words like a keyword are looked for with up to {inline} keywords only")
        out = faq.withColumn("irrelevant", F.lit(False))
        found = texts_with_terms(faq.select(F.explode(F.array(*there)).alias("text")), terms, least)
        for c in there:
            out = out.join(found.select(F.col("text").alias(c), F.lit(True).alias("_hit")), c, "left").withColumn("irrelevant", F.col("irrelevant") | F.coalesce("_hit", F.lit(False))).drop("_hit")
        return out.select(*faq.columns, "irrelevant")
    phrases, words = split
    hit = F.lit(False)
    for c in there:
        hit = hit | irrelevant(F.col(c), phrases, words, least)
    if threshold >= 100 or not words:
        return faq.withColumn("irrelevant", hit)
    tokens = faq.select(F.explode(F.array_distinct(F.flatten(F.array(*[F.coalesce(edge_tokens(c), F.array().cast("array<string>")) for c in there])))).alias("token"))
    near = near_tokens(tokens, words, threshold, least)
    rows = faq.withColumn("_row", F.struct(*[F.col(c) for c in there]))
    exploded = rows.select("_row").distinct().select("_row", F.explode(F.array_distinct(F.flatten(F.array(*[F.coalesce(edge_tokens(F.col(f"_row.{c}")), F.array().cast("array<string>")) for c in there])))).alias("token"))
    found = exploded.join(near, "token", "left_semi").select("_row").distinct().withColumn("_near", F.lit(True))
    joined = rows.join(found, rows["_row"].eqNullSafe(found["_row"]), "left").drop("_row")
    return joined.withColumn("irrelevant", hit | F.coalesce("_near", F.lit(False))).drop("_near")


def filtered(faq: DataFrame, terms: DataFrame, least: int = 3, threshold: float = 100.0) -> tuple[DataFrame, DataFrame]:
    """(kept, removed)."""
    marked = mark(faq, terms, least, threshold)
    return marked.where(~F.col("irrelevant")).drop("irrelevant"), marked.where("irrelevant").drop("irrelevant")
