"""Frequencies of questions, exact duplicates, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import crop_norm, norm_key, strip
from .rank import first_per_group, global_rank


def of_crop(log: DataFrame, crop: str, column: str = "crop") -> DataFrame:
    """The rows of a crop; brackets and outer blanks do not count, case does, null never matches."""
    return log.where(crop_norm(column) == crop_norm(F.lit(crop)))


def frequency(log: DataFrame, column: str = "query_text") -> DataFrame:
    """(query_text, count): each text as it stands; null is left out."""
    return log.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("query_text")).count()


def frequency_trimmed(log: DataFrame, column: str = "query_text") -> DataFrame:
    """The same on stripped texts, blanks left out."""
    return frequency(log.select(strip(F.coalesce(column, F.lit(""))).alias("query_text")).where("query_text <> ''"))


def frequency_with_missing(log: DataFrame, column: str = "querytext") -> DataFrame:
    """The same with missing texts counted as one text 'nan'."""
    return log.groupBy(F.coalesce(column, F.lit("nan")).alias("query_text")).count()


def dedup(faq: DataFrame, question: str = "representative_question", freq: str = "raw_frequency", tie: str = "unique_q_id") -> DataFrame:
    """One row per normal form of the question: the most frequent one, ties by id. Frequencies are not summed."""
    keyed = faq.withColumn("_key", norm_key(question))
    return first_per_group(keyed, ["_key"], [-F.coalesce(freq, F.lit(0)), F.col(tie)]).drop("_key")


def ranked(faq: DataFrame, freq: str = "raw_frequency", tie: str = "unique_q_id") -> DataFrame:
    return global_rank(faq, [F.desc(freq), F.asc(tie)])


def duplicates(faq: DataFrame, question: str = "representative_question", freq: str = "raw_frequency") -> DataFrame:
    """All members of groups of exact duplicates; those that have the group's highest frequency are marked."""
    key = norm_key(question)
    groups = faq.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("group_size"), F.max(freq).alias("_top")).where("group_size > 1")
    return faq.withColumn("_key", key).join(groups, "_key").withColumn("keep", F.col(freq) == F.col("_top")).drop("_key", "_top")


def sample(freq: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly n texts (all if there are fewer), chosen by the MD5 of text and seed."""
    return freq.orderBy(F.md5(F.concat("query_text", F.lit(str(seed)))), "query_text").limit(n)


def most_frequent(freq: DataFrame, n: int) -> DataFrame:
    return freq.orderBy(F.desc("count"), "query_text").limit(n)


def unique_in_cluster(questions: DataFrame, cluster: str, question: str, order: list[str], cap: int | None = None) -> DataFrame:
    """Questions of each cluster in order, stripped, without repeated normal forms; position from 1, at most cap of them."""
    rows = questions.where(F.col(question).isNotNull()).select(cluster, strip(question).alias("question"), norm_key(question).alias("_key"), F.struct(*order).alias("_o"))
    once = first_per_group(rows, [cluster, "_key"], [F.col("_o"), F.col("question")])
    out = once.withColumn("position", F.row_number().over(Window.partitionBy(cluster).orderBy("_o", "question")))
    return (out.where(F.col("position") <= cap) if cap else out).drop("_key", "_o")
