"""The queries of the training-data problems: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import answer_defects, format_duplicates, language, mixing, near_duplicates, note_clusters, packing, pii
from ._common import read, records


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.pairs(records(spark, sf_dir))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = read(spark, sf_dir, "unique_questions_freq_qa").select("unique_q_id", F.col("representative_question").alias("question"), "category", "answer")
    return answer_defects.defects(pairs)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_duplicates.copies(records(spark, sf_dir))


def p3_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question once: its smallest key, its number of records and of spellings."""
    return format_duplicates.sets(records(spark, sf_dir)).select("table_name", "kept_key", "copies", "spellings")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "raw_log")
    return language.mislabelled(rows, language.trained(spark, sf_dir)).select("raw_row_id", "segment_no", "lang")


def p4_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's segments with their confidence."""
    rows = read(spark, sf_dir, "raw_log")
    return language.segments(rows, language.trained(spark, sf_dir), "raw_row_id", "querytext").select("raw_row_id", "segment_no", "lang", F.round("confidence", 6).alias("confidence"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = note_clusters.clustered(read(spark, sf_dir, "raw_log"), read(spark, sf_dir, "repaired_clusters"))
    return rows.where("cluster_id is not null").select("cluster_id", "raw_row_id")


def p5_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each cluster with its true size, the size on file and its three most typical notes (ties by row id), the first of them as medoid."""
    files = read(spark, sf_dir, "repaired_clusters")
    stale = files.groupBy("cluster_id").agg(F.max("size").alias("size_on_file"))
    rows = note_clusters.summed(read(spark, sf_dir, "raw_log"), files)
    first = F.element_at("notes", 1)
    return rows.join(stale, "cluster_id", "left").withColumns({"medoid_row_id": first["raw_row_id"], "medoid": first["query_text"]})


def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), read(spark, sf_dir, "pack_capacities"))


def p6_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    capacities = read(spark, sf_dir, "pack_capacities")
    return packing.filling(packing.pack(read(spark, sf_dir, "documents"), capacities), capacities)


def p7_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"), read(spark, sf_dir, "mix_targets"))


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = read(spark, sf_dir, "mix_targets")
    return mixing.shares(mixing.mix(read(spark, sf_dir, "documents"), targets), targets)


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return pii.found(documents, pii.trained(), pii.common_words(documents))


def p8_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with placeholders, and their number."""
    documents = read(spark, sf_dir, "documents")
    return pii.details(documents, pii.trained(), pii.common_words(documents)).select("doc_id", F.col("redacted").alias("text"), F.size("kinds").alias("n_found"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p2_found, p3_found, p3_sets, p4_found, p4_segments, p5_found, p5_clusters, p6_containers, p6_filling, p7_mixed, p7_shares, p8_found, p8_redacted)
}

_BARE = "regexp_replace({0}, '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_FIELDS = f"""with r as (select 'raw_log' as table_name, raw_row_id::varchar as k, query_text as x from raw_log union all select 'unique_questions_freq', unique_q_id, representative_question from unique_questions_freq),
    p as (select table_name, k, x, string_split(regexp_replace(lower(x), '(?:^|[|,;/\\n\\r])[^\\p{{L}}\\p{{N}}]*({"|".join(format_duplicates.LABELS)})\\s*\\p{{Z}}*[:=\\-–>]', chr(1) || '\\1' || chr(1), 'g'), chr(1)) as parts from r
        where k is not null and x is not null and regexp_matches(x, '[\\p{{L}}\\p{{N}}]')),
    f as (select table_name, k, x, case when len(parts) >= 7 and {_BARE.format('parts[1]')} = '' then list_sort(list_transform(range(1, (len(parts) - 1) // 2 + 1), lambda i: parts[2 * i] || '=' || {_BARE.format('parts[2 * i + 1]')})) else [{_BARE.format('lower(x)')}] end as fields from p),
    s as (select table_name, fields, min(k) as kept_key, count(*)::bigint as copies, count(distinct x)::bigint as spellings from f group by 1, 2)"""

#: Queries that DuckDB can answer as well.
SQL: dict[str, str] = {
    "p3_found": f"{_FIELDS} select table_name, kept_key, k as copy_key from f join s using (table_name, fields) where spellings > 1 and k <> kept_key",
    "p3_sets": f"{_FIELDS} select table_name, kept_key, copies, spellings from s",
}
