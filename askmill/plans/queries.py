"""Named queries over whole tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import replies, text
from ..operators import cluster, corpus, density, evaluate, freq, qa, rank, repair, similarity, tfidf, unique
from ..operators.models import Echo, SameLetter
from ..sources import io

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: White space at the ends, in the two engines' notations.
_WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
CROP = "Maize"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')"


def _key(c: str) -> str:
    return f"lower({_strip(c)})"


def _crop(c: str) -> str:
    return _strip(f"regexp_replace({c}, '[()]', '', 'g')")


_STOP = ", ".join(f"'{w}'" for w in sorted(text.STOP_WORDS))


def _clean(c: str) -> str:
    return f"array_to_string(list_filter(string_split(trim(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[^a-z\\s]', ' ', 'g'), '\\s+', ' ', 'g')), ' '), lambda w: w not in ({_STOP})), ' ')"


def _tokens(c: str) -> str:
    return f"regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9_]{{2,}}')"


_EDGE = r"[.,!?;:()\[\]{}\"'']+"


def _edge_tokens(c: str) -> str:
    return f"list_transform(string_split_regex({_key(c)}, '{_WS}+'), lambda t: regexp_replace(t, '^{_EDGE}|{_EDGE}$', '', 'g'))"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _terms(spark: SparkSession, d: str) -> DataFrame:
    return io.terms(_t(spark, d, "irrelevant_corpus"))


def _faq(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "unique_questions_freq")


_TERMS = f"terms as (select distinct {_key('term')} as term from irrelevant_corpus where {_key('term')} <> '')"


def _irrelevant(c: str) -> str:
    return f"""coalesce(list_bool_or([contains(lower({c}), p) for p in (select coalesce(list(term), []) from terms where contains(term, ' '))]), false)
        or coalesce(list_has_any(list_filter({_edge_tokens(c)}, lambda t: length(t) >= 3), (select coalesce(list(term), []) from terms where not contains(term, ' '))), false)"""


# --- frequencies -------------------------------------------------------------------------------------------------------------------


@query(f"""with {_TERMS}, f as (select query_text, count(*) as c from raw_log where {_crop('crop')} = '{CROP}' and query_text is not null group by 1),
    d as (select *, row_number() over (partition by {_key('query_text')} order by c desc, query_text) as r from f),
    k as (select query_text, c from d where r = 1 and not ({_irrelevant('query_text')}))
    select query_text, c::bigint as count, row_number() over (order by c desc, query_text)::bigint as rank, round(c * 100.0::double / sum(c) over (), 2) as pct from k""")
def faq_slice(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: questions of one crop, exact duplicates and off-topic ones removed, ranked by frequency."""
    f = freq.frequency(freq.of_crop(_t(spark, d, "raw_log"), CROP))
    once = freq.dedup(f, "query_text", "count", "query_text").withColumnRenamed("query_text", "representative_question")
    kept, _ = corpus.filtered(once, _terms(spark, d))
    kept = kept.withColumnRenamed("representative_question", "query_text")
    ranked = freq.ranked(kept, "count", "query_text")  # on a checkpoint, from which the total is read as well
    out = ranked.crossJoin(F.broadcast(ranked.agg(F.sum("count").alias("_total"))))  # one row
    return out.select("query_text", "count", "rank", F.round(F.col("count") * 100.0 / F.col("_total"), 2).alias("pct"))


@query("select query_text, count(*)::bigint as count from raw_log where query_text is not null group by 1")
def freq_table(spark, d):
    return freq.frequency(_t(spark, d, "raw_log"))


@query(f"select {_strip('query_text')} as query_text, count(*)::bigint as count from raw_log where {_strip('query_text')} <> '' group by 1")
def freq_trimmed(spark, d):
    return freq.frequency_trimmed(_t(spark, d, "raw_log"))


@query("select coalesce(querytext, 'nan') as query_text, count(*)::bigint as count from raw_log group by 1")
def freq_with_missing(spark, d):
    return freq.frequency_with_missing(_t(spark, d, "raw_log"))


@query(f"select raw_row_id, crop from raw_log where {_crop('crop')} = '{CROP}'")
def crop_filter(spark, d):
    return freq.of_crop(_t(spark, d, "raw_log"), CROP).select("raw_row_id", "crop")


@query(f"select raw_row_id from raw_log where crop = '{CROP}'")
def crop_filter_exact(spark, d):
    return _t(spark, d, "raw_log").where(F.col("crop") == CROP).select("raw_row_id")


@query("select distinct crop, regexp_replace(regexp_replace(lower(crop), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug from raw_log where crop is not null")
def crop_slugs(spark, d):
    return _t(spark, d, "raw_log").where("crop is not null").select("crop", text.slug("crop").alias("slug")).distinct()


@query("select raw_row_id, (row_number() over (order by raw_row_id) - 1)::bigint as row_no from raw_log")
def row_numbers(spark, d):
    return io.with_row_id(_t(spark, d, "raw_log").select("raw_row_id"), ["raw_row_id"], "row_no")


@query(f"select query_text, cleaned from (select distinct query_text, {_clean('query_text')} as cleaned from raw_log) where cleaned <> ''")
def text_clean(spark, d):
    """Each distinct text is cleaned once: the condition names the count, so it cannot be pushed below the aggregation to all rows."""
    f = _t(spark, d, "raw_log").groupBy("query_text").count().withColumn("cleaned", text.clean("query_text"))
    return f.where(F.when(F.col("count") > 0, F.col("cleaned")) != "").select("query_text", "cleaned")


# --- duplicates, ranks, samples ----------------------------------------------------------------------------------------------------


@query(f"""select unique_q_id, representative_question, raw_frequency, row_number() over (order by raw_frequency desc, unique_q_id)::bigint as rank
    from (select *, row_number() over (partition by {_key('representative_question')} order by raw_frequency desc, unique_q_id) as r from unique_questions_freq) where r = 1""")
def exact_dedup(spark, d):
    return freq.ranked(freq.dedup(_faq(spark, d))).select("unique_q_id", "representative_question", "raw_frequency", "rank")


@query(f"""select unique_q_id, n::bigint as group_size, raw_frequency = top as keep from (select unique_q_id, raw_frequency, count(*) over w as n, max(raw_frequency) over w as top
    from unique_questions_freq window w as (partition by {_key('representative_question')})) where n > 1""")
def duplicate_report(spark, d):
    return freq.duplicates(_faq(spark, d)).select("unique_q_id", "group_size", "keep")


@query(f"select count(*)::bigint as groups from (select 1 from unique_questions_freq group by {_key('representative_question')} having count(*) > 1)")
def duplicate_groups(spark, d):
    return _faq(spark, d).groupBy(text.norm_key("representative_question").alias("k")).count().where("count > 1").agg(F.count(F.lit(1)).alias("groups"))


@query("select query_text, count(*)::bigint as count from raw_log where query_text is not null group by 1 order by 2 desc, 1 limit 20000")
def most_frequent(spark, d):
    return freq.most_frequent(freq.frequency(_t(spark, d, "raw_log")), 20_000)


@query("select query_text, count(*)::bigint as count from raw_log where query_text is not null group by 1 order by md5(query_text || '42'), 1 limit 2000")
def sampled(spark, d):
    """A sampling operator: exactly 2,000 texts by hash."""
    return freq.sample(freq.frequency(_t(spark, d, "raw_log")), 2_000)


@query(f"""select cluster_id, question, row_number() over (partition by cluster_id order by o, question)::bigint as position from (
    select cluster_id, {_strip('question')} as question, not is_representative as o, row_number() over (partition by cluster_id, {_key('question')} order by not is_representative, {_strip('question')}) as r
    from cluster_questions where question is not null) where r = 1""")
def unique_in_cluster(spark, d):
    q = _t(spark, d, "cluster_questions").withColumn("_later", ~F.col("is_representative"))
    return freq.unique_in_cluster(q, "cluster_id", "question", ["_later"]).select("cluster_id", "question", F.col("position").cast("long").alias("position"))


# --- keywords ----------------------------------------------------------------------------------------------------------------------


@query(f"with {_TERMS} select unique_q_id, ({_irrelevant('representative_question')}) or ({_irrelevant('cluster_label')}) or ({_irrelevant('answer_label')}) as irrelevant from unique_questions_freq")
def corpus_marks(spark, d):
    return corpus.mark(_faq(spark, d), _terms(spark, d)).select("unique_q_id", "irrelevant")


@query(f"with {_TERMS} select unique_q_id from unique_questions_freq where not (({_irrelevant('representative_question')}) or ({_irrelevant('cluster_label')}) or ({_irrelevant('answer_label')}))")
def corpus_kept(spark, d):
    return corpus.filtered(_faq(spark, d), _terms(spark, d))[0].select("unique_q_id")


@query(f"with {_TERMS} select distinct query_text, {_irrelevant('query_text')} as irrelevant from raw_log where query_text is not null")
def corpus_on_log(spark, d):
    log = _t(spark, d, "raw_log").where("query_text is not null").select("query_text").distinct().withColumnRenamed("query_text", "representative_question")
    return corpus.mark(log, _terms(spark, d)).select(F.col("representative_question").alias("query_text"), "irrelevant")


@query()
def corpus_fuzzy(spark, d):
    """Words like a keyword count as well (Indel ratio of 85 or more)."""
    return corpus.mark(_faq(spark, d), _terms(spark, d), threshold=85.0).select("unique_q_id", "irrelevant")


@query(f"select distinct {_key('term')} as term, contains({_key('term')}, ' ') as is_phrase from irrelevant_corpus where {_key('term')} <> ''")
def keyword_terms(spark, d):
    return _terms(spark, d)


# --- terms -------------------------------------------------------------------------------------------------------------------------


def _docs(spark, d):
    return _faq(spark, d).select("unique_q_id", "cluster_id", text.clean("representative_question").alias("cleaned")).where("cleaned <> ''")


_DOCS = f"docs as (select * from (select unique_q_id, cluster_id, {_clean('representative_question')} as cleaned from unique_questions_freq) where cleaned <> '')"
_VOCAB = f"""{_DOCS}, t as (select unique_q_id, cluster_id, unnest({_tokens('cleaned')}) as term from docs), tf as (select unique_q_id, any_value(cluster_id) as cluster_id, term, count(*) as tf from t group by 1, 3),
    n as (select count(*) as n from docs), v as (select term, count(*)::bigint as df, sum(tf)::bigint as tf from tf group by 1 having count(*) >= 2 and count(*) <= 0.95 * (select n from n) order by 3 desc, 1 limit 1000),
    vocab as (select term, df, tf, ln((1 + n)::double / (1 + df)) + 1 as idf from v, n)"""
_KW = f"""{_VOCAB}, w as (select unique_q_id, cluster_id, term, tf.tf * idf as w from tf join vocab using (term)), ww as (select *, w / sqrt(sum(w * w) over (partition by unique_q_id)) as weight from w),
    r as (select *, row_number() over (partition by unique_q_id order by round(weight, 9) desc, term) as r from ww), kw as (select unique_q_id, any_value(cluster_id) as cluster_id, string_agg(term, ', ' order by term) as top_keywords from r where r <= 5 group by 1)"""
_CKW = f"{_KW}, x as (select cluster_id, unnest(string_split(top_keywords, ', ')) as kw from kw), y as (select cluster_id, kw, count(*)::bigint as n from x group by 1, 2), ckw as (select *, row_number() over (partition by cluster_id order by n desc, kw)::bigint as position from y)"


@query(f"with {_VOCAB} select term, df, tf, round(idf, 6) as idf from vocab")
def tfidf_terms(spark, d):
    return tfidf.vocabulary(_docs(spark, d), "unique_q_id", "cleaned").withColumn("idf", F.round("idf", 6))


@query(f"with {_KW} select unique_q_id, top_keywords from kw")
def question_keywords(spark, d):
    rank.checkpoint_folder(spark)
    docs = _docs(spark, d).checkpoint()  # cleaned once, read for the vocabulary, its size and the weights
    return tfidf.keywords(tfidf.weights(docs, "unique_q_id", "cleaned", tfidf.vocabulary(docs, "unique_q_id", "cleaned")), "unique_q_id")


def _cluster_keywords(spark, d):
    kw = question_keywords(spark, d).join(_faq(spark, d).select("unique_q_id", "cluster_id"), "unique_q_id")
    return tfidf.cluster_keywords(kw, "cluster_id")


@query(f"with {_CKW} select cluster_id, kw, n, position from ckw where position <= 5")
def cluster_keywords(spark, d):
    return _cluster_keywords(spark, d).select("cluster_id", "kw", "n", F.col("position").cast("long").alias("position"))


@query(f"with {_CKW} select distinct a.cluster_id as cluster_a, b.cluster_id as cluster_b from ckw a join ckw b using (kw) where a.position <= 3 and b.position <= 3 and a.cluster_id < b.cluster_id order by 1, 2 limit 30")
def keyword_pairs(spark, d):
    return tfidf.shared_keyword_pairs(_cluster_keywords(spark, d), "cluster_id")


# --- clusters ----------------------------------------------------------------------------------------------------------------------


def _members(spark, d):
    return _faq(spark, d).where("cluster_id is not null").select("unique_q_id", "cluster_id", F.col("representative_question").alias("query_text"), F.col("raw_frequency").alias("count"))


_MEMBERS = "members as (select unique_q_id, cluster_id, representative_question as query_text, raw_frequency as c from unique_questions_freq where cluster_id is not null)"
_BUILT = f"{_MEMBERS}, built as (select cluster_id, sum(c)::bigint as size, count(*)::bigint as unique_queries, first(query_text order by c desc, query_text) as representative from members where cluster_id <> -1 and query_text is not null group by 1)"


def _built(spark, d):
    return cluster.build(_members(spark, d))


@query(f"with {_BUILT} select * from built")
def cluster_build(spark, d):
    return _built(spark, d)


_METRICS = """sizes as (select cluster_id, sum(c)::bigint as size, count(*) as q from members group by 1), run as (select *, sum(size) over (order by size desc, cluster_id) as run from sizes where cluster_id <> -1),
    m as (select (select count(*) from run)::bigint as n_clusters, round((select coalesce(sum(q), 0) from sizes where cluster_id = -1) / (select sum(q) from sizes)::double, 6) as noise_ratio,
    (select coalesce(median(size), 0) from run)::double as median_cluster_size, round((select coalesce(avg(size), 0) from run), 6) as mean_cluster_size,
    least((select count(*) from run), 1 + (select count(*) from run where run < 0.85::double * (select sum(size) from run)))::bigint as clusters_for_85pct)"""


@query(f"with {_MEMBERS}, {_METRICS} select *, round(clusters_for_85pct / n_clusters::double, 6) as coverage_efficiency from m")
def cluster_metrics(spark, d):
    return cluster.metrics(_members(spark, d))


@query(f"with {_BUILT} select round(avg(size), 6) as mean_volume, median(size)::double as median_volume, max(size) as max_volume, min(size) as min_volume, round(avg(unique_queries), 6) as mean_unique, median(unique_queries)::double as median_unique from built")
def cluster_summary(spark, d):
    return cluster.summary(_built(spark, d))


_BUCKETS = " union all ".join(f"select '{n}' as bucket, {lo} as lo, {hi or 'null'} as hi, {k} as position" for k, (lo, hi, n) in enumerate(cluster.BUCKETS))


@query(f"with {_BUILT}, b as ({_BUCKETS}) select bucket, position::int as position, (select count(*) from built where unique_queries >= lo and (hi is null or unique_queries <= hi))::bigint as clusters from b")
def size_buckets(spark, d):
    return cluster.size_buckets(_built(spark, d))


_RANKED = f"{_BUILT}, ranked as (select *, row_number() over w as rank, sum(size) over w as run, sum(size) over () as total from built window w as (order by size desc, cluster_id))"


@query(f"with {_RANKED} select cluster_id, size, rank::bigint as rank, round(size * 100.0::double / total, 2) as pct_of_total, run::bigint as cumulative_size, round(run * 100.0::double / total, 2) as cumulative_pct from ranked")
def cluster_rank(spark, d):
    return cluster.ranked(_built(spark, d)).select("cluster_id", "size", F.col("rank").cast("long").alias("rank"), "pct_of_total", "cumulative_size", "cumulative_pct")


@query(f"""with {_RANKED}, p as (select cluster_id, rank, round(run * 100.0::double / total, 2) as cumulative_pct from ranked), q as (select *, coalesce(lag(cumulative_pct) over (order by rank), 0) as b from p)
    select threshold::double as threshold, rank::bigint as rank, cluster_id, cumulative_pct from q, (select unnest([50, 70, 80, 90, 95]) as threshold) where b < threshold and threshold <= cumulative_pct""")
def threshold_crossings(spark, d):
    return cluster.crossings(_built(spark, d)).withColumn("rank", F.col("rank").cast("long"))


@query(f"with {_RANKED} select cluster_id, size, rank::bigint as rank from ranked where run - size < 0.8::double * total or rank <= 2")
def coverage_cap(spark, d):
    return cluster.coverage_capped(_built(spark, d), 0.8).select("cluster_id", "size", F.col("rank").cast("long").alias("rank"))


def _grid_sql(mode: str) -> str:
    a, b, c, e, g = cluster.GRIDS[mode]
    lists = [f"(select unnest({list(v)}) as {n})" for v, n in zip((a, b, c, e, g), ("alpha", "min_cluster_size", "min_samples", "n_neighbors", "n_components"))]
    return f"""grid as (select (row_number() over (order by alpha, min_cluster_size, min_samples, n_neighbors, n_components) - 1)::int as config_id, alpha::double as alpha, min_cluster_size::int as min_cluster_size, min_samples::int as min_samples,
        n_neighbors::int as n_neighbors, n_components::int as n_components, format('alpha={{:.1f}}_mcs={{}}_ms={{}}_nn={{}}', alpha::double, min_cluster_size, min_samples, n_neighbors) as config from {', '.join(lists)})"""


@query(f"with {_grid_sql('exhaustive')} select * from grid")
def param_grid(spark, d):
    return cluster.param_grid(spark, "exhaustive")


def _candidates(spark, d):
    """Metrics of real clusterings, one for each centre: its log rows by the clusters of their questions (-1 where they have none), with
    the parameters of the configuration that has the centre's place in the grid."""
    one = _t(spark, d, "cluster_questions").where("question is not null").groupBy(F.col("question").alias("query_text")).agg(F.min("cluster_id").alias("cluster_id"))
    asked = _t(spark, d, "raw_log").where("centre_id is not null and query_text is not null").groupBy("centre_id", "query_text").count()
    m = cluster.metrics(asked.join(one, "query_text", "left").withColumn("cluster_id", F.coalesce("cluster_id", F.lit(-1))), ["centre_id"])
    placed = m.withColumn("config_id", (F.row_number().over(Window.orderBy("centre_id")) - 1).cast("int"))  # as many rows as centres
    return placed.join(cluster.param_grid(spark, "exhaustive"), "config_id").drop("centre_id", "median_cluster_size", "mean_cluster_size")


_CAND = f"""{_grid_sql('exhaustive')}, one as (select question, min(cluster_id) as cluster_id from cluster_questions where question is not null group by 1),
    asked as (select centre_id, query_text, count(*) as c from raw_log where centre_id is not null and query_text is not null group by 1, 2),
    sized as (select centre_id, coalesce(cluster_id, -1) as cluster_id, sum(c) as size, count(*) as q from asked left join one on query_text = question group by 1, 2),
    run as (select *, sum(case when cluster_id <> -1 then size end) over (partition by centre_id order by (cluster_id = -1), size desc, cluster_id rows between unbounded preceding and current row) as run, sum(case when cluster_id <> -1 then size else 0 end) over (partition by centre_id) as total from sized),
    met as (select centre_id, count_if(cluster_id <> -1)::bigint as n_clusters, round(sum(case when cluster_id = -1 then q else 0 end) / sum(q)::double, 6) as noise_ratio, least(count_if(cluster_id <> -1 and run < 0.85::double * total) + 1, count_if(cluster_id <> -1))::bigint as clusters_for_85pct from run group by 1),
    cand as (select grid.*, n_clusters, noise_ratio, clusters_for_85pct, round(coalesce(clusters_for_85pct / nullif(n_clusters, 0)::double, 0), 6) as coverage_efficiency
        from (select *, (row_number() over (order by centre_id) - 1)::int as config_id from met) join grid using (config_id))"""


@query(f"with {_CAND} select config_id, config, n_clusters, noise_ratio, clusters_for_85pct, coverage_efficiency from cand")
def candidate_metrics(spark, d):
    return _candidates(spark, d).select("config_id", "config", "n_clusters", "noise_ratio", "clusters_for_85pct", "coverage_efficiency")


@query(f"""with {_CAND} select config_id, case when n_clusters < 50 then 'Too few clusters' when n_clusters > 1000 then 'Too many clusters' when noise_ratio > 0.3 then 'High noise ratio'
    when clusters_for_85pct < 5 then 'Poor coverage efficiency' else 'Viable' end as reason from cand""")
def viability(spark, d):
    return _candidates(spark, d).select("config_id", cluster.viability(F.col("n_clusters"), F.col("noise_ratio"), F.col("clusters_for_85pct")).alias("reason"))


@query(f"with {_CAND} select config_id, coverage_efficiency from cand order by coverage_efficiency, config_id limit 5")
def phase2_topk(spark, d):
    return cluster.select_top(_candidates(spark, d), 5).select("config_id", "coverage_efficiency")


@query(f"with {_CAND} select config_id from cand order by coverage_efficiency, config_id limit 1")
def best_config(spark, d):
    return cluster.best(_candidates(spark, d)).select("config_id")


@query(f"with {_CAND} select config, min(config_id)::int as config_id from cand group by 1")
def config_lookup(spark, d):
    return _candidates(spark, d).groupBy("config").agg(F.min("config_id").alias("config_id"))


@query(f"with {_CAND} select config_id, round((coverage_efficiency - min(coverage_efficiency) over ()) / (max(coverage_efficiency) over () - min(coverage_efficiency) over () + 1e-9), 6) as scaled from cand")
def min_max(spark, d):
    return _candidates(spark, d).select("config_id", F.round(cluster.min_max("coverage_efficiency"), 6).alias("scaled"))


@query(f"with {_CAND} select config_id from (select config_id, (row_number() over (order by config_id) - 1) // ceil(count(*) over () / 3.0)::bigint + 1 as p from cand) where p = 2")
def config_shard(spark, d):
    return cluster.shard(_candidates(spark, d), 2, 3).select("config_id")


def _scaled(c: str) -> str:
    return f"({c} - min({c}) over ()) / (max({c}) over () - min({c}) over () + 1e-9)"


_FAR = "list_min([round(sqrt((t.x - f.x) ** 2 + (t.y - f.y) ** 2), 9) for t in (select list({{'x': x, 'y': y}}) from {0} where stratum is not null)])"


@query(f"""with {_CAND}, s as (select *, round({_scaled('coverage_efficiency')} - 0.5 * {_scaled('clusters_for_85pct')} - 0.3 * {_scaled('noise_ratio')}, 9) as phase1_score from cand),
    o as (select * from (select *, row_number() over (partition by config order by phase1_score desc, config_id) as r from s) where r = 1),
    i as (select *, row_number() over (order by phase1_score desc, config_id) - 1 as i, count(*) over () as n, {_scaled('alpha')} as x, {_scaled('n_components')} as y from o),
    e as (select *, case when i < 8 then 'top' when i >= n - 1 then 'bottom' end as ends from i), nr as (select *, ends is null and i >= n // 2 - 16 and i < n // 2 + 16 as near from e),
    p as (select *, row_number() over (partition by near order by i) - 1 as p, count(*) over (partition by near) as k from nr),
    z as (select *, case when near and (k < 4 or (p % greatest(1, k // 4) = 0 and p < 4 * greatest(1, k // 4))) then 'middle' else ends end as stratum from p),
    d1 as (select i from z f where stratum is null order by {_FAR.format('z')} desc, i limit 1), z1 as (select * replace (case when i in (select i from d1) then 'diverse' else stratum end as stratum) from z),
    d2 as (select i from z1 f where stratum is null order by {_FAR.format('z1')} desc, i limit 1), z2 as (select * replace (case when i in (select i from d2) then 'diverse' else stratum end as stratum) from z1)
    select config_id, config, phase1_score, stratum from z2 where stratum is not null""")
def stratified(spark, d):
    return cluster.strata(_candidates(spark, d)).select("config_id", "config", "phase1_score", "stratum")


@query(f"with {_CAND} select config_id, composite from (select config_id, round(0.45 * coverage_efficiency + 0.30 * (1 - noise_ratio) + 0.25 * (1 - noise_ratio) - 0.20 * (clusters_for_85pct / 400.0::double), 6) as composite from cand) union all select -1, 0.66")
def composite_score(spark, d):
    c = _candidates(spark, d)
    s = evaluate.composite(F.col("coverage_efficiency"), 1 - F.col("noise_ratio"), F.col("noise_ratio"), F.col("clusters_for_85pct") / 400)
    fixed = spark.createDataFrame([(-1, 0.6, 0.7, 0.2, 0.1)], "config_id int, s double, c double, o double, m double").select("config_id", F.round(evaluate.composite(F.col("s"), F.col("c"), F.col("o"), F.col("m")), 6).alias("composite"))
    return c.select("config_id", F.round(s, 6).alias("composite")).unionByName(fixed)


@query("""with c as (select cluster_id, pct_of_cluster_volume / 100 as coherence, (n_questions_in_group % 2)::double as outlier, raw_frequency as w, (raw_frequency % 3) / 2.0::double as separation, (raw_frequency % 2)::double as merge from unique_questions_freq where cluster_id is not null),
    a as (select cluster_id, case when sum(w) > 0 then sum(coherence * w) / sum(w) else avg(coherence) end as coherence_mean, stddev_pop(coherence) as coherence_std, case when sum(w) > 0 then sum(outlier * w) / sum(w) else avg(outlier) end as outlier_rate, avg(separation) as separation_mean, stddev_pop(separation) as separation_std, avg(merge) as merge_rate from c group by 1)
    select cluster_id, round(coherence_mean, 6) as coherence_mean, round(coherence_std, 6) as coherence_std, round(outlier_rate, 6) as outlier_rate, round(separation_mean, 6) as separation_mean, round(separation_std, 6) as separation_std, round(merge_rate, 6) as merge_rate,
    round(0.45 * separation_mean + 0.30 * coherence_mean + 0.25 * (1 - outlier_rate) - 0.20 * merge_rate, 6) as composite from a""")
def score_aggregation(spark, d):
    f = _faq(spark, d).where("cluster_id is not null")
    c = f.select("cluster_id", (F.col("pct_of_cluster_volume") / 100).alias("coherence"), (F.col("n_questions_in_group") % 2).cast("double").alias("outlier"), F.col("raw_frequency").alias("weight"))
    p = f.select("cluster_id", ((F.col("raw_frequency") % 3) / 2).alias("separation"), (F.col("raw_frequency") % 2).cast("double").alias("merge"))
    s = evaluate.scores(c, p, "cluster_id")
    return s.select("cluster_id", *[F.round(x, 6).alias(x) for x in ("coherence_mean", "coherence_std", "outlier_rate", "separation_mean", "separation_std", "merge_rate", "composite")])


@query(f"""with {_BUILT}, l as (select cluster_id, query_text, case when c <= 1 then -1 else cluster_id end as k, c from members), o as (select query_text, row_number() over (order by query_text) as n from (select distinct query_text from l where k = -1 and c > 0))
    select l.query_text, max(case when k = -1 and c > 0 then (select max(k) from l) + n else k end)::bigint as cluster_id from l left join o using (query_text) group by 1""")
def own_clusters(spark, d):
    """Noise (here: questions asked once) that was asked often enough (here: at all) becomes clusters of its own."""
    m = _members(spark, d).withColumn("cluster_id", F.when(F.col("count") <= 1, F.lit(-1)).otherwise(F.col("cluster_id")).cast("long")).select("query_text", "cluster_id", "count")
    m = m.groupBy("query_text").agg(F.max("cluster_id").alias("cluster_id"), F.max("count").alias("count"))
    return cluster.own_clusters(m, 0).select("query_text", "cluster_id")


# --- joins back to the rows --------------------------------------------------------------------------------------------------------

_MAPPED = """one as (select question, min(cluster_id) as cluster_id, first(label order by cluster_id, label nulls first) as label from cluster_questions group by 1), reps as (select distinct representative from cluster_questions where representative is not null),
    mapped as (select raw_row_id, query_text, cluster_id as final_cluster_id, label as cluster_label, representative is not null as is_representative from raw_log left join one on query_text = question left join reps on query_text = representative)"""


def _mapped(spark, d):
    return repair.back_map(_t(spark, d, "raw_log").select("raw_row_id", "query_text"), _t(spark, d, "cluster_questions"))


@query(f"with {_MAPPED} select raw_row_id, coalesce(final_cluster_id, -1)::bigint as final_cluster_id, cluster_label, is_representative from mapped")
def back_mapping(spark, d):
    """Every row with its cluster (-1 where it has none)."""
    return _mapped(spark, d).select("raw_row_id", F.coalesce("final_cluster_id", F.lit(-1)).alias("final_cluster_id"), "cluster_label", "is_representative")


@query(f"with {_MAPPED} select count(final_cluster_id)::bigint as mapped, count_if(final_cluster_id is null)::bigint as unmapped, count(distinct final_cluster_id)::bigint as clusters from mapped")
def mapped_counts(spark, d):
    return _mapped(spark, d).agg(F.count("final_cluster_id").alias("mapped"), F.count_if(F.col("final_cluster_id").isNull()).alias("unmapped"), F.count_distinct("final_cluster_id").alias("clusters"))


@query("select distinct question, coalesce(n, 0)::bigint as raw_freq_individual from cluster_questions left join (select query_text, count(*) as n from raw_log where query_text is not null group by 1) on question = query_text")
def question_frequency(spark, d):
    f = freq.frequency(_t(spark, d, "raw_log")).withColumnRenamed("query_text", "question")
    return _t(spark, d, "cluster_questions").select("question").distinct().join(f, "question", "left").select("question", F.coalesce("count", F.lit(0)).alias("raw_freq_individual"))


@query("select c.cluster_id, c.question, max(u.unique_q_id) as unique_q_id from cluster_questions c left join unique_questions_freq u on c.cluster_id = u.cluster_id and c.question = u.representative_question group by 1, 2")
def question_ids(spark, d):
    """The id of each (cluster, question); of several, the last."""
    last = _faq(spark, d).groupBy("cluster_id", F.col("representative_question").alias("question")).agg(F.max("unique_q_id").alias("unique_q_id"))
    return _t(spark, d, "cluster_questions").select("cluster_id", "question").distinct().join(last, ["cluster_id", "question"], "left").select("cluster_id", "question", "unique_q_id")


@query(f"""with m as (select cluster_id, question, max(f) as c, min(label) as label, min(representative) as representative, min(parent_cluster) as parent_cluster, min(merged_from) as merged_from from (select distinct cluster_id, question, label, representative, parent_cluster, merged_from from cluster_questions)
    left join (select query_text, count(*) as f from raw_log where query_text is not null group by 1) on question = query_text group by 1, 2),
    c as (select cluster_id, min(label) as label, min(representative) as representative, count(*)::bigint as n_unique_questions, sum(coalesce(c, 0))::bigint as query_volume, min(parent_cluster) as parent_cluster, min(merged_from) as merged_from from m group by 1)
    select * replace (coalesce(parent_cluster, -1)::bigint as parent_cluster), row_number() over (order by query_volume desc, cluster_id)::bigint as rank, round(query_volume * 100.0::double / sum(query_volume) over (), 2) as pct_of_total, parent_cluster is not null as was_split from c""")
def repaired_summary(spark, d):
    q = _t(spark, d, "cluster_questions").groupBy("cluster_id", "question").agg(*[F.min(c).alias(c) for c in ("label", "representative", "parent_cluster", "merged_from")])
    f = question_frequency(spark, d).withColumnRenamed("raw_freq_individual", "count")
    m = q.join(f, "question", "left").withColumn("count", F.coalesce("count", F.lit(0))).withColumn("merged_from", F.split("merged_from", ","))
    r = repair.repaired(m).drop("all_unique_questions")
    return r.withColumns({"rank": F.col("rank").cast("long"), "parent_cluster": F.coalesce("parent_cluster", F.lit(-1))})


@query("select cluster_id, count(*)::bigint as questions from cluster_questions c where not exists (select 1 from repaired_clusters r where r.cluster_id = c.cluster_id and r.was_split) group by 1")
def resume_anti(spark, d):
    done = _t(spark, d, "repaired_clusters").where("was_split").select("cluster_id").distinct()
    return _t(spark, d, "cluster_questions").join(done, "cluster_id", "left_anti").groupBy("cluster_id").agg(F.count(F.lit(1)).alias("questions"))


@query("""with m as (select distinct cluster_id, question, length(question) as c from cluster_questions), r as (select distinct cluster_id, representative as question from repaired_clusters where representative is not null), s as (select cluster_id, question from r semi join m using (cluster_id, question)),
    f as (select cluster_id, first(question order by c desc, question) as question from m group by 1) select cluster_id, question from s union all select cluster_id, question from f where cluster_id not in (select cluster_id from s)""")
def refreshed_reps(spark, d):
    m = _t(spark, d, "cluster_questions").select("cluster_id", "question", F.length("question").cast("long").alias("count")).distinct()
    r = _t(spark, d, "repaired_clusters").where("representative is not null").select("cluster_id", F.lit(1).alias("position"), F.col("representative").alias("question")).distinct()
    return repair.refreshed(r, m).select("cluster_id", "question")


@query("""with m as (select distinct cluster_id, question from cluster_questions), x as (select *, contains(lower(question), 'block') as bad from m), y as (select *, count_if(not bad) over (partition by cluster_id) as keep from x) select cluster_id, question from y where not bad or keep < 2""")
def contamination(spark, d):
    """Members without the flagged ones (here: those with a given word), where two or more are left."""
    m = _t(spark, d, "cluster_questions").select("cluster_id", "question").distinct()
    return repair.without_flagged(m, m.where(F.lower("question").contains("block")))


# --- groups and checks -------------------------------------------------------------------------------------------------------------

_GROUPED = """g as (select cluster_id, coalesce(answer_label, '') as group_no, unique_q_id as position, representative_question as question, raw_frequency as freq from unique_questions_freq where cluster_id is not null),
    rolled as (select cluster_id, group_no, first(question order by freq desc, position) as representative_question, sum(freq)::bigint as raw_frequency, count(*)::bigint as n_questions_in_group from g group by 1, 2)"""


def _rolled(spark, d):
    m = _faq(spark, d).where("cluster_id is not null").select("cluster_id", F.coalesce("answer_label", F.lit("")).alias("group_no"), F.col("unique_q_id").alias("position"), F.col("representative_question").alias("question"), F.col("raw_frequency").alias("freq"))
    return unique.roll_up(m)


@query(f"with {_GROUPED} select *, coalesce(round(raw_frequency * 100.0::double / nullif(sum(raw_frequency) over (partition by cluster_id), 0), 2), 0) as pct_of_cluster_volume from rolled")
def group_rollup(spark, d):
    return _rolled(spark, d)


@query(f"""with {_GROUPED}, n as (select count(*)::bigint as log_rows from raw_log), q as (select count(*)::double as q from unique_questions_freq)
    select count(distinct cluster_id)::bigint as n_clusters, count(*)::bigint as n_groups, sum(n_questions_in_group)::bigint as n_questions, sum(raw_frequency)::bigint as sum_frequency, any_value(log_rows) as log_rows, sum(raw_frequency) <= any_value(log_rows) as frequency_ok,
    round(1 - count(*) / any_value(q), 6) as reduction, round(count(*)::double / count(distinct cluster_id), 6) as groups_per_cluster from rolled, n, q""")
def verification(spark, d):
    return unique.verification(_rolled(spark, d), _t(spark, d, "raw_log").count(), _faq(spark, d).count())


@query(f"with {_GROUPED}, k as (select cluster_id, count(*) as k from rolled group by 1) select count_if(k = 1)::bigint as one, count_if(k between 2 and 3)::bigint as two_or_three, count_if(k >= 4)::bigint as four_or_more from k")
def groups_per_cluster(spark, d):
    g = _rolled(spark, d).withColumn("group_no", F.row_number().over(Window.partitionBy("cluster_id").orderBy("group_no")))
    return unique.distribution(g)


def _replies(spark, d):
    """For each cluster the reply that a judge would give who groups its questions (in order of their ids) by answer label: JSON amid other
    words, indices partly as text, one out of range and the first question claimed by every group."""
    p = F.row_number().over(Window.partitionBy("cluster_id").orderBy("unique_q_id"))
    q = _faq(spark, d).where("cluster_id is not null").select("cluster_id", F.coalesce(text.strip("answer_label"), F.lit("none")).alias("label"), p.alias("i"))
    g = q.groupBy("cluster_id", "label").agg(F.sort_array(F.collect_list("i")).alias("own"))
    more = F.concat(F.transform("own", lambda i: F.when(i % 2 == 0, F.concat(F.lit('"'), i.cast("string"), F.lit('"'))).otherwise(i.cast("string"))), F.array(F.lit("1"), F.lit("999999")))
    said = F.concat(F.lit('{"group": '), F.col("own")[0].cast("string"), F.lit(', "label": '), F.to_json(F.array("label")).substr(F.lit(2), F.length(F.to_json(F.array("label"))) - 2), F.lit(', "indices": ['), F.array_join(more, ", "), F.lit("]}"))
    parts = g.select("cluster_id", F.col("own")[0].alias("at"), said.alias("s"), F.size("own").alias("k"))
    rows = parts.groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("at", "s", "k"))).alias("x"), F.sum("k").cast("int").alias("n"))
    return rows.select("cluster_id", "n", "x")


def _reply(parts):
    return F.concat(F.lit("Here you are: ["), F.array_join(F.transform(parts, lambda x: x["s"]), ", "), F.lit("] Done."))


_ASKED = f"""q as (select cluster_id, coalesce({_strip('answer_label')}, 'none') as label, row_number() over (partition by cluster_id order by unique_q_id) as i from unique_questions_freq where cluster_id is not null),
    g as (select *, min(i) over w as pos, count(*) over w as k from q window w as (partition by cluster_id, label))"""


@query(f"with {_ASKED} select cluster_id, dense_rank() over (partition by cluster_id order by pos)::int as group_no, {_strip('left(label, 200)')} as answer_label, (i - 1)::int as idx from g")
def parse_groups(spark, d):
    r = _replies(spark, d)
    return unique.parse_groups(r.select("cluster_id", _reply(F.col("x")).alias("raw"), "n"))


@query(f"""with {_ASKED}, h as (select *, case when k > 1 or pos = 1 then pos end as own from g), b as (select cluster_id, first(pos order by k desc, pos) as big, first(label order by k desc, pos) as big_label from (select distinct cluster_id, pos, label, k + (pos = 1)::int as k from g where k > 1 or pos = 1) group by 1),
    r as (select cluster_id, coalesce(own, big) as pos, case when own is null then big_label else label end as label, i from h join b using (cluster_id))
    select cluster_id, dense_rank() over (partition by cluster_id order by pos)::int as group_no, left({_strip('left(label, 200)')}, 100) as answer_label, (i - 1)::int as idx from r""")
def split_groups(spark, d):
    """The same replies without the groups of one question (but the first): these questions join the largest group."""
    r = _replies(spark, d).withColumn("x", F.filter("x", lambda x: (x["k"] > 1) | (x["at"] == 1)))
    return unique.split_groups(r.select("cluster_id", _reply(F.col("x")).alias("raw"), "n")).distinct()


@query("""select distinct query_text, case when regexp_extract(upper(query_text), '[ABC]') = '' then 'C' else regexp_extract(upper(query_text), '[ABC]') end as letter,
    case regexp_extract(upper(query_text), '[ABC]') when 'A' then 1.0 when 'B' then 0.7 else 0.2 end::double as coherence, case regexp_extract(upper(query_text), '[ABC]') when 'A' then 1.0 when 'B' then 0.6 else 0 end::double as separation,
    case when regexp_extract(upper(query_text), '[N1-4]') in ('', 'N') then -1 else regexp_extract(upper(query_text), '[N1-4]')::int - 1 end as outlier from raw_log where query_text is not null""")
def reply_letters(spark, d):
    """Any text as a reply: its letter, scores and outlier index."""
    t = _t(spark, d, "raw_log").where("query_text is not null").select("query_text").distinct()
    k = replies.letter(F.col("query_text"))
    return t.select("query_text", k.alias("letter"), replies.score(k, replies.COHERENCE, 0.5).alias("coherence"), replies.score(k, replies.SEPARATION, 0.5).alias("separation"), replies.outlier(F.col("query_text"), F.lit(4)).alias("outlier"))


@query(f"""select distinct unique_q_id, {_strip("coalesce(representative_question, '')")} as question, {_strip("coalesce(category, 'none')")} as category, case when answer is null then 'CATEGORY: ' || coalesce(category, 'none') || chr(10) || 'QUESTION: ' || coalesce(representative_question, '') else {_strip('answer')} end as answer
    from unique_questions_freq_qa""")
def qa_parse(spark, d):
    """Replies built from the stored parts of every row, in fences, and taken apart again; a null answer is a reply without that part."""
    t = _t(spark, d, "unique_questions_freq_qa")
    raw = F.concat(F.lit("```text\nCATEGORY: "), F.coalesce("category", F.lit("none")), F.lit("\nQUESTION: "), F.coalesce("representative_question", F.lit("")), F.coalesce(F.concat(F.lit("\n**ANSWER**:\n"), "answer"), F.lit("")), F.lit("\n```"))
    q, c, a = replies.qa_fields(raw)
    return t.select("unique_q_id", q.alias("question"), c.alias("category"), a.alias("answer")).distinct()


@query(f"""select cluster_id, string_agg(position || '. ' || question, chr(10) order by position) as numbered from (select cluster_id, question, row_number() over (partition by cluster_id order by question) as position from (select distinct cluster_id, {_strip('question')} as question from cluster_questions where question is not null)) group by 1""")
def numbered_questions(spark, d):
    q = _t(spark, d, "cluster_questions").where("question is not null").select("cluster_id", text.strip("question").alias("question")).distinct()
    return q.groupBy("cluster_id").agg(F.sort_array(F.collect_list("question")).alias("qs")).select("cluster_id", text.numbered(F.col("qs")).alias("numbered"))


@query("select unique_q_id, 'Question: ' || representative_question || chr(10) || 'Asked: ' || raw_frequency || ' times' as message from unique_questions_freq where representative_question is not null and raw_frequency is not null")
def qa_messages(spark, d):
    return qa.messages(_faq(spark, d).where("representative_question is not null and raw_frequency is not null")).select("unique_q_id", "message")


@query(f"with {_BUILT} select cluster_id, least(200 + 20 * unique_queries, 4096)::bigint as remote, least(150 + 16 * unique_queries, 600)::bigint as local from built")
def token_budgets(spark, d):
    return _built(spark, d).select("cluster_id", replies.token_budget(F.col("unique_queries")).alias("remote"), replies.token_budget(F.col("unique_queries"), True).alias("local"))


# --- vectors -----------------------------------------------------------------------------------------------------------------------

_COS = "(list_dot_product(a.embedding::double[], b.embedding::double[]) / (sqrt(list_dot_product(a.embedding::double[], a.embedding::double[])) * sqrt(list_dot_product(b.embedding::double[], b.embedding::double[]))))"


@query(f"select * from (select a.vec_id as a, b.vec_id as b, round({_COS}, 6) as similarity from embeddings a join embeddings b on a.vec_id < b.vec_id) where similarity >= 0.4")
def cosine_pairs(spark, d):
    return similarity.similar_pairs(_t(spark, d, "embeddings"), "vec_id", "embedding", 0.3999995).withColumn("similarity", F.round("similarity", 6)).where("similarity >= 0.4")


@query(f"select * from (select a.vec_id as a, b.vec_id as b, round({_COS}, 6) as similarity from embeddings a join embeddings b on a.vec_id < b.vec_id and a.label <> b.label) where similarity >= 0.35")
def cross_cluster_pairs(spark, d):
    return similarity.similar_pairs(_t(spark, d, "embeddings"), "vec_id", "embedding", 0.3499995, "label").withColumn("similarity", F.round("similarity", 6)).where("similarity >= 0.35")


@query(f"select a, b, round(s, 6) as similarity from (select a.vec_id as a, b.vec_id as b, {_COS} as s from embeddings a join embeddings b on a.vec_id < b.vec_id) where s >= 0.2 order by round(s, 9) desc, a, b limit 100")
def merge_candidates(spark, d):
    return similarity.merge_candidates(_t(spark, d, "embeddings"), "vec_id", "embedding", 0.2).withColumn("similarity", F.round("similarity", 6))


@query("""with d as (select p.vec_id, t.vec_id as nearest_id, t.label, list_distance(p.embedding::double[], t.embedding::double[]) as distance from embeddings p, embeddings t where p.label = 0 and t.label <> 0)
    select vec_id, nearest_id, label, round(distance, 6) as distance from (select *, row_number() over (partition by vec_id order by round(distance, 9), nearest_id) as r from d) where r = 1""")
def nearest_reassign(spark, d):
    e = _t(spark, d, "embeddings")
    return similarity.nearest(e.where("label = 0"), e.where("label <> 0"), "vec_id", "embedding", "label").withColumn("distance", F.round("distance", 6))


_UNIT = "u as (select vec_id, label, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as n from embeddings), x as (select vec_id, label, generate_subscripts(e, 1) as p, unnest(e) / n as v from u)"


@query(f"with {_UNIT}, c as (select label, p, avg(v) as c from x group by 1, 2), s as (select label, vec_id, sum(v * c) as s from x join c using (label, p) group by 1, 2) select label, first(vec_id order by round(s, 9) desc, vec_id) as centre_id, count(*)::bigint as members from s group by 1")
def centroid_nearest(spark, d):
    return similarity.centroid_nearest(_t(spark, d, "embeddings"), "vec_id", "embedding", "label")


_ALPHAS = [0.3, 0.5, 0.7]


@query(f"""with p as (select a.vec_id as a, b.vec_id as b, 1 - {_COS} as cd from embeddings a join embeddings b on a.vec_id < b.vec_id and {_COS} >= 0.3), t as (select doc_id, list_distinct({_tokens('text')}) as t from documents),
    j as (select a, b, cd, len(list_intersect(x.t, y.t)) as i, len(x.t) + len(y.t) as n from p join t x on a = x.doc_id join t y on b = y.doc_id), k as (select a, b, cd, case when n = 0 then 0 else 1 - i::double / (n - i) end as jd from j)
    select a, b, alpha::double as alpha, round(cd, 6) as cosine_distance, round(jd, 6) as jaccard_distance, round(alpha::double * cd + (1 - alpha::double) * jd, 6) as hybrid_distance from k, (select unnest({_ALPHAS}) as alpha)""")
def hybrid_distance(spark, d):
    e = _t(spark, d, "embeddings")
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), F.array_distinct(text.tokens("text")).alias("terms")).join(e, "vec_id")
    out = similarity.pair_distances(similarity.similar_pairs(e, "vec_id", "embedding", 0.3), docs, "vec_id", "embedding", "terms", _ALPHAS)
    return out.select("a", "b", "alpha", *[F.round(c, 6).alias(c) for c in ("cosine_distance", "jaccard_distance", "hybrid_distance")])


@query(f"""with {_UNIT}, c as (select label, p, avg(v) as c from x group by 1, 2), s as (select label, vec_id, sum(v * c) as s from x join c using (label, p) group by 1, 2), one as (select label, first(vec_id order by round(s, 12) desc, vec_id) as v1 from s group by 1),
    w as (select vec_id, label, list_transform(e, lambda v: v / n) as e from u), d1 as (select w.*, v1, 1 - list_dot_product(w.e, b.e) as g from w join one using (label) join w b on b.vec_id = v1),
    two as (select label, first(vec_id order by round(g, 12) desc, vec_id) as v2 from d1 where vec_id <> v1 group by 1), d2 as (select d1.* replace (least(g, 1 - list_dot_product(d1.e, b.e)) as g), v2 from d1 join two using (label) join w b on b.vec_id = v2),
    three as (select label, first(vec_id order by round(g, 12) desc, vec_id) as v3 from d2 where vec_id not in (v1, v2) group by 1)
    select label, 1::int as position, v1 as vec_id from one union all select label, 2::int, v2 from two union all select label, 3::int, v3 from three""")
def diverse_reps(spark, d):
    return repair.diverse(_t(spark, d, "embeddings"), "label", "vec_id", "embedding")


@query()
def greedy_merge(spark, d):
    e = _t(spark, d, "embeddings")
    m = e.join(_t(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "n_chars"), "vec_id").select(F.col("label").cast("long").alias("cluster_id"), F.col("vec_id").alias("question"), F.col("n_chars").alias("count"))
    c = similarity.centroid_nearest(e, "vec_id", "embedding", "label").join(e.drop("label").withColumnRenamed("vec_id", "centre_id"), "centre_id").withColumn("label", F.col("label").cast("long"))
    return repair.merge(m, similarity.merge_candidates(c, "label", "embedding", -1.0, 5)).withColumn("merged_from", F.array_join("merged_from", ","))


@query()
def cross_cluster_merge(spark, d):
    n = _t(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), F.col("n_chars").alias("freq"))
    e = _t(spark, d, "embeddings").join(n, "vec_id").withColumn("n_questions_in_group", F.lit(1).cast("long"))
    return unique.cross_cluster_dedup(e, "vec_id", "embedding", "label", "freq", 0.35, also=("n_questions_in_group",)).drop("embedding")


@query()
def hdbscan_labels(spark, d):
    grid = cluster.param_grid(spark, "quick")
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), F.array_distinct(text.tokens("text")).alias("terms"))
    return density.grid_labels(_t(spark, d, "embeddings").select("vec_id", "embedding").join(docs, "vec_id", "left"), grid, "vec_id", "embedding", "terms")


@query()
def grid_metrics(spark, d):
    labels = hdbscan_labels(spark, d).withColumn("count", F.lit(1))
    return cluster.metrics(labels, ["config_id"])


@query()
def evaluation(spark, d):
    m = _members(spark, d).where("query_text is not null").select("cluster_id", F.col("query_text").alias("question"), "count")
    return evaluate.evaluate(m, SameLetter("B"))


@query(f"""with m as (select unique_q_id, 'Question: ' || coalesce(representative_question, 'N/A') || chr(10) || 'Asked: ' || coalesce(raw_frequency, 1) || ' times' as message from unique_questions_freq)
    select unique_q_id, {_strip('message')} as generated_question, 'Other' as generated_category, {_strip("'Please ask an officer about: ' || message")} as generated_answer from m""")
def qa_generated(spark, d):
    return qa.answers(_faq(spark, d), CROP, Echo()).select("unique_q_id", "generated_question", "generated_category", "generated_answer")


@query()
def chunk_merges(spark, d):
    e = _t(spark, d, "embeddings").withColumn("group_no", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")))
    return unique.merge_chunk_groups(e, "label", "embedding", 0.3)


# --- sets --------------------------------------------------------------------------------------------------------------------------


@query("select query_text as question from raw_log where query_text is not null union select question from cluster_questions where question is not null")
def question_union(spark, d):
    return _t(spark, d, "raw_log").select(F.col("query_text").alias("question")).unionByName(_t(spark, d, "cluster_questions").select("question")).where("question is not null").distinct()


@query("select question from cluster_questions where question is not null except select query_text from raw_log")
def question_difference(spark, d):
    a = _t(spark, d, "cluster_questions").where("question is not null").select("question").distinct()
    return a.join(_t(spark, d, "raw_log").select(F.col("query_text").alias("question")), "question", "left_anti")


@query("select * exclude (parent_cluster) from cluster_questions union all select * exclude (parent_cluster) from cluster_questions")
def shard_union(spark, d):
    q = _t(spark, d, "cluster_questions").drop("parent_cluster")
    return q.unionByName(q, allowMissingColumns=True)
