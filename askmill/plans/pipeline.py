"""The stages of a run, from the raw log to question-answer pairs; each writes its tables and can be resumed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import replies
from ..functions.text import clean, tokens
from ..operators import cluster, corpus, density, evaluate, freq, qa, repair, similarity, unique
from ..operators.models import Echo, Embedder, Generator, HashedWords, Judge, SameLetter, embedded, judged
from ..operators.rank import first_per_group
from ..sources.io import Stages


@dataclass
class Settings:
    crop: str
    max_queries: int = 20_000
    grid_mode: str = "quick"
    phase2_top_k: int = 5
    coverage_cap: float = 0.8
    diverse_k: int = 3
    coherence_flag: str = "C"
    merge_sim: float = 0.82
    group_chunk: int = 12
    group_sim: float = 0.88
    dedup_threshold: float = 0.92
    fuzz_threshold: float = 100.0


class Pipeline:
    def __init__(self, spark: SparkSession, root: str, settings: Settings, embedder: Embedder | None = None, judge: Judge | None = None, generator: Generator | None = None):
        self.stages, self.s, self.spark = Stages(spark, root), settings, spark
        self.embedder, self.judge, self.generator = embedder or HashedWords(), judge or SameLetter(), generator or Echo()

    def frequency(self, log: DataFrame) -> DataFrame:
        """The questions of the crop with their counts and vectors; a hashed sample if there are too many."""
        f = freq.frequency(freq.of_crop(log, self.s.crop))
        return self.stages.write("frequency", embedded(freq.sample(f, self.s.max_queries), "query_text", self.embedder))

    def screen(self) -> DataFrame:
        """All configurations of the grid: labels and metrics; the viable ones are candidates."""
        f, grid = self.stages.read("frequency"), cluster.param_grid(self.spark, self.s.grid_mode)
        terms = f.withColumn("terms", F.array_distinct(tokens(clean("query_text"))))
        labels = density.grid_labels(terms, grid, "query_text", "embedding", "terms", max(self.s.max_queries, 1)).join(f.select("query_text", "count"), "query_text")
        labels = self.stages.write("labels", labels)
        m = cluster.metrics(labels, ["config_id"]).join(grid, "config_id")
        return self.stages.write("candidates", m.withColumn("reason", cluster.viability(F.col("n_clusters"), F.col("noise_ratio"), F.col("clusters_for_85pct"))))

    def choose(self) -> int:
        """The best of the candidates by the judge's scores; of all configurations if none is viable."""
        c = self.stages.read("candidates")
        viable = c.where("reason = 'Viable'")
        rows = cluster.select_top(viable if viable.limit(1).count() else c, self.s.phase2_top_k).select("config_id").collect()
        labels, scores = self.stages.read("labels"), []
        for r in rows:
            members = labels.where((F.col("config_id") == r["config_id"]) & (F.col("cluster_id") != -1)).select("cluster_id", F.col("query_text").alias("question"), "count")
            sizes = members.groupBy("cluster_id").agg(F.sum("count").alias("size"))
            kept = cluster.coverage_capped(sizes, self.s.coverage_cap).select("cluster_id")
            scores.append(evaluate.evaluate(members.join(kept, "cluster_id", "left_semi"), self.judge, whole=members).withColumn("config_id", F.lit(r["config_id"])))
        out = scores[0]
        for x in scores[1:]:
            out = out.unionByName(x)
        best = self.stages.write("scores", out).orderBy(F.desc("composite"), "config_id").first()
        return best["config_id"] if best else rows[0]["config_id"]  # nothing could be judged: all is noise

    def _ordered(self, members: DataFrame, by: list[str], order: list) -> DataFrame:
        """One row per ``by``: qs, the questions in order, and n, their number."""
        o = F.sort_array(F.collect_list(F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)], F.col("question").alias("q"))))
        return members.groupBy(*by).agg(F.transform(o, lambda x: x["q"]).alias("qs")).withColumn("n", F.size("qs"))

    def _off_crop(self, members: DataFrame) -> DataFrame:
        """(cluster_id, question): what the judge says deals with another crop."""
        lists = self._ordered(members, ["cluster_id"], [-F.col("count")])
        asked = judged(lists.withColumn("prompt", replies.ask_off_crop(self.s.crop, F.col("qs"))), "prompt", self.judge)
        off = asked.select("cluster_id", "qs", "n", F.explode(replies.json_object(F.col("reply"), "off array<string>")["off"]).alias("i")).withColumn("i", F.col("i").try_cast("int"))
        return self.stages.write("off_crop", off.where("i between 1 and n").select("cluster_id", F.expr("get(qs, i - 1)").alias("question")).distinct())

    def _splits(self, members: DataFrame, reps: DataFrame) -> DataFrame:
        """(cluster_id, group_no, answer_label, question) of the clusters whose representatives the judge finds to differ."""
        shown = self._ordered(reps, ["cluster_id"], [F.col("position")]).where("n >= 2")
        rated = judged(shown.withColumn("prompt", replies.ask_range(self.s.crop, F.col("qs"))), "prompt", self.judge)
        rated = rated.where(replies.letter(F.col("reply"), "A") == self.s.coherence_flag).select("cluster_id", F.col("qs")[0].alias("topic"))
        lists = self._ordered(members, ["cluster_id"], [-F.col("count")]).join(rated, "cluster_id")
        asked = judged(lists.withColumn("prompt", replies.ask_split(F.col("qs"), F.col("topic"), self.s.crop)), "prompt", self.judge)
        asked = self.stages.write("split_replies", asked.select("cluster_id", "qs", "n", F.col("reply").alias("raw")))
        return unique.split_groups(asked).join(asked.select("cluster_id", "qs"), "cluster_id").select("cluster_id", "group_no", "answer_label", F.expr("get(qs, idx)").alias("question"))

    def repair(self, config_id: int) -> DataFrame:
        """Noise into clusters, representatives, questions of other crops out, splits and merges as the judge decides; one row per question."""
        f = self.stages.read("frequency")
        one = self.stages.read("labels").where(F.col("config_id") == config_id).select("query_text", "cluster_id", "count")
        one = cluster.own_clusters(one).join(f.select("query_text", "embedding"), "query_text")
        settled, noise = one.where("cluster_id >= 0"), one.where("cluster_id < 0")
        moved = similarity.nearest(noise, settled, "query_text", "embedding", "cluster_id").select("query_text", "cluster_id").join(noise.drop("cluster_id"), "query_text")
        members = self.stages.write("settled", settled.unionByName(moved.select(settled.columns)).withColumnRenamed("query_text", "question"))
        reps = repair.diverse(members, "cluster_id", "question", "embedding", self.s.diverse_k)
        members = repair.without_flagged(members, self._off_crop(members))
        reps = self.stages.write("representatives", repair.refreshed(reps, members))
        groups = self.stages.write("splits", self._splits(members, reps))
        members = self.stages.write("split_members", repair.split(members, groups))
        parts = members.where("parent_cluster is not null")
        named = parts.join(groups.select(F.col("cluster_id").alias("parent_cluster"), "question", "answer_label"), ["parent_cluster", "question"]).groupBy("cluster_id", "answer_label").agg(F.count(F.lit(1)).alias("n"))
        named = first_per_group(named, ["cluster_id"], [-F.col("n"), F.col("answer_label")]).select("cluster_id", F.col("answer_label").alias("split_label"))
        whole = reps.join(members.where("parent_cluster is null").select("cluster_id").distinct(), "cluster_id", "left_semi")
        first = first_per_group(whole, ["cluster_id"], [F.col("position")]).select("cluster_id", F.col("question").alias("representative"))
        first = first.unionByName(repair.diverse(parts, "cluster_id", "question", "embedding", 1).select("cluster_id", F.col("question").alias("representative")))
        centres = first.join(members.select("cluster_id", F.col("question").alias("representative"), "embedding"), ["cluster_id", "representative"])
        pairs = similarity.merge_candidates(centres, "cluster_id", "embedding", self.s.merge_sim)
        both = pairs.join(first.select(F.col("cluster_id").alias("a"), F.col("representative").alias("ra")), "a").join(first.select(F.col("cluster_id").alias("b"), F.col("representative").alias("rb")), "b")
        pairs = self.stages.write("merge_pairs", judged(both.withColumn("prompt", replies.ask_join(self.s.crop, F.col("ra"), F.col("rb"))), "prompt", self.judge))
        yes = {(r["a"], r["b"]) for r in pairs.where(replies.letter(F.col("reply"), "B") == "A").select("a", "b").collect()}  # a hundred pairs at most
        merged = repair.merge(members, pairs, lambda a, b: (a, b) in yes)
        out = merged.join(first, "cluster_id", "left").join(named, "cluster_id", "left")
        return self.stages.write("members", out.withColumn("label", F.substring(F.coalesce("split_label", "representative"), 1, 120)).drop("split_label"))

    def groups(self) -> DataFrame:
        """(cluster_id, group_no, answer_label, position, question, freq, embedding): the questions of a cluster grouped by the answer they need.

        The judge is asked once for each chunk; groups of several chunks that it finds to be one answer are merged.
        """
        w = Window.partitionBy("cluster_id")  # a cluster is bounded by max_queries
        m = self.stages.read("members").withColumns({"position": F.row_number().over(w.orderBy(F.desc("count"), "question")), "size": F.count(F.lit(1)).over(w)})
        m = unique.chunks(m, "cluster_id", self.s.group_chunk).withColumn("chunk", F.concat_ws("_", "cluster_id", "chunk_no"))
        lists = self._ordered(m.where("size > 1"), ["chunk", "label"], [F.col("position")])
        asked = judged(lists.withColumn("prompt", replies.ask_groups(F.col("qs"), F.col("label"), self.s.crop)), "prompt", self.judge)
        asked = self.stages.write("group_replies", asked.select("chunk", "n", F.col("reply").alias("raw")))
        found = unique.parse_groups(asked, "chunk").withColumnRenamed("group_no", "g")
        each = m.withColumn("idx", ((F.col("position") - 1) % self.s.group_chunk).cast("int")).join(found, ["chunk", "idx"], "left").withColumns({"g": F.coalesce("g", F.lit(1)), "answer_label": F.coalesce("answer_label", "label")})
        each = self.stages.write("chunk_groups", each.withColumn("group_no", F.dense_rank().over(w.orderBy("chunk_no", "g"))))
        heads = first_per_group(each.where(F.col("size") > self.s.group_chunk), ["cluster_id", "group_no"], [F.col("position")]).select("cluster_id", "group_no", "embedding", "question")
        to = self.stages.write("chunk_merges", unique.merge_chunk_groups(heads, "cluster_id", "embedding", self.s.group_sim, self.judge, "question", self.s.crop))
        each = each.join(to, ["cluster_id", "group_no"], "left").withColumn("_g", F.coalesce("merged_no", "group_no"))
        good = F.when(~F.col("answer_label").isin("(unclassified)", ""), F.struct("group_no", "answer_label"))
        named = each.groupBy("cluster_id", "_g").agg(F.coalesce(F.min(good)["answer_label"], F.min("answer_label")).alias("_l"))
        return self.stages.write("groups", each.join(named, ["cluster_id", "_g"]).select("cluster_id", F.col("_g").alias("group_no"), F.col("_l").alias("answer_label"), "position", "question", F.col("count").alias("freq"), "embedding", F.col("label").alias("cluster_label")))

    def faq(self, terms: DataFrame) -> DataFrame:
        """Answer-distinct questions: grouped in each cluster, merged across clusters, without duplicates and off-topic ones, ranked."""
        self.stages.write("repaired", repair.repaired(self.stages.read("members")))
        g = self.groups()
        names = g.select("cluster_id", "group_no", "answer_label", "cluster_label").distinct()
        vectors = g.select("cluster_id", F.col("question").alias("representative_question"), "embedding")
        rows = unique.roll_up(g).join(names, ["cluster_id", "group_no"]).join(vectors, ["cluster_id", "representative_question"])
        rows = self.stages.write("rolled_up", rows.withColumn("unique_q_id", F.concat_ws("_", "cluster_id", "group_no")))
        once = unique.cross_cluster_dedup(rows, "unique_q_id", "embedding", "cluster_id", "raw_frequency", self.s.dedup_threshold, also=("n_questions_in_group",)).drop("embedding")
        kept, removed = corpus.filtered(freq.dedup(once), terms, threshold=self.s.fuzz_threshold)
        self.stages.write("filtered_out", removed)
        return self.stages.write("faq", freq.ranked(kept))

    def answers(self) -> DataFrame:
        return self.stages.write("faq_qa", qa.answers(self.stages.read("faq"), self.s.crop, self.generator))

    def run(self, log: DataFrame, terms: DataFrame, resume: bool = False) -> DataFrame:
        """All stages; with ``resume`` those whose last table is there are left as they are."""

        def todo(table: str) -> bool:
            return not (resume and self.stages.exists(table))

        if todo("frequency"):
            self.frequency(log)
        if todo("candidates"):
            self.screen()
        if todo("members"):
            self.repair(self.choose())
        if todo("row_mapping"):
            self.stages.write("row_mapping", repair.back_map(freq.of_crop(log, self.s.crop), self.stages.read("members")))
        if todo("faq"):
            self.faq(terms)
        return self.answers() if todo("faq_qa") else self.stages.read("faq_qa")
