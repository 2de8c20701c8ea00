"""Operators on small tables: edge rows, invariants, brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from askmill.operators import cluster, corpus, density, evaluate, freq, qa, rank, repair, similarity, tfidf, unique
from askmill.operators.models import Echo, HashedWords, SameLetter, embedded
from askmill.plans.pipeline import Pipeline, Settings
from askmill.streaming import frequency as streaming


def test_crop_and_frequency(spark, rows):
    log = spark.createDataFrame([(" Paddy (Dhan) ", "a"), ("Paddy Dhan", "a"), ("paddy dhan", "x"), (None, "y")], "crop string, query_text string")
    assert freq.of_crop(log, "Paddy (Dhan)").count() == 2
    f = spark.createDataFrame([("a",), ("a",), ("A",), ("a ",), (" ",), (None,)], "query_text string")
    assert rows(freq.frequency(f)) == [(" ", 1), ("A", 1), ("a ", 1), ("a", 2)]
    assert rows(freq.frequency_trimmed(f)) == [("A", 1), ("a", 3)]
    assert ("nan", 1) in rows(freq.frequency_with_missing(f, "query_text"))


def test_dedup_rank_duplicates(spark, rows):
    faq = spark.createDataFrame([("1", "Q1", 5), ("2", "q1 ", 9), ("3", "q2", 1), ("4", "\u00a0Q2", 1)], "unique_q_id string, representative_question string, raw_frequency long")
    assert rows(freq.dedup(faq), "unique_q_id", "raw_frequency") == [("2", 9), ("3", 1)]
    assert rows(freq.ranked(faq), "unique_q_id", "rank") == [("1", 2), ("2", 1), ("3", 3), ("4", 4)]
    assert rows(freq.duplicates(faq), "unique_q_id", "keep") == [("1", False), ("2", True), ("3", True), ("4", True)]
    assert freq.dedup(faq.where("false")).count() == 0 and freq.ranked(faq.where("false")).count() == 0


def test_global_rank(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert rank.global_rank(df, [F.desc("v")]).where("rank <> 1000 - v").count() == 0


def test_corpus(spark, rows):
    terms = spark.createDataFrame([("market", False), ("contact no", True), ("ok", False)], "term string, is_phrase boolean")
    faq = spark.createDataFrame([(1, "Market?", None), (2, "markets", None), (3, "supermarket", None), (4, "contact northern office", None), (5, "ok then", None), (6, None, "the market"), (7, "", "")], "id int, representative_question string, cluster_label string")
    assert rows(corpus.mark(faq, terms), "id", "irrelevant") == [(1, True), (2, False), (3, False), (4, True), (5, False), (6, True), (7, False)]
    assert rows(corpus.mark(faq, terms, inline=1), "id", "irrelevant") == rows(corpus.mark(faq, terms), "id", "irrelevant")  # by joins
    kept, removed = corpus.filtered(faq, terms)
    assert kept.count() + removed.count() == faq.count()
    assert [r[0] for r in rows(corpus.mark(faq, terms, threshold=85.0).where("irrelevant"), "id")] == [1, 2, 4, 6]
    with pytest.raises(ValueError):
        corpus.mark(faq.select("id"), terms)
    got = [round(corpus.indel_ratio(a, b), 2) for a, b in (("markett", "market"), ("weathr", "weather"), ("wheat", "heat"), ("tst", "test"), ("rein", "rain"))]
    assert got == [92.31, 92.31, 88.89, 85.71, 75.0]


@pytest.mark.parametrize("threshold", [60.0, 80.0, 85.0, 95.0])
def test_near_tokens_against_all_pairs(spark, threshold):
    import random

    r = random.Random(5)
    words = ["market", "weather", "loan", "subsidy", "price"]
    tokens = {w for x in words for w in (x, x[1:], x + "s", x[:2] + x[3:], x[:1] + "z" + x[1:], x[::-1])} | {"".join(r.choice("aeklmprst") for _ in range(r.randint(2, 9))) for _ in range(200)}
    want = {t for t in tokens if len(t) >= 3 and any(abs(len(t) - len(w)) <= 2 and corpus.indel_ratio(t, w) >= threshold for w in words)}
    df = spark.createDataFrame([(t,) for t in tokens], "token string")
    assert {x["token"] for x in corpus.near_tokens(df, words, threshold).collect()} == want


def test_tfidf(spark, rows):
    docs = spark.createDataFrame([(1, "leaf rust rust"), (2, "leaf spot"), (3, "rust spot x"), (4, None)], "id int, t string")
    v = tfidf.vocabulary(docs, "id", "t", min_df=2, max_df=1.0)
    assert rows(v, "term", "df", "tf") == [("leaf", 2, 2), ("rust", 2, 3), ("spot", 2, 2)]
    w = {(r[0], r[1]): r[2] for r in rows(tfidf.weights(docs, "id", "t", v))}
    assert abs(w[(1, "rust")] - 2 / 5**0.5) < 1e-9
    assert rows(tfidf.keywords(tfidf.weights(docs, "id", "t", v), "id", 1)) == [(1, "rust"), (2, "leaf"), (3, "rust")]


def test_cluster_numbers(spark, rows):
    sizes = spark.createDataFrame([(k, s) for k, s in enumerate([50, 30, 15, 4, 1])], "cluster_id long, count long")
    m = cluster.metrics(sizes).first()
    assert (m["n_clusters"], m["clusters_for_85pct"], m["median_cluster_size"], m["noise_ratio"]) == (5, 3, 15.0, 0.0)
    noise = cluster.metrics(spark.createDataFrame([(-1, 5), (-1, 1)], "cluster_id long, count long")).first()
    assert (noise["n_clusters"], noise["noise_ratio"], noise["coverage_efficiency"]) == (0, 1.0, 0.0)
    c = sizes.withColumnRenamed("count", "size")
    assert [r[0] for r in rows(cluster.coverage_capped(c, 0.8), "cluster_id")] == [0, 1]
    assert cluster.coverage_capped(spark.createDataFrame([(1, 90), (2, 10)], "cluster_id long, size long"), 0.8).count() == 2
    assert cluster.coverage_capped(c, 1.0).count() == 5
    n = spark.createDataFrame([(49,), (50,), (1000,), (1001,)], "n int")
    assert [r[0] for r in n.select(cluster.viability(F.col("n"), F.lit(0.0), F.lit(5))).collect()] == ["Too few clusters", "Viable", "Viable", "Too many clusters"]
    assert [cluster.param_grid(spark, g).count() for g in ("quick", "medium", "full", "exhaustive")] == [9, 108, 420, 3780]


def test_own_clusters_and_nearest(spark, rows):
    a = spark.createDataFrame([("a", 0, 1, [0.0, 0.0]), ("b", 1, 1, [5.0, 5.0]), ("c", -1, 51, [1.0, 0.0]), ("d", -1, 50, [4.0, 4.0])], "query_text string, cluster_id long, count long, v array<double>")
    own = cluster.own_clusters(a)
    assert rows(own, "query_text", "cluster_id") == [("a", 0), ("b", 1), ("c", 2), ("d", -1)]
    near = similarity.nearest(own.where("cluster_id < 0"), own.where("cluster_id >= 0"), "query_text", "v", "cluster_id")
    assert rows(near, "query_text", "nearest_id", "cluster_id") == [("d", "b", 1)]


def test_pairs_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8))
    df = spark.createDataFrame([(k, v.tolist(), k % 3) for k, v in enumerate(x)], "id long, v array<double>, g int")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if u[i] @ u[j] >= 0.7}
    assert {(r["a"], r["b"]) for r in similarity.similar_pairs(df, "id", "v", 0.7, block=64).collect()} == want
    assert {(r["a"], r["b"]) for r in similarity.similar_pairs(df, "id", "v", 0.7, "g", block=64).collect()} == {(i, j) for i, j in want if i % 3 != j % 3}
    zero = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None)], "id long, v array<double>")
    assert similarity.similar_pairs(zero, "id", "v", 0.5).count() == 0


def test_greedy_merges():
    pairs = [(0, 1, 0.95), (1, 2, 0.94), (2, 3, 0.93)]
    assert repair.greedy_merges(pairs, {0: 4, 1: 3, 2: 2, 3: 1}) == {1: 0, 3: 2}
    assert repair.greedy_merges(pairs, {0: 4, 1: 3, 2: 2, 3: 1}, lambda a, b: False) == {}
    assert unique.merge_groups(np.array([[1.0, 0], [1, 0.1], [0, 1]]), 0.9) == [[0, 1], [2]]


def test_merges_in_rounds_are_those_of_the_serial_walk(spark):
    import random

    for seed in range(4):
        r = random.Random(seed)
        freq = {k: r.choice([1, 2, 2, 5, 9]) for k in range(40)}
        pairs = sorted({(min(a, b), max(a, b)) for a, b in ((r.randrange(40), r.randrange(40)) for _ in range(90)) if a != b})
        pairs = [(a, b, r.choice([0.95, 0.96, 0.97, 0.99])) for a, b in pairs]
        got = unique.cross_cluster(spark.createDataFrame(pairs, "a long, b long, similarity double"), spark.createDataFrame(list(freq.items()), "key long, freq long"))
        assert {x["key"]: x["_to"] for x in got.collect()} == repair.greedy_merges(pairs, freq)
    none = unique.cross_cluster(spark.createDataFrame([], "a long, b long, similarity double"), spark.createDataFrame([(1, 2)], "key long, freq long"))
    assert none.count() == 0


def test_contamination_and_split(spark, rows):
    m = spark.createDataFrame([(1, q, 1) for q in "abcd"] + [(2, q, 1) for q in "ef"], "cluster_id long, question string, count long")
    bad = spark.createDataFrame([(1, "a"), (1, "b"), (2, "e")], "cluster_id long, question string")
    assert rows(repair.without_flagged(m, bad), "cluster_id", "question") == [(1, "c"), (1, "d"), (2, "e"), (2, "f")]
    assert rows(repair.without_flagged(m, bad, True), "cluster_id", "question") == [(1, "c"), (1, "d")]
    groups = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (1, 3, "d")], "cluster_id long, group_no int, question string")
    assert {r["cluster_id"] for r in repair.split(m, groups).collect()} == {1, 2}  # lone groups join the largest: one group, no split
    groups = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (1, 2, "d")], "cluster_id long, group_no int, question string")
    assert rows(repair.split(m, groups), "cluster_id", "question", "parent_cluster") == [(2, "e", None), (2, "f", None), (3, "a", 1), (3, "b", 1), (4, "c", 1), (4, "d", 1)]


def test_summary_keeps_separators_and_parent_zero(spark):
    m = spark.createDataFrame([(1, "a | b", 3, "l", "a | b", 0, None), (2, "c", 1, "m", "c", None, [3, 4])], "cluster_id long, question string, count long, label string, representative string, parent_cluster long, merged_from array<long>")
    r = {x["cluster_id"]: x for x in repair.repaired(m).collect()}
    assert r[1]["all_unique_questions"] == ["a | b"] and r[1]["was_split"] and not r[2]["was_split"]
    assert (r[1]["pct_of_total"], r[2]["rank"], r[2]["merged_from"]) == (75.0, 2, "3,4")


def test_back_map(spark, rows):
    log = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z")], "id int, query_text string")
    c = spark.createDataFrame([(7, "a", "l", "a"), (5, "a", "k", "b"), (7, "b", "l", "a")], "cluster_id long, question string, label string, representative string")
    assert rows(repair.back_map(log, c), "id", "final_cluster_id", "is_representative") == [(1, 5, True), (2, 7, True), (3, None, False), (4, None, False)]


def test_roll_up_tie_and_checks(spark):
    m = spark.createDataFrame([(1, 1, 1, "x", 3), (1, 1, 2, "y", 3), (1, 2, 3, "z", 2), (2, 1, 1, "o", 0)], "cluster_id long, group_no int, position int, question string, freq long")
    g = unique.roll_up(m)
    r = {(x["cluster_id"], x["group_no"]): x for x in g.collect()}
    assert r[(1, 1)]["representative_question"] == "x" and r[(1, 1)]["pct_of_cluster_volume"] == 75.0 and r[(2, 1)]["pct_of_cluster_volume"] == 0.0
    v = unique.verification(g, 8, 4).first()
    assert v["frequency_ok"] and v["n_groups"] == 3 and v["reduction"] == 0.25


def test_scores(spark):
    c = spark.createDataFrame([(1, 1.0, 0.0, 60), (1, 0.7, 0.0, 30), (1, 0.2, 0.0, 10)], "k int, coherence double, outlier double, weight long")
    p = spark.createDataFrame([(1, 0.6, 0.0)], "k int, separation double, merge double")
    s = evaluate.scores(c, p, "k").first()
    assert round(s["coherence_mean"], 6) == 0.83 and round(s["composite"], 6) == round(0.45 * 0.6 + 0.3 * 0.83 + 0.25, 6)
    pairs = evaluate.sized_pairs(list(range(10, 21)), [10] + [1] * 10)
    assert len(pairs) == 5 and all(a != b for a, b in pairs)  # half as many as clusters
    assert len(evaluate.sized_pairs(list(range(300)), [0] * 300)) == 50 and evaluate.sized_pairs([1], [5]) == []
    rng = np.random.default_rng(42)  # two vectors, one after the other
    p = np.array([10] + [1] * 10) / 20
    a, b = rng.choice(11, 5, p=p), rng.choice(11, 5, p=p)
    assert pairs == [(10 + i, 10 + (j if i != j else (j + 1) % 11)) for i, j in zip(a.tolist(), b.tolist())]


def test_viability_and_strata(spark, rows):
    n = spark.createDataFrame([(60, 0.31, 9), (60, 0.3, 4), (60, 0.3, 5)], "n int, noise double, c int")
    assert [r[0] for r in n.select(cluster.viability(F.col("n"), F.col("noise"), F.col("c"))).collect()] == ["High noise ratio", "Poor coverage efficiency", "Viable"]
    grid = cluster.param_grid(spark, "medium").withColumns({"coverage_efficiency": F.col("config_id") / 108, "clusters_for_85pct": F.lit(10), "noise_ratio": F.lit(0.1)})
    got = {r["stratum"]: set() for r in cluster.strata(grid).collect()}
    for r in cluster.strata(grid).collect():
        got[r["stratum"]].add(r["config_id"])
    assert got["top"] == set(range(100, 108)) and got["bottom"] == {0} and len(got["middle"]) == 4 and len(got["diverse"]) == 2
    assert got["middle"] == {107 - i for i in range(54 - 16, 54 + 16, 8)}
    assert cluster.strata(grid.where("config_id < 3")).count() == 3 and cluster.strata(grid.where("false")).count() == 0


def test_a_split_keeps_an_index_named_twice(spark, rows):
    raw = '[{"group":1,"label":"p","indices":[1,1,2]},{"group":2,"label":"q","indices":[3,1]}]'
    df = spark.createDataFrame([(1, raw, 4)], "cluster_id long, raw string, n int")
    assert rows(unique.split_groups(df)) == [(1, 1, "p", 0), (1, 1, "p", 0), (1, 1, "p", 1), (1, 1, "p", 3), (1, 2, "q", 2)]
    assert rows(unique.parse_groups(df)) == [(1, 1, "p", 0), (1, 1, "p", 1), (1, 2, "q", 2), (1, 3, "(unclassified)", 3)]


def test_density():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.1, size=(30, 2)) for c in ((0, 0), (5, 5), (0, 8))] + [np.array([[20.0, -20.0]])])
    labels = density.hdbscan(x, 5, 5)
    assert len(set(labels[:30])) == len(set(labels[30:60])) == len(set(labels[60:90])) == 1
    assert len(set(labels[[0, 30, 60]])) == 3 and labels[-1] == -1
    assert (density.hdbscan(np.zeros((20, 3)), 3, 2) >= -1).all() and (density.hdbscan(np.zeros((1, 3))) == -1).all()


def test_grid_depends_on_alpha_and_neighbours(spark):
    """Vectors tell two groups apart, terms two others: alpha decides which are found; the number of neighbours changes the coordinates."""
    rng = np.random.default_rng(3)
    n = 60
    x = np.array([[1.0, 0.0] if k % 2 else [0.0, 1.0] for k in range(n)]) + rng.normal(0, 0.05, (n, 2))
    terms = [["rust", f"r{k % 5}"] if k < n // 2 else ["borer", f"b{k % 5}"] for k in range(n)]
    df = spark.createDataFrame([(k, x[k].tolist(), terms[k]) for k in range(n)], "id long, v array<double>, t array<string>")
    grid = spark.createDataFrame([(0, 1.0, 5, 3, 8, 2), (1, 0.0, 5, 3, 8, 2), (2, 1.0, 5, 3, 25, 2)], "config_id int, alpha double, min_cluster_size int, min_samples int, n_neighbors int, n_components int")
    got = {}
    for r in density.grid_labels(df, grid, "id", "v", "t").collect():
        got.setdefault(r["config_id"], {})[r["id"]] = r["cluster_id"]
    assert all(len(v) == n for v in got.values())

    def apart(labels, by):
        """No cluster has members of both sides."""
        return all(len({by(k) for k in labels if labels[k] == c}) == 1 for c in set(labels.values()) - {-1})

    assert apart(got[0], lambda k: k % 2) and apart(got[1], lambda k: k < n // 2) and not apart(got[0], lambda k: k < n // 2)
    graphs = [density.neighbour_graph(x, terms, 0.5, k) for k in (8, 25)]
    assert all((np.bincount(g[0]) == k).all() for g, k in zip(graphs, (8, 25)))
    assert not np.allclose(density.reduce(graphs[0], n, 2), density.reduce(graphs[1], n, 2))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    i, j, d = (z[11] for z in graphs[0])
    a, b = set(terms[i]), set(terms[j])
    assert d == pytest.approx(0.5 * (1 - u[i] @ u[j]) + 0.5 * (1 - len(a & b) / len(a | b)))
    with pytest.raises(ValueError):
        density.grid_labels(df, grid, "id", "v", "t", most=10)


def test_pipeline(spark, tmp_path):
    texts = ["rust on wheat leaf", "rust of wheat leaf", "wheat leaf rust", "termite in wheat roots", "termites in wheat roots", "wheat roots termite", "market rate"]
    log = spark.createDataFrame([(k, "Wheat", t) for k, t in enumerate(texts * 3)], "raw_row_id long, crop string, query_text string")
    terms = spark.createDataFrame([("market", False)], "term string, is_phrase boolean")
    p = Pipeline(spark, str(tmp_path / "run"), Settings("Wheat"))
    out = p.run(log, terms)
    assert out.count() == p.stages.read("faq").count() >= 2
    assert "market rate" in {r["representative_question"] for r in p.stages.read("filtered_out").collect()}
    assert p.stages.read("row_mapping").count() == len(texts) * 3
    again = Pipeline(spark, str(tmp_path / "run"), Settings("Wheat"), judge=None)
    again.frequency = again.screen = again.faq = None  # with resume no stage is run again
    assert again.run(log, terms, resume=True).count() == out.count()


def test_judge_sees_all_distinct_questions(spark):
    class Tail:
        def reply(self, prompts):
            return ["C" if "tail" in p and "one and the same" in p else "A" for p in prompts]

    m = spark.createDataFrame([(1, f"q{k}", 100 - k) for k in range(30)] + [(1, "odd tail", 1), (2, "same", 2), (2, " Same ", 1)], "cluster_id long, question string, count long")
    assert evaluate.evaluate(m.where("cluster_id = 1"), Tail()).first()["coherence_mean"] == pytest.approx(0.2)
    assert evaluate.evaluate(m.where("cluster_id = 2"), Tail()).first()["coherence_mean"] == 0.0  # one distinct question: not asked


def test_merge_pass(spark):
    class Merges:
        def reply(self, prompts):
            return ["A" if "become one" in p and "rust" in p else "B" for p in prompts]

    texts = {1: ["rust spots", "rust leaves"], 2: ["rust stripes", "rust powder"], 3: ["termite roots", "termite mounds"], 4: ["termite attack", "termite wings"]}
    m = spark.createDataFrame([(c, q, 1) for c, qs in texts.items() for q in qs], "cluster_id long, question string, count long")
    s = evaluate.evaluate(m, Merges()).first()
    assert s["merge_rate"] == 0.5
    assert s["composite"] == pytest.approx(0.45 * s["separation_mean"] + 0.3 * s["coherence_mean"] + 0.25 * (1 - s["outlier_rate"]) - 0.2 * 0.5)


def scripted():
    class Scripted:
        """Finds paddy off the crop, tells rust from termites, merges nothing but spellings of one question."""

        def reply(self, prompts):
            return [self.one(p) for p in prompts]

        def one(self, p):
            lines = [x.strip() for x in p.split("\n") if x.strip()[:1].isdigit()]
            if "another crop" in p:
                return '{"off": [%s]}' % ", ".join(x.split(".")[0] for x in lines if "paddy" in x)
            if "into one group" in p:  # grouping and splitting
                parts = [[x.split(".")[0] for x in lines if w in x] for w in ("rust", "termite")]
                return "[%s]" % ", ".join('{"group": %d, "label": "%s", "indices": [%s]}' % (k, ("spray", "drench")[k], ", ".join(i)) for k, i in enumerate(parts) if i)
            if "one and the same" in p:
                return "C" if "rust" in p and "termite" in p else "A"
            if "become one" in p:
                return "B"
            return "A" if "same advice" in p else "B"

    return Scripted()  # a local class is sent to the workers by value


def test_pipeline_asks_the_judge(spark, tmp_path):
    texts = [f"wheat rust leaf {w}" for w in "a b c d e f g h i j k l m n".split()] + ["termite in wheat roots", "termites eat wheat roots", "paddy seed rate"]
    log = spark.createDataFrame([(k, "Wheat", t) for k, t in enumerate(texts * 2)], "raw_row_id long, crop string, query_text string")
    p = Pipeline(spark, str(tmp_path / "run"), Settings("Wheat", group_sim=0.7, dedup_threshold=1.1), judge=scripted())
    p.stages.write("labels", p.frequency(log).select(F.lit(0).alias("config_id"), "query_text", F.lit(0).cast("long").alias("cluster_id"), "count"))
    m = p.repair(0).collect()
    assert {r["question"] for r in m} == set(texts) - {"paddy seed rate"}
    assert {(r["cluster_id"], r["parent_cluster"], r["label"], "rust" in r["question"]) for r in m} in ({(1, 0, "spray", True), (2, 0, "drench", False)}, {(2, 0, "spray", True), (1, 0, "drench", False)})
    faq = p.faq(spark.createDataFrame([("market", False)], "term string, is_phrase boolean")).collect()
    assert sorted((r["answer_label"], r["raw_frequency"], r["n_questions_in_group"]) for r in faq) == [("drench", 4, 2), ("spray", 28, 14)]
    assert {r["was_split"] for r in p.stages.read("repaired").collect()} == {True}


def test_models(spark):
    df = embedded(spark.createDataFrame([(1, "a b"), (2, None)], "id int, t string"), "t", HashedWords(8))
    assert [len(r["embedding"]) for r in df.collect()] == [8, 8]
    faq = spark.createDataFrame([("1", "how much water?", 3)], "unique_q_id string, representative_question string, raw_frequency long")
    r = qa.answers(faq, "Maize", Echo()).first()
    assert r["generated_category"] == "Other" and "how much water?" in r["generated_question"]
    m = spark.createDataFrame([(c, f"q{c}{k}", 1) for c in (1, 2) for k in range(4)], "cluster_id long, question string, count long")
    assert evaluate.evaluate(m, SameLetter("A")).first()["coherence_mean"] == 1.0


def test_batches(spark, rows):
    from askmill.operators.models import Deferred, judged_in_batches

    df = spark.createDataFrame([(k, f"prompt {k}", 300) for k in range(7)], "cluster_id int, prompt string, budget int").coalesce(1)
    service = Deferred(SameLetter('[{"group": 1, "label": "l", "indices": [1, 2]}]'), fails="prompt 3")
    out = judged_in_batches(df, "prompt", service, "budget", size=3, wait=0.0)
    assert {r["cluster_id"] for r in out.where("reply is null").collect()} == {3} and out.count() == 7
    groups = unique.parse_groups(out.select("cluster_id", F.col("reply").alias("raw"), F.lit(2).alias("n")))
    assert rows(groups.where("cluster_id = 3"), "idx", "answer_label") == [(0, "(unclassified)"), (1, "(unclassified)")]
    assert {r[0] for r in rows(groups.where("cluster_id = 4"), "answer_label")} == {"l"}


def test_stream(spark, tmp_path):
    import datetime as dt

    src = str(tmp_path / "in")
    t = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("1", "a", t), ("1", "a", t), ("2", "a", t), ("3", None, t)], "call_id string, query_text string, received_at timestamp").write.parquet(src)
    stream = spark.readStream.schema("call_id string, query_text string, received_at timestamp").parquet(src)
    q = streaming.frequency(streaming.once_per_call(stream), late=None).writeStream.outputMode("append").format("memory").queryName("freqs").start()
    q.processAllAvailable()
    q.stop()
    u = streaming.frequency(spark.read.parquet(src).dropDuplicates(["call_id"]))
    assert [(r["query_text"], r["count"]) for r in u.collect()] == [("a", 2)]
