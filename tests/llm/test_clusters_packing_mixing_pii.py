"""Problems 5 to 8: invariants, brute force, edge rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from askmill.llm import mixing, note_clusters, packing, pii, queries
from askmill.llm.pii_training import examples


# --- clusters ------------------------------------------------------------------------------------------------------------------------

MATTERS = {
    1: ("onion", ["thrips", "silver streak"], ["silvery flecks", "tips twisted", "necks folded"]),
    2: ("onion", ["bolting", "early stalks"], ["woody core", "cold nights", "thick bulbs"]),
    3: ("wheat", ["yellow rust", "stripe rust"], ["orange dust", "powder lines", "damp mornings"]),
    4: ("wheat", ["termite attack", "white ants"], ["mud galleries", "hollow roots", "pulled seedlings"]),
}


def notes(n=600, seed=2):
    r, out = random.Random(seed), []
    for k in range(n):
        m = r.choice(list(MATTERS))
        crop, names, signs = MATTERS[m]
        name = "".join(r.choice("bdgk") + r.choice("aeiou") for _ in range(4))
        out.append((k, crop, f"farmer from {name} asks how to control {r.choice(names)} in {crop}, {' and '.join(r.sample(signs, r.randint(1, 2)))}, sown {name}x", m))
    for k in range(n, n + 60):
        out.append((k, None, "Weather information wanted", 5))
    return out


def test_clusters(spark):
    data = notes()
    extra = [(9000, "onion", None, 0), (9001, None, "", 0), (9002, None, "qzx vbn wpt", 0), (9003, "wheat", "?!", 0), (9004, "x", "lorem " * 20_000, 0)]
    log = spark.createDataFrame(data + extra, "raw_row_id long, crop string, query_text string, cluster_id long")
    reps = spark.createDataFrame([(m, f"asks cure for {names[0]} of {crop}, {signs[0]}") for m, (crop, names, signs) in MATTERS.items()] + [(5, "Weather information wanted"), (6, None), (7, "no such matter")], "cluster_id long, representative string")
    truth = {r[0]: r[3] for r in data}
    got = {r["raw_row_id"]: r["cluster_id"] for r in note_clusters.clustered(log, reps).collect() if r["cluster_id"] is not None}
    right = sum(truth.get(k) == v for k, v in got.items())
    assert right >= 0.97 * len(truth) and right == len(got)
    assert note_clusters.clustered(log.where("false"), reps).count() == 0


@pytest.fixture(scope="module")
def matters(spark, tmp_path_factory):
    """The tables of problem 5: matter 3 has two representatives, and some notes are of no matter on file."""
    d = str(tmp_path_factory.mktemp("matters"))
    more = [(20_000 + k, "rice", f"farmer number {k} reports blast lesions in rice, spindle spots") for k in range(40)]
    log = spark.createDataFrame([r[:3] for r in notes()] + more, "raw_row_id long, crop string, query_text string")
    log.write.parquet(f"{d}/raw_log.parquet")
    reps = [(m, f"asks cure for {names[0]} of {crop}, {signs[0]}") for m, (crop, names, signs) in MATTERS.items()] + [(8, "asks cure for stripe rust of wheat, powder lines, damp mornings")]
    spark.createDataFrame([(m, 1, r) for m, r in reps], "cluster_id long, size long, representative string").write.parquet(f"{d}/repaired_clusters.parquet")
    return d


def test_sizes_are_those_of_the_ids(spark, matters):
    want = {r[0]: r[1] for r in queries.p5_found(spark, matters).groupBy("cluster_id").count().collect()}
    got = [(r["cluster_id"], r["size"]) for r in queries.p5_clusters(spark, matters).collect() if r["cluster_id"] is not None]
    assert {3, 8} <= set(want) and len(got) == len(want) and dict(got) == want


def test_three_typical_notes(spark, matters):
    rows = queries.p5_clusters(spark, matters).collect()
    of = {r["raw_row_id"]: r["cluster_id"] for r in queries.p5_found(spark, matters).collect()}
    texts = {r["raw_row_id"]: r["query_text"] for r in spark.read.parquet(f"{matters}/raw_log.parquet").collect()}
    for r in rows:
        k = len({n["query_text"] for n in r["notes"]})
        assert [n["position"] for n in r["notes"]] == list(range(1, k + 1)) and (k == 3 or r["cluster_id"] is None)  # the weather notes are one text
        assert all(texts[n["raw_row_id"]] == n["query_text"] and of.get(n["raw_row_id"]) == r["cluster_id"] for n in r["notes"])
        assert (r["medoid_row_id"], r["medoid"]) == (r["notes"][0]["raw_row_id"], r["notes"][0]["query_text"])
    assert {r["cluster_id"] for r in rows} >= {1, 2, 3, 4, 8}
    log, reps = (spark.read.parquet(f"{matters}/{t}.parquet") for t in ("raw_log", "repaired_clusters"))
    assert note_clusters.summed(log.where("false"), reps).count() == 0


def items(spark, vectors):
    return spark.createDataFrame([(k, float(v.pop("", 1.0)), list(v), [x / sum(y * y for y in v.values()) ** 0.5 for x in v.values()]) for k, v in vectors.items()], "id long, weight double, ws array<string>, xs array<double>")


def random_vectors(n, seed):
    r = random.Random(seed)
    return {k: {f"w{w}": r.uniform(0.5, 3) for w in r.sample(range(12), r.randint(1, 5))} for k in r.sample(range(-10_000, 10_000), n)}


def cosines(vectors):
    norm = {k: sum(x * x for x in v.values()) ** 0.5 for k, v in vectors.items()}
    return {(a, b): sum(x * vectors[b].get(w, 0.0) for w, x in vectors[a].items()) / norm[a] / norm[b] for a in vectors for b in vectors if a != b}


@pytest.mark.parametrize("block", [2048, 5])
def test_neighbours_are_all_found(spark, block):
    v = random_vectors(60, 1)
    want = {k for k, s in cosines(v).items() if s >= 0.45}
    got = {(r["a"], r["b"]): r["s"] for r in note_clusters.neighbours(items(spark, v), 0.45, block).collect()}
    assert set(got) == want and all(abs(got[k] - cosines(v)[k]) < 1e-4 for k in got)


def test_pivots_are_those_of_the_serial_algorithm(spark):
    v = random_vectors(60, 2)
    near = {k for k, s in cosines(v).items() if s >= 0.45}
    kept = []
    for k in sorted(v):
        if not any((k, p) in near for p in kept):
            kept.append(k)
    got = {r["id"]: r["pivot"] for r in note_clusters.pivots(items(spark, v), 0.45).collect()}
    assert sorted(set(got.values())) == kept and set(got) == set(v) and all(got[p] == p for p in kept)
    assert all(k == p or (k, p) in near for k, p in got.items())


def test_pivots_by_weight(spark):
    v = {1: {"a": 1.0, "b": 1.0, "": 1.0}, 2: {"b": 1.0, "c": 1.0, "": 9.0}, 3: {"c": 1.0, "d": 1.0, "": 2.0}, 4: {"x": 1.0, "": 0.5}}
    got = {r["id"]: r["pivot"] for r in note_clusters.pivots(items(spark, v), 0.4, heaviest=True).collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 4}


def test_sums_and_medoids(spark):
    words = note_clusters.Words({"thrips": 3.0, "streak": 2.0, "onion": 1.0, "rust": 3.0, "wheat": 1.0}, frozenset(("onion", "wheat")))
    texts = spark.createDataFrame([("thrips in onion streak", 5), ("onion thrips", 3), ("streak of onion", 1), ("rust of wheat", 4), ("onion", 9)], "text string, n long")
    nodes = note_clusters.cores(texts, words)
    assert {r["core"]: r["n"] for r in nodes.collect()} == {"onion streak thrips": 5, "onion thrips": 3, "onion streak": 1, "rust wheat": 4}
    got = {r["medoid"]: round(r["weight"], 3) for r in note_clusters.clusters(nodes).collect()}
    assert set(got) == {"onion streak thrips", "rust wheat"} and 7 < got["onion streak thrips"] <= 9 and got["rust wheat"] == 4


# --- packing -------------------------------------------------------------------------------------------------------------------------


def brute_first_fit(sizes, capacity):
    room, out = [], []
    for s in sizes:
        k = next((k for k, x in enumerate(room) if x >= s), len(room))
        if k == len(room):
            room.append(capacity)
        room[k] -= s
        out.append(k)
    return out


def test_first_fit():
    r = random.Random(4)
    for n in (0, 1, 7, 300):
        sizes = sorted((r.randint(0, 100) for _ in range(n)), reverse=True)
        assert packing.first_fit(sizes, 100) == brute_first_fit(sizes, 100)


def test_pack(spark):
    r = random.Random(5)
    docs = [(k, "ä" * r.randint(0, 60) + "x" * r.randint(0, 99)) for k in range(300)] + [(900, None), (901, ""), (902, "y" * 1234), (903, "z" * 400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("tokens", F.lit(1)).withColumn("capacity_id", F.lit(1))
    caps = spark.createDataFrame([(1, 200), (2, 1000), (3, None), (4, 0), (1, 200)], "capacity_id int, capacity_tokens long")
    rows = packing.pack(df, caps, group=100).collect()
    size = {k: len((t or "").encode()) for k, t in docs}
    for c, capacity in ((1, 200), (2, 1000)):
        mine = [x for x in rows if x["capacity_id"] == c]
        used, whole, pieces = defaultdict(int), defaultdict(int), defaultdict(int)
        for x in mine:
            used[(x["group_no"], x["container_no"])] += x["tokens"]
            whole[x["doc_id"]] += x["tokens"]
            pieces[x["doc_id"]] += 1
        assert dict(whole) == size and max(used.values()) <= capacity
        assert all(n == 1 or size[k] > capacity for k, n in pieces.items())
        assert len(used) <= -(-sum(size.values()) // capacity) * 1.1 + 4
    assert {x["capacity_id"] for x in rows} == {1, 2}
    assert packing.pack(df.where("false"), caps).count() == 0 and packing.pack(df, caps.where("false")).count() == 0
    summary = {x["capacity_id"]: x for x in packing.filling(packing.pack(df, caps, group=100), caps.where("capacity_tokens > 0")).collect()}
    assert summary[1]["tokens"] == sum(size.values()) and summary[1]["fullest"] <= 200


# --- mixing --------------------------------------------------------------------------------------------------------------------------


def test_budgets():
    assert [round(x) for x in mixing.budgets(100, [0.5, 0.5], [200, 200])] == [50, 50]
    assert [round(x) for x in mixing.budgets(100, [0.5, 0.3, 0.2], [20, 200, 200])] == [20, 45, 35]
    assert [round(x) for x in mixing.budgets(100, [0.5, 0.5], [0, 200])] == [0, 100]
    assert mixing.budgets(0, [], []) == []


def test_mix(spark):
    r = random.Random(6)
    docs = [(k, "word%d " % r.randrange(50) * r.randint(1, 30), s) for k, s in enumerate(["A"] * 400 + [" a "] * 20 + ["b"] * 60 + ["c"] * 3 + [None] * 9)] + [(900, None, "a"), (901, "", "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("key", F.lit(1)).withColumn("tokens", F.lit(5)).withColumn("w", F.lit(0))
    targets = spark.createDataFrame([("m", "a", 0.5, 2), ("m", "b", 0.3, 4), ("m", "c", 0.1, 3), ("m", "none", 0.1, 9), ("n", "b", 1.0, 1)], "mix_id string, source string, target_share double, max_repeats int")
    size = {k: len((t or "").encode()) for k, t, _ in docs}
    name = {k: (s or "").strip().lower() for k, _, s in docs}
    rows = mixing.mix(df, targets, slice_size=50).collect()
    limit = {("m", "a"): 2, ("m", "b"): 4, ("m", "c"): 3, ("n", "b"): 1}
    assert all(x["times"] <= limit[(x["mix_id"], x["source"])] and name[x["doc_id"]] == x["source"] and x["tokens"] == size[x["doc_id"]] for x in rows)
    assert len({(x["mix_id"], x["doc_id"]) for x in rows}) == len(rows)
    for m, sources in (("m", "abc"), ("n", "b")):
        total = sum(v for k, v in size.items() if name[k] and name[k] in sources)
        got = sum(x["tokens"] * x["times"] for x in rows if x["mix_id"] == m)
        assert abs(got - total) <= 0.01 * total
    share = {(x["mix_id"], x["source"]): x for x in mixing.shares(mixing.mix(df, targets, slice_size=50), targets).collect()}
    have = {s: sum(v for k, v in size.items() if name[k] == s) for s in "abc"}
    assert share[("m", "c")]["tokens"] == 3 * have["c"] and share[("m", "none")]["tokens"] == 0
    assert abs(share[("m", "a")]["reached_share"] - 0.5 - (share[("m", "b")]["reached_share"] - 0.3)) < 0.02
    assert all(abs(x["reached_share"] - share[(x["mix_id"], x["source"])]["reached_share"]) < 1e-5 for x in rows)
    again = mixing.mix(df.repartition(7), targets, slice_size=50).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mixing.mix(df.where("false"), targets).count() == 0 and mixing.mix(df, targets.where("false")).count() == 0
