"""Problems 1 and 3 against brute force, with edge rows."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from askmill.llm import format_duplicates, near_duplicates
from askmill.llm._common import records

SPEC = "table_name string, key string, text string"
LABEL = r"(?:^|[|,;/\n])\W*(village|block|crop|issue|signs|variety|shop|product|water|age)\s*[:=\-–]"


def canon(text):
    low = text.lower()
    found = list(re.finditer(LABEL, low))
    if len(found) >= 3 and not re.search(r"[^\W_]", low[: found[0].start()]):
        ends = [m.start() for m in found[1:]] + [len(low)]
        return tuple(sorted(m.group(1) + "=" + re.sub(r"[\W_]", "", low[m.end() : e]) for m, e in zip(found, ends)))
    return re.sub(r"[\W_]", "", low)


def words(text):
    return set(re.findall(r"[^\W_]+", text.lower()))


def brute(rows):
    copies, near = set(), set()
    groups = {}
    for t, k, x in rows:
        if x and re.search(r"[^\W_]", x):
            groups.setdefault((t, canon(x)), []).append((k, x))
    for (t, _), g in groups.items():
        if len({x for _, x in g}) > 1:
            keys = sorted(k for k, _ in g)
            copies |= {(t, keys[0], k) for k in keys[1:]}
    rest = [r for r in rows if r[2] and words(r[2])]
    for (t, a, x), (u, b, y) in combinations(rest, 2):
        p, q = words(x), words(y)
        if t == u and canon(x) != canon(y) and len(p & q) >= 0.75 * len(p | q) - 1e-9:
            near.add((t, min(a, b), max(a, b)))
    return copies, near


def made(n=200, seed=3):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(n):
        if rows and r.random() < 0.5:
            old = r.choice(rows)[2].split()
            for _ in range(r.randint(0, 3)):
                old[r.randrange(len(old))] = r.choice(vocabulary)
            if r.random() < 0.3:
                r.shuffle(old)
            x = (" " if r.random() < 0.7 else " - ").join(old)
            x = x.upper() if r.random() < 0.3 else x
        else:
            x = " ".join(r.sample(vocabulary, r.randint(1, 16)))
        rows.append((r.choice(["raw_log", "unique_questions_freq"]), f"{k:04d}", x))
    labelled = "Village: A b | Block: C | Crop: Paddy | Age: 4 days"
    return rows + [
        ("raw_log", "9000", labelled), ("raw_log", "9001", "crop = paddy; age=4 DAYS; village=ab; block=c."), ("raw_log", "9002", labelled), ("raw_log", "9003", "Crop Paddy Age 4 days Village A b Block C"),
        ("raw_log", "9004", ""), ("raw_log", "9005", "  \t"), ("raw_log", "9006", "???"), ("raw_log", "9007", "long " * 30_000 + "end"), ("raw_log", "9008", "Long, " * 30_000 + "End!"), ("raw_log", "9009", "w1 w2"), ("raw_log", "9010", "w2 w1"),
    ]


def test_against_brute_force(spark, rows):
    data = made()
    copies, near = brute(data)
    df = spark.createDataFrame([*data, ("raw_log", None, "w1"), ("raw_log", "9999", None)], SPEC).where("key is not null and text is not null").where(F.col("text").rlike(r"[\p{L}\p{N}]"))
    assert set(rows(format_duplicates.copies(df))) == copies and copies
    assert set(rows(near_duplicates.pairs(df))) == near and len(near) > 20
    sets = format_duplicates.sets(df).agg(F.sum("copies")).first()[0]
    assert sets == df.count()


@pytest.mark.parametrize("rare, block", [(2, 32_768), (1, 4), (20, 3)])
def test_any_key_rule_gives_the_same(spark, rows, rare, block):
    """With hardly any rare word the keys are two and three words; with small blocks long lists are cut. The result is the same."""
    data = made(90, 5)
    _, near = brute(data)
    df = spark.createDataFrame(data, SPEC).where(F.col("text").rlike(r"[\p{L}\p{N}]"))
    assert set(rows(near_duplicates.pairs(df, rare=rare, block=block))) == near
    lists = near_duplicates.lists(near_duplicates.index(df, rare=rare, block=block)).first()
    assert lists["texts"] <= lists["entries"]


def test_long_lists_are_cut(spark):
    """No list holds many more than two blocks of entries."""
    data = [("raw_log", str(k), f"alpha beta gamma delta {' '.join(f'n{k}x{j}' for j in range(2))}") for k in range(400)]
    df = spark.createDataFrame(data, SPEC)
    longest = [near_duplicates._posted(near_duplicates.index(df, rare=2, block=b), b).groupBy("key").count().agg(F.max("count")).first()[0] or 0 for b in (10_000, 20)]
    assert longest[1] <= 4 * 20 and (longest[0] >= 400 or longest[0] <= 2)


def test_word_hash_is_that_of_the_tables(spark):
    import xxhash

    got = spark.createDataFrame([("wheat",), ("गेहूं",), ("a" * 100,)], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(near_duplicates.BUCKETS)).alias("h")).collect()
    assert all(r["h"] == xxhash.xxh64_intdigest(r["w"], 42) % near_duplicates.BUCKETS for r in got)


def test_hot_text_and_repeats(spark, rows):
    data = [("raw_log", f"{k:05d}", "Weather information for next five days") for k in range(3000)] + [("raw_log", "a", "weather  information for next five days"), ("raw_log", "b", "weather information for next five days please")]
    df = spark.createDataFrame(data, SPEC)
    assert format_duplicates.copies(df).count() == 3000
    assert near_duplicates.pairs(df).count() == 3001
    same = spark.createDataFrame(data[:100], SPEC)
    assert format_duplicates.copies(same).count() == 0 and near_duplicates.pairs(same).count() == 0


def test_empty_and_clashing_columns(spark, tmp_path):
    spark.createDataFrame([], "raw_row_id long, query_text string, text string, key string, table_name string").write.parquet(str(tmp_path / "raw_log.parquet"))
    spark.createDataFrame([("1", "a b c d", "x"), ("2", "A b, c d", "y")], "unique_q_id string, representative_question string, text string").write.parquet(str(tmp_path / "unique_questions_freq.parquet"))
    df = records(spark, str(tmp_path))
    assert [tuple(r) for r in format_duplicates.copies(df).collect()] == [("unique_questions_freq", "1", "2")]
    assert near_duplicates.pairs(df).count() == 0
    none = df.where("false")
    assert format_duplicates.copies(none).count() == 0 and near_duplicates.pairs(none).count() == 0 and format_duplicates.sets(none).count() == 0


def test_signature_bound():
    """A pair within the bound never shares fewer positional bytes than guaranteed."""
    import pandas as pd

    of = near_duplicates._tokeniser({}, 0.75)
    r = random.Random(1)
    for _ in range(200):
        a = [f"v{r.randrange(500)}" for _ in range(r.randint(4, 40))]
        b = [w if r.random() < 0.9 else f"v{r.randrange(500)}" for w in a]
        out = next(of(iter([pd.DataFrame({"table_name": ["t", "t"], "text": [" ".join(a), " ".join(b)]})])))
        sig = np.ascontiguousarray(out[["sig_a", "sig_b"]].to_numpy()).view("uint8").reshape(2, 16)
        assert (sig[0] == sig[1]).sum() >= 16 - len(set(a) ^ set(b))
