"""Hand-derived edge rows (FIXTURES.md, part C)."""

from pyspark.sql import functions as F

from askmill.functions import replies, text
from askmill.operators import unique
from askmill.sources import io


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v"))).first()[0]


def test_strip_clean_slug(spark):
    assert one(spark, "\t Fall\u00a0Armyworm\n\u00a0", text.norm_key) == "fall\u00a0armyworm"
    assert [one(spark, v, text.slug) for v in ("Maize Makka", "Paddy (Dhan)", "  A--B ")] == ["maize_makka", "paddy_dhan", "a_b"]
    stop = ("to", "in", "crop")
    assert one(spark, "How to control Stem-borer in  Crop no. 12?", lambda c: text.clean(c, stop)) == "how control stem borer no"
    assert one(spark, "rust rust", text.clean) == "rust rust"
    assert one(spark, None, text.clean) == ""
    assert one(spark, " (Paddy (Dhan)) ", text.crop_norm) == "Paddy Dhan"


def test_letters_and_outliers(spark):
    assert [one(spark, v, replies.letter) for v in ("B", "Answer: B", "no idea", "", "xyz", None)] == ["B", "A", "A", "C", "C", "C"]
    got = [one(spark, v, lambda c: replies.outlier(c, F.lit(4))) for v in ("3", "N", "7", "7 2", "None", None)]
    assert got == [2, -1, -1, 1, -1, -1]


def test_groups(spark, rows):
    raw = 'x [{"group":1,"label":"p","indices":[1,"2",9]},{"group":2,"label":"q","indices":[2,3]}] y'
    df = spark.createDataFrame([(1, raw, 4), (2, "none", 2), (3, None, 1)], "cluster_id long, raw string, n int")
    assert rows(unique.parse_groups(df)) == [(1, 1, "p", 0), (1, 1, "p", 1), (1, 2, "q", 2), (1, 3, "(unclassified)", 3), (2, 1, "(unclassified)", 0), (2, 2, "(unclassified)", 1), (3, 1, "(unclassified)", 0)]
    assert rows(unique.split_groups(df).where("cluster_id = 1")) == [(1, 1, "p", 0), (1, 1, "p", 1), (1, 1, "p", 3), (1, 2, "q", 2)]
    assert {r[1] for r in rows(unique.split_groups(df).where("cluster_id = 2"))} == {1}


def test_qa_parse(spark):
    def parse(raw):
        q, c, a = replies.qa_fields(F.col("v"))
        return tuple(spark.createDataFrame([(raw,)], "v string").select(q, c, a).first())

    assert parse("CATEGORY: Pest\nQUESTION: q?\nANSWER:\nfoo") == ("q?", "Pest", "foo")
    assert parse("```markdown\n**CATEGORY**: Pest\n**QUESTION**: q?\n**ANSWER**:\nfoo\nbar\n```") == ("q?", "Pest", "foo\nbar")
    js = '{"category": "IRRELEVANT_CROP", "answer": ""}'
    assert parse(js) == ("", "PARSE_ERROR", js)
    assert parse("QUESTION: only") == ("only", "Other", "QUESTION: only")


def test_other_crops_and_hints(spark):
    assert "Paddy" not in replies.other_crops("Rice") and "Maize" in replies.other_crops("Rice")
    assert "Maize" not in replies.other_crops("Maize Makka")
    rules = [(["tur"], "pulses"), (["turmeric"], "spice")]
    assert one(spark, "Turmeric", lambda c: replies.hint(c, rules, "none")) == "pulses"
    assert one(spark, "Okra", lambda c: replies.hint(c, rules, "none")) == "none"


def test_query_column():
    assert io.query_column(["a", "QueryText"]) == "QueryText"
    assert io.query_column(list("abcdefghijk")) == "i"
    assert io.query_column(["A", "My Query"], "my query") == "My Query"


def test_csv_stages_terms(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text('crop,query_text,n\nMaize,"two\nlines, ""quoted""",1\nNA,null,\n', encoding="utf-8")
    assert [tuple(r) for r in io.read_log(spark, str(p)).collect()] == [("Maize", 'two\nlines, "quoted"', "1"), (None, None, None)]
    stages = io.Stages(spark, str(tmp_path / "stages"))
    first = stages.write("t", spark.range(3).toDF("k"))
    second = stages.write("t", first.where("k > 0"))  # replaces what it reads
    assert sorted(r[0] for r in second.collect()) == [1, 2]
    assert [r[0] for r in stages.resume("t", spark.range(4).toDF("k"), "k").orderBy("k").collect()] == [0, 3]
    y = tmp_path / "c.yaml"
    y.write_text("categories:\n  a:\n    keywords: [Market, ' contact no ', 5, '']\n    typos: [markat, market]\nmin_word_length: 4\n")
    terms, least = io.load_terms(spark, str(y))
    assert least == 4 and sorted(tuple(r) for r in terms.collect()) == [("contact no", True), ("markat", False), ("market", False)]
