"""The command line on small files."""

import pytest

from askmill.__main__ import main, parser
from askmill.sources import io


def test_options():
    a = parser().parse_args(["all", "--root", "r", "--crop", "Maize", "--raw-file", "x.csv", "--grid-mode", "full", "--merge-sim", "0.9"])
    assert (a.grid_mode, a.merge_sim, a.max_queries, a.resume, a.coherence_flag) == ("full", 0.9, 20_000, False, "C")
    for wrong in (["all", "--root", "r"], ["frequency", "--root", "r", "--crop", "c"], ["all", "--root", "r", "--crop", "c", "--raw-file", "x", "--grid-mode", "huge"], []):
        with pytest.raises(SystemExit):
            parser().parse_args(wrong)


def test_small_commands(spark, tmp_path):
    src = tmp_path / "faq.csv"
    src.write_text("unique_q_id,representative_question,raw_frequency\n1,Leaf rust?,5\n2,leaf rust? ,9\n3,market rate,2\n", encoding="utf-8")
    words = tmp_path / "words.yaml"
    words.write_text("categories:\n  trade:\n    keywords: [market]\n")
    assert main(["dedup", "--input", str(src), "--output", str(tmp_path / "once")], spark) == 0
    assert sorted(tuple(r) for r in io.read_csv(spark, str(tmp_path / "once")).select("unique_q_id", "rank").collect()) == [("2", "1"), ("3", "2")]
    assert main(["corpus", "--input", str(src), "--output", str(tmp_path / "kept"), "--corpus-file", str(words), "--removed", str(tmp_path / "gone")], spark) == 0
    assert io.read_csv(spark, str(tmp_path / "kept")).count() == 2 and io.read_csv(spark, str(tmp_path / "gone")).count() == 1


def test_stages(spark, tmp_path):
    log = tmp_path / "log.csv"
    texts = ["rust on wheat leaf", "rust of wheat leaf", "wheat leaf rust", "termite in wheat roots", "termites in wheat roots", "wheat roots termite"]
    log.write_text("crop,query_text\n" + "".join(f"Wheat,{t}\n" for t in texts * 2), encoding="utf-8")
    root = ["--root", str(tmp_path / "run"), "--crop", "Wheat"]
    for command in (["frequency", *root, "--raw-file", str(log), "--single-line"], ["screen", *root], ["repair", *root], ["map", *root, "--raw-file", str(log)]):
        assert main(command, spark) == 0
    stages = io.Stages(spark, str(tmp_path / "run"))
    assert stages.read("row_mapping").count() == 12 and stages.read("candidates").count() == 9
