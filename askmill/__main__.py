"""Command line: ``python -m askmill STAGE ...`` runs one stage, or all of them, on tables in a folder."""

from __future__ import annotations

import argparse
import importlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import cluster, corpus, freq, repair
from .plans.pipeline import Pipeline, Settings
from .sources import io

STAGES = ("frequency", "screen", "choose", "repair", "map", "faq", "answers", "all")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="askmill", description="From a log of questions to answered, answer-distinct questions.")
    sub = p.add_subparsers(dest="command", required=True)
    for name in STAGES:
        s = sub.add_parser(name, help="all stages" if name == "all" else f"the stage {name}")
        s.add_argument("--root", required=True, help="folder of the stages' tables")
        s.add_argument("--crop", required=True, help="crop as in the log; brackets do not count")
        if name in ("frequency", "map", "all"):
            s.add_argument("--raw-file", required=True, help="log as CSV or Parquet")
            s.add_argument("--single-line", action="store_true", help="no line breaks inside CSV fields: large files are read in parallel")
        if name in ("faq", "all"):
            s.add_argument("--corpus-file", help="keywords as YAML; without it nothing is filtered out")
        if name == "all":
            s.add_argument("--resume", action="store_true", help="leave stages that are done")
        if name == "repair":
            s.add_argument("--config-id", type=int, help="configuration; the best one by score if not given")
        for f in ("max_queries", "phase2_top_k", "diverse_k", "group_chunk"):
            s.add_argument(f"--{f.replace('_', '-')}", type=int, default=getattr(Settings, f))
        for f in ("coverage_cap", "merge_sim", "group_sim", "dedup_threshold", "fuzz_threshold"):
            s.add_argument(f"--{f.replace('_', '-')}", type=float, default=getattr(Settings, f))
        s.add_argument("--grid-mode", choices=sorted(cluster.GRIDS), default=Settings.grid_mode)
        s.add_argument("--coherence-flag", choices=("B", "C"), default=Settings.coherence_flag)
        for part in ("embedder", "judge", "generator"):
            s.add_argument(f"--{part}", help="module:callable that makes one; a stand-in if not given")
    d = sub.add_parser("dedup", help="one row per question of a CSV table, ranked")
    c = sub.add_parser("corpus", help="remove off-topic rows of a CSV table by keywords")
    for s in (d, c):
        s.add_argument("--input", required=True)
        s.add_argument("--output", required=True)
    c.add_argument("--corpus-file", required=True)
    c.add_argument("--fuzz-threshold", type=float, default=100.0)
    c.add_argument("--removed", help="where the removed rows go")
    m = sub.add_parser("merge-shards", help="all score files of an evaluation, best first")
    m.add_argument("--input", required=True)
    m.add_argument("--output", required=True)
    return p


def _made(name: str | None):
    if name is None:
        return None
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)()


def _terms(spark: SparkSession, path: str | None):
    if path is None:
        return spark.createDataFrame([], "term string, is_phrase boolean"), 3
    return io.load_terms(spark, path)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("askmill").getOrCreate()
    if a.command == "dedup":
        t = io.read_csv(spark, a.input).withColumn("raw_frequency", F.col("raw_frequency").try_cast("long"))
        io.write_csv(freq.ranked(freq.dedup(t)), a.output)
    elif a.command == "corpus":
        terms, least = _terms(spark, a.corpus_file)
        kept, removed = corpus.filtered(io.read_csv(spark, a.input), terms, least, a.fuzz_threshold)
        io.write_csv(kept, a.output)
        if a.removed:
            io.write_csv(removed, a.removed)
    elif a.command == "merge-shards":
        io.write_csv(io.merge_shards(spark, a.input), a.output)
    else:
        known = {f for f in Settings.__dataclass_fields__ if f in vars(a)}
        p = Pipeline(spark, a.root, Settings(**{f: getattr(a, f) for f in known}), *(_made(getattr(a, x)) for x in ("embedder", "judge", "generator")))
        log = io.read_log(spark, a.raw_file, not a.single_line) if "raw_file" in vars(a) else None
        terms = _terms(spark, a.corpus_file)[0] if "corpus_file" in vars(a) else None
        if a.command == "all":
            p.run(log, terms, a.resume)
        elif a.command == "frequency":
            p.frequency(log)
        elif a.command == "screen":
            p.screen()
        elif a.command == "choose":
            print(p.choose())
        elif a.command == "repair":
            p.repair(p.choose() if a.config_id is None else a.config_id)
        elif a.command == "map":
            p.stages.write("row_mapping", repair.back_map(freq.of_crop(log, a.crop), p.stages.read("members")))
        elif a.command == "faq":
            p.faq(terms)
        else:
            p.answers()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
