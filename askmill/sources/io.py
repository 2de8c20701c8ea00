"""Reading and writing: logs as CSV or Parquet, keyword lists as YAML, shard files, stage tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import norm_key

#: Texts that stand for a missing value in CSV files (fixed values).
NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes; the usual marks of missing values become null.

    With line breaks inside quotes a file cannot be split, so it is one task; without ``multi_line`` large files are read in parallel.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    df = (reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema])) if schema else reader).csv(path)
    kinds = {f.name: f.dataType for f in schema} if schema else {}
    out = [F.when(~F.col(f"`{c}`").isin(*NULLS), F.col(f"`{c}`")).try_cast(kinds.get(c, T.StringType())).alias(c) for c in df.columns]
    return df.select(*out)


def read_log(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A raw log from CSV or Parquet, its question column named query_text."""
    df = read_csv(spark, path, multi_line=multi_line) if path.rstrip("/").lower().endswith((".csv", ".csv.gz")) else spark.read.parquet(path)
    return with_query_column(df)


def query_column(columns: list[str], wanted: str | None = None) -> str:
    """query_text, else QueryText, else the ninth column; or the one named as wanted in any case."""
    if wanted is not None:
        for c in columns:
            if c.lower() == wanted.lower():
                return c
        raise ValueError(f"no column {wanted}; there are {', '.join(columns)}")
    for c in ("query_text", "QueryText"):
        if c in columns:
            return c
    if len(columns) < 9:
        raise ValueError(f"no question column; there are {', '.join(columns)}")
    return columns[8]


def with_query_column(df: DataFrame, wanted: str | None = None) -> DataFrame:
    c = query_column(df.columns, wanted)
    return df if c == "query_text" else df.withColumn("query_text", F.col(f"`{c}`"))


def with_row_id(df: DataFrame, order: list[str], name: str = "raw_row_id") -> DataFrame:
    """Row numbers from 0 in the order of the given columns, without one task for all rows."""
    from ..operators.rank import global_rank

    return global_rank(df, [F.col(c).asc() for c in order], name).withColumn(name, F.col(name) - 1)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def load_terms(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """(category, term, kind) of a YAML keyword file and its least word length (3 if not given). Blank terms and other types are left out."""
    import yaml

    with open(path, encoding="utf-8") as f:
        data = yaml.safe_load(f) or {}
    rows = [(c, t, k) for c, x in (data.get("categories") or {}).items() for k, name in (("keyword", "keywords"), ("typo", "typos")) for t in (x or {}).get(name) or [] if isinstance(t, str) and t.strip()]
    return terms(spark.createDataFrame(rows, "category string, term string, kind string")), int(data.get("min_word_length", 3))


def terms(df: DataFrame) -> DataFrame:
    """Distinct terms in normal form, and whether each is a phrase."""
    return df.select(norm_key("term").alias("term")).where("term <> ''").distinct().withColumn("is_phrase", F.col("term").contains(" "))


def merge_shards(spark: SparkSession, pattern: str, order: str = "composite") -> DataFrame:
    """All shard files of an evaluation, best first."""
    df = read_csv(spark, pattern)
    return df.withColumn(order, F.col(order).try_cast("double")).orderBy(F.desc(order), *[c for c in df.columns if c != order])


class Stages:
    """Tables between the stages of a run. Each write makes a new version and then moves the pointer to it, so a stage may replace
    the table that it reads, and a run that breaks off leaves the last version whole."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def write(self, name: str, df: DataFrame) -> DataFrame:
        version = uuid.uuid4().hex
        df.write.parquet(f"{self.root}/{name}/{version}")
        jvm, fs = self._fs()
        pointer = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/CURRENT")
        out = fs.create(pointer, True)
        out.write(bytearray(version.encode()))
        out.close()
        return self.read(name)

    def exists(self, name: str) -> bool:
        jvm, fs = self._fs()
        return fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/CURRENT"))

    def read(self, name: str) -> DataFrame:
        version = self.spark.read.text(f"{self.root}/{name}/CURRENT").first()[0]
        return self.spark.read.parquet(f"{self.root}/{name}/{version}")

    def resume(self, name: str, todo: DataFrame, key: str) -> DataFrame:
        """The rows of todo that a stage has not done yet."""
        return todo.join(self.read(name).select(key).distinct(), key, "left_anti") if self.exists(name) else todo
