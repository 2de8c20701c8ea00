"""Problem 3: records that differ in nothing but formatting.

Method: dictionary encoding. Every distinct text is canonicalised once; each of its field values becomes an integer identifier; a record is
then its sorted tuple of identifiers, and equal tuples are one question.

* A labelled note (``Label mark value`` fields) has one identifier per field, so the order of the fields does not matter. A sentence has
  one identifier for the whole text.
* The identifier of a value is an integer of 128 bits (two independent hashes of 64), so no dictionary has to be built, sorted or joined at
  any size, and no second key stands beside the tuple: two of 10^12 distinct values share an identifier with a probability below 10^-14.
* Only distinct texts are shuffled (with their counts, combined on the map side first), then only tuples and digests: a text that stands in
  a third of all rows is one row from the first aggregation on. Where every copy is listed, the rows of a text with a thousandth of all rows
  or more (there are at most 1000 such texts) are spread over ``SALTS`` keys, so no task gets all rows of one text.

Nulls, blanks and texts without a letter or digit form no set. Repeated rows (same text) are copies only in sets with two or more
spellings. An empty table gives no rows. The longest texts are used whole. Columns besides those named are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import staged

#: The labels of labelled notes (fixed values of the data).
LABELS = ("village", "block", "crop", "issue", "signs", "variety", "shop", "product", "water", "age")

_NOT_WORD = r"[^\p{L}\p{N}]+"
_LABEL = "|".join(LABELS)
#: A label counts at the start of the text or after a separator, and when a mark follows it.
_FIELD = rf"(?:^|[|,;/\n\r])[^\p{{L}}\p{{N}}]*({_LABEL})\s*\p{{Z}}*[:=\-–>]"
_SPLIT = "\u0001"


def fields(text: Column) -> Column:
    """The canonical fields of a text, ``label=value`` or, for a sentence, one plain value: sorted strings of letters and digits.

    A text is a labelled note if at least three fields are found in it and it starts with one.
    """
    low = F.lower(text)
    marked = F.regexp_replace(low, _FIELD, f"{_SPLIT}$1{_SPLIT}")
    parts = F.split(marked, _SPLIT)
    count = (F.size(parts) - 1) / 2
    labelled = F.transform(
        F.sequence(F.lit(1), F.greatest(count.cast("int"), F.lit(1))),
        lambda i: F.concat(F.element_at(parts, 2 * i), F.lit("="), F.regexp_replace(F.element_at(parts, 2 * i + 1), _NOT_WORD, "")),
    )
    head = F.regexp_replace(F.element_at(parts, 1), _NOT_WORD, "")
    return F.when((count >= 3) & (head == ""), F.array_sort(labelled)).otherwise(F.array(F.regexp_replace(low, _NOT_WORD, "")))


def digest(text: Column) -> Column:
    """16 bytes that stand for a text."""
    return F.unhex(F.md5(text))


def identifier(value: Column) -> Column:
    """The integer of 128 bits that stands for a value, as two longs."""
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(1), value).alias("b"))


def encode(distinct: DataFrame, text: str = "text") -> DataFrame:
    """Add ``tuple``, the sorted integer tuple of a text."""
    return distinct.withColumn("tuple", F.array_sort(F.transform(fields(F.col(text)), identifier)))


def distinct_texts(records: DataFrame) -> DataFrame:
    """(table_name, text, n, first_key): each distinct text once, with its number of rows and smallest key."""
    return records.groupBy("table_name", "text").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key"))


def sets(records: DataFrame) -> DataFrame:
    """One row per question: (table_name, tuple, kept_key, copies, spellings)."""
    return _grouped(encode(distinct_texts(records)))


def _grouped(coded: DataFrame) -> DataFrame:
    return coded.groupBy("table_name", "tuple").agg(F.min("first_key").alias("kept_key"), F.sum("n").alias("copies"), F.count(F.lit(1)).alias("spellings"))


#: Over how many keys the rows of a hot text are spread, and the share of all rows that makes a text hot.
SALTS, HOT = 64, 1 / 1000


def copies(records: DataFrame) -> DataFrame:
    """(table_name, kept_key, copy_key): each record of a set with two or more spellings, but for the kept one."""
    coded = staged(encode(distinct_texts(records)).select("table_name", "tuple", "n", "first_key", digest(F.col("text")).alias("_digest")))
    several = _grouped(coded).where("spellings > 1").select("table_name", "tuple", "kept_key")
    texts = coded.join(several, ["table_name", "tuple"]).select("table_name", "_digest", "kept_key", "n")
    rows = records.select("table_name", F.col("key").alias("copy_key"), digest(F.col("text")).alias("_digest"))
    return spread_join(rows, texts, coded.agg(F.sum("n")).first()[0] or 0, "copy_key").where("copy_key <> kept_key").select("table_name", "kept_key", "copy_key")


def spread_join(rows: DataFrame, texts: DataFrame, total: int, key: str) -> DataFrame:
    """Join rows to texts (table_name, _digest, n, ...) with the rows of hot texts spread over SALTS keys; total: the number of rows."""
    hot = F.col("n") >= F.lit(max(1.0, total * HOT))
    known = texts.where(hot).select("table_name", "_digest", F.lit(True).alias("_hot"))  # 1 / HOT texts at most
    left = rows.join(F.broadcast(known), ["table_name", "_digest"], "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(key), F.lit(SALTS))).otherwise(0)).drop("_hot")
    right = texts.withColumn("_salt", F.explode(F.when(hot, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long"))))).drop("n")
    return left.join(right, ["table_name", "_digest", "_salt"]).drop("_salt", "_digest")
