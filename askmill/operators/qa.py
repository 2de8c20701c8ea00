"""Question-answer generation: messages in, parsed pairs out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.replies import hint, other_crops, qa_fields, system_prompt
from .models import Generator, generated


def _first(df: DataFrame, names: tuple[str, ...], default: Column) -> Column:
    there = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*there, default)


def messages(faq: DataFrame) -> DataFrame:
    """Add message: the question and how often it was asked, from the columns that are there."""
    q = _first(faq, ("QueryText", "querytext", "representative_question"), F.lit("N/A"))
    n = _first(faq, ("count", "raw_frequency"), F.lit(1)).cast("string")
    return faq.withColumn("message", F.concat(F.lit("Question: "), q, F.lit("\nAsked: "), n, F.lit(" times")))


def answers(faq: DataFrame, crop: str, generator: Generator, hints: list[tuple[list[str], str]] | None = None) -> DataFrame:
    """Add generated_question, generated_category and generated_answer."""
    c = F.lit(crop)
    asked = messages(faq).withColumn("system", system_prompt(c, F.lit(", ".join(other_crops(crop))), hint(c, hints or [], "Keep to established advice for this crop.")))
    q, k, a = qa_fields(F.col("reply"))
    out = generated(asked, "system", "message", generator).withColumns({"generated_question": q, "generated_category": k, "generated_answer": a})
    return out.drop("system", "message", "reply")
