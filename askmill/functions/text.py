"""Text functions as column expressions (JVM side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words left out when questions are cleaned (fixed values).
STOP_WORDS = frozenset(
    "a an the in on of for to at by from with and or is are am was were be been being have has had"
    " mein me mai main ko ka ki ke se ne hai hain kya kyon kab kaise kaha kahan kon kaun"
    " kare karen karna kar lag laga ho hona crop fasal kheti farm kisan plant field seed"
    " question query problem help info information".split()
)

#: Signs stripped from both ends of a token (fixed values).
TOKEN_EDGE = ".,!?;:()[]{}\"'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends (Spark's trim knows blanks only)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def norm_key(c: Column | str) -> Column:
    """Stripped and in lower case: what makes two questions exact duplicates."""
    return F.lower(strip(c))


def crop_norm(c: Column | str) -> Column:
    """A crop name without brackets and outer white space; case is kept."""
    return strip(F.regexp_replace(_col(c), r"[()]", ""))


def slug(c: Column | str) -> Column:
    """Lower case with every run of other signs as one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(_col(c)), r"[^a-z0-9]+", "_"), r"^_+|_+$", "")


def clean(c: Column | str, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Lower case letters only, stop words dropped, single blanks; null becomes ''. Repeated words stay."""
    words = F.split(F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(_col(c), F.lit(""))), r"[^a-z\s]", " "), r"\s+", " ")), " ")
    stop = F.array(*[F.lit(w) for w in sorted(stop_words)])
    return F.array_join(F.filter(words, lambda w: ~F.array_contains(stop, w)), " ")


def tokens(c: Column | str) -> Column:
    """Words of two or more word characters, in order, repeated ones included."""
    return F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit(r"[a-z0-9_]{2,}"), F.lit(0))


def edge_tokens(c: Column | str) -> Column:
    """White-space separated tokens in lower case without punctuation at their ends."""
    edge = r"[.,!?;:()\[\]{}\"']+"
    return F.transform(F.split(norm_key(c), r"(?U)\s+"), lambda t: F.regexp_replace(t, f"^{edge}|{edge}$", ""))


def cut(c: Column | str, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def numbered(items: Column, mark: str = "") -> Column:
    """'1. first' and so on, one per line."""
    return F.array_join(F.transform(items, lambda q, i: F.concat(F.lit(mark), (i + 1).cast("string"), F.lit(". "), q)), "\n")
