"""Prompts for a judge or generator, and parsers of what it replies, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import cut, numbered, strip

#: Letter -> score (fixed values).
COHERENCE = {"A": 1.0, "B": 0.7, "C": 0.2}
SEPARATION = {"A": 1.0, "B": 0.6, "C": 0.0}
MERGE = {"A": 1.0, "B": 0.0}

#: Crops that an answer about one crop must not deal with, and names of the same crop (fixed values).
OTHER_CROPS = (
    "Wheat", "Paddy", "Rice", "Sugarcane", "Potato", "Mustard", "Mango", "Black Gram", "Urad", "Mentha", "Mint", "Maize", "Chillies", "Tomato",
    "Pea", "Brinjal", "Green Gram", "Moong", "Sunnhemp", "Bengal Gram", "Chickpea", "Chana", "Onion", "Groundnut", "Okra", "Pearl Millet",
    "Bajra", "Guava", "Barseem", "Bottle Gourd", "Lauki", "Guar", "Cluster Bean", "Cotton", "Soybean", "Lentil", "Masoor", "Cauliflower",
    "Apple", "Banana", "Arecanut", "Coconut", "Pigeon Pea",
)
SAME_CROP = (
    ("pearl millet", "bajra"), ("bottle gourd", "lauki", "ghiya"), ("green gram", "moong", "mung"), ("onion", "pyaz", "piaz"), ("paddy", "rice", "dhan", "dhaan"),
    ("pigeon pea", "arhar", "tur", "toor"), ("bengal gram", "chickpea", "chana"), ("black gram", "urad"), ("maize", "makka", "corn"), ("cotton", "kapas", "narma"),
    ("wheat", "gehun", "gehu"), ("mango", "aam"), ("banana", "kela"),
)


def letter(reply: Column, default: str = "C") -> Column:
    """The first A, B or C anywhere in a reply, also inside a word; else the default."""
    found = F.regexp_extract(F.upper(F.coalesce(reply, F.lit(""))), "([ABC])", 1)
    return F.when(found == "", F.lit(default)).otherwise(found)


def score(letters: Column, table: dict[str, float], missing: float) -> Column:
    out = F.lit(missing)
    for k, v in table.items():
        out = F.when(letters == k, F.lit(v)).otherwise(out)
    return out


def outlier(reply: Column, size: Column) -> Column:
    """Index (from 0) of the question that does not belong; -1 if none. The first N or digit up to the size (5 at most) counts."""
    found = F.lit("")
    up = F.upper(F.coalesce(reply, F.lit("")))
    for n in range(1, 6):
        found = F.when(F.least(size, F.lit(5)) == n, F.regexp_extract(up, f"([N1-{n}])", 1)).otherwise(found)
    return F.when((found == "") | (found == "N"), F.lit(-1)).otherwise(F.try_to_number(found, F.lit("9")).cast("int") - 1)


_GROUPS = "array<struct<group:string,label:string,indices:array<string>>>"


def json_list(reply: Column) -> Column:
    """The groups of a reply: its longest [...] part as JSON; null if there is none or it is broken."""
    return F.from_json(F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)(\[.*\])", 1), _GROUPS)


def json_object(reply: Column, schema: str) -> Column:
    """The first flat {...} part of a reply as JSON."""
    return F.from_json(F.regexp_extract(F.coalesce(reply, F.lit("")), r"(\{[^{}]+\})", 1), schema)


def token_budget(n: Column, local: bool = False) -> Column:
    return F.least(150 + 16 * n, F.lit(600)) if local else F.least(200 + 20 * n, F.lit(4096))


def other_crops(crop: str, crops: tuple[str, ...] = OTHER_CROPS) -> list[str]:
    """The crops to reject: all but those that are a name of the crop (any of its words counts)."""
    own = {crop.lower(), *crop.lower().split()}
    for group in SAME_CROP:
        if own & set(group):
            own |= set(group)
    return [c for c in crops if c.lower() not in own]


def hint(crop: Column, rules: list[tuple[list[str], str]], default: str) -> Column:
    """The text of the first rule of which a name is part of the crop."""
    out = F.lit(default)
    for names, text in reversed(rules):
        hit = F.lit(False)
        for n in names:
            hit = hit | F.lower(crop).contains(n)
        out = F.when(hit, F.lit(text)).otherwise(out)
    return out


def ask_coherence(questions: Column) -> Column:
    return F.concat(F.lit("Do these "), F.size(questions).cast("string"), F.lit(" questions deal with one and the same topic?\n"), numbered(questions), F.lit("\nA) all of them\nB) most of them\nC) no\nReply with A, B or C:"))


def ask_pair(a: Column, b: Column, ask: str, choices: str) -> Column:
    """Two groups, three questions of each."""
    return F.concat(F.lit(f"{ask}\nFirst group:\n"), numbered(F.slice(a, 1, 3), "  "), F.lit("\nSecond group:\n"), numbered(F.slice(b, 1, 3), "  "), F.lit(f"\n{choices}:"))


def ask_separation(a: Column, b: Column) -> Column:
    return ask_pair(a, b, "Should these groups stay apart?", "A) different topics\nB) related, yet distinct\nC) the same topic\nReply with A, B or C")


def ask_merge(a: Column, b: Column) -> Column:
    return ask_pair(a, b, "Should these groups become one?", "A) one topic\nB) different topics\nReply with A or B")


def ask_outlier(questions: Column) -> Column:
    return F.concat(F.lit("Which of these questions does not belong to the others? Reply with its number, or N if all do.\n"), numbered(F.slice(questions, 1, 5)))


def ask_off_crop(crop: str, questions: Column) -> Column:
    return F.concat(F.lit(f'The crop is {crop}. Which of these questions deal with another crop? Reply as {{"off": [numbers]}}.\n'), numbered(questions))


def ask_groups(questions: Column, topic: Column, crop: str) -> Column:
    asked = f'\nCrop: {crop}. Put questions that need the very same advice into one group; each question in one group. Reply as [{{"group": 1, "label": "the advice", "indices": [1, 2]}}].\n'
    return F.concat(F.lit("Topic: "), topic, F.lit(asked), numbered(F.transform(questions, strip)))


def ask_range(crop: str, questions: Column) -> Column:
    """Do the representatives of a cluster, which are far apart, need one and the same advice?"""
    return F.concat(F.lit(f"Crop: {crop}. These questions span one cluster. Would an officer give one and the same advice for all of them?\n"), numbered(questions), F.lit("\nA) for all\nB) for most, with small changes\nC) no\nReply with A, B or C:"))


def ask_split(questions: Column, topic: Column, crop: str) -> Column:
    """Groups of two or more questions that need the same advice; one group means that the cluster stays whole."""
    asked = f'\nCrop: {crop}. Put questions that need the very same advice into one group, but part them only where the advice differs; no group of one question. Reply as [{{"group": 1, "label": "two to four words", "indices": [1, 2]}}].\n'
    return F.concat(F.lit("Topic: "), topic, F.lit(asked), numbered(F.transform(questions, strip)))


def ask_join(crop: str, a: Column, b: Column) -> Column:
    """Do the representatives of two clusters need the same advice?"""
    return F.concat(F.lit(f"Crop: {crop}.\nFirst cluster: "), a, F.lit("\nSecond cluster: "), b, F.lit("\nWould both get the same advice, so that they should become one?\nA) yes\nB) no\nReply with A or B:"))


def ask_same(crop: str, a: str, b: str) -> str:
    """Do two questions need the same advice?"""
    return f"Crop: {crop}.\nFirst question: {a}\nSecond question: {b}\nDo both need the same advice? A) yes B) no\nReply with A or B:"


def system_prompt(crop: Column, rejected: Column, hints: Column) -> Column:
    """Instructions for the generator of one question-answer pair per call."""
    return F.concat(
        F.lit("You write one question-answer pair about "), crop, F.lit(" in plain English, close to the question given.\nOther crops ("), rejected, F.lit("): reply with the category IRRELEVANT_CROP and an empty answer.\n"),
        hints, F.lit("\nCategories: Disease | Pest | Fertilizer and Nutrient | Variety | Agronomy | Other | IRRELEVANT_CROP\nReply as\nCATEGORY: one of them\nQUESTION: the question\nANSWER:\nthe answer"),
    )


#: The headings of a reply, bold or not, with or without a colon (fixed format).
_HEADINGS = ("CATEGORY", "QUESTION", "ANSWER")
_HEADING_LINE = rf"(?i)^\s*(?:\*\*)?({'|'.join(_HEADINGS)})(?:\*\*)?:?"


def qa_fields(reply: Column) -> tuple[Column, Column, Column]:
    """(question, category, answer) of a reply in CATEGORY / QUESTION / ANSWER form.

    The reply is read by lines: each line that starts with a heading opens a part, which ends before the next line with another heading
    (the answer does not end). Fences around it are dropped. No heading at all: PARSE_ERROR with the whole text; no category: Other; no
    answer: the whole text.
    """
    text = strip(F.regexp_replace(strip(F.coalesce(reply, F.lit(""))), r"^```(?:markdown|text)?\s*|\s*```$", ""))
    lines = F.split(text, "\n")
    kinds = F.transform(lines, lambda x: F.upper(F.regexp_extract(x, _HEADING_LINE, 1)))

    def part(name: str) -> tuple[Column, Column]:
        start = F.array_position(kinds, name)  # from 1; 0 if there is none
        others = [h for h in _HEADINGS if h != name]
        after = F.filter(F.transform(kinds, lambda k, i: F.when((i + 1 > start) & k.isin(*others), i + 1)), lambda i: i.isNotNull())
        stop = F.lit(None).cast("int") if name == "ANSWER" else F.try_element_at(after, F.lit(1))
        size = F.coalesce(stop, F.size(lines) + 1) - start
        body = F.array_join(F.slice(lines, F.greatest(start, F.lit(1)).cast("int"), F.greatest(size, F.lit(0)).cast("int")), "\n")
        return start > 0, strip(F.regexp_replace(body, _HEADING_LINE, ""))

    (has_c, c), (has_q, q), (has_a, a) = (part(h) for h in _HEADINGS)
    none = ~(has_c | has_q | has_a)
    return F.when(has_q, q).otherwise(F.lit("")), F.when(none, F.lit("PARSE_ERROR")).when(has_c, c).otherwise(F.lit("Other")), F.when(has_a, a).otherwise(text)


def label_cut(c: Column, n: int = 200) -> Column:
    return strip(cut(F.coalesce(c, F.lit("")), n))
