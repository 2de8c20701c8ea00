"""Problem 2: question-answer pairs whose answer is no usable reply, with the type of the defect.

Defects, in the order in which they are tried: ``empty``, ``copied_question``, ``refusal``, ``other_language``, ``truncated``.

* *Truncation* is found by a pushdown parser (``parse``): one tokeniser and one stack for fences (of backticks or tildes), inline code,
  brackets, quotation marks, emphasis, HTML tags, table rows, headings, list items, labels and clauses. Each opens a frame that its closing
  sign, or the content it calls for, pops: a list marker or heading wants a word, a colon or comma wants something to follow. A text that ends
  with an open frame breaks off. Frames of emphasis and code end with their paragraph, as in Markdown.
* An addition to the parser: a text whose only open frame is a sentence (no final mark) is unfinished if its last words do not usually
  end sentences: the share of sentence ends among all places where its last one to three words stand (names and numbers
  masked), counted over all answers, decides. These counts are a distributed aggregate that is joined to the open answers' last
  words; nothing of the corpus goes to the driver.
* *Copied questions* are found by greedy string tiling: how much of the answer is tiled by runs of the question's words, however often.
* *Refusals* are found by a grammar over word classes (``_GRAMMAR``): a sentence is a refusal if one of its rules matches anywhere in it, and
  an answer is one if it has a refusal and no more sentences of advice than refusals.
* *Other languages* are found by script and, for Latin letters, by the share of English function words.

An answer is tokenised once per row, no text is shuffled. Null and blank answers are ``empty``, unless the category is IRRELEVANT_CROP (in
any case, blanks ignored). A null question makes no copy. Repeated rows give one row. Texts of any length are read whole. An empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import spread, staged

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_LABEL = re.compile(r"^\W*(?:answer|reply|response|advice)\W*(?=$|[:\-–=])[\s:*_\-–=]*", re.I)
#: What stands for nothing.
_NOTHING = {"", "na", "n a", "none", "null", "nan", "nil", "no answer", "answer", "reply", "response", "empty", "blank", "tbd"}
_FUNCTION = frozenset(
    "the a an of to and in is are was were be been with for on at by from that this these those it its as or not no do does did can cannot may should"
    " will would your you i my me we our they their there which when what how if before after until per any some both more than then so such have has had".split()
)
#: Words that introduce a question given back.
_INTRO = frozenset("question query q you asked ask asks your the farmer caller so this is about regarding here as follows about: answer reply".split())


def bare(answer: str | None) -> str:
    """The answer without a label at its start, fences and emphasis."""
    text = re.sub(r"`{3}\w*|`", " ", answer or "")
    text = text.replace("**", "").replace("__", "").strip()
    return _LABEL.sub("", text).strip()


def is_empty(answer: str | None) -> bool:
    words = " ".join(_WORD.findall(bare(answer).lower()))
    return words in _NOTHING


# --- copies --------------------------------------------------------------------------------------------------------------------------


def tiles(question: list[str], answer: list[str], least: int = 2, again: bool = False) -> list[bool]:
    """Greedy string tiling: which words of the answer are covered by the longest common runs (of ``least`` words or more).

    Each word of the question is used once; with ``again`` as often as it is given back.
    """
    covered, used = [False] * len(answer), [False] * len(question)
    where: dict[tuple[str, ...], list[int]] = {}
    for i in range(len(question) - least + 1):
        where.setdefault(tuple(question[i : i + least]), []).append(i)
    starts = [j for j in range(len(answer) - least + 1) if tuple(answer[j : j + least]) in where]
    while starts:
        best, found = least - 1, []
        for j in starts:
            for i in where[tuple(answer[j : j + least])]:
                k = 0
                while i + k < len(question) and j + k < len(answer) and question[i + k] == answer[j + k] and not used[i + k] and not covered[j + k]:
                    k += 1
                if again and k >= least:
                    found.append((i, j, k))
                elif k > best:
                    best, found = k, [(i, j, k)]
                elif k == best and k >= least:
                    found.append((i, j, k))
        for i, j, k in found:
            if again:
                covered[j : j + k] = [True] * k
            elif not any(used[i : i + k]) and not any(covered[j : j + k]):
                used[i : i + k] = [True] * k
                covered[j : j + k] = [True] * k
        if again or not found:
            break
    return covered


class Pair:
    """A question and an answer, tokenised and tiled once."""

    def __init__(self, question: str | None, answer: str):
        self.answer = answer
        self.found = list(_WORD.finditer(answer))
        self.a = [m.group().lower() for m in self.found]
        self.q = _WORD.findall((question or "").lower())
        self.cover = tiles(self.q, self.a, 2 if len(self.q) > 3 else 1) if self.q else [False] * len(self.a)

    def is_copy(self) -> bool:
        """Is the answer the question and nothing else, perhaps introduced, repeated or slightly altered?"""
        q, a, cover = self.q, self.a, self.cover
        known = set(q)
        if not q or not a or sum(w in known for w in a) < 0.6 * sum(w not in _INTRO for w in a):  # no tiling can cover enough
            return False
        if len(a) > 1.5 * len(q):  # given back more than once
            cover = tiles(q, a, 2 if len(q) > 3 else 1, again=True)
        lead = 0
        while lead < len(a) and not cover[lead] and a[lead] in _INTRO:
            lead += 1
        rest, run, longest = cover[lead:], 0, 0
        if not rest:
            return False
        for c in rest:
            run = 0 if c else run + 1
            longest = max(longest, run)
        return sum(rest) >= 0.6 * len(rest) and longest <= max(4, len(q) // 8) and sum(rest) >= 0.5 * len(q)

    def is_foreign(self) -> bool:
        """Is most of the answer in another script, or in Latin letters but not English? A restated question is left out of account."""
        if not self.answer.isascii():
            letters = [c for c in self.answer if c.isalpha()]
            if letters and sum(c < "ɐ" for c in letters) < 0.5 * len(letters):
                return True
        left = [w for w, c in zip(self.a, self.cover) if not c and not w.isdigit()] or [w for w in self.a if not w.isdigit()]
        return len(left) >= 5 and sum(w in _FUNCTION for w in left) < 0.1 * len(left)

    def rest(self) -> str:
        """The answer without a question restated at its start."""
        end, inside = 0, 0
        for k, c in enumerate(self.cover, 1):
            inside += c
            if c and inside >= 0.7 * k:
                end = k
        if end < 6:
            return self.answer
        return re.sub(r"^[^\w\s]*\s*", "", self.answer[self.found[end - 1].end() :])


# --- refusals ------------------------------------------------------------------------------------------------------------------------

#: Word classes of the grammar; a word may be in several.
_CLASSES = {
    "self": "i we me us",
    "own": "my our",
    "desk": "assistant desk service system team bot model program office helpline portal side end",
    "unable": "cannot can't couldn't won't unable mustn't",
    "can": "can could will may must might shall able",
    "not": "not never neither nor",
    "no": "no nothing none neither without",
    "do": "do does did don't doesn't didn't",
    "have": "have has possess hold got haven't hasn't",
    "lack": "lack lacks lacking",
    "act": "answer answering advise advising comment commenting respond responding reply replying discuss discussing recommend recommending help helping assist assisting say provide providing suggest suggesting state give giving offer offering speak tell guide guiding support share sharing address handle process fulfil fulfill comply engage cover resolve take weigh contribute attempt judge elaborate talk deal",
    "word": "answer answers advice guidance help response reply recommendation recommendations comment comments information opinion suggestion suggestions assistance support details knowledge expertise view data facts",
    "know": "knowledge information details expertise permission authority data training competence insight background facts means right",
    "allowed": "allowed permitted authorised authorized qualified equipped trained supposed position free meant designed cleared licensed competent prepared willing",
    "refuse": "decline declines declined refuse refuses refrain abstain pass withhold desist skip excuse",
    "given": "given provided offered available possible supplied issued shared made forthcoming come be found stated",
    "out": "outside beyond exceeds exceed",
    "scope": "scope remit range expertise purview area limits limit mandate competence knowledge field role reach duties what",
    "fit": "appropriate right proper suitable fitting ethical wise permissible inappropriate",
    "rules": "guidelines guideline rules rule policy policies instructions training programming terms restrictions mandate protocol",
    "bar": "forbid forbids prohibit prohibits prevent prevents bar bars restrict restricts stop stops disallow disallows",
    "let": "allow permit let",
    "want": "must have need will would rather prefer choose shall going should am are intend decided wish",
    "left": "unanswered unresolved open",
    "stay": "stay remain go left leave keep",
    "is": "is are am be was were 'm 're falls lies fall lie goes sits",
    "to": "to",
    "for": "for of from by",
}
_OF: dict[str, str] = {}
for _k, _words in _CLASSES.items():
    for _w in _words.split():
        _OF[_w] = f"{_OF.get(_w, '')}<{_k}>"

#: Rules over classes; ``~n`` allows n words between.
_GRAMMAR = (
    "self unable ~4 act", "self can not ~4 act", "self unable ~3 word", "self ~1 is not ~1 can to ~3 act", "self ~1 is unable to ~3 act", "desk ~2 unable ~4 act", "desk can not ~3 act", "self can no ~2 word",
    "self ~1 is not ~3 allowed", "desk ~1 is not ~3 allowed", "self ~2 do not ~1 have ~4 know", "self do ~1 have ~4 know", "self have no ~3 know", "self have ~1 not ~4 know", "self have no ~3 word", "self lack ~3 know",
    "self ~3 want ~3 refuse", "self refuse", "self ~2 refuse ~2 to", "no ~1 word ~3 given", "word ~5 unable ~2 given", "word ~5 can not ~2 given", "word ~3 is not ~2 given", "no ~1 self ~1 is ~1 allowed", "no ~1 self can ~2 act", "no ~1 self ~1 is can ~1 act",
    "out ~3 scope", "out ~2 self", "out ~2 own", "is not ~1 within ~3 scope", "not ~1 part ~1 own", "is not ~2 fit for self", "is not ~2 fit for ~2 desk", "not be ~1 fit for self", "be inappropriate for self", "is inappropriate for self",
    "own rules ~2 not ~1 let", "rules ~2 not ~1 let", "rules ~2 do let", "rules bar", "rules ~2 bar self", "want ~1 stay ~2 left", "stay ~4 left", "self ~2 want ~3 stay ~3 left", "self want ~1 leave ~4 others", "something self ~3 refuse", "not something self can", "not something self ~2 allowed", "not something self ~2 act", "not a ~2 self can ~1 act", "self want not ~2 act", "self 'd rather not",
)


def _rule(rule: str) -> re.Pattern:
    """A rule as a pattern over a sentence written as ``word<class><class> ``."""
    out = ""
    for part in rule.split():
        if part.startswith("~"):
            out += rf"(?:\S+ ){{0,{part[1:]}}}?"
        elif part in _CLASSES:
            out += rf"\S*<{part}>\S* "
        else:
            out += rf"{re.escape(part)}(?:<\S*)? "
    return re.compile(rf"(?:^| ){out}")


_RULES = [_rule(r) for r in _GRAMMAR]
#: Every rule holds a word of these classes or a negated verb; sentences without one are not coded.
_TRIGGER = re.compile(rf"n't\b|\b(?:{'|'.join(sorted({w for k in 'unable not no lack refuse out bar left stay'.split() for w in _CLASSES[k].split()} | {'inappropriate', 'cannot'}))})\b")
#: Words that begin a sentence which sends the asker on or is polite, and no advice.
_POLITE = frozenset("please kindly try ask contact consult see sorry apologies thank thanks understand unfortunately regrettably refer visit call speak approach seek wait".split())


def _split(text: str) -> list[str]:
    return [s for s in re.split(r"(?<=[.!?।])\s+|\n+", text) if _WORD.search(s)]


def refuses(sentence: str) -> bool:
    """Does a rule of the grammar match in the sentence?"""
    low = sentence.lower().replace("’", "'").replace("can not", "cannot").replace("n't be ", "n't not be ")
    if not _TRIGGER.search(low):
        return False
    coded = " ".join(w + _OF.get(w, "") for x in re.findall(r"[^\W_]+(?:'[^\W_]+)?", low) for w in (x, *(("not",) if x.endswith("n't") and x not in _OF else ()))) + " "
    return any(r.search(coded) for r in _RULES)


def is_refusal(answer: str, parts: list[str] | None = None, known: dict[str, bool] | None = None) -> bool:
    """Does a sentence decline to answer, with no more sentences of advice than such ones in the whole answer?

    parts: its sentences, if they are at hand; known: what was found of sentences met before.
    """
    parts = _split(bare(answer)) if parts is None else parts
    known = {} if known is None else known
    no = []
    for s in parts:
        r = known.get(s)
        if r is None:
            r = known[s] = refuses(s)
        no.append(r)
    if not any(no):
        return False
    advice = 0
    for s, r in zip(parts, no):
        first = _WORD.findall(s.lower())[0]
        advice += not r and first not in _FUNCTION and first not in _POLITE
    return advice <= sum(no)


# --- truncation ----------------------------------------------------------------------------------------------------------------------

_CLOSING = {"(": ")", "[": "]", "{": "}", "“": "”", "«": "»", "‘": "’"}
#: HTML elements that must be closed (fixed values); others are taken for text.
_TAGS = frozenset("ul ol dl table thead tbody div span b i u em strong a code pre blockquote h1 h2 h3 h4 h5 h6 sub sup small mark section article del ins".split())
_TOKEN = re.compile(
    r"""(?P<fence>(?m:^)[ \t]*(?:`{3,}|~{3,}))|(?P<rule>(?m:^)[ \t]*(?:(?:-[ \t]*){3,}|(?:\*[ \t]*){3,}|(?:_[ \t]*){3,}|\|?[ \t]*:?-{2,}[-|: \t]*)(?=\n|\Z))|(?P<heading>(?m:^)[ \t]*\#{1,6}(?=\s|\Z))"""
    r"""|(?P<item>(?m:^)[ \t]*(?:[-*+•–]|\d{1,3}[.)]|[a-zA-Z][.)])(?=\s|\Z))|(?P<row>(?m:^)[ \t]*\|)|(?P<tag></?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>)|(?P<cut></?[A-Za-z][^<>]*\Z)"""
    r"""|(?P<word>[^\W_]+(?:['’.,:/\-_][^\W_]+)*)|(?P<code>`+)|(?P<emph>\*+|_+)|(?P<open>[(\[{“«‘])|(?P<close>[)\]}”»’])|(?P<quote>")"""
    r"""|(?P<dots>…|\.{2,})|(?P<end>[.!?।॥]+)|(?P<para>\n[ \t]*\n\s*)|(?P<line>\n)|(?P<more>[,;:&/\-–—|])"""
)
#: Frames that the next word pops: they only want something to follow.
_WANT = frozenset(("item", "heading", "more", "body"))


def frames(answer: str) -> tuple[list[str], str]:
    """Pushdown parse: (the frames left open at the end, the words of the sentence left open, if there is one)."""
    text = answer.rstrip()
    stack: list[str] = []
    since, ended, closed_row = 0, False, False
    size = len(text)

    def start(frame: str) -> None:
        """Open a frame that is content itself."""
        while stack and stack[-1] in _WANT:
            stack.pop()
        stack.append(frame)

    for m in _TOKEN.finditer(text):
        kind, s, at = m.lastgroup, m.group(), m.start()
        if stack and stack[-1][0] in "`~":  # inside code only its end counts
            mark = s.strip()
            if (kind == "fence" and stack[-1] in (mark, mark[0] + "fence")) or (kind == "code" and stack[-1] == s) or (kind == "para" and not stack[-1].endswith("fence")):
                stack.pop()
            continue
        if kind == "word":
            while stack and stack[-1] in _WANT:
                stack.pop()
            if not stack or stack[-1] != "sentence":
                stack.append("sentence")
                since = at
            ended = False
        elif kind == "end":
            while stack and stack[-1] in ("sentence", "more"):
                stack.pop()
            ended = True
        elif kind == "dots":
            stack.append("more")
        elif kind == "more":
            if stack and stack[-1] in ("sentence", "body") or (s == ":" and stack):
                stack.append("body" if s == ":" else "more")
            elif stack and stack[-1] not in _WANT and s not in "-–—|":
                stack.append("more")
            if s == "|" and "row" in stack and (m.end() == size or text[m.end() :].lstrip(" \t")[:1] == "\n"):
                closed_row = True
                while stack.pop() != "row":
                    pass
        elif kind in ("line", "para"):
            while stack and (stack[-1] == "sentence" or stack[-1] == "row" or (kind == "para" and (stack[-1] == "more" or stack[-1][0] in "*_"))):
                stack.pop()
            if kind == "para":  # emphasis ends with its paragraph
                stack = [x for x in stack if x[0] not in "*_"]
            ended = False
        elif kind in ("item", "heading"):
            while stack and stack[-1] in ("item", "body", "more", "sentence"):
                stack.pop()
            stack.append(kind)
        elif kind == "row":
            stack = [x for x in stack if x not in ("body", "more", "sentence", "item")]
            stack.append("row")
        elif kind == "rule":
            continue
        elif kind == "fence":
            while stack and stack[-1] in _WANT | {"sentence"}:
                stack.pop()
            stack.append(s.strip()[0] + "fence")
        elif kind == "code":
            start(s)
        elif kind == "cut":
            stack.append("<")
        elif kind == "tag":
            name = re.match(r"</?([A-Za-z0-9]+)", s).group(1).lower()
            if name in _TAGS and not s.endswith("/>"):
                if s[1] != "/":
                    start(f"<{name}")
                elif f"<{name}" in stack:
                    while stack.pop() != f"<{name}":
                        pass
        elif kind == "emph":
            before, after = text[at - 1 : at] if at else " ", text[m.end() : m.end() + 1] or " "
            if not before.isspace() and s in stack:
                while stack.pop() != s:
                    pass
            elif not after.isspace() and not (before.isalnum() or before == ")"):
                start(s)
            elif m.end() == size and before.isspace() and stack:
                stack.append(s)
        elif kind == "open":
            start(_CLOSING[s])
        elif kind in ("close", "quote"):
            mark = s if kind == "close" else '"'
            before, after = text[at - 1 : at] if at else " ", text[m.end() : m.end() + 1]
            if mark in stack and (kind == "close" or not before.isspace() or not after or after.isspace()):
                while stack.pop() != mark:
                    pass
                if ended and stack and stack[-1] == "sentence":  # the mark stood before the closing sign
                    stack.pop()
            elif kind == "quote" and (before.isspace() or before in "([{:-–—*_") and not before.isdigit():
                start(mark)
    if "row" in stack and not closed_row:
        stack.remove("row")
    sentence = text[since:] if stack and stack[-1] == "sentence" else ""
    return stack, sentence


def parse(answer: str) -> tuple[bool, str]:
    """(breaks off within a frame other than a sentence, the sentence left open if it is the only frame)."""
    stack, sentence = frames(answer)
    if any(x != "sentence" for x in stack):
        return True, ""
    return False, re.split(r"(?<=[:])\s+", sentence)[-1] if sentence else ""


def masked(words: list[str]) -> list[str]:
    """Words in lower case; numbers and names (capitals within the sentence) as one sign each."""
    return ["#" if any(c.isdigit() for c in w) else "@" if k and w[0].isupper() else w.lower() for k, w in enumerate(words)]


def _grams(words: list[str]) -> list[str]:
    return [" ".join(words[-n:]) for n in (1, 2, 3) if len(words) >= n]


def _judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (unique_q_id, defect, grams) of the answers and, with a null id, (gram, ends, places): the runs of one to three masked words of
    the finished sentences, how often they end one and how often they stand anywhere."""
    known: dict[str, bool] = {}
    for pdf in batches:
        ids, defects, last = [], [], []
        sentences: Counter[str] = Counter()
        if len(known) > 200_000:
            known.clear()
        for i, q, c, a in zip(pdf["unique_q_id"], pdf["question"], pdf["category"], pdf["answer"]):
            d, grams = None, []
            if is_empty(a):
                d = None if (c or "").strip().upper() == "IRRELEVANT_CROP" else "empty"
            else:
                clean = bare(a)
                parts = _split(clean)
                sentences.update(parts)
                pair = Pair(q, clean)
                if pair.is_copy():
                    d = "copied_question"
                elif is_refusal(clean, parts, known):
                    d = "refusal"
                elif pair.is_foreign():
                    d = "other_language"
                else:
                    broken, open_ = parse(Pair(q, a).rest() if clean != a.strip() else pair.rest())
                    d = "truncated" if broken else None
                    grams = _grams(masked(_WORD.findall(open_)))
            if d or grams:
                ids.append(i)
                defects.append(d)
                last.append(grams)
        forms: Counter[tuple[str, ...]] = Counter()  # of one masked form are many sentences
        for s, k in sentences.items():
            if s.rstrip()[-1] in ".!?।":
                forms[tuple(masked(_WORD.findall(s)))] += k
        ends: Counter[str] = Counter()
        places: Counter[str] = Counter()
        for words, k in forms.items():
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    places[" ".join(words[i : i + n])] += k
            for g in _grams(list(words)):
                ends[g] += k
        n, m = len(ids), len(places)
        if n + m:
            none = lambda values, k, first: pd.Series([*([None] * k if first else values), *(values if first else [None] * k)], dtype=object)
            counts = [pd.array([*[None] * n, *x], "Int64") for x in ([ends[g] for g in places], list(places.values()))]
            yield pd.DataFrame({"unique_q_id": none(ids, m, False), "defect": none(defects, m, False), "grams": none(last, m, False), "gram": none(list(places), n, True), "ends": counts[0], "places": counts[1]})


#: A run of words counts as evidence from this many places on, and as a sentence end from this share on.
LEAST_PLACES, LEAST_SHARE = 3, 0.5


def defects(pairs: DataFrame) -> DataFrame:
    """(unique_q_id, defect) of (unique_q_id, question, category, answer): one row per defective pair."""
    rows = spread(pairs.select("unique_q_id", "question", "category", "answer").where("unique_q_id is not null"))
    judged = staged(rows.mapInPandas(_judged, "unique_q_id string, defect string, grams array<string>, gram string, ends long, places long"))  # read twice
    sure = judged.where("defect is not null").select("unique_q_id", "defect")
    open_ = judged.where("unique_q_id is not null and defect is null").select("unique_q_id", F.posexplode("grams").alias("n", "gram"))
    counts = judged.where("gram is not null").groupBy("gram").agg(F.sum("ends").alias("ends"), F.sum("places").alias("places")).where(F.col("places") >= LEAST_PLACES)
    # the longest run that is known decides; a run that is not known anywhere ends no sentence
    seen = open_.join(counts, "gram", "left").groupBy("unique_q_id").agg(F.max(F.when(F.col("places").isNotNull(), F.struct("n", (F.col("ends") / F.col("places")).alias("share")))).alias("best"))
    cut = seen.where(F.coalesce(F.col("best.share"), F.lit(0.0)) < LEAST_SHARE).select("unique_q_id", F.lit("truncated").alias("defect"))
    return sure.unionByName(cut).distinct()
