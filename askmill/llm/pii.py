"""Problem 8: personal details in free text, found and replaced by typed placeholders.

Method: a semi-Markov conditional random field. A candidate segment is any span of up to ``LONGEST`` tokens within a line that starts at a
capital, a digit, a phone sign or a word of a script without capitals (in texts of one case: at any word that is not common), under every
kind that its first token allows. A segment is scored as a whole by its shape, the words inside, its length and its surroundings; tokens
outside segments score nothing. The best set of segments that do not overlap is found by dynamic programming over their ends, which
decides boundaries and kinds together. Training maximises the conditional likelihood of the true segmentations with the
forward-backward recursion over the same lattice.

* There are no labelled documents, so the model is trained on ``SENTENCES`` generated sentences of general language whose segments are known
  (module ``pii_training``), once per query, on the driver. None of these sentences is taken from the documents.
* Whether a word is common is a feature, never a filter. Words of the scripts with capitals are common if they stand in lower case in
  ``LEAST_SHARE`` of the documents that mix both cases and in most of those that they are in; words of other scripts if they are in
  ``LEAST_SHARE`` of all; those of the training sentences are common too. Counts cover all documents; as only shares decide, there are at most 1/``LEAST_SHARE`` times the
  distinct words of a mean document of them, at any number of documents, and a document is judged alike in a table of any size with
  the same shares.
* Given names that stand alone are scored again once the full names of the document are known.

The score of a segment is a sum over small groups of features (word inside, word before, pattern, ...), whose weights are added up
once and kept by the task, so a candidate costs a few dictionary reads. A span is only left unextended at the end of a line or sentence.

Every document is read whole, whatever its length; texts are not shuffled. Null and empty texts give no rows. Repeated documents give the
same rows under their own ids. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import spread

KINDS = ("person_name", "phone", "id_number", "email", "address")
PLACEHOLDER = {"person_name": "[NAME]", "phone": "[PHONE]", "id_number": "[ID]", "email": "[EMAIL]", "address": "[ADDRESS]"}
LONGEST = 24
#: Words of a person's name, initials included.
NAME_WORDS = 5
SENTENCES = 4500
LEAST_SHARE = 1 / 2000

#: Digits, words (with the vowel signs of Indian scripts, which are no letters), line ends, signs.
_TOKEN = re.compile(r"\d+|[A-Z]['’][A-Z][a-z]+|[^\W\d_]+(?:(?![\u0964\u0965])[^\d\W\u0900-\u0d7f]*[\u0900-\u0963\u0971-\u09e3\u09f0-\u0a65\u0a70-\u0ae5\u0b70-\u0be5\u0c00-\u0c65\u0d00-\u0d65][^\W\d_]*)*|\n|[^\s]")
_DIGITS = frozenset("zero one two three four five six seven eight nine oh double triple".split())


#: Signs that may end a line or sentence.
_STOPS = frozenset("\n;|!?।.")


class Text:
    """A text with its tokens and the class of each.

    Classes: ``d`` digits, ``c``/``C`` common word in lower case / with a capital, ``u``/``U`` other word, ``A`` other word in capitals, ``I``
    one capital, ``X``/``x`` other / common word of a script without capitals, else the sign itself.
    """

    def __init__(self, text: str, common: frozenset[str], classes: dict[tuple[str, str], str] | None = None):
        self.text = text
        found = list(_TOKEN.finditer(text))
        self.words = [m.group() for m in found]
        self.starts = [m.start() for m in found]
        self.ends = [m.end() for m in found]
        upper, lower = sum(map(str.isupper, text)), sum(map(str.islower, text))
        # both cases, or (nearly) one case
        self.mode = "n" if 0.005 * sum(map(str.isalpha, text)) < upper < 0.85 * (upper + lower) else "o"
        self.low = [w.lower() for w in self.words]
        classes = {} if classes is None else classes
        self.cls = []
        for w, k in zip(self.words, self.low):
            c = classes.get((w, self.mode))
            if c is None:
                if len(classes) > 500_000:
                    classes.clear()
                c = classes[(w, self.mode)] = self._class(w, k, common)
            self.cls.append(c)
        self.gap = [0, *(s - e for s, e in zip(self.starts[1:], self.ends))]
        # what stands at a place, and its class, with two places beyond either end
        self._at = ["^", "^", *("#" if c == "d" else k for c, k in zip(self.cls, self.low)), "^", "^", "^"]
        self._kind = ["^", "^", *self.cls, "^", "^", "^"]
        self._after: dict[tuple[str, int], tuple] = {}
        # the next comma or digits at or after a place, and the next end of a line or sentence after it
        n = len(self.words)
        self.mark, self.stop = [n] * (n + 1), [n] * (n + 1)
        for k in range(n - 1, -1, -1):
            self.mark[k] = k if self.cls[k] in ",d" else self.mark[k + 1]
            self.stop[k] = k if self.cls[k] in _STOPS and _breaks(self, k) else self.stop[k + 1]

    def _class(self, w: str, low: str, common: frozenset[str]) -> str:
        a = w[0]
        if a.isdigit():
            return "d"
        if not a.isalpha():
            return w
        known = low in common
        if a.lower() == a.upper():
            return "x" if known else "X"
        if len(w) == 1 and (a.isupper() or self.mode == "o"):
            return "I"
        if self.mode == "o":
            return "c" if known else "U"
        if a.isupper():
            return "C" if known else "A" if len(w) > 3 and w.isupper() else "U"
        return "c" if known else "u"

    def at(self, k: int) -> str:
        return self._at[k + 2]

    def kind(self, k: int) -> str:
        return self._kind[k + 2]

    def before(self, i: int, kind: str) -> tuple:
        """The group for what stands before token i."""
        return kind, "b", self._at[i + 1], self._kind[i + 1], self._at[i], self._kind[i], self.gap[i] > 0

    def after(self, j: int, kind: str) -> tuple:
        """The group for what stands from token j on."""
        g = self._after.get((kind, j))
        if g is None:
            g = self._after[(kind, j)] = (kind, "a", self._at[j + 2], self._kind[j + 2], self._at[j + 3], self._kind[j + 3], j < len(self.gap) and self.gap[j] > 0)
        return g


class Run:
    """The groups of a growing run of tokens; each candidate that ends in it shares the sum of their weights."""

    __slots__ = ("before", "group", "value")

    def __init__(self, before: Run | None, group: tuple):
        self.before, self.group, self.value = before, group, None

    def groups(self) -> list[tuple]:
        return [*(self.before.groups() if self.before else ()), self.group]


#: A segment with the groups of features that score it: (first token, one past the last, kind, groups).
Candidate = tuple[int, int, str, list]
_NAMELIKE = frozenset("UAXICx")
_WORDLIKE = frozenset("cCuUAIXx")


def _breaks(t: Text, k: int) -> bool:
    """Does the token end the line or, as a full stop, the sentence?"""
    w = t.words[k]
    if w == "\n" or w in ";|!?।":
        return True
    if w != "." or k + 1 >= len(t.words) or not t.gap[k + 1]:
        return w == "." and k + 1 >= len(t.words)
    before = t.low[k - 1] if k else ""
    return len(before) > 4 or (len(before) == 4 and t.cls[k - 1] == "c") or not before[:1].isalpha()  # else it may shorten a word


def candidates(t: Text, known: frozenset[str] = frozenset()) -> Iterator[Candidate]:
    """All segments that could be a personal detail, with the groups of features that score them."""
    n = len(t.words)
    words, cls, gap = t.words, t.cls, t.gap
    mail = "@" in words or "at" in t.low
    for i in range(n):
        c = cls[i]
        if i and not gap[i] and cls[i - 1] in _WORDLIKE | {"d"} and c != "(":
            continue  # within a word
        if c == "d" or words[i] in "+(" or t.low[i] in _DIGITS:
            yield from _numbers(t, i)
        if c in _WORDLIKE or c == "d":
            if i + 1 < n and not gap[i + 1]:
                yield from _codes(t, i)
            if mail:
                yield from _emails(t, i)
        if c in "UAXIx" or (c == "C" and t.mode == "n"):
            yield from _names(t, i, known)
        if c in "dUAXIC#" or (c == "c" and (t.mode == "o" or t.kind(i + 1) == "d" or t.at(i + 1) == ".")):
            yield from _addresses(t, i)


def _numbers(t: Text, i: int) -> Iterator[Candidate]:
    """Runs of digits, or of words for digits, with single signs and blanks between them."""
    shape, digits, j = [], 0, i
    spoken = t.low[i] in _DIGITS
    before = t.before(i, "phone")
    while j < len(t.words) and j - i < LONGEST:
        w = t.words[j]
        blank = "_" if j > i and t.gap[j] else ""
        if t.gap[j] > 1 and j > i:
            return
        if spoken and t.low[j] in _DIGITS:
            digits += 1
            j += 1
            if digits >= 5:
                yield i, j, "phone", [("phone", "spoken", min(digits, 13), t.low[j] in _DIGITS if j < len(t.words) else False, t.low[i - 1] in _DIGITS if i else False), before, t.after(j, "phone")]
            continue
        if spoken and w in ",-":
            j += 1
            continue
        if not spoken and t.cls[j] == "d":
            digits += len(w)
            if digits > 16:
                return
            shape.append(f"{blank}{len(w)}")
            j += 1
            if digits >= 5:
                goes = "".join(("_" if t.gap[j] else "", t.kind(j))) if j < len(t.words) else "^"
                goes2 = t.kind(j + 1) if goes in ("-", ".", "/", "_-") else ""
                from_ = "".join((t.kind(i - 1), "_" if t.gap[i] else "")) if i else "^"
                from2 = t.kind(i - 2) if from_ in ("-", ".", "/", "-_", "+", "+_") else ""
                whole = "".join(shape)
                for kind in ("phone", "id_number"):
                    yield i, j, kind, [(kind, "shape", whole, digits), (kind, "goes", goes, goes2), (kind, "from", from_, from2), t.before(i, kind), t.after(j, kind)]
            continue
        if not spoken and w in "+().-/" and not (w == "+" and j > i):
            shape.append(blank + w)
            j += 1
            continue
        return


def _codes(t: Text, i: int) -> Iterator[Candidate]:
    """One unbroken run of letters and digits, such as the number of a card."""
    j, shape, digits = i, [], 0
    while j < len(t.words) and (j == i or not t.gap[j]) and t.cls[j] in _WORDLIKE | {"d"} and j - i < 8 and ord(t.words[j][0]) < 0x250:
        shape.append(("9" if t.cls[j] == "d" else "a") + str(len(t.words[j])))
        digits += len(t.words[j]) if t.cls[j] == "d" else 0
        j += 1
    if 1 < j - i and digits >= 3:
        goes = t.kind(j) if j < len(t.words) and not t.gap[j] else "_"
        yield i, j, "id_number", [("id_number", "code", "".join(shape), digits), ("id_number", "goes", goes, t.kind(j + 1) if goes in "-./" else ""), t.before(i, "id_number"), t.after(j, "id_number")]


def _emails(t: Text, i: int) -> Iterator[Candidate]:
    """A local part, an at sign or a word for it, and a domain whose dots may be words; each end of the domain is a candidate."""
    n, k = len(t.words), i
    while k + 1 < n and not t.gap[k + 1] and k - i < 10 and (t.cls[k + 1] in _WORDLIKE | {"d"} or t.words[k + 1] in "._+-%"):
        k += 1
    k += 1
    sign, k = _mark(t, k, "@", "at")
    if not sign:
        return
    before = t.kind(i - 1) if not t.gap[i] else "_"
    dots, how = 0, sign
    last = k
    while k < n and (t.cls[k] in _WORDLIKE or t.cls[k] == "d"):
        k += 1
        while k + 1 < n and not t.gap[k] and not t.gap[k + 1] and (t.words[k] == "-" or t.words[k] == "_") and t.cls[k + 1] in _WORDLIKE | {"d"}:
            k += 2
        while k < n and not t.gap[k] and t.cls[k] in _WORDLIKE | {"d"}:
            k += 1
        last = k
        dot, then = _mark(t, k, ".", "dot")
        more = bool(dot) and then < n and t.cls[then] in _WORDLIKE and (dot != "." or not (t.gap[then] or t.gap[k]))
        yield i, last, "email", [("email", "how", how, min(dots, 4), more), ("email", "mark", sign, before), t.before(i, "email"), t.after(last, "email")]
        if not more:
            return
        dots, how, k = dots + 1, sign + dot, then


def _mark(t: Text, k: int, sign: str, word: str) -> tuple[str, int]:
    """The sign, or the word for it, at token k with or without brackets: (how it is written or '', the token after it)."""
    n = len(t.words)
    if k < n and t.words[k] == sign:
        return ("_" if t.gap[k] else "") + sign, k + 1
    if k + 2 < n and t.words[k] in "([{<" and t.low[k + 1] in (word, sign) and t.words[k + 2] in ")]}>":
        return "[" + word, k + 3
    if k < n and t.low[k] == word and t.gap[k]:
        return word, k + 1
    return "", k


def _names(t: Text, i: int, known: frozenset[str]) -> Iterator[Candidate]:
    """One to NAME_WORDS words side by side, initials with or without a full stop among them."""
    n, j, count = len(t.words), i, 0
    pattern, inner = [], []
    before = t.before(i, "person_name")
    first = t.low[i]
    while j < n and count < NAME_WORDS:
        c = t.cls[j]
        if c not in _NAMELIKE or (j > i and t.gap[j] != 1 and not (t.words[j - 1] == "." and t.gap[j] == 0)) or (t.words[j].islower() and t.mode == "n" and c != "X" and c != "x"):
            return
        count += 1
        pattern.append(c)
        inner.append(("person_name", "w", t.low[j], c, count == 1))
        j += 1
        end, shape = j, "".join(pattern)
        if c == "I" and j < n and t.words[j] == "." and not t.gap[j]:
            pattern.append(".")
            j += 1
        if count == 1 and c in "IC":
            continue  # an initial or a common word alone is no name: it scores with what follows
        on = end < n and t.gap[end] == 1 and t.cls[end] in "UAXI"
        prev = i > 0 and t.gap[i] == 1 and t.cls[i - 1] in "UAXI"
        dot = i > 1 and t.words[i - 1] == "." and t.cls[i - 2] == "I"
        groups = [("person_name", "p", shape, t.mode), ("person_name", "on", on, prev, dot, min(count, 3), t.kind(end), t.mode), ("person_name", "len", min(len(t.words[end - 1]), 4), c, count), *inner, before, t.after(end, "person_name")]
        if count == 1:
            groups.append(("person_name", "alone", first in known, t.kind(i - 1), t.at(i - 1), t.at(end)))
        yield i, end, "person_name", groups


def _addresses(t: Text, i: int) -> Iterator[Candidate]:
    """From a word or number that may name a house on to each word or number up to LONGEST tokens further; a comma or number must be inside."""
    n, stop = len(t.words), t.stop[i + 1]
    if t.mark[i] >= min(stop, i + LONGEST):
        return
    commas = words = small = numbers = 0
    top = ""  # the classes before the first comma
    inner: Run | None = None
    before = t.before(i, "address")
    lead = "d" if t.cls[i] == "d" else t.cls[i]
    head = [("address", "lead", t.low[i] if lead != "d" else "#", lead, t.kind(i + 1) if i + 1 < n else "^")]
    back = ("address", "from", t.kind(i - 1), i > 0 and t.gap[i] > 0, t.at(i - 2) if t.kind(i - 1) in ".,-" else "", t.cls[i - 2] if i > 1 else "^")
    for j in range(i, min(n, stop, i + LONGEST)):
        c, w = t.cls[j], t.words[j]
        if not commas:
            top += c
        if c == "d":
            numbers += 1
            inner = Run(inner, ("address", "d", min(len(w), 7), j == i))
        elif c in _WORDLIKE:
            words += 1
            small += c in "cx"
            inner = Run(inner, ("address", "w", t.low[j], c, j == i))
        elif w == ",":
            commas += 1
            if commas == 1:
                head.append(("address", "top", top[:6], t.low[j - 1] if t.cls[j - 1] in _WORDLIKE else "#"))
            continue
        elif w in "-/.#():'&–":
            inner = Run(inner, ("address", "s", w, t.at(j - 1) if w == "." else ""))
            continue
        else:
            return
        if words + numbers < 3 or not commas + numbers or small > 5 or (t.mode == "n" and c == "c"):
            if small > 5:
                return
            continue
        pin = c == "d" and len(w) == 6
        after, then = t.kind(j + 1), t.kind(j + 2)
        nearby = "pin" if (after == "d" and len(t.words[j + 1]) == 6) or (after in (",", "-", "–") and then == "d" and len(t.words[j + 2]) == 6) else "word" if after == "," and then in "UAXI" and j + 3 < n else "join" if after in "UAXICd" and t.gap[j + 1] == 1 else "part" if after in ("-", "/") and not t.gap[j + 1] else after if after in (",", ".", "\n", "^") else "w"
        where = "pin" if pin else "d" if c == "d" else c
        prior = t.at(j - 1) if j > i else ""
        yield i, j + 1, "address", [
            *head, back, inner, ("address", "end", where, nearby), ("address", "last", t.low[j] if c in "cCUA" else where, nearby), ("address", "before last", prior if prior in ",-–" or t.cls[j - 1] in "cC" else "w", where),
            ("address", "counts", min(commas, 4), min(numbers, 4), lead == "d", min(words, 9), pin, min(small, 4)), before, t.after(j + 1, "address"),
        ]


def features(group: tuple) -> list[str]:
    """The features of a group."""
    kind, what = group[0], group[1]
    f = [f"{kind}|{what}|{'|'.join(map(str, group[2:]))}"]
    if what == "b":
        w, c, w2, c2, gap = group[2:]
        return [f"{kind}|b|{w}", f"{kind}|bc|{c}|{gap}", f"{kind}|b2|{w2}|{w}", f"{kind}|bcc|{c2}|{c}|{gap}", f"{kind}|b3|{w2}|{c}"]
    if what == "a":
        w, c, w2, c2, gap = group[2:]
        return [f"{kind}|a|{w}", f"{kind}|ac|{c}|{gap}", f"{kind}|a2|{w}|{w2}", f"{kind}|acc|{c}|{c2}|{gap}"]
    if what == "w":
        w, c, first = group[2:]
        return [f"{kind}|w|{w}", f"{kind}|wf|{w}|{first}", f"{kind}|wc|{c}|{first}", f"{kind}|s3|{w[-3:]}", f"{kind}|n|{min(len(w), 5)}"]
    if what == "shape":
        return [*f, f"{kind}|digits|{group[3]}", f"{kind}|signs|{re.sub('[0-9]+', '9', group[2])}", f"{kind}|groups|{sum(x.isdigit() for x in re.split('([0-9]+)', group[2]))}", f"{kind}|start|{group[2][:1] in '+(' and group[2][:1]}|{group[3]}"]
    if what == "code":
        return [*f, f"{kind}|letters|{re.sub('[0-9]', '', group[2])}"]
    if what == "p":
        return [*f, f"{kind}|size|{len(group[2].replace('.', ''))}", f"{kind}|bias", f"{kind}|common|{group[2].count('C') + group[2].count('x')}", f"{kind}|initial|{'I' in group[2]}"]
    if what == "on":
        return [f"{kind}|on|{group[2]}|{group[7]}", f"{kind}|prev|{group[3]}|{group[7]}", f"{kind}|dot|{group[4]}", f"{kind}|on+|{group[6]}|{group[5]}"]
    if what == "alone":
        known, c, b, a = group[2:]
        return [f"{kind}|alone|{known}", f"{kind}|alone|{known}|{c}", f"{kind}|alone b|{b}|{known}", f"{kind}|alone a|{a}|{known}", f"{kind}|alone ab|{b}|{a}"]
    if what == "lead":
        return [f"{kind}|lead|{group[2]}", f"{kind}|leadc|{group[3]}|{group[4]}"]
    if what == "counts":
        commas, numbers, lead, words, pin, small = group[2:]
        return [f"{kind}|size|{commas}|{numbers}|{lead}", f"{kind}|size1|{commas}", f"{kind}|size2|{numbers}|{lead}", f"{kind}|words|{words}|{commas > 0}|{pin}", f"{kind}|words1|{words}", f"{kind}|words2|{commas > 0}|{pin}", f"{kind}|small|{small}", f"{kind}|bias"]
    if what in ("top", "end", "last", "from", "how", "mark"):
        return [*f, f"{kind}|{what}1|{group[2]}", f"{kind}|{what}2|{'|'.join(map(str, group[3:]))}", f"{kind}|bias"]
    return f


class Model:
    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self._sums: dict[tuple, float] = {}
        self.common: frozenset[str] | None = None
        self.classes: dict[tuple[str, str], str] = {}  # of words under these common ones

    def __getstate__(self):
        return {"weights": self.weights, "_sums": {}, "common": None, "classes": {}}

    def one(self, group: tuple) -> float:
        """The weight of a group."""
        s = self._sums.get(group)
        if s is None:
            if len(self._sums) > 500_000:
                self._sums.clear()
            s = self._sums[group] = sum(self.weights.get(f, 0.0) for f in features(group))
        return s

    def score(self, groups: list[tuple | Run]) -> float:
        out, sums = 0.0, self._sums
        for g in groups:
            if type(g) is Run:
                out += g.value if g.value is not None else self._run(g)
            else:
                s = sums.get(g)
                out += self.one(g) if s is None else s
        return out

    def _run(self, run: Run) -> float:
        todo = []
        r: Run | None = run
        while r is not None and r.value is None:
            todo.append(r)
            r = r.before
        value = r.value if r is not None else 0.0
        for r in reversed(todo):
            value = r.value = value + self.one(r.group)
        return value

    def scored(self, found: Iterator[Candidate]) -> list[tuple[int, int, str, float]]:
        """(end, start, kind, score) of the candidates that score more than none."""
        return [(c[1], c[0], c[2], s) for c in found if (s := self.score(c[3])) > 0]

    def decode(self, found: Iterator[Candidate]) -> list[tuple[int, int, str]]:
        return best_segments(self.scored(found))


def best_segments(scored: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str]]:
    """The best set of segments that do not overlap: semi-Markov Viterbi over (end, start, kind, score), free tokens scoring 0."""
    if not scored:
        return []
    scored = sorted(scored)
    ends = [x[0] for x in scored]
    best, take = [0.0], []
    for k, (_, start, _, s) in enumerate(scored):
        j = bisect_right(ends, start, 0, k)
        take.append((best[j] + s > best[k], j))
        best.append(max(best[k], best[j] + s))
    out, k = [], len(scored)
    while k:
        yes, j = take[k - 1]
        if yes:
            end, start, kind, _ = scored[k - 1]
            out.append((start, end, kind))
            k = j
        else:
            k -= 1
    return out[::-1]


def train(examples: list[tuple[list[Candidate], set[tuple[int, int, str]]]], epochs: int = 5, rate: float = 0.4, l2: float = 3e-5) -> Model:
    """Adaptive gradient steps on the conditional log-likelihood; expectations by forward-backward over the lattice of segments."""
    number: dict[str, int] = {}
    of_group: dict[tuple, list[int]] = {}
    made = []
    for found, gold in examples:
        found = sorted(found, key=lambda c: (c[1], c[0]))
        if not found:
            continue
        flat, rows = [], []
        for k, c in enumerate(found):
            for g in [x for y in c[3] for x in (y.groups() if type(y) is Run else (y,))]:
                ids = of_group.get(g)
                if ids is None:
                    ids = of_group[g] = [number.setdefault(f, len(number)) for f in features(g)]
                flat += ids
                rows += [k] * len(ids)
        points = sorted({0, *(c[0] for c in found), *(c[1] for c in found)})
        at = {p: k for k, p in enumerate(points)}
        made.append((np.array(flat), np.array(rows), [(at[c[0]], at[c[1]]) for c in found], np.array([(c[0], c[1], c[2]) in gold for c in found], float), len(points)))
    w, squares = np.zeros(len(number)), np.full(len(number), 1e-2)
    mean, kept = np.zeros(len(number)), 0
    order = np.random.default_rng(5)
    for epoch in range(epochs):
        for x in order.permutation(len(made)):
            flat, rows, spans, gold, m = made[x]
            score = np.bincount(rows, w[flat], len(spans))
            p = _marginals(spans, score.tolist(), m)
            g = gold - p
            keep = np.abs(g) > 1e-3
            if not keep.any():
                continue
            use = keep[rows]
            ids, back = np.unique(flat[use], return_inverse=True)
            step = np.bincount(back, g[rows[use]], len(ids)) - l2 * w[ids]
            squares[ids] += step * step
            w[ids] += rate * step / np.sqrt(squares[ids])
        if 2 * epoch >= epochs - 1:  # the mean of the later epochs' ends
            mean, kept = mean + w, kept + 1
    w = mean / max(1, kept)
    return Model({f: float(w[k]) for f, k in number.items() if abs(w[k]) > 1e-3})


def _marginals(spans: list[tuple[int, int]], score: list[float], m: int) -> np.ndarray:
    """Probability of each segment (sorted by end) under the model."""
    alpha, beta = [0.0] * m, [0.0] * m
    k, n = 0, len(spans)
    for e in range(1, m):
        values = [alpha[e - 1]]
        while k < n and spans[k][1] == e:
            values.append(alpha[spans[k][0]] + score[k])
            k += 1
        alpha[e] = values[0] if len(values) == 1 else _sum(values)
    starts = sorted(range(n), key=lambda x: -spans[x][0])
    k = 0
    for s in range(m - 1, -1, -1):
        values = [beta[s + 1]] if s + 1 < m else [0.0]
        while k < n and spans[starts[k]][0] == s:
            values.append(beta[spans[starts[k]][1]] + score[starts[k]])
            k += 1
        beta[s] = values[0] if len(values) == 1 else _sum(values)
    z = alpha[-1]
    return np.array([math.exp(min(0.0, alpha[a] + s + beta[b] - z)) for (a, b), s in zip(spans, score)])


def _sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def find(model: Model, text: str, common: frozenset[str]) -> list[tuple[int, int, str]]:
    """The personal details of a text: (start, end, kind), in order."""
    if model.common is not common:
        model.common, model.classes = common, {}
    t = Text(text, common, model.classes)
    scored = model.scored(candidates(t))
    found = best_segments(scored)
    known = frozenset(t.low[i] for i, j, k in found if k == "person_name" and sum(c in _WORDLIKE for c in t.cls[i:j]) > 1 and t.cls[i] != "I")
    if known and sum(w in known for w in t.low) > len(known):  # only names that start with a known word score otherwise now
        again = {i for i, w in enumerate(t.low) if w in known}
        scored = [x for x in scored if x[2] != "person_name" or x[1] not in again]
        found = best_segments(scored + model.scored(c for i in sorted(again) if t.cls[i] in "UAXIxC" for c in _names(t, i, known)))
    return [(t.starts[i], t.ends[j - 1], k) for i, j, k in found]


def common_words(documents: DataFrame, text: str = "text") -> frozenset[str]:
    """The common words of the documents; see the module's text for the rule and the bound."""
    pattern = r"(?<![\p{L}\p{M}\p{N}.@_+\-])\p{L}[\p{L}\p{M}]+(?![\p{L}\p{M}\p{N}@_+\-]|\.\p{L})"
    x = F.col(text)
    mixed = F.lower(x) != x
    rows = documents.select(x.alias("t"), mixed.alias("m"), x.rlike("[a-z]").alias("s")).where("t is not null and (not m or s)")
    words = rows.select("m", F.explode(F.array_distinct(F.regexp_extract_all("t", F.lit(pattern), F.lit(0)))).alias("w"))
    # a text of one case tells nothing about the words of scripts with capitals
    words = words.where(F.col("m") | ~F.col("w").rlike(r"^[a-z]"))
    small, low = F.col("w") == F.lower("w"), F.lower("w")
    counts = words.groupBy("w").count().groupBy(low.alias("w")).agg(F.sum("count").alias("all"), F.sum(F.when(small, F.col("count")).otherwise(0)).alias("small"))
    n = documents.count()
    found = counts.where((F.col("small") >= n * LEAST_SHARE) & (2 * F.col("small") >= F.col("all"))).select("w").collect()  # bounded: see the module's text
    from .pii_training import lexicon

    return lexicon() | {r["w"] for r in found}


def details(documents: DataFrame, model: Model, common: frozenset[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, redacted, kinds, texts) of every document with a text: the text with placeholders, and what they stand for."""
    rows = spread(documents.select(key, text).where(F.col(text).isNotNull()))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            redacted, kinds, texts = [], [], []
            for x in pdf[text]:
                spans = find(model, x, common)
                parts, at = [], 0
                for s, e, k in spans:
                    parts += [x[at:s], PLACEHOLDER[k]]
                    at = e
                redacted.append("".join([*parts, x[at:]]))
                kinds.append([k for _, _, k in spans])
                texts.append([x[s:e] for s, e, _ in spans])
            yield pd.DataFrame({key: pdf[key], "redacted": redacted, "kinds": kinds, "texts": texts})

    return rows.mapInPandas(of, f"`{key}` {dict(rows.dtypes)[key]}, redacted string, kinds array<string>, texts array<string>")


def trained(sentences: int = SENTENCES) -> Model:
    from .pii_training import examples

    return train(examples(sentences))


def found(documents: DataFrame, model: Model, common: frozenset[str]) -> DataFrame:
    """(doc_id, pii_kind, found_text): each distinct text once per document and kind."""
    both = details(documents, model, common).select("doc_id", F.explode(F.array_distinct(F.arrays_zip(F.col("kinds").alias("pii_kind"), F.col("texts").alias("found_text")))).alias("x"))
    return both.select("doc_id", "x.pii_kind", "x.found_text")
