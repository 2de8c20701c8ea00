"""Problem 4: the language of every text and of every stretch of a mixed text, with a confidence.

Method: sparse multinomial logistic regression on TF-IDF character n-grams of the words, trained by follow-the-regularised-leader (per
coordinate, elastic net) and then calibrated by a temperature. A text is a sequence of words; its segmentation is the best path through
the words' class evidence with a cost for each change of language, lower where a punctuation mark stands, so single borrowed words and crop
names do not end a segment.

* The model is fitted on the driver on all of ``lang_samples`` and on ``SAMPLE`` labelled rows of the log (smallest hashes of the row id; a
  bounded sample by parameter). Labels that contradict a first fit are left out of the second one. A fifth of the rows is held out for the temperature;
  of these the ones count whose label is confirmed by a model fitted on others of them.
* Every row of the log is labelled. The model (a few thousand weights) goes to the tasks with the function; a task keeps the evidence of
  each word it has met, and the path search is vectorised over the texts of a batch. Texts are shuffled only where there are
  fewer files than cores.

Null and blank texts, and texts without any letter, have no segments. Repeated rows are labelled alike. Texts of any length are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import read, spread

LANGS = ("en", "hi", "mr", "pa", "bn", "ta", "te")
SAMPLE = 20_000
GRAMS = (1, 2, 3, 4)
#: Log-odds that a change of language costs between words, and where a punctuation mark stands.
CHANGE, CHANGE_AT_MARK = 7.0, 3.5
#: The evidence of one word is limited to this many nats against a language.
LIMIT = 4.0

_PIECE = re.compile(r"([^\W\d_][^\s\d,.;:!?।॥|()\[\]{}\"“”/\-–—…*>]*)|([,.;:!?।॥|\n/\-–—…])")


def tokens(text: str) -> tuple[list[str], list[bool]]:
    """The words of a text in lower case, and for each whether a mark stands before it."""
    words, marked, mark = [], [], False
    for word, sign in _PIECE.findall(text):
        if sign:
            mark = True
        else:
            words.append(word.lower())
            marked.append(mark)
            mark = False
    return words, marked


def grams(word: str) -> list[str]:
    w = f"<{word}>"
    return [w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1)]


class Model:
    """Class evidence of single words; picklable."""

    def __init__(self, names: dict[str, int], idf: np.ndarray, weights: np.ndarray, temperature: float = 1.0):
        self.names, self.idf, self.weights, self.temperature = names, idf, weights, temperature

    def vector(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        tf = Counter(self.names[g] for g in grams(word) if g in self.names)
        at = np.fromiter(tf, np.int64, len(tf))
        x = np.fromiter(tf.values(), np.float64, len(tf)) * self.idf[at]
        return at, x / (np.linalg.norm(x) or 1.0)

    def evidence(self, word: str) -> np.ndarray:
        """Log-probabilities by language under equal priors, relative to the best one and limited."""
        at, x = self.vector(word)
        if not len(at):
            return np.zeros(len(LANGS))
        s = x @ self.weights[at]
        return np.maximum(s - s.max(), -LIMIT)


def fit(counts: dict[str, Counter], epochs: int = 12, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> Model:
    """Fit on words with their counts by language. Targets are the shares of a word's language-balanced counts."""
    words = sorted(counts)
    if not words:
        return Model({}, np.zeros(0), np.zeros((0, len(LANGS))))
    raw = np.array([[counts[w].get(k, 0) for k in LANGS] for w in words], np.float64)
    total = np.maximum(raw.sum(0), 1.0)
    target = raw / total
    target /= target.sum(1, keepdims=True)
    df = Counter(g for w in words for g in set(grams(w)))
    names = {g: i for i, g in enumerate(sorted(df))}
    idf = np.array([math.log((1 + len(words)) / (1 + df[g])) + 1 for g in sorted(df)])
    model = Model(names, idf, np.zeros((len(names), len(LANGS))))
    seen = raw.sum(1)
    vectors = [model.vector(w) for w in words]
    weight = np.minimum(np.sqrt(seen), 8.0)
    z, n = np.zeros_like(model.weights), np.zeros_like(model.weights)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for k in rng.permutation(len(words)):
            at, x = vectors[k]
            if not len(at):
                continue
            zz, nn = z[at], n[at]
            w = np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))
            s = x @ w
            p = np.exp(s - s.max())
            g = np.outer(x, p / p.sum() - target[k]) * weight[k]
            sigma = (np.sqrt(nn + g * g) - np.sqrt(nn)) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    model.weights = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return model


def _counted(rows: Iterable[tuple[str, str]], samples: Iterable[tuple[str, str]]) -> dict[str, Counter]:
    """Words with their counts by language; a trusted sample counts as 20 rows."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for weight, part in ((20, samples), (1, rows)):
        for k, t in part:
            for w in tokens(t)[0]:
                counts[w][k] += weight
    return counts


def _agreeing(model: Model, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The rows that a model takes for texts in the language of their label."""
    found = segment(model, [t for _, t in rows], {})
    return [row for row, spans in zip(rows, found) if len(spans) == 1 and spans[0][0] == row[0]]


def train(labelled: Iterable[tuple[str, str]], samples: Iterable[tuple[str, str]]) -> Model:
    """Two fits on (language, text) pairs; ``samples`` are trusted, ``labelled`` may be wrong. The last fifth of the latter calibrates."""
    labelled = [(k, t) for k, t in labelled if k in LANGS and t]
    samples = [(k, t) for k, t in samples if k in LANGS and t]
    held = labelled[len(labelled) * 4 // 5 :]
    used = labelled[: len(labelled) * 4 // 5] if held else labelled
    model = fit(_counted(_agreeing(fit(_counted(used, samples), epochs=4), used), samples))
    model.temperature = calibrated(model, held, samples)
    return model


def calibrated(model: Model, held: list[tuple[str, str]], samples: list[tuple[str, str]]) -> float:
    """The temperature under which the held-out rows are most likely.

    Labels may be wrong, so only rows count whose label is confirmed by a second model that was fitted on the other half of the held-out rows;
    what the model itself makes of a row plays no part. Of each row the whole text and stretches of one to four words count, as
    segments may be short.
    """
    halves = held[::2], held[1::2]
    trusted = [row for mine, other in (halves, halves[::-1]) for row in _agreeing(fit(_counted(other, samples), epochs=4), mine)]
    cache: dict[str, np.ndarray] = {}
    rng = np.random.default_rng(3)
    scores, truth = [], []
    for k, t in trusted:
        words = tokens(t)[0]
        for size in (len(words), int(rng.integers(1, 3)), int(rng.integers(1, 5))):
            at = int(rng.integers(0, max(1, len(words) - size + 1)))
            part = words[at : at + size]
            for w in part:
                if w not in cache:
                    cache[w] = model.evidence(w)
            if part:
                scores.append(np.sum([cache[w] for w in part], axis=0))
                truth.append(LANGS.index(k))
    if not scores:
        return 1.0
    s, y = np.array(scores), np.array(truth)
    best = (math.inf, 1.0)
    for temperature in np.geomspace(0.25, 32, 57):
        v = s / temperature
        v -= v.max(1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(v).sum(1)) - v[np.arange(len(y)), y]))
        best = min(best, (loss, float(temperature)))
    return best[1]


def calibration_error(confidence: np.ndarray, right: np.ndarray, bins: int = 10) -> float:
    """Expected calibration error: the mean distance of confidence and accuracy over bins of confidence."""
    at = np.minimum((np.asarray(confidence) * bins).astype(int), bins - 1)
    n = np.bincount(at, minlength=bins)
    return float(np.abs(np.bincount(at, confidence, bins) - np.bincount(at, np.asarray(right, float), bins)).sum() / max(1, n.sum()))


def segment(model: Model, texts: list[str], cache: dict[str, np.ndarray]) -> list[list[tuple[str, float, int, int]]]:
    """For each text its segments: (language, confidence, first word, one past the last word)."""
    cut = [tokens(t) for t in texts]
    out: list[list[tuple[str, float, int, int]]] = [[] for _ in texts]
    order = sorted((k for k in range(len(texts)) if cut[k][0]), key=lambda k: len(cut[k][0]))
    L = len(LANGS)
    for at in range(0, len(order), 512):
        part = order[at : at + 512]
        n, longest = len(part), len(cut[part[-1]][0])
        e, cost, size = np.zeros((n, longest, L)), np.full((n, longest), CHANGE), np.array([len(cut[k][0]) for k in part])
        for i, k in enumerate(part):
            words, marked = cut[k]
            for w in words:
                if w not in cache:
                    if len(cache) > 200_000:
                        cache.clear()
                    cache[w] = model.evidence(w)
            e[i, : len(words)] = [cache[w] for w in words]
            cost[i, : len(words)][marked] = CHANGE_AT_MARK
        score, back = e[:, 0].copy(), np.zeros((n, longest, L), np.int8)
        final = score.copy()
        for t in range(1, longest):
            top = score.argmax(1)
            jump = score[np.arange(n), top] - cost[:, t]
            leap = jump[:, None] > score
            back[:, t] = np.where(leap, top[:, None], np.arange(L)[None])
            score = np.where(leap, jump[:, None], score) + e[:, t]
            final = np.where((size > t)[:, None], score, final)
        now = final.argmax(1)
        path = np.zeros((n, longest), np.int8)
        for t in range(longest - 1, -1, -1):
            path[:, t] = now
            now = np.where(size > t, back[np.arange(n), t, now], now)
        for i, k in enumerate(part):
            p = path[i, : size[i]]
            edges = [0, *(np.flatnonzero(p[1:] != p[:-1]) + 1).tolist(), int(size[i])]
            for a, b in zip(edges, edges[1:]):
                v = e[i, a:b].sum(0) / model.temperature
                v = np.exp(v - v.max())
                out[k].append((LANGS[p[a]], float(v[p[a]] / v.sum()), a, b))
    return out


def trained(spark: SparkSession, sf_dir: str, sample: int = SAMPLE) -> Model:
    known = [(r[0], r[1]) for r in read(spark, sf_dir, "lang_samples").select("lang", "sample_text").orderBy("sample_id").collect()]
    rows = read(spark, sf_dir, "raw_log").select(F.lower(F.trim("lang_label")).alias("k"), F.col("querytext").alias("t"), F.xxhash64("raw_row_id").alias("h"))
    rows = rows.where(F.col("k").isin(*LANGS) & (F.length(F.trim("t")) > 0))
    share = min(1.0, 1.5 * sample / max(1, rows.count()))  # so that no task sends more than its part of the sample
    rows = rows.where(F.col("h") <= min(2**63 - 1, int((share - 0.5) * 2**64))).orderBy("h", "t").limit(sample)  # bounded by the parameter
    return train([(r["k"], r["t"]) for r in rows.collect()], known)


def segments(texts: DataFrame, model: Model, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, segment_no, lang, confidence, n_segments): one row per segment of each text."""
    rows = spread(texts.select(key, text, *keep).where(F.col(text).isNotNull()))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, np.ndarray] = {}
        for pdf in batches:
            code, distinct = pd.factorize(pdf[text])
            found = segment(model, list(distinct), cache)
            sizes = np.array([len(x) for x in found], np.int64)[code] if len(distinct) else np.zeros(0, np.int64)
            row = np.repeat(np.arange(len(pdf)), sizes)
            flat = [s for c in code for s in found[c]]
            out = pdf[[key, *keep]].iloc[row].reset_index(drop=True)
            out["segment_no"] = (np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1).astype(np.int32)
            out["lang"] = [s[0] for s in flat]
            out["confidence"] = np.array([s[1] for s in flat], np.float64)
            out["n_segments"] = sizes[row].astype(np.int32)
            yield out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != text)
    return rows.mapInPandas(of, f"{schema}, segment_no int, lang string, confidence double, n_segments int")


def mislabelled(rows: DataFrame, model: Model) -> DataFrame:
    """Segments of the texts whose label is missing or wrong or that are in more than one language."""
    found = segments(rows, model, "raw_row_id", "querytext", ("lang_label",))
    label = F.lower(F.trim(F.coalesce("lang_label", F.lit(""))))
    return found.where((F.col("n_segments") > 1) | (label != F.col("lang")))
