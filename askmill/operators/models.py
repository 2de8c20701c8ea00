"""Interfaces to models, and deterministic stand-ins that need none."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> np.ndarray: ...


class Judge(Protocol):
    def reply(self, prompts: list[str]) -> list[str]: ...


class Generator(Protocol):
    def reply(self, systems: list[str], prompts: list[str]) -> list[str]: ...


class HashedWords:
    """Vectors of hashed words: texts that share words are near."""

    def __init__(self, size: int = 256):
        self.size = size

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size), np.float32)
        for k, t in enumerate(texts):
            for w in (t or "").lower().split():
                h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "big")
                out[k, h % self.size] += 1 if h >> 63 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


class SameLetter:
    """A judge that always gives one reply."""

    def __init__(self, text: str = "A"):
        self.text = text

    def reply(self, prompts: list[str]) -> list[str]:
        return [self.text for _ in prompts]


class Echo:
    """A generator that gives the question back in the form asked for."""

    def reply(self, systems: list[str], prompts: list[str]) -> list[str]:
        return [f"CATEGORY: Other\nQUESTION: {p}\nANSWER:\nPlease ask an officer about: {p}" for p in prompts]


def embedded(df: DataFrame, text: str, embedder: Embedder, name: str = "embedding") -> DataFrame:
    """Add vectors; the embedder is sent to each task once and called on Arrow batches."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{name: list(np.asarray(embedder.embed(["" if t is None else t for t in pdf[text]]), np.float32))})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(of, f"{schema}, `{name}` array<float>")


def judged(df: DataFrame, prompt: str, judge: Judge, name: str = "reply") -> DataFrame:
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{name: judge.reply(list(pdf[prompt]))})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(of, f"{schema}, `{name}` string")


def generated(df: DataFrame, system: str, prompt: str, generator: Generator, name: str = "reply") -> DataFrame:
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(**{name: generator.reply(list(pdf[system]), list(pdf[prompt]))})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(of, f"{schema}, `{name}` string")


class BatchService(Protocol):
    """A hosted judge that takes many prompts at once and is asked for the outcome later."""

    def submit(self, requests: list[tuple[str, str, int]]) -> str:
        """Hand in (id, prompt, most tokens of the reply); the id of the batch."""

    def ended(self, batch: str) -> bool: ...

    def results(self, batch: str) -> list[tuple[str, str | None]]:
        """(id, reply) in any order; the reply is null where a request failed."""


class Deferred:
    """A batch service around a judge, for tests: a batch has ended when it has been asked for ``polls`` times; prompts with ``fails`` in them fail."""

    def __init__(self, judge: Judge, polls: int = 2, fails: str | None = None):
        self.judge, self.polls, self.fails, self.batches = judge, polls, fails, {}

    def submit(self, requests: list[tuple[str, str, int]]) -> str:
        name = f"batch{len(self.batches)}"
        self.batches[name] = [list(requests), self.polls]
        return name

    def ended(self, batch: str) -> bool:
        self.batches[batch][1] -= 1
        return self.batches[batch][1] <= 0

    def results(self, batch: str) -> list[tuple[str, str | None]]:
        return [(i, None if self.fails and self.fails in p else self.judge.reply([p])[0]) for i, p, _ in reversed(self.batches[batch][0])]


def judged_in_batches(df: DataFrame, prompt: str, service: BatchService, budget: str | None = None, size: int = 10_000, wait: float = 30.0, name: str = "reply") -> DataFrame:
    """Add the replies of a batch service: each task submits ``size`` prompts at a time, polls until the batch has ended and collects. The
    reply of a failed request is null, which leaves its questions unclassified (``unique.parse_groups``). A prompt of one row is asked once
    per row; stage the result, or a lost task asks again."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies: list[str | None] = [None] * len(pdf)
            tokens = list(pdf[budget]) if budget else [4096] * len(pdf)
            for at in range(0, len(pdf), size):
                batch = service.submit([(str(k), pdf[prompt].iloc[k], int(tokens[k])) for k in range(at, min(at + size, len(pdf)))])
                while not service.ended(batch):
                    time.sleep(wait)
                for k, reply in service.results(batch):
                    replies[int(k)] = reply
            yield pdf.assign(**{name: pd.Series(replies, index=pdf.index, dtype=object)})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(of, f"{schema}, `{name}` string")
