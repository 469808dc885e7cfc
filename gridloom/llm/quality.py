"""Quality classifier: supervised subword embeddings trained by numpy stochastic gradient descent.

Every token contributes its own hashed vector, those of its character n-grams, and that of the word bigram
it forms with its successor; a token that repeats its predecessor also contributes one vector that all such
bigrams share.  A document is the mean of all its vectors, the output layer is a softmax.  After training
the vectors are projected on the output layer, so that scoring needs one number for each hash bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridloom.llm.common import held_out, labelled_sample

SAMPLE = 2000
"""At most so many labelled documents train the model (those with the smallest id hash)."""
CACHE_WORDS, CACHE_CHARS, LONG_CHARS, STEP = 250_000, 64, 1 << 22, 64
END, REPEAT = "\x02end", "\x02repeat"


@dataclass(frozen=True)
class Shape:
    buckets: int = 1 << 18
    dim: int = 12
    least: int = 3
    most: int = 5
    steps: int = 3_000
    rate: float = 0.4


_MULTIPLIER, _MIX = np.uint32(0x01000193), np.uint32(0x85EBCA6B)


def _bucket(feature: str, buckets: int) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % buckets


def word_hash(token: str) -> int:
    return zlib.crc32(token.encode("utf-8", "surrogatepass"))


def bigrams(hashes: np.ndarray, shape: Shape) -> np.ndarray:
    """Buckets of the word bigrams of a text, from its words' hashes; they follow those of words and characters."""
    mixed = (hashes[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (hashes[1:].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return ((mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.int64) % shape.buckets + shape.buckets


def features(tokens: list[str], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all tokens, and for each the number of its token: token itself, n-grams of ``<token>``."""
    codes = np.frombuffer("".join([f"<{w}>" for w in tokens]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 2
    owner = np.repeat(np.arange(len(tokens)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))
    ids = [np.fromiter((_bucket("\x01" + w, shape.buckets) for w in tokens), dtype=np.int64, count=len(tokens))]
    owners = [np.arange(len(tokens))]
    rolled = np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, shape.most + 1):
        last = len(codes) - n + 1
        if last <= 0:
            break
        rolled = rolled[:last] * _MULTIPLIER + codes[n - 1 :]
        if n >= shape.least:
            at = np.flatnonzero(left[:last] >= n)
            mixed = (rolled[at] + np.uint32(n)) * _MIX
            ids.append(((mixed ^ (mixed >> np.uint32(15))) % np.uint32(shape.buckets)).astype(np.int64))
            owners.append(owner[at])
    return np.concatenate(ids), np.concatenate(owners)


def _bag(text: str, shape: Shape, known: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    words = text.split()
    new = list(set(words) - known.keys())
    if new:
        ids, owner = features(new, shape)
        order = np.argsort(owner, kind="stable")
        known.update(zip(new, np.split(ids[order], np.cumsum(np.bincount(owner, minlength=len(new)))[:-1]), strict=True))
    own = np.array([_bucket(END, shape.buckets)] + [_bucket(REPEAT, shape.buckets)] * sum(map(eq, words, words[1:])), dtype=np.int64)
    pairs = bigrams(np.fromiter(map(word_hash, words), dtype=np.uint32, count=len(words)), shape)
    return np.unique(np.concatenate([own, pairs, *map(known.__getitem__, words)]), return_counts=True)


def train(rows: list[tuple[str, int]], shape: Shape = Shape(), seed: int = 7) -> np.ndarray:
    """Projected weight (log odds of label 1) of each bucket.  No rows or one class: the prior."""
    ys = np.array([y for _, y in rows], dtype=np.int64)
    if len(ys) == 0 or ys.min() == ys.max():
        return np.full(2 * shape.buckets, 0.0 if len(ys) == 0 else (4.0 if ys[0] else -4.0), dtype=np.float32)
    rng = np.random.default_rng(seed)
    known: dict[str, np.ndarray] = {}
    bags = []
    for text, _ in rows:
        ids, n = _bag(text, shape, known)
        bags.append((ids, (n / n.sum()).astype(np.float32)))
        if len(known) > CACHE_WORDS:
            known.clear()
    vectors = rng.uniform(-1 / shape.dim, 1 / shape.dim, (2 * shape.buckets, shape.dim)).astype(np.float32)
    out = np.zeros((2, shape.dim), dtype=np.float32)
    epochs = int(min(40, max(2, shape.steps // len(rows))))
    done, total = 0, epochs * len(rows)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            ids, share = bags[k]
            mean = share @ vectors[ids]
            z = out @ mean
            p = np.exp(z - z.max())
            p /= p.sum()
            p[ys[k]] -= 1
            step = shape.rate * (1 - done / total)
            back = p @ out
            out -= step * np.outer(p, mean)
            # a mean over thousands of vectors moves each of them little; scaled up, training needs few epochs
            vectors[ids] -= (step * 8) * np.outer(np.sqrt(share), back)
            done += 1
    return (vectors @ (out[1] - out[0])).astype(np.float32)


class Words(dict):
    """token -> its place in arrays of weight sums, numbers of features and hashes; bounded, so memory does not follow the corpus."""

    def __init__(self, weights: np.ndarray, shape: Shape, most: int = CACHE_WORDS):
        super().__init__()
        self.weights, self.shape, self.most = weights, shape, most
        self.end, self.repeat = (float(weights[_bucket(x, shape.buckets)]) for x in (END, REPEAT))
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self.sums, self.counts, self.hashes = np.zeros(1 << 12), np.zeros(1 << 12), np.zeros(1 << 12, dtype=np.uint32)
        self.long_chars = 0

    def learn(self, tokens: set[str]) -> None:
        """Holds all ``tokens``, and starts afresh where they or long ones grow too many."""
        new = [w for w in tokens if w not in self]
        if new and (len(self) + len(new) > self.most or self.long_chars > LONG_CHARS):
            self._reset()
            new = list(tokens)
        if not new:
            return
        ids, owner = features(new, self.shape)
        first, n = len(self), len(new)
        while first + n > len(self.sums):
            self.sums, self.counts, self.hashes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.sums, self.counts, self.hashes))
        self.sums[first : first + n] = np.bincount(owner, weights=self.weights[ids], minlength=n)
        self.counts[first : first + n] = np.bincount(owner, minlength=n)
        self.hashes[first : first + n] = np.fromiter(map(word_hash, new), dtype=np.uint32, count=n)
        self.update(zip(new, range(first, first + n), strict=True))
        self.long_chars += sum(len(w) for w in new if len(w) > CACHE_CHARS)


def score_texts(texts: list[str | None], words: Words) -> list[float]:
    """Probability of label 1 for each text."""
    split = [(t or "").split() for t in texts]
    words.learn(set().union(*split))
    out = []
    for tokens in split:
        at = np.fromiter(map(words.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        again = int((at[1:] == at[:-1]).sum())
        total = words.end + again * words.repeat + float(words.sums[at].sum())
        if len(tokens) > 1:
            total += float(words.weights[bigrams(words.hashes[at], words.shape)].sum(dtype=np.float64))
        n = 1 + again + float(words.counts[at].sum()) + max(0, len(tokens) - 1)
        out.append(float(1 / (1 + np.exp(-np.clip(total / n, -30, 30)))))
    return out


def scorer(spark: SparkSession, weights: np.ndarray, shape: Shape = Shape()):
    """Column function text -> probability of label 1."""
    held = spark.sparkContext.broadcast((weights, shape))

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = Words(*held.value)
        for batch in texts:
            rows = batch.tolist()
            yield pd.Series([p for k in range(0, len(rows), STEP) for p in score_texts(rows[k : k + STEP], words)], dtype="float64")

    return score


def fit(docs: DataFrame, labels: DataFrame, shape: Shape = Shape(), sample: int = SAMPLE) -> np.ndarray:
    """Train on at most ``sample`` whole labelled documents outside the held-out fold."""
    return train(labelled_sample(docs, labels, "quality", sample), shape)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts get the score of the end mark alone; very long texts are scored whole.  Repeated
    rows are scored each; null ids stay and are not held out; a score at the threshold counts as 1; an empty
    table gives no rows.  Only doc_id and text are read, so
    further columns cannot clash.
    """
    score = scorer(docs.sparkSession, fit(docs, labels, sample=sample))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """Rows of ``docs``, all columns, whose score reaches ``threshold``."""
    score: Column = scorer(docs.sparkSession, fit(docs, labels, sample=sample))("text")
    return docs.filter(score >= threshold)
