"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact verification.

Each benchmark item has a 64-bit SimHash of its weighted word shingles.  Of a document, windows as
long as the item are fingerprinted wherever a shingle of that item anchors them; a window without any
of the item's shingles has similarity zero, so leaving it out loses nothing.  Items within the radius
are found through block tables that by the pigeonhole principle hold all of them, and the similarity
of the weighted shingles, computed exactly, decides.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

WORD = re.compile(r"[^\W_]+")
SHINGLE, SIMILARITY, RADIUS, BLOCKS = 5, 0.8, 23, 8
MOST_ITEMS, MOST_CHARS = 200_000, 500_000_000
"""Benchmarks beyond these are refused: they go to every task whole."""
HIT = "array<struct<item_id:long,similarity:double,start:int,words:int>>"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _hash(shingle: tuple[str, ...]) -> int:
    return xxhash.xxh64_intdigest(" ".join(shingle).encode("utf-8", "surrogatepass"), 42)


def shingles(words: list[str]) -> list[tuple[str, ...]]:
    """Runs of five words; of fewer words, the whole sequence; of none, nothing."""
    if not words:
        return []
    return [tuple(words[k : k + SHINGLE]) for k in range(max(1, len(words) - SHINGLE + 1))]


def weighted(counts: Counter, weights: dict) -> float:
    return sum(n * weights.get(s, 1.0) for s, n in counts.items())


def similarity(a: Counter, b: Counter, weights: dict) -> float:
    """Weighted Jaccard of two shingle multisets."""
    both = weighted(a & b, weights)
    either = weighted(a | b, weights)
    return both / either if either else 0.0


def simhash(counts: Counter, weights: dict) -> int:
    """Bits on which the weighted shingles vote above half."""
    if not counts:
        return 0
    h = np.array([_hash(s) for s in counts], dtype=np.uint64)
    w = np.array([n * weights.get(s, 1.0) for s, n in counts.items()])
    bits = np.unpackbits(h.view(np.uint8).reshape(len(h), 8), axis=1, bitorder="little")
    return int(np.packbits((w @ bits) * 2 > w.sum(), bitorder="little").view(np.uint64)[0])


class Blocks:
    """Multi-index: fingerprints by each of eight bytes; at radius r one byte differs in r // 8 bits at most."""

    def __init__(self, prints: list[int], radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        self.tables: list[dict[int, list[int]]] = [{} for _ in range(BLOCKS)]
        for k, p in enumerate(prints):
            for b in range(BLOCKS):
                self.tables[b].setdefault(p >> (8 * b) & 255, []).append(k)
        self.near = [v for v in range(256) if v.bit_count() <= radius // BLOCKS]

    def within(self, p: int) -> set[int]:
        found: set[int] = set()
        for b, flip in product(range(BLOCKS), self.near):
            found.update(self.tables[b].get((p >> (8 * b) & 255) ^ flip, ()))
        return {k for k in found if (self.prints[k] ^ p).bit_count() <= self.radius}


def between(starts: list[int], size: int) -> Iterator[int]:
    """The starts, and all that lie between two of them less than ``size`` apart: insertions shift a copy's parts."""
    for a, b in zip(starts, [*starts[1:], starts[-1] + size], strict=True):
        yield from range(a, b) if b - a < size else (a,)


@dataclass
class Index:
    """A benchmark's items, ready for matching."""

    ids: list[int]
    words: list[list[str]]
    radius: int = RADIUS

    def __post_init__(self):
        self.counts = [Counter(shingles(w)) for w in self.words]
        seen = Counter(s for c in self.counts for s in c)
        # shingles that many items share tell little: a shingle weighs less the more items hold it
        self.weights = {s: 1.0 + float(np.log(len(self.ids) / n)) for s, n in seen.items()}
        self.default = 1.0 + float(np.log(max(1, len(self.ids))))
        self.blocks = Blocks([simhash(c, self.all_weights(c)) for c in self.counts], self.radius)
        self.anchors: dict[tuple[str, ...], list[tuple[int, int]]] = {}
        for k, w in enumerate(self.words):
            for at, s in enumerate(shingles(w)):
                self.anchors.setdefault(s, []).append((k, at))
        self.first = {s[0] for s in self.anchors}
        self.short = {len(s) for s in self.anchors if len(s) < SHINGLE}

    def all_weights(self, counts: Counter) -> dict:
        return {s: self.weights.get(s, self.default) for s in counts}

    def matches(self, words: list[str]) -> dict[int, tuple[float, int, int]]:
        """Item number -> best similarity, window start and length, of items that reach the bound."""
        starts: dict[int, set[int]] = {}
        for size in {SHINGLE, *self.short}:
            for at, w in enumerate(words):
                if w in self.first and (found := self.anchors.get(tuple(words[at : at + size]))):
                    for k, inside in found:
                        starts.setdefault(k, set()).add(max(0, min(at - inside, len(words) - len(self.words[k]))))
        windows = {(start, len(self.words[k])) for k, own in starts.items() for start in between(sorted(own), len(self.words[k]))}
        best: dict[int, tuple[float, int, int]] = {}
        for start, n in sorted(windows):
            counts = Counter(shingles(words[start : start + n]))
            weights = self.all_weights(counts)
            for k in self.blocks.within(simhash(counts, weights)):
                got = similarity(counts, self.counts[k], weights | self.all_weights(self.counts[k]))
                if got >= SIMILARITY and (k not in best or got > best[k][0]):
                    best[k] = (got, start, n)
        return best


def load_index(spark: SparkSession, benchmark: DataFrame) -> Index:
    """The benchmark's items on the driver, after a check of their number and size."""
    items = benchmark.select("item_id", "text").filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).distinct()
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    if n > MOST_ITEMS or chars > MOST_CHARS:
        raise ValueError(f"benchmark of {n} items and {chars} characters is too large to broadcast")
    rows = [(i, w) for i, t in sorted(map(tuple, items.collect())) if (w := words_of(t))]
    return Index([i for i, _ in rows], [w for _, w in rows])


@lru_cache(maxsize=1)
def _kept(name: str) -> list[Index]:
    return []


def index_of(name: str, ids: list[int], words: list[list[str]], radius: int) -> Index:
    """The index of this process: tasks that follow one another in a worker build it once."""
    kept = _kept(name)
    if not kept:
        kept.append(Index(ids, words, radius))
    return kept[0]


def hits_column(spark: SparkSession, index: Index):
    """Column function text -> hits, an array that is empty for clean texts."""
    held = spark.sparkContext.broadcast((uuid.uuid4().hex, index.ids, index.words, index.radius))

    @pandas_udf(HIT)
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = index_of(*held.value)
        for batch in texts:
            yield pd.Series([[{"item_id": index.ids[k], "similarity": s, "start": a, "words": n} for k, (s, a, n) in sorted(index.matches(words_of(t)).items())] for t in batch])

    return hits


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, start, n_words: one row for each item found in a document.

    start counts words from 0; of windows with equal similarity the first is reported.  Null and empty texts
    or items match nothing, very long texts are searched whole, repeated rows are reported each, empty
    tables give no rows.  Only doc_id and text are read, so further columns cannot clash.
    """
    found = hits_column(docs.sparkSession, load_index(docs.sparkSession, benchmark))
    hit = docs.select("doc_id", F.explode(found("text")).alias("hit"))
    return hit.select("doc_id", "hit.item_id", "hit.similarity", "hit.start", F.col("hit.words").alias("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, that hold no benchmark item."""
    found = hits_column(docs.sparkSession, load_index(docs.sparkSession, benchmark))
    return docs.filter(F.size(found("text")) == 0)
