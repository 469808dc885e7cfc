"""SimHash near-duplicates: pigeonhole blocks, join on blocks, verified Hamming distance.

64-bit fingerprints within a small radius are linked exactly, and the components named by their least
document.  (``near_dedup`` has the fingerprints for whole corpora, where similarity of shingles decides.)
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridloom.llm.common import materialise, spread_join
from gridloom.llm.graph import components

SEED, BITS = 42, 64
SMALL_BUCKET = 24
"""Fingerprints in a block bucket up to which its pairs are joined; larger buckets meet at midpoints."""
ROWS = 1 << 15


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(text: str | None, size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by spaces; fewer words: of all; none: nothing."""
    words = words_of(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)], dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)), dtype=np.uint64, count=len(words) - size + 1)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed 64-bit number."""
    votes = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), ROWS):
        part = hashes[k : k + ROWS]
        votes += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.int64)[0]) if len(hashes) else 0


def fingerprint_text(text: str | None, size: int = 3) -> int:
    return majority(shingle_hashes(text, size))


def fingerprint(text: Column, size: int = 3) -> Column:
    @pandas_udf("long")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint_text(t, size) for t in batch], dtype="int64")

    return prints(text)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def block_keys(bits: Column, radius: int) -> Column:
    """Pigeonhole: of ``radius + 2`` blocks at least two agree, so each pair of blocks is a key."""
    n = radius + 2
    edges = [round(BITS * k / n) for k in range(n + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    keys = []
    for k, (x, y) in enumerate(combinations(masks, 2)):
        mask = x | y
        mask -= (1 << 64) if mask >= 1 << 63 else 0
        keys.append(F.struct(F.lit(k).cast("byte").alias("n"), bits.bitwiseAND(F.lit(mask)).alias("v")))
    return F.array(*keys)


def close_pairs(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``radius`` bits (1 or 2).

    Fingerprints that agree on a pair of blocks meet in a bucket.  Small buckets are joined and each
    pair verified.  Of a larger bucket no pairs are emitted: its members send the values one bit
    away; two fingerprints at most two bits apart share such a midpoint, and each is linked to the
    least that reaches it, verified again.  So links grow with the members, not with their square.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    keyed = prints.select("fp", F.explode(block_keys(F.col("fp"), radius)).alias("key"))
    size = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    small = size.filter(F.col("n") <= SMALL_BUCKET).select("key")
    left = keyed.join(small, "key")
    pairs = left.select("key", F.col("fp").alias("a")).join(left.select("key", F.col("fp").alias("b")), "key").filter((F.col("a") < F.col("b")) & (hamming(F.col("a"), F.col("b")) <= radius)).select("a", "b")
    crowded = keyed.join(size.filter(F.col("n") > SMALL_BUCKET).select("key"), "key", "left_semi").select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit((1 << k) - ((1 << 64) if k == 63 else 0))) for k in range(BITS)])
    mid = crowded.select("fp", F.explode(flips).alias("mid"))
    heads = mid.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("mid", "a")
    met = mid.join(heads, "mid").filter((F.col("fp") != F.col("a")) & (hamming(F.col("fp"), F.col("a")) <= radius)).select("a", F.col("fp").alias("b"))
    return pairs.union(met).distinct()


def simhash_components(docs: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits), component_id (least doc_id reachable) of every row.

    Copies share a fingerprint and are linked through it, once; null and empty texts have
    fingerprint zero, linked like any other; very long texts count whole.  A bit set in exactly half of the
    hashes is 0.  Repeated rows stay.  A null doc_id belongs to its component without naming it (a component
    of such rows alone has a null id).  An empty table gives no rows.  Only doc_id and text are read, so
    further columns cannot clash.
    """
    prints = materialise(docs.select("doc_id", fingerprint(F.col("text"), size).alias("fp")), "prints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "fps")
    roots = components(close_pairs(distinct, radius))
    ids = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = ids.select("fp", "root").join(ids.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return spread_join(prints, named, distinct.select("fp", "n"), "fp", F.col("doc_id")).select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
