"""Shards of nearly equal bytes: minimax contiguous partition of ordered atomic groups.

Equal texts form a group that no cut divides.  Groups stand in order of falling size (ties by text
digest).  The smallest feasible capacity is found by binary search, each check filling shards
greedily.  Because equal sizes stand together, the checks need only (size, number of groups) runs:
distinct sizes, whose number grows with the square root of the bytes at most, never the groups
themselves.  Only DataFrame functions run on the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import materialise, spread_join

SALTS = 256


def fill(runs: list[tuple[int, int]], capacity: int, shards: int) -> list[tuple[int, int, int]] | None:
    """Greedy cuts (size, groups of that size before the cut, shard after it); None if infeasible."""
    if runs and runs[0][0] > capacity:
        return None
    shard, room, cuts = 0, capacity, []
    for size, count in runs:
        done = 0
        while done < count:
            fits = min(count - done, room // size)
            done += fits
            room -= fits * size
            if done < count:
                shard += 1
                if shard >= shards:
                    return None
                cuts.append((size, done, shard))
                room = capacity
    return cuts


def smallest_capacity(runs: list[tuple[int, int]], shards: int) -> int:
    """Least capacity at which the ordered runs fit ``shards`` shards."""
    total = sum(s * n for s, n in runs)
    low = max(runs[0][0] if runs else 0, -(-total // shards))
    high = low + (runs[0][0] if runs else 0)
    while low < high:
        mid = (low + high) // 2
        if fill(runs, mid, shards) is None:
            low = mid + 1
        else:
            high = mid
    return low


def _rank(rows: DataFrame, by: list[str], order: list[str], salt: Column, out: str) -> DataFrame:
    """Gapless rank from 0 within ``by``: salted parts are ranked apart, a small table gives their offsets."""
    parts = rows.withColumn("rank_salt", salt)
    counts = parts.groupBy(*by, "rank_salt").agg(F.count("*").alias("rank_n"))
    before = Window.partitionBy(*by).orderBy("rank_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "rank_salt", F.coalesce(F.sum("rank_n").over(before), F.lit(0)).alias("rank_before"))
    within = Window.partitionBy(*by, "rank_salt").orderBy(*order)
    ranked = parts.withColumn("rank_at", F.row_number().over(within) - 1)
    # by has one value a shard (or a cut size), so the offsets have at most shards * SALTS rows
    return ranked.join(F.broadcast(offsets), [*by, "rank_salt"]).withColumn(out, (F.col("rank_before") + F.col("rank_at")).cast("long")).drop("rank_salt", "rank_before", "rank_at")


def shard_by_bytes(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    size is the UTF-8 bytes plus 16; a null text counts as empty and is in its group.  The law is
    ``bytes``; grown_shard is null.  Repeated rows and null ids each take a slot; groups of equal size are
    ordered by digest, rows of a shard by id and digest.  A group larger than an even share, and so a very
    long text, sets the capacity.  An empty table gives no rows.  Only doc_id and text are read.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce("text", F.lit(""))
    rows = materialise(docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("digest")), "sizes")
    groups = materialise(rows.groupBy("digest", "size").agg(F.count("*").alias("copies")).select("digest", "copies", (F.col("size") * F.col("copies")).alias("bytes")), "groups")
    runs = [(r[0], r[1]) for r in groups.groupBy("bytes").agg(F.count("*").alias("n")).orderBy(F.desc("bytes")).collect()]
    cuts = fill(runs, smallest_capacity(runs, shards), shards) or []
    # within a size that is cut, a group's place decides; elsewhere its size does
    cut_sizes = sorted({size for size, _, _ in cuts})
    inside = F.col("bytes").isin(cut_sizes) if cut_sizes else F.lit(False)
    salt = F.pmod(F.xxhash64("digest"), F.lit(SALTS))
    ranked = _rank(groups.filter(inside), ["bytes"], ["digest"], salt, "place")
    by_size = F.lit(0)
    by_place = F.lit(0)
    for size, before, shard in cuts:
        # a cut before the first group of its size leaves the whole size behind it
        by_size = F.when(F.col("bytes") < size, shard).otherwise(by_size)
        by_place = F.when((F.col("bytes") < size) | ((F.col("bytes") == size) & (F.col("place") >= before)), shard).otherwise(by_place)
    placed = ranked.select("digest", by_place.cast("int").alias("shard")).union(groups.filter(~inside).select("digest", by_size.cast("int").alias("shard")))
    out = _rank(spread_join(rows, placed, groups.select("digest", F.col("copies").alias("n")), "digest", F.col("doc_id")), ["shard"], ["doc_id", "digest"], F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SALTS)), "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
