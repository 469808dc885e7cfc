"""SimHash near-dedup of whole corpora: one document of each group of near copies stays.

Two texts are near copies if the sets of their five-word shingles have a Jaccard similarity of 0.8 or
more.  A text's long fingerprint is split into blocks of 64 bits, and every shingle votes in one block
only, chosen by its hash.  Texts of at most u shingles that are near copies differ in 2u/9 shingles at
most, hence in as many blocks at most; their fingerprints have more non-empty blocks than that, so by the
pigeonhole principle they share a block, whatever the size of the corpus.  Texts that share a block are
joined on it, then verified: by the Hamming distance of dense 128-bit SimHashes, by an upper bound of their
overlap from counts of shingles, and last by the shingles themselves.

Verification goes in rounds: each text tries its nearest partners outside its own component, components
merge, and the next round goes on with what is left, so dense groups make few pairs a text.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import discard, materialise
from gridloom.llm.graph import components
from gridloom.llm.simhash import words_of

SHINGLE, SIMILARITY, BITS, SEED = 5, 0.8, 128, 42
RADIUS = 40
"""Distance up to which a pair is verified: pairs at 0.8 differ in 19.4 bits on average, standard deviation 4.1."""
GROUPS, ROWS = 128, 1 << 15
"""Counters of a text's count sketch; shingles whose bits are unpacked at once."""
UPPER = [ceil(1.5 ** (k + 1)) - 1 for k in range(80)]
"""Largest number of shingles of each size class; texts up to 1.25 times apart are in one class or in neighbours."""
WINDOW, LONG, HEADS, CELLS = 48, 8192, 64, 1 << 19
"""Buckets up to WINDOW rows are compared together; in the first round of those over LONG each row meets HEADS others; pairs compared at once."""
FIRST, GROWTH, MOST = 4, 8, 4096
"""Partners a row verifies in the first round, and how their number grows in later ones, up to MOST."""
HELD = 1 << 16
"""Rows of a bucket, and texts, that a task remembers."""


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct 128-bit hashes, as rows of two 64-bit numbers, of the five-word shingles."""
    words = words_of(text)
    if not words:
        return np.zeros((0, 2), dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > SHINGLE:
        starts, ends = starts[: len(words) - SHINGLE + 1], ends[SHINGLE - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh3_128_digest
    raw = b"".join({digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)})
    return np.frombuffer(raw, dtype=np.uint64).reshape(-1, 2)


def wide_print(hashes: np.ndarray) -> tuple[int, int]:
    """Dense SimHash of a shingle set, as two signed 64-bit numbers."""
    votes = np.zeros(BITS, dtype=np.int64)
    for k in range(0, len(hashes), ROWS):
        part = np.ascontiguousarray(hashes[k : k + ROWS])
        votes += np.unpackbits(part.view(np.uint8).reshape(len(part), 16), axis=1).sum(axis=0, dtype=np.int64)
    a, b = np.packbits(votes * 2 > len(hashes)).view(np.int64)
    return int(a), int(b)


def sketch(hashes: np.ndarray) -> bytes:
    """Shingles in each of GROUPS counters; all 255, which bounds nothing, if one would reach that."""
    counts = np.bincount((hashes[:, 1] >> np.uint64(40)).astype(np.int64) % GROUPS, minlength=GROUPS)
    return (counts if counts.max() < 255 else np.full(GROUPS, 255)).astype(np.uint8).tobytes()


def size_classes(n: int) -> list[int]:
    """Classes in which a text of ``n`` shingles gives blocks: its own, and the next if a near copy may lie there."""
    own = bisect_left(UPPER, n)
    return [own, own + 1] if int(n / SIMILARITY) > UPPER[own] else [own]


def block_count(size_class: int) -> int:
    """Blocks of a class: enough that more of them are non-empty than near copies differ in shingles."""
    return max(32, ceil(0.23 * UPPER[size_class]) + 10)


def block_prints(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each run of ``hashes`` that begins at ``starts``: bits set in over half of the run."""
    sizes = np.diff(np.append(starts, len(hashes)))
    out, k = np.zeros(len(starts), dtype=np.uint64), 0
    while k < len(starts):
        e = max(k + 1, int(np.searchsorted(starts, starts[k] + ROWS)))
        a, b = int(starts[k]), int(starts[e - 1] + sizes[e - 1])
        bits = np.unpackbits(np.ascontiguousarray(hashes[a:b]).view(np.uint8).reshape(-1, 8), axis=1)
        votes = np.add.reduceat(bits, starts[k:e] - a, axis=0, dtype=np.int32)
        out[k:e] = np.packbits(votes * 2 > sizes[k:e, None], axis=1).view(np.uint64).ravel()
        k = e
    return out


def blocks(hashes: np.ndarray) -> np.ndarray:
    """Keys of a text's non-empty blocks, from class, place of the block and its bits."""
    out = [np.zeros(0, dtype=np.uint64)]
    for c in size_classes(len(hashes)) if len(hashes) else ():
        place = hashes[:, 1] % np.uint64(block_count(c))
        order = np.argsort(place, kind="stable")
        place = place[order]
        starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        key = block_prints(hashes[order, 0], starts)
        key ^= (place[starts] * np.uint64(128) + np.uint64(c + 1)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        out.append(key ^ (key >> np.uint64(32)))
    return np.concatenate(out).view(np.int64)


def batch_of(fields: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], [f.split()[0] for f in fields.split(", ")])


PRINTS = "doc_id long, digest binary, row long, a long, b long, n long, sketch binary"


def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dense prints, sizes and sketches of the texts."""
    for batch in batches:
        sets = map(shingle_set, batch.column("text").to_pylist())
        found = [(*wide_print(s), len(s), sketch(s)) for s in sets]
        a, b, n, sk = zip(*found, strict=True) if found else ((),) * 4
        yield batch_of(PRINTS, *(batch.column(c) for c in ("doc_id", "digest", "row")), *(pa.array(x, pa.int64()) for x in (a, b, n)), pa.array(sk, pa.binary()))


def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, row) of all blocks.  Copies of a text that this task remembers add nothing."""
    seen: set[int] = set()
    held: list[tuple[np.ndarray, int]] = []
    size = 0

    def out() -> pa.RecordBatch:
        return batch_of("key long, row long", np.concatenate([k for k, _ in held]), np.repeat([r for _, r in held], [len(k) for k, _ in held]))

    for batch in batches:
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
            if row in seen:
                continue
            if len(seen) >= HELD:
                seen.clear()
            seen.add(row)
            held.append((blocks(shingle_set(text.as_py())), row))
            size += len(held[-1][0])
            if size >= ROWS:
                yield out()
                held, size = [], 0
    if size:
        yield out()


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, row) of the blocks that several texts share, from rows sorted by key.

    A bucket is named by its members, so equal buckets are one; of a bucket over HELD rows, which passes
    through in pieces, the key is the name.
    """
    fields = "bucket long, row long"
    key, row = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    crowded: int | None = None

    def closed(key: np.ndarray, row: np.ndarray) -> pa.RecordBatch | None:
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])])
        key, row = key[fresh], row[fresh]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        names = np.zeros(len(key), dtype=np.int64)
        for at, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            names[at : at + size] = np.array(xxhash.xxh64_intdigest(row[at : at + size].tobytes()), dtype=np.uint64).view(np.int64)
        keep = np.repeat(sizes > 1, sizes)
        return batch_of(fields, names[keep], row[keep]) if keep.any() else None

    for batch in batches:
        k, r = (np.asarray(c) for c in batch.columns)
        if crowded is not None:
            cut = int(np.searchsorted(k, crowded, "right"))
            if cut:
                yield batch_of(fields, k[:cut], r[:cut])
            k, r = k[cut:], r[cut:]
            if not len(k):
                continue
            crowded = None
        key, row = np.concatenate([key, k]), np.concatenate([row, r])
        cut = int(np.searchsorted(key, key[-1], "left")) if len(key) else 0
        if cut and (out := closed(key[:cut], row[:cut])):
            yield out
        key, row = key[cut:], row[cut:]
        if len(key) > HELD:
            crowded = int(key[0])
            yield batch_of(fields, key, row)
            key, row = key[:0], row[:0]
    if len(key) and (out := closed(key, row)):
        yield out


def distance(xa: np.ndarray, xb: np.ndarray) -> np.ndarray:
    return np.bitwise_count(xa).astype(np.int64) + np.bitwise_count(xb)


Triples = tuple[np.ndarray, np.ndarray, np.ndarray]
NONE: Triples = (np.zeros(0, dtype=np.int64),) * 3


def live(c: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> Triples:
    """Of the pairs, those still to be verified: in two components, within RADIUS, untried, possibly similar.

    Neither sizes nor sketches rule out a pair that reaches SIMILARITY.
    """
    keep = (c["label"][i] != c["label"][j]) & (np.minimum(c["n"][i], c["n"][j]) >= SIMILARITY * np.maximum(c["n"][i], c["n"][j]))
    i, j = i[keep], j[keep]
    d = distance(c["a"][i] ^ c["a"][j], c["b"][i] ^ c["b"][j])
    tried = ((d < c["td"][i]) | ((d == c["td"][i]) & (c["row"][j] <= c["ty"][i]))) | ((d < c["td"][j]) | ((d == c["td"][j]) & (c["row"][i] <= c["ty"][j])))
    keep = (d <= RADIUS) & ~tried
    i, j, d = i[keep], j[keep], d[keep]
    fine = np.zeros(len(i), dtype=bool)
    for k in range(0, len(i), ROWS):
        x, y = i[k : k + ROWS], j[k : k + ROWS]
        both = np.minimum(c["sketch"][x], c["sketch"][y]).sum(axis=1, dtype=np.int64)
        both = np.where((c["sketch"][x, 0] == 255) & (c["sketch"][y, 0] == 255), np.minimum(c["n"][x], c["n"][y]), both)
        fine[k : k + ROWS] = both >= SIMILARITY * (c["n"][x] + c["n"][y] - both)
    return i[fine], j[fine], d[fine]


def ordered(c: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, d: np.ndarray) -> Triples:
    """Both directions of the pairs, by bucket, row, distance and partner."""
    i, j, d = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([d, d])
    order = np.lexsort((c["row"][j], d, i))
    return i[order], j[order], d[order]


def nearest(c: dict[str, np.ndarray], found: Triples, most: int) -> Triples:
    """Of rows sorted as by :func:`ordered`, the ``most`` nearest partners of each."""
    i, j, d = found
    starts = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])[: len(i)])
    rank = np.arange(len(i)) - np.repeat(starts, np.diff(np.append(starts, len(i))))
    return i[rank < most], j[rank < most], d[rank < most]


def bucket_pairs(c: dict[str, np.ndarray], most: int, first: bool) -> Triples:
    """(from, to, distance): the ``most`` nearest live partners of every row in each of its buckets.

    ``c`` is sorted by bucket and row.  In the first round each row also meets the least row it can pair
    with, a hub for the bucket, and in a bucket over LONG only the HEADS least.  Later, in a large bucket,
    only the rows outside its largest component are compared with all others, so what is linked already
    costs nothing.  Never more than ``most`` + 1 partners a row, and CELLS pairs besides, are held.
    """
    key = c["bucket"]
    edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    sizes = np.diff(edges)
    large = np.repeat(sizes > WINDOW, sizes)
    found = [NONE]
    for step in range(1, min(WINDOW, len(key))):
        i = np.flatnonzero((key[:-step] == key[step:]) & ~large[:-step])
        if not len(i):
            break
        found.append(live(c, i, i + step))
    out = [chosen(c, ordered(c, *(np.concatenate(x) for x in zip(*found, strict=True))), most, first)]
    for k in np.flatnonzero(sizes > WINDOW):
        here = np.arange(edges[k], edges[k + 1])
        outside = np.ones(len(here), dtype=bool)
        others = here
        if first and len(here) > LONG:
            others = here[:HEADS]
        elif not first:
            _, which, counts = np.unique(c["label"][here], return_inverse=True, return_counts=True)
            outside = which != np.argmax(counts)
        few, step = here[outside], max(1, CELLS // len(others))
        held = NONE
        for f in range(0, len(few), step):
            i, j = (x.ravel() for x in np.meshgrid(few[f : f + step], others, indexing="ij"))
            once = (i < j) | ~outside[j - edges[k]] if others is here else i > j
            more = ordered(c, *live(c, i[once], j[once]))
            both = tuple(np.concatenate(x) for x in zip(held, more, strict=True))
            order = np.lexsort((c["row"][both[1]], both[2], both[0]))
            held = chosen(c, tuple(x[order] for x in both), most, first)
        out.append(held)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def chosen(c: dict[str, np.ndarray], found: Triples, most: int, first: bool) -> Triples:
    near = nearest(c, found, most)
    if not first:
        return near
    i, j, d = found
    order = np.lexsort((c["row"][j], i))
    hub = order[np.concatenate([[True], i[order][1:] != i[order][:-1]])[: len(order)]]
    both = tuple(np.concatenate([x, y[hub]]) for x, y in zip(near, found, strict=True))
    order = np.lexsort((c["row"][both[1]], both[2], both[0]))
    both = tuple(x[order] for x in both)
    fresh = np.concatenate([[True], (both[0][1:] != both[0][:-1]) | (both[1][1:] != both[1][:-1])])[: len(order)]
    return tuple(x[fresh] for x in both)


STATE = ["row", "label", "a", "b", "n", "td", "ty", "sketch"]
MET = "bucket long, x long, lx long, ps array<struct<d:long,y:long,ly:long>>"


def meet(most: int, first: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: live partners (distance, row, label) of each row (bucket, x, lx) that has any."""

    def pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = {name: np.asarray(batch.column(name)).astype(np.int64) for name in ["bucket", *STATE[:-1]]}
        c["a"], c["b"] = c["a"].view(np.uint64), c["b"].view(np.uint64)
        c["sketch"] = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint8).reshape(-1, GROUPS)
        i, j, d = bucket_pairs(c, most, first)
        if first:
            # a bucket over LONG is not yet compared as a whole: all its rows go on, without partners
            _, which, sizes = np.unique(c["bucket"], return_inverse=True, return_counts=True)
            alone = np.setdiff1d(np.flatnonzero(sizes[which] > LONG), i)
        starts = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])[: len(i)])
        offsets = pa.array(np.append(starts, len(i)).astype(np.int32))
        ps = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(x) for x in (d, c["row"][j], c["label"][j])], ["d", "y", "ly"]))
        at = i[starts]
        if first and len(alone):
            at, offsets = np.concatenate([at, alone]), pa.array(np.concatenate([starts, np.full(len(alone) + 1, len(i))]).astype(np.int32))
            ps = pa.ListArray.from_arrays(offsets, ps.values)
        return batch_of(MET, c["bucket"][at], c["row"][at], c["label"][at], ps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            key = np.asarray(batch.column("bucket"))
            if not len(key):
                continue
            # the last bucket's rows may go on in the next batch
            if key[-1] != (last if held else key[0]):
                cut = int(np.searchsorted(key, key[-1], "left"))
                yield pairs(pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks().to_batches()[0])
                held, batch = [], batch.slice(cut)
            held.append(batch)
            last = key[-1]
        if held:
            yield pairs(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def meetings(near: DataFrame, state: DataFrame, most: int, first: bool) -> DataFrame:
    """Rows (bucket, x, lx, ps) that still have live partners in buckets ``near`` (bucket, row)."""
    parts = int(near.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = near.join(state, "row").select("bucket", *STATE)
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "row").mapInArrow(meet(most, first), MET)


def partners(met: DataFrame, most: int, first: bool) -> DataFrame:
    """(x, lx, ps): the ``most`` nearest partners (d, y, ly) of each row over all its buckets, at first its least one too."""
    each = met.filter(F.size("ps") > 0).groupBy("x", "lx").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ps")))).alias("ps"))
    ps = F.slice("ps", 1, most)
    if first:
        least = F.array_min(F.transform("ps", lambda p: F.struct(p["y"], p["d"], p["ly"])))
        ps = F.array_union(ps, F.array(F.struct(least["d"].alias("d"), least["y"].alias("y"), least["ly"].alias("ly"))))
    return each.select("x", "lx", ps.alias("ps"))


def similar(found: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): labels of the partners whose shingle sets reach SIMILARITY."""
    each = found.select("x", "lx", F.explode("ps").alias("p")).select("x", "lx", "p.y", "p.ly")
    swap = F.col("x") > F.col("y")
    pairs = each.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), F.when(swap, F.col("ly")).otherwise(F.col("lx")).alias("lx"), F.when(swap, F.col("lx")).otherwise(F.col("ly")).alias("ly")).distinct()
    both = pairs.join(sets.select(F.col("row").alias("x"), F.col("s").alias("sx")), "x").join(sets.select(F.col("row").alias("y"), F.col("s").alias("sy")), "y")
    return both.withColumn("i", F.size(F.array_intersect("sx", "sy"))).filter(F.col("i") >= SIMILARITY * (F.size("sx") + F.size("sy") - F.col("i"))).select(F.col("lx").alias("a"), F.col("ly").alias("b")).distinct()


def shingle_longs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t)[:, 0].view(np.int64) for t in batch.column("text").to_pylist()]
        yield batch_of("row long, s array<long>", batch.column("row"), pa.array(sets, pa.list_(pa.int64())))


def labels(plain: DataFrame, texts: DataFrame) -> DataFrame:
    """(row, label) of the texts (digest, row, doc_id, a, b, n, sketch) that may have near copies; equal labels: one group.

    ``plain`` (doc_id, text, digest, row) holds the texts.  Rounds: every row verifies its nearest few
    untried partners outside its own component, then the components are merged, until no pair is left.  A
    row's partners are tried in order of (distance, row), so its last one, a threshold, tells which are
    done.  All pairs that share a block within RADIUS are thus verified, or lie in one component, or cannot
    be similar: no link is lost.
    """
    parts = int(plain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = plain.select("row", "text").mapInArrow(deal, "key long, row long")
    shared = dealt.repartition(parts, "key").sortWithinPartitions("key", "row").mapInArrow(gather, "bucket long, row long").distinct()
    start = texts.select("row", F.col("row").alias("label"), "a", "b", "n", F.lit(-1).cast("long").alias("td"), F.lit(0).cast("long").alias("ty"), "sketch")
    near = materialise(meetings(shared, start, FIRST, True), "near")
    if near.isEmpty():
        return texts.limit(0).select("row", F.col("row").alias("label"))
    involved = near.select(F.col("x").alias("row")).distinct()
    state = start.join(involved, "row")
    named = texts.join(involved, "row").select("row", "digest", "doc_id")
    # the wide rows are dealt by id and text digest: no copy group meets in one task
    found = plain.select("doc_id", "text", "digest", "row").join(named.drop("row").hint("shuffle_hash"), plain.digest.eqNullSafe(named.digest) & plain.doc_id.eqNullSafe(named.doc_id), "left_semi")
    sets = materialise(found.select("row", "text").mapInArrow(shingle_longs, "row long, s array<long>").dropDuplicates(["row"]), "sets")
    most, first = FIRST, True
    while True:
        last = state
        tried = materialise(partners(near, most, first), "partners")
        roots = components(similar(tried, sets))
        state = state.join(roots, state.label == roots.node, "left").withColumn("label", F.coalesce("root", "label")).drop("node", "root")
        if not first:
            end = F.element_at("ps", -1)
            ends = tried.select("x", F.when(F.size("ps") < most, F.lit(BITS + 1)).otherwise(end["d"]).cast("long").alias("nd"), end["y"].alias("ny"))
            state = state.join(ends, state.row == ends.x, "left").withColumns({"td": F.coalesce("nd", "td"), "ty": F.coalesce("ny", "ty")}).drop("x", "nd", "ny")
        state = materialise(state, "state")
        first, most = False, min(GROWTH * most, MOST)
        # the next round's live pairs are among this one's
        met, near = near, materialise(meetings(near.select("bucket", F.col("x").alias("row")), state, most, False), "near")
        discard(last, tried, met, roots)
        if near.isEmpty():
            discard(near, sets)
            return state.select("row", "label")


def near_copies(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of the kept documents, and the keyed rows of ``docs``."""
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", text_digest(F.col("text"))).withColumn("row", F.xxhash64("digest"))
    plain = plain.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "digest", "row")
    keyed = materialise(plain.mapInArrow(fingerprints, PRINTS), "wide")
    texts = materialise(keyed.groupBy("digest", "row").agg(F.min("doc_id").alias("doc_id"), F.min(F.struct("a", "b", "n", "sketch")).alias("p")).select("digest", "row", "doc_id", "p.*"), "texts")
    grouped = texts.join(labels(plain, texts), "row", "left").select("digest", "doc_id", F.coalesce("label", "row").alias("root"))
    kept = grouped.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("k")).select("k.doc_id", "k.digest")
    return kept, keyed


def text_digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def dedupe(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, of which each group of near copies has one: the least doc_id.

    Null and empty texts are copies of one another.  Rows equal in doc_id and text count as one
    document; null ids stay only where a group has no other.  An empty table gives no rows.  Column
    names cannot clash, since the input's columns travel as one struct.
    """
    kept, keyed = near_copies(docs)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("dd_columns"), F.col("doc_id").alias("dd_id"), text_digest(F.coalesce("text", F.lit(""))).alias("dd_digest"))
    # the wide rows are dealt by id and text digest: no copy group meets in one task
    out = packed.join(kept.hint("shuffle_hash"), packed.dd_id.eqNullSafe(kept.doc_id) & (packed.dd_digest == kept.digest), "left_semi")
    if keyed.groupBy("doc_id", "digest").count().filter("count > 1").limit(1).count():
        out = out.dropDuplicates(["dd_id", "dd_digest"])
    return out.select("dd_columns.*")
