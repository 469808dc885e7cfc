"""Corpus operators against brute force, round trips, held-out accuracy, and on awkward rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from gridloom.llm import ann, common, decontaminate, graph, html, mixing, near_dedup, quality, sharding, simhash, token_counts, token_file, tokens, toxicity
from gridloom.llm.tokens import PieceCounts, WordIds

SF = "/root/testdata/sf0.001"
WORD_BPE, PIECE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
LONG = "very long text " * 20_000
#: nulls in each column, empty and long texts, ties, a repeated row; names that operators use themselves
AWKWARD = [(1, "a b c d e f g", "en", "s1"), (1, "a b c d e f g", "en", "s1"), (2, None, None, None), (3, "", "en", None), (None, "x y", "de", "s2"), (4, LONG, "en", "s1"), (5, "a b c d e f g", None, "s2")]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASH = ("fp", "digest", "shard", "mix_row", "mix_source", "row", "key", "score", "dd_id", "n")


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# graph and SimHash


@pytest.mark.parametrize("small", [0, 1 << 14])
def test_components_match_union_find(spark, monkeypatch, small):
    monkeypatch.setattr(graph, "SMALL", small)
    rnd = random.Random(1)
    edges = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 120)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    got = dict(rows(graph.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert all(got[x] == find(x) for a, b in edges if a != b for x in (a, b))
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def reference_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    ids = list(prints)
    root = {i: i for i in range(len(ids))}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (ids[i] ^ ids[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {ids[i]: ids[find(i)] for i in range(len(ids))}


def test_simhash_matches_definition(docs):
    texts = dict(rows(docs, "doc_id", "text"))
    got = {r.doc_id: r for r in simhash.simhash_components(docs).collect()}
    prints = {i: reference_print(t) for i, t in texts.items()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    root = brute_components(dict.fromkeys(prints.values()))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(least.get(root[p], i), i)
    assert {i: r.component_id for i, r in got.items()} == {i: least[root[p]] for i, p in prints.items()}


def test_close_pairs_in_crowded_buckets(spark):
    rnd = random.Random(5)
    base = rnd.getrandbits(63)
    prints = {base} | {base ^ (1 << rnd.randrange(40)) ^ (1 << rnd.randrange(40)) ^ (1 << rnd.randrange(40)) for _ in range(150)}
    prints |= {rnd.getrandbits(63) for _ in range(50)}
    links = simhash.close_pairs(spark.createDataFrame([(p,) for p in prints], "fp long"), 2).collect()
    assert all((a ^ b).bit_count() <= 2 for a, b in links)
    got = dict(rows(graph.components(spark.createDataFrame(links, "a long, b long")), "node", "root"))
    want = brute_components(sorted(prints))
    groups = lambda m: {frozenset(x for x in m if m[x] == r) for r in m.values()}
    assert {g for g in groups(want) if len(g) > 1} == groups(got)


def test_simhash_awkward(awkward, empty):
    got = rows(simhash.simhash_components(awkward), "doc_id", "fingerprint", "component_id")
    assert len(got) == len(AWKWARD)
    by = Counter((i, c) for i, _, c in got)
    assert by[(1, 1)] == 2 and by[(5, 1)] == 1 and by[(2, 2)] == 1 and by[(3, 2)] == 1
    assert simhash.simhash_components(empty).count() == 0


# near-dedup


def test_dedupe_matches_brute_force(docs):
    sets = {}
    for i, t in rows(docs, "doc_id", "text"):
        w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {r.doc_id for r in near_dedup.dedupe(docs).collect()} == {find(i) for i in sets}


def test_dedupe_finds_edited_copies(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    data, clean = [], 40
    for k in range(clean):
        words = [word() for _ in range(200)]
        data.append((2 * k, " ".join(words)))
        words[rnd.randrange(200)] = "changed"
        words[rnd.randrange(200)] = "altered"
        data.append((2 * k + 1, " ".join(words)))
    kept = near_dedup.dedupe(spark.createDataFrame(data, "doc_id long, text string"))
    assert rows(kept, "doc_id") == sorted([(2 * k,) for k in range(clean)], key=repr)


def test_dedupe_long_run_of_near_copies(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    data = []
    for k in range(150):
        mine = list(words)
        mine[rnd.randrange(300)] = f"edit{k}"
        data.append((k, " ".join(mine)))
    assert rows(near_dedup.dedupe(spark.createDataFrame(data, "doc_id long, text string")), "doc_id") == [(0,)]


def joined(links, size):
    """Least member of each row's group."""
    root = list(range(size))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in links:
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)
    return [find(x) for x in range(size)]


def all_links(sets):
    """Pairs whose shingles reach the similarity, from counts of shared shingles over an inverted index."""
    holders = {}
    for k, s in enumerate(sets):
        for h in s:
            holders.setdefault(h, []).append(k)
    both = Counter((x, y) for own in holders.values() for n, x in enumerate(own) for y in own[n + 1 :])
    return [(x, y) for (x, y), n in both.items() if n >= 0.8 * (len(sets[x]) + len(sets[y]) - n)]


def edited(rnd, base, k, most):
    mine = list(base)
    for at in rnd.sample(range(len(base)), rnd.randrange(1, most)):
        mine[at] = f"edit{k}x{at}"
    return mine


def test_dedupe_rounds_lose_no_link_of_a_dense_group(spark):
    rnd = random.Random(6)
    base = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    texts = [" ".join(edited(rnd, base, k, 9)) for k in range(260)]
    links = all_links([set(map(tuple, near_dedup.shingle_set(t).tolist())) for t in texts])
    want = set(joined(links, len(texts)))
    kept = near_dedup.dedupe(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert len(links) > 2000 and 1 < len(want) < 200
    assert {r.doc_id for r in kept.collect()} == want


def test_dedupe_hot_bucket_holds_few_pairs(monkeypatch):
    """A bucket of 5,000 near copies: no more than ``most`` + 1 partners a row come out, and none but live ones."""
    rnd = np.random.default_rng(3)
    n = 5000
    base = rnd.integers(0, 1 << 62, (120, 2), dtype=np.uint64)
    sets = []
    for k in range(n):
        mine = base.copy()
        mine[rnd.choice(120, 6, replace=False)] = rnd.integers(0, 1 << 62, (6, 2), dtype=np.uint64)
        sets.append(mine)
    a, b = (np.array([near_dedup.wide_print(s)[k] for s in sets]).view(np.uint64) for k in (0, 1))
    c = {"bucket": np.zeros(n, dtype=np.int64), "row": np.arange(n), "label": np.arange(n), "a": a, "b": b, "n": np.full(n, 120), "td": np.full(n, -1), "ty": np.zeros(n, dtype=np.int64)}
    c["sketch"] = np.frombuffer(b"".join(map(near_dedup.sketch, sets)), dtype=np.uint8).reshape(n, -1)
    i, j, d = near_dedup.bucket_pairs(c, 4, True)
    assert len(i) <= 5 * n and (i != j).all()
    monkeypatch.setattr(near_dedup, "LONG", 1000)
    i, j, d = near_dedup.bucket_pairs(c, 4, True)
    assert len(i) <= 5 * n and (np.minimum(i, j) < near_dedup.HEADS).all()
    c["label"] = np.where(np.arange(n) < 4990, 0, np.arange(n))
    i, j, d = near_dedup.bucket_pairs(c, 32, False)
    assert len(i) <= 32 * n and (c["label"][i] != c["label"][j]).all() and set(range(4990, n)) <= set(i.tolist())


def test_crowded_buckets_pass_whole(monkeypatch):
    """Rows of buckets over HELD and LONG come out of both steps, and later rounds meet every pair of components."""
    monkeypatch.setattr(near_dedup, "HELD", 40)
    monkeypatch.setattr(near_dedup, "LONG", 60)
    monkeypatch.setattr(near_dedup, "WINDOW", 6)
    monkeypatch.setattr(near_dedup, "HEADS", 3)
    rnd = np.random.default_rng(5)
    key = np.sort(np.concatenate([np.full(100, 7), np.repeat(np.arange(20, 40), 3), np.arange(50, 90), np.full(30, 95)]))
    row = np.concatenate([np.sort(rnd.choice(1000, n, replace=False)) for n in np.unique(key, return_counts=True)[1]])
    batches = lambda *cols: [near_dedup.batch_of("key long, row long", *(c[k : k + 17] for c in cols)) for k in range(0, len(key), 17)]
    out = [b for b in near_dedup.gather(iter(batches(key, row)))]
    got = np.concatenate([np.asarray(b.column(1)) for b in out])
    names = np.concatenate([np.asarray(b.column(0)) for b in out])
    members = {frozenset(got[names == n].tolist()) for n in np.unique(names)}
    assert members == {frozenset(row[key == k].tolist()) for k in np.unique(key) if (key == k).sum() > 1}
    n = 100
    bits = np.zeros(n, dtype=np.int64)
    state = {"bucket": np.full(n, 7), "row": np.arange(n), "label": np.arange(n), "a": bits, "b": bits, "n": np.full(n, 5), "td": np.full(n, -1), "ty": bits, "sketch": pa.array([b"\xff" * near_dedup.GROUPS] * n)}
    pieces = [near_dedup.batch_of("bucket l, row l, label l, a l, b l, n l, td l, ty l, sketch b", *(c[k : k + 9] for c in state.values())) for k in range(0, n, 9)]
    first = [r for b in near_dedup.meet(4, True)(iter(pieces)) for r in b.to_pylist()]
    assert {r["x"] for r in first} == set(range(n)) and all(p["y"] < 3 or r["x"] < 3 for r in first for p in r["ps"])
    later = {(r["x"], p["y"]) for b in near_dedup.meet(4096, False)(iter(pieces)) for r in b.to_pylist() for p in r["ps"]}
    assert later == {(x, y) for x in range(n) for y in range(n) if x != y}


@pytest.mark.parametrize("small", [False, True])
def test_dedupe_long_buckets_lose_no_link(spark, monkeypatch, small):
    """A group that is linked in parts, with components contracted over all tasks or ended in one."""
    if small:
        monkeypatch.setattr(graph, "SMALL", 5)
    rnd = random.Random(9)
    base = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(150)]
    texts = [" ".join(edited(rnd, base, k, 8)) for k in range(150)] + [f"alone {k} " + " ".join(f"w{k}x{j}" for j in range(rnd.randrange(3, 60))) for k in range(50)]
    want = set(joined(all_links([set(map(tuple, near_dedup.shingle_set(t).tolist())) for t in texts]), len(texts)))
    kept = near_dedup.dedupe(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r.doc_id for r in kept.collect()} == want


@pytest.mark.parametrize("words", [6, 9, 15, 40, 100, 333, 1000, 4000])
def test_blocks_outnumber_the_shingles_near_copies_differ_in(words):
    """The pigeonhole bound, and pairs right at the similarity share a block, at every size."""
    rnd = np.random.default_rng(words)
    for _ in range(20):
        n = words - 4
        own = rnd.integers(0, 1 << 63, (n, 2), dtype=np.uint64)
        classes = near_dedup.size_classes(n)
        assert max(near_dedup.block_count(k) for k in classes) > (n + int(n / 0.8)) // 9
        filled = len(np.unique(own[:, 1] % np.uint64(near_dedup.block_count(classes[0]))))
        assert filled > (n + min(int(n / 0.8), near_dedup.UPPER[classes[0]])) // 9
        drop = int(n / 9)  # both texts lack so many of the other's shingles: similarity (n - drop) / (n + drop) >= 0.8
        other = np.concatenate([own[drop:], rnd.integers(0, 1 << 63, (drop, 2), dtype=np.uint64)])
        assert set(near_dedup.blocks(own).tolist()) & set(near_dedup.blocks(other).tolist())
        more = np.concatenate([own, rnd.integers(0, 1 << 63, (int(n / 4), 2), dtype=np.uint64)])
        assert set(near_dedup.blocks(own).tolist()) & set(near_dedup.blocks(more).tolist())


def test_sketch_never_rules_out_a_near_copy():
    rnd = np.random.default_rng(2)
    for n in (3, 50, 700, 60_000):
        own = rnd.integers(0, 1 << 63, (n, 2), dtype=np.uint64)
        other = np.concatenate([own[: n // 2], rnd.integers(0, 1 << 63, (n // 3, 2), dtype=np.uint64)])
        x, y = (np.frombuffer(near_dedup.sketch(s), dtype=np.uint8) for s in (own, other))
        assert (x[0] == 255 and y[0] == 255) or np.minimum(x, y).sum(dtype=np.int64) >= n // 2


def test_dedupe_awkward(awkward, empty):
    out = near_dedup.dedupe(awkward)
    assert out.columns == awkward.columns
    assert [r[0] for r in rows(out, "doc_id")] == [1, 2, 4, None]
    assert near_dedup.dedupe(empty).count() == 0


# decontamination


def test_decontamination_matches_brute_force(spark, docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    plain = lambda t: " ".join(decontaminate.words_of(t))
    items = [(i, plain(t)) for i, t in rows(bench, "item_id", "text")]
    want = {(i, k) for i, t in rows(docs, "doc_id", "text") for k, x in items if x in plain(t)}
    got = {(a, b) for a, b in rows(decontaminate.contaminated(docs, bench), "doc_id", "item_id")}
    assert want and want <= got
    index = decontaminate.load_index(spark, bench)
    for i, t in rows(docs, "doc_id", "text")[:30]:
        words = decontaminate.words_of(t)
        for k, item in enumerate(index.words):
            best = 0.0
            for start in range(max(1, len(words) - len(item) + 1)):
                c = Counter(decontaminate.shingles(words[start : start + len(item)]))
                if c & index.counts[k]:
                    best = max(best, decontaminate.similarity(c, index.counts[k], index.all_weights(c) | index.all_weights(index.counts[k])))
            assert (best >= 0.8) == ((i, index.ids[k]) in got)


def test_decontamination_blocks_hold_the_radius():
    rnd = random.Random(4)
    prints = [rnd.getrandbits(64) for _ in range(300)]
    blocks = decontaminate.Blocks(prints)
    for k in range(60):
        p = prints[k]
        for b in rnd.sample(range(64), decontaminate.RADIUS):
            p ^= 1 << b
        assert blocks.within(p) == {j for j, x in enumerate(prints) if (x ^ p).bit_count() <= decontaminate.RADIUS}


def test_decontamination_tries_windows_between_anchors(spark):
    """Words inserted into a copy shift its parts; the best window may begin between the two alignments."""
    rnd = random.Random(7)
    item = [f"w{k}" for k in range(80)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    index = decontaminate.load_index(spark, bench)
    for _ in range(30):
        at, m = rnd.randrange(5, 75), rnd.randrange(1, 8)
        words = ["x"] * 20 + item[:at] + [f"in{k}" for k in range(m)] + item[at:] + ["y"] * 20
        best = max(decontaminate.similarity(c := Counter(decontaminate.shingles(words[s : s + 80])), index.counts[0], index.all_weights(c) | index.all_weights(index.counts[0])) for s in range(len(words) - 79))
        got = index.matches(words)
        assert (best >= 0.8) == (0 in got) and (best < 0.8 or got[0][0] == pytest.approx(best))


def test_decontamination_edited_and_awkward(spark, awkward, empty):
    item = [f"w{k}" for k in range(60)]
    edited = list(item)
    edited[30] = "other"
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "two words"), (None, "x y")], "item_id long, text string")
    found = spark.createDataFrame([(1, "before " * 9 + " ".join(edited) + " after"), (2, "clean " * 50), (3, "then two words here")], "doc_id long, text string")
    assert rows(decontaminate.contaminated(found, bench), "doc_id", "item_id") == [(1, 1), (3, 4)]
    assert decontaminate.decontaminate(awkward, bench).count() == len(AWKWARD) and decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.contaminated(found, bench.limit(0)).count() == 0


# sharding


def test_smallest_capacity_is_exact():
    rnd = random.Random(6)
    for _ in range(60):
        sizes = sorted((rnd.randrange(1, 40) for _ in range(rnd.randrange(1, 40))), reverse=True)
        shards = rnd.randrange(1, 8)
        runs = sorted(Counter(sizes).items(), reverse=True)

        def need(cap):
            used, room = 1, cap
            for s in sizes:
                if s > room:
                    used, room = used + 1, cap
                room -= s
            return used

        want = next(c for c in range(max(sizes), sum(sizes) + 1) if need(c) <= shards)
        assert sharding.smallest_capacity(runs, shards) == want
        assert sharding.fill(runs, want, shards) is not None and (want == max(sizes) or sharding.fill(runs, want - 1, shards) is None)


def test_shards_are_whole(docs, awkward, empty):
    got = sharding.shard_by_bytes(docs, 7).toPandas()
    texts = dict(rows(docs, "doc_id", "text"))
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    assert got.shard.between(0, 6).all() and len(got) == len(texts)
    assert (got["size"] == [len(texts[i].encode()) + 16 for i in got.doc_id]).all() and (got.text_crc32 == [zlib.crc32(texts[i].encode()) for i in got.doc_id]).all()
    assert (got.assign(t=[texts[i] for i in got.doc_id]).groupby("t").shard.nunique() == 1).all()
    size = got.groupby("shard")["size"].sum()
    assert size.max() <= got["size"].sum() / 7 + max(got.groupby("text_crc32")["size"].sum())
    odd = sharding.shard_by_bytes(awkward, 3).collect()
    assert len(odd) == len(AWKWARD) and {r["size"] for r in odd if r.doc_id in (2, 3)} == {16}
    assert len({r.shard for r in odd if r.text_crc32 == zlib.crc32(b"a b c d e f g")}) == 1
    assert sharding.shard_by_bytes(empty).count() == 0


def test_shards_match_brute_force(docs):
    """Every row's shard and slot: groups in falling size, by digest, filled greedily at the least capacity."""
    import hashlib

    data = rows(docs, "doc_id", "text")
    size = Counter()
    for _, t in data:
        size[t] += len(t.encode()) + 16
    order = sorted(size, key=lambda t: (-size[t], hashlib.md5(t.encode()).digest()))

    def fill(capacity):
        shard, room, where = 0, capacity, {}
        for t in order:
            if size[t] > room:
                shard, room = shard + 1, capacity
            where[t], room = shard, room - size[t]
        return where, shard

    low, high = max(size.values()), sum(size.values())
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fill(mid)[1] < 7 else (mid + 1, high)
    where = fill(low)[0]
    got = sharding.shard_by_bytes(docs, 7).collect()
    assert {r.doc_id: r.shard for r in got} == {i: where[t] for i, t in data}
    assert {r.law for r in got} == {"bytes"} and all(r.grown_shard is None for r in got)


# mixing


def test_exponent_meets_its_target():
    shares = {"a": 1000, "b": 100, "c": 10}
    e = mixing.bisect_exponent(shares, repetition_limit=5.0)
    assert mixing.repetition(shares, e) == pytest.approx(5.0)
    e = mixing.bisect_exponent(shares, target_entropy=0.8)
    assert mixing.entropy(mixing.weights(shares, e)) == pytest.approx(0.8)
    assert mixing.bisect_exponent({"a": 5, "b": 5}, repetition_limit=2.0) == 0.0 and mixing.plan({}, 2.0, None, None).budgets == {}


def test_mixture_meets_budgets(spark, docs):
    text = dict(rows(docs, "doc_id", "text"))
    import regex

    n = {i: max(1, len(regex.findall(r"\p{L}+|\p{N}|[^\s\p{L}\p{N}]+", t))) for i, t in text.items()}
    have = Counter()
    for i, s in rows(docs, "doc_id", "source"):
        have[s] += n[i]
    for budget in (None, sum(have.values()) // 3):
        plan = mixing.plan(dict(have), 2.0, None, budget)
        got = mixing.mixture_table(docs, 2.0, budget=budget).collect()
        for s, b in plan.budgets.items():
            mine = [r for r in got if r.source == s]
            # walked to the budget: it is passed by less than one document
            assert b <= sum(r.n_tokens for r in mine) < b + max(n.values()) + 1
            assert len({(r.doc_id, r.epoch) for r in mine}) == len(mine)
            for e in range(max(r.epoch for r in mine)):
                assert {r.doc_id for r in mine if r.epoch == e} == {i for i, x in rows(docs, "doc_id", "source") if x == s}
        if budget is None:
            assert {r.doc_id for r in got} == set(text)
        assert all(0 <= r.position < 1.0001 for r in got)


def test_mixture_matches_brute_force(spark, monkeypatch):
    """Every emission, from the definition: permuted blocks epoch by epoch, walked to the budget."""
    monkeypatch.setattr(mixing, "BLOCKS", 4)
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 40)
    rnd = random.Random(2)
    data = [(k, " ".join(["w"] * rnd.randrange(0, 9)), "en", rnd.choice("aaaaaabbc")) for k in range(120)]
    docs = spark.createDataFrame(data, SCHEMA)
    hashed = spark.createDataFrame(data, SCHEMA).select("doc_id", F.xxhash64("doc_id", "text").alias("row"))
    row = dict(rows(hashed, "doc_id", "row"))
    n = {k: max(1, len(t.split())) for k, t, _, _ in data}
    have = Counter()
    for k, _, _, s in data:
        have[s] += n[k]
    plan = mixing.plan(dict(have), 3.0, None, None)
    h = lambda *xs: spark.range(1).select(F.xxhash64(*[F.lit(x) if not isinstance(x, str) else F.lit(x) for x in xs])).first()[0]
    blocks = {s: mixing.block_number(have[s]) for s in have}
    at = {r.doc_id: r.h for r in hashed.select("doc_id", F.xxhash64("row", F.lit(0)).alias("h")).collect()}
    want = set()
    for s in have:
        for epoch in range(-(-plan.budgets[s] // have[s])):
            order = sorted(range(blocks[s]), key=lambda b: (h(s, epoch, b, 0), b))
            place = epoch * have[s]
            for b in order:
                own = [k for k, _, _, x in data if x == s and at[k] % blocks[s] == b]
                size = sum(n[k] for k in own)
                if place + size > plan.budgets[s]:
                    mixed = {r.k: r.h for r in spark.createDataFrame([(k, row[k], epoch) for k in own] or [(-1, 0, 0)], "k long, row long, epoch int").select("k", F.xxhash64("row", "epoch", F.lit(0)).alias("h")).collect()}
                    here = place
                    for k in sorted(own, key=lambda k: (mixed[k], row[k])):
                        if here < plan.budgets[s]:
                            want.add((k, epoch))
                        here += n[k]
                elif place < plan.budgets[s]:
                    want |= {(k, epoch) for k in own}
                place += size
    got = [(r.doc_id, r.epoch) for r in mixing.mixture_table(docs, 3.0).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert Counter(r.doc_id for r in mixing.mix(docs, 3.0).collect()) == Counter(k for k, _ in want)


def test_counts_of_tokens_may_be_given(spark):
    data = [(1, "a  b, c\n", 7), (2, None, None), (3, "", 0)]
    docs = spark.createDataFrame([(i, t, "s", n) for i, t, n in data], "doc_id long, text string, source string, tokens int")
    assert [r.n for r in docs.select(mixing.token_count(F.col("text")).alias("n")).collect()] == [4, 1, 1]
    assert mixing.mix(docs, 1.0, tokens="tokens").count() == 3


def test_mixing_awkward(awkward, empty):
    assert Counter(r.doc_id for r in mixing.mixture_table(awkward, 1.0).collect()) >= Counter(r[0] for r in AWKWARD)
    out = mixing.mix(awkward, 1.5)
    assert out.columns == awkward.columns and out.count() >= len(AWKWARD)
    assert mixing.mix(empty).count() == 0 and mixing.mixture_table(empty).count() == 0


# tokens

ODD_TEXTS = ["", None, " ", "a  b", " lead", "trail ", "tab\tand\nline\r\nend", "<s>x</s> <|endoftext|> y", "naïve Œuvre ﬁ ΑΣ é İ", "▁mark a▁b", "emoji 👩‍👩‍👧 中文字", "it's we'll DON'T 12345", "x" * 500, " nb em", "a\x1cb"]


def test_token_ids_are_the_librarys(docs):
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ODD_TEXTS + [t for _, t in rows(docs, "doc_id", "text")][:60]
    whole = Tokenizer.from_file(WORD_BPE)
    assert WordIds(WORD_BPE).texts(texts) == [np.asarray(whole.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    assert PieceCounts(PIECE_BPE).texts(texts) == [len(model.encode(t or "")) for t in texts]


def test_token_counts_use_the_cache(spark, docs, awkward, empty, tmp_path):
    cache = str(tmp_path / "cache")
    first = rows(token_counts.token_counts(docs, PIECE_BPE, cache=cache), "doc_id", "n_tokens")
    folder = token_counts.cache_folder(cache, PIECE_BPE)
    assert spark.read.parquet(folder).count() == docs.select("text").distinct().count()
    assert rows(token_counts.token_counts(docs, PIECE_BPE, cache=cache), "doc_id", "n_tokens") == first
    assert spark.read.parquet(folder).count() == docs.select("text").distinct().count()
    odd = token_counts.token_counts(awkward, PIECE_BPE).collect()
    assert len(odd) == len(AWKWARD) and {(r.n_bytes, r.n_tokens) for r in odd if r.doc_id in (2, 3)} == {(0, 0)}
    assert [r.over_limit for r in odd if r.doc_id == 4] == [True]
    assert token_counts.token_counts(empty, PIECE_BPE).count() == 0


def test_token_counts_are_the_librarys(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    want = {i: (len(t.encode()), len(model.encode(t))) for i, t in rows(docs, "doc_id", "text")}
    got = token_counts.token_counts(docs, PIECE_BPE, limit=200).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and all(r.over_limit == (r.n_tokens > 200) for r in got)


def test_frequent_keys_are_spread(spark, monkeypatch):
    """A key that holds most rows is dealt over tasks and joined whole; null keys match nothing."""
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    left = spark.createDataFrame([(k, 1 if k < 500 else k) for k in range(600)] + [(700, None)], "i long, k long")
    right = spark.createDataFrame([(k, f"n{k}") for k in (1, *range(500, 600))], "k long, name string")
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    got = common.spread_join(left, right, counts, "k", F.col("i"))
    assert sorted(got.columns) == ["i", "k", "name"] and rows(got, "i", "name") == sorted(((k, "n1" if k < 500 else f"n{k}") for k in range(600)), key=repr)


def test_token_files_round_trip(spark, docs, awkward, empty, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORD_BPE)
    want, start = [], 0
    for i, t in sorted(rows(docs, "doc_id", "text")):
        ids = whole.encode(t, add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    files = token_file.write_tokens(docs, str(tmp_path / "out"), WORD_BPE)
    got = sorted(tuple(r) for r in token_file.read_tokens(spark, files).collect())
    assert got == want and sum(f[3] for f in files) == start
    stream = b"".join(zstandard.ZstdDecompressor().stream_reader(open(f[1], "rb"), read_across_frames=True).read() for f in files)
    assert len(stream) == 4 * start
    small = token_file.write_tokens(docs, str(tmp_path / "small"), WORD_BPE, file_bytes=40_000)
    assert len(small) > len(files) and sorted(tuple(r) for r in token_file.read_tokens(spark, small).collect()) == want
    odd = sorted((r.start, r.doc_id, r.n_tokens) for r in token_file.token_files(awkward, WORD_BPE).collect())
    assert [x[1] for x in odd] == [None, 1, 1, 2, 3, 4, 5] and [x[2] for x in odd if x[1] in (2, 3)] == [1, 1]
    assert token_file.token_files(empty, WORD_BPE).count() == 0


def test_token_file_reads_one_frame_and_checks_it(tmp_path):
    path = str(tmp_path / "a" / "x.tok")
    w = token_file.Writer(path)
    docs = [(k, np.arange(k * 900, dtype="<u4").tobytes()) for k in range(40)]
    for d in docs:
        w.add(*d)
    w.close()
    r = token_file.Reader(path)
    assert len(r.frames) > 1 and [r.document(k) for k in range(40)] == [b for _, b in docs] and list(r.find(7)) == [docs[7][1]]
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) // 3] ^= 1
    open(path, "wb").write(raw)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken = token_file.Reader(path)
        [broken.document(k) for k in range(40)]


# classifiers


def labelled(sf="/root/testdata/sf0.01"):
    import pandas as pd

    m = pd.read_parquet(f"{sf}/documents.parquet").merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    out = m.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    return m[~out], m[out]


def test_quality_on_held_out_rows():
    train, test = labelled()
    weights = quality.train(list(zip(train.text, train.quality, strict=True)))
    got = np.array(quality.score_texts(test.text.tolist(), quality.Words(weights, quality.Shape()))) >= 0.3
    assert (got == (test.quality == 1)).mean() >= 0.95


def test_quality_scores_are_those_of_the_bags(monkeypatch):
    """The cached scores equal the mean over all of a text's features, however small the cache; word order counts."""
    rnd = random.Random(5)
    texts = [" ".join(rnd.choice(["aa", "bb", "aa", "ccc", "é", "x" * 90, "rare%d" % rnd.randrange(900)]) for _ in range(rnd.randrange(60))) for _ in range(120)]
    shape = quality.Shape(buckets=1 << 12)
    weights = quality.train([(t, k % 2) for k, t in enumerate(texts)], shape)
    want = []
    for t in texts:
        ids, n = quality._bag(t, shape, {})
        want.append(1 / (1 + np.exp(-(weights[ids] @ n) / n.sum())))
    for most in (quality.CACHE_WORDS, 40):
        words = quality.Words(weights, shape, most)
        got = [p for k in range(0, len(texts), 7) for p in quality.score_texts(texts[k : k + 7], words)]
        assert np.allclose(got, want, atol=1e-6)
    ordered = [("good text here" if k % 2 else "here text good", k % 2) for k in range(60)]
    words = quality.Words(quality.train(ordered, shape), shape)
    good, bad = quality.score_texts(["good text here", "here text good"], words)
    assert good > 0.9 and bad < 0.1


def test_quality_awkward(spark, awkward, empty, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.quality_scores(awkward, labels, sample=50).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert quality.quality_scores(empty, labels).count() == 0
    assert quality.keep(awkward, labels, threshold=0.0).columns == awkward.columns


def toxicity_split(limit=2000):
    train, test = labelled("/root/testdata/sf0.1")
    return list(zip(train.text[:limit], train.toxic[:limit], strict=True)), test


def test_toxicity_on_held_out_rows():
    """Accuracy, and that the automaton keeps it where words are misspelled."""
    train, test = toxicity_split(4000)
    model = toxicity.train(train)
    matcher, y = toxicity.Matcher(model), test.toxic.to_numpy() == 1
    got = np.array([toxicity.score_text(t, matcher) for t in test.text]) >= 0.5
    assert got[y].mean() >= 0.93 and got[~y].mean() <= 0.002
    exact = toxicity.Matcher(model)
    exact.automaton.match = lambda w: (w, 0) if w in model.lexicon else None
    score = lambda texts, m: np.array([toxicity.score_text(t, m) for t in texts]) >= 0.5
    # these documents misspell little that training has not seen; the same ones with a letter of every lexicon word changed: what the automaton is for
    rnd = random.Random(3)

    def misspelled(m):
        w = m.group()
        if w.lower() not in model.lexicon or len(w) < 5:
            return w
        at = rnd.randrange(1, len(w))
        return w[:at] + rnd.choice("bcdfgkpqvxz") + w[at + 1 :]

    changed = [toxicity.WORD.sub(misspelled, t) for t in test.text[y]]
    assert score(changed, matcher).mean() >= 0.8 and score(changed, exact).mean() <= 0.3


def test_quotation_is_learned_and_changes_predictions():
    """Documents that quote insults are clean, those that use them are toxic; only their context tells them apart."""
    rnd = random.Random(1)
    filler = lambda n: [rnd.choice("river stone cloud table paper green window garden".split()) for _ in range(n)]
    bad = ["scoundrel", "imbecile", "wretched"]

    def doc(quote):
        word = rnd.choice(bad)
        return " ".join([*filler(12), *(["he", "reported", f'"{word}"'] if quote else ["you", word]), *filler(12)])

    rows = [(doc(k % 2 == 0) if k % 3 else " ".join(filler(26)), int(k % 2 == 1 and k % 3 > 0)) for k in range(600)]
    model = toxicity.train(rows)
    # quoted use is as frequent as abuse here, so no word is 8 times as frequent in toxic documents: state the lexicon
    model.lexicon, model.spellings = {w: 3.0 for w in bad}, {}
    matcher = toxicity.Matcher(model)
    model.quotation = toxicity.learn_quotation(rows, matcher)
    assert {toxicity.QUOTED, "reported"} <= model.quotation.keys() and "river" not in model.quotation
    x = np.stack([toxicity.features(t, matcher) for t, _ in rows])
    y = np.array([y for _, y in rows])
    assert x[(y == 1), 0].min() > 1 and x[(y == 0), 0].max() < 0.5 and x[:, 4].max() > 1
    model.weights, model.bias = np.array([4.0, 0, 0, 0, 0]), -4.0
    score = lambda: np.array([toxicity.score_text(t, matcher) for t, _ in rows]) >= 0.5
    with_context = score()
    model.quotation = {}
    assert (with_context == y).all() and (score() != with_context).sum() > 100


def _edits(a, b):
    """Edit distance with swaps of neighbours, no part edited twice."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] != b[j] == a[i - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


@pytest.mark.parametrize("most_states", [3, 50_000])
def test_automaton_is_edit_distance(most_states):
    rnd = random.Random(8)
    lexicon = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 12))) for _ in range(40)})
    automaton = toxicity.Automaton(lexicon, most_states)
    for k in range(1500):
        if k % 2:
            w = list(rnd.choice(lexicon))
            for _ in range(rnd.randrange(3)):
                at = rnd.randrange(len(w) + 1)
                w[at : at + rnd.randrange(2)] = [rnd.choice("abcd")] * rnd.randrange(2)
            w = "".join(w)
        else:
            w = "".join(rnd.choice("abcd") for _ in range(rnd.randrange(0, 12)))
        near = [(_edits(w, x), x) for x in lexicon if _edits(w, x) <= toxicity.allowed(len(x))]
        assert automaton.match(w) == ((min(near)[1], min(near)[0]) if near else None), w


def test_misspelled_words():
    matcher = toxicity.Matcher(toxicity.Model({"scum": 4.0, "idiot": 4.0, "worthless": 4.0, "scoundrel": 4.0}, {"sum": 0.0}))
    assert [matcher.weight(w) for w in ("scum", "scoundrel", "idoit", "skum", "scm", "w0rthl3ss", "scundrels")] == [4, 4, 2, 2, 2, 1, 1]
    assert [matcher.weight(w) for w in ("sum", "clean", "wonderful", "scound", "", "x" * 10_000)] == [0] * 6


def test_a_hit_weighs_what_training_says():
    rows = [("vermin here filler", 1)] * 20 + [("vermine there filler", 0)] * 20 + [("only filler", 0)] * 20
    lexicon, spellings = toxicity.learn_lexicon(rows)
    assert "vermin" in lexicon and "filler" not in lexicon and spellings["vermine"] < 0.5 * lexicon["vermin"]


def test_toxicity_awkward(spark, awkward, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.toxicity_scores(awkward, labels).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity_scores(empty, labels).count() == 0


# pages


def test_article_text(spark):
    page = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body><nav><ul><li>menu</li></ul></nav>
    <article><header>By line</header><h1>Head &amp; tail</h1><p>One <b>bold</b>
    word<br>next<p>Two&nbsp;x<aside>side</aside><div class="comments"><p>comment</p></div><form>f</form></article><footer>foot</footer>"""
    assert "\n\n".join(b[0] for b in html.main_blocks(page)[0]) == "By line\n\nHead & tail\n\nOne bold word next\n\nTwo x"
    data = [(1, "http://A.example/x", page), (2, None, None), (None, "x", ""), (4, "http://a.example/y", "<div>only text</div>"), (4, "http://a.example/y", "<div>only text</div>")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = rows(html.extract(pages), "page_id", "url", "text", "n_chars")
    assert [r[2] for r in got if r[0] == 4] == ["only text"] * 2 and [r[3] for r in got if r[0] in (2, None)] == [0, 0]
    assert html.extract(pages.limit(0)).count() == 0


def test_template_is_deleted_where_no_article_is_marked(spark):
    pages = [(k, f"http://h{k % 2}.example/{k}", f"<body><div>Same banner</div><div><p>Own words {k}</p></div><div>Same end<p>here</p></div></body>") for k in range(40)]
    got = html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {f"Own words {k}" for k in range(40)}


def test_template_is_deleted_inside_articles(spark):
    page = "<article><h2 id='related-{0}'>Related work {0}</h2><p>Own words {0}</p><div class='x'><p>Licence</p><p>of the site</p></div></article>"
    pages = [(k, f"http://h.example/{k}", page.format(k)) for k in range(30)]
    copies = [(100 + k, f"http://copies.example/{k}", f"<nav>{k}</nav><article><p>One text</p></article>") for k in range(30)]
    got = html.extract(spark.createDataFrame(pages + copies, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {k: f"Related work {k}\n\nOwn words {k}" for k in range(30)} | {100 + k: "One text" for k in range(30)}


def test_articles_keep_what_near_copies_and_a_part_of_the_host_share(spark):
    """Sentences that recur in articles stay: those of near copies, and those on less than half of a host's pages."""
    rnd = random.Random(4)
    words = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    shared, base = words(12), [words(40) for _ in range(6)]
    pages, want = [], {}
    for k in range(60):
        own = [words(30), shared] if k < 20 else [words(30)]
        pages.append((k, f"http://h.example/{k}", "<article>" + "".join(f"<p>{x}</p>" for x in own) + "</article>"))
        want[k] = "\n\n".join(own)
    for k in range(60, 90):
        own = [*base[:5], f"{base[5]} edit{k}"]
        pages.append((k, f"http://near.example/{k}", "<article>" + "".join(f"<p>{x}</p>" for x in own) + "</article>"))
        want[k] = "\n\n".join(own)
    got = html.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == want


def test_classes_drop_no_article():
    text = lambda page: "\n\n".join(b[0] for b in html.main_blocks(page)[0])
    assert text('<div class="with-sidebar"><article><p>Own</p></article><div class="sidebar">links</div></div>') == "Own"
    assert text('<div class="sidebar"><p>links</p><article><p>Own</p><div class="share-buttons">x</div></article></div>') == "Own"
    assert text('<article><p class="alert-box">Own</p><div class="comments"><article><p>reader</p></article></div></article>') == "Own"
    assert text('<div class="content-header-wide"><p>Own</p></div><div class="site-header">x</div><aside><article>teaser</article></aside>') == "Own"


def test_repeated_pages_are_no_template(spark):
    data = [(k, "http://h.example/", "<div><p>Same words</p><p>and more</p></div>") for k in range(8)]
    assert {r.text for r in html.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()} == {"Same words\n\nand more"}


def test_extraction_matches_brute_force(spark):
    """The test pages hold their main text in the blocks of one article; plain patterns find it too."""
    import html as entities

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        inner = re.sub(r"<(nav|aside|footer|form|script|style)\b.*?</\1>|<div class=\"ad\">.*?</div>|<!--.*?-->", "<p>", inner, flags=re.S)
        parts = re.split(r"</?(?:p|h[1-6]|ul|ol|li|div|section|blockquote|pre|table|tr|td|th)\b[^>]*>", inner)
        clean = [" ".join(re.split(r"\s+", entities.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\s*/?>", " ", x))))).strip() for x in parts]
        want[r.page_id] = "\n\n".join(x for x in clean if x)
    got = {r.page_id: r.text for r in html.extract(pages).collect()}
    assert got == want


@pytest.mark.parametrize("pages", [400, 401, 1000])
def test_template_does_not_depend_on_the_size_of_its_host(spark, pages):
    page = lambda k: f"<div>{'<div>Section menu</div>' if k < 20 else ''}<p>Own words {k}</p></div>"
    data = [(k, f"http://h.example/{k}", page(k)) for k in range(pages)]
    got = html.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {f"Own words {k}" for k in range(pages)}


# nearest neighbours


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16)).astype(np.float32)
    x[100:180] = x[100]
    data = [(k, v.tolist()) for k, v in enumerate(x)] + [(700, None), (720, [0.0] * 16), (740, [float("nan")] * 16), (760, [None] * 16), (780, [1.0])]
    got = ann.nearest_neighbours(spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("leaf", F.lit(1)), leaves=8, branch=8).toPandas()
    y = x.astype(float)
    hits = 0
    for q in range(0, 600, 20):
        s = y @ y[q]
        want = [k for k in np.lexsort((np.arange(600), -s.round(12))) if k != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and np.allclose(mine.score, s[mine.vec_id])
        hits += len(set(want) & set(mine.vec_id))
    assert hits >= 0.9 * 30 * 20 and set(got.query_id) == set(range(0, 600, 20))
    assert got[got.query_id == 100].vec_id.tolist() == list(range(101, 121))
    few = ann.nearest_neighbours(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>"))
    assert rows(few, "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 0.0)]
    assert ann.nearest_neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    odd = spark.createDataFrame([(None, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.0]), (20, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert rows(ann.nearest_neighbours(odd), "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 0.5), (0, 2, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0)]


def test_neighbours_recall_on_the_test_vectors(spark):
    """Recall against brute force over a whole table, by the production parameters; every score is the exact product."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = table.toPandas()
    x, ids = np.stack(data.embedding.to_list()).astype(float), data.vec_id.to_numpy()
    got = ann.nearest_neighbours(table).toPandas()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = np.array([x[q] @ y for y in x])
        s[q] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        mine = got[got.query_id == ids[q]]
        hits, total = hits + len(best & set(mine.vec_id)), total + len(best)
        where = np.searchsorted(ids, mine.vec_id) if (np.diff(ids) > 0).all() else [int(np.flatnonzero(ids == i)[0]) for i in mine.vec_id]
        assert np.allclose(mine.score, s[where], rtol=1e-12)
    assert total and hits / total >= 0.95


def test_calibration_leaves_the_query_out():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 8)) * 10
    x = np.concatenate([c + rng.normal(size=(50, 8)) for c in centres])
    tree = ann.Tree(x, 8, 64)
    leaf, visits = tree.assign(x), ann.calibrate(tree, x, 20, 0.97)
    found = total = 0
    for k in range(0, len(x), 7):
        s = x @ x[k]
        s[k] = -np.inf
        seen = set(tree.search(x[k], visits))
        found, total = found + sum(leaf[r] in seen for r in np.argsort(-s)[:20]), total + 20
    assert found / total >= 0.93 and visits < tree.leaves / 2
    assert ann.leaf_groups([5, 0, 3, 9, 2, 20, 1], 10) == [0, 0, 0, 1, 2, 3, 4] and ann.leaf_groups([]) == []
    assert ann.leaf_number(1) == 1 and ann.leaf_number(50_000) == 512 and ann.leaf_number(10**12) <= ann.MOST_SAMPLE // 16


# pipeline


def test_pipeline_runs_and_returns_tokens(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_output"]
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and sum(r.n_tokens for r in out) == max(r.start + r.n_tokens for r in out)


@pytest.mark.parametrize("empty_table", [False, True])
def test_pipeline_on_awkward_tables(spark, awkward, tmp_path, empty_table):
    """Nulls in every column, empty, long and repeated texts, clashing names; and no documents at all."""
    import corpus_pipeline

    docs = awkward.withColumn("n_chars", F.length("text").cast("long"))
    (docs.limit(0) if empty_table else docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 1, 1), (3, None, None), (4, 1, 0), (5, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this is in any document here"), (2, None), (None, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, f in corpus_pipeline.STAGES[:-1]:
        out = f(spark, stage, str(tmp_path))
        assert out.columns == docs.columns
    kept = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert not kept if empty_table else {r.doc_id for r in kept} >= {1, 2, 4}


def test_words_cut_here_get_the_librarys_ids():
    ids = WordIds(WORD_BPE)
    assert ids.direct
    pieces = ["", "don't", "I'LL'd", "a--b12,5%", "ÉTÉ", "aß-Öø;x_y", "x×y÷", "<|endoftext|>a", "<|ENDOFTEXT|>", "ǅ", "İ", "ﬁ", "e\u0301", "日本語", "a\x0bb", "\x1c", "ª²", "z" * 500]
    assert [ids.piece(p) for p in pieces] == [ids.library(p) for p in pieces]
    assert ids.texts([" ".join(pieces)]) == [ids.library(" ".join(pieces))]
    rnd = random.Random(12)
    alphabet = "abzABZ019 .,;:'!\"-_<|>\n\t\r\x0b\x1c\x85\xa0éÉßÿ×÷ªµ²Ǆİﬁ\u0301\u200b日😀" + "'s'll"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(40))) for _ in range(5000)]
    want = [ids.library(t) for t in texts]
    assert ids.texts(texts) == want
    ids.direct = False
    assert ids.texts(texts[:200]) == want[:200]


def test_a_word_is_merged_once_whatever_its_case_and_marks(monkeypatch):
    merged = []

    class Counting(WordIds):
        def word(self, word):
            merged.append(word)
            return super().word(word)

    texts = ["The the\tTHE, (the) the.", None, "", "the\n\n THE!", " ", "Éa éa, ÉA; 77"] * 3
    ids = Counting(WORD_BPE)
    want = [ids.library(t) if t else b"" for t in texts]
    assert ids.texts(texts) == want
    assert all(merged.count(w) == 1 for w in ["the", "éa", "7", ","])
    for most in (1, 25, 40):
        monkeypatch.setattr(tokens, "TOGETHER", most)
        assert ids.texts(texts) == want and ids.texts([]) == [] and ids.texts([None, " \n "]) == [b"", b""]


def test_bounded_caches_change_nothing(monkeypatch, docs):
    texts = [r.text for r in docs.select("text").collect()]
    whole = WordIds(WORD_BPE).texts(texts), PieceCounts(PIECE_BPE).texts(texts)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    small = WordIds(WORD_BPE)
    small.pieces.most, small.words.most = 20, 7
    assert small.texts(texts) == whole[0] and len(small.pieces) <= 20
    assert PieceCounts(PIECE_BPE).texts(texts) == whole[1]
