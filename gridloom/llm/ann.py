"""Approximate nearest neighbours: hierarchical k-means tree, best-bin-first search by priority queue.

The tree is fitted on a bounded sample; every row is put into a leaf.  Leaves number about the square root
of the rows, up to what the sample can tell apart.  A query walks the tree through a queue ordered by the
bound that each unvisited branch has on its inner product, visiting as many leaves as calibration found
necessary: visits are widened until the recall against brute force, on queries of the sample over the other
rows of the sample, reaches the target.  Rows are dealt by groups of neighbouring leaves, queries to the
groups that hold leaves they visit.  Scores are exact inner products in double precision.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridloom.llm.common import materialise

SAMPLE, MOST_SAMPLE = 8192, 65_536
"""The tree is fitted and calibrated on so many rows (those with the smallest id hash): 16 a leaf, within these bounds."""
BRANCH, ROUNDS = 8, 8
RECALL, PROBES = 0.97, 256
CHUNK, QUERIES, PARTS = 8192, 256, 16
"""At most about so many rows, and so many queries, of a group of leaves meet in one task's memory; queries scored at once; parts of a merge."""


def leaf_number(rows: int, branch: int = BRANCH) -> int:
    """Power of ``branch`` nearest to the square root of the rows, as far as MOST_SAMPLE // 16 leaves."""
    depth = round(math.log(max(1.0, rows**0.5), branch))
    while branch**depth > MOST_SAMPLE // 16:
        depth -= 1
    return branch**depth


def leaf_groups(sizes: list[int], most: int = CHUNK) -> list[int]:
    """Group of each leaf: leaves that follow one another, neighbours in the tree, up to ``most`` rows together."""
    out, group, held = [], 0, 0
    for n in sizes:
        if held and held + n > most:
            group, held = group + 1, 0
        out.append(group)
        held += n
    return out


@dataclass
class Node:
    children: list[Node] | None = None
    centres: np.ndarray | None = None
    radii: np.ndarray | None = None
    leaf: int = -1


class Tree:
    def __init__(self, rows: np.ndarray, branch: int = BRANCH, leaves: int = 64, seed: int = 3):
        self.leaves = 0
        self.rng = np.random.default_rng(seed)
        self.depth = max(0, round(math.log(leaves, branch))) if len(rows) else 0
        self.root = self._grow(rows, self.depth, branch)

    def _grow(self, rows: np.ndarray, depth: int, branch: int) -> Node:
        if depth == 0 or len(np.unique(rows[: 4 * branch], axis=0)) < 2:
            self.leaves += 1
            return Node(leaf=self.leaves - 1)
        centres = rows[self.rng.choice(len(rows), min(branch, len(rows)), replace=False)].copy()
        for _ in range(ROUNDS):
            own = nearest(rows, centres)
            for k in range(len(centres)):
                if (mine := rows[own == k]).size:
                    centres[k] = mine.mean(axis=0)
        own = nearest(rows, centres)
        used = np.flatnonzero(np.bincount(own, minlength=len(centres)))
        centres = centres[used]
        own = nearest(rows, centres)
        # the 90th percentile of the distances, not the largest: one outlier must not open every branch
        radii = np.array([np.quantile(np.linalg.norm(rows[own == k] - c, axis=1), 0.9) if (own == k).any() else 0.0 for k, c in enumerate(centres)])
        return Node([self._grow(rows[own == k], depth - 1, branch) for k in range(len(centres))], centres, radii)

    def assign(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), dtype=np.int64)
        todo = [(self.root, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if node.children is None:
                out[at] = node.leaf
            elif len(at):
                own = nearest(rows[at], node.centres)
                todo += [(child, at[own == k]) for k, child in enumerate(node.children)]
        return out

    def search(self, query: np.ndarray, visits: int) -> list[int]:
        """Leaves in best-bin-first order: the branch with the highest possible inner product next."""
        norm = float(np.linalg.norm(query))
        queue: list[tuple[float, int, Node]] = [(0.0, 0, self.root)]
        found, n = [], 0
        while queue and len(found) < visits:
            _, _, node = heapq.heappop(queue)
            if node.children is None:
                found.append(node.leaf)
                continue
            bound = node.centres @ query + norm * node.radii
            for k, child in enumerate(node.children):
                n += 1
                heapq.heappush(queue, (-float(bound[k]), n, child))
        return found


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * rows @ centres.T, axis=1)


def calibrate(tree: Tree, rows: np.ndarray, top: int, target: float = RECALL, probes: int = PROBES) -> int:
    """Least number of leaf visits whose recall over ``rows`` reaches ``target``."""
    if not len(rows):
        return 1
    leaf = tree.assign(rows)
    probed = np.arange(0, len(rows), max(1, len(rows) // probes))[:probes]
    need = min(top, len(rows) - 1)
    rank = []
    for at in probed:
        scores = rows @ rows[at]
        scores[at] = -np.inf  # a query is not its own neighbour
        place = {x: k for k, x in enumerate(tree.search(rows[at], tree.leaves))}
        rank += [place[leaf[r]] for r in np.argpartition(-scores, need - 1)[:need]] if need else []
    rank = np.array(rank)
    visits = 1
    while visits < tree.leaves and len(rank) and (rank < visits).mean() < target:
        visits += 1
    return visits


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """id and double vector of the rows that take part: ids and components non-null, finite, not all zero."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.filter(F.coalesce(fine, F.lit(False))).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def block_top(queries: np.ndarray, q_ids: np.ndarray, visited: list[np.ndarray], rows: np.ndarray, r_ids: np.ndarray, leaves: np.ndarray, top: int) -> Iterator[tuple[int, int, float]]:
    """The ``top`` best rows of each query in the leaves it visits, ties to the smaller id, itself left out."""
    order = np.lexsort((r_ids, leaves))
    rows, r_ids, leaves = rows[order], r_ids[order], leaves[order]
    names, starts = np.unique(leaves, return_index=True)
    ends = np.append(starts[1:], len(leaves))
    for a in range(0, len(queries), QUERIES):
        mine = visited[a : a + QUERIES]
        asked = {int(x): [] for x in names}
        for k, own in enumerate(mine):
            for x in own.tolist():
                if x in asked:
                    asked[x].append(k)
        scores = np.full((len(mine), len(rows)), -np.inf)
        for x, s, e in zip(names.tolist(), starts.tolist(), ends.tolist(), strict=True):
            if asked[x]:
                scores[asked[x], s:e] = queries[a : a + QUERIES][asked[x]] @ rows[s:e].T
        for k, line in enumerate(scores):
            line[r_ids == q_ids[a + k]] = -np.inf
            need = min(top, len(line))
            floor = np.partition(line, len(line) - need)[len(line) - need]
            at = np.flatnonzero((line >= floor) & (line > -np.inf))
            for r in at[np.lexsort((r_ids[at], -line[at]))][:top]:
                # of the vectors alone: a product of matrices may round otherwise for other blocks
                yield int(q_ids[a + k]), int(r_ids[r]), float(queries[a + k] @ rows[r])


def nearest_neighbours(rows: DataFrame, modulus: int = 20, top: int = 20, vec_id: str = "vec_id", vector: str = "embedding", recall: float = RECALL, branch: int = BRANCH, leaves: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``top`` best candidates found.

    Queries are the rows whose id is divisible by ``modulus``.  Vectors that are null, zero or hold null
    or non-finite components take no part, nor do null ids or vectors of another length than the most
    common one of the sample; equal scores go to the smaller id; repeated ids count once.  Fewer
    candidates than ``top`` are all returned; an empty table gives no rows.  Only the two columns are read.
    """
    spark = rows.sparkSession
    live = materialise(usable(rows, vec_id, vector).groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    leaves = leaf_number(live.count(), branch) if leaves is None else leaves
    sample = live.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(MOST_SAMPLE, max(SAMPLE, 16 * leaves))).toPandas()
    if sample.empty:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    width = int(sample["v"].map(len).mode().iloc[0])
    fit = np.stack([v for v in sample["v"] if len(v) == width]).astype(np.float64)
    tree = Tree(fit, branch, leaves)
    visits = calibrate(tree, fit, top, recall)
    held = spark.sparkContext.broadcast((tree, visits))

    @pandas_udf("int")
    def leaf_of(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in vectors:
            yield pd.Series(held.value[0].assign(np.stack(batch.to_list()).astype(np.float64)) if len(batch) else [], dtype="int32")

    live = live.filter(F.size("v") == width)
    placed = materialise(live.withColumn("leaf", leaf_of("v")), "leaves")
    # sizes of leaves, of which there are MOST_SAMPLE // 16 at most, and of the groups made of them
    counts = {r[0]: r[1] for r in placed.groupBy("leaf").count().collect()}
    group = leaf_groups([counts.get(k, 0) for k in range(tree.leaves)])
    grouped = np.array(group, dtype=np.int32)
    placed = placed.join(F.broadcast(spark.createDataFrame(list(enumerate(group)), "leaf int, grp int")), "leaf")

    @pandas_udf("array<struct<grp:int,leaves:array<int>>>")
    def visited(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in vectors:
            tree, visits = held.value
            out = []
            for v in batch:
                found = np.sort(np.array(tree.search(np.asarray(v, dtype=np.float64), visits), dtype=np.int32))
                cuts = np.flatnonzero(np.diff(grouped[found])) + 1
                out.append([{"grp": int(grouped[x[0]]), "leaves": x.tolist()} for x in np.split(found, cuts)])
            yield pd.Series(out)

    asked = materialise(live.filter(F.col("vec_id") % modulus == 0).select("vec_id", "v", F.inline(visited("v"))), "asked")
    # into how many chunks the rows and queries of each group are cut
    r_n: dict[int, int] = {}
    for leaf, n in counts.items():
        r_n[group[leaf]] = r_n.get(group[leaf], 0) + n
    q_n = {r[0]: r[1] for r in asked.groupBy("grp").count().collect()}
    chunks = [(g, -(-r_n[g] // CHUNK), -(-q_n.get(g, 0) // CHUNK) or 1) for g in sorted(r_n)]
    cut = F.broadcast(spark.createDataFrame(chunks, "grp int, r_chunks int, q_chunks int"))
    r_side = placed.join(cut, "grp").select("grp", F.pmod(F.xxhash64("vec_id"), "r_chunks").cast("int").alias("rc"), F.explode(F.sequence(F.lit(0), F.col("q_chunks") - 1)).alias("qc"), "vec_id", "v", "leaf")
    q_side = asked.join(cut, "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("r_chunks") - 1)).alias("rc"), F.pmod(F.xxhash64("vec_id"), "q_chunks").cast("int").alias("qc"), "vec_id", "v", "leaves")

    def meet(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        got = block_top(np.stack(q["v"].to_list()), q["vec_id"].to_numpy(), q["leaves"].to_list(), np.stack(r["v"].to_list()), r["vec_id"].to_numpy(), r["leaf"].to_numpy(), top)
        return pd.DataFrame(list(got), columns=["query_id", "vec_id", "score"])

    keys = ["grp", "rc", "qc"]
    near = q_side.groupBy(*keys).cogroup(r_side.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("i"))))
    # the best of each query in a few parts, then over the parts: no buffer holds all its candidates
    part = near.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(PARTS)))
    best = part.groupBy("query_id", "part").agg(F.slice(order, 1, top).alias("best")).groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, top).alias("best"))
    return best.select("query_id", F.posexplode("best")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.i").alias("vec_id"), (-F.col("col.s")).alias("score"))
