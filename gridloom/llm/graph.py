"""Connected components of an edge table: contraction to least neighbours, then union-find on a small rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import discard, materialise

SMALL = 1 << 14
"""Links up to which one task finishes the job; more are contracted first, over all tasks."""


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for batch in batches:
        for v, u in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            v, u = find(v), find(u)
            parent[max(v, u)] = min(v, u)
    if parent:
        nodes = np.fromiter(parent, dtype=np.int64, count=len(parent))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.array([find(x) for x in nodes.tolist()], dtype=np.int64))], ["v", "u"])


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long), root being the component's least node.

    Each round every node goes to its least neighbour's least neighbour and the links between what is
    left go on; once SMALL links or fewer are left, one task ends them.  Every step is written to the
    shared folder, so lost executors repeat one step at most, and nothing unbounded meets in one task.
    An empty edge table has no nodes; loops and repeated edges change nothing.
    """
    links = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
    named = last = None
    for _ in range(most):
        small = links.count() <= SMALL
        if small:
            tops = links.coalesce(1).mapInArrow(_finish, "v long, u long")
        else:
            both = links.union(links.select(F.col("u").alias("v"), F.col("v").alias("u")))
            ups = materialise(both.groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("u")), "ups")
            tops = materialise(ups.join(ups.select(F.col("v").alias("u"), F.col("u").alias("t")), "u").select("v", F.col("t").alias("u")), "tops")
        to = tops.select(F.col("v").alias("x"), F.col("u").alias("y"))
        if named is None:
            named = tops.select(F.col("v").alias("node"), F.col("u").alias("root"))
        else:
            last, named = named, named.join(to, named.root == to.x, "left").select("node", F.coalesce("y", "root").alias("root"))
        named = materialise(named, "named")
        discard(last)
        if small:
            discard(links)
            return named
        left = links.join(to, F.col("v") == F.col("x")).select("u", F.col("y").alias("a"))
        ends = left.join(to, F.col("u") == F.col("x")).select("a", F.col("y").alias("b"))
        left = materialise(ends.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "links")
        discard(links, ups, tops)
        links = left
    raise RuntimeError(f"components did not settle in {most} rounds")
