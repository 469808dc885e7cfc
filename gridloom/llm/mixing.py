"""Mixing sources to target weights: temperature, and budgeted block permutations.

Tokens are counted as pre-tokenizers of public word tokenizers cut a text (runs of letters, digits, runs of
other signs); a column of exact counts may be given instead.  Weights are the sources' token shares raised to an exponent in [0, 1] and normalised.  The exponent
is bisected: the least one (the flattest mixture) that repeats no source more often than a limit, or
the one that meets a target entropy.  Each source's documents lie in blocks by hash; every epoch goes
through a new permutation of the blocks, and the last epoch stops where the budget ends, inside one
block at most.  Blocks have a bounded size in tokens, so that one is little work wherever it is walked.  Only
DataFrame functions run on the data; the driver sees one row for each source.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.llm.common import materialise

BLOCKS, BLOCK_TOKENS, MOST_BLOCKS = 256, 1 << 22, 1 << 16
"""A source's least number of blocks, the tokens of a block that make it have more, and its most blocks."""
MOST_SOURCES = 100_000
# How word tokenizers cut before they merge.
TOKEN = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def weights(shares: dict[str, int], exponent: float) -> dict[str, float]:
    top = max(shares.values())
    raw = {s: (n / top) ** exponent for s, n in shares.items()}
    total = sum(raw.values())
    return {s: v / total for s, v in raw.items()}


def entropy(w: dict[str, float]) -> float:
    return -sum(v * math.log(v) for v in w.values() if v > 0)


def repetition(shares: dict[str, int], exponent: float) -> float:
    """Most epochs of any source when the least repeated source has one."""
    w = weights(shares, exponent)
    each = [w[s] / n for s, n in shares.items()]
    return max(each) / min(each)


def bisect_exponent(shares: dict[str, int], repetition_limit: float | None = None, target_entropy: float | None = None) -> float:
    """Least exponent within the repetition limit, or the largest that still has the target entropy."""
    low, high = 0.0, 1.0
    if repetition_limit is not None:
        if repetition(shares, 0.0) <= repetition_limit:
            return 0.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (low, mid) if repetition(shares, mid) <= repetition_limit else (mid, high)
        return high
    if target_entropy is None:
        return 1.0
    if entropy(weights(shares, 1.0)) >= target_entropy:
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if entropy(weights(shares, mid)) >= target_entropy else (low, mid)
    return low


@dataclass(frozen=True)
class Mixture:
    exponent: float
    budgets: dict[str, int]
    tokens: dict[str, int]


def plan(tokens: dict[str, int], repetition_limit: float | None, target_entropy: float | None, budget: int | None) -> Mixture:
    """Budgets in tokens.  Without ``budget`` every source gets one epoch at least, so no document is lost."""
    live = {s: n for s, n in tokens.items() if n > 0}
    if not live:
        return Mixture(1.0, {}, tokens)
    exponent = bisect_exponent(live, repetition_limit, target_entropy)
    w = weights(live, exponent)
    scale = budget if budget is not None else max(n / w[s] for s, n in live.items())
    return Mixture(exponent, {s: int(round(w[s] * scale)) for s in live}, tokens)


def token_count(text: Column) -> Column:
    """Tokens before merges, at least one, so that empty texts are emitted as well."""
    return F.greatest(F.lit(1), F.regexp_count(F.coalesce(text, F.lit("")), F.lit(TOKEN))).cast("long")


def counting(text: Column, tokens: Column | None) -> Column:
    """The given count, at least one (null: one), or that of the text."""
    return token_count(text) if tokens is None else F.greatest(F.lit(1), F.coalesce(tokens, F.lit(1))).cast("long")


def block_number(tokens: float) -> int:
    return int(min(MOST_BLOCKS, max(BLOCKS, math.ceil(tokens / BLOCK_TOKENS))))


def emissions(rows: DataFrame, mixture: Mixture, seed: int = 0, counted: DataFrame | None = None, count: Column | None = None) -> DataFrame:
    """``rows`` (mix_source, mix_tokens, mix_row, ...) once for each emission, with mix_epoch, mix_block, mix_position.

    Wide rows may come without mix_tokens: ``counted`` (mix_source, mix_tokens, mix_row) then holds them
    for the plan, and ``count`` makes them again for the rows of cut blocks alone.

    mix_position in [0, 1) is the emission's place in its source's stream; ordering all rows by it
    interleaves the sources in proportion.
    """
    spark = rows.sparkSession
    listed = [(s, float(mixture.tokens[s]), float(b), block_number(mixture.tokens[s])) for s, b in mixture.budgets.items()]
    # one row a source, at most MOST_SOURCES of them
    budgets = F.broadcast(spark.createDataFrame(listed, "mix_source string, mix_have double, mix_budget double, mix_blocks int"))
    block = F.pmod(F.xxhash64("mix_row", F.lit(seed)), F.col("mix_blocks")).cast("int")
    dealt = lambda df: df.join(budgets.select("mix_source", "mix_blocks"), "mix_source").withColumn("mix_block", block).drop("mix_blocks")
    keyed = dealt(rows)
    blocks = (keyed if counted is None else dealt(counted)).groupBy("mix_source", "mix_block").agg(F.sum("mix_tokens").alias("block_tokens"))
    epochs = blocks.join(budgets.drop("mix_blocks"), "mix_source").withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("mix_budget") / F.col("mix_have")).cast("int") - 1))))
    order = Window.partitionBy("mix_source", "mix_epoch").orderBy(F.xxhash64("mix_source", "mix_epoch", "mix_block", F.lit(seed)), "mix_block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("block_tokens").over(order), F.lit(0)) + F.col("mix_epoch") * F.col("mix_have")
    table = epochs.withColumn("mix_start", start).filter(F.col("mix_start") < F.col("mix_budget"))
    table = table.select("mix_source", "mix_block", "mix_epoch", "mix_start", "mix_budget", "block_tokens")
    # whole blocks need no order within; the one cut block of a source is walked document by document
    cut = F.col("mix_start") + F.col("block_tokens") > F.col("mix_budget")
    joined = keyed.join(F.broadcast(table.withColumn("mix_cut", cut)) if sum(n for *_, n in listed) <= 200_000 else table.withColumn("mix_cut", cut), ["mix_source", "mix_block"])
    within = Window.partitionBy("mix_source", "mix_epoch", "mix_block").orderBy(F.xxhash64("mix_row", "mix_epoch", F.lit(seed)), "mix_row")
    walked = joined.filter("mix_cut")
    if count is not None:
        walked = walked.withColumn("mix_tokens", count)
    walked = walked.withColumn("mix_at", F.col("mix_start") + F.coalesce(F.sum("mix_tokens").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # an emission belongs to the mixture if it begins before the budget ends
    walked = walked.filter(F.col("mix_at") < F.col("mix_budget"))
    whole = joined.filter(~F.col("mix_cut")).withColumn("mix_at", F.col("mix_start") + F.pmod(F.xxhash64("mix_row", "mix_epoch", F.lit(seed)), F.lit(1 << 20)) / F.lit(float(1 << 20)) * F.col("block_tokens"))
    both = whole.unionByName(walked if count is None else walked.drop("mix_tokens"))
    return both.withColumn("mix_position", F.col("mix_at") / F.col("mix_budget")).drop("mix_start", "mix_budget", "block_tokens", "mix_cut", "mix_at")


NULL_SOURCE = "\x00null"


def keyed_rows(docs: DataFrame, source: str, text: str, tokens: str | None = None) -> DataFrame:
    """All columns of ``docs`` as one struct beside the mixing keys, so no name can clash."""
    count = counting(F.col(text), None if tokens is None else F.col(tokens))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_columns"),
        F.coalesce(F.col(source).cast("string"), F.lit(NULL_SOURCE)).alias("mix_source"),
        count.alias("mix_tokens"),
        F.xxhash64(*[F.col(f"`{c}`") for c in ("doc_id", text)]).alias("mix_row"),
    )


def source_tokens(keyed: DataFrame) -> dict[str, int]:
    """Tokens of each source, on the driver; more than MOST_SOURCES sources are refused."""
    rows = keyed.groupBy("mix_source").agg(F.sum("mix_tokens").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    return {r[0]: int(r[1]) for r in sorted(rows, key=lambda r: r[0])}


def mixture_table(docs: DataFrame, repetition_limit: float | None = 2.0, target_entropy: float | None = None, budget: int | None = None, seed: int = 0) -> DataFrame:
    """doc_id, source, n_tokens, epoch, block, position: one row for each emission of a document.

    A null source is a source of its own; null and empty texts count one token, very long ones all of theirs.
    Rows that repeat are emitted each; blocks and rows that tie in hash go by number.  Without ``budget`` every row is emitted once at least and ``repetition_limit + 1``
    times at most.  An empty table gives no rows.  Only doc_id, source and text are read.
    """
    narrow = materialise(keyed_rows(docs.select("doc_id", "source", "text"), "source", "text").select(F.col("mix_columns.doc_id").alias("doc_id"), F.col("mix_columns.source").alias("source"), "mix_source", "mix_tokens", "mix_row"), "mix")
    mixture = plan(source_tokens(narrow), repetition_limit, target_entropy, budget)
    if not mixture.budgets:
        return narrow.limit(0).select("doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.lit(0).alias("epoch"), F.lit(0).alias("block"), F.lit(0.0).alias("position"))
    out = emissions(narrow, mixture, seed)
    return out.select("doc_id", "source", F.col("mix_tokens").alias("n_tokens"), F.col("mix_epoch").alias("epoch"), F.col("mix_block").alias("block"), F.col("mix_position").alias("position"))


def mix(docs: DataFrame, repetition_limit: float | None = 2.0, target_entropy: float | None = None, budget: int | None = None, seed: int = 0, tokens: str | None = None) -> DataFrame:
    """Rows of ``docs``, all columns, once for each emission (see :func:`mixture_table`); ``tokens`` names a column of counts."""
    keyed = keyed_rows(docs, "source", "text", tokens)
    # the texts are counted once; the plan needs no more of them
    counted = materialise(keyed.select("mix_source", "mix_row", "mix_tokens"), "mix")
    mixture = plan(source_tokens(counted), repetition_limit, target_entropy, budget)
    if not mixture.budgets:
        return docs.limit(0)
    count = counting(F.col("mix_columns")["text"], None if tokens is None else F.col("mix_columns")[tokens])
    return emissions(keyed.drop("mix_tokens"), mixture, seed, counted, count).select("mix_columns.*")
