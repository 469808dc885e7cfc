"""Time buckets with completeness rules, and aggregation of households to projects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.config import FULL_BIN, Keys, Variable, minutes


def reduce_column(method: str, x: Column, enough: Column) -> Column:
    """sum, max or avg of ``x`` where enough values are there, else null."""
    by = {"sum": F.sum, "max": F.max, "avg": F.avg}
    if method not in by:
        raise ValueError(f"unknown method {method!r}")
    return F.when(enough, by[method](x))


def validated(x: str, validator: str | None) -> Column:
    """``x``, null where its validator says false."""
    col = F.col(f"`{x}`")
    return col if validator is None else F.when(~F.coalesce(F.col(f"`{validator}`"), F.lit(True)), None).otherwise(col)


def resample(df: DataFrame, variables: Mapping[str, Variable], interval: str, keys: Keys = Keys(), group: Sequence[str] | None = None, min_count: int | None = None) -> DataFrame:
    """One row per group and bucket between its first and last one; buckets that lack readings are null.

    Buckets are closed on the left, labelled by their start and aligned to midnight.  A value needs
    ``min_count`` readings, by default those of a full bucket.  All variables share one aggregation;
    the dense spine is made from its buckets, not from the readings.  Five minutes are a projection.
    """
    group = list(group or keys.entity)
    step = minutes(interval)
    if interval == "5min" and min_count is None:
        return df.select(*group, keys.time, *[F.col(f"`{c}`") for c in variables])
    least = FULL_BIN[interval] if min_count is None else min_count
    bucket = F.window(keys.time, f"{step} minutes")["start"].alias("bucket_start")
    cells = df.groupBy(*group, bucket).agg(*[reduce_column(v.resample, validated(c, v.validator), F.count(validated(c, v.validator)) >= least).alias(c) for c, v in variables.items()])
    span = cells.groupBy(*group).agg(F.min("bucket_start").alias("first_start"), F.max("bucket_start").alias("last_start"))
    spine = span.select(*group, F.explode(F.sequence("first_start", "last_start", F.expr(f"INTERVAL {step} MINUTES"))).alias("bucket_start"))
    return spine.join(cells, [*group, "bucket_start"], "left").withColumnRenamed("bucket_start", keys.time)


def aggregate(df: DataFrame, variables: Mapping[str, Variable], by: Sequence[str], time: str, presence: float = 0.6) -> DataFrame:
    """Values per group and moment where ``presence`` of its rows have one; ``n`` counts all rows.

    Method diff_cumsum averages the column's Diff and accumulates it over time within the group.
    """
    out, running = [], []
    for c, v in variables.items():
        if v.aggregate == "diff_cumsum":
            d = F.col(f"`{c}Diff`")
            if f"{c}Diff" not in variables:
                out.append(reduce_column("avg", d, F.count(d) >= presence * F.count("*")).alias(f"{c}Diff"))
            running.append(c)
        else:
            x = validated(c, v.validator)
            out.append(reduce_column(v.aggregate, x, F.count(x) >= presence * F.count("*")).alias(c))
    result = df.groupBy(*by, time).agg(*out, F.count("*").alias("n"))
    w = Window.partitionBy(*by).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    for c in running:
        d = F.col(f"`{c}Diff`")
        result = result.withColumn(c, F.when(d.isNotNull(), F.sum(d).over(w)))
    return result


def mean_diffs(df: DataFrame, columns: Sequence[str], keys: Keys = Keys()) -> DataFrame:
    """Plain mean of columns by project and moment."""
    return df.groupBy(keys.project, keys.time).agg(*[F.avg(f"`{c}`").alias(c) for c in columns])
