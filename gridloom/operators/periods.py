"""Rolling averages, peak and coldest periods, simultaneity.  Positions count rows from 0."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridloom.config import TIME, minutes


def steps(days: float, interval: str = "60min") -> int:
    """Rows in so many days."""
    return int(days * 1440 / minutes(interval))


def _series(by: Sequence[str]) -> WindowSpec:
    """Windows run within a series, in one task each; a table of many series needs its columns named."""
    if not by:
        raise ValueError("name the columns that tell series apart; without any, all rows would meet in one task")
    return Window.partitionBy(*by)


def rolling_mean(x: Column, w: WindowSpec, n: int) -> Column:
    """Mean of the last n rows, null unless half of them have values; ``w`` is ordered."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(x).over(frame) >= n // 2, F.avg(x).over(frame))


def rolling_average(df: DataFrame, by: Sequence[str], var: str, n: int, order: Sequence[str] = (TIME,), out: str = "RollingAverage") -> DataFrame:
    return df.withColumn(out, rolling_mean(F.col(f"`{var}`"), _series(by).orderBy(*order), n))


def rolling_days(df: DataFrame, by: Sequence[str], var: str, days: float = 14, order: Sequence[str] = (TIME,), out: str = "RollingAverage") -> DataFrame:
    """Trailing mean over ``days``; the rows in a day follow from the least step between moments of the data."""
    moment = F.col(order[0])
    gap = F.unix_micros(moment.cast("timestamp")) - F.unix_micros(F.lag(moment).over(_series(by).orderBy(*order)).cast("timestamp"))
    step = df.select(gap.alias("gap")).filter("gap > 0").agg(F.min("gap")).first()[0]
    n = max(1, round(days * 86_400_000_000 / step)) if step else 1
    return rolling_average(df, by, var, n, order, out)


def _extreme_period(df: DataFrame, by: Sequence[str], var: str, n: int, order: Sequence[str], best, out: str) -> DataFrame:
    w, ordered = _series(by), _series(by).orderBy(*order)
    time = order[0]
    begin = F.coalesce(F.lag(time, n - 1).over(ordered), F.first(time).over(ordered))
    rows = df.select(*by, begin.alias("StartTime"), F.col(time).alias("EndTime"), F.col(f"`{var}`").alias(out), best(f"`{var}`").over(w).alias("extreme"))
    return rows.filter(F.col(out) == F.col("extreme")).drop("extreme")


def highest_period(df: DataFrame, by: Sequence[str], var: str = "RollingAverage", n: int = 14 * 24, order: Sequence[str] = (TIME,)) -> DataFrame:
    """The n rows that end where ``var`` is highest; ties give a row each; begins at the first row at the earliest."""
    return _extreme_period(df, by, var, n, order, F.max, "HighestRollingAverage")


def lowest_period(df: DataFrame, by: Sequence[str], var: str = "RollingAvg_Temperatuur", n: int = 14 * 24, order: Sequence[str] = (TIME,)) -> DataFrame:
    return _extreme_period(df, by, var, n, order, F.min, "LowestRollingAverage")


def _mark(df: DataFrame, by: Sequence[str], order: Sequence[str], hit: Column, before: int, n: int, out: str) -> DataFrame:
    """Marks rows [p - before, p - before + n) for each hit at p.

    A start before the first row counts from the group's end, as array slices do; that leaves nothing
    in groups of n rows or more, and only in shorter ones are the hits' positions gathered.
    """
    w, ordered = _series(by), _series(by).orderBy(*order)
    df = df.select("*", (F.row_number().over(ordered) - 1).alias("mk_pos"), F.count(F.lit(1)).over(w).alias("mk_len"), F.coalesce(hit, F.lit(False)).alias("mk_hit"))
    inside = F.max(F.when(F.col("mk_hit") & (F.col("mk_pos") >= before), 1)).over(ordered.rowsBetween(before - n + 1, before))
    wrapped = F.collect_list(F.when(F.col("mk_hit") & (F.col("mk_len") < n) & (F.col("mk_pos") < before), F.col("mk_pos"))).over(w)
    r, size = F.col("mk_pos"), F.col("mk_len")
    around = F.exists(wrapped, lambda p: (r >= F.greatest(F.lit(0), size + p - before)) & (r < p - before + n))
    return df.withColumn(out, (inside.isNotNull()) | around).drop("mk_pos", "mk_len", "mk_hit")


def mark_coldest(df: DataFrame, by: Sequence[str], var: str = "TemperatuurRA", n: int = 14 * 24, order: Sequence[str] = ("YYYYMMDD", "HH"), out: str = "coldest") -> DataFrame:
    """Marks the n rows before each minimum of ``var``, the minimum itself excluded."""
    return _mark(df, by, order, F.col(f"`{var}`") == F.min(f"`{var}`").over(_series(by)), n, n, out)


def mark_highest_peak(df: DataFrame, by: Sequence[str], var: str = "ElektriciteitsgebruikTotaalNetto", n: int = 6 * 288, order: Sequence[str] = (TIME,), out: str = "peak") -> DataFrame:
    """Marks n rows around each maximum of ``var``."""
    return _mark(df, by, order, F.col(f"`{var}`") == F.max(f"`{var}`").over(_series(by)), math.ceil(n / 2), n, out)


def simultaneity(daily: DataFrame, fine: DataFrame, var: str = "RollingAverage", by: str | None = None) -> DataFrame:
    """Ratio of the highest daily to the highest fine average, by group if there is one."""
    keys = [by] if by else []
    a = daily.groupBy(*keys).agg(F.max(f"`{var}`").alias("HighestDailyAvg"))
    b = fine.groupBy(*keys).agg(F.max(f"`{var}`").alias("Highest5MinAvg"))
    both = a.join(b, keys, "full") if keys else a.crossJoin(F.broadcast(b))  # one row each
    return both.withColumn("Ratio", F.try_divide("HighestDailyAvg", "Highest5MinAvg"))
