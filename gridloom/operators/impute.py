"""Gap imputation of meter increments and reconstruction of the cumulative meters.

A column pair (cumulative X, increment XDiff) is handled in long form, one row per reading and column,
so that the window logic runs once for all columns and a household's columns spread over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.config import Keys

NEAR_ZERO = 1e-8
# Flags of the imputation types.
NONE, NEGATIVE_GAP_JUMP, NEAR_ZERO_GAP_JUMP, LINEAR_FILL, SCALED_FILL = 0, 1, 2, 4, 8
ZERO_END_VALUE, POSITIVE_END_VALUE, NO_END_VALUE, THRESHOLD_ADJUSTED = 16, 32, 64, 128


def to_long(df: DataFrame, columns: Sequence[str], keys: Keys = Keys(), carried: Sequence[str] = ()) -> DataFrame:
    """(keys, column, cum, diff, avg) of a wide table with X, XDiff and XDiff_avg.

    Columns ``carried`` travel as one struct on the row of the first meter alone.
    """
    each = []
    for k, c in enumerate(columns):
        parts = [F.lit(f"{c}Diff").alias("column"), F.col(f"`{c}`").cast("double").alias("cum"), F.col(f"`{c}Diff`").cast("double").alias("diff"), F.col(f"`{c}Diff_avg`").cast("double").alias("avg")]
        if carried:
            whole = F.struct(*[F.col(f"`{r}`") for r in carried])
            parts.append((whole if k == 0 else F.lit(None).cast(df.select(whole).schema[0].dataType)).alias("carried"))
        each.append(F.struct(*parts))
    return df.select(*keys.entity, *keys.order, F.inline(F.array(*each)))


def numbered(df: DataFrame, keys: Keys = Keys(), out: str = "reading") -> DataFrame:
    """Numbers the readings of a household at one moment (null moments too) from 1, by their contents.

    Rows equal in all columns are interchangeable, so a repeated task gives the same table.
    """
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields]
    w = Window.partitionBy(*keys.entity, *keys.order).orderBy(F.xxhash64(*plain), F.hash(*plain))
    return df.withColumn(out, F.row_number().over(w))


def gap_groups(long: DataFrame, keys: Keys = Keys(), by: Sequence[str] = ("column",)) -> DataFrame:
    """Adds grp (null outside gaps) and gap_length.

    A gap is a run of null increments; it ends with the first row that has a cumulative value, after
    which the next null increment begins another.
    """
    series = [*keys.entity, *by]
    w = Window.partitionBy(*series).orderBy(*keys.order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    missing = F.col("diff").isNull()
    seen = missing & F.col("cum").isNotNull()
    start = missing & ~F.lag(missing, 1, False).over(w)
    flagged = long.select("*", (start | F.lag(seen, 1, False).over(w)).alias("gap_edge"), F.lag("cum").over(w).alias("lag_cum"))
    numbered = flagged.withColumn("grp", F.when(F.col("diff").isNull(), F.sum(F.col("gap_edge").cast("int")).over(upto)))
    return numbered.withColumn("gap_length", F.when(F.col("grp").isNotNull(), F.count("*").over(Window.partitionBy(*series, "grp")))).drop("gap_edge")


def house_factor(long: DataFrame, keys: Keys = Keys(), by: Sequence[str] = ("column",)) -> DataFrame:
    """Adds house_impute_factor: sum of averages over sum of increments where both are known.

    It is 1 unless over half of the household's rows are comparable and both sums make a finite ratio.
    """
    w = Window.partitionBy(*keys.entity, *by)
    comparable = F.col("avg").isNotNull() & F.col("diff").isNotNull() & (F.col("diff") >= 0)
    ratio = F.try_divide(F.sum(F.when(comparable, F.col("avg"))).over(w), F.sum(F.when(comparable, F.col("diff"))).over(w))
    enough = F.count(F.when(comparable, 1)).over(w) > F.count("*").over(w) / 2
    return long.withColumn("house_impute_factor", F.when(enough, F.coalesce(ratio, F.lit(1.0))).otherwise(1.0))


def impute_long(long: DataFrame, keys: Keys = Keys(), by: Sequence[str] = ("column",), thresholds: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """Fills gaps and replaces values beyond thresholds; adds old_diff, is_imputed, impute_type.

    Null cumulative and average values are unknown; a gap of which neither the value before nor the
    one at its end is known stays null.  Negative averages make the query fail.
    """
    series = [*keys.entity, *by]
    g = Window.partitionBy(*series, "grp")
    in_group = g.orderBy(*keys.order)
    df = house_factor(gap_groups(long, keys, by), keys, by)
    value = F.coalesce(F.when(F.col("avg") < 0, F.raise_error(F.lit("negative average")).cast("double")).otherwise(F.col("avg")), F.lit(0.0))
    inside = F.col("grp").isNotNull()
    first = F.first("lag_cum").over(in_group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    last = F.max("cum").over(g)
    df = df.select("*", value.alias("value"), F.when(inside & (first >= 0), first).alias("prev"), F.when(inside & (last >= 0), last).alias("end"), F.sum(value).over(g).alias("impute_jump"))
    jump, prev, end, v = F.col("end") - F.col("prev"), F.col("prev"), F.col("end"), F.col("value")
    known = prev.isNotNull() & end.isNotNull()
    cases: list[tuple[Column, Column, int]] = [
        (known & (jump < 0), F.lit(0.0), NEGATIVE_GAP_JUMP),
        (known & (jump < NEAR_ZERO), F.lit(0.0), NEAR_ZERO_GAP_JUMP),
        (known & (F.col("impute_jump") < NEAR_ZERO), F.bround(jump / F.col("gap_length"), 10), LINEAR_FILL),
        (known, F.bround(v * F.try_divide(jump, F.col("impute_jump")), 10), SCALED_FILL),
        (prev.isNull() & (end < NEAR_ZERO), F.lit(0.0), ZERO_END_VALUE),
        (prev.isNull() & (end > NEAR_ZERO), v, POSITIVE_END_VALUE),
        (prev.isNotNull() & end.isNull(), v * F.col("house_impute_factor"), NO_END_VALUE),
    ]
    kind, filled = F.lit(None).cast("long"), F.col("diff")
    for when, new, flag in reversed(cases):
        kind = F.when(inside & when, F.lit(flag).cast("long")).otherwise(kind)
        filled = F.when(inside & when, new).otherwise(filled)
    df = df.select(*[c for c in long.columns if c != "diff"], F.col("diff").alias("old_diff"), "gap_length", "house_impute_factor", filled.alias("diff"), kind.alias("impute_type"))
    return apply_thresholds(df.withColumn("is_imputed", F.col("impute_type").isNotNull()), thresholds or {})


def apply_thresholds(df: DataFrame, thresholds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Increments outside their column's bounds become the average and gain the threshold flag."""
    beyond = F.lit(False)
    for column, (low, high) in thresholds.items():
        beyond = beyond | ((F.col("column") == column) & ((F.col("diff") < low) | (F.col("diff") > high)))
    beyond = F.coalesce(beyond, F.lit(False))
    return df.withColumns(
        {
            "diff": F.when(beyond, F.col("avg")).otherwise(F.col("diff")),
            "impute_type": F.when(beyond, F.coalesce("impute_type", F.lit(0).cast("long")).bitwiseOR(F.lit(THRESHOLD_ADJUSTED).cast("long"))).otherwise(F.col("impute_type")),
            "is_imputed": beyond | F.col("is_imputed"),
        }
    )


def reconstruct_long(df: DataFrame, keys: Keys = Keys(), by: Sequence[str] = ("column",)) -> DataFrame:
    """original = cum; cum = running sum of increments (null where they are); check = step of the difference."""
    w = Window.partitionBy(*keys.entity, *by).orderBy(*keys.order)
    total = F.when(F.col("diff").isNotNull(), F.sum("diff").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.withColumn("original", F.col("cum")).withColumn("cum", total)
    gap = F.col("cum") - F.col("original")
    return df.withColumn("check", gap - F.lag(gap).over(w))


def to_wide(long: DataFrame, columns: Sequence[str], keys: Keys = Keys()) -> DataFrame:
    """One row per reading with X, XOriginal, XCheck, XDiff, XOldDiff, XDiff_avg, XDiff_is_imputed, XDiff_impute_type.

    ``keys`` must tell readings apart (see :func:`numbered`).  Carried columns come back as they were.
    """
    out = []
    for c in columns:
        mine = F.col("column") == f"{c}Diff"
        for name, source in ((c, "cum"), (f"{c}Original", "original"), (f"{c}Check", "check"), (f"{c}Diff", "diff"), (f"{c}OldDiff", "old_diff"), (f"{c}Diff_avg", "avg"), (f"{c}Diff_is_imputed", "is_imputed"), (f"{c}Diff_impute_type", "impute_type")):
            out.append(F.max(F.when(mine, F.col(source))).alias(name))
    if "carried" not in long.columns:
        return long.groupBy(*keys.entity, *keys.order).agg(*out)
    names = [f.name for f in long.schema["carried"].dataType.fields]
    wide = long.groupBy(*keys.entity, *keys.order).agg(*out, F.first("carried", ignorenulls=True).alias("carried"))
    return wide.select(*[F.col(f"`{c}`") for c in wide.columns if c != "carried"], *[F.col("carried")[n].alias(n) for n in names])
