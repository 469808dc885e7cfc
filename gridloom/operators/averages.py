"""Outlier-trimmed project averages: households beyond a bound of their project do not count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.config import Keys

NEAR_ZERO = 1e-8


def diff_columns(columns: Sequence[str]) -> list[str]:
    return [f"{c}Diff" for c in columns]


def household_max(df: DataFrame, diffs: Sequence[str], keys: Keys = Keys()) -> DataFrame:
    """Largest value of each Diff by household."""
    return df.groupBy(*keys.entity).agg(*[F.max(F.col(f"`{c}`").cast("double")).alias(f"{c}_huis_max") for c in diffs])


def bounds(maxima: DataFrame, diffs: Sequence[str], keys: Keys = Keys()) -> DataFrame:
    """Household maxima with twice the 95th percentile of their project's maxima above zero.

    The percentile interpolates linearly; a project without any such household has a null bound.
    """
    each = maxima.groupBy(keys.project).agg(*[(2 * F.percentile(F.when(F.col(f"`{c}_huis_max`") > NEAR_ZERO, F.col(f"`{c}_huis_max`")), F.lit(0.95))).alias(f"{c}_upper_bound") for c in diffs])
    return maxima.join(each, keys.project, "left")


def household_bounds(df: DataFrame, diffs: Sequence[str], keys: Keys = Keys()) -> DataFrame:
    return bounds(household_max(df, diffs, keys), diffs, keys)


def trimmed_averages(df: DataFrame, diffs: Sequence[str], keys: Keys = Keys(), limits: DataFrame | None = None, check: bool = True) -> DataFrame:
    """Mean of each Diff by project and moment over the households whose maximum is below the bound.

    One aggregation serves all columns, so its keys are all moments of a project.  ``check`` makes the
    query fail on a negative value of a counted household, as such values must not be averaged.
    """
    limits = household_bounds(df, diffs, keys) if limits is None else limits
    joined = df.join(limits, keys.entity)
    out = []
    for c in diffs:
        counted = F.when(F.col(f"`{c}_huis_max`") < F.col(f"`{c}_upper_bound`"), F.col(f"`{c}`").cast("double"))
        if check:
            counted = F.when(counted < 0, F.raise_error(F.lit(f"negative value in {c}")).cast("double")).otherwise(counted)
        out.append(F.avg(counted).alias(f"{c}_avg"))
    return joined.groupBy(keys.project, keys.time).agg(*out)
