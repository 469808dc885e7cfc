"""How much was imputed, where and by which rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.config import Keys

WARN_PERCENT = 40


def share(part: Column, whole: Column) -> Column:
    """100 * part / whole of counts, rounded once: a quotient times 100 makes 7 of 25 more than 28 %."""
    return F.lit(100.0) * part / whole


def method_mask(methods: Column) -> Column:
    """OR of 1 << (m - 1) over the methods from 1 to 32; larger ones do not fit a shift and are left out."""
    fits = F.filter(methods, lambda m: (m > 0) & (m <= 32))
    return F.aggregate(fits, F.lit(0).cast("long"), lambda acc, m: acc.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), (m - 1).cast("int"))))


def gap_stats(long: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """Totals by household and column of an imputed long table (cum as measured)."""
    known = F.count("impute_type")
    return long.groupBy(*keys.entity, "column").agg(
        F.sum("diff").alias("diff_col_total"),
        (F.max("cum") - F.min("cum")).alias("cum_col_min_max_diff"),
        (F.sum("diff") - (F.max("cum") - F.min("cum"))).alias("deviation"),
        F.count("gap_length").alias("missing"),
        F.array_sort(F.collect_set("impute_type")).alias("methods"),
        known.alias("imputed"),
        (F.count("gap_length") - known).alias("imputed_na"),
        F.coalesce(F.bit_or("impute_type"), F.lit(0).cast("long")).alias("method_flags"),
        F.count("*").alias("total_records"),
    ).withColumn("bitwise_methods", method_mask(F.col("methods")))


def house_summary(stats: DataFrame) -> DataFrame:
    """Gap statistics with the share of imputed rows; total_records are the household's rows."""
    return stats.drop("deviation").withColumn("percentage_imputed", share(F.col("imputed"), F.col("total_records")))


def project_summary(stats: DataFrame, keys: Keys = Keys()) -> DataFrame:
    return (
        stats.groupBy(keys.project, "column")
        .agg(
            F.bit_or("bitwise_methods").alias("bitwise_methods"),
            F.bit_or("method_flags").alias("method_flags"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("methods")))).alias("methods"),
            F.sum("missing").alias("missing"),
            F.sum("imputed").alias("imputed"),
            F.sum("imputed_na").alias("imputed_na"),
            F.sum("total_records").alias("total_records"),
        )
        .withColumn("percentage_imputed", share(F.col("imputed"), F.col("total_records")))
    )


def reading_date_stats(long: DataFrame, keys: Keys = Keys()) -> DataFrame:
    """Imputed, missing and original rows by project, moment and column."""
    total = F.count("*")
    counts = long.groupBy(keys.project, keys.time, "column").agg(F.count(F.when(F.col("is_imputed"), 1)).alias("imputed"), F.count(F.when(F.col("diff").isNull(), 1)).alias("na"), total.alias("total_records"))
    counts = counts.withColumn("original", F.col("total_records") - F.col("imputed") - F.col("na"))
    return counts.withColumns({f"percent_{c}": share(F.col(c), F.col("total_records")) for c in ("imputed", "na", "original")})


def over_limit(summary: DataFrame, percent: float = WARN_PERCENT) -> DataFrame:
    """Rows of a summary of which more than ``percent`` % was imputed."""
    return summary.filter(F.col("percentage_imputed") > percent)


def validate_columns(df: DataFrame, columns: Sequence[str], keys: Keys = Keys()) -> DataFrame:
    """By household and column: whether it can be imputed (has values, a sum and a range that are not zero)."""
    each = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns]
    long = df.select(*keys.entity, F.inline(F.array(*each)))
    n, missing = F.count("*"), F.count(F.when(F.col("x").isNull(), 1))
    out = long.groupBy(*keys.entity, "column").agg(missing.alias("missing"), n.alias("total"), F.bround(F.sum("x"), 10).alias("s"), F.bround(F.max("x") - F.min("x"), 10).alias("r"))
    usable = (F.col("missing") < F.col("total")) & (F.col("s") != 0) & (F.col("r") != 0)
    return out.select(*keys.entity, "column", "missing", F.coalesce(usable, F.lit(False)).alias("usable"), (F.col("missing") > 0.4 * F.col("total")).alias("mostly_missing"))
