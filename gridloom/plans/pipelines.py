"""End-to-end plans: combine, impute, derive, resample, aggregate.  Each returns lazy tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.config import CUMULATIVE_COLUMNS, VARIABLES, EngineConfig, Keys, Variable
from gridloom.functions.scalar import calculated_columns
from gridloom.operators import averages, impute, stats
from gridloom.operators.resample import aggregate, mean_diffs, resample
from gridloom.sources import tables

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Imputation:
    """An imputation run: the long table (a row for each reading and meter), and all tables derived from it."""

    long: DataFrame
    averages: DataFrame
    bounds: DataFrame
    columns: tuple[str, ...]
    keys: Keys

    @property
    def households(self) -> DataFrame:
        return impute.to_wide(self.long, self.columns, self.keys).drop(READING)

    @property
    def gap_stats(self) -> DataFrame:
        return stats.gap_stats(self.long.withColumn("cum", F.col("original")), self.keys)

    @property
    def summary_household(self) -> DataFrame:
        return stats.house_summary(self.gap_stats)

    @property
    def summary_project(self) -> DataFrame:
        return stats.project_summary(self.gap_stats, self.keys)

    @property
    def summary_reading_date(self) -> DataFrame:
        return stats.reading_date_stats(self.long, self.keys)

    @property
    def project_diffs(self) -> DataFrame:
        return mean_diffs(self.households, averages.diff_columns(self.columns), self.keys)


READING = "reading"


def impute_households(df: DataFrame, columns: Sequence[str] = CUMULATIVE_COLUMNS, thresholds: Mapping[str, tuple[float, float]] | None = None, keys: Keys = Keys(), average_table: DataFrame | None = None, config: EngineConfig | None = None) -> Imputation:
    """Imputes all meters of a household table and reconstructs the cumulative ones.

    ``average_table`` holds project averages made before; by default they are made here.  Thresholds
    come from ``config`` unless given.  Repeated readings of a moment and readings without a moment are
    rows of their own; other columns come along.  Every table is derived from the long one: store that
    (:func:`write_imputation` does) when several are used.
    """
    thresholds = (config.thresholds if config else {}) if thresholds is None else thresholds
    columns = [c for c in columns if c in df.columns]
    diffs = averages.diff_columns(columns)
    bounds = averages.household_bounds(df, diffs, keys)
    means = averages.trimmed_averages(df, diffs, keys, bounds) if average_table is None else average_table
    row_keys = replace(keys, tie=(*keys.tie, READING))
    joined = impute.numbered(df, keys, READING).join(means, [keys.project, keys.time], "left")
    rest = [c for c in df.columns if c not in {*keys.entity, *keys.order, *columns, *diffs}]
    long = impute.reconstruct_long(impute.impute_long(impute.to_long(joined, columns, row_keys, rest), row_keys, thresholds=thresholds), row_keys)
    return Imputation(long, means, bounds, tuple(columns), row_keys)


def write_imputation(run: Imputation, config: EngineConfig, percent: float = stats.WARN_PERCENT) -> Imputation:
    """Stores the long table once and, read back from it, all others; warns of what was imputed above ``percent`` %."""
    folder = config.aggregate_folder_path
    spark = run.long.sparkSession
    tables.write_table(run.bounds, f"{folder}/household_diff_max_bounds.parquet", None)
    tables.write_table(run.averages, f"{folder}/avg_diffs.parquet", run.keys.project)
    tables.write_table(run.long, f"{folder}/household_imputed_long.parquet", None)
    run = replace(run, long=spark.read.schema(run.long.schema).parquet(f"{folder}/household_imputed_long.parquet"))
    tables.write_table(run.households, f"{folder}/household_imputed.parquet", run.keys.project)
    done = tables.read_table(spark, f"{folder}/household_imputed.parquet")
    tables.write_table(mean_diffs(done, averages.diff_columns(run.columns), run.keys), f"{folder}/household_aggregated_diff.parquet", run.keys.project)
    tables.write_table(run.gap_stats, f"{folder}/impute_gap_stats.parquet", None)
    gaps = spark.read.parquet(f"{folder}/impute_gap_stats.parquet")
    summaries = {"household": stats.house_summary(gaps), "project": stats.project_summary(gaps, run.keys), "reading_date": run.summary_reading_date}
    for name, table in summaries.items():
        path = f"{folder}/impute_summary_{name}.parquet"
        tables.write_table(table, path, None)
        share = "percent_imputed" if name == "reading_date" else "percentage_imputed"
        over = spark.read.parquet(path).filter(F.col(share) > percent)
        # a count and the ten worst rows reach the driver
        if n := over.count():
            log.warning("more than %s %% imputed in %d rows by %s, first %s", percent, n, name, [r.asDict() for r in over.orderBy(F.desc(share)).limit(10).collect()])
    return run


def combine(spark: SparkSession, config: EngineConfig) -> DataFrame:
    """Unites included households and stores them as the default household table."""
    df = tables.union_households(spark, config)
    tables.write_table(df, f"{config.aggregate_folder_path}/household_default.parquet")
    return tables.read_households(spark, config)


def calculate(spark: SparkSession, config: EngineConfig, df: DataFrame | None = None) -> DataFrame:
    df = calculated_columns(tables.read_households(spark, config, "imputed") if df is None else df)
    tables.write_table(df, f"{config.aggregate_folder_path}/household_calculated.parquet")
    return tables.read_households(spark, config, "calculated")


def resample_households(spark: SparkSession, config: EngineConfig, intervals: Sequence[str] = ("60min", "15min", "5min"), variables: Mapping[str, Variable] = VARIABLES, df: DataFrame | None = None, name: str = "household", min_count: int | None = None) -> dict[str, DataFrame]:
    df = tables.read_households(spark, config, "calculated") if df is None else df
    out = {}
    for interval in intervals:
        path = f"{config.aggregate_folder_path}/{tables.sanitize(name)}_{interval}.parquet"
        tables.write_table(resample(df, variables, interval, min_count=min_count), path)
        out[interval] = tables.read_table(spark, path)
    return out


def aggregate_projects(spark: SparkSession, config: EngineConfig, intervals: Sequence[str] = ("5min", "15min", "60min"), variables: Mapping[str, Variable] = VARIABLES, keys: Keys = Keys()) -> dict[str, DataFrame]:
    out = {}
    for interval in intervals:
        path = f"{config.aggregate_folder_path}/project_{interval}.parquet"
        tables.write_table(aggregate(tables.read_households(spark, config, interval), variables, [keys.project], keys.time), path)
        out[interval] = tables.read_table(spark, path)
    return out
