"""Scans and sinks of the stored tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.config import HOUSE, PROJECT, EngineConfig
from gridloom.operators.joins import add_index_columns


def sanitize(name: str) -> str:
    """Table name as files have it: runs of other characters than letters, digits and _ become _."""
    return re.sub(r"\W+", "_", name).lower()


def scan(spark: SparkSession, *paths: str, merge: bool = False) -> DataFrame:
    """Parquet as it is.  Where files hold nanosecond timestamps, and only there, the session's setting
    ``spark.sql.legacy.parquet.nanosAsLong`` is turned on, and stays on, since Spark reads it as the query runs."""
    reader = spark.read.option("mergeSchema", merge)
    try:
        return reader.parquet(*paths)
    except PySparkException as e:
        if "NANOS" not in str(e):
            raise
        spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
        return reader.parquet(*paths)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet with NaN as null and nanosecond timestamps (read as long) as microseconds; see :func:`scan`."""
    return normalise(scan(spark, path))


def normalise(df: DataFrame, nanos: Sequence[str] = ("ReadingDate",)) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        elif f.name in nanos and isinstance(f.dataType, T.LongType):
            # without a zone from the start, as a cast of an instant would depend on the session's; in whole numbers, as doubles round
            c = F.expr(f"timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, CAST((`{f.name}` - pmod(`{f.name}`, 1000)) div 1000 AS DECIMAL(24, 6)) / 1000000)")
        out.append(c.alias(f.name))
    return df.select(*out)


def read_index(spark: SparkSession, config: EngineConfig) -> DataFrame:
    """Household metadata; an old name of the household column is accepted."""
    df = read_table(spark, f"{config.mapped_folder_path}/index.parquet")
    return df.withColumnRenamed("HuisCode", HOUSE) if HOUSE not in df.columns else df


def included(index: DataFrame, flag: str = "Meenemen") -> DataFrame:
    """Households that take part; a null flag is none."""
    return index.filter(F.col(flag))


def select_columns(df: DataFrame, names: Sequence[str] = (), starts: str | None = None, ends: str | None = None, contains: str | None = None, without: str | None = None) -> DataFrame:
    """Columns by name: those of ``names``, and those that begin with, end with or contain a text; never those that contain ``without``."""
    fits = lambda c: c in names or (starts is not None and c.startswith(starts)) or (ends is not None and c.endswith(ends)) or (contains is not None and contains in c)
    any_rule = names or starts is not None or ends is not None or contains is not None
    return df.select(*[F.col(f"`{c}`") for c in df.columns if (fits(c) if any_rule else True) and not (without and without in c)])


def read_households(spark: SparkSession, config: EngineConfig, interval: str = "default", metadata: Sequence[str] | None = None) -> DataFrame:
    df = read_table(spark, f"{config.aggregate_folder_path}/household_{interval}.parquet")
    return add_index_columns(df, read_index(spark, config), metadata) if metadata else df


def read_aggregate(spark: SparkSession, config: EngineConfig, name: str, interval: str) -> DataFrame:
    return read_table(spark, f"{config.aggregate_folder_path}/{sanitize(name)}_{interval}.parquet")


def read_diffs(spark: SparkSession, config: EngineConfig) -> DataFrame:
    return read_table(spark, f"{config.aggregate_folder_path}/avg_diffs.parquet")


def read_bounds(spark: SparkSession, config: EngineConfig) -> DataFrame:
    return read_table(spark, f"{config.aggregate_folder_path}/household_diff_max_bounds.parquet")


def union_households(spark: SparkSession, config: EngineConfig) -> DataFrame:
    """Readings of all included households: one scan of their files, ids taken from the file name.

    The paths come from the index's included rows, so other households' files are not read.
    """
    index = included(read_index(spark, config)).select(F.col(HOUSE).cast("long").alias(HOUSE), F.col(PROJECT).cast("long").alias(PROJECT)).distinct()
    paths = [f"{config.mapped_folder_path}/household_{r[0]}_table.parquet" for r in index.select(HOUSE).distinct().toLocalIterator()]
    if not paths:
        raise ValueError("no household is included")
    df = scan(spark, *paths, merge=True)
    # the name of a single file, or of the folder that a writer made of it
    name = F.regexp_extract(F.col("_metadata.file_path"), r"household_(\d+)_table", 1).cast("long")
    df = normalise(df.select("*", name.alias(HOUSE)).drop(PROJECT) if HOUSE not in df.columns else df.drop(HOUSE, PROJECT).select("*", name.alias(HOUSE)))
    return df.join(index, HOUSE)


def write_table(df: DataFrame, path: str, partition: str | None = PROJECT) -> None:
    """Overwrites a table, laid out by project where it has one, so that readers prune."""
    w = df.write.mode("overwrite")
    (w.partitionBy(partition) if partition and partition in df.columns and len(df.columns) > 1 else w).parquet(path)


def profile(df: DataFrame) -> DataFrame:
    """column, rows, min, max, null_count of every column, in one pass."""
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))]
    agg = [F.count("*").alias("rows")]
    for k, c in enumerate(plain):
        x = F.col(f"`{c}`")
        agg += [F.min(x).cast("string").alias(f"lo{k}"), F.max(x).cast("string").alias(f"hi{k}"), F.count(F.when(x.isNull(), 1)).alias(f"na{k}")]
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"lo{k}").alias("min"), F.col(f"hi{k}").alias("max"), F.col(f"na{k}").alias("null_count")) for k, c in enumerate(plain)])
    return df.agg(*agg).select(F.inline(each))


def preview(df: DataFrame, n: int = 5, order: Sequence[str] = ()) -> DataFrame:
    """The first n rows, by ``order`` if given, else any."""
    return (df.orderBy(*order) if order else df).limit(n)


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 100, seed: int = 42) -> DataFrame:
    """n rows by the hash of their keys: the same ones however the table is laid out."""
    return df.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)
