"""Bundles of lazy tables with metadata and weather, and a report on missing weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.config import PROJECT, TIME, EngineConfig
from gridloom.operators.joins import WEATHER_COLUMNS, exclude_project, join_index, join_station, join_weather
from gridloom.operators.weather import weather_table
from gridloom.sources import tables
from gridloom.sources.weather import read_stations, weather_data


def _weather(spark: SparkSession, config: EngineConfig) -> tuple[DataFrame, DataFrame]:
    return weather_table(weather_data(spark, config)), read_stations(spark, config)


def household_tables(spark: SparkSession, config: EngineConfig, include_weather: bool = True, intervals: tuple[str, ...] = ("5min", "15min", "60min", "24h", "calculated")) -> dict[str, DataFrame]:
    index = tables.read_index(spark, config)
    out = {i: join_index(tables.read_households(spark, config, i), index) for i in intervals}
    if include_weather:
        weather, stations = _weather(spark, config)
        out = {i: join_weather(join_station(df, stations), weather, columns=WEATHER_COLUMNS) for i, df in out.items()}
        out["weather"] = weather
    return out


def project_tables(spark: SparkSession, config: EngineConfig, include_weather: bool = True, intervals: tuple[str, ...] = ("5min", "15min", "60min", "24h")) -> dict[str, DataFrame]:
    out = {i: exclude_project(tables.read_aggregate(spark, config, "project", i), config.excluded_project) for i in intervals}
    if include_weather:
        weather, stations = _weather(spark, config)
        out = {i: join_weather(join_station(df, stations), weather, columns=WEATHER_COLUMNS) for i, df in out.items()}
        out |= {"weather": weather, "project_weather": stations}
    return out


def missing_weather(df: DataFrame, column: str = "Temperatuur", time: str = TIME) -> DataFrame:
    """One row: readings without ``column``, their share, projects and first dates."""
    missing = F.col(column).isNull()
    return df.agg(
        F.count(F.when(missing, 1)).alias("missing"),
        F.count("*").alias("total"),
        (F.count(F.when(missing, 1)) * 100.0 / F.greatest(F.count("*"), F.lit(1))).alias("percent"),
        F.array_sort(F.collect_set(F.when(missing, F.col(PROJECT)))).alias("projects"),
        F.min(F.when(missing, F.to_date(time))).alias("first_date"),
        F.max(F.when(missing, F.to_date(time))).alias("last_date"),
    )
