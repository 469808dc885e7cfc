"""Joins of series with household metadata, weather stations and weather.

The dimensions carry no broadcast hint: the planner broadcasts a side whose size in bytes it knows to be
below ``spark.sql.autoBroadcastJoinThreshold``, at run time too, and shuffles otherwise.  No job runs while
a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.config import HOUSE, PROJECT, TIME
from gridloom.functions.scalar import station_hour

def add_index_columns(df: DataFrame, index: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Metadata columns by household; none asked for, none added."""
    if not columns:
        return df
    return df.join(index.select(HOUSE, PROJECT, *[c for c in columns if c not in (HOUSE, PROJECT)]), [HOUSE, PROJECT], "left")


def join_index(df: DataFrame, index: DataFrame, on: Sequence[str] = (HOUSE, PROJECT)) -> DataFrame:
    """All metadata by household; columns that clash get the suffix _right."""
    clash = {c: f"{c}_right" for c in index.columns if c in df.columns and c not in on}
    return df.join(index.withColumnsRenamed(clash), list(on), "left")


def without_right(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if "_right" not in c])


def join_station(df: DataFrame, stations: DataFrame, on: str = PROJECT) -> DataFrame:
    """Weather station of each project; earlier station columns are replaced."""
    names = [c for c in ("Weerstation", "STN") if c in stations.columns]
    return df.drop(*names).join(stations.select(on, *names), on, "left")


# The weather columns that table bundles hold beside the keys.
WEATHER_COLUMNS = ("Temperatuur", "Gevoelstemperatuur", "Vochtigheid", "Windsnelheid", "TemperatuurRA", "GevoelstemperatuurRA", "Koudste2WkTemperatuur", "Koudste2WkGevoelstemperatuur")


def join_weather(df: DataFrame, weather: DataFrame, time: str = TIME, columns: Sequence[str] | None = None) -> DataFrame:
    """Weather of each reading's station, date and hour (hours are numbered 1 to 24); all or some ``columns``."""
    if columns is not None:
        weather = weather.select("STN", "YYYYMMDD", "HH", *[c for c in columns if c in weather.columns])
    if "YYYYMMDD" not in df.columns:
        date, hour = station_hour(F.col(time))
        df = df.withColumns({"YYYYMMDD": date, "HH": hour})
    keys = ["STN", "YYYYMMDD", "HH"]
    clash = [c for c in weather.columns if c in df.columns and c not in keys]
    return df.join(weather.drop(*clash), keys, "left")


def exclude_project(df: DataFrame, project: int, column: str = PROJECT) -> DataFrame:
    """All other projects; a null project is neither and goes."""
    return df.filter(F.col(column) != project)
