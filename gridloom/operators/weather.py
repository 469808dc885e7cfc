"""Hourly weather with rolling means, coldest periods and coldest ISO weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.operators.periods import mark_coldest, rolling_mean

HOURS = 14 * 24


def calendar(df: DataFrame) -> DataFrame:
    """Date, moment (hour 24 is midnight of the next day), year, ISO week and weekday of YYYYMMDD and HH."""
    day = F.to_date(F.col("YYYYMMDD").cast("string"), "yyyyMMdd")
    df = df.withColumn("date_column", day)
    return df.withColumns({"datetime_column": F.col("date_column").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("HH")), "year": F.year("date_column"), "week_of_year": F.weekofyear("date_column"), "day_of_week": F.weekday("date_column")})


def week_rank(temperature: str, year: str = "year") -> Column:
    """Rank of an hour's week, from 1, among those of its station and year; missing means come last, ties to the earlier week."""
    return F.dense_rank().over(Window.partitionBy("STN", year).orderBy(F.col(temperature).asc_nulls_last(), "week_of_year"))


def weather_table(hourly: DataFrame, hours: int = HOURS, iso_year: bool = False) -> DataFrame:
    """The weather table of hourly station data (STN, YYYYMMDD, HH, Temperatuur, Gevoelstemperatuur).

    Weeks are grouped by calendar year and ISO week, so the last days of December may join the week of
    January; ``iso_year`` groups them by the year their week belongs to.
    """
    w = Window.partitionBy("STN").orderBy("YYYYMMDD", "HH")
    df = hourly.withColumns({f"{c}RA": rolling_mean(F.col(c), w, hours) for c in ("Temperatuur", "Gevoelstemperatuur")})
    for c in ("Temperatuur", "Gevoelstemperatuur"):
        df = mark_coldest(df, ["STN"], f"{c}RA", hours, out=f"Koudste2Wk{c}")
    df = calendar(df)
    if iso_year:
        df = df.withColumn("year", F.extract(F.lit("YEAROFWEEK"), "date_column"))
    # windows within a station share one exchange; no join of the table with its own weeks
    week, dated = Window.partitionBy("STN", "year", "week_of_year"), F.col("date_column").isNotNull()
    weekly = {f"{c}ISOWk": F.when(dated, F.avg(c).over(week)) for c in ("Temperatuur", "Gevoelstemperatuur")}
    df = df.withColumns(weekly | {"days_in_week": F.when(dated, F.round(F.count("date_column").over(week) / 24.0)).cast("int")})
    return df.withColumns({f"Koudste2ISOWk{c}": F.when(dated, week_rank(f"{c}ISOWk") <= 2) for c in ("Temperatuur", "Gevoelstemperatuur")})
