"""Column expressions: energy balance, units, weather, calendar, comparisons.  All run JVM-side."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.config import TIME, TO_KW

# Derived energy-balance columns as sums of signed inputs, in order of dependence.
BALANCE: tuple[tuple[str, tuple[tuple[int, str], ...]], ...] = (
    ("TerugleveringTotaalNetto", ((1, "ElektriciteitTerugleveringLaagDiff"), (1, "ElektriciteitTerugleveringHoogDiff"))),
    ("ElektriciteitsgebruikTotaalNetto", ((1, "ElektriciteitNetgebruikLaagDiff"), (1, "ElektriciteitNetgebruikHoogDiff"))),
    ("Netuitwisseling", ((1, "ElektriciteitsgebruikTotaalNetto"), (-1, "TerugleveringTotaalNetto"))),
    ("ElektriciteitsgebruikTotaalWarmtepomp", ((1, "ElektriciteitsgebruikWarmtepompDiff"), (1, "ElektriciteitsgebruikBoosterDiff"))),
    ("ElektriciteitsgebruikTotaalGebouwgebonden", ((1, "ElektriciteitsgebruikTotaalWarmtepomp"), (1, "ElektriciteitsgebruikBoilervatDiff"), (1, "ElektriciteitsgebruikWTWDiff"), (1, "ElektriciteitsgebruikRadiatorDiff"))),
    ("ElektriciteitsgebruikTotaalHuishoudelijk", ((1, "Netuitwisseling"), (1, "ZonopwekBruto"), (-1, "ElektriciteitsgebruikTotaalGebouwgebonden"))),
    ("Zelfgebruik", ((1, "ZonopwekBruto"), (-1, "TerugleveringTotaalNetto"))),
    ("ElektriciteitsgebruikTotaalBruto", ((1, "ElektriciteitsgebruikTotaalNetto"), (1, "Zelfgebruik"))),
)
SOLAR_IN, SOLAR_OUT = "Zon-opwekTotaalDiff", "ZonopwekBruto"


def calculated_columns(df: DataFrame, fillna: bool = True) -> DataFrame:
    """Adds the energy-balance columns; ``fillna`` counts missing inputs as 0, else they make nulls."""
    if SOLAR_IN in df.columns:
        df = df.withColumnRenamed(SOLAR_IN, SOLAR_OUT)
    known: dict[str, Column] = {}

    def value(name: str) -> Column:
        if name in known:
            return known[name]
        return F.coalesce(F.col(f"`{name}`"), F.lit(0.0)) if fillna else F.col(f"`{name}`")

    for name, parts in BALANCE:
        total: Column | None = None
        for sign, part in parts:
            term = value(part) if sign > 0 else -value(part)
            total = term if total is None else total + term
        known[name] = total
    return df.select("*", *[c.alias(n) for n, c in known.items()])


def to_kw(interval: str) -> float:
    """Factor from kWh per interval to kW."""
    if interval not in TO_KW:
        raise ValueError(f"unknown interval {interval!r}; use one of {', '.join(TO_KW)}")
    return TO_KW[interval]


def normalized_datetime(df: DataFrame, reference: datetime.date = datetime.date(2023, 1, 2), time: str = TIME) -> DataFrame:
    """Adds day_of_week (Monday 0), time_of_day and normalized_datetime, the moment within a reference week."""
    if dict(df.dtypes).get(time) not in ("timestamp", "timestamp_ntz"):
        raise TypeError(f"{time} must be a timestamp column")
    at = F.col(time)
    start = F.lit(datetime.datetime.combine(reference, datetime.time())).cast("timestamp_ntz")
    local = at.cast("timestamp_ntz")
    return df.select("*", F.date_format(at, "HH:mm:ss.SSSSSS").alias("time_of_day"), F.weekday(at).alias("day_of_week"), (start + F.make_dt_interval(F.weekday(at)) + (local - F.date_trunc("day", local).cast("timestamp_ntz"))).alias("normalized_datetime"))


def vapour_pressure(temperature: Column, humidity: Column) -> Column:
    return humidity * 6.105 * F.exp(F.try_divide(17.27 * temperature, temperature + 237.7)) / 100


def apparent_temperature(temperature: Column, humidity: Column, wind: Column) -> Column:
    """Felt temperature of air temperature (degrees C), relative humidity (%) and wind (m/s)."""
    return temperature + 0.33 * vapour_pressure(temperature, humidity) - 0.7 * wind - 4.0


def significant(x: Column, digits: int) -> Column:
    """Rounded to significant figures, halves to even; 0 stays 0."""
    scale = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(F.abs(F.when(x != 0, x)))))
    return F.when(x == 0, 0.0).otherwise(F.rint(x * scale) / scale)


def equal_sig_fig(a: Column, b: Column, digits: int) -> Column:
    """Whether both agree to ``digits`` significant figures, within a relative 10^-digits."""
    x, y = significant(a, digits), significant(b, digits)
    return F.abs(x - y) <= F.lit(10.0**-digits) * F.greatest(F.abs(x), F.abs(y))


def station_hour(time: Column) -> tuple[Column, Column]:
    """Date as yyyyMMdd and hour of the weather observation, 1 to 24, that a reading belongs to."""
    return F.date_format(time, "yyyyMMdd").cast("int"), F.hour(time) + 1
