"""Hourly weather station files and the project-to-station table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.config import EngineConfig
from gridloom.functions.scalar import apparent_temperature, vapour_pressure


def read_weather(spark: SparkSession, folder: str) -> DataFrame:
    """All *.txt files of a folder: comment lines, the last of which names the columns, then padded CSV.

    Files may order their columns differently: each file's header is found in one scan of the comment
    lines, and files with the same header are read together.  Blank fields are null.
    """
    lines = spark.read.option("pathGlobFilter", "*.txt").text(folder)
    path = F.col("_metadata.file_path")
    last = lines.select(path.alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("line"), "value").filter(F.col("value").startswith("#"))
    # one row per file reaches the driver
    headers = last.groupBy("path").agg(F.max_by("value", F.struct("at", "line")).alias("header")).groupBy("header").agg(F.collect_list("path").alias("paths")).collect()
    if not headers:
        raise ValueError(f"no weather file with a header in {folder}")
    out: DataFrame | None = None
    for header, paths in headers:
        names = [c.strip() for c in header.lstrip("#").split(",")]
        schema = ", ".join(f"`{c}` string" for c in names)
        raw = spark.read.schema(schema).option("comment", "#").option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(sorted(paths))
        out = raw if out is None else out.unionByName(raw, allowMissingColumns=True)
    typed = out.select(*[F.expr(f"try_cast(nullif(trim(`{c}`), '') as {'int' if c in ('STN', 'YYYYMMDD', 'HH') else 'double'})").alias(c) for c in out.columns])
    return with_units(typed)


def with_units(raw: DataFrame) -> DataFrame:
    """Temperature, wind, humidity, vapour pressure and felt temperature from T, FH and U."""
    t, wind, humid = F.col("T") / 10, F.col("FH") / 10, F.col("U").cast("double")
    return raw.withColumns({"Temperatuur": t, "Windsnelheid": wind, "Vochtigheid": humid, "Dampdruk": vapour_pressure(t, humid), "Gevoelstemperatuur": apparent_temperature(t, humid, wind)})


def weather_data(spark: SparkSession, config: EngineConfig) -> DataFrame:
    if not config.weather_data_folder_path:
        raise ValueError("weather_data_folder_path is not set")
    return read_weather(spark, config.weather_data_folder_path)


def read_stations(spark: SparkSession, config: EngineConfig) -> DataFrame:
    """Project, station name in capitals, station number; from Parquet, CSV or a workbook's sheet."""
    path = config.weather_stations_summary_file
    if not path:
        raise ValueError("weather_stations_summary_file is not set")
    if path.endswith((".xlsx", ".xls")):
        import pandas as pd

        df = spark.createDataFrame(pd.read_excel(path, sheet_name="ProjectWeatherStation"))
    elif path.endswith(".csv"):
        df = spark.read.csv(path, header=True)
    else:
        df = spark.read.parquet(path)
    return df.withColumns({"Weerstation": F.upper("Weerstation"), "STN": F.col("Nummer").cast("int"), "ProjectIdBSV": F.col("ProjectIdBSV").cast("long")})
