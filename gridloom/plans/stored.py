"""Queries through sources, sinks and whole plans: tables are written to the shared folder, then read by the engine.

Five "households" (user_id % 5) of two projects hold the events; household 3 is not included.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.config import EngineConfig, Keys, Variable
from gridloom.functions import scalar
from gridloom.plans import pipelines
from gridloom.plans.registry import _FROM, _INPUTS, DAILY, IMPUTED, _balance_sql, _daily, _r, _read, _readings, query
from gridloom.plans.scratch import shared_folder
from gridloom.sources import bundles, tables
from gridloom.sources.weather import read_stations, read_weather

HOUSE_SQL = "user_id % 5 AS \"HuisIdBSV\", CAST(CASE WHEN user_id % 5 < 2 THEN 1 ELSE 2 END AS BIGINT) AS \"ProjectIdBSV\""


def _config(spark: SparkSession, name: str) -> EngineConfig:
    root = shared_folder(spark, name)
    return EngineConfig(f"{root}/mapped", f"{root}/aggregate")


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return _read(spark, sf, "events").select((F.col("user_id") % 5).alias("HuisIdBSV"), F.col("ts").cast("timestamp_ntz").alias("ReadingDate"), "event_id", "value")


def _mapped(spark: SparkSession, sf: str, name: str, house: str = "HuisIdBSV") -> EngineConfig:
    """Index and one file a household, as the engine expects them from the mapping step."""
    config = _config(spark, name)
    k = F.col("id")
    index = spark.range(5).select(k.alias(house), F.when(k < 2, 1).otherwise(2).cast("long").alias("ProjectIdBSV"), (k != 3).alias("Meenemen"), F.concat(F.lit("supplier "), k).alias("Dataleverancier"))
    tables.write_table(index, f"{config.mapped_folder_path}/index.parquet", None)
    for n in range(5):
        tables.write_table(_events(spark, sf).filter(F.col("HuisIdBSV") == n).drop("HuisIdBSV"), f"{config.mapped_folder_path}/household_{n}_table.parquet", None)
    return config


@query(f"SELECT {HOUSE_SQL}, event_id, ts AS \"ReadingDate\", value FROM events WHERE user_id % 5 <> 3")
def multi_file_union(spark, sf):
    return pipelines.combine(spark, _mapped(spark, sf, "union")).select("HuisIdBSV", "ProjectIdBSV", "event_id", "ReadingDate", "value")


@query(f"SELECT event_id, {HOUSE_SQL}, 'supplier ' || (user_id % 5) AS \"Dataleverancier\" FROM events WHERE user_id % 5 <> 3")
def household_scan_metadata(spark, sf):
    """The stored household table with a metadata column, from an index with the old name of the household column."""
    config = _mapped(spark, sf, "metadata", "HuisCode")
    pipelines.combine(spark, config)
    return tables.read_households(spark, config, metadata=["Dataleverancier"]).select("event_id", "HuisIdBSV", "ProjectIdBSV", "Dataleverancier")


@query(f"WITH {DAILY} SELECT project AS \"ProjectIdBSV\", house AS \"HuisIdBSV\", ts AS \"ReadingDate\", round(value, 6) AS value FROM daily")
def resample_plan(spark, sf):
    """Daily household tables, stored and read back."""
    config = _config(spark, "resample")
    df = _read(spark, sf, "events").select((F.col("user_id") % 5).alias("ProjectIdBSV"), F.col("user_id").alias("HuisIdBSV"), F.col("ts").cast("timestamp_ntz").alias("ReadingDate"), "value")
    pipelines.resample_households(spark, config, ["24h"], {"value": Variable()}, df, min_count=2)
    return tables.read_households(spark, config, "24h").select(F.col("ProjectIdBSV").cast("long").alias("ProjectIdBSV"), "HuisIdBSV", "ReadingDate", *_r("value"))


@query(f"WITH {DAILY} SELECT project AS \"ProjectIdBSV\", ts AS \"ReadingDate\", round(CASE WHEN count(value) >= 0.6 * count(*) THEN avg(value) END, 6) AS value, count(*) AS n FROM daily GROUP BY 1, 2")
def aggregate_plan(spark, sf):
    """Stored daily households, aggregated to projects; the stored result read back."""
    config = _config(spark, "aggregate")
    daily = _daily(spark, sf).withColumnsRenamed({"project": "ProjectIdBSV", "house": "HuisIdBSV", "ts": "ReadingDate"})
    tables.write_table(daily, f"{config.aggregate_folder_path}/household_24h.parquet")
    pipelines.aggregate_projects(spark, config, ["24h"], {"value": Variable()})
    return tables.read_aggregate(spark, config, "project", "24h").select(F.col("ProjectIdBSV").cast("long").alias("ProjectIdBSV"), "ReadingDate", *_r("value"), "n")


@query(_balance_sql(True))
def calculated_plan(spark, sf):
    """The balance of a stored imputed table, stored and read back."""
    config = _config(spark, "calculated")
    df = _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[F.expr(s).alias(n) for n, s in zip(_INPUTS, _FROM, strict=True)])
    tables.write_table(df, f"{config.aggregate_folder_path}/household_imputed.parquet", None)
    done = pipelines.calculate(spark, config)
    return done.select("l_orderkey", "l_linenumber", *[(F.round(n, 4) + 0.0).alias(n) for n, _ in scalar.BALANCE])


# wide imputation

METERS = {"a": 7, "b": 5, "c": 11}
"""Meters, and which share of their increments is missing."""
DAY = "CASE WHEN event_id % 250 = 0 THEN NULL ELSE date_trunc('day', ts) END"
WIDE = ("Original", "OldDiff", "Diff", "Diff_impute_type", "Diff_is_imputed")


def _meter_sql(name: str, k: int) -> str:
    """The imputation of one meter whose readings are known by day: many of a household at one moment, some at none."""
    sql = IMPUTED.replace("event_id % 7", f"event_id % {k}").replace("date_trunc('day', ts) AS day FROM ev)", f"{DAY} AS day FROM ev)")
    sql = sql.replace("PARTITION BY house ORDER BY ts, event_id", f"PARTITION BY house ORDER BY {DAY} NULLS FIRST, event_id")
    sql = sql.replace("ORDER BY ts, event_id", "ORDER BY day NULLS FIRST, event_id").replace("ORDER BY r.ts, r.event_id", "ORDER BY r.day NULLS FIRST, r.event_id")
    return f"(WITH {sql} SELECT event_id, cum AS original, diff AS old_diff, round(new_diff, 6) AS diff, kind, kind IS NOT NULL AS is_imputed FROM imp) {name}"


def _meters(spark: SparkSession, sf: str) -> DataFrame:
    df = _readings(spark, sf).select("event_id", "house", "project", "event_type", "cents", F.expr("CASE WHEN event_id % 250 <> 0 THEN day END").alias("day"))
    upto = Window.partitionBy("house").orderBy("day", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("total", F.sum(F.when(F.col("event_id") % 97 == 0, -50 * F.col("cents")).otherwise(F.col("cents"))).over(upto))
    for name, k in METERS.items():
        turn = F.col("event_id") % k
        df = df.withColumns({name: F.when(turn != 1, F.col("total") / 100.0), f"{name}Diff": F.when(~turn.isin(0, 1), F.col("cents") / 100.0)})
    return df.drop("total", "cents")


def _wide_sql() -> str:
    columns = [f"{m}.{x} AS \"{m}{c}\"" for m in METERS for c, x in zip(WIDE, ("original", "old_diff", "diff", "kind", "is_imputed"), strict=True)]
    return f"SELECT e.event_id, e.event_type, {', '.join(columns)} FROM events e " + " ".join(f"JOIN {_meter_sql(m, k)} ON e.event_id = {m}.event_id" for m, k in METERS.items())


@query(_wide_sql())
def wide_imputation(spark, sf):
    """Three meters imputed together, stored and read back; the event type comes along."""
    config = _config(spark, "imputation")
    pipelines.write_imputation(pipelines.impute_households(_meters(spark, sf), list(METERS), keys=Keys("project", "house", "day", ("event_id",)), config=config), config)
    df = tables.read_households(spark, config, "imputed")

    def plain(name: str) -> Column:
        x = F.col(name)
        return (x.cast("int") if name.endswith("type") else F.round(x, 6) if name.endswith("Diff") and not name.endswith("OldDiff") else x).alias(name)

    return df.select("event_id", "event_type", *[plain(f"{m}{c}") for m in METERS for c in WIDE])


# weather files and bundles


def _station_files(spark: SparkSession, sf: str, root: str) -> None:
    """Two text files with other column orders, of figures that stand for the weather of two stations."""
    date = F.date_format("ReadingDate", "yyyyMMdd").cast("int")
    station = (F.lit(200) + F.col("event_id") % 2).alias("STN")
    hourly = _events(spark, sf).groupBy(station, date.alias("YYYYMMDD"), (F.hour("ReadingDate") + 1).alias("HH")).agg(F.count("*").alias("FH"), F.sum(F.col("event_id") % 100).alias("T"), (F.max(F.col("event_id") % 90) + 5).alias("U"))
    for k, order in ((200, ("FH", "T", "U")), (201, ("U", "T", "FH"))):
        cells = [F.lpad(F.col(c).cast("string"), 6, " ") for c in ("STN", "YYYYMMDD", "HH", *order)]
        cells[1] = F.col("YYYYMMDD").cast("string")
        body = hourly.filter(F.col("STN") == k).select(F.lit(2).alias("n"), F.concat_ws(",", *cells).alias("value"))
        head = spark.createDataFrame([(0, "# source"), (1, f"# STN,YYYYMMDD,   HH, {', '.join(order)}")], "n int, value string")
        head.union(body).coalesce(1).sortWithinPartitions("n").select("value").write.text(f"{root}/{k}")


HOURS = "h AS (SELECT CAST(200 + event_id % 2 AS INTEGER) AS \"STN\", CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS \"YYYYMMDD\", CAST(hour(ts) + 1 AS INTEGER) AS \"HH\", CAST(count(*) AS DOUBLE) / 10 AS w, CAST(sum(event_id % 100) AS DOUBLE) / 10 AS t, CAST(max(event_id % 90) + 5 AS DOUBLE) AS u FROM events GROUP BY 1, 2, 3)"


@query(f"WITH {HOURS} SELECT \"STN\", \"YYYYMMDD\", \"HH\", t AS \"Temperatuur\", w AS \"Windsnelheid\", u AS \"Vochtigheid\", round(t + 0.33 * (u * 6.105 * exp(17.27 * t / (t + 237.7)) / 100) - 0.7 * w - 4.0, 7) AS \"Gevoelstemperatuur\" FROM h")
def weather_text_scan(spark, sf):
    root = shared_folder(spark, "weather")
    _station_files(spark, sf, root)
    return read_weather(spark, f"{root}/*").select("STN", "YYYYMMDD", "HH", "Temperatuur", "Windsnelheid", "Vochtigheid", F.round("Gevoelstemperatuur", 7).alias("Gevoelstemperatuur"))


def _stations(spark: SparkSession, sf: str, root: str) -> str:
    n = _read(spark, sf, "nation").select(F.col("n_nationkey").alias("ProjectIdBSV"), F.lower("n_name").alias("Weerstation"), (F.lit(200) + F.col("n_nationkey") % 2).cast("int").alias("Nummer"))
    tables.write_table(n, f"{root}/stations.parquet", None)
    return f"{root}/stations.parquet"


@query("SELECT n_nationkey AS \"ProjectIdBSV\", n_name AS \"Weerstation\", CAST(200 + n_nationkey % 2 AS INTEGER) AS \"STN\" FROM nation")
def station_scan(spark, sf):
    config = EngineConfig(weather_stations_summary_file=_stations(spark, sf, shared_folder(spark, "stations")))
    return read_stations(spark, config).select("ProjectIdBSV", "Weerstation", "STN")


def _with_weather(spark: SparkSession, sf: str, config: EngineConfig) -> EngineConfig:
    root = config.mapped_folder_path.rpartition("/")[0]
    _station_files(spark, sf, f"{root}/weather")
    return replace(config, weather_data_folder_path=f"{root}/weather/*", weather_stations_summary_file=_stations(spark, sf, root))


AT = "h.\"STN\" = 200 + r.\"ProjectIdBSV\" % 2 AND h.\"YYYYMMDD\" = CAST(strftime(r.ts, '%Y%m%d') AS INTEGER) AND h.\"HH\" = hour(r.ts) + 1"


@query(f"WITH {HOURS}, r AS (SELECT event_id, ts, user_id, {HOUSE_SQL} FROM events WHERE user_id % 5 <> 3) SELECT r.event_id, r.\"ProjectIdBSV\", 'supplier ' || (r.user_id % 5) AS \"Dataleverancier\", n_name AS \"Weerstation\", h.t AS \"Temperatuur\" FROM r JOIN nation ON n_nationkey = r.\"ProjectIdBSV\" LEFT JOIN h ON {AT}")
def household_bundle(spark, sf):
    config = _with_weather(spark, sf, _mapped(spark, sf, "bundle"))
    pipelines.combine(spark, config)
    df = bundles.household_tables(spark, config, intervals=("default",))["default"]
    return df.select("event_id", F.col("ProjectIdBSV").cast("long").alias("ProjectIdBSV"), "Dataleverancier", "Weerstation", "Temperatuur")


@query(f"WITH {HOURS}, r AS (SELECT user_id % 7 AS \"ProjectIdBSV\", date_trunc('hour', ts) AS ts, count(*) AS n FROM events WHERE user_id % 7 <> 6 GROUP BY 1, 2) SELECT r.\"ProjectIdBSV\", r.ts AS \"ReadingDate\", n, h.t AS \"Temperatuur\", h.w AS \"Windsnelheid\" FROM r LEFT JOIN h ON {AT}")
def project_bundle(spark, sf):
    """Hourly project tables with weather; the configured project, number 6, is left out."""
    config = _with_weather(spark, sf, _config(spark, "projects"))
    hourly = _read(spark, sf, "events").groupBy((F.col("user_id") % 7).alias("ProjectIdBSV"), F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ReadingDate")).agg(F.count("*").alias("n"))
    tables.write_table(hourly, f"{config.aggregate_folder_path}/project_60min.parquet")
    df = bundles.project_tables(spark, config, intervals=("60min",))["60min"]
    return df.select(F.col("ProjectIdBSV").cast("long").alias("ProjectIdBSV"), "ReadingDate", "n", "Temperatuur", "Windsnelheid")
