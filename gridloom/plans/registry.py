"""Queries over the TPC-H-like test tables that exercise each operator, with DuckDB equivalents.

``events`` stands for meter readings: user_id is the household, user_id % 5 its project, value the
increment.  Gaps, a cumulative meter and its resets are made from event_id, alike on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.config import FULL_BIN, Keys, Variable, minutes
from gridloom.functions import scalar
from gridloom.operators import averages, impute, joins, periods, stats, weather
from gridloom.operators.resample import aggregate, mean_diffs, resample
from gridloom.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
K = Keys("project", "house", "ts", ("event_id",))
D = Keys("project", "house", "day")
LIMITS = {"xDiff": (0.5, 150.0)}


def query(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(*names: str) -> list[Column]:
    """Doubles to six digits, as sums depend on their order beyond that."""
    return [F.round(F.col(n), 6).alias(n) for n in names]


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("user_id").alias("house"), (F.col("user_id") % 5).alias("project"), "event_type", "value", F.round(F.col("value") * 100).cast("long").alias("cents"))
    w = Window.partitionBy("house").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    turn = F.col("event_id") % 7
    total = F.sum(F.when(F.col("event_id") % 97 == 0, -50 * F.col("cents")).otherwise(F.col("cents"))).over(w)
    return ev.select("*", F.when(~turn.isin(0, 1), F.col("cents") / 100.0).alias("diff"), F.when(turn != 1, total / 100.0).alias("cum"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense daily household sums of at least two readings."""
    df = _read(spark, sf_dir, "events").select(F.col("user_id").alias("house"), (F.col("user_id") % 5).alias("project"), F.col("ts").cast("timestamp_ntz").alias("ts"), "value")
    return resample(df, {"value": Variable("sum")}, "24h", Keys("project", "house", "ts"), min_count=2)


def _with_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _readings(spark, sf_dir).withColumn("xDiff", F.col("diff"))
    means = averages.trimmed_averages(df, ["xDiff"], D).withColumnRenamed("xDiff_avg", "avg")
    return df.drop("xDiff").join(means, ["project", "day"], "left").withColumn("column", F.lit("xDiff"))


def _imputed(spark: SparkSession, sf_dir: str, thresholds: dict | None = None) -> DataFrame:
    long = _with_average(spark, sf_dir).select("project", "house", "ts", "event_id", "day", "column", "cum", "diff", "avg")
    return impute.impute_long(long, K, thresholds=thresholds)


READINGS = """
ev AS (SELECT event_id, ts, user_id AS house, user_id % 5 AS project, event_type, value, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
readings AS (SELECT *, CASE WHEN event_id % 7 NOT IN (0, 1) THEN CAST(cents AS DOUBLE) / 100 END AS diff,
  CASE WHEN event_id % 7 <> 1 THEN CAST(sum(CASE WHEN event_id % 97 = 0 THEN -50 * cents ELSE cents END) OVER (PARTITION BY house ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) / 100 END AS cum,
  date_trunc('day', ts) AS day FROM ev)"""
TRIMMED = (
    READINGS
    + """,
hm AS (SELECT project, house, max(diff) AS m FROM readings GROUP BY 1, 2),
ub AS (SELECT project, 2 * quantile_cont(CASE WHEN m > 1e-8 THEN m END, 0.95) AS ub FROM hm GROUP BY 1),
means AS (SELECT r.project, r.day, avg(CASE WHEN hm.m < ub.ub THEN r.diff END) AS mean FROM readings r JOIN hm ON r.project = hm.project AND r.house = hm.house JOIN ub ON r.project = ub.project GROUP BY 1, 2)"""
)
GAPS = (
    TRIMMED
    + """,
g0 AS (SELECT r.*, m.mean, r.diff IS NULL AS na, coalesce(lag(r.diff IS NULL) OVER w, false) AS lag_na, lag(r.cum) OVER w AS lag_cum, coalesce(lag(r.diff IS NULL AND r.cum IS NOT NULL) OVER w, false) AS lag_seen
  FROM readings r LEFT JOIN means m ON r.project = m.project AND r.day = m.day WINDOW w AS (PARTITION BY r.project, r.house ORDER BY r.ts, r.event_id)),
g1 AS (SELECT *, CASE WHEN na THEN sum(CASE WHEN (na AND NOT lag_na) OR lag_seen THEN 1 ELSE 0 END) OVER (PARTITION BY project, house ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) END AS grp FROM g0),
g2 AS (SELECT *, CASE WHEN grp IS NOT NULL THEN count(*) OVER p END AS gap_length, first_value(lag_cum) OVER (PARTITION BY project, house, grp ORDER BY ts, event_id) AS prev0, max(cum) OVER p AS end0, sum(coalesce(mean, 0)) OVER p AS impute_jump,
  sum(CASE WHEN mean IS NOT NULL AND diff >= 0 THEN mean END) OVER h AS s_avg, sum(CASE WHEN mean IS NOT NULL AND diff >= 0 THEN diff END) OVER h AS s_diff, count(CASE WHEN mean IS NOT NULL AND diff >= 0 THEN 1 END) OVER h AS n_cmp, count(*) OVER h AS n_all
  FROM g1 WINDOW p AS (PARTITION BY project, house, grp), h AS (PARTITION BY project, house))"""
)
IMPUTED = (
    GAPS
    + """,
g3 AS (SELECT *, CASE WHEN prev0 >= 0 THEN prev0 END AS prev, CASE WHEN end0 >= 0 THEN end0 END AS endv, CASE WHEN n_cmp > n_all / 2.0 AND s_diff <> 0 AND s_avg IS NOT NULL THEN s_avg / s_diff ELSE 1.0 END AS factor FROM g2),
g4 AS (SELECT *, CASE WHEN grp IS NULL THEN NULL
   WHEN endv - prev < 0 THEN 1 WHEN endv - prev < 1e-8 THEN 2 WHEN endv - prev >= 1e-8 AND impute_jump < 1e-8 THEN 4 WHEN endv - prev >= 1e-8 THEN 8
   WHEN prev IS NULL AND endv < 1e-8 THEN 16 WHEN prev IS NULL AND endv > 1e-8 THEN 32 WHEN prev IS NOT NULL AND endv IS NULL THEN 64 END AS kind FROM g3),
imp AS (SELECT *, CASE kind WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 4 THEN (endv - prev) / gap_length WHEN 8 THEN coalesce(mean, 0) * (endv - prev) / impute_jump WHEN 16 THEN 0 WHEN 32 THEN coalesce(mean, 0) WHEN 64 THEN coalesce(mean, 0) * factor ELSE diff END AS new_diff FROM g4)"""
)
DAILY = """
b0 AS (SELECT user_id % 5 AS project, user_id AS house, date_trunc('day', ts) AS ts, CASE WHEN count(value) >= 2 THEN sum(value) END AS value FROM events GROUP BY 1, 2, 3),
sp AS (SELECT project, house, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM b0 GROUP BY 1, 2),
daily AS (SELECT sp.project, sp.house, sp.ts, b0.value FROM sp LEFT JOIN b0 ON sp.project = b0.project AND sp.house = b0.house AND sp.ts = b0.ts)"""


# scans, projections, joins


@query("SELECT c_custkey, c_nationkey, c_name FROM customer WHERE c_acctbal > 0")
def scan_filter_included(spark, sf):
    index = _read(spark, sf, "customer").withColumn("Meenemen", F.col("c_acctbal") > 0)
    return tables.select_columns(tables.included(index), ["c_custkey", "c_nationkey", "c_name"])


@query("SELECT e.event_id, e.user_id AS \"HuisIdBSV\", c.s_name AS \"Dataleverancier\" FROM events e LEFT JOIN supplier c ON e.user_id = c.s_suppkey AND e.user_id % 5 = c.s_suppkey % 5")  # fewer suppliers than users: some rows have no match
def metadata_join(spark, sf):
    ev = _read(spark, sf, "events").select("event_id", F.col("user_id").alias("HuisIdBSV"), (F.col("user_id") % 5).alias("ProjectIdBSV"))
    index = _read(spark, sf, "supplier").select(F.col("s_suppkey").alias("HuisIdBSV"), (F.col("s_suppkey") % 5).alias("ProjectIdBSV"), F.col("s_name").alias("Dataleverancier"))
    return joins.add_index_columns(ev, index, ["Dataleverancier"]).drop("ProjectIdBSV")


@query("SELECT e.event_id, e.user_id AS \"HuisIdBSV\", e.value, c.c_acctbal AS value_right FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey")
def index_join_suffix(spark, sf):
    ev = _read(spark, sf, "events").select("event_id", F.col("user_id").alias("HuisIdBSV"), "value")
    return joins.join_index(ev, _read(spark, sf, "customer").select(F.col("c_custkey").alias("HuisIdBSV"), F.col("c_acctbal").alias("value")), on=["HuisIdBSV"])


@query("SELECT event_id, user_id % 7 AS \"ProjectIdBSV\" FROM events WHERE user_id % 7 <> 6")
def exclude_project(spark, sf):
    return joins.exclude_project(_read(spark, sf, "events").select("event_id", (F.col("user_id") % 7).alias("ProjectIdBSV")), 6)


@query("SELECT n_nationkey AS \"ProjectIdBSV\", upper(n_name) AS \"Weerstation\", n_regionkey AS \"STN\" FROM nation")
def project_station(spark, sf):
    n = _read(spark, sf, "nation")
    stations = n.select(F.col("n_nationkey").alias("ProjectIdBSV"), F.upper("n_name").alias("Weerstation"), F.col("n_regionkey").alias("STN"))
    return joins.join_station(n.select(F.col("n_nationkey").alias("ProjectIdBSV"), F.lit("old").alias("Weerstation")), stations)


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS \"rows\", {t.format(f'min({c})')} AS \"min\", {t.format(f'max({c})')} AS \"max\", count(*) - count({c}) AS null_count FROM events" for c, t in (("event_id", "CAST({} AS VARCHAR)"), ("value", "CAST(CAST({} AS DECIMAL(18, 2)) AS VARCHAR)"), ("event_type", "{}"))))
def table_profile(spark, sf):
    df = tables.profile(_read(spark, sf, "events").select("event_id", F.col("value").cast("decimal(18,2)").alias("value"), "event_type"))
    return df.select("column", "rows", "min", "max", "null_count")


# time buckets and project aggregation


def _bucket_sql(method: str, least: int) -> str:
    return f"SELECT project, house, ts, round(value, 6) AS value FROM (WITH b0 AS (SELECT user_id % 5 AS project, user_id AS house, time_bucket(INTERVAL 6 HOUR, ts) AS ts, CASE WHEN count(value) >= {least} THEN {method}(value) END AS value FROM events GROUP BY 1, 2, 3), sp AS (SELECT project, house, unnest(generate_series(min(ts), max(ts), INTERVAL 6 HOUR)) AS ts FROM b0 GROUP BY 1, 2) SELECT sp.project, sp.house, sp.ts, b0.value FROM sp LEFT JOIN b0 ON sp.project = b0.project AND sp.house = b0.house AND sp.ts = b0.ts)"


def _bucket(spark: SparkSession, sf: str, method: str) -> DataFrame:
    df = _read(spark, sf, "events").select(F.col("user_id").alias("house"), (F.col("user_id") % 5).alias("project"), F.col("ts").cast("timestamp_ntz").alias("ts"), "value")
    return resample(df, {"value": Variable(method)}, "6h", Keys("project", "house", "ts"), min_count=2).select("project", "house", "ts", *_r("value"))


@query(_bucket_sql("sum", 2))
def resample_sum_min_count(spark, sf):
    return _bucket(spark, sf, "sum")


@query(_bucket_sql("max", 2))
def resample_max_min_count(spark, sf):
    return _bucket(spark, sf, "max")


@query(_bucket_sql("avg", 2))
def resample_avg_min_count(spark, sf):
    return _bucket(spark, sf, "avg")


@query(f"WITH {DAILY} SELECT project, house, ts, round(value, 6) AS value FROM daily")
def resample_spine(spark, sf):
    return _daily(spark, sf).select("project", "house", "ts", *_r("value"))


@query("WITH v AS (SELECT user_id AS house, date_trunc('day', ts) AS ts, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events), b AS (SELECT house, ts, CASE WHEN count(value) >= 1 THEN sum(value) END AS value FROM v GROUP BY 1, 2), sp AS (SELECT house, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM b GROUP BY 1) SELECT sp.house, sp.ts, round(b.value, 6) AS value FROM sp LEFT JOIN b ON sp.house = b.house AND sp.ts = b.ts")
def resample_validated(spark, sf):
    df = _read(spark, sf, "events").select(F.col("user_id").alias("house"), F.col("ts").cast("timestamp_ntz").alias("ts"), "value", (F.col("event_type") != "error").alias("valid"))
    return resample(df, {"value": Variable("sum", validator="valid")}, "24h", Keys("house", "house", "ts"), group=["house"], min_count=1).select("house", "ts", *_r("value"))


@query("SELECT user_id AS house, ts, value FROM events")
def resample_5min_projection(spark, sf):
    df = _read(spark, sf, "events").select(F.col("user_id").alias("house"), F.col("ts").cast("timestamp_ntz").alias("ts"), "value", "props")
    return resample(df, {"value": Variable()}, "5min", Keys("house", "house", "ts"), group=["house"])


def _presence_sql(method: str) -> str:
    return f"WITH {DAILY} SELECT project, ts, round(CASE WHEN count(value) >= 0.6 * count(*) THEN {method}(value) END, 6) AS value, count(*) AS n FROM daily GROUP BY 1, 2"


def _presence(spark: SparkSession, sf: str, method: str) -> DataFrame:
    return aggregate(_daily(spark, sf), {"value": Variable(aggregate=method)}, ["project"], "ts").select("project", "ts", *_r("value"), "n")


@query(_presence_sql("avg"))
def project_avg_60pct(spark, sf):
    return _presence(spark, sf, "avg")


@query(_presence_sql("sum"))
def project_sum_60pct(spark, sf):
    return _presence(spark, sf, "sum")


@query(_presence_sql("max"))
def project_max_60pct(spark, sf):
    return _presence(spark, sf, "max")


@query(f"WITH {DAILY}, a AS (SELECT project, ts, CASE WHEN count(value) >= 0.6 * count(*) THEN avg(value) END AS d, count(*) AS n FROM daily GROUP BY 1, 2) SELECT project, ts, round(d, 6) AS \"valueDiff\", n, round(CASE WHEN d IS NOT NULL THEN sum(d) OVER (PARTITION BY project ORDER BY ts ROWS UNBOUNDED PRECEDING) END, 5) AS value FROM a")
def project_diff_cumsum(spark, sf):
    df = _daily(spark, sf).withColumnRenamed("value", "valueDiff")
    return aggregate(df, {"value": Variable(aggregate="diff_cumsum")}, ["project"], "ts").select("project", "ts", *_r("valueDiff"), "n", F.round("value", 5).alias("value"))


@query(f"WITH {READINGS} SELECT project, day, round(avg(diff), 6) AS diff FROM readings GROUP BY 1, 2")
def project_mean_diff(spark, sf):
    return mean_diffs(_readings(spark, sf), ["diff"], D).select("project", "day", *_r("diff"))


# trimmed averages


@query(f"WITH {TRIMMED} SELECT hm.project, hm.house, hm.m AS \"xDiff_huis_max\", round(ub.ub, 6) AS \"xDiff_upper_bound\" FROM hm JOIN ub ON hm.project = ub.project")
def household_max_bounds(spark, sf):
    df = _readings(spark, sf).withColumnRenamed("diff", "xDiff")
    return averages.household_bounds(df, ["xDiff"], D).select("project", "house", "xDiff_huis_max", *_r("xDiff_upper_bound"))


@query(f"WITH {TRIMMED} SELECT project, day, round(mean, 6) AS \"xDiff_avg\" FROM means")
def trimmed_avg_diff(spark, sf):
    return averages.trimmed_averages(_readings(spark, sf).withColumnRenamed("diff", "xDiff"), ["xDiff"], D).select("project", "day", *_r("xDiff_avg"))


# imputation


@query(f"WITH {GAPS} SELECT event_id, project, house, CAST(grp AS BIGINT) AS grp, gap_length FROM g2")
def gap_groups(spark, sf):
    return impute.gap_groups(_with_average(spark, sf), K).select("event_id", "project", "house", "grp", "gap_length")


@query(f"WITH {IMPUTED} SELECT event_id, round(factor, 6) AS house_impute_factor FROM g3")
def house_impute_factor(spark, sf):
    return impute.house_factor(_with_average(spark, sf), K).select("event_id", *_r("house_impute_factor"))


@query(f"WITH {IMPUTED} SELECT event_id, project, house, round(new_diff, 6) AS diff, kind AS impute_type, kind IS NOT NULL AS is_imputed FROM imp")
def impute_cases(spark, sf):
    return _imputed(spark, sf).select("event_id", "project", "house", *_r("diff"), F.col("impute_type").cast("int").alias("impute_type"), "is_imputed")


@query(f"WITH {IMPUTED}, t AS (SELECT *, coalesce(new_diff < 0.5 OR new_diff > 150, false) AS beyond FROM imp) SELECT event_id, round(CASE WHEN beyond THEN mean ELSE new_diff END, 6) AS diff, CASE WHEN beyond THEN coalesce(kind, 0) | 128 ELSE kind END AS impute_type, beyond OR kind IS NOT NULL AS is_imputed FROM t")
def impute_thresholds(spark, sf):
    return _imputed(spark, sf, LIMITS).select("event_id", *_r("diff"), F.col("impute_type").cast("int").alias("impute_type"), "is_imputed")


@query(f"WITH {IMPUTED}, c AS (SELECT event_id, project, house, ts, cum AS original, CASE WHEN new_diff IS NOT NULL THEN sum(new_diff) OVER (PARTITION BY project, house ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) END AS cum FROM imp) SELECT event_id, round(cum, 4) AS cum, original, round(cum - original - lag(cum - original) OVER (PARTITION BY project, house ORDER BY ts, event_id), 4) + 0.0 AS \"check\" FROM c")
def reconstruct_cumulative(spark, sf):
    df = impute.reconstruct_long(_imputed(spark, sf), K)
    return df.select("event_id", F.round("cum", 4).alias("cum"), "original", (F.round("check", 4) + 0.0).alias("check"))


STATS = f"WITH {IMPUTED}, st AS (SELECT project, house, sum(new_diff) AS total, max(cum) - min(cum) AS span, count(gap_length) AS missing, count(kind) AS imputed, coalesce(bit_or(kind), 0) AS method_flags, bit_or(CASE WHEN kind <= 32 THEN CAST(1 AS BIGINT) << (kind - 1) END) AS mask, count(*) AS n FROM imp GROUP BY 1, 2)"


@query(f"{STATS} SELECT project, house, round(total, 4) AS diff_col_total, round(span, 4) AS cum_col_min_max_diff, round(total - span, 4) AS deviation, missing, imputed, missing - imputed AS imputed_na, CAST(method_flags AS BIGINT) AS method_flags, CAST(coalesce(mask, 0) AS BIGINT) AS bitwise_methods FROM st")
def gap_stats(spark, sf):
    df = stats.gap_stats(_imputed(spark, sf), K)
    return df.select("project", "house", *[F.round(c, 4).alias(c) for c in ("diff_col_total", "cum_col_min_max_diff", "deviation")], "missing", "imputed", "imputed_na", "method_flags", "bitwise_methods")


@query(f"{STATS} SELECT project, house, missing, imputed, n AS total_records, round(100.0 * imputed / n, 6) AS percentage_imputed FROM st")
def impute_summary_house(spark, sf):
    return stats.house_summary(stats.gap_stats(_imputed(spark, sf), K)).select("project", "house", "missing", "imputed", "total_records", *_r("percentage_imputed"))


@query(f"{STATS} SELECT project, CAST(bit_or(coalesce(mask, 0)) AS BIGINT) AS bitwise_methods, CAST(sum(missing) AS BIGINT) AS missing, CAST(sum(imputed) AS BIGINT) AS imputed, CAST(sum(missing - imputed) AS BIGINT) AS imputed_na, CAST(sum(n) AS BIGINT) AS total_records, round(100.0 * sum(imputed) / sum(n), 6) AS percentage_imputed FROM st GROUP BY 1")
def impute_summary_project(spark, sf):
    df = stats.project_summary(stats.gap_stats(_imputed(spark, sf), K), K)
    return df.select("project", "bitwise_methods", "missing", "imputed", "imputed_na", "total_records", *_r("percentage_imputed"))


@query(f"WITH {IMPUTED}, k AS (SELECT DISTINCT project, kind FROM imp WHERE kind IS NOT NULL) SELECT project, string_agg(CAST(kind AS VARCHAR), ',' ORDER BY kind) AS methods FROM k GROUP BY 1")
def impute_methods_union(spark, sf):
    df = stats.project_summary(stats.gap_stats(_imputed(spark, sf), K), K).filter(F.size("methods") > 0)
    return df.select("project", F.array_join(F.col("methods").cast("array<string>"), ",").alias("methods"))


@query(f"{STATS} SELECT project, house FROM st WHERE 100.0 * imputed / n > 28")
def imputed_over_limit(spark, sf):
    return stats.over_limit(stats.house_summary(stats.gap_stats(_imputed(spark, sf), K)), 28).select("project", "house")


@query(f"WITH {IMPUTED} SELECT project, day, count(kind) AS imputed, count(*) - count(new_diff) AS na, count(*) AS total_records, count(*) - count(kind) - (count(*) - count(new_diff)) AS original, round(100.0 * count(kind) / count(*), 6) AS percent_imputed FROM imp GROUP BY 1, 2")
def reading_date_stats(spark, sf):
    return stats.reading_date_stats(_imputed(spark, sf), D).select("project", "day", "imputed", "na", "total_records", "original", *_r("percent_imputed"))


@query(f"WITH {READINGS}, v AS (SELECT project, house, CASE WHEN house % 4 = 0 THEN NULL ELSE cum END AS x FROM readings) SELECT project, house, count(*) - count(x) AS missing, coalesce(count(x) > 0 AND round(sum(x), 10) <> 0 AND round(max(x) - min(x), 10) <> 0, false) AS usable, count(*) - count(x) > 0.4 * count(*) AS mostly_missing FROM v GROUP BY 1, 2")
def validate_columns(spark, sf):
    df = _readings(spark, sf).withColumn("x", F.when(F.col("house") % 4 != 0, F.col("cum")))
    return stats.validate_columns(df, ["x"], D).drop("column")


# scalar functions

_INPUTS = ("ElektriciteitTerugleveringLaagDiff", "ElektriciteitTerugleveringHoogDiff", "ElektriciteitNetgebruikLaagDiff", "ElektriciteitNetgebruikHoogDiff", "ElektriciteitsgebruikWarmtepompDiff", "ElektriciteitsgebruikBoosterDiff", "ElektriciteitsgebruikBoilervatDiff", "ElektriciteitsgebruikWTWDiff", "ElektriciteitsgebruikRadiatorDiff", "Zon-opwekTotaalDiff")
_FROM = ("l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_discount + 1", "l_tax + 1", "l_quantity * 2", "l_quantity + 3", "l_extendedprice / 4", "CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE l_quantity * 3 END")


def _balance_sql(fill: bool) -> str:
    x = [f"coalesce({c}, 0)" if fill else f"({c})" for c in _FROM]
    out, net, heat, build = f"{x[0]} + {x[1]}", f"{x[2]} + {x[3]}", f"{x[4]} + {x[5]}", f"{x[4]} + {x[5]} + {x[6]} + {x[7]} + {x[8]}"
    cols = {"TerugleveringTotaalNetto": out, "ElektriciteitsgebruikTotaalNetto": net, "Netuitwisseling": f"({net}) - ({out})", "ElektriciteitsgebruikTotaalWarmtepomp": heat, "ElektriciteitsgebruikTotaalGebouwgebonden": build, "ElektriciteitsgebruikTotaalHuishoudelijk": f"({net}) - ({out}) + {x[9]} - ({build})", "Zelfgebruik": f"{x[9]} - ({out})", "ElektriciteitsgebruikTotaalBruto": f"({net}) + {x[9]} - ({out})"}
    return "SELECT l_orderkey, l_linenumber, " + ", ".join(f'round({v}, 4) + 0.0 AS "{k}"' for k, v in cols.items()) + " FROM lineitem"


def _balance(spark: SparkSession, sf: str, fill: bool) -> DataFrame:
    df = _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[F.expr(s).alias(n) for n, s in zip(_INPUTS, _FROM, strict=True)])
    return scalar.calculated_columns(df, fill).select("l_orderkey", "l_linenumber", *[(F.round(n, 4) + 0.0).alias(n) for n, _ in scalar.BALANCE])


@query(_balance_sql(True))
def calculated_columns(spark, sf):
    return _balance(spark, sf, True)


@query(_balance_sql(False))
def calculated_columns_nullprop(spark, sf):
    return _balance(spark, sf, False)


@query("SELECT event_id, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, strftime(ts, '%H:%M:%S.%f') AS time_of_day, TIMESTAMP '2023-01-02' + to_days(CAST(isodow(ts) - 1 AS INTEGER)) + (ts - date_trunc('day', ts)) AS normalized_datetime FROM events")
def normalized_datetime(spark, sf):
    df = _read(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ReadingDate"))
    return scalar.normalized_datetime(df).select("event_id", "day_of_week", "time_of_day", "normalized_datetime")


@query("SELECT * FROM (VALUES ('5min', 12.0::DOUBLE, 1, 1), ('15min', 4.0, 3, 15), ('60min', 1.0, 12, 60), ('6h', 0.166667, 72, 360), ('24h', 0.041667, 288, 1440)) t(\"interval\", factor, full_bin, steps) WHERE steps = 1 OR steps = 5 * full_bin")
def interval_multiplier(spark, sf):
    rows = [(k, round(scalar.to_kw(k), 6), n, 1 if k == "5min" else minutes(k)) for k, n in FULL_BIN.items()]
    return spark.createDataFrame(rows, "interval string, factor double, full_bin int, steps int")


def _sig_sql(x: str) -> str:
    return f"CASE WHEN {x} = 0 THEN 0 ELSE round_even({x} * pow(10, 2 - floor(log10(abs({x})))), 0) / pow(10, 2 - floor(log10(abs({x})))) END"


@query(f"WITH s AS (SELECT l_orderkey, l_linenumber, {_sig_sql('l_extendedprice')} AS a, {_sig_sql('(l_extendedprice + l_quantity)')} AS b FROM lineitem) SELECT l_orderkey, l_linenumber, abs(a - b) <= 0.001 * greatest(abs(a), abs(b)) AS same FROM s")
def equal_sig_fig(spark, sf):
    return _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", scalar.equal_sig_fig(F.col("l_extendedprice"), F.col("l_extendedprice") + F.col("l_quantity"), 3).alias("same"))


@query("WITH w AS (SELECT l_orderkey, l_linenumber, l_quantity - 15 AS t, 50 + 1000 * l_tax / 2 AS u, l_discount * 100 AS f FROM lineitem) SELECT l_orderkey, l_linenumber, round(t + 0.33 * (u * 6.105 * exp(17.27 * t / (t + 237.7)) / 100) - 0.7 * f - 4.0, 8) AS felt FROM w")  # to eight digits: at five, values at t = 0 lie on ties
def apparent_temperature(spark, sf):
    t, u, f = F.col("l_quantity") - 15, 50 + 1000 * F.col("l_tax") / 2, F.col("l_discount") * 100
    return _read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(scalar.apparent_temperature(t, u, f), 8).alias("felt"))


# rolling averages and periods


def _totals(spark: SparkSession, sf: str) -> DataFrame:
    """Daily cents by project: exact, so that extremes tie alike in both engines."""
    return _readings(spark, sf).groupBy("project", "day").agg(F.sum("cents").cast("double").alias("x"))


TOTALS = f"WITH {READINGS}, tot AS (SELECT project, day, CAST(sum(cents) AS DOUBLE) AS x FROM readings GROUP BY 1, 2)"
ROLLED = TOTALS + ", ra AS (SELECT *, CASE WHEN count(x) OVER w >= 3 THEN round(avg(x) OVER w, 4) END AS avg7, row_number() OVER (PARTITION BY project ORDER BY day) - 1 AS pos, count(*) OVER (PARTITION BY project) AS n FROM tot WINDOW w AS (PARTITION BY project ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))"


def _rolled(spark: SparkSession, sf: str) -> DataFrame:
    df = periods.rolling_average(_totals(spark, sf), ["project"], "x", 7, ["day"], "avg7")
    return df.withColumn("avg7", F.round("avg7", 4))


@query(ROLLED + " SELECT project, day, avg7 FROM ra")
def rolling_avg(spark, sf):
    return _rolled(spark, sf).select("project", "day", "avg7")


def _period_sql(best: str, out: str) -> str:
    return ROLLED + f", e AS (SELECT *, coalesce(lag(day, 6) OVER (PARTITION BY project ORDER BY day), first_value(day) OVER (PARTITION BY project ORDER BY day)) AS s, {best}(avg7) OVER (PARTITION BY project) AS b FROM ra) SELECT project, s AS \"StartTime\", day AS \"EndTime\", avg7 AS \"{out}\" FROM e WHERE avg7 = b"


@query(_period_sql("max", "HighestRollingAverage"))
def highest_avg_period(spark, sf):
    return periods.highest_period(_rolled(spark, sf), ["project"], "avg7", 7, ["day"])


@query(_period_sql("min", "LowestRollingAverage"))
def lowest_avg_period(spark, sf):
    return periods.lowest_period(_rolled(spark, sf), ["project"], "avg7", 7, ["day"])


@query(ROLLED + ", m AS (SELECT project AS p, pos AS hit FROM ra QUALIFY avg7 = min(avg7) OVER (PARTITION BY project)) SELECT project, day, EXISTS (SELECT 1 FROM m WHERE p = project AND hit >= 5 AND pos >= hit - 5 AND pos < hit) AS coldest FROM ra")
def mark_coldest(spark, sf):
    return periods.mark_coldest(_rolled(spark, sf), ["project"], "avg7", 5, ["day"]).select("project", "day", "coldest")


@query(ROLLED + ", m AS (SELECT project AS p, pos AS hit FROM ra QUALIFY x = max(x) OVER (PARTITION BY project)) SELECT project, day, EXISTS (SELECT 1 FROM m WHERE p = project AND hit >= 3 AND pos >= hit - 3 AND pos < hit + 2) AS peak FROM ra")
def mark_highest_peak(spark, sf):
    return periods.mark_highest_peak(_rolled(spark, sf), ["project"], "x", 5, ["day"]).select("project", "day", "peak")


@query(f"WITH {READINGS}, a AS (SELECT project, max(x) AS x FROM (SELECT project, day, CAST(sum(cents) AS DOUBLE) AS x FROM readings GROUP BY 1, 2) GROUP BY 1), b AS (SELECT project, max(CAST(cents AS DOUBLE)) AS y FROM readings GROUP BY 1) SELECT coalesce(a.project, b.project) AS project, x AS \"HighestDailyAvg\", y AS \"Highest5MinAvg\", round(x / y, 6) AS \"Ratio\" FROM a FULL JOIN b ON a.project = b.project")
def simultaneity_ratio(spark, sf):
    fine = _readings(spark, sf).select("project", F.col("cents").cast("double").alias("x"))
    return periods.simultaneity(_totals(spark, sf), fine, "x", "project").select("project", "HighestDailyAvg", "Highest5MinAvg", *_r("Ratio"))


# weather


def _hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Hours of events as weather: the station is the project, hours are numbered 1 to 24."""
    date, hour = scalar.station_hour(F.col("ts"))
    df = _readings(spark, sf).groupBy(F.col("project").alias("STN"), date.alias("YYYYMMDD"), hour.alias("HH")).agg(F.sum("cents").cast("double").alias("Temperatuur"), F.min("cents").cast("double").alias("Gevoelstemperatuur"))
    return df


HOURLY = READINGS + ", hourly AS (SELECT project AS \"STN\", CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS \"YYYYMMDD\", CAST(hour(ts) + 1 AS INTEGER) AS \"HH\", CAST(sum(cents) AS DOUBLE) AS \"Temperatuur\", CAST(min(cents) AS DOUBLE) AS \"Gevoelstemperatuur\" FROM readings GROUP BY 1, 2, 3)"


@query(f"WITH {HOURLY}, c AS (SELECT *, strptime(CAST(\"YYYYMMDD\" AS VARCHAR), '%Y%m%d') AS d FROM hourly) SELECT \"STN\", \"YYYYMMDD\", \"HH\", CAST(d AS TIMESTAMP) + to_hours(\"HH\") AS datetime_column, CAST(year(d) AS INTEGER) AS \"year\", CAST(week(d) AS INTEGER) AS week_of_year, CAST(isodow(d) - 1 AS INTEGER) AS day_of_week FROM c")
def weather_calendar(spark, sf):
    return weather.calendar(_hourly(spark, sf)).select("STN", "YYYYMMDD", "HH", "datetime_column", "year", "week_of_year", "day_of_week")


@query(f"WITH {HOURLY}, c AS (SELECT *, strptime(CAST(\"YYYYMMDD\" AS VARCHAR), '%Y%m%d') AS d FROM hourly), k AS (SELECT \"STN\", year(d) AS y, week(d) AS w, round(avg(\"Temperatuur\"), 6) AS t, CAST(round(count(*) / 24.0) AS INTEGER) AS n FROM c GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY \"STN\", y ORDER BY t, w) <= 2 AS cold FROM k) SELECT c.\"STN\", c.\"YYYYMMDD\", c.\"HH\", r.t AS \"TemperatuurISOWk\", r.n AS days_in_week, r.cold AS \"Koudste2ISOWkTemperatuur\" FROM c JOIN r ON c.\"STN\" = r.\"STN\" AND year(c.d) = r.y AND week(c.d) = r.w")
def iso_week_rank(spark, sf):
    return weather.weather_table(_hourly(spark, sf)).select("STN", "YYYYMMDD", "HH", *_r("TemperatuurISOWk"), "days_in_week", "Koudste2ISOWkTemperatuur")


@query(f"WITH {HOURLY}, ra AS (SELECT *, CASE WHEN count(*) OVER w >= 12 THEN round(avg(\"Temperatuur\") OVER w, 5) END AS t, row_number() OVER (PARTITION BY \"STN\" ORDER BY \"YYYYMMDD\", \"HH\") - 1 AS pos FROM hourly WINDOW w AS (PARTITION BY \"STN\" ORDER BY \"YYYYMMDD\", \"HH\" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)) SELECT \"STN\", \"YYYYMMDD\", \"HH\", t AS \"TemperatuurRA\" FROM ra")
def weather_rolling(spark, sf):
    return weather.weather_table(_hourly(spark, sf), 24).select("STN", "YYYYMMDD", "HH", F.round("TemperatuurRA", 5).alias("TemperatuurRA"))


def _coldest_sql() -> str:
    """Rolling means of 24 hours, the hours before each station's least mean, and the two coldest ISO weeks, of both temperatures."""
    both = {"Temperatuur": "t", "Gevoelstemperatuur": "g"}
    rolled = ", ".join(f"CASE WHEN count(*) OVER w >= 12 THEN avg(\"{c}\") OVER w END AS {x}" for c, x in both.items())
    ra = f"ra AS (SELECT *, {rolled}, row_number() OVER (PARTITION BY \"STN\" ORDER BY \"YYYYMMDD\", \"HH\") - 1 AS pos, strptime(CAST(\"YYYYMMDD\" AS VARCHAR), '%Y%m%d') AS d FROM hourly WINDOW w AS (PARTITION BY \"STN\" ORDER BY \"YYYYMMDD\", \"HH\" ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))"
    least = ", ".join(f"m{x} AS (SELECT \"STN\" AS s, pos AS hit FROM ra QUALIFY {x} = min({x}) OVER (PARTITION BY \"STN\"))" for x in both.values())
    weeks = f"k AS (SELECT \"STN\", year(d) AS y, week(d) AS wk, {', '.join(f'avg(\"{c}\") AS k{x}' for c, x in both.items())} FROM ra GROUP BY 1, 2, 3), r AS (SELECT *, {', '.join(f'row_number() OVER (PARTITION BY \"STN\", y ORDER BY k{x}, wk) <= 2 AS c{x}' for x in both.values())} FROM k)"
    columns = ", ".join(f"round(ra.{x}, 6) AS \"{c}RA\", EXISTS (SELECT 1 FROM m{x} WHERE s = ra.\"STN\" AND hit >= 24 AND pos >= hit - 24 AND pos < hit) AS \"Koudste2Wk{c}\", round(r.k{x}, 6) AS \"{c}ISOWk\", r.c{x} AS \"Koudste2ISOWk{c}\"" for c, x in both.items())
    return f"WITH {HOURLY}, {ra}, {least}, {weeks} SELECT ra.\"STN\", ra.\"YYYYMMDD\", ra.\"HH\", {columns} FROM ra JOIN r ON ra.\"STN\" = r.\"STN\" AND year(ra.d) = r.y AND week(ra.d) = r.wk"


@query(_coldest_sql())
def weather_coldest(spark, sf):
    df = weather.weather_table(_hourly(spark, sf), 24)
    return df.select("STN", "YYYYMMDD", "HH", *[x for c in ("Temperatuur", "Gevoelstemperatuur") for x in (F.round(f"{c}RA", 6).alias(f"{c}RA"), F.col(f"Koudste2Wk{c}"), F.round(f"{c}ISOWk", 6).alias(f"{c}ISOWk"), F.col(f"Koudste2ISOWk{c}"))])


@query(f"WITH {HOURLY} SELECT r.event_id, h.\"Temperatuur\" FROM readings r LEFT JOIN hourly h ON r.project = h.\"STN\" AND CAST(strftime(r.ts, '%Y%m%d') AS INTEGER) = h.\"YYYYMMDD\" AND hour(r.ts) + 1 = h.\"HH\"")
def weather_join(spark, sf):
    series = _readings(spark, sf).select("event_id", F.col("project").alias("STN"), F.col("ts").alias("ReadingDate"))
    return joins.join_weather(series, _hourly(spark, sf).select("STN", "YYYYMMDD", "HH", "Temperatuur")).select("event_id", "Temperatuur")


import gridloom.plans.stored  # noqa: E402, F401  registers the queries that go through stored tables
