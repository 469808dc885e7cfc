"""Operators on small tables made by hand."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from gridloom.config import CUMULATIVE_COLUMNS, VARIABLES, EngineConfig, Keys, Variable, minutes
from gridloom.functions import scalar
from gridloom.operators import averages, impute, joins, periods, resample, stats
from gridloom.operators.weather import weather_table
from gridloom.plans import pipelines
from gridloom.sources import bundles, tables
from gridloom.sources.weather import read_weather

K = Keys("p", "h", "t")
T0 = dt.datetime(2023, 1, 1)

# house, t, cum, diff, avg, new diff, type
CASES = [
    (1, 0, 10.0, 1.0, 0.5, 1.0, None),
    (1, 1, None, None, 0.5, 1.5, 8),
    (1, 2, 13.0, None, 0.5, 1.5, 8),
    (1, 3, None, None, 0.5, 0.5, 64),
    (1, 4, None, None, 0.5, 0.5, 64),
    (1, 5, 20.0, 2.0, 0.5, 2.0, None),
    (2, 0, None, None, 0.5, 0.5, 32),
    (2, 1, 5.0, None, 0.5, 0.5, 32),
    (2, 2, 6.0, 1.0, 0.5, 1.0, None),
    (3, 0, 9.0, 1.0, 0.5, 1.0, None),
    (3, 1, 4.0, None, 0.5, 0.0, 1),
    (3, 2, 4.0, None, 0.5, 0.0, 2),
    (3, 3, 6.0, None, None, 2.0, 4),
    (4, 0, 0.0, None, 0.5, 0.0, 16),
    (5, 0, None, None, 0.5, None, None),
    (6, 0, 100.0, 50.0, 0.5, 0.5, 128),
]


@pytest.fixture(scope="module")
def long(spark):
    rows = [(1, h, t, "xDiff", cum, diff, avg) for h, t, cum, diff, avg, _, _ in CASES]
    return spark.createDataFrame(rows, "p long, h long, t int, column string, cum double, diff double, avg double")


def test_each_imputation_case(long):
    got = {(r.h, r.t): r for r in impute.impute_long(long, K, thresholds={"xDiff": (0.0, 10.0)}).collect()}
    for h, t, _, diff, _, new, kind in CASES:
        r = got[(h, t)]
        assert r.impute_type == kind and r.old_diff == diff and r.is_imputed == (kind is not None)
        assert (r.diff is None and new is None) or abs(r.diff - new) < 1e-9


def test_reconstruction_skips_nulls(long):
    rows = {(r.h, r.t): r for r in impute.reconstruct_long(impute.impute_long(long, K), K).collect()}
    assert [rows[(1, t)].cum for t in range(6)] == pytest.approx([1, 2.5, 4, 4.5, 5, 7])
    assert rows[(5, 0)].cum is None and rows[(1, 5)].original == 20


def test_negative_average_fails(spark):
    bad = spark.createDataFrame([(1, 1, 0, "xDiff", 1.0, None, -1.0)], "p long, h long, t int, column string, cum double, diff double, avg double")
    with pytest.raises(Exception, match="negative average"):
        impute.impute_long(bad, K).collect()


def test_wide_and_long_agree(spark):
    df = spark.createDataFrame([(1, 1, k, float(k), None if k == 2 else 1.0, 1.0) for k in range(4)], "p long, h long, t int, x double, xDiff double, xDiff_avg double")
    wide = impute.to_wide(impute.reconstruct_long(impute.impute_long(impute.to_long(df, ["x"], K), K), K), ["x"], K).orderBy("t").collect()
    assert [r.xDiff for r in wide] == [1, 1, 1, 1] and [r.xDiff_is_imputed for r in wide] == [False, False, True, False] and wide[2].xOldDiff is None


def test_trimming_bound_is_twice_the_percentile(spark):
    df = spark.createDataFrame([(1, h, 0, v) for h, v in enumerate([0.0, 1.0, 2.0, 100.0])], "p long, h long, t int, xDiff double")
    b = averages.household_bounds(df, ["xDiff"], K).first()
    assert b.xDiff_upper_bound == pytest.approx(2 * (2 + 0.9 * 98))
    none = averages.household_bounds(df.withColumn("xDiff", F.lit(0.0)), ["xDiff"], K).first()
    assert none.xDiff_upper_bound is None
    assert averages.trimmed_averages(df.withColumn("xDiff", F.lit(0.0)), ["xDiff"], K).first().xDiff_avg is None
    with pytest.raises(Exception, match="negative value"):
        averages.trimmed_averages(df.withColumn("xDiff", F.when(F.col("h") == 1, -1.0).otherwise(F.col("xDiff"))).union(df), ["xDiff"], K).collect()


def test_method_mask_and_summaries(spark, long):
    got = spark.createDataFrame([([1, 4, 64, 128],)], "m array<long>").select(stats.method_mask(F.col("m"))).first()[0]
    assert got == 0b1001
    s = {r.h: r for r in stats.gap_stats(impute.impute_long(long, K), K).collect()}
    assert (s[1].missing, s[1].imputed, s[1].methods, s[1].method_flags) == (4, 4, [8, 64], 72)
    assert s[5].imputed_na == 1
    over = stats.over_limit(stats.house_summary(stats.gap_stats(impute.impute_long(long, K), K))).collect()
    assert {r.h for r in over} == {1, 2, 3, 4}


def test_share_at_a_limit_is_not_over_it(spark):
    shares = [(n, k) for n in range(1, 201) for k in range(n + 1) if 100 * k % n == 0]
    df = spark.createDataFrame([(n, k, "xDiff", 0, 0, [], k, k, 0, n, 0.0) for n, k in shares], "p long, h long, column string, bitwise_methods long, method_flags long, methods array<long>, missing long, imputed long, imputed_na long, total_records long, deviation double")
    house = stats.house_summary(df)
    assert all(r.percentage_imputed == 100 * r.imputed // r.total_records for r in house.collect())
    assert all(100 * r.imputed > 28 * r.total_records for r in stats.over_limit(house, 28).collect())
    project = stats.project_summary(df.withColumn("p", F.col("p") * 1000 + F.col("h")), K)
    assert all(r.percentage_imputed == 100 * r.imputed // r.total_records for r in project.collect())
    rows = [(1, 0, "xDiff", k < 7, None if 7 <= k < 14 else 1.0) for k in range(25)]
    dates = stats.reading_date_stats(spark.createDataFrame(rows, "p long, t int, column string, is_imputed boolean, diff double"), K).first()
    assert (dates.percent_imputed, dates.percent_na, dates.percent_original) == (28.0, 28.0, 44.0)


def test_resample_is_dense_and_needs_full_bins(spark):
    rows = [(1, 1, T0 + dt.timedelta(minutes=5 * k), 1.0 if k != 4 else None) for k in range(6)] + [(1, 1, T0 + dt.timedelta(minutes=60), 1.0)]
    df = spark.createDataFrame(rows, "p long, h long, t timestamp_ntz, x double")
    out = resample.resample(df, {"x": Variable()}, "15min", K).orderBy("t").collect()
    assert [r.x for r in out] == [3.0, None, None, None, None]
    with pytest.raises(ValueError):
        minutes("7min")
    with pytest.raises(ValueError):
        resample.resample(df, {"x": Variable("median")}, "15min", K)


def test_presence_rule_counts_null_rows(spark):
    df = spark.createDataFrame([(1, 0, 1.0), (1, 0, 3.0), (1, 0, 5.0), (1, 0, None), (1, 0, None), (2, 0, 1.0), (2, 0, None)], "p long, t int, x double")
    got = {r.p: (r.x, r.n) for r in resample.aggregate(df, {"x": Variable()}, ["p"], "t").collect()}
    assert got == {1: (3.0, 5), 2: (None, 2)}


def _mark_slow(values, n, before, best):
    hit = best([v for v in values if v is not None])
    out = [False] * len(values)
    for p, v in enumerate(values):
        if v == hit:
            start = p - before
            for k in range(len(values))[start : start + n] if start + n > 0 or start >= 0 else []:
                out[k] = True
            if start < 0:
                for k in range(len(values))[max(0, len(values) + start) : max(0, start + n)]:
                    out[k] = True
    return out


@pytest.mark.parametrize("values", [[5, 4, 1, 7, 1, 9, 2, 8], [1, 2, 3], [3, 2, 1], [2, None, 2, 5], [9, 1, 1, 1, 1, 0, 4, 4, 4, 9]])
def test_marks_follow_slices(spark, values):
    df = spark.createDataFrame([(1, k, None if v is None else float(v)) for k, v in enumerate(values)], "g long, k int, v double")
    for n in (2, 4):
        cold = [r.m for r in periods.mark_coldest(df, ["g"], "v", n, ["k"], "m").orderBy("k").collect()]
        assert cold == _mark_slow(values, n, n, min)
        peak = [r.m for r in periods.mark_highest_peak(df, ["g"], "v", n, ["k"], "m").orderBy("k").collect()]
        assert peak == _mark_slow(values, n, math.ceil(n / 2), max)


def test_periods_and_simultaneity(spark):
    df = spark.createDataFrame([(1, T0 + dt.timedelta(days=k), float(v)) for k, v in enumerate([1, 5, 2, 5])], "g long, t timestamp_ntz, v double")
    top = periods.highest_period(df, ["g"], "v", 2, ["t"]).orderBy("EndTime").collect()
    assert [(r.StartTime, r.EndTime) for r in top] == [(T0, T0 + dt.timedelta(days=1)), (T0 + dt.timedelta(days=2), T0 + dt.timedelta(days=3))]
    assert periods.lowest_period(df, ["g"], "v", 2, ["t"]).first().StartTime == T0
    assert periods.simultaneity(df, df, "v").first().Ratio == 1.0
    assert periods.steps(14) == 336 and periods.steps(1, "5min") == 288


def test_normalised_week(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 8, 13, 30),)], "ReadingDate timestamp_ntz")
    r = scalar.normalized_datetime(df).first()
    assert r.day_of_week == 2 and r.normalized_datetime == dt.datetime(2023, 1, 4, 13, 30)
    with pytest.raises(TypeError):
        scalar.normalized_datetime(df.select(F.lit("x").alias("ReadingDate")))
    with pytest.raises(ValueError):
        scalar.to_kw("2h")


def test_significant_figures(spark):
    df = spark.createDataFrame([(0.0,), (123456.0,), (-0.0012345,)], "x double")
    assert [r[0] for r in df.select(scalar.significant(F.col("x"), 3)).collect()] == pytest.approx([0.0, 123000.0, -0.00123])
    assert df.select(scalar.equal_sig_fig(F.lit(1.2344), F.lit(1.2341), 4)).first()[0]


def test_right_suffix(spark):
    a, b = spark.createDataFrame([(1, 1, 2)], "HuisIdBSV long, ProjectIdBSV long, x int"), spark.createDataFrame([(1, 1, 3)], "HuisIdBSV long, ProjectIdBSV long, x int")
    out = joins.join_index(a, b)
    assert out.columns[-1] == "x_right" and joins.without_right(out).columns == ["HuisIdBSV", "ProjectIdBSV", "x"]


WEATHER = """# source
# STN,YYYYMMDD,   HH,   FH,    T,    U
{rows}
"""


def test_whole_run(spark, tmp_path):
    """Files in, every stored table out, then the bundles with weather."""
    config = EngineConfig(str(tmp_path / "mapped"), str(tmp_path / "agg"), str(tmp_path / "knmi"), str(tmp_path / "stations.csv"))
    spark.createDataFrame([(h, 1 + (h > 2), h != 4, "x") for h in (1, 2, 3, 4)], "HuisIdBSV long, ProjectIdBSV long, Meenemen boolean, Dataleverancier string").write.parquet(f"{config.mapped_folder_path}/index.parquet")
    steps = 2 * 288
    for h in (1, 2, 3, 4):
        rows = [(T0 + dt.timedelta(minutes=5 * k), *[float(k) * h for _ in CUMULATIVE_COLUMNS], *[None if h == 1 and 10 <= k < 20 else float(h) for _ in CUMULATIVE_COLUMNS]) for k in range(steps)]
        schema = "ReadingDate timestamp_ntz, " + ", ".join(f"`{c}` double" for c in CUMULATIVE_COLUMNS) + ", " + ", ".join(f"`{c}Diff` double" for c in CUMULATIVE_COLUMNS)
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{config.mapped_folder_path}/household_{h}_table.parquet")
    (tmp_path / "knmi").mkdir()
    hours = [f"  260,{(T0 + dt.timedelta(hours=k)):%Y%m%d},{k % 24 + 1:5d},   30,{'' if k == 3 else k:>5},   80" for k in range(48)]
    (tmp_path / "knmi" / "a.txt").write_text(WEATHER.format(rows="\n".join(hours)))
    (tmp_path / "stations.csv").write_text("ProjectIdBSV,Weerstation,Nummer\n1,de bilt,260\n2,de bilt,260\n")

    df = pipelines.combine(spark, config)
    assert df.count() == 3 * steps
    pipelines.write_imputation(pipelines.impute_households(df), config)
    imputed = tables.read_households(spark, config, "imputed")
    assert imputed.count() == 3 * steps and imputed.filter("GasgebruikDiff is null").count() == 0
    assert tables.read_table(spark, f"{config.aggregate_folder_path}/impute_gap_stats.parquet").count() == 3 * len(CUMULATIVE_COLUMNS)
    assert tables.read_diffs(spark, config).count() == 2 * steps and tables.read_bounds(spark, config).count() == 3
    pipelines.calculate(spark, config)
    out = pipelines.resample_households(spark, config, ("24h", "60min", "15min", "5min"))
    assert {k: v.count() for k, v in out.items()} == {"24h": 6, "60min": 144, "15min": 576, "5min": 3 * steps}
    projects = pipelines.aggregate_projects(spark, config, ("24h", "60min", "15min", "5min"))
    assert {k: v.count() for k, v in projects.items()} == {"24h": 4, "60min": 96, "15min": 384, "5min": 2 * steps}
    assert set(VARIABLES) <= set(projects["24h"].columns)
    house = bundles.household_tables(spark, config)
    assert {"weather", "calculated", "5min"} <= set(house) and "Temperatuur" in house["60min"].columns
    report = bundles.missing_weather(bundles.project_tables(spark, config)["60min"]).first()
    assert (report.total, report.missing, report.projects) == (96, 2, [1, 2])
    w = read_weather(spark, config.weather_data_folder_path)
    assert w.count() == 48 and w.filter("T is null").count() == 1
    assert weather_table(w).filter("HH = 24").first().datetime_column == dt.datetime(2023, 1, 2)
    assert tables.read_aggregate(spark, config, "Project", "24h").count() == 4 and tables.sanitize("A b-c") == "a_b_c"
    assert tables.sample_rows(w, ["YYYYMMDD", "HH"], 5).count() == 5


def test_stream_buckets(spark, tmp_path):
    from gridloom.streaming.windows import resample_stream

    rows = [(1, T0 + dt.timedelta(minutes=5 * k), 1.0) for k in range(9)]
    spark.createDataFrame(rows, "h long, t timestamp, x double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("h long, t timestamp, x double").parquet(str(tmp_path / "in"))
    q = resample_stream(stream, {"x": Variable()}, "15min", ["h"], "t", "0 seconds").writeStream.outputMode("append").format("memory").queryName("buckets").start()
    q.processAllAvailable()
    q.stop()
    assert [r.x for r in spark.sql("SELECT * FROM buckets ORDER BY t").collect()] == [3.0, 3.0]


def test_wide_imputation_keeps_repeated_and_null_moments(spark):
    """Readings at one moment, without a moment and equal in all columns are rows of their own."""
    rows = [(1, 1, 0, 1.0, 1.0, "a"), (1, 1, 0, 4.0, 3.0, "b"), (1, 1, None, 9.0, 7.0, "c"), (1, 1, None, 9.0, 7.0, "c"), (1, 1, 1, 6.0, None, None)]
    df = spark.createDataFrame(rows, "p long, h long, t int, x double, xDiff double, note string")
    run = pipelines.impute_households(df, ["x"], keys=K)
    got = sorted((repr(r.t), r.xOriginal, r.xOldDiff, r.note) for r in run.households.collect())
    assert got == sorted((repr(t), x, d, note) for _, _, t, x, d, note in rows)
    assert "reading" not in run.households.columns and run.long.count() == len(rows)


def test_thresholds_come_from_the_settings(spark):
    df = spark.createDataFrame([(1, 1, k, float(k), 50.0 if k == 2 else 1.0) for k in range(4)], "p long, h long, t int, x double, xDiff double")
    run = pipelines.impute_households(df, ["x"], keys=K, config=EngineConfig(thresholds={"xDiff": (0.0, 10.0)}))
    assert {r.t for r in run.households.filter("xDiff_is_imputed").collect()} == {2}
    assert pipelines.impute_households(df, ["x"], keys=K).households.filter("xDiff_is_imputed").count() == 0


def test_stored_imputation_warns(spark, tmp_path, caplog):
    config = EngineConfig(str(tmp_path), str(tmp_path / "agg"))
    df = spark.createDataFrame([(1, 1, k, float(k), None if k > 1 else 1.0) for k in range(5)], "ProjectIdBSV long, HuisIdBSV long, ReadingDate int, x double, xDiff double")
    pipelines.write_imputation(pipelines.impute_households(df, ["x"], keys=Keys()), config)
    assert "60.0" in caplog.text and "household" in caplog.text and "reading_date" in caplog.text


def test_rolling_by_days_takes_the_step_from_the_data(spark):
    df = spark.createDataFrame([(1, T0 + dt.timedelta(hours=6 * k), float(k)) for k in range(12)], "g long, t timestamp_ntz, v double")
    got = [r.a for r in periods.rolling_days(df, ["g"], "v", 1, ["t"], "a").orderBy("t").collect()]
    want = [r.a for r in periods.rolling_average(df, ["g"], "v", 4, ["t"], "a").orderBy("t").collect()]
    assert got == want and got[-1] == 9.5
    assert [r.a for r in periods.rolling_days(df.limit(1), ["g"], "v", 1, ["t"], "a").collect()] == [0.0]
    with pytest.raises(ValueError):
        periods.rolling_average(df, [], "v", 4, ["t"])


def test_preview(spark):
    df = spark.range(9)
    assert [r.id for r in tables.preview(df, 3, ["id"]).collect()] == [0, 1, 2] and tables.preview(df, 20).count() == 9


def test_columns_by_name(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "aDiff int, a_right int, bDiff int, c int")
    assert tables.select_columns(df, ends="Diff").columns == ["aDiff", "bDiff"]
    assert tables.select_columns(df, starts="a", without="_right").columns == ["aDiff"]
    assert tables.select_columns(df, ["c"], contains="right").columns == ["a_right", "c"]
    assert tables.select_columns(df, without="_right").columns == ["aDiff", "bDiff", "c"]


@pytest.mark.parametrize("zone", ["UTC", "Europe/Amsterdam", "Pacific/Auckland"])
def test_moments_do_not_depend_on_the_zone(spark, tmp_path, zone):
    """Nanosecond files and buckets keep their wall time in any session zone."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    at = [T0 + dt.timedelta(hours=k, microseconds=k) for k in range(30)]
    nanos = pa.array([int((x - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1)) * 1000 for x in at], pa.int64()).cast(pa.timestamp("ns"))
    pq.write_table(pa.table({"ReadingDate": nanos, "x": [1.0] * 29 + [float("nan")]}), f"{tmp_path}/n.parquet", version="2.6", coerce_timestamps=None)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.session.timeZone", "spark.sql.legacy.parquet.nanosAsLong")}
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = tables.read_table(spark, f"{tmp_path}/n.parquet")
        assert [r.ReadingDate for r in df.orderBy("ReadingDate").collect()] == at
        assert df.filter("x is null").count() == 1
        days = resample.resample(df.withColumn("h", F.lit(1)), {"x": Variable()}, "24h", Keys("h", "h"), ["h"], 1)
        assert [(r.ReadingDate, r.x) for r in days.orderBy("ReadingDate").collect()] == [(T0, 24.0), (T0 + dt.timedelta(days=1), 5.0)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_plain_reads_leave_the_session_alone(spark, tmp_path):
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{tmp_path}/t.parquet")
    before = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong")
    tables.read_table(spark, f"{tmp_path}/t.parquet").collect()
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong") == before


def test_core_queries_do_not_need_the_corpus_packages():
    """Without a package that only the corpus operators need, the core's queries are listed still."""
    import subprocess
    import sys

    code = "import sys; sys.modules['public_tokenizers'] = None; sys.modules['xxhash'] = None; import warnings; warnings.simplefilter('ignore'); import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(n.startswith('op') for n in q) and q.keys() == e.oracle_sql().keys(); print('ok')"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=__file__.rpartition("/tests/")[0])
    assert out.stdout.strip() == "ok", out.stderr[-500:]
