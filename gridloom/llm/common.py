"""Shared plumbing: scratch tables in the cluster's shared folder, labelled samples, helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors, taken from ``spark.checkpoint.dir``.

    Only where the session leaves it unset, and only on a local master (single-machine tests), a temporary
    folder is chosen; on a cluster executors could not see one another's files, so the setting is required.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    found = getattr(spark, "_gridloom_scratch", None)
    if found is None:
        found = spark._gridloom_scratch = tempfile.mkdtemp(prefix="gridloom-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/gridloom/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return it reread.

    This cuts the lineage without keeping blocks on executors that can be lost, and unlike a
    reliable checkpoint it runs the plan a single time and leaves column pruning possible.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._gridloom_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete materialised tables that nothing will read again; what a result still reads must stay."""
    for df in tables:
        path = getattr(df, "_gridloom_path", None)
        jvm = getattr(df.sparkSession, "_jvm", None) if path else None
        if jvm is not None:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


HOT_KEYS, HOT_ROWS = 10_000, 1_000


def spread_join(rows: DataFrame, named: DataFrame, counts: DataFrame, key: str, by: Column) -> DataFrame:
    """``rows`` joined with ``named`` (one row a ``key``), the rows of frequent keys dealt over several tasks by ``by``.

    ``counts`` (key, n) tells how often a key is in ``rows``.  A key is frequent if it holds over HOT_ROWS
    rows and over one in HOT_KEYS of all, so there are fewer than HOT_KEYS of them, whatever the size: that
    bounds the broadcast.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = max(HOT_ROWS, total // HOT_KEYS)
    hot = materialise(counts.filter(F.col("n") > most).select(F.col(key).alias("hot_key"), F.ceil(F.col("n") / most).cast("int").alias("hot_parts")), "hot")
    if hot.isEmpty():
        return rows.join(named, key)
    parts = lambda df: df.join(F.broadcast(hot), F.col(key) == F.col("hot_key"), "left").withColumn("hot_parts", F.coalesce("hot_parts", F.lit(1))).drop("hot_key")
    dealt = parts(rows).withColumn("hot_part", F.pmod(F.xxhash64(by), F.col("hot_parts")).cast("int")).drop("hot_parts")
    copied = parts(named).withColumn("hot_part", F.explode(F.sequence(F.lit(0), F.col("hot_parts") - 1))).drop("hot_parts")
    return dealt.join(copied, [key, "hot_part"]).drop("hot_part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int = 5) -> Column:
    """``crc32(doc_id as text) mod folds``; null ids are in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column) -> Column:
    """True where the id's remainder is 0; a null id is never held out."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> list[tuple[str, int]]:
    """Whole texts and labels of at most ``limit`` training rows (fold not 0), on the driver.

    The rows are the ``limit`` labelled ids with the smallest hash, so that the choice depends on
    no order or partitioning; ``limit`` bounds both the broadcast and what reaches the driver.
    """
    ids = (
        labels.select(F.col("doc_id").alias("sample_id"), F.col(label).cast("int").alias("sample_y"))
        .filter(F.col("sample_id").isNotNull() & F.col("sample_y").isNotNull() & (fold(F.col("sample_id")) != 0))
        .groupBy("sample_id")
        .agg(F.max("sample_y").alias("sample_y"))
        .orderBy(F.xxhash64("sample_id"), "sample_id")
        .limit(limit)
    )
    rows = (
        docs.select(F.col("doc_id").alias("sample_id"), F.coalesce(F.col("text"), F.lit("")).alias("sample_text"))
        .join(F.broadcast(ids), "sample_id")
        .groupBy("sample_id")
        .agg(F.max(F.struct("sample_text", "sample_y")).alias("r"))
        .select("sample_id", "r.sample_text", "r.sample_y")
        .collect()
    )
    return [(r[1], int(r[2])) for r in sorted(rows, key=lambda r: r[0])]
