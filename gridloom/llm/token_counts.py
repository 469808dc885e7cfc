"""Token counts through a digest cache: known contents are looked up, distinct misses encoded and appended."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridloom.llm.common import materialise, scratch_path, spread_join
from gridloom.llm.tokens import counter, file_digest, in_steps

CACHE_SCHEMA = "digest binary, n_tokens long"


def cache_folder(root: str, tokenizer: str) -> str:
    """The part of a cache that belongs to one tokenizer version."""
    return f"{root.rstrip('/')}/tokenizer={file_digest(tokenizer)}"


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    """Stored counts, one row a digest; a folder that does not exist yet is an empty cache."""
    try:
        stored = spark.read.schema(CACHE_SCHEMA).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE_SCHEMA)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_column(tokenizer: str):
    @pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = counter(tokenizer)
        for batch in texts:
            yield pd.Series(in_steps(batch.tolist(), counts.texts), dtype="int64")

    return count


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 4096, cache: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Contents are normalised by taking null as empty; anything more would change counts.  ``cache`` is
    a folder kept between runs (none: a fresh one); misses are appended to its part for this
    tokenizer's digest, so a change of the file starts a new part.  Copies are encoded once: the row
    with the least doc_id of a digest carries the text.  Repeated rows and null ids are counted; very long
    texts are encoded whole; ``limit`` tokens exactly are not over it; an empty table gives no rows.  Only doc_id and text are read, so further columns cannot clash.
    """
    spark = docs.sparkSession
    folder = cache_folder(cache or scratch_path(spark, "token-cache"), tokenizer)
    text = F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    plain = docs.select("doc_id", text.alias("text"))
    keys = materialise(plain.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest.alias("digest")), "digests")
    contents = materialise(keys.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")), "contents")
    missing = contents.join(read_cache(spark, folder), "digest", "left_anti").select("digest", "first")
    # both keys take part in the exchange, so the copies of a hot text spread over the tasks
    texts = plain.withColumn("digest", digest)
    chosen = texts.join(missing.hint("shuffle_hash"), (texts.digest == missing.digest) & texts.doc_id.eqNullSafe(missing["first"]), "left_semi")
    chosen.select("digest", count_column(tokenizer)("text").alias("n_tokens")).write.mode("append").parquet(folder)
    counts = read_cache(spark, folder)
    return spread_join(keys, counts, contents.select("digest", "n"), "digest", F.col("doc_id")).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
