"""The bucket and presence rules on streams: watermarks bound the state, late readings are dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.config import FULL_BIN, Variable, minutes
from gridloom.operators.resample import reduce_column, validated


def resample_stream(stream: DataFrame, variables: Mapping[str, Variable], interval: str, group: Sequence[str], time: str, late: str = "1 hour", min_count: int | None = None) -> DataFrame:
    """Buckets of a stream of readings; a bucket is emitted once the watermark passes its end.

    Empty buckets have no rows: a stream does not know a household's last bucket.  ``time`` must be a
    timestamp with time zone, as watermarks need.
    """
    least = FULL_BIN[interval] if min_count is None else min_count
    w = F.window(time, f"{minutes(interval)} minutes")
    cells = stream.withWatermark(time, late).groupBy(*group, w.alias("bucket")).agg(*[reduce_column(v.resample, validated(c, v.validator), F.count(validated(c, v.validator)) >= least).alias(c) for c, v in variables.items()])
    return cells.select(*group, F.col("bucket.start").alias(time), *[F.col(f"`{c}`") for c in variables])
