"""A folder that driver and executors share, for tables that queries write and read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; without that, and only on a local master, a temporary one."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gridloom-")
    return f"{root.rstrip('/')}/gridloom/{name}-{uuid.uuid4().hex}"
