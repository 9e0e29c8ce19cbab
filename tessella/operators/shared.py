"""Lineage cuts in the folder that all executors share, and broadcasts of a checked size."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled_table(df: DataFrame, what: str) -> DataFrame:
    """`df` written to `spark.checkpoint.dir` and read back; where that is unset and all runs in this process, to a temporary folder."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, megabytes: int = 16) -> DataFrame:
    """`df` with a broadcast hint if the planner's own estimate of its size is within the bound, else as it is."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= megabytes << 20 else df
