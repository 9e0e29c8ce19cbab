"""Shared folders, lineage cuts and connected components for the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import re
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def give_back() -> None:
    """Return what this process's libraries hold and don't use."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where there is no glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def relieve(spark: SparkSession) -> None:
    """Have the executors' JVMs collect their garbage and return the heap that they don't use.

    A heap that a shuffle has grown stays so, beside Python workers that need the memory later.  One short task a core
    reaches every executor that is idle, as between the stages of a pipeline; results don't depend on it.
    """
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')")).collect()


def tidy(function, tokens: bool = False):
    """`function` over batches, after which its worker gives back what its libraries hold: workers outlive their tasks.

    Identifiers that a task cached stay for functions that use `tokens` alone, and only while such tasks follow each
    other: an executor may have more workers than tasks run at once, and those that wait would hold a full cache each.
    """

    def run(batches):
        if own := sys.modules.get(f"{__package__}.tokens"):
            own.TokenIds.keep() if tokens else own.TokenIds.forget()
        try:
            yield from function(batches)
        finally:
            if tokens and (own := sys.modules.get(f"{__package__}.tokens")):
                own.TokenIds.forget_soon(give_back)
            give_back()

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: `spark.checkpoint.dir`.  Where that is unset, a temporary one, but only if
    everything runs in this process (tests): executors elsewhere would not see it."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write `df` as a table in the shared folder and read it back.

    A lost executor then costs the tasks it was running and nothing that came before; Parquet keeps the
    copy compressed and lets later reads prune columns.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Python functions of the jobs inside take `rows` rows at once at most, for those that need no more."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(*tables: DataFrame) -> None:
    """Delete tables written by `materialise` that no later plan reads."""
    spark = tables[0].sparkSession
    jvm = spark.sparkContext._jvm
    for path in {f.rsplit("/", 1)[0] for df in tables for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of `df` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (src, dst); component is the smallest node reachable.

    Alternates the large-star and small-star steps: each round links the neighbours of a node to the
    smallest of them, so paths shorten geometrically and hubs become stars.  The smallest neighbour comes
    from an aggregate that combines before the shuffle, and the joins are plain equi-joins that adaptive
    execution splits where a hub is hot.  Null endpoints and self-loops are dropped; no edges, no rows.
    """
    e = materialise(
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
        .where("src is not null and dst is not null and u != v")
        .distinct(),
        "edges",
    )
    seen = None
    for _ in range(max_rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = materialise(small, "edges")
        mark = tuple(after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        discard(e)
        e = after
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("the components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))
