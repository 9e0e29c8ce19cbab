"""JSON-lines tables, run directories and Markdown passages as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DEFAULTS, schema_of


class RecordError(ValueError):
    """A line that isn't JSON, or a record without its key."""


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, value) of the non-blank lines; a missing path is an empty table.

    ordinal rises with a line's place in its file; files follow each other by name.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], "ordinal long, value string")
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("ordinal"), "value")
    return lines.where(F.trim("value") != "")


def read_records(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A typed table: known fields with their defaults, unknown ones dropped; malformed lines fail the read."""
    schema = schema_of(kind)
    own = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    parsed = read_lines(spark, path).withColumn("it", F.from_json("value", own, {"mode": "FAILFAST"}))
    return parsed.select("ordinal", *(_default(F.col(f"it.{f.name}"), kind, f).alias(f.name) for f in schema))


def _default(value: Column, kind: str, field: T.StructField) -> Column:
    given = DEFAULTS.get(kind, {}).get(field.name)
    if given is not None:
        return F.coalesce(value, F.lit(given))
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(value, F.array().cast(field.dataType))
    return value


def write_records(df: DataFrame, path: str, append: bool = False) -> None:
    out = df.sortWithinPartitions("ordinal").drop("ordinal") if "ordinal" in df.columns else df
    out.write.mode("append" if append else "overwrite").json(path)


def last_write_wins(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the last by `order`, found with an aggregate that combines before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in rest if c != order])).alias("it")).select(*keys, *(F.col(f"it.{c}").alias(c) for c in rest))


def resume(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows of `todo` that `done` has no row for."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def latest_run(runs: DataFrame, target: str = "target_id", run: str = "run_id") -> DataFrame:
    return runs.groupBy(target).agg(F.max(run).alias(run))


def parse_passages(texts: DataFrame) -> DataFrame:
    """(source, passage_id, title, body) of Markdown `texts` (source, text): headings of two to four marks open a passage.

    The heading splits at its first dash into id and title; the body runs to the next heading.
    """
    parts = F.split(F.concat(F.lit("\n"), F.coalesce("text", F.lit(""))), r"\n(?=#{2,4}\s)")
    blocks = texts.select("source", F.posexplode(parts).alias("place", "block")).where(F.col("block").rlike(r"^#{2,4}\s"))
    head = F.regexp_extract("block", r"^#{2,4}\s+([^\n]*)", 1)
    cut = F.split(head, r"\s+[-–—]+\s+", 2)
    return blocks.select(
        "source",
        "place",
        F.trim(F.get(cut, F.lit(0))).alias("passage_id"),
        F.trim(F.coalesce(F.get(cut, F.lit(1)), F.lit(""))).alias("title"),
        F.regexp_replace("block", r"^[^\n]*\n?\s*|\s+$", "").alias("body"),
    )


def numbered(df: DataFrame, order: list, name: str = "ordinal") -> DataFrame:
    """Ranks from 0 within nothing: for tables of plan size only."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)) - 1)
