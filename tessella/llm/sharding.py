"""Sharding by proportional stratified interleaving (operator 4, DataFrame functions only).

Rows are shuffled by a seeded digest within their source; the row of rank r among n of its source stands at
(r - 1/2) / n of the whole; all rows are laid out in that order and cut into equal shards.  Every shard then
holds each source in the corpus's proportion, to within one row of each source.

No rank comes from one large window.  Rows fall into slices of the digest (or of the fraction), the square root of
their number in all, so that neither a slice nor the list of slices grows with the table as a whole; slice
counts are summed before the shuffle, their running sums give each slice its first rank, and only the
rows of one slice are sorted together.  A source that holds a third of all rows is spread over all slices.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import table

SEED = "tessella-shards"
N_SHARDS = 40


def _ranked(rows: DataFrame, keys: list[str], bucket: str, order: list, name: str) -> DataFrame:
    """Adds `name`, the rank from 0 within `keys` by `order`, which must refine `bucket`; and `of`, the count in `keys`."""
    sums = rows.groupBy(*keys, bucket).agg(F.count("*").alias("in_bucket"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*(keys or [F.lit(0)]))
    starts = sums.select(
        *keys, bucket, F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("before"), F.sum("in_bucket").over(whole).alias("of")
    )
    inner = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order))
    return (
        rows.withColumn("inner_rank", inner)
        .join(starts, [*keys, bucket])
        .withColumn(name, F.col("before") + F.col("inner_rank") - 1)
        .drop("before", "inner_rank")
    )


def interleaved_shards(docs: DataFrame, n_shards: int = N_SHARDS, seed: str = SEED, buckets: int | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, text, source): its size, shard and slot.

    Law `rows`: shard sizes differ by one row at most.  A null text has size 16 and checksum 0; a null source
    is a source of its own; a null doc_id sorts as an empty one; repeated rows are rows like any other; an
    empty table gives an empty one; other columns are ignored.
    """
    buckets = buckets or max(1, math.isqrt(docs.count()))
    base = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("stratum"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("digest"),
    ).withColumn("slice", F.expr(f"cast(conv(substring(digest, 1, 6), 16, 10) as long) * {buckets} div 16777216"))
    ties = ["doc_id", "text_crc32", "size"]
    ranked = _ranked(base, ["stratum"], "slice", ["digest", *ties], "rank").withColumnRenamed("of", "stratum_rows")
    placed = ranked.select(
        "doc_id", "size", "text_crc32", "stratum", ((F.col("rank") + 0.5) / F.col("stratum_rows")).alias("fraction")
    ).withColumn("slice", F.floor(F.col("fraction") * buckets))
    laid = _ranked(placed, [], "slice", ["fraction", "stratum", *ties], "place")
    shard = F.expr(f"place * {n_shards} div of")
    return laid.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.expr(f"place - (shard * of + {n_shards - 1}) div {n_shards}").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.expr("if(stratum = '', null, substring(stratum, 2))").alias("source"),
    )


def op4_sharding(spark, sf_dir):
    return interleaved_shards(table(spark, sf_dir, "documents"))
