"""Deterministic quotas, interleaving, cycles and batches as window expressions over plan-sized tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import settled_table, small


def largest_remainder(shares: DataFrame, n: int) -> DataFrame:
    """`shares` (key, weight, place) with quota: floor(weight share * n), then one more by falling fraction, earlier place first."""
    everything = Window.partitionBy()
    exact = F.col("weight") / F.sum("weight").over(everything) * n
    with_floor = shares.withColumn("exact", exact).withColumn("whole", F.floor("exact"))
    left = F.lit(n) - F.sum("whole").over(everything)
    order = Window.orderBy(F.desc(F.round(F.col("exact") - F.col("whole"), 9)), F.asc("place"))
    return with_floor.withColumn("left_over", left).withColumn("quota", F.col("whole") + F.when(F.row_number().over(order) <= F.col("left_over"), 1).otherwise(0)).drop(
        "exact", "whole", "left_over"
    )


def interleaved(quotas: DataFrame, order: Column | str = "place") -> DataFrame:
    """(slot, key): each key `quota` times, dealt in turns until all are spent."""
    turns = quotas.where("quota > 0").select("key", "place", F.explode(F.sequence(F.lit(1), F.col("quota").cast("int"))).alias("turn"))
    return turns.select((F.row_number().over(Window.orderBy("turn", order)) - 1).alias("slot"), "key")


def coverage_cycle(slots: DataFrame, pool: DataFrame) -> DataFrame:
    """`slots` (slot) with the member of `pool` (key, place) that a cycle through the whole pool gives it.

    A slot's rank is the count of the slots in the ranges of rows before its own and its rank there, so no task holds
    more than one range.
    """
    size = pool.count()
    ranked_pool = small(pool.select("key", (F.row_number().over(Window.orderBy("place")) - 1).alias("at")))
    return ranked(slots, "slot").withColumn("at", F.col("rank") % F.lit(max(size, 1))).join(ranked_pool, "at", "left").drop("at", "rank")


def ranked(rows: DataFrame, by: str) -> DataFrame:
    """`rows` with rank: their place from 0 in the order of the distinct values of `by`."""
    dealt = settled_table(rows.repartitionByRange(by).sortWithinPartitions(by).withColumn("range_", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("range_").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = F.row_number().over(Window.partitionBy("range_").orderBy(by)) - 1
    return dealt.withColumn("inner_", inner).join(F.broadcast(counts.select("range_", "before")), "range_").withColumn("rank", F.col("before") + F.col("inner_")).drop("range_", "inner_", "before")


def stratified_pick(rows: DataFrame, count: int, offset: float = 0.0) -> DataFrame:
    """`count` of `rows` (key, stratum, place): each stratum has its share of them, evenly spaced from `offset` on.

    Shares are whole numbers by largest remainder, strata in the order of their names; a stratum whose positions fall
    together is topped up with its first rows, so that `count` rows are chosen wherever there are as many.
    """
    sizes = rows.groupBy("stratum").agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    count = min(count, total)
    if count <= 0:
        return rows.limit(0)
    shares = sizes.select(F.col("stratum").alias("key"), F.col("n").cast("double").alias("weight"), F.col("n").alias("size"), "stratum")
    quota = largest_remainder(shares.withColumn("place", F.col("stratum")), count).select("stratum", "size", "quota")
    ranks = rows.withColumn("rank", F.row_number().over(Window.partitionBy("stratum").orderBy("place")) - 1).join(small(quota), "stratum")
    # Row r is at position k where floor((offset + k) * size / quota) is r; a row may be at several.
    step = F.col("size") / F.col("quota")
    first = F.ceil(F.col("rank") / step - offset)
    hit = F.exists(F.sequence(F.lit(-1), F.lit(1)), lambda d: (first + d >= 0) & (first + d < F.col("quota")) & (F.least(F.col("size") - 1, F.floor(F.lit(offset) * step + (first + d) * step)) == F.col("rank")))
    marked = ranks.where("quota > 0").withColumn("hit", F.coalesce(hit, F.lit(False)))
    own = Window.partitionBy("stratum")
    missed = F.row_number().over(own.orderBy("hit", "rank"))
    topped = marked.withColumns({"lacking": F.col("quota") - F.count_if("hit").over(own), "missed": missed})
    return topped.where(F.col("hit") | (F.col("missed") <= F.col("lacking"))).select(rows.columns)


def even_batches(rows: DataFrame, size: int, by: str = "stratum") -> DataFrame:
    """`rows` with batch: an even number to a batch, the members of a `pair` together and before single rows, so that no batch parts one."""
    even = max(2, size - size % 2)
    order = ([F.coalesce(F.nullif("pair", F.lit("")), F.lit("~"))] if "pair" in rows.columns else []) + [F.col("place")]
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1
    return rows.withColumn("batch", F.floor(rank / even))


def within_budget(rows: DataFrame, budget: int, by: str) -> DataFrame:
    """`rows` (place, length) whose running length stays within the budget; the first of each group always does."""
    own = Window.partitionBy(by).orderBy("place")
    running = F.sum("length").over(own.rowsBetween(Window.unboundedPreceding, 0))
    ranked = rows.withColumns({"running": running, "rank_": F.row_number().over(own)})
    return ranked.where((F.col("running") <= budget) | (F.col("rank_") == 1)).drop("rank_")


def omitted(rows: DataFrame, budget: int, by: str) -> DataFrame:
    """(by, note) of the groups of which `within_budget` leaves rows out: how many."""
    kept = within_budget(rows, budget, by).groupBy(by).agg(F.count("*").alias("kept"))
    whole = rows.groupBy(by).agg(F.count("*").alias("n")).join(kept, by)
    return whole.where("n > kept").select(by, F.format_string("[%d further passages omitted for length]", F.col("n") - F.col("kept")).alias("note"))
