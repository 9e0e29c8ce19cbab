"""Roll-ups of a usage ledger in which one unpriced call makes a total unknown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import small


def priced(ledger: DataFrame, prices: DataFrame) -> DataFrame:
    """`ledger` with cost_usd filled from `prices` (model, input, output per million), by full name or its last path segment."""
    whole = small(prices.select(F.col("model"), F.col("input").alias("i1"), F.col("output").alias("o1")))
    last = small(prices.select(F.col("model").alias("tail"), F.col("input").alias("i2"), F.col("output").alias("o2")))
    joined = ledger.join(whole, "model", "left").withColumn("tail", F.element_at(F.split("model", "/"), -1)).join(last, "tail", "left")
    cost = (F.col("prompt_tokens") * F.coalesce("i1", "i2") + F.col("completion_tokens") * F.coalesce("o1", "o2")) / 1e6
    return joined.withColumn("cost_usd", F.coalesce("cost_usd", cost)).select(ledger.columns)


def rollup(ledger: DataFrame) -> DataFrame:
    """Totals, by stage and by model: calls, tokens, known cost, and whether the cost is known in full."""
    grouped = ledger.groupingSets([[], ["stage"], ["model"]], "stage", "model").agg(
        F.count("*").alias("calls"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.round(F.sum("cost_usd"), 4).alias("cost_usd"),
        F.min(F.col("cost_usd").isNotNull()).alias("cost_known"),
        F.grouping_id().alias("gid"),
    )
    level = F.when(F.col("gid") == 3, "total").when(F.col("gid") == 1, "stage").otherwise("model")
    return grouped.select(level.alias("level"), F.coalesce("stage", "model", F.lit("")).alias("name"), "calls", "prompt_tokens", "completion_tokens", "cost_usd", "cost_known")


def unpriced_models(ledger: DataFrame) -> DataFrame:
    """(model) of the models with a call of unknown cost, in order."""
    return ledger.where("cost_usd is null").select("model").distinct().orderBy("model")


def cost_text(known: Column, cost: Column) -> Column:
    amount = F.format_string("$%.4f", F.coalesce(cost, F.lit(0.0)))
    return F.when(known, amount).otherwise(F.concat(F.lit("unknown (at least "), amount, F.lit(")")))
