"""House style: n-grams that a share of a label's texts contain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ngrams, style_words

SHOWN, SHARED, N = 0.30, 0.15, 4


def presence(texts: DataFrame, n: int = N) -> DataFrame:
    """(label, phrase, share) of `texts` (label, text): the share of the label's texts that contain the phrase."""
    sizes = texts.groupBy("label").agg(F.count("*").alias("texts"))
    phrases = texts.select("label", F.explode(ngrams(style_words(F.col("text")), n)).alias("phrase")).groupBy("label", "phrase").agg(F.count("*").alias("n"))
    return phrases.join(F.broadcast(sizes), "label").select("label", "phrase", (F.col("n") / F.col("texts")).alias("share"))


def style_table(shares: DataFrame, least: float = SHOWN, top: int = 15) -> DataFrame:
    """(phrase, labels, mean): phrases habitual in some label, by the number of such labels and the mean share."""
    own = shares.groupBy("phrase").agg(F.count_if(F.col("share") >= least).alias("labels"), F.avg("share").alias("mean"))
    return own.where("labels > 0").orderBy(F.desc("labels"), F.desc(F.round("mean", 9)), "phrase").limit(top)


def style_pivot(shares: DataFrame, labels: list[str], least: float = SHOWN, top: int = 15) -> DataFrame:
    """`style_table` with a column of the share for each label."""
    best = style_table(shares, least, top)
    per = shares.join(F.broadcast(best.select("phrase")), "phrase").groupBy("phrase").pivot("label", labels).agg(F.first("share"))
    return best.join(per, "phrase").select("phrase", F.col("labels"), "mean", *(F.coalesce(F.col(f"`{x}`"), F.lit(0.0)).alias(x) for x in labels))


def shared_style(shares: DataFrame, least: float) -> DataFrame:
    """(a, b, jaccard) of every two labels' sets of habitual phrases.

    A phrase meets the labels that share it, few as they are; the sets themselves are only counted, never gathered.
    """
    habits = shares.where(F.col("share") >= least).select("label", "phrase")
    sizes = habits.groupBy("label").agg(F.count("*").alias("n"))
    per = habits.groupBy("phrase").agg(F.sort_array(F.collect_list("label")).alias("of"))
    two = F.flatten(F.transform("of", lambda a: F.transform(F.filter("of", lambda b: a < b), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    both = per.select(F.explode(two).alias("it")).groupBy(F.col("it.a").alias("a"), F.col("it.b").alias("b")).agg(F.count("*").alias("n"))
    sides = [sizes.select(F.col("label").alias(x), F.col("n").alias(f"n{x}")) for x in "ab"]
    every = sides[0].join(sides[1], F.col("a") < F.col("b"))
    return every.join(both, ["a", "b"], "left").select("a", "b", (F.coalesce("n", F.lit(0)) / (F.col("na") + F.col("nb") - F.coalesce("n", F.lit(0)))).alias("jaccard"))


def style_score(shares: DataFrame, least: float) -> DataFrame:
    """One row: habitual phrases in all, those of two labels or more, and the mean overlap of two labels' sets.

    Labels without a habitual phrase make no pair with each other, and a pair with one counts as 0.
    """
    habits = shares.where(F.col("share") >= least)
    phrases = habits.groupBy("phrase").agg(F.count("*").alias("labels")).agg(F.count("*").alias("habitual"), F.count_if(F.col("labels") >= 2).alias("shared_by_two"))
    n = shares.select("label").distinct().count()
    full = habits.select("label").distinct().count()
    pairs = full * (full - 1) // 2 + full * (n - full)
    overlap = shared_style(shares, least).agg(F.coalesce(F.sum("jaccard"), F.lit(0.0)).alias("total"))
    return phrases.join(overlap, how="cross").select(F.lit(least).alias("least"), "habitual", "shared_by_two", (F.col("total") / F.lit(max(pairs, 1))).alias("mean_overlap"))


def habit_counts(shares: DataFrame, least: float) -> DataFrame:
    """(label, habitual): how many habitual phrases each label has."""
    return shares.groupBy("label").agg(F.count_if(F.col("share") >= least).alias("habitual"))


def answer_texts(responses: DataFrame) -> DataFrame:
    """`responses` (label, deliberation, answer) as (label, text): both halves, as they are exported; blank ones dropped."""
    both = F.concat(F.coalesce("deliberation", F.lit("")), F.lit("\n"), F.coalesce("answer", F.lit("")))
    return responses.select("label", F.regexp_replace(both, r"(?U)^\s+|\s+$", "").alias("text")).where("text != ''")
