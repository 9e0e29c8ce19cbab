"""The tables of a run's report, and the page that holds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import shortened
from ..schema import ASKER_STANCE_MIX

#: The beginnings by which reasons are counted together, the longer before those that they begin with.
REASON_BUCKETS = [
    "reviewer rejected",
    "reviewer still asks for revision after a rewrite",
    "note: reviewer asked for revision but all scores pass thresholds",
    "reviewer asked for revision",
    "reviewer: fixed template shape",
    "scores below thresholds",
    "reviewer: confident resolution",
    "cue terms found",
    "reviewer flagged cue leakage",
    "near-duplicate of",
    "eval item too close to training data",
    "note: intended divergence did not hold",
    "note: intended divergence not checked",
    "note: soft cue terms present",
    "note: explicit-mode record",
    "note: quoted or closely echoed source-text wording",
    "quoted or closely echoed source-text wording",
    "reviewer flagged archaic or translated-sounding register",
    "no reviewer verdict",
    "empty answer",
    "orphan response",
]
UNBUCKETED = 60


def reason_bucket(reason: Column) -> Column:
    """The kind of a reason; the beginning of one of no kind."""
    out = F.substring(reason, 1, UNBUCKETED)
    for prefix in reversed(REASON_BUCKETS):
        out = F.when(reason.startswith(prefix), F.lit(prefix)).otherwise(out)
    return out


def reason_counts(decisions: DataFrame) -> DataFrame:
    """(bucket, n) of the reasons of dropped responses."""
    return decisions.where("not keep").select(F.explode("reasons").alias("reason")).groupBy(reason_bucket(F.col("reason")).alias("bucket")).agg(F.count("*").alias("n"))


def top_leakage(decisions: DataFrame, k: int = 5) -> DataFrame:
    """(response_id, max_leakage) of the responses nearest to training data, of equals those of the last ids."""
    return decisions.where("max_leakage is not null").orderBy(F.desc("max_leakage"), F.desc("response_id")).limit(k).select("response_id", "max_leakage")


def closest_pairs(pairs: DataFrame, k: int = 10) -> DataFrame:
    """`pairs` (kind, a_id, b_id, score, ...) with place: the k closest of each kind, flagged or not."""
    own = Window.partitionBy("kind").orderBy(F.desc("score"), "a_id", "b_id")
    return pairs.withColumn("place", F.row_number().over(own)).where(F.col("place") <= k)


def described_pairs(pairs: DataFrame, ends: DataFrame, kind: str, cut: float) -> DataFrame:
    """`pairs` (a_id, b_id, score) with the family and the split of either end (id, family, split), and whether the cut flags them."""
    for side in "ab":
        own = ends.select(F.col("id").alias(f"{side}_id"), F.col("family").alias(f"{side}_family"), F.coalesce("split", F.lit("")).alias(f"{side}_split"))
        pairs = pairs.join(own, f"{side}_id", "left")
    return pairs.select(F.lit(kind).alias("kind"), "a_id", "b_id", "a_family", "b_family", "a_split", "b_split", F.bround("score", 4).alias("score"), (F.col("score") >= cut).alias("flagged"), F.lit(round(cut, 4)).alias("threshold"))


def samples(decisions: DataFrame, responses: DataFrame, keep: bool, k: int, limit: int = 400) -> DataFrame:
    """The first k kept or dropped decisions in the run's order, with the beginnings of their answers."""
    own = decisions.where(F.col("keep") == keep).orderBy("ordinal").limit(k)
    return own.join(responses.select("response_id", "answer"), "response_id", "left").select("ordinal", "response_id", F.array_join("reasons", "; ").alias("reasons"), shortened(F.coalesce("answer", F.lit("")), limit).alias("answer"))


def most_common(rows: DataFrame, column: str, k: int, order: str = "ordinal") -> DataFrame:
    """(value, n, place) of the k most frequent values, of equals the first seen."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    best = counts.orderBy(F.desc("n"), "seen").limit(k)
    return best.select("value", "n", F.row_number().over(Window.orderBy(F.desc("n"), "seen")).alias("place"))


def count_table(rows: DataFrame, column: str) -> DataFrame:
    """(value, n, share) of a column; the share of all rows."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total"))
    return counts.join(F.broadcast(total), how="cross").select("value", "n", (F.col("n") / F.col("total")).alias("share"))


def feature_spread(families: DataFrame, k: int = 4) -> DataFrame:
    """(feature, value, n, place): the k most frequent values of every situation feature, of equals the first seen."""
    each = families.select("ordinal", F.explode("situation_features").alias("feature", "value")).where("coalesce(value, '') != ''")
    counts = each.groupBy("feature", "value").agg(F.count("*").alias("n"), F.min("ordinal").alias("seen"))
    own = Window.partitionBy("feature").orderBy(F.desc("n"), "seen")
    return counts.withColumn("place", F.row_number().over(own)).where(F.col("place") <= k).drop("seen")


def tradeoff_coverage(families: DataFrame, tradeoffs: DataFrame) -> DataFrame:
    """(tradeoff, families, unresolved, known): uses of every tradeoff (id, unresolved) of the spec and of any other that
    families (tradeoff_ids) carry; 0 families where it was never used, known false where the spec lacks it."""
    used = families.select(F.explode("tradeoff_ids").alias("id")).groupBy("id").agg(F.count("*").alias("families"))
    both = used.join(tradeoffs.select("id", "unresolved", F.lit(True).alias("known")), "id", "full_outer")
    return both.select(F.col("id").alias("tradeoff"), F.coalesce("families", F.lit(0)).alias("families"), F.coalesce("unresolved", F.lit(False)).alias("unresolved"), F.coalesce("known", F.lit(False)).alias("known"))


def hypothesis_coverage(families: DataFrame, hypotheses: DataFrame, per_hundred: float = 1.0) -> DataFrame:
    """(hypothesis, families, short): divergence families (case_type_intent, divergence_hypothesis_id) of every hypothesis
    (id), and whether they are fewer than the floor for a run of this size."""
    floor = max(1, round(families.count() * per_hundred / 100))
    used = families.where("case_type_intent = 'divergence'").groupBy(F.coalesce(F.nullif("divergence_hypothesis_id", F.lit("")), F.lit("(none assigned)")).alias("id")).agg(F.count("*").alias("families"))
    both = used.join(hypotheses.select("id"), "id", "full_outer")
    return both.select(F.col("id").alias("hypothesis"), F.coalesce("families", F.lit(0)).alias("families"), ((F.coalesce("families", F.lit(0)) < floor) & (F.col("id") != "(none assigned)")).alias("short"))


def stance_table(families: DataFrame, mix: dict[str, float] | None = None) -> DataFrame:
    """(stance, families, share, planned): realised stances (asker_stance, situation_features) against the mix."""
    spark, mix = families.sparkSession, mix or ASKER_STANCE_MIX
    recorded = F.coalesce(F.nullif("asker_stance", F.lit("")), F.nullif(F.try_element_at("situation_features", F.lit("asker_stance")), F.lit("")), F.lit("(not recorded)"))
    real = count_table(families.select(recorded.alias("stance")), "stance")
    planned = spark.createDataFrame(list(mix.items()), "value string, planned double")
    return real.join(planned, "value", "full_outer").select(F.col("value").alias("stance"), F.coalesce("n", F.lit(0)).alias("families"), F.coalesce("share", F.lit(0.0)).alias("share"), "planned")


def eval_composition(families: DataFrame, exported: DataFrame) -> DataFrame:
    """(case_type, planned, exported): eval families by intent against exported eval rows (case_type)."""
    planned = families.where("split = 'eval'").groupBy(F.col("case_type_intent").alias("case_type")).agg(F.count("*").alias("planned"))
    real = exported.groupBy(F.coalesce("case_type", F.lit("?")).alias("case_type")).agg(F.count("*").alias("exported"))
    return planned.join(real, "case_type", "full_outer").select("case_type", F.coalesce("planned", F.lit(0)).alias("planned"), F.coalesce("exported", F.lit(0)).alias("exported"))


# --- the page ------------------------------------------------------------------------------------------------------


def percent(part: float, whole: float | None = None) -> str:
    return "-" if whole == 0 else f"{part / (1 if whole is None else whole):.0%}"


def calibration_line(threshold: float | None, calibration: dict | None) -> str:
    """How a cut came about, from the record that was kept with the pairs."""
    own = calibration or {}
    said = f"Flagged above **{'not recorded' if threshold is None else f'{threshold:.3f}'}**, from {own.get('statistic', 'an unrecorded statistic')}"
    if own.get("centre") is None or own.get("spread") is None:
        return said + "."
    return said + f" over the whole pair distribution (centre {own['centre']:.3f}, spread {own['spread']:.3f})."


def conflict_text(conflicts: dict, pairs: list[tuple[str, str, int]]) -> list[str]:
    """What a report says of reviews that award a 5 and raise a defect flag, and of prompts that give the move away."""
    n, total = conflicts["reviews_with_flag_and_five"], conflicts["reviews_total"]
    lines = [f"Reviews awarding a 5 while raising a defect flag: **{n}** of {total}."]
    if n and pairs:
        lines.append("Conflicting pairs: " + ", ".join(f"{flag}+{score}=5 ×{k}" for flag, score, k in pairs) + ".")
    if conflicts["stipulating_prompts"]:
        lines.append(f"Prompts that stipulate the target's move: **{conflicts['stipulating_prompts']}** of {total}; relabelled ordinary.")
    return lines


def markdown_table(df: DataFrame, order: list | None = None, most: int = 200) -> list[str]:
    """A small table as Markdown, its first `most` rows."""
    rows = (df.orderBy(*order) if order else df).limit(most).collect()
    cell = lambda v: "-" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    return ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(map(cell, r)) + " |" for r in rows)]


def page(title: str, parts: list[tuple[str, DataFrame | list[str] | str]]) -> str:
    """A report: a heading and, under each part's own, its table or its lines."""
    lines = [f"# {title}"]
    for name, part in parts:
        lines += ["", f"## {name}", ""]
        lines += markdown_table(part) if isinstance(part, DataFrame) else [part] if isinstance(part, str) else part
    return "\n".join(lines) + "\n"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A text file, by Spark's own file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
