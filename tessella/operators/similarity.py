"""The robust threshold, order-preserving near-duplicates and leakage over pair scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .pairs import ListedScores, Scores, TokenScores, VectorScores

SIGMAS, FLOOR, CEILING = 3.0, 0.0, 0.98
SAME_GROUP = 0.985
FEW_EDGES = 1 << 17


def calibrate(scores: Scores, sigmas: float = SIGMAS, floor: float = FLOOR, ceiling: float = CEILING) -> dict:
    """n, centre, spread, cut and the statistic's text: median + sigmas * 1.4826 * MAD, held between floor and ceiling.

    Without spread, the least gap between neighbouring scores stands in; with fewer than two scores the cut is that of a
    score of 1.
    """
    n = scores.count()
    centre = spread = 0.0
    if n:
        middle = ((n - 1) // 2, n // 2) if n % 2 == 0 else (n // 2,)
        low, high = -1.0 - 1e-9, 1.0 + 1e-9
        found = scores.at_ranks(middle, low, high)
        centre = sum(found) / len(found)
    cut = 1.0
    if n > 1:
        away = scores.at_ranks(middle, 0.0, 2.0 + 1e-9, centre)
        spread = 1.4826 * sum(away) / len(away)
        spread = spread if spread > 0 else scores.least_gap()
        cut = centre + sigmas * spread
    return {"n": n, "centre": centre, "spread": spread, "cut": min(max(cut, floor), ceiling), "sigmas": sigmas, "statistic": f"median + {sigmas:g} x robust_sd"}


def calibration_row(spark: SparkSession, found: dict) -> DataFrame:
    """The record of a calibration that a report prints."""
    return spark.createDataFrame(
        [(found["n"], found["centre"], found["spread"], found["cut"], found["sigmas"], found["statistic"])],
        "n long, centre double, spread double, cut double, sigmas double, statistic string",
    )


def robust_threshold(scores: DataFrame, zeros: int = 0, sigmas: float = SIGMAS, floor: float = FLOOR, ceiling: float = CEILING) -> DataFrame:
    """`calibrate` over column `score` of a table, with `zeros` further scores of 0."""
    return calibration_row(scores.sparkSession, calibrate(ListedScores(scores, zeros), sigmas, floor, ceiling))


def scores_of(rows: DataFrame, vectors: bool) -> tuple[Scores, str]:
    """The pair scores of `rows` (id, vector or text) by the method at hand, and its name: cosines where there are
    vectors, else Jaccard similarities of token sets."""
    if vectors:
        return VectorScores(rows), "embeddings"
    return TokenScores(rows, rows, within=True), "jaccard"


def duplicate_edges(scores: Scores, cut: float, groups: DataFrame | None = None, same_group: float | None = SAME_GROUP) -> DataFrame:
    """(a_id, b_id, score) of the pairs that count as near-duplicates, a_id before b_id.

    With `groups` (id, group, never), rows of one group are held against `same_group` instead of `cut` (None: never
    compared), and rows with an equal `never` are not compared at all.
    """
    least = cut if groups is None or same_group is None else min(cut, same_group)
    found = scores.at_least(least).where("a_id < b_id")
    if groups is None:
        return found
    sides = [groups.select(F.col("id").alias(f"{x}_id"), F.col("group").alias(f"{x}_group"), F.col("never").alias(f"{x}_never")) for x in "ab"]
    joined = found.join(sides[0], "a_id").join(sides[1], "b_id")
    bar = F.when(F.col("a_group") == F.col("b_group"), F.lit(same_group).cast("double")).otherwise(F.lit(cut))
    apart = F.coalesce(F.col("a_never") != F.col("b_never"), F.lit(True))
    return joined.where(apart & (F.col("score") >= bar)).select("a_id", "b_id", "score")


def greedy_duplicates(nodes: DataFrame, edges: DataFrame, few_edges: int = FEW_EDGES) -> DataFrame:
    """(id, duplicate_of, score) of nodes (id): as if rows came one by one and each was held against the kept ones.

    `edges` (a_id, b_id, score), a_id before b_id, are the pairs over their threshold.  A row is a duplicate once an
    earlier neighbour is kept, and kept once all earlier neighbours are duplicates; every round settles at least
    the first open row of each chain, and rounds go on until no row is open.  Once at most `few_edges` edges lead to open
    rows, one pass in order settles them, so a long chain doesn't cost a round a row.  duplicate_of is the kept earlier
    neighbour of the best score, the earliest of equals.
    """
    from .shared import settled_table

    edges = settled_table(edges.where("score > 0").select("a_id", "b_id", "score"), "edges")
    state = settled_table(edges.select(F.col("b_id").alias("id")).distinct().withColumn("kept", F.lit(None).cast("boolean")), "state")
    first = edges.select(F.col("a_id").alias("id")).distinct().join(state.select("id"), "id", "left_anti").withColumn("kept", F.lit(True))
    state = settled_table(state.union(first), "state")
    left = state.where("kept is null").count()
    while left:
        opened = edges.join(state.where("kept is null").select(F.col("id").alias("b_id")), "b_id")
        around = opened.join(state.select(F.col("id").alias("a_id"), F.col("kept").alias("a_kept")), "a_id").select("a_id", "b_id", "a_kept")
        if len(rows := around.take(few_edges + 1)) <= few_edges:
            known = {r["b_id"]: True for r in rows}
            for r in sorted(rows, key=lambda r: (r["b_id"], r["a_id"])):
                if known[r["b_id"]]:
                    known[r["b_id"]] = not (r["a_kept"] if r["a_kept"] is not None else known[r["a_id"]])
            passed = state.sparkSession.createDataFrame(list(known.items()), "id long, passed boolean")
            state = settled_table(state.join(passed, "id", "left").select("id", F.coalesce("kept", "passed").alias("kept")), "state")
        else:
            seen = around.groupBy(F.col("b_id").alias("id")).agg(F.max(F.coalesce("a_kept", F.lit(False))).alias("by_kept"), F.min(F.col("a_kept").isNotNull()).alias("all_known"))
            state = settled_table(
                state.join(seen, "id", "left").select(
                    "id", F.coalesce("kept", F.when(F.col("by_kept"), F.lit(False)).when(F.col("all_known"), F.lit(True))).alias("kept")
                ),
                "state",
            )
        before, left = left, state.where("kept is null").count()
        if left == before:
            raise RuntimeError("the duplicates did not settle: an edge leads to an earlier row")
    kept = state.where("kept").select(F.col("id").alias("a_id"))
    lost = state.where("not kept").select(F.col("id").alias("b_id"))
    best = edges.join(kept, "a_id").join(lost, "b_id").groupBy("b_id").agg(F.max(F.struct("score", (-F.col("a_id")).alias("earlier"))).alias("it"))
    found = best.select(F.col("b_id").alias("id"), (-F.col("it.earlier")).alias("duplicate_of"), F.col("it.score").alias("score"))
    return nodes.select("id").join(found, "id", "left")


def best_match(scores: Scores, items: DataFrame) -> DataFrame:
    """(id, best_id, score) of every item (id): the match of the highest score, the lowest id of equals; 0.0 and null without any."""
    top = scores.best().withColumnRenamed("a_id", "id")
    return items.select("id").join(top, "id", "left").select("id", F.col("b_id").alias("best_id"), F.coalesce("score", F.lit(0.0)).alias("score"))


def duplicate_clusters(found: DataFrame, order: Column | str = "id") -> DataFrame:
    """(duplicate_of, members): what each representative of `greedy_duplicates` absorbs, in order."""
    lost = found.where("duplicate_of is not null")
    members = F.transform(F.array_sort(F.collect_list(F.struct(F.expr(order).alias("at") if isinstance(order, str) else order.alias("at"), F.col("id")))), lambda x: x["id"])
    return lost.groupBy("duplicate_of").agg(members.alias("members"))
