"""Keep-or-drop decisions with ordered reasons, and what is counted over them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.payload import NUMERIC_SCORES
from ..functions.text import cue_hits
from ..sources.records import last_write_wins

#: The least scores that pass, in the order of NUMERIC_SCORES, and flags by what they are a defect of.
MINIMA = (4, 3, 3)
DEFECT_FLAGS = ["cue_leakage", "confident_on_unresolved", "formulaic_shape", "quoted_source_text", "archaic_register"]
PROMPT_FLAGS = ["prompt_stipulates_move"]
#: The texts of reasons.
NO_REVIEW = "no reviewer verdict"
REJECTED = "reviewer rejected: "
STILL_REVISE = "reviewer still asks for revision after a rewrite: "
TEMPLATE_SHAPE = "reviewer: fixed template shape rather than a shape this case needed"
STIPULATED = "note: prompt stipulates the target's move; relabelled ordinary"
CONFIDENT = "reviewer: confident resolution of an unresolved tradeoff"
SOFT_CUES = "note: soft cue terms present: "
EXPLICIT = "note: explicit-mode record, cue check skipped"
CUE_LEAK = "reviewer flagged cue leakage the term list did not catch"
ARCHAIC = "reviewer flagged archaic or translated-sounding register, which signals the source as surely as naming it"
QUOTED = "quoted or closely echoed source-text wording"
NOT_CHECKED = "note: intended divergence not checked, no baseline answer for this prompt"
UNVERIFIED = "note: divergence unverified: "
EMPTY = "empty answer"
ORPHAN = "orphan response: its family is missing"


@dataclass
class Policy:
    """What a run's decisions turn on besides its records."""

    forbidden: list[str] = field(default_factory=list)
    soft: list[str] = field(default_factory=list)
    minima: tuple[int, int, int] = MINIMA
    reject_quoted: bool = False
    method: str = "embeddings"
    leakage_cut: float = 0.98


def capped(score: Column, defects: list[Column], most: int = 3) -> Column:
    """A score held down where any defect holds; never raised."""
    any_defect = F.lit(False)
    for d in defects:
        any_defect = any_defect | F.coalesce(d, F.lit(False))
    return F.when(any_defect, F.least(score, F.lit(most))).otherwise(score)


def passes(scores: Column, minima: tuple[int, int, int] = MINIMA) -> Column:
    """Whether the three numeric scores reach their minima; a missing one counts as 0."""
    ok = F.lit(True)
    for name, least in zip(NUMERIC_SCORES, minima):
        ok = ok & (F.coalesce(scores[name], F.lit(0)) >= least)
    return ok


def decide(rows: DataFrame, rules: list[tuple[str | Column, Column, bool]]) -> DataFrame:
    """`rows` with reasons, in the order of `rules` (reason, condition, fatal), and keep: no fatal one holds."""
    hits, fatal = [], F.lit(False)
    for reason, condition, deadly in rules:
        holds = F.coalesce(condition, F.lit(False))
        hits.append(F.when(holds, F.lit(reason) if isinstance(reason, str) else reason))
        if deadly:
            fatal = fatal | holds
    return rows.withColumn("reasons", F.array_compact(F.array(*hits))).withColumn("keep", ~fatal)


def listed(terms: Column) -> Column:
    """A list of terms as a reason shows it: quoted, in brackets."""
    quoted = F.transform(terms, lambda t: F.when(F.contains(t, F.lit("'")) & ~F.contains(t, F.lit('"')), F.concat(F.lit('"'), t, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(t, F.lit("'"), F.lit("\\'")), F.lit("'"))))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def joined_records(responses: DataFrame, prompts: DataFrame, families: DataFrame, reviews: DataFrame, verdicts: DataFrame) -> DataFrame:
    """A row per response whose prompt is known: r, p, f, v and w, the records of the response, its prompt, family, review
    and verdict; the last three null where there is none.  Of records with one key the last counts."""
    last = lambda df, key: last_write_wins(df, [key], "ordinal") if "ordinal" in df.columns else df.dropDuplicates([key])
    whole = lambda df, name, key: last(df, key).select(F.struct(*[c for c in df.columns if c != "ordinal"]).alias(name), F.col(key).alias(f"{name}_key"))
    own = responses.select(F.struct(*[c for c in responses.columns if c != "ordinal"]).alias("r"), *(["ordinal"] if "ordinal" in responses.columns else []))
    return (
        own.join(whole(prompts, "p", "prompt_id"), F.col("r.prompt_id") == F.col("p_key"))
        .join(whole(families, "f", "family_id"), F.col("p.family_id") == F.col("f_key"), "left")
        .join(whole(reviews, "v", "response_id"), F.col("r.response_id") == F.col("v_key"), "left")
        .join(whole(verdicts, "w", "prompt_id"), F.col("r.prompt_id") == F.col("w_key"), "left")
        .drop("p_key", "f_key", "v_key", "w_key")
    )


def decide_responses(joined: DataFrame, policy: Policy, duplicates: DataFrame | None = None, leakage: DataFrame | None = None) -> DataFrame:
    """A decision record for every row of `joined_records`.

    `duplicates` (response_id, duplicate_of) and `leakage` (response_id, score) add what similarity found.  Reasons
    stand in the order in which the checks are made; notes never drop a response.
    """
    rows = joined
    key = F.col("r.response_id")
    for found, name in ((duplicates, "duplicate_of"), (leakage, "score")):
        if found is None:
            rows = rows.withColumn(name, F.lit(None).cast("string" if name == "duplicate_of" else "double"))
        else:
            rows = rows.join(found.select(F.col("response_id").alias("found_id"), name), key == F.col("found_id"), "left").drop("found_id")
    spoken = F.concat(F.coalesce("r.deliberation", F.lit("")), F.lit("\n"), F.coalesce("r.answer", F.lit("")))
    explicit, reviewed = F.col("p.mode") == "explicit", F.col("v.response_id").isNotNull()
    flag = lambda name: F.coalesce(F.col(f"v.scores.{name}"), F.lit(False))
    rows = rows.withColumns(
        {
            "soft": F.array_sort(F.array_union(cue_hits(F.col("p.text"), policy.soft), cue_hits(spoken, policy.soft))),
            "in_prompt": F.when(~explicit, cue_hits(F.col("p.text"), policy.forbidden)).otherwise(F.array().cast("array<string>")),
            "in_response": F.when(~explicit, cue_hits(spoken, policy.forbidden)).otherwise(F.array().cast("array<string>")),
        }
    )
    cued = (F.size("in_prompt") > 0) | (F.size("in_response") > 0)
    shown = lambda c: F.when(F.size(c) > 0, listed(F.col(c))).otherwise(F.lit("none"))
    intended = F.col("p.case_type") == "divergence"
    judged_as = intended & ~flag("prompt_stipulates_move")
    unjudged = F.coalesce(F.col("w.unverified_reason"), F.lit("")) != ""
    has_verdict, diverges = F.col("w.prompt_id").isNotNull(), F.coalesce("w.diverges", F.lit(False))
    not_confirmed = judged_as & has_verdict & ~unjudged & ~diverges
    leaked = F.col("score") >= policy.leakage_cut
    score = lambda name: F.coalesce(F.col(f"v.scores.{name}").cast("string"), F.lit("None"))
    scores_text = F.concat(F.lit("scores below thresholds: fidelity="), score("fidelity"), F.lit(" judgment="), score("judgment_not_terminology"), F.lit(" scenario="), score("scenario_quality"))
    too_close = F.concat(F.lit(f"eval item too close to training data ({policy.method} "), F.format_string("%.3f", "score"), F.lit(f" >= {round(policy.leakage_cut, 4)})"))
    did_not_hold = F.concat(F.lit("note: intended divergence did not hold against the baseline ("), F.substring(F.coalesce("w.explanation", F.lit("")), 1, 120), F.lit("); relabelled ordinary"))
    rationale = F.substring(F.coalesce("v.rationale", F.lit("")), 1, 160)
    decided = decide(
        rows,
        [
            (NO_REVIEW, ~reviewed, True),
            (F.concat(F.lit(REJECTED), rationale), F.col("v.verdict") == "reject", True),
            (F.concat(F.lit(STILL_REVISE), rationale), F.col("v.verdict") == "revise", True),
            (TEMPLATE_SHAPE, flag("formulaic_shape"), True),
            (STIPULATED, flag("prompt_stipulates_move") & intended, False),
            (scores_text, reviewed & ~passes(F.col("v.scores"), policy.minima), True),
            (CONFIDENT, flag("confident_on_unresolved"), True),
            (F.concat(F.lit(SOFT_CUES), listed(F.col("soft"))), F.size("soft") > 0, False),
            (EXPLICIT, explicit, False),
            (F.concat(F.lit("cue terms found (prompt: "), shown("in_prompt"), F.lit(", response: "), shown("in_response"), F.lit(")")), cued, True),
            (CUE_LEAK, ~explicit & ~cued & flag("cue_leakage"), True),
            (ARCHAIC, ~explicit & ~cued & ~flag("cue_leakage") & flag("archaic_register"), True),
            (QUOTED if policy.reject_quoted else f"note: {QUOTED}", flag("quoted_source_text"), policy.reject_quoted),
            (F.concat(F.lit("near-duplicate of "), "duplicate_of", F.lit(f" ({policy.method})")), F.col("duplicate_of").isNotNull(), True),
            (too_close, leaked, True),
            (NOT_CHECKED, judged_as & ~has_verdict, False),
            (F.concat(F.lit(UNVERIFIED), "w.unverified_reason"), judged_as & has_verdict & unjudged, False),
            (did_not_hold, not_confirmed, False),
            (EMPTY, F.trim(F.regexp_replace(F.coalesce("r.answer", F.lit("")), r"(?U)\s+", " ")) == "", True),
            (ORPHAN, F.col("f.family_id").isNull(), True),
        ],
    )
    status = F.when(~F.coalesce(judged_as, F.lit(False)), "not_applicable").when(~has_verdict | unjudged, "unverified").when(diverges, "confirmed").otherwise("not_confirmed")
    judged = has_verdict & ~unjudged & F.coalesce(judged_as, F.lit(False))
    return decided.select(
        key.alias("response_id"),
        "keep",
        "reasons",
        F.when(flag("prompt_stipulates_move") | F.coalesce(not_confirmed, F.lit(False)), "ordinary").otherwise(F.col("p.case_type")).alias("final_case_type"),
        "duplicate_of",
        F.bround("score", 4).alias("max_leakage"),
        status.alias("divergence_status"),
        F.when(judged, F.coalesce("w.kind", F.lit(""))).otherwise("").alias("divergence_kind"),
        F.when(judged, F.coalesce("w.divergence_source", F.lit(""))).otherwise("").alias("divergence_source"),
        F.col("soft").alias("soft_cue_hits"),
        *(["ordinal"] if "ordinal" in joined.columns else []),
    )


def comparable(rows: DataFrame) -> DataFrame:
    """`rows` (prompt_id, base, generic: baseline records or null) with unverified_reason: why the legs can't be judged, or ''."""
    cut = lambda leg: is_truncated(F.col(f"{leg}.finish_reason"), F.col(f"{leg}.text"))
    why = F.coalesce(F.nullif(F.col("base.finish_reason"), F.lit("")), F.lit("no terminal punctuation"))
    reasons = F.array_compact(
        F.array(
            F.when(cut("base"), F.concat(F.lit("base answer cut off ("), why, F.lit(")"))),
            F.when(F.col("generic.prompt_id").isNull(), "no strong generic answer; run the baseline stage").when(cut("generic"), "strong generic answer cut off"),
        )
    )
    return rows.withColumn("unverified_reason", F.array_join(reasons, "; "))


def is_truncated(finish_reason: Column, text: Column) -> Column:
    """Whether an answer was cut off or is blank."""
    return (F.coalesce(finish_reason, F.lit("")) == "length") | (F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " ")) == "")


def summary(decisions: DataFrame, joined: DataFrame) -> DataFrame:
    """One row of counts over decisions and the reviews and prompts they were made from."""
    of = joined.select(F.col("r.response_id").alias("response_id"), F.col("p.mode").alias("mode"), F.col("v.scores").alias("scores"), F.col("f.split").alias("split"))
    rows = decisions.join(of, "response_id", "left")
    status, kind = F.col("divergence_status"), F.col("divergence_kind")
    starts = lambda prefix: F.exists("reasons", lambda r: r.startswith(prefix))
    flagged = lambda name: F.coalesce(F.col(f"scores.{name}"), F.lit(False))
    n = F.count_if
    return rows.agg(
        F.count("*").alias("responses"),
        n("keep").alias("kept"),
        n(~F.col("keep")).alias("dropped"),
        F.count_distinct("duplicate_of").alias("duplicate_clusters"),
        n(F.col("duplicate_of").isNotNull()).alias("duplicates"),
        n(starts("cue terms found")).alias("cue_hits"),
        n(F.col("split") == "eval").alias("eval_items_checked_for_leakage"),
        F.coalesce(F.max("max_leakage"), F.lit(0.0)).alias("max_leakage_seen"),
        *(n(status == s).alias(f"divergence_{s}") for s in ("confirmed", "not_confirmed", "unverified")),
        n((status == "confirmed") & kind.isin("action", "both")).alias("divergence_action"),
        n((status == "confirmed") & kind.isin("reasons", "both")).alias("divergence_reasons"),
        n((status == "confirmed") & (kind == "reasons")).alias("divergence_reasons_only"),
        n((status == "confirmed") & (kind == "both")).alias("divergence_both"),
        n(F.size("soft_cue_hits") > 0).alias("soft_cue_flags"),
        n(F.col("mode") == "explicit").alias("explicit_mode_records"),
        n(flagged("quoted_source_text")).alias("quoted_source_flags"),
        n(flagged("archaic_register")).alias("archaic_register_flags"),
        n(flagged("prompt_stipulates_move")).alias("stipulating_prompts"),
    )


def family_rates(verdicts: DataFrame) -> DataFrame:
    """One row of rates from (family, source): a family counts under `value` if every judged row is, under `any` if one is.

    Unverified rows (source null) aren't judged; every family is intended, judged or not; rates are over the intended.
    """
    per = verdicts.groupBy("family").agg(
        F.max(F.col("source").isNotNull()).alias("judged"),
        F.min(F.when(F.col("source").isNotNull(), F.col("source") == "value")).alias("every"),
        F.max(F.when(F.col("source").isNotNull(), F.col("source") == "value")).alias("some"),
    )
    counts = per.agg(
        F.count("*").alias("intended"), F.count_if("judged").alias("judged"), F.count_if(F.coalesce("every", F.lit(False))).alias("n_value"), F.count_if(F.coalesce("some", F.lit(False))).alias("n_any")
    )
    rate = lambda c: F.when(F.col("intended") > 0, F.bround(F.col(c) / F.col("intended"), 3)).otherwise(F.lit(0.0))
    return counts.select("*", rate("n_value").alias("value_rate"), rate("n_any").alias("any_rate"))


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    """(name, n): how often the legs differ, how many verdicts were judged, and what the candidate was nearer to."""
    counted = {
        "candidate_vs_base": F.col("diverges_vs_base"),
        "candidate_vs_strong_generic": F.col("diverges_vs_generic"),
        "strong_generic_vs_base": F.col("generic_differs_from_base"),
        "judged": F.coalesce("unverified_reason", F.lit("")) == "",
    }
    names = F.array_compact(
        F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in counted.items()), F.when(F.coalesce("closer_to", F.lit("")) != "", F.concat(F.lit("closer_to:"), "closer_to")))
    )
    return verdicts.select(F.explode(names).alias("name")).groupBy("name").agg(F.count("*").alias("n"))


def three_way(verdicts: DataFrame) -> DataFrame:
    """One row per family (family_id) of `verdicts`: which legs differ and what the difference is attributed to.

    Runs from before the three-way comparison have its fields at their defaults: there a divergence stands for a
    difference from the base, and, where only closer_to was recorded, one from the generic answer.
    """
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    some = lambda c: F.coalesce(F.max(c), F.lit(False))
    source = F.coalesce("divergence_source", F.lit(""))
    recorded = (F.coalesce("generic_action", F.lit("")) != "") | (F.coalesce("closer_to", F.lit("")) != "") | yes("diverges_vs_generic") | yes("generic_differs_from_base")
    return verdicts.groupBy("family_id").agg(
        some(yes("diverges_vs_base")).alias("vs_base"),
        some(yes("diverges")).alias("diverges"),
        some(yes("diverges_vs_generic")).alias("vs_generic"),
        some(F.coalesce("closer_to", F.lit("")).isin("candidate", "equidistant")).alias("vs_generic_older"),
        some(yes("generic_differs_from_base")).alias("generic_vs_base"),
        F.min(source == "value").alias("every_value"),
        some(source == "value").alias("any_value"),
        some(source == "stipulated").alias("any_stipulated"),
        some(recorded).alias("recorded"),
    )


def three_way_summary(families: DataFrame) -> DataFrame:
    """One row over `three_way`: families by comparison and attribution, with the fallbacks for older runs."""
    n = F.count_if
    base, generic = n("vs_base"), n("vs_generic")
    recorded = F.coalesce(F.max("recorded"), F.lit(False))
    return families.agg(
        F.count("*").alias("families"),
        F.when(base > 0, base).otherwise(n("diverges")).alias("candidate_vs_base"),
        F.when(recorded & (generic == 0), n("vs_generic_older")).otherwise(generic).alias("candidate_vs_generic"),
        n("generic_vs_base").alias("generic_vs_base"),
        n("every_value").alias("value_every_prompt"),
        n("any_value").alias("value_any_prompt"),
        n("any_stipulated").alias("stipulated"),
        recorded.alias("three_way_recorded"),
    )


def agreement(first: DataFrame, second: DataFrame, key: str = "id") -> DataFrame:
    """One row comparing two reviewers' (id, score, verdict) on the rows that both have."""
    both = _two_reviews(first, second, key)
    apart = F.abs(F.col("a") - F.col("b"))
    return both.agg(
        F.count("*").alias("n"),
        F.round(F.avg("a"), 6).alias("mean_first"),
        F.round(F.avg("b"), 6).alias("mean_second"),
        F.count_if(apart == 0).alias("exact"),
        F.count_if(apart <= 1).alias("within_one"),
        F.count_if(F.col("va") == F.col("vb")).alias("same_verdict"),
    )


def _two_reviews(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    sides = [df.select(key, F.col("score").alias(s), F.col("verdict").alias(f"v{s}")) for df, s in ((first, "a"), (second, "b"))]
    return sides[0].join(sides[1], key)


def second_verdicts(first: DataFrame, second: DataFrame, key: str = "id") -> DataFrame:
    """(verdict, n, disagree): how often the second reviewer gave each verdict on shared rows, and how often against the first."""
    both = _two_reviews(first, second, key)
    return both.groupBy(F.col("vb").alias("verdict")).agg(F.count("*").alias("n"), F.count_if(F.col("va") != F.col("vb")).alias("disagree"))


def disagreements(first: DataFrame, second: DataFrame, key: str = "id", most: int = 5) -> DataFrame:
    """(id, first, second) of the first few shared rows whose verdicts differ."""
    both = _two_reviews(first, second, key).where("va != vb")
    return both.orderBy(key).limit(most).select(key, F.col("va").alias("first"), F.col("vb").alias("second"))


def mean_scores(reviews: DataFrame) -> DataFrame:
    """One row: means of the numeric scores, a missing one as 0, and shares of two flags."""
    numbers = [F.avg(F.coalesce(F.col(f"scores.{n}"), F.lit(0))).alias(n) for n in NUMERIC_SCORES]
    return reviews.agg(*numbers, *(F.avg(F.coalesce(F.col(f"scores.{n}"), F.lit(False)).cast("int")).alias(n) for n in ("cue_leakage", "confident_on_unresolved")))


def flag_conflicts(reviews: DataFrame, flags: list[str], scores: list[str], top: int = 5) -> DataFrame:
    """(flag, score, n): reviews that raise a defect flag and yet give a top score, per pair of the two."""
    raised = F.array_compact(F.array(*(F.when(F.col(f), F.lit(f)) for f in flags)))
    given = F.array_compact(F.array(*(F.when(F.col(s) >= top, F.lit(s)) for s in scores)))
    return reviews.select(F.explode(raised).alias("flag"), given.alias("given")).select("flag", F.explode("given").alias("score")).groupBy("flag", "score").agg(F.count("*").alias("n"))


def conflict_summary(reviews: DataFrame) -> DataFrame:
    """One row: reviews with a defect flag and a 5, reviews in all, and prompts that stipulate the move."""
    any_of = lambda names: F.exists(F.array(*(F.coalesce(F.col(f"scores.{n}"), F.lit(False)) for n in names)), lambda x: x)
    fives = F.exists(F.array(*(F.coalesce(F.col(f"scores.{n}"), F.lit(0)) >= 5 for n in NUMERIC_SCORES)), lambda x: x)
    return reviews.agg(
        F.count_if(any_of(DEFECT_FLAGS) & fives).alias("reviews_with_flag_and_five"), F.count("*").alias("reviews_total"), F.count_if(any_of(PROMPT_FLAGS)).alias("stipulating_prompts")
    )
