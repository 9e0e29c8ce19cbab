"""What reviewers and judges return, read from loosely typed JSON with expressions that stay in the JVM.

A value counts as true as a script would take it: a string if it isn't empty, a number if it isn't 0, a list or an
object if it has members.  An explicit null is the same as a missing value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import short_id

#: The score keys of a review, the most a capped score may be, and the reasons of a cap.
NUMERIC_SCORES = ["fidelity", "judgment_not_terminology", "scenario_quality"]
SCORE_FLAGS = ["cue_leakage", "confident_on_unresolved", "formulaic_shape", "prompt_stipulates_move", "quoted_source_text", "archaic_register"]
REQUIRED_SCORES = NUMERIC_SCORES + SCORE_FLAGS
JUDGMENT_CAP = 3
NO_QUOTE = "no judgment_evidence_quote"
CAPPING_FLAGS = {
    "formulaic_shape": "a fixed paragraph template is a shape, not judgment about this case",
    "archaic_register": "translated-sounding register signals the source rather than reasoning",
}
#: What a divergence may come from, and what a reply may be nearer to.
SOURCES = ["value", "capability", "stipulated", "none"]
NEARER = ["generic", "weak", "neither"]
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def field(payload: Column, path: str) -> Column:
    """The variant at `path` of a variant; null where there is none."""
    return F.try_variant_get(payload, f"$.{path}", "variant")


def text_of(value: Column) -> Column:
    """A variant as trimmed text, '' where it is null."""
    return F.regexp_replace(F.coalesce(F.try_variant_get(value, "$", "string"), F.lit("")), r"(?U)^\s+|\s+$", "")


def truthy(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    plain = F.try_variant_get(value, "$", "string")
    return F.coalesce(
        F.when(kind == "STRING", plain != "")
        .when(kind == "BOOLEAN", plain == "true")
        .when(kind == "VOID", F.lit(False))
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .when(kind.startswith("ARRAY"), F.size(F.try_variant_get(value, "$", "array<variant>")) > 0)
        .otherwise(F.try_variant_get(value, "$", "double") != 0),
        F.lit(False),
    )


def as_number(value: Column, otherwise: float = 0.0) -> Column:
    """A number or its text as a double; anything else, and what isn't finite, as `otherwise`."""
    plain = F.try_variant_get(value, "$", "string")
    number = F.when(F.schema_of_variant(value) == "BOOLEAN", (plain == "true").cast("double")).when(plain.rlike(_NUMBER), F.trim(plain).try_cast("double"))
    return F.coalesce(F.when(F.abs(number) < 1e300, number), F.lit(otherwise))


def as_int(value: Column) -> Column:
    """`as_number`, rounded half to even."""
    return F.rint(as_number(value)).cast("int")


def texts_of(value: Column) -> Column:
    """A list as texts; empty for anything else."""
    own = F.try_variant_get(value, "$", "array<variant>")
    return F.coalesce(F.transform(own, lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.lit(""))), F.array().cast("array<string>"))


def missing_scores(payload: Column) -> Column:
    """The required score keys that a JSON text leaves out; a key with a null value is there."""
    present = F.json_object_keys(F.get_json_object(payload, "$.scores"))
    return F.array_except(F.array(*map(F.lit, REQUIRED_SCORES)), F.coalesce(present, F.array().cast("array<string>")))


def review_of(payload: Column, response_id: Column, reviewer_model: Column) -> Column:
    """A review record from a JSON text: typed scores, the judgment capped where its evidence or shape is lacking."""
    it = F.try_parse_json(payload)
    quote = text_of(field(it, "judgment_evidence_quote"))
    flags = {k: truthy(field(it, f"scores.{k}")) for k in SCORE_FLAGS}
    caps = F.array_compact(F.array(F.when(quote == "", F.lit(NO_QUOTE)), *(F.when(flags[k], F.lit(f"{k}: {why}")) for k, why in CAPPING_FLAGS.items())))
    judgment = as_int(field(it, "scores.judgment_not_terminology"))
    numbers = {
        "fidelity": as_int(field(it, "scores.fidelity")),
        "judgment_not_terminology": F.when(F.size(caps) > 0, F.least(judgment, F.lit(JUDGMENT_CAP))).otherwise(judgment),
        "scenario_quality": as_int(field(it, "scores.scenario_quality")),
    }
    verdict = field(it, "verdict")
    return F.struct(
        short_id("rev", response_id, reviewer_model).alias("review_id"),
        response_id.alias("response_id"),
        reviewer_model.alias("reviewer_model"),
        F.struct(*(v.alias(k) for k, v in numbers.items()), *(flags[k].alias(k) for k in SCORE_FLAGS)).alias("scores"),
        F.concat(texts_of(field(it, "issues")), F.transform(caps, lambda c: F.concat(F.lit("score capped: "), c))).alias("issues"),
        F.when(verdict.isNull() | F.is_variant_null(verdict), F.lit("revise")).otherwise(F.lower(text_of(verdict))).alias("verdict"),
        text_of(field(it, "rationale")).alias("rationale"),
        quote.alias("judgment_evidence_quote"),
        text_of(field(it, "judgment_move")).alias("judgment_move"),
        texts_of(field(it, "signature_moves_present")).alias("signature_moves_present"),
        texts_of(field(it, "notes")).alias("notes"),
    )


def label_of(prompt_id: Column) -> Column:
    """Which letter each of the three replies carries, as a map from kind to letter: their order by a digest of the
    prompt, so that place tells a judge nothing and a re-run changes nothing."""
    kinds = F.array(*map(F.lit, ("candidate", "generic", "weak")))
    ordered = F.array_sort(F.transform(kinds, lambda k: F.struct(F.sha2(F.concat(prompt_id, F.lit("|"), k), 256).alias("at"), k.alias("kind"))))
    return F.map_from_arrays(F.transform(ordered, lambda x: x["kind"]), F.array(*map(F.lit, "ABC")))


def verdict_of(payload: Column, prompt_id: Column, judge_model: Column, labels: Column) -> Column:
    """A verdict record from a judge's JSON text, which names the replies by letters; `labels` maps kinds to those."""
    it = F.try_parse_json(payload)
    named, same = text_of(field(it, "value_named")), truthy(field(it, "generic_makes_same_claim"))
    given = F.lower(text_of(field(it, "divergence_source")))
    source = F.when(same, F.lit("capability")).when(given.isin(SOURCES), given).otherwise(F.lit("none"))
    closer = F.lower(text_of(field(it, "closer_to")))
    actions = F.from_json(F.get_json_object(payload, "$.actions"), "map<string,string>")
    action = lambda kind: F.trim(F.coalesce(F.try_element_at(actions, F.lower(F.try_element_at(labels, F.lit(kind)))), F.lit("")))
    kind = text_of(field(it, "kind"))
    order = F.array_sort(F.transform(F.map_entries(labels), lambda e: F.concat(e["value"], F.lit("="), e["key"])))
    return F.struct(
        prompt_id.alias("prompt_id"),
        judge_model.alias("judge_model"),
        ((named != "") & (source == "value")).alias("diverges"),
        F.when(kind == "", "none").otherwise(kind).alias("kind"),
        text_of(field(it, "explanation")).alias("explanation"),
        F.coalesce(F.try_element_at(labels, F.lit("candidate")), F.lit("")).alias("presented_first"),
        action("candidate").alias("candidate_action"),
        action("weak").alias("base_action"),
        action("generic").alias("generic_action"),
        F.when(closer.isin(NEARER), closer).otherwise(F.lit("")).alias("closer_to"),
        truthy(field(it, "pairwise.test_vs_weak")).alias("diverges_vs_base"),
        truthy(field(it, "pairwise.test_vs_generic")).alias("diverges_vs_generic"),
        truthy(field(it, "pairwise.generic_vs_weak")).alias("generic_differs_from_base"),
        named.alias("value_named"),
        text_of(field(it, "generic_echo")).alias("generic_echo"),
        same.alias("generic_makes_same_claim"),
        F.array_join(order, ", ").alias("label_order"),
        source.alias("divergence_source"),
        text_of(field(it, "hypothesis_id")).alias("hypothesis_id"),
        F.lit("").alias("unverified_reason"),
    )
