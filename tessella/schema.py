"""Record types of a curation run as Spark schemas, with the defaults that older rows lack."""

from __future__ import annotations

from pyspark.sql import types as T


def schema_of(kind: str) -> T.StructType:
    """The type of a record kind; parsing it needs a session."""
    return T.StructType.fromDDL(SCHEMAS[kind])


_SCORES = (
    "struct<fidelity:int,judgment_not_terminology:int,scenario_quality:int,cue_leakage:boolean,confident_on_unresolved:boolean,"
    "formulaic_shape:boolean,prompt_stipulates_move:boolean,quoted_source_text:boolean,archaic_register:boolean>"
)
_HIDDEN = "struct<principles_applied:array<string>,source_passages:array<string>,source_passage_notes:map<string,string>,intended_divergence_note:string,hypothesis_id:string>"

SCHEMAS: dict[str, str] = {
    "family": (
        "family_id string, target_id string, domain string, tradeoff_ids array<string>, principle_ids array<string>, case_type_intent string, "
        "seed_situation string, why_it_is_hard string, split string, source_passage_ids array<string>, generator_model string, spec_version string, "
        "counterfactual_group_id string, varied_fact string, varied_axis string, situation_features map<string,string>, reserved_reason string, "
        "mode string, slot_index int, divergence_hypothesis_id string, asker_stance string, institution string, layers_generated array<string>"
    ),
    "prompt": ("prompt_id string, family_id string, variant string, text string, case_type string, mode string, register string, question_kind string"),
    "response": (
        f"response_id string, prompt_id string, deliberation string, answer string, hidden {_HIDDEN}, generator_model string, usage string, "
        "revise_rounds int, mode string, expected_actions string, varied_fact_effect string"
    ),
    "review": (
        f"review_id string, response_id string, reviewer_model string, scores {_SCORES}, issues array<string>, verdict string, rationale string, "
        "judgment_evidence_quote string, judgment_move string, signature_moves_present array<string>, notes array<string>"
    ),
    "baseline": ("prompt_id string, base_model string, text string, usage string, kind string, finish_reason string"),
    "verdict": (
        "prompt_id string, judge_model string, diverges boolean, kind string, explanation string, presented_first string, candidate_action string, "
        "base_action string, generic_action string, closer_to string, diverges_vs_base boolean, diverges_vs_generic boolean, generic_differs_from_base boolean, "
        "value_named string, generic_echo string, generic_makes_same_claim boolean, label_order string, divergence_source string, hypothesis_id string, unverified_reason string"
    ),
    "decision": (
        "response_id string, keep boolean, reasons array<string>, final_case_type string, duplicate_of string, max_leakage double, divergence_status string, "
        "divergence_kind string, divergence_source string, soft_cue_hits array<string>"
    ),
    "usage": (
        "stage string, role string, model string, record_id string, request_id string, prompt_tokens bigint, completion_tokens bigint, reasoning_tokens bigint, "
        "cost_usd double, latency_s double, finish_reason string"
    ),
}

DEFAULTS: dict[str, dict[str, object]] = {
    "family": {"mode": "neutral", "slot_index": -1},
    "prompt": {"mode": "neutral"},
    "response": {"mode": "neutral", "revise_rounds": 0},
    "baseline": {"kind": "base"},
}

#: The closed vocabularies of the records, from one end to the other, and the mixes that a plan keeps.
VARIANTS = ["base", "setting_shift", "role_shift", "fiction", "roleplay", "terse"]
CASE_TYPES = ["ordinary", "divergence"]
SPLITS = ["train", "eval", "reserved"]
MODES = ["neutral", "explicit"]
HARM_SEVERITY = ["minor", "serious", "grave"]
URGENCY = ["none", "days", "now"]
PUBLIC_OR_PRIVATE = ["private", "semi_public", "public"]
ROLE_TYPE_MIX = {"no_authority": 0.45, "peer": 0.25, "holds_authority": 0.25, "institution": 0.05}
ASKER_STANCE_MIX = {"conflicted": 0.40, "decided_wants_permission": 0.20, "angry_wants_to_win": 0.15, "defensive": 0.15, "transactional": 0.10}
AXES = {
    "harm_severity": HARM_SEVERITY,
    "role_type": list(ROLE_TYPE_MIX),
    "public_or_private": PUBLIC_OR_PRIVATE,
    "urgency": URGENCY,
    "asker_stance": list(ASKER_STANCE_MIX),
}
QUESTION_KINDS = ["what_to_do", "how_to_say_it", "was_my_decision_right"]


def outside_vocabulary(column: str, values: list[str]) -> str:
    """A condition that holds for a value of `column` that its vocabulary lacks; '' stands for a missing one."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"coalesce({column}, '') not in ('', {listed})"
