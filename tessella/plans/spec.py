"""Target specifications: loading, checks that report every problem at once, lookups, and the texts that writers and reviewers read."""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .planner import Target

#: What a specification must hold, and the words of its renderings.
REQUIRED = ["id", "name", "version", "summary", "principles", "domains", "cue_policy"]
PASSAGES_FILE = "key_passages.md"
LEAST_PRINCIPLES = 3
OPEN_TRADEOFF = "UNRESOLVED: the reviewed target does not settle this. Present the conflict honestly and do not write a confident resolution."
ALLOWED_WORDS = (
    "Ordinary-English words this target needs in order to say what it means. These are NOT cues and you should use them where they are the right word: "
)
SOFT_WORDS = "Terms to use only if the situation genuinely calls for them, never as a signal of where the judgment comes from: "
AMBIGUOUS, AVOID = "mark_ambiguous", "avoid"


class SpecError(ValueError):
    """A specification that lacks something; the message lists all problems."""


def load_structured(path: str) -> dict:
    """A mapping from a YAML or JSON file."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        found = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise SpecError(f"{path} needs a YAML reader; write it as JSON") from e
        found = yaml.safe_load(text)
    if found is not None and not isinstance(found, dict):
        raise SpecError(f"{path} is not a mapping")
    return found or {}


def passages_in(text: str) -> list[dict]:
    """Passages (id, title, text) of Markdown: a heading of two to four marks opens one and its first dash parts id and title."""
    found = []
    for block in re.split(r"(?m)^(?=#{2,4}\s)", text):
        head, _, body = block.partition("\n")
        m = re.match(r"#{2,4}\s+([^\n#]+?)\s*$", head)
        if m:
            name, *title = re.split(r"\s+[—–-]{1,2}\s+", m.group(1), maxsplit=1)
            found.append({"id": name.strip(), "title": "".join(title).strip(), "text": body.strip()})
    return [p for p in found if p["id"]]


def prefixes_of(id_format: str) -> list[str]:
    """The beginnings of the ids that a format stands for: its alternatives up to their first placeholder or section mark."""
    return [p for p in (re.split(r"[<§(]", a, maxsplit=1)[0].strip() for a in str(id_format or "").split("/")) if p]


@dataclass
class Spec:
    raw: dict
    passages: list[dict] = field(default_factory=list)

    def section(self, name: str) -> list[dict]:
        return self.raw.get(name) or []

    def terms(self, kind: str) -> list[str]:
        """forbidden_terms, allowed_terms, soft_terms or archaic_register_examples."""
        return list((self.raw.get("cue_policy") or {}).get(kind) or [])

    def find(self, section: str, item: str) -> dict | None:
        return next((x for x in (self.passages if section == "passages" else self.section(section)) if x.get("id") == item), None)

    def moves(self) -> list[dict]:
        return [m if isinstance(m, dict) else {"id": str(m), "description": ""} for m in self.section("signature_moves")]

    def default_layers(self) -> list[str]:
        return [str(x["id"]) for x in self.section("layers") if x.get("id") and x.get("generate_by_default", True)]

    def layers(self, wanted: list[str] | None) -> list[str]:
        """The wanted layers, which must be known; without any, those that are on by default."""
        if not wanted:
            return self.default_layers()
        unknown = set(wanted) - {str(x.get("id")) for x in self.section("layers")}
        if unknown:
            raise SpecError(f"no such layers: {sorted(unknown)}")
        return [str(x) for x in wanted]

    def principles(self, layers: list[str] | None = None) -> list[dict]:
        """The principles of the layers, and those of no layer; all of them where there are no layers."""
        own = set(self.default_layers() if layers is None else layers)
        return [p for p in self.section("principles") if not self.section("layers") or not p.get("layer") or p["layer"] in own]

    def choices(self, policy: str) -> list[dict]:
        return [c for c in self.section("unresolved_choices") if str(c.get("generation_policy", "")).strip() == policy]

    def avoid_words(self) -> list[str]:
        return [str(w) for c in self.choices(AVOID) for w in c.get("avoid_keywords") or []]

    def sources_of(self, passage_id: str) -> list[str]:
        """The reference entries whose id format a passage's id starts with, in any case, the longest beginning first."""
        found = [(p, str(e["id"])) for e in self.section("reference_material") if e.get("id") for p in prefixes_of(e.get("passage_id_format", "")) if passage_id.lower().startswith(p.lower())]
        return list(dict.fromkeys(source for _, source in sorted(found, key=lambda x: -len(x[0]))))

    def target(self, institutions: dict[str, list[str]] | None = None) -> Target:
        """What a plan covers of it."""
        ids = lambda items: [str(x["id"]) for x in items if x.get("id")]
        return Target(
            str(self.raw["id"]),
            {str(d["id"]): float(d.get("weight", 1.0)) for d in self.section("domains")},
            ids(self.section("tradeoffs")),
            ids(t for t in self.section("tradeoffs") if t.get("unresolved")),
            ids(self.choices(AMBIGUOUS)),
            ids(self.section("divergence_hypotheses")),
            institutions or {},
        )

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        """principles, tradeoffs, hypotheses, terms, sources and passages as tables, for joins with records."""
        text = lambda x, k: str(x.get(k) or "")
        texts = lambda x, k: [str(v) for v in x.get(k) or []]
        kinds = ("forbidden_terms", "allowed_terms", "soft_terms")
        return {
            "principles": spark.createDataFrame(
                [(text(p, "id"), text(p, "name"), text(p, "description"), texts(p, "positive_indicators"), texts(p, "failure_modes")) for p in self.section("principles")],
                "id string, name string, description string, positive_indicators array<string>, failure_modes array<string>",
            ),
            "tradeoffs": spark.createDataFrame([(text(t, "id"), text(t, "description"), bool(t.get("unresolved"))) for t in self.section("tradeoffs")], "id string, description string, unresolved boolean"),
            "hypotheses": spark.createDataFrame([(text(h, "id"), text(h, "description")) for h in self.section("divergence_hypotheses")], "id string, description string"),
            "terms": spark.createDataFrame([(k, k_at, str(t)) for k in kinds for k_at, t in enumerate(self.terms(k))], "kind string, place int, term string"),
            "sources": spark.createDataFrame(
                [(text(e, "id"), text(e, "use"), text(e, "license"), text(e, "path")) for e in self.section("reference_material")], "source_id string, use string, license string, path string"
            ),
            "passages": spark.createDataFrame([(p["id"], p["title"], p["text"], self.sources_of(p["id"])) for p in self.passages], "passage_id string, title string, text string, sources array<string>"),
        }


# --- checks --------------------------------------------------------------------------------------------------------


def problems(spec: Spec, strict: bool = False) -> list[str]:
    """Everything that is wrong with a specification; with `strict`, avoided choices need words to screen for."""
    raw = spec.raw
    found = [f"'{k}' is missing" for k in REQUIRED if not raw.get(k)]
    if strict:
        found += [f"avoided choice '{c.get('id')}' has no avoid_keywords" for c in spec.choices(AVOID) if not c.get("avoid_keywords")]
    principles = spec.section("principles")
    if 0 < len(principles) < LEAST_PRINCIPLES:
        found.append(f"{len(principles)} principles, {LEAST_PRINCIPLES} at least are needed")
    needed = {"principles": ["name", "description", "sources"], "tradeoffs": ["description"], "domains": []}
    for section, fields in needed.items():
        items = spec.section(section)
        found += [f"{section}[{k}] has no id" for k, x in enumerate(items) if not x.get("id")]
        if section != "domains":
            found += [f"{section} repeat the id '{i}'" for i, n in Counter(x["id"] for x in items if x.get("id")).items() if n > 1]
        found += [f"{section}[{k}] '{x.get('id')}' has no {f}" for k, x in enumerate(items) for f in fields if not x.get(f)]
    found += [f"tradeoff '{t.get('id')}' is neither unresolved nor has an intended_lean" for t in spec.section("tradeoffs") if t.get("unresolved") is not True and not t.get("intended_lean")]
    lower = lambda kind: {str(t).strip().lower() for t in spec.terms(kind)}
    for kind in ("allowed_terms", "soft_terms"):
        if shared := sorted(lower(kind) & lower("forbidden_terms")):
            found.append(f"{kind} and forbidden_terms share {shared}")
    if raw.get("cue_policy") and not spec.terms("forbidden_terms"):
        found.append("cue_policy has no forbidden_terms")
    known = {p["id"] for p in spec.passages}
    if not known:
        return [*found, f"no passages in {PASSAGES_FILE}"]
    for section in ("principles", "boundaries", "tradeoffs"):
        for k, x in enumerate(spec.section(section)):
            cited = x.get("sources") or []
            if lacking := [str(s) for s in ([cited] if isinstance(cited, str) else cited) if str(s) not in known]:
                found.append(f"{section} '{x.get('id') or x.get('principle') or k}' cite unknown passages {lacking}")
    return found


def load_spec(targets_dir: str, target_id: str, strict: bool = False) -> Spec:
    """The specification in the folder of a target; a problem is an error that lists all of them."""
    root = os.path.join(targets_dir, target_id)
    path = next((p for p in (os.path.join(root, n) for n in ("spec.yaml", "spec.json")) if os.path.exists(p)), None)
    if path is None:
        raise SpecError(f"no specification in {root}")
    raw = load_structured(path)
    named = next((str(e["path"]) for e in raw.get("reference_material") or [] if str(e.get("path", "")).endswith(PASSAGES_FILE)), None)
    at = os.path.join(root, named or os.path.join("references", PASSAGES_FILE))
    if named and not os.path.exists(at):
        raise SpecError(f"{path} names {at}, which isn't there")
    spec = Spec(raw)
    if os.path.exists(at):
        with open(at, encoding="utf-8") as f:
            spec.passages = passages_in(f.read())
    if found := problems(spec, strict):
        raise SpecError(f"{target_id}: {len(found)} problems\n  - " + "\n  - ".join(found))
    if raw["id"] != target_id:
        raise SpecError(f"{path} is of '{raw['id']}', its folder of '{target_id}'")
    return spec


def overview(spec: Spec) -> dict[str, object]:
    """What a specification holds, by counts."""
    grounding = [e for e in spec.section("reference_material") if e.get("use") == "grounding"]
    sections = ("principles", "tradeoffs", "boundaries", "divergence_hypotheses", "domains", "layers", "signature_moves")
    return {
        **{s: len(spec.section(s)) for s in sections},
        "unresolved_tradeoffs": sum(t.get("unresolved") is True for t in spec.section("tradeoffs")),
        "passages": len(spec.passages),
        **{k: len(spec.terms(k)) for k in ("forbidden_terms", "allowed_terms", "soft_terms")},
        "avoided": [c.get("id") for c in spec.choices(AVOID)],
        "avoid_words": len(spec.avoid_words()),
        "grounding": len(grounding),
        "without_licence": [e.get("id") for e in grounding if not e.get("license")],
        "deliberation_shape": bool(spec.raw.get("deliberation_shape")),
        "redistribution_note": bool(spec.raw.get("redistribution_note")),
    }


def known_ids(returned: list | None, known: set[str], fallback: list[str]) -> list[str]:
    """The known ones of the ids that a writer returned, in order; what was planned where there are none."""
    return [v for v in (str(x).strip() for x in returned or []) if v in known] or list(fallback)


# --- texts ---------------------------------------------------------------------------------------------------------


def _said(item: dict, key: str) -> str:
    return str(item.get(key) or "").strip()


def _bullets(lines: list[str], none: str = "(none recorded)") -> str:
    return "\n".join(f"- {x}" for x in lines or [none])


def _blocks(blocks: list[list[str]], none: str) -> str:
    return "\n\n".join("\n".join(b) for b in blocks) or none


def _detail(item: dict, key: str, label: str, between: str) -> list[str]:
    return [f"  {label}: " + between.join(map(str, item[key]))] if item.get(key) else []


def render_principles(spec: Spec, ids: list[str] | None = None, layers: list[str] | None = None, compact: bool = False) -> str:
    """The principles of the layers, or those with the ids where any has; `compact` leaves out how they show."""
    own = spec.principles(layers)
    own = [p for p in own if p.get("id") in (ids or [])] or own
    return _blocks(
        [
            [f"{p.get('id')} {p.get('name')}: {_said(p, 'description')}"]
            + ([] if compact else _detail(p, "positive_indicators", "looks like", "; "))
            + _detail(p, "failure_modes", "fails when", "; ")
            + _detail(p, "sources", "grounded in", ", ")
            for p in own
        ],
        "(no principles)",
    )


def render_tradeoffs(spec: Spec, ids: list[str] | None = None) -> str:
    return _blocks(
        [
            [f"{t.get('id')}: {_said(t, 'description')}"]
            + _detail(t, "considerations", "what is in tension", "; ")
            + ([f"  {OPEN_TRADEOFF}"] if t.get("unresolved") else [f"  how the target leans: {_said(t, 'intended_lean')}"] if t.get("intended_lean") else [])
            + _detail(t, "sources", "grounded in", ", ")
            for t in spec.section("tradeoffs")
            if ids is None or t.get("id") in ids
        ],
        "(no tradeoffs recorded)",
    )


def render_boundaries(spec: Spec) -> str:
    return _bullets([f"{b.get('principle', 'general')}: {_said(b, 'limit')}" for b in spec.section("boundaries")])


def render_domains(spec: Spec) -> str:
    return _bullets([f"{d.get('id')} (weight {d.get('weight', 1)}): {_said(d, 'notes')}" for d in spec.section("domains")])


def render_unresolved(spec: Spec) -> str:
    return _bullets(
        [
            f"{c.get('id')}: {_said(c, 'question')} [policy: {c.get('generation_policy', AMBIGUOUS)}; working assumption: {_said(c, 'working_assumption')}]"
            for c in spec.section("unresolved_choices")
        ]
    )


def render_misinterpretations(spec: Spec) -> str:
    return _bullets([f"WRONG: {m.get('claim')}  ->  RIGHT: {m.get('correction')}" for m in spec.section("misinterpretations")])


def render_hypotheses(spec: Spec) -> str:
    shape = lambda h: f" Example shape: {h['example_prompt_shape']}" if h.get("example_prompt_shape") else ""
    return _bullets([f"{h.get('id')}: {_said(h, 'description')}{shape(h)}" for h in spec.section("divergence_hypotheses")])


def render_passages(spec: Spec, ids: list[str] | None = None, budget: int = 6000) -> str:
    """Passages with the ids, or all where none has, as many as fit the budget of characters, one at least; then how
    many were left out."""
    own = [p for p in spec.passages if p["id"] in (ids or [])] or spec.passages
    blocks = [f"[{p['id']}]{' ' + p['title'] if p['title'] else ''}\n{p['text']}" for p in own]
    fits, size = 0, 0
    while fits < len(blocks) and (not fits or size + len(blocks[fits]) <= budget):
        size += len(blocks[fits])
        fits += 1
    left = len(blocks) - fits
    return "\n\n".join(blocks[:fits] + [f"[{left} further passages omitted for length]"] * bool(left)) or "(no key passages)"


def render_cue_policy(spec: Spec) -> str:
    policy = spec.raw.get("cue_policy") or {}
    lines = [
        f"User prompts must not name the tradition or ask for a persona: {bool(policy.get('prompts_must_not_name_tradition', True))}",
        f"Responses use ordinary language, not doctrinal vocabulary: {bool(policy.get('responses_avoid_doctrinal_vocabulary', True))}",
        "Terms that must not appear in prompts or responses: " + (", ".join(spec.terms("forbidden_terms")) or "(none listed)"),
    ]
    lines += [words + ", ".join(spec.terms(kind)) for kind, words in (("allowed_terms", ALLOWED_WORDS), ("soft_terms", SOFT_WORDS)) if spec.terms(kind)]
    return _bullets(lines)


def render_avoided(spec: Spec) -> str:
    return _bullets([f"{c.get('id')}: {_said(c, 'question')}" for c in spec.choices(AVOID)], "(nothing is off limits)")


def render_open_questions(spec: Spec) -> str:
    """What each unresolved item leaves open, and what of it is settled; a tradeoff without an open question is open as a whole."""
    lines = []
    for t in (t for t in spec.section("tradeoffs") if t.get("unresolved")):
        lines.append(f"{t.get('id')}:")
        lines += [f"  SETTLED, be decisive about this: {_said(t, 'resolved_part')}"] * bool(_said(t, "resolved_part"))
        lines.append(f"  OPEN, do not settle this: {_said(t, 'open_question') or _said(t, 'description')}")
    for c in (c for c in spec.section("unresolved_choices") if _said(c, "generation_policy") in (AMBIGUOUS, AVOID)):
        lines += [f"{c.get('id')}:", f"  OPEN, do not settle this: {_said(c, 'question')}"]
    return "\n".join(lines) or "(this target marks nothing as open)"


def render_moves(spec: Spec) -> str:
    return "\n".join(f"    - {m.get('id') or m.get('name')}: {_said(m, 'description')}" for m in spec.moves())


def _sections(spec: Spec, parts: list[tuple[str, str]]) -> str:
    head = f"# Target: {spec.raw['name']} (id {spec.raw['id']}, spec version {spec.raw['version']})"
    return "\n\n".join([head, *(f"## {title}\n{body}" for title, body in parts)])


def for_generator(spec: Spec, principles: list[str] | None = None, tradeoffs: list[str] | None = None, layers: list[str] | None = None, stage: str = "families") -> str:
    """What a writer reads: the whole target for families; for responses only what the family uses, more briefly."""
    families = stage == "families"
    parts = [
        ("How this target judges", str(spec.raw["summary"]).strip()),
        ("Principles", render_principles(spec, principles, layers, compact=stage == "responses")),
        ("Limits the target imposes on itself", render_boundaries(spec)),
        ("Genuine tradeoffs", render_tradeoffs(spec, tradeoffs)),
        ("Open interpretation questions", render_unresolved(spec)),
        ("Common distortions to avoid", render_misinterpretations(spec)),
    ]
    if families:
        parts += [
            ("Where a generic assistant is expected to answer differently", render_hypotheses(spec)),
            ("Situation domains to cover", render_domains(spec)),
            ("Topics this pilot must not build scenarios about", render_avoided(spec)),
        ]
    return _sections(spec, [*parts, ("Cue policy", render_cue_policy(spec))])


def for_reviewer(spec: Spec, layers: list[str] | None = None) -> str:
    """What a reviewer reads: the target and its red flags, without what a plan covers."""
    return _sections(
        spec,
        [
            ("How this target judges", str(spec.raw["summary"]).strip()),
            ("Principles", render_principles(spec, None, layers)),
            ("Limits the target imposes on itself", render_boundaries(spec)),
            ("Genuine tradeoffs", render_tradeoffs(spec)),
            ("Open interpretation questions (a confident resolution is a defect)", render_unresolved(spec)),
            ("Common distortions (red flags)", render_misinterpretations(spec)),
            ("Topics this pilot does not build scenarios about", render_avoided(spec) + "\nA scenario that is really about one of these is a scenario_quality defect."),
            ("Cue policy", render_cue_policy(spec)),
        ],
    )
