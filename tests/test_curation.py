"""Plans, specifications, gateway, exports, payloads and configuration, with cases of their own."""

import collections
import json

import pytest
from pyspark.sql import functions as F

from tessella import config, schema
from tessella.functions import payload as P
from tessella.functions import text as X
from tessella.operators import coverage, decisions, export, gateway, report
from tessella.plans import planner, spec
from tessella.sources import records

TARGET = planner.Target("toy", {"work": 5, "home": 3, "law": 2}, ["t1", "t2", "t3", "t4", "t5"], ["t2", "t4"], ["c1"], ["h1", "h2"], {"a": ["x", "y"], "b": ["z"]})
RAW = {
    "id": "toy", "name": "Toy", "version": 2, "summary": "judges toys", "deliberation_shape": "short",
    "principles": [{"id": f"P{k}", "name": f"n{k}", "description": f"d{k}.", "sources": ["S 1.1"], "positive_indicators": ["asks first"], "failure_modes": ["rushing ahead"], **({"layer": "extra"} if k == 2 else {})} for k in range(3)],
    "domains": [{"id": "work", "weight": 3}, {"id": "home"}], "layers": [{"id": "core"}, {"id": "extra", "generate_by_default": False}],
    "cue_policy": {"forbidden_terms": ["Zog"], "allowed_terms": ["care"], "soft_terms": ["duty"]},
    "tradeoffs": [{"id": "t1", "description": "speed or care", "intended_lean": "care"}, {"id": "t2", "description": "tell or keep", "unresolved": True, "resolved_part": "never lie"}],
    "unresolved_choices": [{"id": "c1", "question": "who?", "generation_policy": "mark_ambiguous"}, {"id": "c2", "question": "when?", "generation_policy": "avoid", "avoid_keywords": ["estate"]}],
    "divergence_hypotheses": [{"id": "h1", "description": "asks"}],
    "reference_material": [{"id": "s", "use": "grounding", "license": "public domain", "passage_id_format": "S <n> / T", "path": "references/key_passages.md"}, {"id": "s1", "passage_id_format": "S 1"}],
}
PASSAGES = "intro\n## S 1.1 — First\nbody one\n\n### S 2\nbody two\n"


@pytest.mark.parametrize("n", [1, 2, 3, 12, 40, 97, 240])
@pytest.mark.parametrize("k", range(4))
def test_plan_invariants(n, k):
    s = planner.Settings(n, [0.35, 0.5, 0.0, 1.0][k], [0.25, 0.0, 0.5, 0.17][k], [0.0, 0.05, 0.1, 0.0][k], [0.3, 0.0, 1.0, 0.5][k], held_out=[0, 1, 2, 0][k], explicit=[0.0, 0.2, 0.0, 0.5][k])
    slots = planner.plan(TARGET, s)
    assert [x.slot_index for x in slots] == list(range(n)) and slots == planner.plan(TARGET, s)
    domains = collections.Counter(x.domain for x in slots)
    assert all(abs(domains[d] - w / 10 * n) < 1 for d, w in TARGET.domains.items())
    pairs = collections.defaultdict(list)
    for x in slots:
        pairs[x.pair].append(x)
    singles = pairs.pop("", [])
    for a, b in pairs.values():
        assert (a.domain, a.split, a.tradeoff, a.intent, a.hypothesis) == (b.domain, b.split, b.tradeoff, b.intent, b.hypothesis)
        assert [axis for axis in schema.AXES if getattr(a, axis) != getattr(b, axis)] == [a.varied_axis]
    assert len(singles) + 2 * len(pairs) == n and 2 * len(pairs) <= max(0, round(n * s.counterfactual))
    assert all(bool(x.hypothesis) == (x.intent == "divergence") for x in slots)
    units = [u[0] for u in planner.units_of(slots)]
    used = collections.Counter(u.tradeoff for u in units)
    for kind in (TARGET.unresolved, [t for t in TARGET.tradeoffs if t not in TARGET.unresolved]):
        assert max(used[t] for t in kind) - min(used[t] for t in kind) <= 1
    held = planner.held_out_tradeoffs(slots, s.held_out)
    assert all(x.split == "eval" for x in slots if x.tradeoff in held)
    in_eval = sum(x.split == "eval" for x in slots)
    assert in_eval >= min(1, n - 1)
    if not held:
        assert abs(in_eval - planner.wanted_eval(slots, s)) <= 1
    assert abs(sum(x.mode == "explicit" for x in units) - len(units) * s.explicit) <= 1


def test_plan_checks(spark):
    settings = planner.Settings(40, 0.4, 0.25, 0.05, 0.3)
    assert planner.checked_plan(spark, TARGET, settings).count() == 40
    slots = planner.plan(TARGET, settings)
    first = next(x for x in slots if x.pair)
    first.split, first.domain = "eval" if first.split == "train" else "train", "elsewhere"
    slots[-1].slot_index = 99
    next(x for x in slots if x.hypothesis).hypothesis = ""
    found = {r.rule for r in planner.check(planner.as_table(spark, slots), TARGET, settings).where("level = 'ERROR'").collect()}
    assert found >= {"a pair is in one split", "a pair is in one domain", "slots are numbered without gaps", "a divergence slot has a hypothesis"}
    with pytest.raises(planner.PlanError):
        planner.plan(TARGET, planner.Settings(0))
    families = spark.createDataFrame([("a", 2, 0), ("b", -1, 1), ("c", -1, 2)], "family_id string, slot_index int, ordinal int")
    spots = spark.createDataFrame([(k, "g1" if k < 2 else "") for k in range(4)], "slot_index int, pair string")
    filled = planner.backfill(families, spots)
    assert sorted((r.family_id, r.slot_index) for r in filled.collect()) == [("a", 2), ("b", 0), ("c", 1)]
    assert planner.incomplete_groups(spots, filled).count() == 0 and planner.incomplete_groups(spots, families).first().missing == [0, 1]


def test_draw_spreads_over_domains():
    slots = [planner.Slot(k, d, pair) for k, (d, pair) in enumerate([("a", "g1"), ("a", "g1"), ("b", ""), ("a", ""), ("b", ""), ("c", "")])]
    size = lambda wanted, offset: [[s.slot_index for s in u] for u in planner.draw(planner.units_of(slots), wanted, offset)]
    assert size(2, 0) == [[0, 1]] and size(3, 0) == [[0, 1], [2]] and size(3, 1) == [[3], [4], [5]] and size(0, 0) == []
    assert planner.spread(slots, 3) == [0, 1, 2] and planner.dealt({"x": 2, "y": 1}) == ["x", "y", "x"]


def test_coverage_tables(spark):
    rows = spark.createDataFrame([(k, "ab"[k % 3 == 0], k) for k in range(11)], "key int, stratum string, place int")
    for count, offset in ((0, 0.0), (1, 0.9), (4, 0.3), (7, 0.0), (20, 0.3)):
        slots = [planner.Slot(k, "ab"[k % 3 == 0]) for k in range(11)]
        assert sorted(r.key for r in coverage.stratified_pick(rows, count, offset).collect()) == planner.spread(slots, count, offset)
    lines = spark.createDataFrame([("t", k, 40) for k in range(5)], "by string, place int, length int")
    assert [r.note for r in coverage.omitted(lines, 100, "by").collect()] == ["[3 further passages omitted for length]"]
    both = spark.createDataFrame([(k, "d", k, "g" if k in (1, 5) else "") for k in range(6)], "id int, stratum string, place int, pair string")
    batch = {r.id: r.batch for r in coverage.even_batches(both, 3).collect()}
    assert batch[1] == batch[5] == 0 and collections.Counter(batch.values()) == {0: 2, 1: 2, 2: 2}


def test_spec(tmp_path, spark):
    (tmp_path / "toy" / "references").mkdir(parents=True)
    (tmp_path / "toy" / "spec.json").write_text(json.dumps(RAW))
    (tmp_path / "toy" / "references" / "key_passages.md").write_text(PASSAGES)
    own = spec.load_spec(str(tmp_path), "toy", strict=True)
    assert [(p["id"], p["title"], p["text"]) for p in own.passages] == [("S 1.1", "First", "body one"), ("S 2", "", "body two")]
    assert own.sources_of("s 1.1") == ["s1", "s"] and own.sources_of("S 2") == ["s"] and own.avoid_words() == ["estate"]
    assert [p["id"] for p in own.principles()] == ["P0", "P1"] and len(own.principles(["extra"])) == 3 and own.layers(None) == ["core"]
    assert own.target().shares() == {"work": 0.75, "home": 0.25} and own.target().unresolved == ["t2"]
    with pytest.raises(spec.SpecError):
        own.layers(["none"])
    assert spec.render_principles(own, ["P1"], compact=True) == "P1 n1: d1.\n  fails when: rushing ahead\n  grounded in: S 1.1"
    assert "UNRESOLVED" in spec.render_tradeoffs(own, ["t2"]) and spec.render_boundaries(own) == "- (none recorded)"
    assert spec.render_passages(own, None, 5).splitlines()[-1] == "[1 further passages omitted for length]" and spec.render_passages(own, ["S 2"]) == "[S 2]\nbody two"
    assert "SETTLED, be decisive about this: never lie" in spec.render_open_questions(own) and spec.render_avoided(own) == "- c2: when?"
    assert "## Situation domains to cover" in spec.for_generator(own) and "Situation domains" not in spec.for_generator(own, stage="responses") and "red flags" in spec.for_reviewer(own)
    assert spec.overview(own)["unresolved_tradeoffs"] == 1 and spec.known_ids([" P1 ", "no"], {"P1"}, ["P2"]) == ["P1"]
    assert own.tables(spark)["terms"].count() == 3
    broken = json.loads(json.dumps(RAW))
    broken["principles"] = [{"id": "P0", "name": "x", "sources": ["none"]}] * 2
    broken["tradeoffs"][0].pop("intended_lean")
    broken["cue_policy"]["soft_terms"] = ["ZOG"]
    broken["unresolved_choices"][1].pop("avoid_keywords")
    del broken["summary"]
    found = spec.problems(spec.Spec(broken, own.passages), strict=True)
    for words in ("'summary'", "2 principles", "repeat the id 'P0'", "no description", "intended_lean", "share ['zog']", "avoid_keywords", "unknown passages ['none']"):
        assert any(words in f for f in found), words
    with pytest.raises(spec.SpecError):
        spec.load_spec(str(tmp_path), "missing")


class Scripted:
    def __init__(self, *replies):
        self.replies, self.asked = list(replies), []

    def post(self, role, path, payload, stage):
        self.asked.append(payload)
        own = self.replies.pop(0)
        if isinstance(own, Exception):
            raise own
        return own


def said(text, finish="stop"):
    return 200, {"choices": [{"message": {"content": text}, "finish_reason": finish}], "usage": {"prompt_tokens": 3, "completion_tokens": 2}}


def test_gateway():
    waits = []
    caller = lambda *replies: gateway.Caller(Scripted(*replies), waits.append, lambda: 0.0, lambda: 0.5)
    role = gateway.Role("w", "m", max_tokens=10_000)
    ask = [{"role": "user", "content": "q"}]
    own = caller((503, {}), TimeoutError("slow"), (429, {}), said("hi"))
    assert own.complete(role, ask)["text"] == "hi" and waits == [1.5, 3.0, 6.0, 8.0] and own.usage[0][5:7] == (3, 2)
    with pytest.raises(gateway.ModelError):
        caller((400, {})).complete(role, ask)
    with pytest.raises(gateway.EndpointUnavailable):
        caller(ConnectionError("no")).complete(role, ask)
    with pytest.raises(gateway.ModelError):
        caller(*[(500, {})] * 10).complete(role, ask)
    own = caller((200, {"error": "maximum number of tokens"}), said("ok"))
    own.complete(role, ask)
    assert [a["max_tokens"] for a in own.client.asked] == [10_000, 5000]
    own = caller(said("", "length"), said("", "length"), said("done"))
    assert own.complete(role, ask)["text"] == "done" and [a["max_tokens"] for a in own.client.asked] == [10_000, 20_000, 20_000] and own.client.asked[2]["reasoning_effort"] == "low"
    own = caller(said("no json"), said('{"a": 1,}'))
    assert own.complete_json(role, ask)[0] == {"a": 1} and own.client.asked[1]["temperature"] == 0.0 and len(own.usage) == 2
    with pytest.raises(gateway.ModelError) as e:
        caller(said("no"), said("nor this")).complete_json(role, ask)
    assert e.value.raw_text == "nor this"
    own = caller(said('{"items": [{"text": "a"}]}'), said('{"items": [{"text": "a"}, {"text": ""}]}'))
    assert own.request_items(role, ask, 2, ["items"], "text") == ([{"text": "a"}], {"wanted": 2, "got": 1, "payload": {"items": [{"text": "a"}, {"text": ""}]}, "raw_text": '{"items": [{"text": "a"}, {"text": ""}]}'})
    own = caller((200, {"data": [{"index": 1, "embedding": [1.0]}, {"index": 0, "embedding": [0.0]}]}))
    assert own.embed(role, ["x", " "]) == [[0.0], [1.0]] and own.client.asked[0]["input"] == ["x", "empty"]
    with pytest.raises(gateway.ModelError):
        caller((200, {"data": []})).embed(role, ["x"])
    generator = gateway.Role("generator", "big", temperature=0.3, extra_body={"e": 1})
    got = gateway.strong_generic({"generator": generator, "strong_generic": gateway.Role("strong_generic", "big", max_tokens=9)}, {"max_tokens": 9})
    assert (got.max_tokens, got.temperature, got.extra_body) == (9, 0.3, {"e": 1})


def test_payload_edges(spark):
    rows = [("{not json",), ("{}",), ('{"scores": null, "verdict": null}',), ('{"scores": {"fidelity": "x", "judgment_not_terminology": 1e400, "scenario_quality": true, "cue_leakage": "false", "archaic_register": {}}, "judgment_evidence_quote": "q", "issues": "none"}',)]
    got = spark.createDataFrame(rows, "p string").select(P.review_of(F.col("p"), F.lit("r"), F.lit("m")).alias("v"), P.missing_scores(F.col("p")).alias("m")).collect()
    assert [r.v.verdict for r in got] == ["revise"] * 4 and [len(r.m) for r in got] == [9, 9, 9, 4]
    last = got[3].v
    assert (last.scores.fidelity, last.scores.judgment_not_terminology, last.scores.scenario_quality, last.scores.cue_leakage, last.scores.archaic_register, last.issues) == (0, 0, 1, True, False, [])


def test_export(spark, tmp_path):
    df = spark.createDataFrame([("A  quick move. ",), ("IT is late",), ("I agree.",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(X.tidy_phrase(F.col("t"))).collect()] == ["A quick move", "IT is late", "I agree", "", ""]
    assert [r[0] for r in df.select(X.filled("<{{ a }}{{b}}>", {"a": F.col("t"), "b": 1})).limit(1).collect()] == ["<A  quick move. 1>"]
    with pytest.raises(KeyError):
        X.filled("{{x}}", {})
    principles = [("n0", "d0.", ["asks first"], ["rushing ahead"]), ("n1", "d1", [], ["Treats it as done."])]
    rows = spark.createDataFrame(
        [(("does it", "because", (["p"], "waits ")), ("g1", "one fact."), (["a", "b", "c"],), ("divergence",), principles), (("", "", ([], "waits")), (None, ""), None, ("ordinary",), None)],
        "r struct<expected_actions:string,varied_fact_effect:string,hidden:struct<principles_applied:array<string>,intended_divergence_note:string>>, f struct<counterfactual_group_id:string,varied_fact:string>, "
        "v struct<issues:array<string>>, d struct<final_case_type:string>, p array<struct<name:string,description:string,positive_indicators:array<string>,failure_modes:array<string>>>",
    )
    expected, notes = export.grading_key(F.col("p"))
    got = rows.select(expected.alias("e"), notes.alias("n")).collect()
    assert got[0].e == "does it This case is one of a pair that differ in exactly one fact: one fact. because. n0: d0. n1: d1. A generic assistant would probably instead: waits"
    assert got[0].n == ["PASS if the reply asks first.", "FAIL if the reply ends up rushing ahead.", "FAIL if the reply treats it as done.", export.REVIEW_NOTE + "a", export.REVIEW_NOTE + "b"]
    assert (got[1].e, got[1].n) == (export.ADEQUATE, [export.CONCRETE])
    texts = spark.createDataFrame([("see S 1.1 there",), ("S 1.12",), (None,)], "text string")
    assert export.leaked_ids(texts, ["S 1.1", "T"]) == ["S 1.1"] and export.leaked_ids(texts, []) == []
    with pytest.raises(export.ExportError):
        export.require_no_leaks(texts, ["S 1.1"])
    hostile = spark.createDataFrame([(False, "eval", ["cue (x"]), (False, "eval", ["scores"]), (True, "train", [])], "keep boolean, split string, reasons array<string>")
    assert export.admitted(hostile, ["cue ("]).count() == 2
    sources = spark.createDataFrame([("a", "grounding", "public domain"), ("b", "grounding", "CC BY"), ("c", "other", "")], "source_id string, use string, license string")
    export.check_licences(sources, "note")
    for bad, note in ((sources, ""), (sources.union(spark.createDataFrame([("z", "grounding", " ")], sources.schema)), "note")):
        with pytest.raises(export.ExportError):
            export.check_licences(bad, note)
    assert export.redistribution_note("a b", "b") == "a b" and export.redistribution_note("a", "b") == "a b" and export.redistribution_note(None, "b") == "b"
    cites = spark.createDataFrame([("r", k, p, c) for k, (p, c) in enumerate([("x", "1"), ("", "2"), ("x", "3"), ("y", ""), ("z", "5"), ("w", "6")])], "id string, place int, passage_id string, clause string")
    assert export.first_citations(cites).first().ids == ["x", "y", "z"] and export.first_citations(cites).first().notes == {"x": "1", "y": "", "z": "5"}
    export.write_manifest(spark, str(tmp_path / "m.json"), {"é": 1})
    assert json.loads((tmp_path / "m.json").read_text(encoding="utf-8")) == {"é": 1}
    assert report.percent(1, 4) == "25%" and report.calibration_line(0.5, None).startswith("Flagged above **0.500**") and "5 ×2" in "".join(report.conflict_text({"reviews_with_flag_and_five": 2, "reviews_total": 3, "stipulating_prompts": 1}, [("f", "s", 2)]))
    assert "| t |" in report.page("Run", [("Texts", df.limit(1)), ("Words", "none")])
    X.register(spark)
    assert spark.sql("select cosine_of(array(1D, 0D), array(1D, 1D)), ngrams_of(split('a b c', ' '), 2), cue_hits_of('the  Requiem, sol', array('the Requiem', 'so', 'sol')), loose_json('x [1,]')").first()[1:] == (["a b", "b c"], ["the Requiem", "sol"], "[1]")


def test_three_way_of_older_runs(spark):
    ddl = "family_id string, diverges_vs_base boolean, diverges boolean, diverges_vs_generic boolean, closer_to string, generic_differs_from_base boolean, divergence_source string, generic_action string"
    old = spark.createDataFrame([("a", False, True, False, "", False, "", ""), ("b", False, False, False, "", False, "", "")], ddl)
    r = decisions.three_way_summary(decisions.three_way(old)).first()
    assert (r.families, r.candidate_vs_base, r.candidate_vs_generic, r.three_way_recorded) == (2, 1, 0, False)
    mid = spark.createDataFrame([("a", True, False, False, "candidate", False, "value", ""), ("a", True, False, False, "", False, "none", "")], ddl)
    r = decisions.three_way_summary(decisions.three_way(mid)).first()
    assert (r.candidate_vs_base, r.candidate_vs_generic, r.value_every_prompt, r.value_any_prompt) == (1, 1, 0, 1)


def test_config(tmp_path, monkeypatch, spark):
    (tmp_path / "configs").mkdir()
    path = tmp_path / "configs" / "c.json"
    path.write_text(json.dumps({"models": {"w": {"model": "m", "api_key_source": "env:TOY_KEY"}}, "pricing_file": "configs/p.json"}))
    (tmp_path / "configs" / "p.json").write_text(json.dumps({"models": {"m": {"input_per_1m_usd": 1, "output_per_1m_usd": 2}, "free": {}}}))
    own = config.load_config(str(path))
    assert own.price_rows() == [("m", 1.0, 2.0)] and own.role("w").endpoint.endswith("::m") and len(own.digest()) == 12
    with pytest.raises(config.ConfigError):
        own.role("none")
    with pytest.raises(config.ConfigError):
        config.headers(own.role("w"))
    monkeypatch.setenv("TOY_KEY", "secret-key")
    assert config.headers(own.role("w"))["Authorization"] == "Bearer secret-key" and config.api_key(str(tmp_path / "none"), "TOY_KEY") == "secret-key"
    path.write_text(json.dumps({"models": {"w": {"model": "m", "odd": 1}}}))
    with pytest.raises(config.ConfigError):
        config.load_config(str(path))
    runs = [config.run_dir(own, "t", r) for r in ("20240101-000000", "20250101-000000")]
    assert config.run_dir(own, "t") == runs[1]
    for r in (runs[0], config.run_dir(own, "u", "1")):
        with open(f"{r}/responses.jsonl", "w") as f:
            f.write("{}\n")
    assert config.sibling_runs(runs[1]) == {"t": runs[1], "u": config.run_dir(own, "u", "1")}
    (tmp_path / "spec.json").write_text('{"id": "t"}')
    assert len(config.snapshot(own, str(tmp_path / "spec.json"), runs[0])) == 12 and config.spec_snapshot(runs[0]) == {"id": "t"} and config.spec_snapshot(runs[1]) == {}
    assert config.git_commit(str(tmp_path)) == "unknown"
    records.write_records(spark.createDataFrame([(1, "é")], "ordinal long, v string"), str(tmp_path / "out"))
    records.write_records(spark.createDataFrame([(2, "b")], "ordinal long, v string"), str(tmp_path / "out"), append=True)
    assert sorted(json.loads(r.value)["v"] for r in records.read_lines(spark, str(tmp_path / "out")).collect()) == ["b", "é"]
