"""Golden values of the curation operators and their agreement with DuckDB."""

import os
import statistics

import pytest
from pyspark.sql import functions as F

from tessella import catalog
from tessella.functions import loose_json
from tessella.functions import text as X
from tessella.operators import decisions, pairs, similarity, usage
from tessella.sources import records
from tessella.streaming import ledger

SF = "/root/testdata/sf0.001"


def plain_cut(scores, floor, ceiling=0.98):
    """The cut by the definition, in plain Python."""
    if len(scores) < 2:
        return min(ceiling, max(floor, 1.0))
    centre = statistics.median(scores)
    spread = 1.4826 * statistics.median(abs(x - centre) for x in scores)
    if spread <= 0:
        spread = min((b - a for a, b in zip(sorted(scores), sorted(scores)[1:]) if b > a), default=0.0)
    return min(ceiling, max(floor, centre + 3 * spread))


@pytest.mark.parametrize("floor", [0.0, 0.6])
@pytest.mark.parametrize(
    "scores, zeros",
    [([0.22, 0.27, 0.25, 0.24, 0.91], 0), ([0.05, 0.4, 0.41, 0.43], 9), ([0.2] * 7 + [0.23, 0.31], 0), ([0.7] * 5, 0), ([0.3], 0), ([], 0), ([], 3), ([-0.4, 0.1, 0.6, 0.61], 0), ([k / 997 for k in range(1, 900)], 40)],
)
def test_robust_threshold(spark, scores, zeros, floor):
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    got = similarity.robust_threshold(df, zeros, floor=floor).first()
    assert got["n"] == len(scores) + zeros and got["cut"] == pytest.approx(plain_cut(scores + [0.0] * zeros, floor), abs=1e-9)


def test_pair_scores(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5))
    x[7] = 0
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id long, vector array<double>")
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    true = {(a, b): float(unit[a] @ unit[b]) for a in range(60) for b in range(a + 1, 60)}
    scores = pairs.VectorScores(rows, block_rows=16)
    assert similarity.calibrate(scores)["cut"] == pytest.approx(plain_cut(list(true.values()), 0.0), abs=1e-9)
    assert {(r.a_id, r.b_id) for r in scores.at_least(0.5).collect()} == {k for k, v in true.items() if v >= 0.5}
    assert [(r.a_id, r.b_id) for r in scores.top(9).collect()] == sorted(true, key=lambda k: (-true[k], -k[0], -k[1]))[:9]
    groups = spark.createDataFrame([(k, k % 3, "n" if k < 20 else None) for k in range(60)], "id long, group int, never string")
    for same in (0.8, None):
        got = {(r.a_id, r.b_id) for r in similarity.duplicate_edges(scores, 0.4, groups, same).collect()}
        assert got == {(a, b) for (a, b), v in true.items() if not b < 20 and (v >= 0.4 if a % 3 != b % 3 else same is not None and v >= same)}
    texts = [(k, " ".join(str(w) for w in rng.integers(0, 12, rng.integers(0, 9)))) for k in range(40)]
    sets = {k: set(t.split()) for k, t in texts}
    jac = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) if sets[a] | sets[b] else 0.0 for a in sets for b in sets}
    table = spark.createDataFrame(texts, "id long, text string")
    cross = pairs.TokenScores(table, table, block_tokens=40)
    assert len(cross.blocks) > 1 and cross.count() == 1600
    assert similarity.calibrate(cross)["cut"] == pytest.approx(plain_cut(list(jac.values()), 0.0), abs=1e-9)
    assert {(r.a_id, r.b_id): r.score for r in cross.best().collect()} == pytest.approx({(a, min(b for b in sets if jac[a, b] == top)): top for a in sets if (top := max(jac[a, b] for b in sets)) > 0})
    inner = {k: v for k, v in jac.items() if k[0] < k[1]}
    assert similarity.calibrate(similarity.scores_of(table, vectors=False)[0])["cut"] == pytest.approx(plain_cut(list(inner.values()), 0.0), abs=1e-9)


def test_cues(spark):
    terms = ["Mozart", "sol", "the Requiem", " ", "a.b"]
    df = spark.createDataFrame([("MOZART wrote",), ("console, solar, resolve",), ("the \t Requiem",), ("ésol Sol!",), ("aXb a.b",)], "t string")
    assert [list(r[0]) for r in df.select(X.cue_hits(F.col("t"), terms)).collect()] == [["Mozart"], [], ["the Requiem"], ["sol"], ["a.b"]]


def test_tokens_and_ids(spark):
    df = spark.createDataFrame([("Don't Panic, now.",)], "t string")
    row = df.select(X.tokens(F.col("t")).alias("t"), X.short_id("x", F.lit("fam"), F.lit("a")).alias("i"), X.ngrams(F.split(F.lit("a b c d e"), " "), 4).alias("n")).first()
    assert set(row.t) == {"don't", "panic", "now"} and row.i == "x_ada7e91778" and row.n == ["a b c d", "b c d e"]


def test_greedy_duplicates_against_a_fold(spark):
    import random

    rng = random.Random(7)
    n = 40
    edges = {(a, b): round(rng.random(), 2) + 0.01 for a in range(n) for b in range(a + 1, n) if rng.random() < 0.08}
    kept, expected = [], {}
    for k in range(n):
        near = [(-edges[r, k], r) for r in kept if (r, k) in edges]
        expected[k] = min(near)[1] if near else None
        if not near:
            kept.append(k)
    nodes = spark.createDataFrame([(k,) for k in range(n)], "id long")
    got = similarity.greedy_duplicates(nodes, spark.createDataFrame([(a, b, s) for (a, b), s in edges.items()], "a_id long, b_id long, score double"))
    assert {r.id: r.duplicate_of for r in got.collect()} == expected


@pytest.mark.parametrize("n, few", [(450, similarity.FEW_EDGES), (9, 3)])
def test_greedy_duplicates_along_a_chain(spark, n, few):
    nodes = spark.range(n)
    edges = spark.range(n - 1).selectExpr("id as a_id", "id + 1 as b_id", "0.9D as score")
    got = {r.id: r.duplicate_of for r in similarity.greedy_duplicates(nodes, edges, few).collect()}
    assert got == {k: k - 1 if k % 2 else None for k in range(n)}


def test_family_rates(spark):
    rows = [("both", "value"), ("both", "value"), ("one", "value"), ("one", "capability"), ("none", "capability"), ("none", "capability")]
    r = decisions.family_rates(spark.createDataFrame(rows, "family string, source string")).first()
    assert (r.n_value, r.n_any, r.intended, r.value_rate, r.any_rate) == (1, 2, 3, 0.333, 0.667)


def test_usage_poison(spark):
    led = spark.createDataFrame([("a", "x/big", 10**6, 10**6, None), ("a", "free", 5, 5, None), ("b", "odd", 1, 1, None)], "stage string, model string, prompt_tokens long, completion_tokens long, cost_usd double")
    prices = spark.createDataFrame([("big", 2.0, 6.0), ("free", 0.0, 0.0)], "model string, input double, output double")
    got = {(r.level, r.name): (r.cost_usd, r.cost_known) for r in usage.rollup(usage.priced(led, prices)).collect()}
    assert got["stage", "a"] == (8.0, True) and got["total", ""] == (8.0, False) and got["model", "odd"][1] is False


def test_loose_json():
    assert loose_json.parse('well: {"a": [1, 2,], "b": "}"} ok') == {"a": [1, 2], "b": "}"}
    assert loose_json.parse("```json\n[1]\n```") == [1] and loose_json.parse("none") is None
    assert loose_json.items({"x": {"families": [1]}}, "families") == [1] and loose_json.items({"a": 1}, "k") == []
    fits = lambda x: isinstance(x, dict) and bool(x.get("text"))
    assert loose_json.items({"n": [1], "p": [{"text": "a"}]}, "q", fits=fits) == [{"text": "a"}] and loose_json.items({"text": "a"}, "q", fits=fits) == [{"text": "a"}]
    assert loose_json.items({"r": {"text": "a"}, "n": 1}, "q", fits=fits) == [{"text": "a"}] and loose_json.items({"a": [1], "b": [2]}, "q") == []
    assert loose_json.one_text({"text": " ", "prompt": "x", "more": "y"}, "text", "prompt") == "x" and loose_json.one_text({"a": "x", "b": "y"}) == ""


def test_records(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"prompt_id": "p1", "extra": 1}\n\n{"prompt_id": "p2", "mode": "explicit"}\n')
    rows = records.read_records(spark, str(tmp_path / "p.jsonl"), "prompt").orderBy("ordinal").collect()
    assert [(r.prompt_id, r.mode) for r in rows] == [("p1", "neutral"), ("p2", "explicit")]
    assert records.read_records(spark, str(tmp_path / "none.jsonl"), "prompt").count() == 0
    (tmp_path / "bad.jsonl").write_text("{not json\n")
    with pytest.raises(Exception):
        records.read_records(spark, str(tmp_path / "bad.jsonl"), "prompt").collect()
    text = spark.createDataFrame([("s", "intro\n## HCP 1.1 — On rest\nbody one\n### 2.2\nmore\n")], "source string, text string")
    assert [(r.passage_id, r.title, r.body) for r in records.parse_passages(text).orderBy("place").collect()] == [("HCP 1.1", "On rest", "body one"), ("2.2", "", "more")]


def test_streaming_ledger(spark, tmp_path):
    rows = [("2024-01-01 00:10:00", "a", 1.0), ("2024-01-01 00:20:00", "a", 2.0), ("2024-01-01 03:00:00", "b", 5.0)]
    spark.createDataFrame(rows, "ts string, stage string, amount double").select(F.col("ts").cast("timestamp").alias("ts"), "stage", "amount").write.json(str(tmp_path / "in"))
    stream = ledger.read_ledger(spark, str(tmp_path / "in"), "ts timestamp, stage string, amount double")
    q = ledger.windowed_usage(stream).writeStream.outputMode("complete").format("memory").queryName("ledger_out").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.stage, r.calls, r.amount) for r in spark.table("ledger_out").collect()) == [("a", 2, 3.0), ("b", 1, 5.0)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_duckdb(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = catalog.queries()[name](spark, SF)
    cols = sorted(df.columns)
    r = con.execute(catalog.oracle_sql()[name])
    theirs = [d[0] for d in r.description]
    plain = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else (v.replace(tzinfo=None).isoformat() if hasattr(v, "isoformat") else v)
    own = sorted((tuple(plain(x[c]) for c in cols) for x in df.collect()), key=repr)
    assert sorted(theirs) == cols
    assert own == sorted((tuple(plain(x[theirs.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
