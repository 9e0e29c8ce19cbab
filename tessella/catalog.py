"""The engine's queries over the driver tables, each with the SQL that it is held against where SQL can say it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import text as X
from .functions.loose_json import loose_json
from .operators import coverage, decisions, export, gateway, similarity, style, usage
from .operators.pairs import TokenScores, VectorScores
from .plans import planner
from .sources import records
from .streaming import ledger

_QUERIES: dict = {}
_SQL: dict[str, str] = {}

TERMS = ["que la", "the", "und", "heon", "der", "éthe"]
FORBIDDEN, SOFT = ["worthless", "heon", "que la"], ["der", "and"]
PRICES = [("click", 2.0, 6.0), ("view", 0.5, 1.5), ("purchase", 0.0, 0.0)]
TOKENS = "list_distinct(regexp_extract_all(lower({0}), '[a-z0-9'']+'))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def both(name: str, sql: str) -> None:
    """A query that is plain SQL in both engines; {table} names a table."""
    names = sorted(set(re.findall(r"\{(\w+)\}", sql)))

    def run(spark, sf_dir):
        return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})

    _QUERIES[name] = run
    _SQL[name] = re.sub(r"\{(\w+)\}", r"\1", sql)


def queries():
    from . import catalog_runs  # registers its queries here

    return {**_QUERIES, **catalog_runs.QUERIES}


def oracle_sql():
    from . import catalog_runs

    return {**_SQL, **catalog_runs.SQL}


# --- similarity -------------------------------------------------------------------------------------------------

_CROSS = f"""
b as (select item_id, {TOKENS.format('text')} as t from benchmark),
d as (select doc_id, {TOKENS.format('text')} as t from documents),
x as (select item_id, len(t) as n, unnest(t) as w from b),
y as (select doc_id, len(t) as n, unnest(t) as w from d),
shared as (select x.item_id, y.doc_id, any_value(x.n) as na, any_value(y.n) as nb, count(*) as s from x join y using (w) group by 1, 2),
scores as (select item_id, doc_id, s / (na + nb - s) as score from shared)"""
_BEST = """
best as (select item_id, max(struct_pack(s := score, m := -doc_id)) as it from scores group by 1),
matched as (select b.item_id, -it.m as best_doc_id, coalesce(it.s, 0.0) as score from b left join best using (item_id))"""


def _cross(spark, sf_dir):
    left = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return left, TokenScores(left, table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"))


def flagship(spark, sf_dir):
    return max_leakage(spark, sf_dir).orderBy(F.desc("score"), "item_id")


@query(f"with {_CROSS}, {_BEST} select item_id, best_doc_id, round(score, 6) as score from matched")
def max_leakage(spark, sf_dir):
    left, scores = _cross(spark, sf_dir)
    return similarity.best_match(scores, left).select(F.col("id").alias("item_id"), F.col("best_id").alias("best_doc_id"), F.round("score", 6).alias("score"))


@query(
    f"""with {_CROSS}, {_BEST},
counted as (select count(*) as n from scores), every as (select (select count(*) from b) * (select count(*) from d) as n),
allscores as (select score from scores union all select 0.0 from range((select every.n - counted.n from every, counted))),
c as (select median(score) as m from allscores), s as (select 1.4826 * median(abs(score - m)) as w from allscores, c),
cut as (select least(greatest(m + 3 * w, 0.35), 0.98) as cut from c, s)
select item_id, best_doc_id, round(score, 6) as score, round(cut, 6) as cut, score >= cut as flagged from matched, cut"""
)
def leakage_flagged(spark, sf_dir):
    left, scores = _cross(spark, sf_dir)
    cut = similarity.calibrate(scores, floor=0.35)["cut"]
    return similarity.best_match(scores, left).select(
        F.col("id").alias("item_id"), F.col("best_id").alias("best_doc_id"), F.round("score", 6).alias("score"), F.lit(round(cut, 6)).alias("cut"), (F.col("score") >= cut).alias("flagged")
    )


@query(f"select doc_id, cast(len({TOKENS.format('text')}) as bigint) as n_tokens from documents")
def token_stats(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(X.tokens(F.col("text"))).cast("long").alias("n_tokens"))


@query(f"with {_CROSS} select item_id, doc_id, round(score, 6) as score from scores where score >= 0.25")
def jaccard_pairs(spark, sf_dir):
    return _cross(spark, sf_dir)[1].at_least(0.25).select(F.col("a_id").alias("item_id"), F.col("b_id").alias("doc_id"), F.round("score", 6).alias("score"))


_PAIRS = """v as (select vec_id, list_transform(embedding, lambda e: cast(e as double)) as e, label from embeddings),
pairs as (select a.vec_id as a_id, b.vec_id as b_id, a.label as la, b.label as lb, list_cosine_similarity(a.e, b.e) as score from v a join v b on a.vec_id < b.vec_id),
c as (select median(score) as m from pairs), s as (select 1.4826 * median(abs(score - m)) as w from pairs, c),
cut as (select least(greatest(m + 3 * w, 0.0), 0.98) as cut from c, s)"""


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def _calibrated(spark, sf_dir):
    scores = similarity.scores_of(_vectors(spark, sf_dir), vectors=True)[0]
    return scores, similarity.calibrate(scores)


def _rounded(pairs):
    return pairs.select("a_id", "b_id", F.round("score", 6).alias("score"))


@query(f"with {_PAIRS} select a_id, b_id, round(score, 6) as score from pairs order by pairs.score desc, a_id desc, b_id desc limit 50")
def cosine_top50(spark, sf_dir):
    return _rounded(VectorScores(_vectors(spark, sf_dir)).top(50))


@query(f"with {_PAIRS} select (select count(*) from pairs) as n, round(m, 6) as centre, round(w, 6) as spread, round(cut, 6) as cut from c, s, cut")
def robust_threshold(spark, sf_dir):
    cut = similarity.calibration_row(spark, _calibrated(spark, sf_dir)[1])
    return cut.select("n", *(F.round(c, 6).alias(c) for c in ("centre", "spread", "cut")))


@query(f"with {_PAIRS} select a_id, b_id, round(score, 6) as score from pairs, cut where score >= cut")
def dup_edges(spark, sf_dir):
    scores, found = _calibrated(spark, sf_dir)
    return _rounded(similarity.duplicate_edges(scores, found["cut"]))


@query(f"with {_PAIRS} select a_id, b_id, round(score, 6) as score from pairs, cut where score >= case when la = lb then greatest(cut, 0.5) else cut end")
def dup_edges_grouped(spark, sf_dir):
    scores, found = _calibrated(spark, sf_dir)
    groups = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("group"), F.lit(None).cast("string").alias("never"))
    return _rounded(similarity.duplicate_edges(scores, found["cut"], groups, max(found["cut"], 0.5)))


@query(
    f"""with recursive {_PAIRS}, edges as (select a_id, b_id, score from pairs, cut where score >= cut and score > 0),
ordered as (select vec_id, row_number() over (order by vec_id) as k from v),
walk(k, reps) as (
  select cast(0 as bigint), cast([] as bigint[]) union all
  select o.k, case when exists (select 1 from edges e where e.b_id = o.vec_id and list_contains(w.reps, e.a_id)) then w.reps else list_append(w.reps, o.vec_id) end
  from walk w join ordered o on o.k = w.k + 1),
final as (select reps from walk order by k desc limit 1),
kept as (select unnest(reps) as id from final),
best as (select b_id, max(struct_pack(s := score, m := -a_id)) as it from edges where a_id in (select id from kept) and b_id not in (select id from kept) group by 1)
select vec_id, -it.m as duplicate_of, round(it.s, 6) as score from v left join best on b_id = vec_id"""
)
def near_dup_greedy(spark, sf_dir):
    scores, found = _calibrated(spark, sf_dir)
    kept = similarity.greedy_duplicates(_vectors(spark, sf_dir).select("id"), similarity.duplicate_edges(scores, found["cut"]))
    return kept.select(F.col("id").alias("vec_id"), "duplicate_of", F.round("score", 6).alias("score"))


@query(
    f"""with {_PAIRS}, {_CROSS},
a as (select 'dedupe' as kind, a_id, b_id, round(score, 4) as score from pairs order by pairs.score desc, a_id desc, b_id desc limit 50),
l as (select 'leakage' as kind, item_id as a_id, doc_id as b_id, round(score, 4) as score from scores order by scores.score desc, item_id desc, doc_id desc limit 50)
select * from a union all select * from l"""
)
def similarity_pairs(spark, sf_dir):
    top = lambda scores, kind: scores.top(50).select(F.lit(kind).alias("kind"), "a_id", "b_id", F.round("score", 4).alias("score"))
    return top(VectorScores(_vectors(spark, sf_dir)), "dedupe").union(top(_cross(spark, sf_dir)[1], "leakage"))


@query(
    f"""with t as (select doc_id, lang, {TOKENS.format('text')} as t from documents),
pairs as (select a.doc_id as base_id, b.doc_id as variant_id, len(list_intersect(a.t, b.t)) / greatest(len(list_distinct(list_concat(a.t, b.t))), 1) as score
          from t a join t b on b.doc_id = a.doc_id + 1)
select base_id, variant_id, round(score, 6) as score, score > 0.55 as dropped from pairs"""
)
def reframing_overlap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", X.tokens(F.col("text")).alias("t"))
    base = docs.select(F.col("doc_id").alias("base_id"), F.col("t").alias("a"), (F.col("doc_id") + 1).alias("variant_id"))
    both_sides = base.join(docs.select(F.col("doc_id").alias("variant_id"), F.col("t").alias("b")), "variant_id")
    score = X.jaccard(F.col("a"), F.col("b"))
    return both_sides.select("base_id", "variant_id", F.round(score, 6).alias("score"), (score > 0.55).alias("dropped"))


# --- cues, phrases, identifiers ---------------------------------------------------------------------------------


def _cue_sql(terms):
    tests = [
        r"case when regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])" + r"\s+".join(t.split()) + r"($|[^\p{L}\p{N}_])') then '" + t + "' end" for t in terms
    ]
    return "list_filter([" + ", ".join(tests) + "], lambda h: h is not null)"


@query(f"select doc_id, array_to_string({_cue_sql(TERMS)}, ',') as hits from documents")
def cue_hits(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(X.cue_hits(F.col("text"), TERMS), ",").alias("hits"))


@query(
    f"""with h as (select doc_id, lang = 'de' as explicit, {_cue_sql(FORBIDDEN)} as hard, {_cue_sql(SOFT)} as soft from documents)
select doc_id, explicit or len(hard) = 0 as keep, case when explicit then '' else array_to_string(hard, ',') end as hard_hits, array_to_string(list_sort(soft), ',') as soft_hits from h"""
)
def cue_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.col("lang") == "de").alias("explicit"), X.cue_hits(F.col("text"), FORBIDDEN).alias("hard"), X.cue_hits(F.col("text"), SOFT).alias("soft"))
    return rows.select(
        "doc_id",
        (F.col("explicit") | (F.size("hard") == 0)).alias("keep"),
        F.when(F.col("explicit"), "").otherwise(F.array_join("hard", ",")).alias("hard_hits"),
        F.array_join(F.sort_array("soft"), ",").alias("soft_hits"),
    )


@query(r"select page_id, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(html, '\[([^\[\]\n]{1,60})\]', 1), lambda x: regexp_matches(x, '[A-Za-z]') and not regexp_matches(x, '[0-9]')))), ',') as found from pages")
def placeholders(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.sort_array(X.placeholders(F.col("html"))), ",").alias("found"))


@query("select doc_id, 'fam_' || substr(sha256(coalesce(lang, '') || '|' || coalesce(source, '') || '|' || cast(doc_id as varchar)), 1, 10) as family_id, coalesce(lang, '') || '|' || coalesce(source, '') as structural_key from documents")
def short_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.short_id("fam", F.col("lang"), F.col("source"), F.col("doc_id")).alias("family_id"), X.structural_key(F.col("lang"), F.col("source")).alias("structural_key"))


@query("select doc_id, cast(('0x' || substr(sha256(cast(doc_id as varchar)), 1, 8)) as bigint) % 1000 / 1000 < 0.3 as kept from documents")
def hash_sample(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.keeps_share(F.col("doc_id"), 0.3).alias("kept"))


@query(r"select page_id, substr(regexp_replace(url, '[^A-Za-z0-9_.-]+', '_', 'g'), 1, 60) as name from pages")
def safe_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.safe_name(F.col("url")).alias("name"))


_GRAMS = r"""w as (select lang as label, regexp_extract_all(lower(text), '[a-z'']+') as w from documents),
g as (select label, unnest(case when len(w) >= 4 then list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) else [] end) as phrase from w),
sizes as (select label, count(*) as texts from w group by 1),
shares as (select label, phrase, count(*) / any_value(texts) as share from g join sizes using (label) group by 1, 2)"""


def _shares(spark, sf_dir):
    return style.presence(table(spark, sf_dir, "documents").select(F.col("lang").alias("label"), "text"))


@query(f"with {_GRAMS} select label, phrase, round(share, 6) as share from shares where share >= 0.02")
def ngram_presence(spark, sf_dir):
    return _shares(spark, sf_dir).where("share >= 0.02").select("label", "phrase", F.round("share", 6).alias("share"))


@query(f"with {_GRAMS}, t as (select phrase, count(*) filter (share >= 0.03) as labels, avg(share) as mean from shares group by 1) select phrase, labels, round(mean, 6) as mean from t where labels > 0 order by labels desc, round(t.mean, 9) desc, phrase limit 15")
def house_style(spark, sf_dir):
    return style.style_table(_shares(spark, sf_dir), 0.03).select("phrase", "labels", F.round("mean", 6).alias("mean"))


@query(f"with {_GRAMS}, h as (select label, list(phrase) as p from shares where share >= 0.02 group by 1) select a.label as a, b.label as b, round(len(list_intersect(a.p, b.p)) / len(list_distinct(list_concat(a.p, b.p))), 6) as jaccard from h a join h b on a.label < b.label")
def shared_style(spark, sf_dir):
    return style.shared_style(_shares(spark, sf_dir), 0.02).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


# --- decisions ----------------------------------------------------------------------------------------------------


@query(
    f"""with c as (select doc_id, n_chars, lang, {_cue_sql(FORBIDDEN)} as hard, quality, toxic from documents left join labels using (doc_id)),
r as (select doc_id, list_filter([
  case when quality = 0 then 'reviewer: low quality' end, case when toxic = 1 then 'reviewer: toxic' end,
  case when len(hard) > 0 then 'cue terms: ' || array_to_string(hard, ',') end, case when quality is null then 'no review' end, case when n_chars < 200 then 'short' end], lambda x: x is not null) as reasons,
  not coalesce(quality = 0, false) and not coalesce(toxic = 1, false) and len(hard) = 0 as keep from c)
select doc_id, keep, array_to_string(reasons, '; ') as reasons from r"""
)
def decision_reasons(spark, sf_dir):
    return _decided(spark, sf_dir).select("doc_id", "keep", F.array_join("reasons", "; ").alias("reasons"))


def _decided(spark, sf_dir):
    hard = X.cue_hits(F.col("text"), FORBIDDEN)
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", hard.alias("hard")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return decisions.decide(
        rows,
        [
            ("reviewer: low quality", F.col("quality") == 0, True),
            ("reviewer: toxic", F.col("toxic") == 1, True),
            (F.concat(F.lit("cue terms: "), F.array_join("hard", ",")), F.size("hard") > 0, True),
            ("no review", F.col("quality").isNull(), False),
            ("short", F.col("n_chars") < 200, False),
        ],
    )


@query(
    """with r as (""" + _SQL["decision_reasons"] + """), u as (select unnest(string_split(reasons, '; ')) as reason from r where reasons != '')
select case when starts_with(reason, 'cue terms') then 'cue terms' when starts_with(reason, 'reviewer') then 'reviewer' else substr(reason, 1, 60) end as bucket, count(*) as n from u group by 1"""
)
def reason_buckets(spark, sf_dir):
    reason = F.col("reason")
    bucket = F.when(reason.startswith("cue terms"), "cue terms").when(reason.startswith("reviewer"), "reviewer").otherwise(F.substring(reason, 1, 60))
    return _decided(spark, sf_dir).select(F.explode("reasons").alias("reason")).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query(
    """with r as (""" + _SQL["decision_reasons"] + """), s as (select r.*, case when doc_id % 4 = 0 then 'eval' else 'train' end as split from r)
select doc_id, not keep as readmitted from s where keep or (split = 'eval' and not regexp_matches(reasons, '(^|; )(cue terms|reviewer: toxic)'))"""
)
def eval_readmission(spark, sf_dir):
    rows = _decided(spark, sf_dir).withColumn("split", F.when(F.col("doc_id") % 4 == 0, "eval").otherwise("train"))
    return export.admitted(rows, ["cue terms", "reviewer: toxic"]).select("doc_id", "readmitted")


@query("""select count(*) as n, count(*) filter (keep) as kept, count(*) filter (contains(reasons, 'toxic')) as toxic, count(*) filter (contains(reasons, 'no review')) as unreviewed,
 count(*) filter (contains(reasons, 'cue terms')) as cued from (""" + _SQL["decision_reasons"] + ")")
def validation_summary(spark, sf_dir):
    has = lambda p: F.count_if(F.exists("reasons", lambda r: F.contains(r, F.lit(p))))
    return _decided(spark, sf_dir).agg(F.count("*").alias("n"), F.count_if("keep").alias("kept"), has("toxic").alias("toxic"), has("no review").alias("unreviewed"), has("cue terms").alias("cued"))


def _verdicts(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    source = F.when(F.col("l_returnflag") == "A", "value").when(F.col("l_returnflag") == "R", "capability")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(F.col("o_custkey").alias("family"), source.alias("source"))


_FAMILY = """f as (select o_custkey as family, case l_returnflag when 'A' then 'value' when 'R' then 'capability' end as source from orders left join lineitem on o_orderkey = l_orderkey),
p as (select family, bool_or(source is not null) as judged, bool_and(source = 'value') as every, bool_or(source = 'value') as one from f group by 1)"""


@query(f"with {_FAMILY} select count(*) as intended, count(*) filter (judged) as judged, count(*) filter (every) as n_value, count(*) filter (one) as n_any, round_even(count(*) filter (every) / count(*), 3) as value_rate, round_even(count(*) filter (one) / count(*), 3) as any_rate from p")
def family_every_any(spark, sf_dir):
    return decisions.family_rates(_verdicts(spark, sf_dir))


@query(f"with {_FAMILY} select family, coalesce(every, false) as every_value, coalesce(one, false) as any_value, judged from p")
def three_way(spark, sf_dir):
    is_value = F.when(F.col("source").isNotNull(), F.col("source") == "value")
    return _verdicts(spark, sf_dir).groupBy("family").agg(
        F.coalesce(F.min(is_value), F.lit(False)).alias("every_value"), F.coalesce(F.max(is_value), F.lit(False)).alias("any_value"), F.max(F.col("source").isNotNull()).alias("judged")
    )


_REVIEWS = """r as (select doc_id as id, cast(3 + 2 * quality - doc_id % 2 as int) as fidelity, cast(5 - doc_id % 3 as int) as judgment, toxic = 1 as leak, doc_id % 5 = 0 as formulaic from labels)"""


def _reviews(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), (3 + 2 * F.col("quality") - F.col("doc_id") % 2).cast("int").alias("fidelity"), (5 - F.col("doc_id") % 3).cast("int").alias("judgment"), (F.col("toxic") == 1).alias("leak"), (F.col("doc_id") % 5 == 0).alias("formulaic")
    )


@query(f"with {_REVIEWS} select id, case when formulaic or leak then least(judgment, 3) else judgment end as judgment, fidelity >= 4 and case when formulaic or leak then least(judgment, 3) else judgment end >= 3 as passes from r")
def review_caps(spark, sf_dir):
    score = decisions.capped(F.col("judgment"), [F.col("formulaic"), F.col("leak")])
    return _reviews(spark, sf_dir).select("id", score.alias("judgment"), ((F.col("fidelity") >= 4) & (score >= 3)).alias("passes"))


@query(f"with {_REVIEWS}, t as (select unnest(list_filter([case when leak then 'leak' end, case when formulaic then 'formulaic' end], lambda x: x is not null)) as flag, list_filter([case when fidelity = 5 then 'fidelity' end, case when judgment = 5 then 'judgment' end], lambda x: x is not null) as g from r), u as (select flag, unnest(g) as score from t) select flag, score, count(*) as n from u group by 1, 2")
def flag_conflicts(spark, sf_dir):
    return decisions.flag_conflicts(_reviews(spark, sf_dir), ["leak", "formulaic"], ["fidelity", "judgment"])


@query(f"with {_REVIEWS} select round(avg(fidelity), 6) as fidelity, round(avg(judgment), 6) as judgment, round(avg(cast(leak as int)), 6) as leak_rate from r")
def mean_scores(spark, sf_dir):
    return _reviews(spark, sf_dir).agg(F.round(F.avg("fidelity"), 6).alias("fidelity"), F.round(F.avg("judgment"), 6).alias("judgment"), F.round(F.avg(F.col("leak").cast("int")), 6).alias("leak_rate"))


@query(f"with {_REVIEWS}, a as (select id, fidelity as s, case when fidelity >= 4 then 'keep' else 'revise' end as v from r), b as (select id, judgment as s, case when judgment >= 4 then 'keep' else 'revise' end as v from r) select count(*) as n, round(avg(a.s), 6) as mean_first, round(avg(b.s), 6) as mean_second, count(*) filter (a.s = b.s) as exact, count(*) filter (abs(a.s - b.s) <= 1) as within_one, count(*) filter (a.v = b.v) as same_verdict from a join b using (id)")
def reviewer_agreement(spark, sf_dir):
    r = _reviews(spark, sf_dir)
    side = lambda c: r.select("id", F.col(c).alias("score"), F.when(F.col(c) >= 4, "keep").otherwise("revise").alias("verdict"))
    return decisions.agreement(side("fidelity"), side("judgment"))


@query("""with j as (select doc_id, case when quality = 1 then 'VALUE' when toxic = 1 then 'capability' else 'odd' end as raw, doc_id % 7 = 0 as same_claim, case when doc_id % 3 = 0 then '' else 'named' end as value_named from labels),
s as (select *, case when same_claim then 'capability' when lower(raw) in ('value', 'capability', 'stipulated', 'none') then lower(raw) else 'none' end as source from j)
select doc_id, source, value_named != '' and source = 'value' as diverges from s""")
def verdict_gates(spark, sf_dir):
    raw = F.when(F.col("quality") == 1, "VALUE").when(F.col("toxic") == 1, "capability").otherwise("odd")
    payload = F.to_json(F.struct(raw.alias("source"), (F.col("doc_id") % 7 == 0).alias("same_claim"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("named").alias("value_named")))
    it = F.from_json(payload, "source string, same_claim boolean, value_named string")
    rows = table(spark, sf_dir, "labels").select("doc_id", it.alias("it"))
    known = F.lower("it.source").isin("value", "capability", "stipulated", "none")
    source = F.when(F.col("it.same_claim"), "capability").when(known, F.lower("it.source")).otherwise("none")
    return rows.select("doc_id", source.alias("source"), ((F.col("it.value_named") != "") & (source == "value")).alias("diverges"))


# --- usage --------------------------------------------------------------------------------------------------------


def _ledger(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("stage"), F.concat(F.lit("hub/"), F.element_at(F.array(*map(F.lit, ["click", "view", "purchase", "other"])), (F.col("user_id") % 4 + 1).cast("int"))).alias("model"),
        F.col("event_id").alias("prompt_tokens"), (F.col("event_id") % 97).alias("completion_tokens"), F.lit(None).cast("double").alias("cost_usd"),
    )


_PRICED = """l as (select event_type as stage, ['click', 'view', 'purchase', 'other'][user_id % 4 + 1] as tail, event_id as p, event_id % 97 as c from events),
prices(tail, i, o) as (values ('click', 2.0, 6.0), ('view', 0.5, 1.5), ('purchase', 0.0, 0.0)),
k as (select stage, 'hub/' || l.tail as model, p, c, cast((p * i + c * o) / 1e6 as double) as cost from l left join prices using (tail))"""


@query(
    f"""with {_PRICED} select case when grouping(stage) = 1 and grouping(model) = 1 then 'total' when grouping(model) = 1 then 'stage' else 'model' end as level, coalesce(stage, model, '') as name, count(*) as calls,
 cast(sum(p) as bigint) as prompt_tokens, cast(sum(c) as bigint) as completion_tokens, round(sum(cost), 4) as cost_usd, bool_and(cost is not null) as cost_known from k group by grouping sets ((), (stage), (model))"""
)
def usage_rollup(spark, sf_dir):
    prices = spark.createDataFrame(PRICES, "model string, input double, output double")
    return usage.rollup(usage.priced(_ledger(spark, sf_dir), prices))


@query(f"with {_PRICED}, t as (select stage, sum(cost) as cost, bool_and(cost is not null) as known from k group by 1) select stage, case when known then printf('$%.4f', cost) else printf('unknown (at least $%.4f)', coalesce(cost, 0)) end as cost from t")
def usage_cost_text(spark, sf_dir):
    prices = spark.createDataFrame(PRICES, "model string, input double, output double")
    per = usage.priced(_ledger(spark, sf_dir), prices).groupBy("stage").agg(F.sum("cost_usd").alias("c"), F.min(F.col("cost_usd").isNotNull()).alias("known"))
    return per.select("stage", usage.cost_text(F.col("known"), F.col("c")).alias("cost"))


@query("select date_trunc('hour', ts) as window_start, event_type as stage, count(*) as calls, round(sum(value), 4) as amount from events group by 1, 2")
def usage_windows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("stage"), F.col("value").alias("amount"))
    return ledger.windowed_usage(events).select("window_start", "stage", "calls", F.round("amount", 4).alias("amount"))


# --- planning -----------------------------------------------------------------------------------------------------

_QUOTA = """s as (select c_nationkey as place, 'n' || c_nationkey as key, cast(count(*) as double) as weight from customer group by 1),
e as (select *, weight / sum(weight) over () * 240 as exact from s), f as (select *, floor(exact) as whole from e),
q as (select key, place, weight, cast(whole + case when row_number() over (order by round(exact - whole, 9) desc, place) <= 240 - sum(whole) over () then 1 else 0 end as bigint) as quota from f)"""


def _quotas(spark, sf_dir):
    shares = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("place")).agg(F.count("*").cast("double").alias("weight"))
    return coverage.largest_remainder(shares.withColumn("key", F.concat(F.lit("n"), "place")), 240)


@query(f"with {_QUOTA} select key, quota from q")
def largest_remainder(spark, sf_dir):
    return _quotas(spark, sf_dir).select("key", F.col("quota").cast("long").alias("quota"))


@query(f"with {_QUOTA}, t as (select key, place, unnest(range(quota)) as turn from q) select row_number() over (order by turn, place) - 1 as slot, key from t")
def proportional_interleave(spark, sf_dir):
    return coverage.interleaved(_quotas(spark, sf_dir)).select(F.col("slot").cast("long").alias("slot"), "key")


@query("select p.s_suppkey as slot, n.n_name as key from supplier p join (select n_name, row_number() over (order by n_nationkey) - 1 as spot, count(*) over () as size from nation) n on (select count(*) from supplier q where q.s_suppkey < p.s_suppkey) % size = spot")
def coverage_cycle(spark, sf_dir):
    pool = table(spark, sf_dir, "nation").select(F.col("n_name").alias("key"), F.col("n_nationkey").alias("place"))
    return coverage.coverage_cycle(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("slot")), pool).select("slot", "key")


@query("""with r as (select p_partkey as key, p_size as stratum, row_number() over (partition by p_size order by p_partkey) - 1 as k from part),
s as (select stratum, count(*) as n, count(*) * 55.0 / (select count(*) from part) as exact from r group by 1),
q as (select stratum, n, cast(floor(exact) + case when row_number() over (order by round(exact - floor(exact), 9) desc, stratum) <= 55 - (select sum(floor(exact)) from s) then 1 else 0 end as bigint) as quota from s),
spots as (select stratum, least(n - 1, cast(floor(0.3 * n / quota + j * n / quota) as bigint)) as k from q, range(60) t(j) where j < quota),
hit as (select distinct stratum, k from spots),
m as (select r.*, q.quota, h.k is not null as hit from r join q using (stratum) left join hit h on h.stratum = r.stratum and h.k = r.k),
c as (select *, quota - count(*) filter (hit) over (partition by stratum) as lacking, row_number() over (partition by stratum order by hit, k) as missed from m)
select key, stratum from c where hit or missed <= lacking""")
def stratified_pick(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("stratum"), F.col("p_partkey").alias("place"))
    return coverage.stratified_pick(rows, 55, 0.3).select("key", "stratum")


@query("select doc_id, source, cast(floor((row_number() over (partition by source order by doc_id) - 1) / 6) as bigint) as batch from documents")
def even_batches(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("source").alias("stratum"), F.col("doc_id").alias("place"))
    return coverage.even_batches(rows, 7).select("doc_id", "source", F.col("batch").cast("long").alias("batch"))


@query("with r as (select doc_id, lang, sum(n_chars) over (partition by lang order by doc_id rows unbounded preceding) as running, row_number() over (partition by lang order by doc_id) as k from documents) select doc_id, lang, cast(running as bigint) as running from r where running <= 20000 or k = 1")
def running_budget(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("doc_id").alias("place"), F.col("n_chars").alias("length"))
    return coverage.within_budget(rows, 20000, "lang").select("doc_id", "lang", "running")


def _toy_plan(spark, sf_dir):
    domains = {r[0]: float(r[1]) for r in table(spark, sf_dir, "customer").groupBy("c_mktsegment").count().orderBy("c_mktsegment").collect()}
    target = planner.Target("toy", domains, ["speed", "candour", "care", "promise"], ["candour", "promise"], ["which_heir"], ["h1", "h2", "h3"], {"trade": ["a depot", "a yard"], "town": ["a library"]})
    settings = planner.Settings(families=240, divergence=0.4, eval_share=0.25, reserved_share=0.05, counterfactual=0.3, explicit=0.1, held_out=1)
    return target, settings


@query()
def full_plan(spark, sf_dir):
    return planner.checked_plan(spark, *_toy_plan(spark, sf_dir))


@query()
def plan_check(spark, sf_dir):
    target, settings = _toy_plan(spark, sf_dir)
    return planner.check(planner.as_table(spark, planner.plan(target, settings)), target, settings)


# --- runs, export -------------------------------------------------------------------------------------------------


@query("select event_type as target_id, max(user_id) as run_id from events group by 1")
def latest_run(spark, sf_dir):
    return records.latest_run(table(spark, sf_dir, "events").select(F.col("event_type").alias("target_id"), F.col("user_id").alias("run_id")))


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by event_id desc) as k from events) where k = 1")
def last_write_wins(spark, sf_dir):
    return records.last_write_wins(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id").select("user_id", "event_id", "event_type")


@query("select doc_id from documents where doc_id not in (select doc_id from labels)")
def resume_todo(spark, sf_dir):
    return records.resume(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("""with t as (select conv_id, turn, role, text, lead(role) over w as next_role, lead(text) over w as next_text from conversations window w as (partition by conv_id order by turn))
select conv_id, turn, 'user' as role_1, text as content_1, 'assistant' as role_2, next_text as content_2 from t where role = 'user' and next_role = 'assistant'""")
def sft_export(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, sf_dir, "conversations").withColumns({"next_role": F.lead("role").over(w), "next_text": F.lead("text").over(w)})
    rows = turns.where("role = 'user' and next_role = 'assistant'").select("conv_id", "turn", export.chat_row(F.col("text"), F.lit(""), F.col("next_text")).alias("m"))
    return rows.select("conv_id", "turn", *(F.col("m")[k][f].alias(f"{f}_{k + 1}") for k in (0, 1) for f in ("role", "content")))


@query("select 'lang:' || lang as bucket, count(*) as n from documents group by 1 union all select 'source:' || source, count(*) from documents group by 1")
def bucket_counts(spark, sf_dir):
    return export.bucket_counts(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("select o_custkey as group_id, count(distinct o_orderkey) as families from orders where o_orderstatus = 'F' group by 1 having count(distinct o_orderkey) >= 2")
def group_survival(spark, sf_dir):
    return export.survival(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("group_id"), F.col("o_orderkey").alias("family_id")))


both("split_overlap", "select o_custkey as group_id from {orders} where o_orderstatus = 'F' intersect select o_custkey from {orders} where o_orderstatus = 'O'")
both("dup_keys", "select l_orderkey, count(*) as n from {lineitem} group by l_orderkey having count(*) > 1")
both("split_by_domain", "select lang, case when doc_id % 4 = 0 then 'eval' else 'train' end as split, count(*) as n from {documents} group by 1, 2")
both("coverage_missing", "select n_nationkey, n_name from {nation} where n_nationkey not in (select s_nationkey from {supplier} where s_acctbal > 9000)")
both(
    "stance_mix",
    "select coalesce(a.k, b.k) as stance, coalesce(a.n, 0) as planned, coalesce(b.n, 0) as realised from (select c_nationkey as k, count(*) as n from {customer} group by 1) a "
    "full outer join (select s_nationkey as k, count(*) as n from {supplier} group by 1) b on a.k = b.k",
)
both("truncated_answers", "select conv_id, turn, trim(coalesce(text, '')) = '' or length(text) >= 400 as truncated from {conversations} where role = 'assistant'")
both("reviewed_pairs", "select l.doc_id, l.quality, d.lang from {labels} l join {documents} d on l.doc_id = d.doc_id where d.n_chars > 100")


@query("with c as (select lang, source, count(*) as n, min(doc_id) as seen from documents group by 1, 2), r as (select *, row_number() over (partition by lang order by n desc, seen) as place from c) select lang, source, n, place from r where place <= 4")
def situation_spread(spark, sf_dir):
    counts = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"), F.min("doc_id").alias("seen"))
    return export.top_per(counts, "lang", [F.desc("n"), F.asc("seen")], 4).select("lang", "source", "n", F.col("place").cast("long").alias("place"))


@query("select lang as licence, substr(source, 1, 4) as use, array_to_string(list_sort(list(distinct source)), ', ') as sources from documents group by 1, 2")
def licence_groups(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("licence"), F.substring("source", 1, 4).alias("use"), F.col("source").alias("source_id"))
    return export.licence_groups(rows)


@query("""with p(prefix) as (select distinct p_type[:k] from part, range(3, 9, 5) t(k)), m as (select p_partkey as id, p_type as name, prefix, row_number() over (partition by p_partkey order by length(prefix) desc nulls last) as k
 from part left join p on starts_with(lower(p_type), lower(prefix))) select id, name, prefix from m where k = 1""")
def prefix_source_match(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    prefixes = part.select(F.explode(F.array(F.substring("p_type", 1, 3), F.substring("p_type", 1, 8))).alias("prefix")).distinct()
    return export.prefix_match(part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("name")), prefixes)


@query("""with k as (select n_name as id from nation), c as (select n_name as cited from nation union all select lower(n_name) from nation union all select substr(n_name, 3) from nation union all select 'ZZ' || n_name from nation),
d as (select distinct cited from c), e as (select cited, count(*) as n, min(id) as ending from d join k on ends_with(lower(id), lower(cited)) group by 1)
select c.cited, coalesce((select min(id) from k where id = c.cited), (select min(id) from k where lower(id) = lower(c.cited)), case when e.n = 1 then e.ending end, c.cited) as id from c left join e using (cited)""")
def id_repair(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("id"))
    cited = n.select(F.col("id").alias("cited")).union(n.select(F.lower("id"))).union(n.select(F.substr("id", F.lit(3)))).union(n.select(F.concat(F.lit("ZZ"), "id")))
    return export.repair_ids(cited, n)


@query(r"select page_id as source, trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1)) as title, length(regexp_extract(html, '<article>(.*)</article>', 1, 's')) as size from pages")
def parse_passages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    title, body = F.regexp_extract("html", "<h1>([^<]*)</h1>", 1), F.regexp_extract("html", "(?s)<article>(.*)</article>", 1)
    marked = pages.select(F.col("page_id").alias("source"), F.concat(F.lit("## p1 - "), title, F.lit("\n"), F.regexp_replace(body, r"\n#", "\n #")).alias("text"), F.length(body).cast("long").alias("size"))
    passages = records.parse_passages(marked.select("source", "text")).where("place = 1 or place = 0")
    return passages.join(marked.select("source", "size"), "source").select("source", "title", "size")


@query()
def lenient_json(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    written = F.concat(F.lit("Here it is:\n```json\n{\"quality\": "), F.col("quality").cast("string"), F.lit(", \"list\": [1, 2,],}\n``` done"))
    return labels.select("doc_id", loose_json(written).alias("found"))


@query()
def gateway_stub(spark, sf_dir):
    prompts = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("record_id"), F.col("text").alias("prompt"))
    replies = gateway.ask_all(prompts.withColumn("system", F.lit("")), gateway.Role("writer", "stub-model"), "items")
    return replies.select("record_id", "reply", "finish_reason", F.get("usage", F.lit(0))["prompt_tokens"].alias("prompt_tokens"))


@query()
def gateway_embeddings(spark, sf_dir):
    texts = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return gateway.embed_all(texts, gateway.Role("embeddings", "stub-embedding")).select("id", F.size("vector").alias("n"), F.round(F.get("vector", F.lit(0)), 6).alias("first"))
