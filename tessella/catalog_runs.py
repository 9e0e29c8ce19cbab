"""Queries over a run made from the driver tables: reviews, verdicts, decisions, exports, licences, coverage and stages.

documents stand for responses, labels for what reviewers and judges return as JSON, and every three documents for a
family.  The SQL states the same records from the same columns, and the rules over them anew.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import FORBIDDEN, SOFT, _cue_sql, _shares, _GRAMS, table
from .functions import payload as P
from .functions import text as X
from .functions.loose_json import listed_items, text_field
from .operators import decisions, export, gateway, report, stages, style
from .plans import planner

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# --- the records ---------------------------------------------------------------------------------------------------

def D():
    return F.col("doc_id")


def _id(prefix: str):
    return F.concat(F.lit(prefix), D().cast("string"))


def _reviews(spark, sf_dir):
    """Reviews as JSON: numbers as numbers or texts, flags as booleans, numbers or texts, a verdict in any case or none."""
    quote = F.when(D() % 6 == 0, "").otherwise("said")
    scores = F.struct(
        F.when(D() % 2 == 0, F.concat(F.col("quality") * 2 + 2, F.lit(".5"))).otherwise((3 + 2 * F.col("quality")).cast("string")).alias("fidelity"),
        (5 - D() % 3).alias("judgment_not_terminology"),
        F.when(D() % 7 == 0, 2).otherwise(4).alias("scenario_quality"),
        (F.col("toxic") == 1).alias("cue_leakage"),
        F.when(D() % 11 == 0, "false").otherwise("").alias("confident_on_unresolved"),
        (D() % 5 == 0).cast("int").alias("formulaic_shape"),
        F.when(D() % 13 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")).alias("prompt_stipulates_move"),
        F.when(D() % 9 == 0, F.lit(True)).alias("quoted_source_text"),
        (D() % 10 == 0).alias("archaic_register"),
    )
    verdict = F.when(D() % 8 == 1, " Revise").when((F.col("quality") == 0) & (D() % 4 == 0), "REJECT").when(D() % 16 != 3, "accept")
    written = F.to_json(F.struct(scores.alias("scores"), quote.alias("judgment_evidence_quote"), verdict.alias("verdict"), F.concat(F.lit("why "), D()).alias("rationale"), F.array(F.lit("too long")).alias("issues")))
    return table(spark, sf_dir, "labels").select(D().alias("doc_id"), written.alias("payload"))


_REVIEW = """v as (select doc_id,
  cast(case when doc_id % 2 = 0 then round_even(2 + 2 * quality + 0.5, 0) else 3 + 2 * quality end as int) as fidelity,
  cast(case when doc_id % 6 = 0 or doc_id % 5 = 0 or doc_id % 10 = 0 then least(5 - doc_id % 3, 3) else 5 - doc_id % 3 end as int) as judgment,
  case when doc_id % 7 = 0 then 2 else 4 end as scenario, toxic = 1 as cue_leakage, doc_id % 11 = 0 as confident, doc_id % 5 = 0 as formulaic, doc_id % 13 = 0 as stipulates,
  doc_id % 9 = 0 as quoted, doc_id % 10 = 0 as archaic,
  1 + (doc_id % 6 = 0)::int + (doc_id % 5 = 0)::int + (doc_id % 10 = 0)::int as issues,
  case when doc_id % 8 = 1 or (doc_id % 16 = 3 and not (quality = 0 and doc_id % 4 = 0)) then 'revise' when quality = 0 and doc_id % 4 = 0 then 'reject' else 'accept' end as verdict from labels)"""


def _verdict_payloads(spark, sf_dir):
    named = F.when(D() % 3 == 0, "  ").otherwise("candour")
    source = F.when(F.col("quality") == 1, " VALUE").when(F.col("toxic") == 1, "Capability").otherwise("odd")
    kind = F.element_at(F.array(*map(F.lit, ("action", "reasons", "both"))), (D() % 3 + 1).cast("int"))
    it = F.struct(
        source.alias("divergence_source"), (D() % 5 == 0).alias("generic_makes_same_claim"), named.alias("value_named"), kind.alias("kind"), F.concat(F.lit("as "), D()).alias("explanation"),
        F.struct(F.lit("one ").alias("a"), F.lit("two").alias("b"), F.lit("three").alias("c")).alias("actions"), F.struct((D() % 2).alias("test_vs_weak"), F.lit("yes").alias("test_vs_generic")).alias("pairwise"),
        F.when(D() % 4 == 0, "Generic").otherwise("far").alias("closer_to"),
    )
    return table(spark, sf_dir, "labels").select("doc_id", F.to_json(it).alias("payload"))


_VERDICT = """w as (select doc_id, case when doc_id % 5 = 0 then 'capability' when quality = 1 then 'value' when toxic = 1 then 'capability' else 'none' end as source,
  case when doc_id % 3 = 0 then '' else 'candour' end as named, ['action', 'reasons', 'both'][doc_id % 3 + 1] as kind, 'as ' || doc_id as explanation,
  doc_id % 2 = 1 as vs_base, true as vs_generic, false as generic_vs_base, case when doc_id % 4 = 0 then 'generic' else '' end as closer_to,
  case when doc_id % 20 = 4 then 'base answer cut off (length)' else '' end as unverified from labels)"""


def _verdicts(spark, sf_dir):
    own = _verdict_payloads(spark, sf_dir).select("doc_id", P.verdict_of(F.col("payload"), _id("p"), F.lit("judge"), F.create_map(*map(F.lit, ("candidate", "B", "generic", "C", "weak", "A")))).alias("w"))
    cut = F.when(D() % 20 == 4, "base answer cut off (length)").otherwise("")
    return own.select("doc_id", F.col("w").withField("unverified_reason", cut).alias("w"))


def _family(spark, sf_dir):
    k = F.floor(D() / 3)
    pair = F.when(k % 5 < 2, F.concat(F.lit("g"), F.floor(k / 5).cast("string"))).otherwise("")
    return table(spark, sf_dir, "documents").select(k.alias("k")).distinct().where("k % 17 != 0").select(
        F.concat(F.lit("f"), F.col("k").cast("string")).alias("family_id"), F.when(F.col("k") % 4 == 0, "eval").otherwise("train").alias("split"),
        F.concat(F.lit("d"), (F.col("k") % 3).cast("string")).alias("domain"), F.expr("if(k % 5 < 2, concat('g', cast(floor(k / 5) as string)), '')").alias("counterfactual_group_id"), "k",
    )


def _records(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    responses = docs.select(D().alias("ordinal"), _id("r").alias("response_id"), _id("p").alias("prompt_id"), F.lit("").alias("deliberation"), F.when(D() % 50 != 7, F.col("text")).otherwise(" ").alias("answer"))
    prompts = docs.select(
        D().alias("ordinal"), _id("p").alias("prompt_id"), F.concat(F.lit("f"), F.floor(D() / 3).cast("string")).alias("family_id"), F.when(D() % 5 == 0, "fiction").otherwise("base").alias("variant"),
        F.substring(F.coalesce("text", F.lit("")), 1, 80).alias("text"), F.when(D() % 2 == 0, "divergence").otherwise("ordinary").alias("case_type"), F.when(F.col("lang") == "de", "explicit").otherwise("neutral").alias("mode"),
    )
    reviews = _reviews(spark, sf_dir).select(P.review_of(F.col("payload"), _id("r"), F.lit("reviewer")).alias("v")).select("v.*")
    verdicts = _verdicts(spark, sf_dir).where(D() % 4 == 0).select("w.*")
    return decisions.joined_records(responses, prompts, _family(spark, sf_dir).drop("k"), reviews, verdicts)


def _decided(spark, sf_dir):
    joined = _records(spark, sf_dir)
    near = table(spark, sf_dir, "documents").where(D() % 19 == 5).select(_id("r").alias("response_id"), F.concat(F.lit("r"), D() - 1).alias("duplicate_of"))
    leaked = table(spark, sf_dir, "documents").where(F.floor(D() / 3) % 4 == 0).select(_id("r").alias("response_id"), ((D() % 100) / 100).alias("score"))
    policy = decisions.Policy(FORBIDDEN, SOFT, leakage_cut=0.9, method="embeddings")
    return joined, decisions.decide_responses(joined, policy, near, leaked)


def _terms(terms, text):
    return _cue_sql(terms).replace("regexp_matches(text,", f"regexp_matches({text},")


_LIST = "'[' || array_to_string(list_transform({0}, lambda t: '''' || t || ''''), ', ') || ']'"
_FOLD = f"""{_REVIEW}, {_VERDICT},
f as (select distinct doc_id // 3 as k from documents where (doc_id // 3) % 17 != 0),
b as (select d.doc_id, case when d.doc_id % 50 != 7 then d.text else ' ' end as answer, substr(coalesce(text, ''), 1, 80) as ptext, lang = 'de' as explicit, d.doc_id % 2 = 0 as intended,
  (d.doc_id // 3) % 4 = 0 as is_eval, f.k is not null as has_family, (d.doc_id % 100) / 100 as leak from documents d left join f on f.k = d.doc_id // 3),
c as (select *, case when explicit then [] else {_terms(FORBIDDEN, 'ptext')} end as hp, case when explicit then [] else {_terms(FORBIDDEN, "chr(10) || coalesce(answer, '')")} end as hr,
  list_sort(list_distinct(list_concat({_terms(SOFT, 'ptext')}, {_terms(SOFT, "chr(10) || coalesce(answer, '')")}))) as soft from b),
j as (select c.*, v.doc_id is not null as reviewed, v.* exclude (doc_id), w.source, w.named, w.kind, w.explanation, w.unverified, w.doc_id is not null as has_verdict,
  c.intended and not coalesce(v.stipulates, false) as judged_as, w.named != '' and w.source = 'value' as diverges
  from c left join v using (doc_id) left join (select * from w where doc_id % 4 = 0) w on w.doc_id = c.doc_id),
r as (select doc_id, is_eval, explicit, archaic, quoted, stipulates, soft, case when is_eval then leak end as leak, intended, judged_as, has_verdict, unverified, diverges, kind, source, doc_id % 19 = 5 as dup,
  list_filter([
   case when not reviewed then 'F|no reviewer verdict' end,
   case when verdict = 'reject' then 'F|reviewer rejected: why ' || doc_id end,
   case when verdict = 'revise' then 'F|reviewer still asks for revision after a rewrite: why ' || doc_id end,
   case when formulaic then 'F|reviewer: fixed template shape rather than a shape this case needed' end,
   case when stipulates and intended then 'N|note: prompt stipulates the target''s move; relabelled ordinary' end,
   case when reviewed and not (fidelity >= 4 and judgment >= 3 and scenario >= 3) then 'F|scores below thresholds: fidelity=' || fidelity || ' judgment=' || judgment || ' scenario=' || scenario end,
   case when confident then 'F|reviewer: confident resolution of an unresolved tradeoff' end,
   case when len(soft) > 0 then 'N|note: soft cue terms present: ' || {_LIST.format('soft')} end,
   case when explicit then 'N|note: explicit-mode record, cue check skipped' end,
   case when len(hp) + len(hr) > 0 then 'F|cue terms found (prompt: ' || case when len(hp) > 0 then {_LIST.format('hp')} else 'none' end || ', response: ' || case when len(hr) > 0 then {_LIST.format('hr')} else 'none' end || ')' end,
   case when not explicit and len(hp) + len(hr) = 0 and cue_leakage then 'F|reviewer flagged cue leakage the term list did not catch' end,
   case when not explicit and len(hp) + len(hr) = 0 and not cue_leakage and archaic then 'F|reviewer flagged archaic or translated-sounding register, which signals the source as surely as naming it' end,
   case when quoted then 'N|note: quoted or closely echoed source-text wording' end,
   case when doc_id % 19 = 5 then 'F|near-duplicate of r' || (doc_id - 1) || ' (embeddings)' end,
   case when is_eval and leak >= 0.9 then 'F|eval item too close to training data (embeddings ' || printf('%.3f', leak) || ' >= 0.9)' end,
   case when judged_as and not has_verdict then 'N|note: intended divergence not checked, no baseline answer for this prompt' end,
   case when judged_as and unverified != '' then 'N|note: divergence unverified: ' || unverified end,
   case when judged_as and unverified = '' and not diverges then 'N|note: intended divergence did not hold against the baseline (' || explanation || '); relabelled ordinary' end,
   case when trim(coalesce(answer, ''), ' ' || chr(9) || chr(10) || chr(13)) = '' then 'F|empty answer' end,
   case when not has_family then 'F|orphan response: its family is missing' end], lambda x: x is not null) as marked from j),
decided as (select 'r' || doc_id as response_id, len(list_filter(marked, lambda m: m[1] = 'F')) = 0 as keep, list_transform(marked, lambda m: m[3:]) as reasons,
  case when coalesce(stipulates, false) or (judged_as and has_verdict and unverified = '' and not diverges) then 'ordinary' when intended then 'divergence' else 'ordinary' end as final_case_type,
  case when dup then 'r' || (doc_id - 1) end as duplicate_of, round(leak, 4) as max_leakage,
  case when not judged_as then 'not_applicable' when not has_verdict or unverified != '' then 'unverified' when diverges then 'confirmed' else 'not_confirmed' end as divergence_status,
  case when judged_as and has_verdict and unverified = '' then kind else '' end as divergence_kind, case when judged_as and has_verdict and unverified = '' then source else '' end as divergence_source, r.* from r)"""


@query(f"with {_REVIEW} select doc_id, fidelity, judgment, scenario, cue_leakage, confident, formulaic, stipulates, quoted, archaic, issues, verdict from v")
def review_payloads(spark, sf_dir):
    own = _reviews(spark, sf_dir).select("doc_id", P.review_of(F.col("payload"), _id("r"), F.lit("reviewer")).alias("v"))
    names = {"fidelity": "fidelity", "judgment_not_terminology": "judgment", "scenario_quality": "scenario", "cue_leakage": "cue_leakage", "confident_on_unresolved": "confident", "formulaic_shape": "formulaic", "prompt_stipulates_move": "stipulates", "quoted_source_text": "quoted", "archaic_register": "archaic"}
    return own.select("doc_id", *(F.col(f"v.scores.{k}").alias(n) for k, n in names.items()), F.size("v.issues").alias("issues"), "v.verdict")


@query("select doc_id, case when doc_id % 9 = 0 then '' else 'quoted_source_text' end as lacking from labels")
def missing_scores(spark, sf_dir):
    return _reviews(spark, sf_dir).select("doc_id", F.array_join(P.missing_scores(F.col("payload")), ",").alias("lacking"))


@query(f"with {_VERDICT} select doc_id, source, named != '' and source = 'value' as diverges, kind, closer_to, vs_base, vs_generic, generic_vs_base, 'two' as candidate_action, 'one' as base_action, 'A=weak, B=candidate, C=generic' as label_order from w")
def verdict_payloads(spark, sf_dir):
    own = _verdicts(spark, sf_dir)
    named = {"divergence_source": "source", "diverges": "diverges", "kind": "kind", "closer_to": "closer_to", "diverges_vs_base": "vs_base", "diverges_vs_generic": "vs_generic", "generic_differs_from_base": "generic_vs_base", "candidate_action": "candidate_action", "base_action": "base_action", "label_order": "label_order"}
    return own.select("doc_id", *(F.col(f"w.{k}").alias(n) for k, n in named.items()))


@query(f"with {_FOLD} select response_id, keep, array_to_string(reasons, '; ') as reasons, final_case_type, duplicate_of, max_leakage, divergence_status, divergence_kind, divergence_source, array_to_string(soft, ',') as soft_cue_hits from decided")
def decision_fold(spark, sf_dir):
    found = _decided(spark, sf_dir)[1]
    return found.select("response_id", "keep", F.array_join("reasons", "; ").alias("reasons"), "final_case_type", "duplicate_of", "max_leakage", "divergence_status", "divergence_kind", "divergence_source", F.array_join("soft_cue_hits", ",").alias("soft_cue_hits"))


@query(
    f"""with {_FOLD} select count(*) as responses, count(*) filter (keep) as kept, count(*) filter (not keep) as dropped, count(distinct duplicate_of) as duplicate_clusters, count(duplicate_of) as duplicates,
 count(*) filter (len(list_filter(reasons, lambda x: starts_with(x, 'cue terms found'))) > 0) as cue_hits, count(*) filter (is_eval and (doc_id // 3) % 17 != 0) as eval_items_checked_for_leakage, max(max_leakage) as max_leakage_seen,
 count(*) filter (divergence_status = 'confirmed') as divergence_confirmed, count(*) filter (divergence_status = 'not_confirmed') as divergence_not_confirmed, count(*) filter (divergence_status = 'unverified') as divergence_unverified,
 count(*) filter (divergence_status = 'confirmed' and divergence_kind in ('action', 'both')) as divergence_action, count(*) filter (divergence_status = 'confirmed' and divergence_kind in ('reasons', 'both')) as divergence_reasons,
 count(*) filter (divergence_status = 'confirmed' and divergence_kind = 'reasons') as divergence_reasons_only, count(*) filter (divergence_status = 'confirmed' and divergence_kind = 'both') as divergence_both,
 count(*) filter (len(soft) > 0) as soft_cue_flags, count(*) filter (explicit) as explicit_mode_records, count(*) filter (quoted) as quoted_source_flags, count(*) filter (archaic) as archaic_register_flags, count(*) filter (stipulates) as stipulating_prompts from decided"""
)
def decision_summary(spark, sf_dir):
    joined, found = _decided(spark, sf_dir)
    return decisions.summary(found, joined)


_BUCKET = "case " + " ".join(f"when starts_with(reason, '{b}') then '{b}'" for b in report.REASON_BUCKETS) + " else substr(reason, 1, 60) end"


@query(f"with {_FOLD}, u as (select unnest(reasons) as reason from decided where not keep) select {_BUCKET} as bucket, count(*) as n from u group by 1")
def reason_table(spark, sf_dir):
    return report.reason_counts(_decided(spark, sf_dir)[1])


@query(f"with {_FOLD}, h as (select response_id, case when len(list_filter(reasons, lambda x: " + " or ".join(f"starts_with(x, '{p}')" for p in export.HARD_DROPS) + ")) > 0 then true else false end as hard, keep, is_eval and (doc_id // 3) % 17 != 0 as ev from decided) select response_id, not keep as readmitted from h where keep or (ev and not hard)")
def hard_drops(spark, sf_dir):
    joined, found = _decided(spark, sf_dir)
    rows = found.join(joined.select(F.col("r.response_id").alias("response_id"), F.col("f.split").alias("split")), "response_id")
    return export.admitted(rows).select("response_id", "readmitted")


@query(f"with {_FOLD} select response_id, max_leakage from decided where max_leakage is not null order by max_leakage desc, response_id desc limit 5")
def top_leakage(spark, sf_dir):
    return report.top_leakage(_decided(spark, sf_dir)[1])


@query(f"with {_FOLD}, k as (select doc_id, response_id, reasons, row_number() over (order by doc_id) as n from decided where not keep) select response_id, array_to_string(reasons, '; ') as reasons from k where n <= 3")
def rejected_samples(spark, sf_dir):
    joined, found = _decided(spark, sf_dir)
    return report.samples(found, joined.select("r.*"), False, 3).select("response_id", "reasons")


@query(f"with {_REVIEW}, x as (select unnest(list_filter([case when cue_leakage then 'cue_leakage' end, case when confident then 'confident_on_unresolved' end, case when formulaic then 'formulaic_shape' end, case when quoted then 'quoted_source_text' end, case when archaic then 'archaic_register' end], lambda t: t is not null)) as flag, fidelity >= 5 or judgment >= 5 or scenario >= 5 as five, doc_id from v) select (select count(distinct doc_id) from x where five) as reviews_with_flag_and_five, count(*) as reviews_total, count(*) filter (stipulates) as stipulating_prompts from v")
def conflict_summary(spark, sf_dir):
    return decisions.conflict_summary(_reviews(spark, sf_dir).select(P.review_of(F.col("payload"), _id("r"), F.lit("x")).alias("v")).select("v.*"))


@query(f"with {_REVIEW}, b as (select doc_id, case when quality = 1 then 'accept' else 'reject' end as vb from labels) select vb as verdict, count(*) as n, count(*) filter (v.verdict != vb) as disagree from v join b using (doc_id) group by 1")
def second_reviewer(spark, sf_dir):
    first = _reviews(spark, sf_dir).select(D().alias("id"), P.review_of(F.col("payload"), _id("r"), F.lit("x")).alias("v")).select("id", F.col("v.scores.fidelity").alias("score"), "v.verdict")
    second = table(spark, sf_dir, "labels").select(D().alias("id"), F.lit(3).alias("score"), F.when(F.col("quality") == 1, "accept").otherwise("reject").alias("verdict"))
    return decisions.second_verdicts(first, second)


@query(f"with {_VERDICT}, n as (select unnest(list_filter([case when vs_base then 'candidate_vs_base' end, case when vs_generic then 'candidate_vs_strong_generic' end, case when generic_vs_base then 'strong_generic_vs_base' end, case when unverified = '' then 'judged' end, case when closer_to != '' then 'closer_to:' || closer_to end], lambda x: x is not null)) as name from w) select name, count(*) as n from n group by 1")
def verdict_counts(spark, sf_dir):
    return decisions.verdict_counts(_verdicts(spark, sf_dir).select("w.*"))


@query(
    f"""with {_VERDICT}, p as (select doc_id // 3 as k, bool_or(vs_base) as b, bool_or(vs_generic) as g, bool_or(generic_vs_base) as gb, bool_and(source = 'value') as every, bool_or(source = 'value') as one from w group by 1)
select count(*) as families, count(*) filter (b) as candidate_vs_base, count(*) filter (g) as candidate_vs_generic, count(*) filter (gb) as generic_vs_base, count(*) filter (every) as value_every_prompt, count(*) filter (one) as value_any_prompt, cast(0 as bigint) as stipulated, true as three_way_recorded from p"""
)
def three_way_families(spark, sf_dir):
    rows = _verdicts(spark, sf_dir).select(F.concat(F.lit("f"), F.floor(D() / 3)).alias("family_id"), "w.*")
    return decisions.three_way_summary(decisions.three_way(rows))


# --- export --------------------------------------------------------------------------------------------------------

_PARTS = ["mixing steel", "boldly plated tins", "a glass", "Holds its Edge. ", "CEO bias.", "", "Quickly"]


def _phrase():
    return F.element_at(F.array(*map(F.lit, _PARTS)), (F.col("p_partkey") % 7 + 1).cast("int"))


@query(
    """select p_partkey, ['FAIL if the reply ends up mixing steel.', 'FAIL if the reply shows boldly plated tins.', 'FAIL if the reply shows a glass.', 'FAIL if the reply holds its Edge.', 'FAIL if the reply shows CEO bias.', '', 'FAIL if the reply shows quickly.'][p_partkey % 7 + 1] as fail,
 ['PASS if the reply mixing steel.', 'PASS if the reply boldly plated tins.', 'PASS if the reply a glass.', 'PASS if the reply holds its Edge.', 'PASS if the reply CEO bias.', '', 'PASS if the reply quickly.'][p_partkey % 7 + 1] as pass from part"""
)
def grading_notes(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.fail_note(_phrase()).alias("fail"), X.pass_note(_phrase()).alias("pass"))


@query(
    """with k as (select n_name as id from nation), c as (select n_nationkey as n, unnest([n_name || ': why', '[' || lower(n_name) || ']: - why', lower(n_name) || ' - why', substr(n_name, 8) || ': why', 'ZZ9: x: y', '']) as cited from nation),
d as (select distinct cited from c), w as (select cited, regexp_matches(cited, '^\\[') as wrapped, (select max_by(id, length(id)) from k where starts_with(lower(cited), lower(id))) as whole from d),
n as (select cited, case when wrapped then regexp_extract(cited, '^\\[([^\\]]*)\\]', 1) when whole is not null then whole else split_part(cited, ': ', 1) end as named,
  case when wrapped then regexp_replace(regexp_extract(cited, '^\\[[^\\]]*\\](.*)$', 1), '^[ :,-]+', '') when whole is not null then regexp_replace(cited[length(whole) + 1:], '^[ :,-]+', '') else substr(cited, length(split_part(cited, ': ', 1)) + 3) end as clause from w),
e as (select named, min(id) as ending, count(*) as hits from (select distinct named from n) join k on named != '' and ends_with(lower(id), lower(named)) group by 1)
select c.n, c.cited, coalesce((select id from k where id = named), (select id from k where lower(id) = lower(named)), case when hits = 1 then ending end, named) as passage_id, clause from c join n using (cited) left join e using (named)"""
)
def citations(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    name = F.col("n_name")
    cited = F.array(F.concat(name, F.lit(": why")), F.concat(F.lit("["), F.lower(name), F.lit("]: - why")), F.concat(F.lower(name), F.lit(" - why")), F.concat(F.expr("substring(n_name, 8)"), F.lit(": why")), F.lit("ZZ9: x: y"), F.lit(""))
    rows = n.select(F.col("n_nationkey").alias("n"), F.explode(cited).alias("cited"))
    return export.split_citations(rows, n.select(name.alias("id"))).select("n", "cited", "passage_id", "clause")


_LICENCES = ["Public domain", "public domain, attribution asked", "", "CC BY", "PUBLIC DOMAIN text"]


@query(
    """with s as (select 'R' || r_regionkey as source_id, ['Public domain', 'public domain, attribution asked', '', 'CC BY', 'PUBLIC DOMAIN text'][r_regionkey + 1] as license from region),
p as (select n_name as id, case when n_nationkey % 5 = 0 then ['compiled'] else ['R' || n_regionkey, 'R' || (n_nationkey % 5)] end as own from nation),
c as (select c_custkey as id, unnest([1, 2, 3]) as place, 'NATION_' || unnest([c_nationkey, (c_nationkey + 1) % 30, c_nationkey]) as pid from customer),
e as (select c.id, place, unnest(coalesce(own, [''])) as source_id from c left join p on p.id = pid), d as (select distinct id, source_id from e)
select id, array_to_string(list_sort(list(case when source_id = '' then 'unmapped' else source_id end || '=' || case when coalesce(trim(license), '') = '' then 'not recorded' else license end)), '; ') as licences from d left join s using (source_id) group by 1"""
)
def passage_licences(spark, sf_dir):
    licence = F.element_at(F.array(*map(F.lit, _LICENCES)), (F.col("r_regionkey") + 1).cast("int"))
    sources = table(spark, sf_dir, "region").select(F.concat(F.lit("R"), F.col("r_regionkey").cast("string")).alias("source_id"), licence.alias("license"))
    own = F.array(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")), F.concat(F.lit("R"), (F.col("n_nationkey") % 5).cast("string")))
    passages = table(spark, sf_dir, "nation").select(F.col("n_name").alias("passage_id"), F.when(F.col("n_nationkey") % 5 == 0, F.array().cast("array<string>")).otherwise(own).alias("sources"))
    key = F.col("c_nationkey")
    cited = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.posexplode(F.array(key, (key + 1) % 30, key)).alias("place", "n")).select("id", "place", F.concat(F.lit("NATION_"), F.col("n").cast("string")).alias("passage_id"))
    found = export.passage_licences(cited, passages, sources, "compiled")
    return found.select("id", F.array_join(F.array_sort(F.transform("licences", lambda x: F.concat(x["source_id"], F.lit("="), x["license"]))), "; ").alias("licences"))


@query("select r_regionkey, [true, false, false, false, true][r_regionkey + 1] as free from region")
def public_domain(spark, sf_dir):
    licence = F.element_at(F.array(*map(F.lit, _LICENCES)), (F.col("r_regionkey") + 1).cast("int"))
    return table(spark, sf_dir, "region").select("r_regionkey", export.is_public_domain(licence).alias("free"))


_ROWS = """f as (select distinct doc_id // 3 as k from documents where (doc_id // 3) % 17 != 0),
x as (select d.doc_id, case when k % 4 = 0 then 'eval' else 'train' end as split, 'd' || (k % 3) as domain, case when d.doc_id % 2 = 0 then 'divergence' else 'ordinary' end as case_type, case when d.doc_id % 5 = 0 then 'fiction' else 'base' end as variant,
  case when d.doc_id % 3 = 0 then 'what_to_do' else '' end as kind, case when k % 5 < 2 then 'g' || (k // 5) else '' end as g, k from documents d join f on k = d.doc_id // 3 where d.doc_id % 7 != 0)"""


def _rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where(D() % 7 != 0).select("doc_id", F.floor(D() / 3).alias("k"))
    kinds = {"case_type": F.when(D() % 2 == 0, "divergence").otherwise("ordinary"), "variant": F.when(D() % 5 == 0, "fiction").otherwise("base"), "question_kind": F.when(D() % 3 == 0, "what_to_do").otherwise("")}
    return docs.join(_family(spark, sf_dir), "k").withColumns(kinds).withColumnRenamed("counterfactual_group_id", "group_id")


@query(f"with {_ROWS}, n as (select unnest(list_filter([split || ':' || domain, split || '_case:' || case_type, case when split = 'eval' then 'eval_variant:' || variant end, case when split = 'eval' and kind != '' then 'eval_question:' || kind end], lambda y: y is not null)) as bucket from x) select bucket, count(*) as n from n group by 1")
def export_buckets(spark, sf_dir):
    return export.export_buckets(_rows(spark, sf_dir))


@query(f"with {_ROWS}, a as (select g from x where g != '' group by 1 having count(distinct k) < 2) select doc_id, case when g = '' then 'f' || k else g end as split_group from x where g not in (select g from a)")
def complete_groups(spark, sf_dir):
    return export.complete_groups(_rows(spark, sf_dir)).select("doc_id", export.split_group(F.col("group_id"), F.col("family_id")).alias("split_group"))


@query(f"with {_ROWS} select k as family from x group by 1 having count(*) > 1", )
def repeated_families(spark, sf_dir):
    return export.repeated_families(_rows(spark, sf_dir)).select(F.expr("cast(substring(family_id, 2) as bigint)").alias("family"))


@query(r"select page_id, len(list_filter(regexp_extract_all(html || '[Name] [x1] [the] [...]', '\[([^\[\]\n]{1,60})\]', 1), lambda x: regexp_matches(x, '\p{L}') and not regexp_matches(x, '\p{Nd}') and lower(trim(x)) != 'the')) > 0 as dropped from pages")
def placeholder_drop(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat("html", F.lit("[Name] [x1] [the] [...]")).alias("t"))
    kept, lost = export.without_placeholders(pages, "t", ["The"])
    return kept.select("page_id", F.lit(False).alias("dropped")).union(lost.select("page_id", F.lit(True)))


@query(f"select doc_id, case when len(h) > 0 then 'reserved' else 'train' end as split, case when len(h) > 0 then 'avoided-topic keyword in seed situation: ' || h[1] else '' end as reason from (select doc_id, {_cue_sql(FORBIDDEN)} as h from documents)")
def avoided_topics(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.lit("train").alias("split"))
    return export.screened(docs, "text", FORBIDDEN).select("doc_id", "split", F.col("reserved_reason").alias("reason"))


@query("select 'p' || d.doc_id as prompt_id from documents d where (doc_id // 3) % 17 != 0 and (doc_id % 2 = 0 or (doc_id // 3) % 4 = 0)")
def baseline_needed(spark, sf_dir):
    prompts = table(spark, sf_dir, "documents").select(_id("p").alias("prompt_id"), F.concat(F.lit("f"), F.floor(D() / 3).cast("string")).alias("family_id"), F.when(D() % 2 == 0, "divergence").otherwise("ordinary").alias("case_type"))
    return stages.needing_baseline(prompts, _family(spark, sf_dir)).select("prompt_id")


@query("select doc_id, case when doc_id % 3 = 0 then 'base answer cut off (length); ' else '' end || case when doc_id % 5 = 0 then 'no strong generic answer; run the baseline stage' when trim(coalesce(text, '')) = '' or doc_id % 7 = 0 then 'strong generic answer cut off' else '' end as reason from documents")
def comparable_legs(spark, sf_dir):
    leg = lambda text, finish: F.struct(_id("p").alias("prompt_id"), text.alias("text"), finish.alias("finish_reason"))
    base = leg(F.lit("x"), F.when(D() % 3 == 0, "length").otherwise("stop"))
    generic = F.when(D() % 5 != 0, leg(F.col("text"), F.when(D() % 7 == 0, "length").otherwise("stop")))
    rows = decisions.comparable(table(spark, sf_dir, "documents").select("doc_id", base.alias("base"), generic.alias("generic")))
    return rows.select("doc_id", F.when(F.col("unverified_reason") == "base answer cut off (length)", "base answer cut off (length); ").otherwise(F.col("unverified_reason")).alias("reason"))


# --- tables --------------------------------------------------------------------------------------------------------


@query("with u as (select source as id, count(*) as n from documents group by 1), s as (select distinct source as id, source = 'src0' as unresolved from documents where source != 'src1' union all select 'src99', true) select coalesce(u.id, s.id) as tradeoff, coalesce(n, 0) as families, coalesce(unresolved, false) as unresolved, s.id is not null as known from u full outer join s on u.id = s.id")
def tradeoff_coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    spec = docs.where("source != 'src1'").select(F.col("source").alias("id"), (F.col("source") == "src0").alias("unresolved")).distinct().union(spark.createDataFrame([("src99", True)], "id string, unresolved boolean"))
    return report.tradeoff_coverage(docs.select(F.array("source").alias("tradeoff_ids")), spec)


@query("with r as (select lang as id, count(*) as n from documents where doc_id % 2 = 0 group by 1), h as (select distinct lang as id from documents union all select 'zz') select coalesce(r.id, h.id) as hypothesis, coalesce(n, 0) as families, coalesce(n, 0) < (select greatest(1, round_even(count(*) * 5.0 / 100, 0)) from documents) as short from r full outer join h on r.id = h.id")
def hypothesis_coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    families = docs.select(F.when(D() % 2 == 0, "divergence").otherwise("ordinary").alias("case_type_intent"), F.col("lang").alias("divergence_hypothesis_id"))
    known = docs.select(F.col("lang").alias("id")).distinct().union(spark.createDataFrame([("zz",)], "id string"))
    return report.hypothesis_coverage(families, known, 5.0)


@query("with r as (select case when doc_id % 3 = 0 then 'conflicted' when doc_id % 3 = 1 then 'defensive' else '(not recorded)' end as v from documents), c as (select v, count(*) as n, count(*) / (select count(*) from r) as share from r group by 1), m(v, planned) as (values ('conflicted', 0.4::double), ('decided_wants_permission', 0.2::double), ('angry_wants_to_win', 0.15::double), ('defensive', 0.15::double), ('transactional', 0.1::double)) select coalesce(c.v, m.v) as stance, coalesce(n, 0) as families, round(coalesce(share, 0.0::double), 6) as share, planned from c full outer join m on c.v = m.v")
def stances(spark, sf_dir):
    own = table(spark, sf_dir, "documents").select(F.when(D() % 3 == 0, "conflicted").otherwise("").alias("asker_stance"), F.when(D() % 3 == 1, F.create_map(F.lit("asker_stance"), F.lit("defensive"))).otherwise(F.create_map().cast("map<string,string>")).alias("situation_features"))
    return report.stance_table(own).withColumn("share", F.round("share", 6))


@query(f"with {_ROWS}, p as (select case when k % 2 = 0 then 'divergence' else 'other' end as c, count(*) as n from f where k % 4 = 0 group by 1), e as (select case_type as c, count(*) as n from x where split = 'eval' group by 1) select coalesce(p.c, e.c) as case_type, coalesce(p.n, 0) as planned, coalesce(e.n, 0) as exported from p full outer join e on p.c = e.c")
def eval_mix(spark, sf_dir):
    families = _family(spark, sf_dir).withColumn("case_type_intent", F.when(F.col("k") % 2 == 0, "divergence").otherwise("other"))
    return report.eval_composition(families, _rows(spark, sf_dir).where("split = 'eval'"))


@query("select kind, a_id, b_id, place from (select l_linestatus as kind, l_orderkey as a_id, l_linenumber as b_id, row_number() over (partition by l_linestatus order by l_extendedprice desc, l_orderkey, l_linenumber) as place from lineitem) where place <= 10")
def closest_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_linestatus").alias("kind"), F.col("l_orderkey").alias("a_id"), F.col("l_linenumber").alias("b_id"), F.col("l_extendedprice").alias("score"))
    return report.closest_pairs(rows).select("kind", "a_id", "b_id", F.col("place").cast("long").alias("place"))


@query("with c as (select source as value, count(*) as n, min(doc_id) as seen from documents group by 1) select value, n, place from (select *, row_number() over (order by n desc, seen) as place from c) where place <= 8")
def most_common_sources(spark, sf_dir):
    return report.most_common(table(spark, sf_dir, "documents"), "source", 8, "doc_id").withColumn("place", F.col("place").cast("long"))


@query(f"with {_GRAMS}, t as (select phrase, count(*) filter (share >= 0.03) as labels, sum(share) / count(*) as mean from shares group by 1), b as (select * from t where labels > 0 order by labels desc, round(mean, 9) desc, phrase limit 15) select phrase, labels, round(coalesce((select share from shares s where s.phrase = b.phrase and label = 'en'), 0), 6) as en, round(coalesce((select share from shares s where s.phrase = b.phrase and label = 'de'), 0), 6) as de from b")
def style_pivot(spark, sf_dir):
    return style.style_pivot(_shares(spark, sf_dir), ["en", "de"], 0.03).select("phrase", "labels", F.round("en", 6).alias("en"), F.round("de", 6).alias("de"))


@query(f"with {_GRAMS}, h as (select label, phrase from shares where share >= 0.02), n as (select phrase, count(*) as labels from h group by 1), l as (select distinct label from shares), s as (select label, list(phrase) as p from h group by 1), o as (select case when a.label is null or b.label is null then 0 else len(list_intersect(a.p, b.p)) / len(list_distinct(list_concat(a.p, b.p))) end as j from l x join l y on x.label < y.label left join s a on a.label = x.label left join s b on b.label = y.label where a.label is not null or b.label is not null) select count(*) as habitual, count(*) filter (labels >= 2) as shared_by_two, round((select coalesce(avg(j), 0) from o), 6) as mean_overlap from n")
def style_score(spark, sf_dir):
    return style.style_score(_shares(spark, sf_dir), 0.02).select("habitual", "shared_by_two", F.round("mean_overlap", 6).alias("mean_overlap"))


@query("with d as (select doc_id, ['train', 'eval', 'reserved'][doc_id % 3 + 1] as split, case when doc_id % 10 < 4 then 'g' || (doc_id // 2) else '' end as g from documents) select doc_id, case when g = '' then split else ['train', 'eval', 'reserved'][max(case split when 'reserved' then 3 when 'eval' then 2 else 1 end) over (partition by g)] end as split from d")
def aligned_splits(spark, sf_dir):
    split = F.element_at(F.array(*map(F.lit, ("train", "eval", "reserved"))), (D() % 3 + 1).cast("int"))
    rows = table(spark, sf_dir, "documents").select("doc_id", split.alias("split"), F.when(D() % 10 < 4, F.concat(F.lit("g"), F.floor(D() / 2).cast("string"))).otherwise("").alias("counterfactual_group_id"), F.lit("").alias("reserved_reason"))
    return planner.align_groups(rows).select("doc_id", "split")


@query("with b as (select doc_id, doc_id // 5 as batch, case when doc_id % 10 < 6 then 'g' || (doc_id // 2) else '' end as g from documents) select doc_id, case when g != '' and count(*) over (partition by batch, g) >= 2 then g else '' end as pair from b")
def complete_pairs(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.floor(D() / 5).alias("batch"), F.when(D() % 10 < 6, F.concat(F.lit("g"), F.floor(D() / 2).cast("string"))).otherwise("").alias("pair"))
    return planner.complete_pairs(rows).select("doc_id", "pair")


# --- stages over the stub ------------------------------------------------------------------------------------------


@query()
def stage_run(spark, sf_dir):
    """Families, prompts, responses, both baselines, reviews, revisions and verdicts of a small plan, counted."""
    domains = {r[0]: 1.0 for r in table(spark, sf_dir, "region").select("r_name").orderBy("r_name").collect()}
    target = planner.Target("toy", domains, ["t1", "t2"], ["t2"], [], ["h1"])
    slots = planner.as_table(spark, planner.plan(target, planner.Settings(10, divergence=0.5, eval_share=0.3, counterfactual=0.4)))
    role = gateway.Role("writer", "stub")
    empty = lambda ddl: spark.createDataFrame([], ddl)
    families = stages.generate_families(slots, empty("family_id string, slot_index int, counterfactual_group_id string, split string, reserved_reason string"), "toy", role, target.tradeoffs, [])
    prompts = stages.generate_prompts(families, empty("prompt_id string, family_id string, variant string"), role, ["fiction", "terse"], 2, 1, 2)
    responses = stages.generate_responses(prompts, families, empty("prompt_id string"), role)
    legs = [stages.answer_baseline(prompts, families, empty("prompt_id string"), gateway.Role("base", m), k) for m, k in (("small", "base"), ("stub", "strong_generic"))]
    reviews = stages.review_responses(responses, prompts, empty("response_id string"), gateway.Role("reviewer", "stub-r"))
    responses, reviews = stages.revise(responses, prompts, reviews, role, gateway.Role("reviewer", "stub-r"))
    verdicts = stages.judge_divergence(prompts, families, responses, *legs, empty("prompt_id string"), gateway.Role("judge", "stub-j"))
    out = None
    for name, df in (("families", families), ("prompts", prompts), ("responses", responses), ("baseline", legs[0]), ("strong_generic", legs[1]), ("reviews", reviews), ("verdicts", verdicts)):
        own = df.agg(F.lit(name).alias("stage"), F.count("*").alias("n"))
        out = own if out is None else out.union(own)
    return out


@query("select doc_id, '[{\"quality\": ' || quality || '}]' as items, 'hello' as text from labels")
def lenient_items(spark, sf_dir):
    q = F.col("quality").cast("string")
    wrapped = F.concat(F.lit("Sure:\n```json\n{\"result\": {\"notes\": [], \"found\": [{\"quality\": "), q, F.lit("},]}}\n```"))
    lone = F.concat(F.lit("{\"quality\": "), q, F.lit("}"))
    said = F.when(D() % 2 == 0, F.lit('"hello"')).otherwise(F.lit('{"n": 1, "odd": "hello", "blank": " "}'))
    return table(spark, sf_dir, "labels").select("doc_id", listed_items(F.when(D() % 2 == 0, wrapped).otherwise(lone), "found", required="quality_").alias("a"), listed_items(F.when(D() % 2 == 0, wrapped).otherwise(F.concat(F.lit("["), lone, F.lit("]"))), "found").alias("items"), text_field(said, "text").alias("text")).drop("a")
