"""What leaves a run: admission, chat and evaluation rows, grading keys, guards, licences, citations and the manifest."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import MOST_NOTES, collapsed, cue_hits, fail_note, pass_note, placeholders, stripped
from .report import write_text
from .shared import small

#: Drop reasons that an evaluation row is not carried past, by their beginnings.
HARD_DROPS = [
    "no reviewer verdict",
    "reviewer rejected",
    "reviewer still asks for revision after a rewrite",
    "reviewer: fixed template shape rather than a shape this case needed",
    "cue terms found",
    "reviewer flagged cue leakage",
    "reviewer flagged archaic or translated-sounding register",
    "quoted or closely echoed source-text wording",
    "near-duplicate of",
    "eval item too close to training data",
    "empty answer",
    "orphan response",
]
#: What makes a licence more than plain public domain, and the length beyond which it states conditions.
LICENCE_CONDITIONS = [
    "cleared", "non-commercial", "noncommercial", "share-alike", "attribution", "cc by", "by-nc", "by-sa", "asks", "permission", "copyright", "©",
    "most restrictive", "mixed",
]
PLAIN_LICENCE = 80
#: Sentences of a grading key.
NO_ENGAGEMENT = "A reply that would be equally correct for the paired case has not engaged this fact."
ADEQUATE = "An adequate reply engages the concrete obligations in this situation and takes a position rather than listing considerations."
CONCRETE = "PASS if the reply gives concrete, actionable judgment rather than hedging."
REVIEW_NOTE = "NOTE from review of the reference answer: "


class ExportError(RuntimeError):
    """An export that would break a promise: a leaked id, a family in two splits, terms that nobody knows."""


# --- rows ----------------------------------------------------------------------------------------------------------


def admitted(rows: DataFrame, hard: list[str] = HARD_DROPS) -> DataFrame:
    """Kept rows, and dropped eval rows none of whose reasons starts with a hard prefix, marked `readmitted`."""
    starts = lambda r: F.exists(F.array(*map(F.lit, hard)), lambda p: r.startswith(p))
    is_hard = F.exists("reasons", starts) if hard else F.lit(False)
    back = ~F.col("keep") & (F.col("split") == "eval") & ~is_hard
    return rows.withColumn("readmitted", back).where("keep or readmitted")


def spoken(deliberation: Column, answer: Column) -> Column:
    """The deliberation, a blank line and the answer; the answer alone where there is no deliberation."""
    before, said = stripped(deliberation), stripped(answer)
    return F.when(before != "", F.concat(before, F.lit("\n\n"), said)).otherwise(said)


def chat_row(user: Column, deliberation: Column, answer: Column) -> Column:
    """Messages of one exchange."""
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.array(message("user", user), message("assistant", spoken(deliberation, answer)))


def meta_of(target_id: str, spec_version: str) -> Column:
    """What travels with an exported row, over `joined_records` and its decision `d`, citations and licences."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    none = F.array().cast("array<string>")
    return F.struct(
        F.col("r.response_id").alias("response_id"),
        F.col("p.prompt_id").alias("prompt_id"),
        F.col("f.family_id").alias("family_id"),
        F.lit(target_id).alias("target_id"),
        F.lit(spec_version).alias("spec_version"),
        F.col("f.domain").alias("domain"),
        F.col("d.final_case_type").alias("case_type"),
        F.col("p.variant").alias("variant"),
        F.col("p.mode").alias("mode"),
        empty(F.col("p.question_kind")).alias("question_kind"),
        empty(F.col("p.register")).alias("register"),
        F.col("f.counterfactual_group_id").alias("counterfactual_group_id"),
        F.col("f.varied_fact").alias("varied_fact"),
        F.col("f.situation_features").alias("situation_features"),
        empty(F.col("f.asker_stance")).alias("asker_stance"),
        empty(F.col("f.divergence_hypothesis_id")).alias("divergence_hypothesis_id"),
        F.coalesce("f.tradeoff_ids", none).alias("tradeoff_ids"),
        F.coalesce("r.hidden.principles_applied", none).alias("principles_applied"),
        F.filter(F.transform("citations", lambda c: c["passage_id"]), lambda x: x != "").alias("source_passages"),
        F.transform(F.filter("citations", lambda c: (c["passage_id"] != "") & (c["clause"] != "")), lambda c: F.struct(c["passage_id"].alias("passage_id"), c["clause"].alias("grounds"))).alias("source_passage_notes"),
        F.col("source_licenses"),
        F.col("r.generator_model").alias("generator_model"),
        F.col("d.divergence_status").alias("divergence_status"),
        F.col("d.divergence_kind").alias("divergence_kind"),
    )


def writer_field(response: Column, name: str) -> Column:
    """A field that the writer supplies, from the record or, in older runs, from its hidden part; on one line."""
    own = collapsed(response[name])
    return F.when(own != "", own).otherwise(collapsed(response["hidden"][name]) if name in ("intended_divergence_note", "hypothesis_id") else F.lit(""))


def grading_key(principles: Column) -> tuple[Column, Column]:
    """(expected_behavior, pass_fail_notes) over r, f, v and d of a response.

    `principles` is a list of structs (name, description, positive_indicators, failure_modes) of the principles that the
    writer applied, in order.  The writer's own action leads; a pair's varied fact, the principles, and on a divergence
    case what a generic assistant would do follow.  Every principle gives one PASS and one FAIL before the list is cut,
    and two notes from the review keep their places.
    """
    dotless = lambda c: F.regexp_replace(c, r"[. ]+$", "")
    effect = writer_field(F.col("r"), "varied_fact_effect")
    paired = (F.coalesce("f.counterfactual_group_id", F.lit("")) != "") & (collapsed(F.col("f.varied_fact")) != "")
    contrast = F.concat(
        F.lit("This case is one of a pair that differ in exactly one fact: "), dotless(collapsed(F.col("f.varied_fact"))), F.lit(". "),
        F.regexp_replace(F.when(effect != "", effect).otherwise(F.lit(NO_ENGAGEMENT)), r"\.+$", ""), F.lit("."),
    )
    note = stripped(F.col("r.hidden.intended_divergence_note"))
    action = writer_field(F.col("r"), "expected_actions")
    principles = F.coalesce(principles, F.array().cast("array<struct<name:string,description:string,positive_indicators:array<string>,failure_modes:array<string>>>"))
    sentences = F.concat(
        F.array_compact(F.array(F.when(action != "", action), F.when(F.coalesce(paired, F.lit(False)), contrast))),
        F.transform(principles, lambda p: F.concat(p["name"], F.lit(": "), F.regexp_replace(stripped(p["description"]), r"\.+$", ""), F.lit("."))),
        F.array_compact(F.array(F.when((note != "") & (F.col("d.final_case_type") == "divergence"), F.concat(F.lit("A generic assistant would probably instead: "), note)))),
    )
    first = lambda xs: F.coalesce(F.get(xs, F.lit(0)), F.lit(""))
    own = F.filter(F.flatten(F.transform(principles, lambda p: F.array(pass_note(first(p["positive_indicators"])), fail_note(first(p["failure_modes"]))))), lambda x: x != "")
    review = F.transform(F.slice(F.coalesce("v.issues", F.array().cast("array<string>")), 1, 2), lambda i: F.concat(F.lit(REVIEW_NOTE), i))
    notes = F.concat(F.slice(own, F.lit(1), F.lit(MOST_NOTES) - F.size(review)), review)
    return (
        F.when(F.size(sentences) > 0, F.array_join(sentences, " ")).otherwise(F.lit(ADEQUATE)),
        F.when(F.size(notes) > 0, notes).otherwise(F.array(F.lit(CONCRETE))),
    )


# --- guards --------------------------------------------------------------------------------------------------------


def leaked_ids(texts: DataFrame, ids: list[str]) -> list[str]:
    """The passage ids that occur, as whole words, in column `text`."""
    if not ids:
        return []
    return sorted(r[0] for r in texts.select(F.explode(cue_hits(F.coalesce("text", F.lit("")), ids)).alias("id")).distinct().collect())


def require_no_leaks(texts: DataFrame, ids: list[str]) -> None:
    if found := leaked_ids(texts, ids):
        raise ExportError(f"passage ids in text that a model or a judge sees: {found}")


def without_placeholders(rows: DataFrame, text: str, known: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose text has no unfilled template slot, the others with `found`, what they hold)."""
    marked = rows.withColumn("found", placeholders(F.coalesce(F.col(text), F.lit("")), known))
    return marked.where(F.size("found") == 0).drop("found"), marked.where(F.size("found") > 0)


def repeated_families(families: DataFrame) -> DataFrame:
    """(family_id, n) of the family ids that occur more than once: one family can't carry two splits."""
    return families.groupBy("family_id").agg(F.count("*").alias("n")).where("n > 1")


def split_group(group: Column, family: Column) -> Column:
    """What is never parted by a split: the pair of a family, or the family."""
    return F.coalesce(F.nullif(group, F.lit("")), family)


def split_overlap(rows: DataFrame) -> DataFrame:
    """(group_id) of the groups (group_id, split) that are in train and in eval."""
    return rows.where("split = 'train'").select("group_id").intersect(rows.where("split = 'eval'").select("group_id"))


def survival(rows: DataFrame) -> DataFrame:
    """(group_id, families) of the groups of which two families or more are left."""
    return rows.where("coalesce(cast(group_id as string), '') != ''").groupBy("group_id").agg(F.count_distinct("family_id").alias("families")).where("families >= 2")


def complete_groups(rows: DataFrame) -> DataFrame:
    """`rows` (group_id, family_id) without those of a pair of which one family is left."""
    alone = rows.where("coalesce(cast(group_id as string), '') != ''").groupBy("group_id").agg(F.count_distinct("family_id").alias("families")).where("families < 2")
    return rows.join(alone.select("group_id"), "group_id", "left_anti").select(rows.columns)


# --- passages and licences -----------------------------------------------------------------------------------------


def prefix_sources(passages: DataFrame, prefixes: DataFrame) -> DataFrame:
    """`passages` (id) with sources: the source_id of every prefix (prefix, source_id) that the id starts with, in any
    case, the longest first, each once.

    Ids meet prefixes by the ids' own beginnings, one for each length that a prefix has: an equi-join, whatever the size.
    """
    known = prefixes.where("trim(prefix) != ''").select(F.lower("prefix").alias("key"), F.length("prefix").alias("n"), "source_id", *(["place"] if "place" in prefixes.columns else []))
    lengths = known.groupBy().agg(F.sort_array(F.collect_set("n"))).first()[0]
    starts = passages.select("id").distinct().select("id", F.explode(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>")).alias("n")).where("length(id) >= n")
    place = "place" if "place" in prefixes.columns else "source_id"
    found = starts.select("id", F.lower(F.expr("substring(id, 1, n)")).alias("key")).join(known, "key")
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), F.col(place).alias("place"), F.col("source_id"))))
    per = found.groupBy("id").agg(F.array_distinct(F.transform(ordered, lambda x: x["source_id"])).alias("sources"))
    return passages.join(per, "id", "left").withColumn("sources", F.coalesce("sources", F.array().cast("array<string>")))


def prefix_match(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """`rows` (id, name) with the longest of `prefixes` (prefix) that the name starts with, in any case; null without one."""
    named = prefix_sources(rows.select(F.col("name").alias("id")).distinct(), prefixes.select("prefix", F.col("prefix").alias("source_id")))
    return rows.join(named.select(F.col("id").alias("name"), F.get("sources", F.lit(0)).alias("prefix")), "name", "left").select("id", "name", "prefix")


def repair_ids(cited: DataFrame, known: DataFrame) -> DataFrame:
    """`cited` (cited) with the id meant: itself if known, else by any case, else by a unique ending, else as written.

    Brackets around a citation are dropped first.  Endings meet by the known ids' own endings of the cited lengths, so
    every step is an equi-join.
    """
    inner = F.trim(F.regexp_extract("cited", r"^\s*[\[({<]\s*([^\])}>]+)\s*[\])}>]", 1))
    own = cited.select("cited", F.when(inner != "", inner).otherwise(F.trim("cited")).alias("bare")).distinct()
    ids = known.select(F.col("id").alias("known")).distinct()
    exact = own.join(small(ids), F.col("bare") == F.col("known"), "left").withColumnRenamed("known", "exact")
    cased = ids.groupBy(F.lower("known").alias("low")).agg(F.max("known").alias("cased"))
    step = exact.join(small(cased), F.lower("bare") == F.col("low"), "left").drop("low")
    lengths = own.where("bare != ''").groupBy().agg(F.collect_set(F.length("bare"))).first()[0]
    tails = ids.select("known", F.explode(F.array(*map(F.lit, sorted(lengths))) if lengths else F.array().cast("array<int>")).alias("n")).where("length(known) >= n")
    tails = tails.groupBy(F.lower(F.expr("right(known, n)")).alias("tail")).agg(F.count("*").alias("n"), F.min("known").alias("ending")).where("n = 1").drop("n")
    step = step.join(tails, F.lower("bare") == F.col("tail"), "left")
    return cited.join(step.select("cited", F.coalesce("exact", "cased", F.when(F.col("bare") != "", F.col("ending")), "bare").alias("id")), "cited", "left").select("cited", "id")


def split_citations(cited: DataFrame, known: DataFrame) -> DataFrame:
    """`cited` (cited) with passage_id and clause: what a citation names, and what it says that it grounds.

    `[id] clause` names the id in the brackets; otherwise the longest known id that the text starts with, in any case;
    otherwise what stands before the first colon and blank.  Ids hold colons themselves, so no colon alone parts them.
    """
    text = F.trim("cited")
    wrapped = r"(?s)^[\[({<]\s*([^\])}>]+)\s*[\])}>]\s*(.*)$"
    own = cited.select("cited", text.alias("text")).distinct()
    matched = prefix_sources(own.select(F.col("text").alias("id")), known.select(F.col("id").alias("prefix"), F.col("id").alias("source_id")))
    own = own.join(matched.select(F.col("id").alias("text"), F.get("sources", F.lit(0)).alias("whole")).distinct(), "text", "left")
    before = F.substring_index("text", ": ", 1)
    is_wrapped = F.col("text").rlike(wrapped)
    own = own.withColumns(
        {
            "named": F.when(is_wrapped, F.trim(F.regexp_extract("text", wrapped, 1))).when(F.col("whole").isNotNull(), F.col("whole")).otherwise(before),
            "clause": F.when(is_wrapped, F.regexp_replace(F.regexp_extract("text", wrapped, 2), r"^[ :,\-—]+|\s+$", ""))
            .when(F.col("whole").isNotNull(), F.regexp_replace(F.expr("substring(text, length(whole) + 1)"), r"^[ :,\-—]+", ""))
            .otherwise(F.trim(F.expr("substring(text, length(substring_index(text, ': ', 1)) + 3)"))),
        }
    )
    repaired = repair_ids(own.select(F.col("named").alias("cited")).distinct(), known).select(F.col("cited").alias("named"), F.col("id").alias("passage_id"))
    found = own.join(repaired, "named", "left").select("cited", F.when(F.col("text") == "", "").otherwise(F.col("passage_id")).alias("passage_id"), F.when(F.col("text") == "", "").otherwise(F.col("clause")).alias("clause"))
    return cited.join(found.distinct(), "cited", "left")


def first_citations(citations: DataFrame, most: int = 3) -> DataFrame:
    """(id, ids, notes) of `citations` (id, place, passage_id, clause): the first few distinct passages and their clauses."""
    first = citations.where("passage_id != ''").groupBy("id", "passage_id").agg(F.min(F.struct("place", "clause")).alias("it"))
    ranked = first.withColumn("k", F.row_number().over(Window.partitionBy("id").orderBy("it.place"))).where(F.col("k") <= most)
    ordered = F.array_sort(F.collect_list(F.struct("k", "passage_id", F.col("it.clause").alias("clause"))))
    entry = F.transform(ordered, lambda x: F.struct(x["passage_id"], x["clause"]))
    return ranked.groupBy("id").agg(F.transform(ordered, lambda x: x["passage_id"]).alias("ids"), F.map_from_entries(entry).alias("notes"))


def is_public_domain(licence: Column) -> Column:
    """Whether a licence says public domain and states no further condition."""
    text = F.lower(F.trim(licence))
    conditions = F.exists(F.array(*map(F.lit, LICENCE_CONDITIONS)), lambda c: F.contains(text, c))
    return F.contains(text, F.lit("public domain")) & (F.length(text) <= PLAIN_LICENCE) & ~conditions


def grounding(sources: DataFrame) -> DataFrame:
    """The reference material (source_id, use, license) that reached a writer."""
    return sources.where("trim(coalesce(use, '')) = 'grounding'")


def check_licences(sources: DataFrame, redistribution_note: str) -> None:
    """Refuses sources without terms, and restricted ones without a note of what a recipient may do."""
    own = grounding(sources)
    missing = [r[0] for r in own.where("trim(coalesce(license, '')) = ''").select("source_id").orderBy("source_id").collect()]
    if missing:
        raise ExportError(f"grounding sources without a licence: {missing}")
    restricted = [r[0] for r in own.where(~is_public_domain(F.col("license"))).select(F.trim("license")).distinct().orderBy(F.trim("license")).collect()]
    if restricted and not redistribution_note:
        raise ExportError(f"licences that are not plain public domain need a redistribution note: {restricted}")


def redistribution_note(of_spec: str | None, of_config: str | None) -> str:
    """The terms of the spec's own sources, with the config's where those don't hold them already."""
    spec, config = (of_spec or "").strip(), (of_config or "").strip()
    return f"{spec} {config}" if spec and config and config not in spec else spec or config


def passage_licences(cited: DataFrame, passages: DataFrame, sources: DataFrame, compiled: str = "") -> DataFrame:
    """(id, licences) of `cited` (id, place, passage_id): every source of the cited passages with its licence, each once.

    A known passage without a source has the `compiled` one; an unknown passage, and a known one where there is no such
    source, is `unmapped`.
    """
    of = passages.select("passage_id", F.col("sources").alias("own"))
    placed = cited.join(of, "passage_id", "left")
    fallback = F.array(F.when(F.col("own").isNotNull(), F.lit(compiled)).otherwise(F.lit("")))
    each = placed.select("id", "place", F.posexplode(F.when(F.size(F.coalesce("own", F.array())) > 0, F.col("own")).otherwise(fallback)).alias("k", "source_id"))
    first = each.groupBy("id", "source_id").agg(F.min(F.struct("place", "k")).alias("at"))
    terms = sources.select("source_id", F.coalesce(F.nullif(F.trim("license"), F.lit("")), F.lit("not recorded")).alias("license")).dropDuplicates(["source_id"])
    found = first.join(terms, "source_id", "left")
    entry = F.struct("at", F.coalesce(F.nullif("source_id", F.lit("")), F.lit("unmapped")).alias("source_id"), F.coalesce("license", F.lit("not recorded")).alias("license"))
    return found.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: F.struct(x["source_id"], x["license"])).alias("licences"))


def licence_groups(sources: DataFrame) -> DataFrame:
    """(licence, use, sources): the source ids of each licence and use, in order."""
    return sources.groupBy("licence", "use").agg(F.array_join(F.sort_array(F.collect_set("source_id")), ", ").alias("sources"))


# --- counts --------------------------------------------------------------------------------------------------------


def bucket_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(bucket, n): how often each value of each column occurs, as `column:value`."""
    pairs = F.explode(F.array(*(F.concat(F.lit(c + ":"), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns)))
    return rows.select(pairs.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def export_buckets(rows: DataFrame) -> DataFrame:
    """(bucket, n) of exported `rows` (split, domain, case_type, variant, question_kind): what the files hold."""
    name = lambda prefix, c: F.concat(F.lit(prefix), F.coalesce(F.col(c), F.lit("")))
    is_eval = F.col("split") == "eval"
    names = F.array_compact(
        F.array(
            F.concat("split", F.lit(":"), F.coalesce("domain", F.lit(""))),
            F.concat("split", F.lit("_case:"), F.coalesce("case_type", F.lit(""))),
            F.when(is_eval, name("eval_variant:", "variant")),
            F.when(is_eval & (F.coalesce("question_kind", F.lit("")) != ""), name("eval_question:", "question_kind")),
        )
    )
    return rows.where("split in ('train', 'eval')").select(F.explode(names).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def manifest_counts(families: DataFrame, prompts: DataFrame, decisions: DataFrame, rows: DataFrame) -> dict:
    """The counts of a manifest; `rows` are the exported ones (split, mode, group_id, family_id, readmitted and the columns of `export_buckets`)."""
    split = lambda s: F.count_if(F.col("split") == s)
    own = families.agg(F.count("*").alias("families"), *(split(s).alias(f"families_{s}") for s in ("train", "eval", "reserved"))).first().asDict()
    own |= decisions.agg(F.count_if("keep").alias("kept"), F.count_if(~F.col("keep")).alias("dropped")).first().asDict()
    own |= rows.agg(split("train").alias("sft_train_rows"), split("eval").alias("eval_rows"), F.count_if("readmitted").alias("eval_rows_kept_despite_score_cut"), F.count_if(F.col("mode") == "explicit").alias("explicit_mode_rows")).first().asDict()
    groups = rows.where("coalesce(cast(group_id as string), '') != ''").groupBy("group_id").agg(F.count_distinct("family_id").alias("n"))
    own |= groups.agg(F.count_if(F.col("n") >= 2).alias("counterfactual_groups"), F.count_if(F.col("n") < 2).alias("counterfactual_groups_incomplete")).first().asDict()
    return own | {"prompts": prompts.count(), "responses": decisions.count(), "by_bucket": {r["bucket"]: r["n"] for r in export_buckets(rows).orderBy("bucket").collect()}}


def write_manifest(spark: SparkSession, path: str, manifest: dict) -> None:
    """A manifest as indented JSON."""
    write_text(spark, path, json.dumps(manifest, indent=2, ensure_ascii=False) + "\n")


def top_per(rows: DataFrame, by: str, order: list, k: int) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("place") <= k)


def screened(rows: DataFrame, text: str, words: list[str]) -> DataFrame:
    """`rows` with split and reserved_reason: a family whose text holds an avoided word is reserved, never deleted."""
    hits = cue_hits(F.coalesce(F.col(text), F.lit("")), words)
    hit = F.get(hits, F.lit(0))
    return rows.withColumns(
        {
            "reserved_reason": F.when(F.size(hits) > 0, F.concat(F.lit("avoided-topic keyword in seed situation: "), hit)).otherwise(F.lit("")),
            "split": F.when(F.size(hits) > 0, "reserved").otherwise(F.col("split")),
        }
    )


