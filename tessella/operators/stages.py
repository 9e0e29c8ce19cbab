"""The stages that ask models: families, prompts, responses, baselines, reviews, revisions and divergence verdicts.

Every stage asks for the records that a run lacks and returns the old and the new ones, so it can be run again at any
point.  Requests hold the facts that a stage decides on; the wording around them is the caller's `system` text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.loose_json import text_field
from ..functions.payload import label_of, missing_scores, review_of, verdict_of
from ..functions.text import jaccard, keeps_share, short_id, stripped, tokens
from ..plans.planner import align_groups, complete_pairs
from . import export
from .coverage import even_batches
from .decisions import comparable
from .gateway import NO_SERVER, Client, Role, StubClient, ask_all, request_all
from .shared import settled_table, small

Make = Callable[[], Client]
AXES = ["role_type", "harm_severity", "urgency", "public_or_private"]
REPAIR_SCORES = "That reply omitted these required keys inside `scores`: "
MOST_OVERLAP = 0.55


class IncompleteGroup(RuntimeError):
    """A planned pair of which only one family was written."""


class BaselineUnavailable(RuntimeError):
    """A base model that can't be reached, or whose role is off."""


def situation_signature(domain: Column, features: Column, seed: Column) -> Column:
    """What a writer is shown of a family that exists, so as not to write it again."""
    parts = F.array(domain, *(F.try_element_at(features, F.lit(k)) for k in ("role_type", "harm_severity", "relationship")))
    return F.concat(F.lit("["), F.array_join(F.filter(parts, lambda x: F.coalesce(x, F.lit("")) != ""), "/"), F.lit("] "), F.substring(seed, 1, 150))


def merged_features(planned: list[str], returned: Column) -> Column:
    """The plan's own features, with the relationship and the note that a writer adds; blank ones dropped."""
    own = F.map_from_arrays(F.array(*map(F.lit, planned)), F.array(*(F.coalesce(F.col(c), F.lit("")) for c in planned)))
    added = F.map_from_arrays(F.array(F.lit("relationship"), F.lit("note")), F.array(*(stripped(F.try_element_at(returned, F.lit(k))) for k in ("relationship", "note"))))
    return F.map_filter(F.map_concat(own, added), lambda _, v: v != "")


def known_or(returned: Column, known: list[str], fallback: Column) -> Column:
    """The known ones of the ids returned, in order; the fallback where none is."""
    good = F.filter(F.transform(F.coalesce(returned, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x.isin(known) if known else F.lit(False))
    return F.when(F.size(good) > 0, good).otherwise(fallback)


def generate_families(slots: DataFrame, existing: DataFrame, target_id: str, writer: Role, known_tradeoffs: list[str], avoid: list[str], system: str = "", per_call: int = 4, attempts: int = 2, make: Make = StubClient) -> DataFrame:
    """`existing` families (of the columns returned) with one for every slot of the plan that has none.

    Slots are asked for in batches of a domain that never part a pair; the items of a reply fill a batch's slots in
    order.  A slot that stays empty is asked for again by its index, `attempts` times in all.
    """
    families = existing
    for _ in range(attempts):
        left = slots.join(families.select("slot_index"), "slot_index", "left_anti")
        if left.isEmpty():
            break
        batches = complete_pairs(even_batches(left.withColumns({"stratum": F.col("domain"), "place": F.col("slot_index")}), per_call, "domain").withColumn("batch", F.concat_ws(":", "domain", "batch")))
        batches = settled_table(batches.withColumn("at", F.row_number().over(Window.partitionBy("batch").orderBy(F.coalesce(F.nullif("pair", F.lit("")), F.lit("~")), "slot_index")) - 1), "batches")
        assigned = F.concat_ws(", ", *(F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("tradeoff", "intent", "hypothesis", "choice", "mode", "institution", "asker_stance", *AXES, "pair")))
        lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", assigned.alias("line")))), lambda x: x["line"]), "\n")
        asked = batches.groupBy("batch", "domain").agg(F.count("*").alias("wanted"), lines.alias("lines"))
        prompts = asked.select(F.col("batch").alias("record_id"), F.lit(system).alias("system"), "wanted", F.concat(F.lit("domain="), "domain", F.lit(" wanted="), F.col("wanted").cast("string"), F.lit("\n"), "lines").alias("prompt"))
        replies = settled_table(request_all(prompts, writer, "families", ["families", "family", "scenario_families", "items"], "seed_situation", make), "replies")
        item = "struct<seed_situation:string,why_it_is_hard:string,tradeoff_ids:array<string>,principle_ids:array<string>,varied_fact:string,situation_features:map<string,string>>"
        got = replies.select(F.col("record_id").alias("batch"), F.posexplode(F.from_json("items", f"array<{item}>")).alias("at", "it"))
        made = batches.join(got, ["batch", "at"]).withColumn("seed_situation", stripped(F.col("it.seed_situation")))
        made = made.select(
            short_id("fam", F.lit(target_id), F.col("domain"), F.col("seed_situation")).alias("family_id"),
            "domain",
            known_or(F.col("it.tradeoff_ids"), known_tradeoffs, F.array("tradeoff")).alias("tradeoff_ids"),
            F.col("intent").alias("case_type_intent"),
            "seed_situation",
            stripped(F.col("it.why_it_is_hard")).alias("why_it_is_hard"),
            "split",
            F.when(F.col("pair") != "", short_id("cf", F.lit(target_id), F.col("pair"))).alias("counterfactual_group_id"),
            stripped(F.col("it.varied_fact")).alias("varied_fact"),
            "varied_axis",
            merged_features(AXES, F.col("it.situation_features")).alias("situation_features"),
            "mode",
            "slot_index",
            F.col("hypothesis").alias("divergence_hypothesis_id"),
            "asker_stance",
            "institution",
        ).dropDuplicates(["family_id"])
        fresh = export.screened(made, "seed_situation", avoid).join(families.select("family_id"), "family_id", "left_anti")
        families = settled_table(align_groups(families.unionByName(fresh, allowMissingColumns=True)), "families")
    return families


def require_complete(groups: DataFrame) -> None:
    """Refuses half a pair; `groups` is that of `planner.incomplete_groups`."""
    if found := groups.orderBy("pair").limit(20).collect():
        raise IncompleteGroup("; ".join(f"{r.pair}: {r.missing}" for r in found))


def generate_prompts(families: DataFrame, existing: DataFrame, writer: Role, variants: list[str], per_family: int = 3, per_eval: int = 1, reframed: int = 0, system: str = "", make: Make = StubClient) -> DataFrame:
    """`existing` prompts with those of every family without any, and a reframing of the first prompt of some eval families.

    Variants go round the eval families in order; a family that has one already gets no second, and one that shares most
    of its words with its base is dropped.
    """
    todo = families.join(existing.select("family_id").distinct(), "family_id", "left_anti")
    wanted = F.when(F.col("split") == "eval", per_eval).otherwise(per_family)
    asked = todo.select(F.col("family_id").alias("record_id"), F.lit(system).alias("system"), wanted.alias("wanted"), F.concat(F.lit("wanted="), wanted.cast("string"), F.lit(" mode="), "mode", F.lit(" case="), "case_type_intent", F.lit("\n"), "seed_situation").alias("prompt"))
    replies = settled_table(request_all(asked, writer, "prompts", ["prompts", "prompt", "messages", "items"], "text", make), "replies")
    got = replies.select(F.col("record_id").alias("family_id"), F.posexplode(F.from_json("items", "array<struct<text:string,register:string,question_kind:string>>")).alias("place", "it"))
    own = todo.select("family_id", F.col("case_type_intent").alias("case_type"), "mode")
    text = stripped(F.col("it.text"))
    base = got.join(own, "family_id").select(
        short_id("pr", F.col("family_id"), F.lit("base"), text).alias("prompt_id"), "family_id", F.lit("base").alias("variant"), text.alias("text"), "case_type", "mode", stripped(F.col("it.register")).alias("register"),
        stripped(F.col("it.question_kind")).alias("question_kind"), "place",
    ).where("text != ''")
    base = settled_table(base.dropDuplicates(["prompt_id"]), "prompts")
    prompts = existing.unionByName(base.drop("place"), allowMissingColumns=True)
    if not reframed or not variants:
        return prompts
    ranked = families.where("split = 'eval'").withColumn("k", F.row_number().over(Window.orderBy("slot_index")) - 1).where(F.col("k") < reframed)
    done = existing.where("variant != 'base'").select("family_id").distinct()
    first = base.groupBy("family_id").agg(F.min(F.struct("place", *[c for c in base.columns if c not in ("family_id", "place")])).alias("p"))
    jobs = ranked.join(done, "family_id", "left_anti").join(first, "family_id").select("family_id", "p", F.element_at(F.array(*map(F.lit, variants)), (F.col("k") % len(variants) + 1).cast("int")).alias("variant"))
    asked = jobs.select(F.col("p.prompt_id").alias("record_id"), F.lit(system).alias("system"), F.concat(F.lit("variant="), "variant", F.lit("\n"), "p.text").alias("prompt"))
    replies = settled_table(ask_all(asked, writer, "reframing", make), "replies")
    said = replies.select(F.col("record_id").alias("base_id"), stripped(text_field(F.col("reply"), "text", "prompt", "message")).alias("text"))
    fresh = jobs.join(said, F.col("p.prompt_id") == F.col("base_id")).where("text != ''").where(jaccard(tokens(F.col("p.text")), tokens(F.col("text"))) <= MOST_OVERLAP)
    made = fresh.select(short_id("pr", F.col("family_id"), F.col("variant"), F.col("text")).alias("prompt_id"), "family_id", "variant", "text", *(F.col(f"p.{c}").alias(c) for c in ("case_type", "mode", "register", "question_kind")))
    return settled_table(prompts.unionByName(made, allowMissingColumns=True), "prompts")


def generate_responses(prompts: DataFrame, families: DataFrame, existing: DataFrame, writer: Role, deliberating: float = 1.0, system: str = "", make: Make = StubClient) -> DataFrame:
    """`existing` responses with one for every prompt of a known family that has none."""
    todo = prompts.join(existing.select("prompt_id"), "prompt_id", "left_anti").join(families.select("family_id", F.col("divergence_hypothesis_id").alias("hypothesis"), "why_it_is_hard"), "family_id")
    asked = todo.select(F.col("prompt_id").alias("record_id"), F.lit(system).alias("system"), F.concat(F.lit("mode="), "mode", F.lit(" hypothesis="), F.coalesce("hypothesis", F.lit("")), F.lit("\n"), "why_it_is_hard", F.lit("\n"), "text").alias("prompt"))
    replies = settled_table(ask_all(asked, writer, "responses", make), "replies").where("error is null")
    it = F.from_json("reply", "deliberation string, answer string, principles_applied array<string>, source_passages array<string>, expected_actions string, varied_fact_effect string, intended_divergence_note string")
    rows = replies.select(F.col("record_id").alias("prompt_id"), it.alias("it")).join(todo.select("prompt_id", "mode", "hypothesis"), "prompt_id")
    none = F.array().cast("array<string>")
    hidden = F.struct(
        F.coalesce("it.principles_applied", none).alias("principles_applied"), F.slice(F.array_distinct(F.coalesce("it.source_passages", none)), 1, 3).alias("source_passages"),
        F.create_map().cast("map<string,string>").alias("source_passage_notes"), stripped(F.col("it.intended_divergence_note")).alias("intended_divergence_note"), F.coalesce("hypothesis", F.lit("")).alias("hypothesis_id"),
    )
    made = rows.select(
        short_id("resp", F.col("prompt_id"), F.lit(writer.model)).alias("response_id"), "prompt_id", F.when(keeps_share(F.col("prompt_id"), deliberating), stripped(F.col("it.deliberation"))).otherwise("").alias("deliberation"),
        stripped(F.col("it.answer")).alias("answer"), hidden.alias("hidden"), F.lit(writer.model).alias("generator_model"), F.lit(0).alias("revise_rounds"), "mode",
        stripped(F.col("it.expected_actions")).alias("expected_actions"), stripped(F.col("it.varied_fact_effect")).alias("varied_fact_effect"),
    )
    return settled_table(existing.unionByName(made, allowMissingColumns=True), "answers")


def needing_baseline(prompts: DataFrame, families: DataFrame) -> DataFrame:
    """The prompts of known families that are divergence cases or in eval."""
    known = families.select("family_id", F.col("split").alias("family_split")).dropDuplicates(["family_id"])
    return prompts.join(known, "family_id").where("case_type = 'divergence' or family_split = 'eval'").drop("family_split")


def answer_baseline(prompts: DataFrame, families: DataFrame, existing: DataFrame, role: Role, kind: str = "base", system: str = "", make: Make = StubClient) -> DataFrame:
    """`existing` answers with one for every prompt that needs it and has none, from a model without the specification.

    One prompt is asked first: a server that isn't there is then one clear error, not one a prompt.
    """
    if not role.enabled:
        raise BaselineUnavailable(f"role '{role.name}' is off")
    todo = needing_baseline(prompts, families).join(existing.select("prompt_id"), "prompt_id", "left_anti")
    asked = todo.select(F.col("prompt_id").alias("record_id"), F.lit(system).alias("system"), F.col("text").alias("prompt"))
    probe = ask_all(asked.orderBy("record_id").limit(1), role, "baseline", make, parsed=False).collect()
    if probe and (probe[0].error or "").startswith(NO_SERVER):
        raise BaselineUnavailable(probe[0].error)
    replies = settled_table(ask_all(asked, role, "baseline", make, parsed=False), "replies").where("error is null")
    made = replies.select(F.col("record_id").alias("prompt_id"), F.lit(role.model).alias("base_model"), F.col("reply").alias("text"), F.lit(kind).alias("kind"), "finish_reason")
    return settled_table(existing.unionByName(made, allowMissingColumns=True), "answers")


def review_responses(responses: DataFrame, prompts: DataFrame, existing: DataFrame, reviewer: Role, system: str = "", make: Make = StubClient) -> DataFrame:
    """`existing` reviews with one for every response without any; a reply that leaves score keys out is asked for again."""
    todo = responses.join(existing.select("response_id"), "response_id", "left_anti").join(prompts.select("prompt_id", "text"), "prompt_id")
    said = F.concat(F.col("text"), F.lit("\n---\n"), F.col("deliberation"), F.lit("\n---\n"), F.col("answer"))
    asked = settled_table(todo.select(F.col("response_id").alias("record_id"), F.lit(system).alias("system"), said.alias("prompt")), "asked")
    first = settled_table(ask_all(asked, reviewer, "review", make), "replies")
    lacking = first.where("error is null").withColumn("lacking", missing_scores(F.col("reply"))).where(F.size("lacking") > 0)
    again = asked.join(lacking.select("record_id", "lacking", "reply"), "record_id").select(
        "record_id", "system", F.concat("prompt", F.lit("\n---\n"), F.substring("reply", 1, 3000), F.lit("\n---\n" + REPAIR_SCORES), F.array_join("lacking", ", ")).alias("prompt")
    )
    second = ask_all(again, reviewer, "review", make).select("record_id", F.col("reply").alias("repaired"))
    made = first.where("error is null").join(second, "record_id", "left").select(review_of(F.coalesce("repaired", "reply"), F.col("record_id"), F.lit(reviewer.model)).alias("v")).select("v.*")
    return settled_table(existing.unionByName(made, allowMissingColumns=True), "answers")


def revise(responses: DataFrame, prompts: DataFrame, reviews: DataFrame, writer: Role, reviewer: Role, system: str = "", make: Make = StubClient) -> tuple[DataFrame, DataFrame]:
    """(responses, reviews) after the responses whose verdict is `revise` were rewritten and reviewed anew; a rewrite
    without an answer leaves a response and its review as they are."""
    flagged = responses.join(reviews.where("verdict = 'revise'").select("response_id", "issues", "rationale"), "response_id").join(prompts.select("prompt_id", "text"), "prompt_id")
    said = F.concat(F.col("text"), F.lit("\n---\n"), F.col("answer"), F.lit("\n---\n"), F.array_join("issues", "\n"), F.lit("\n"), F.col("rationale"))
    replies = settled_table(ask_all(flagged.select(F.col("response_id").alias("record_id"), F.lit(system).alias("system"), said.alias("prompt")), writer, "revise", make), "replies")
    it = F.from_json("reply", "deliberation string, answer string")
    new = settled_table(replies.select(F.col("record_id").alias("response_id"), stripped(it["deliberation"]).alias("new_deliberation"), stripped(it["answer"]).alias("new_answer")).where("new_answer != ''"), "revised")
    after = responses.join(small(new), "response_id", "left").withColumns(
        {"deliberation": F.coalesce("new_deliberation", "deliberation"), "answer": F.coalesce("new_answer", "answer"), "revise_rounds": F.col("revise_rounds") + F.col("new_answer").isNotNull().cast("int")}
    ).drop("new_deliberation", "new_answer")
    kept = reviews.join(new.select("response_id"), "response_id", "left_anti").select(reviews.columns)
    return after, review_responses(after.join(new.select("response_id"), "response_id", "left_semi"), prompts, reviews.limit(0), reviewer, system, make).unionByName(kept)


def judge_divergence(prompts: DataFrame, families: DataFrame, responses: DataFrame, base: DataFrame, generic: DataFrame, existing: DataFrame, judge: Role, system: str = "", make: Make = StubClient) -> DataFrame:
    """`existing` verdicts with one for every divergence prompt that has a response and a base answer.

    Where a leg is cut off or missing the verdict is unverified and nobody is asked.  The three replies carry letters in
    an order that a digest of the prompt fixes.
    """
    legs = [df.select("prompt_id", F.struct(*df.columns).alias(name)) for df, name in ((base, "base"), (generic, "generic"))]
    rows = prompts.where("case_type = 'divergence'").join(existing.select("prompt_id"), "prompt_id", "left_anti").join(responses.select("prompt_id", "answer"), "prompt_id")
    rows = settled_table(comparable(rows.join(legs[0], "prompt_id").join(legs[1], "prompt_id", "left")).withColumn("labels", label_of(F.col("prompt_id"))), "legs")
    said = {"candidate": F.col("answer"), "generic": F.col("generic.text"), "weak": F.col("base.text")}
    replies = F.array_sort(F.array(*(F.concat(F.try_element_at("labels", F.lit(k)), F.lit(": "), t) for k, t in said.items())))
    hypotheses = families.select("family_id", F.col("divergence_hypothesis_id").alias("hypothesis"))
    open_rows = rows.where("unverified_reason = ''").join(hypotheses, "family_id", "left")
    asked = open_rows.select(F.col("prompt_id").alias("record_id"), F.lit(system).alias("system"), F.concat(F.lit("hypothesis="), F.coalesce("hypothesis", F.lit("")), F.lit("\n"), "text", F.lit("\n"), F.array_join(replies, "\n")).alias("prompt"))
    got = settled_table(ask_all(asked, judge, "divergence", make), "replies").where("error is null").join(rows.select(F.col("prompt_id").alias("record_id"), "labels"), "record_id")
    judged = got.select(verdict_of(F.col("reply"), F.col("record_id"), F.lit(judge.model), F.col("labels")).alias("w")).select("w.*")
    skipped = rows.where("unverified_reason != ''").select(
        "prompt_id", F.lit(judge.model).alias("judge_model"), F.lit(False).alias("diverges"), F.lit("none").alias("kind"), F.lit("not judged").alias("explanation"), F.lit("none").alias("divergence_source"), "unverified_reason"
    )
    return settled_table(existing.unionByName(judged, allowMissingColumns=True).unionByName(skipped, allowMissingColumns=True), "verdicts")
