"""The corpus pipeline: quality rules, line dedup, near-duplicate groups, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
`documents`.  A stage works on all rows that the one before it kept, and begins with the memory that it left behind returned.
"""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from tessella.llm.common import materialise, relieve, table
from tessella.llm.decontaminate import benchmark_matches
from tessella.llm.idfilter import without
from tessella.llm.linededup import dedup_lines
from tessella.llm.neardup import near_duplicates
from tessella.llm.packing import pack_documents
from tessella.llm.quality import COUNTS, fit_quality, judge_quality

ORACLE_SQL = None


def _free(docs, names):
    """The operators replace columns of these names, which a stage couldn't return."""
    if taken := sorted({c for c in docs.columns if c.lower() in names}):
        raise ValueError(f"rename the columns {taken} before this stage")


def _stage(function):
    @functools.wraps(function)
    def run_stage(spark, docs, sf_dir):
        relieve(spark)
        return function(spark, docs, sf_dir)

    return run_stage


@_stage
def quality_rules(spark, docs, sf_dir):
    """Documents that the fixed limits and the trees keep.  The trees learn from the labelled rows of `docs`.

    A null or empty text goes, having no words; repeated rows are judged alike; a null doc_id is judged by its text;
    an empty table stays empty; columns of any name are carried, but one named as a statistic or verdict of the operator
    is an error, for the stage returns its input's columns.
    """
    _free(docs, [*COUNTS, "quality_score", "base_failed", "kept"])
    forest = fit_quality(docs, table(spark, sf_dir, "labels"))
    return judge_quality(docs, forest).where("kept").select(docs.columns)


@_stage
def line_dedup(spark, docs, sf_dir):
    """Texts without the lines that an earlier line is similar to; a document with no word left goes.

    n_chars, where there is one, follows the text.  A null or empty text is as it was, as is a row without doc_id; of
    equal lines that of the smaller doc_id stays, and rows that repeat a doc_id take nothing from each other; an empty
    table stays empty.
    """
    _free(docs, ["n_lines", "n_removed"])
    cut = dedup_lines(docs).where(r"n_removed = 0 or text rlike '[^\\x20\\x09-\\x0D]'")
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


@_stage
def near_dedup(spark, docs, sf_dir):
    """The document with the smallest doc_id of each near-duplicate group.

    Rows that repeat a doc_id are one document, kept or dropped together; texts without words and rows without doc_id are
    kept; an empty table stays empty.
    """
    dropped = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("key")).distinct()
    return without(docs, F.col("doc_id").cast("long"), materialise(dropped, "dropped"))


@_stage
def decontamination(spark, docs, sf_dir):
    """Documents in which no benchmark item is found.

    A null or empty text holds none; a null doc_id is judged by its text, repeated rows alike; without items or
    documents nothing changes.
    """
    matches = benchmark_matches(docs, table(spark, sf_dir, "benchmark"))
    found = materialise(matches.select(F.col("row_hash").alias("key")).distinct(), "contaminated")
    return without(docs, F.xxhash64("doc_id", "text"), found)


@_stage
def packing(spark, docs, sf_dir):
    """Every kept document's pieces and their places in sequences.

    A null or empty text is one end token; repeated rows are packed each; an empty table gives an empty one.
    """
    return pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{k}")
    return docs


def queries():
    return {"pipeline": run}


def oracle_sql():
    return {}
