"""Token counts of documents in flat token files without an index (operator 6).

A token file is little-endian unsigned 16-bit identifiers, each document followed by the end-of-document
identifier.  A reader takes it in fixed blocks, finds separators with one vectorised comparison, and knows
every document that begins and ends inside a block.  What crosses blocks is stitched by a prefix scan over
one small row per block (the position of the last separator so far).  The scan itself is in two levels, spans
of blocks and blocks within a span, so that one huge file is not one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table, tidy
from .tokens import TokenIds, in_slices

BLOCK = 1 << 18  # tokens
SPAN = 1024  # blocks scanned together
END_OF_DOCUMENT = 49407
VOCABULARY_SIZE = SPELLED_OUT = 49408


def token_blocks(docs: DataFrame, vocabulary: str | None = None, eod: int = END_OF_DOCUMENT, block: int = BLOCK) -> DataFrame:
    """Tokenise `docs` into flat files, one per task, as rows (file, block, payload, doc_ids).

    doc_ids are the documents whose separators lie in the block, in order: a manifest of identity, with no
    offsets or lengths.  An end-of-document identifier that a text itself spells out would read as a separator; it is
    written as SPELLED_OUT, an identifier that the vocabulary doesn't have, and counts as the one token that it is.
    """

    def write(batches):
        ids_of, file = TokenIds.open(vocabulary), TaskContext.get().partitionId()
        held, size, ended, number = [], 0, [], 0
        end = np.array([eod], "<u2")

        def row(payload, ids):
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([number], pa.int64()), pa.array([payload.tobytes()], pa.binary()), pa.array([ids], pa.list_(pa.int64()))],
                ["file", "block", "payload", "doc_ids"],
            )

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, own in in_slices(texts):
                for k, tokens in enumerate(ids_of.of_all(own), first):
                    part = np.frombuffer(tokens, "<u4").astype("<u2")
                    part[part == eod] = SPELLED_OUT
                    held += [part, end]
                    size += len(part) + 1
                    ended.append((ids[k], size))  # the separator is the token before this count
                    if size >= block:
                        whole = np.concatenate(held)
                        while len(whole) >= block:
                            inside = [d for d, at in ended if at <= block]
                            ended = [(d, at - block) for d, at in ended if at > block]
                            yield row(whole[:block], inside)
                            number += 1
                            whole = whole[block:]
                        held, size = [whole], len(whole)
        if size:
            yield row(np.concatenate(held), [d for d, _ in ended])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(write, tokens=True), "file long, block long, payload binary, doc_ids array<long>"
    )


def read_token_files(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """Flat token files, of any length, as (file, block, payload), by one scan with Spark's own file system.

    Spark reads a file as one row, of 2 GB at most, and cuts it into blocks where it stands: write tokens in parts below
    that.  A file is named by its path; an empty one has no block, and a last odd byte is no token.
    """
    whole = spark.read.format("binaryFile").load(path).select("path", "length", "content").where("length > 1")
    cut = whole.select(F.col("path").alias("file"), "content", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / (2 * block)))).alias("block"))
    return cut.select("file", F.col("block").cast("long").alias("block"), F.expr(f"substring(content, cast(block * {2 * block} as int) + 1, {2 * block})").alias("payload"))


def _separators(blocks: DataFrame, eod: int, block: int) -> DataFrame:
    """Per block: positions of its separators in the file, and its tokens."""

    def scan(batches):
        for batch in batches:
            found, sizes = [], []
            for number, payload in zip(batch.column(1).to_pylist(), batch.column(2)):
                tokens = np.frombuffer(payload.as_buffer(), "<u2", len(payload.as_buffer()) // 2)
                sizes.append(len(tokens))
                found.append(np.flatnonzero(tokens == eod) + number * block)
            arrays = [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64())), pa.array(sizes, pa.int64())]
            names = ["file", "block", "separators", "n_tokens"]
            if batch.num_columns > 3:
                arrays, names = [*arrays, batch.column(3)], [*names, "doc_ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = f"file {blocks.schema['file'].dataType.simpleString()}, block long, separators array<long>, n_tokens long"
    if "doc_ids" in blocks.columns:
        schema += ", doc_ids array<long>"
    return blocks.mapInArrow(tidy(scan), schema)


def count_tokens(blocks: DataFrame, eod: int = END_OF_DOCUMENT, block: int = BLOCK) -> DataFrame:
    """One row per document of the files: file, ordinal (from 0), doc_id where a manifest is given, n_tokens
    (without the separator).  Tokens after a file's last separator are a document of their own, with
    `terminated` false.  A file without tokens has no documents; two separators in a row enclose an empty one.
    """
    manifest = "doc_ids" in blocks.columns
    found = materialise(_separators(blocks, eod, block), "separators")
    small = found.select(
        "file", "block", F.floor(F.col("block") / SPAN).alias("span"), F.try_element_at("separators", F.lit(-1)).alias("last"), F.size("separators").alias("n"), "n_tokens"
    )
    spans = small.groupBy("file", "span").agg(F.max("last").alias("span_last"), F.sum("n").alias("span_n"), F.max(F.col("block") * block + F.col("n_tokens")).alias("span_end"))
    earlier = Window.partitionBy("file").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    spans = spans.select(
        "file",
        "span",
        F.max("span_last").over(earlier).alias("last_before"),
        F.coalesce(F.sum("span_n").over(earlier), F.lit(0)).alias("n_before"),
        F.max("span_last").over(whole).alias("file_last"),
        F.sum("span_n").over(whole).alias("file_n"),
        F.max("span_end").over(whole).alias("file_end"),
        (F.row_number().over(Window.partitionBy("file").orderBy("span")) == 1).alias("first_span"),
    )
    inner = Window.partitionBy("file", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = small.join(spans, ["file", "span"]).select(
        "file",
        "block",
        F.coalesce(F.max("last").over(inner), "last_before", F.lit(-1)).alias("previous"),
        (F.col("n_before") + F.coalesce(F.sum("n").over(inner), F.lit(0))).alias("ordinal"),
    )
    own = F.posexplode(F.arrays_zip("separators", "doc_ids") if manifest else F.arrays_zip("separators"))
    documents = (
        found.join(stitched, ["file", "block"])
        .withColumn("before", F.concat(F.array("previous"), "separators"))
        .select("file", "ordinal", "before", own.alias("k", "it"))
        .select(
            "file",
            (F.col("ordinal") + F.col("k")).alias("ordinal"),
            *([F.col("it.doc_ids").alias("doc_id")] if manifest else []),
            (F.col("it.separators") - F.get("before", F.col("k")) - 1).alias("n_tokens"),
            F.lit(True).alias("terminated"),
        )
    )
    rest = spans.where("first_span and file_end - 1 > coalesce(file_last, -1)").select(
        "file",
        F.col("file_n").alias("ordinal"),
        *([F.lit(None).cast("long").alias("doc_id")] if manifest else []),
        (F.col("file_end") - 1 - F.coalesce("file_last", F.lit(-1))).alias("n_tokens"),
        F.lit(False).alias("terminated"),
    )
    return documents.union(rest)


def count_document_tokens(docs: DataFrame, vocabulary: str | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id and n_tokens of every row of `docs` (doc_id, text), counted from flat token files of its texts.

    A null or empty text has 0 tokens; a null doc_id stays null; texts longer than a block span several;
    repeated rows are counted each; an empty table gives an empty one; other columns are ignored.
    """
    return count_tokens(materialise(token_blocks(docs, vocabulary, block=block), "tokens"), block=block)


def op6_token_counts(spark, sf_dir):
    return count_document_tokens(table(spark, sf_dir, "documents")).select("doc_id", "file", "ordinal", "n_tokens", "terminated")
