"""Quality rules: fixed limits, then gradient-boosted trees over document statistics (operator 5).

The statistics of every whole text come from one vectorised pass over the Arrow buffer.  Trees are fitted on
the driver to a bounded sample of labelled documents (`sample` rows, chosen by a hash of the document) and
travel to the executors as a few flat arrays.  Symbol share, shouting, repeated words and repeated lines may
only lower the score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, tidy
from .trees import Forest, fit
from .words import SPACE, U, Chunk, chunks, mix

LABEL_SAMPLE = 20_000
KEEP_AT = 0.5
MIN_WORDS = 50
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share", "bang_share", "line_words", "distinct_share"]
MONOTONE = [0, 0, -1, -1, -1, -1, 0, 0, -1, 0, 0]


def _table(chars: bytes) -> np.ndarray:
    marked = np.zeros(256, bool)
    marked[np.frombuffer(chars, np.uint8)] = True
    return marked


_SYMBOL = _table(b"#*$%&|<>")
_UPPER = _table(bytes(range(65, 91)))
_LOWER = _table(bytes(range(97, 123)))
_DIGIT = _table(bytes(range(48, 58)))
_MARK = _table(b".,;:?'\"()-")
_BANG = _table(b"!")
_CHAR = ~SPACE & ((np.arange(256) & 0xC0) != 0x80)
_WORD = ~SPACE


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: how many equal it, and whether it is the first of them."""
    _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
    is_first = np.zeros(len(key), bool)
    is_first[first] = True
    return count[inverse], is_first


def _per_text(marks: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return sums[first[1:]] - sums[first[:-1]]


def statistics(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(counts, features) of the chunk's texts, in the order of COUNTS and FEATURES."""
    start, end, first = chunk.words()
    h = chunk.span_hash(start, end)
    owner = np.repeat(np.arange(chunk.n, dtype=np.uint64), np.diff(first))
    salt = mix(owner + U(1))
    n = len(h)
    covered = np.zeros(n, bool)
    if n >= 3:
        whole = owner[:-2] == owner[2:]
        key = mix(h[:-2] * U(3) + mix(h[1:-1] + U(1)) * U(5) + mix(h[2:] + U(2)) * U(7) + salt[:-2])[whole]
        at = np.flatnonzero(whole)[_distinct(key)[0] > 1]
        for k in range(3):
            covered[at + k] = True
    fresh = _distinct(h + salt)[1] if n else covered
    ls, le, lfirst = chunk.lines()
    words_before = np.concatenate([[0], np.cumsum(_WORD[chunk.data], dtype=np.int64)])
    has_word = words_before[le] > words_before[ls]
    line_owner = np.repeat(np.arange(chunk.n, dtype=np.uint64), np.diff(lfirst))
    at = np.flatnonzero(has_word)
    again = np.zeros(len(ls), bool)
    if len(at):
        again[at] = ~_distinct(chunk.span_hash(ls[at], le[at]) + mix(line_owner[at] + U(1)))[1]
    n_words, lines = np.diff(first), _per_text(has_word, lfirst)
    chars, symbols = chunk.counts(_CHAR), chunk.counts(_SYMBOL)
    dup, repeat = _per_text(again, lfirst), _per_text(covered, first)
    counts = np.stack([n_words, chars, symbols, dup, repeat], 1)
    per_word, per_char, per_line = np.maximum(n_words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    upper, lower = chunk.counts(_UPPER), chunk.counts(_LOWER)
    features = np.stack(
        [
            np.log1p(n_words),
            chars / per_word,
            symbols / per_char,
            dup / per_line,
            repeat / per_word,
            upper / np.maximum(upper + lower, 1),
            chunk.counts(_DIGIT) / per_char,
            chunk.counts(_MARK) / per_char,
            chunk.counts(_BANG) / per_char,
            np.minimum(n_words / per_line, 1000),
            _per_text(fresh, first) / per_word,
        ],
        1,
    )
    return counts, features


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > 50 * counts[:, 0])


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = LABEL_SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and quality of at most `sample` labelled documents, the least by a hash of their ids."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )

    def measure(batches):
        for batch in batches:
            parts = [statistics(c)[1] for c in chunks(batch.column(1), fold=False)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
            arrays = [batch.column(0), *(pa.array(x[:, k]) for k in range(x.shape[1]))]
            yield pa.RecordBatch.from_arrays(arrays, ["quality", *FEATURES])

    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select(F.col("quality").cast("int").alias("quality"), "text")
        .mapInArrow(tidy(measure), "quality int, " + ", ".join(f"{f} double" for f in FEATURES))
        .toPandas()
    )
    return rows[FEATURES].to_numpy(float).reshape(-1, len(FEATURES)), rows["quality"].to_numpy(float)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = LABEL_SAMPLE, **settings) -> Forest:
    x, y = labelled_sample(docs, labels, sample)
    order = np.lexsort([*x.T, y]) if len(y) else np.zeros(0, int)
    return fit(x[order], y[order], MONOTONE, **settings)


def judge_quality(docs: DataFrame, forest: Forest, keep_at: float = KEEP_AT) -> DataFrame:
    """`docs` with the counts, quality (the trees' probability), base_failed and kept.

    A null or empty text has no words and fails; texts of any length are read whole; ties and repeated rows
    are judged alike; an empty table gives an empty one.  Columns of `docs` that clash with a result's are
    replaced by it.
    """
    names = [*COUNTS, "quality_score", "base_failed", "kept"]
    carried = [c for c in docs.columns if c not in names]
    schema = docs.select(carried).schema
    kinds = [*["long"] * len(COUNTS), "double", "boolean", "boolean"]
    for name, kind in zip(names, kinds):
        schema = schema.add(name, kind)
    at = carried.index("text")

    def judge(batches):
        for batch in batches:
            counts, score = [np.zeros((0, len(COUNTS)), np.int64)], [np.zeros(0)]
            for c in chunks(batch.column(at), fold=False):
                own, x = statistics(c)
                counts.append(own)
                score.append(forest.probability(x))
            counts, score = np.concatenate(counts), np.concatenate(score)
            failed = base_failed(counts)
            made = [*(pa.array(counts[:, k]) for k in range(len(COUNTS))), pa.array(score), pa.array(failed), pa.array(~failed & (score >= keep_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])

    return docs.select(carried).mapInArrow(tidy(judge), schema)


def op5_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = fit_quality(docs, table(spark, sf_dir, "labels"))
    return judge_quality(docs, forest).select("doc_id", *COUNTS, "base_failed", "kept", "quality_score")
