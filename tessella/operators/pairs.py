"""Scores of all pairs, never written out: histograms, selections and best matches come from the tasks that make them.

A robust threshold is defined over every pair's score, so every pair is scored; but what leaves a task is a histogram
of fixed size, the scores inside one narrow range, the pairs above a cut or the best few.  Medians are exact: a range
that holds the wanted ranks is narrowed by histograms until few enough scores are left in it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens

BINS = 4096
FEW_VALUES = 1 << 17  # scores of one range that the driver sorts
BLOCK_ROWS = 1024
BLOCK_TOKENS = 2_000_000  # of items that are broadcast at once
PAIR = "a_id long, b_id long, score double"
Scorer = Callable[[np.ndarray, np.ndarray, np.ndarray], pd.DataFrame]


def _bins(x: np.ndarray, low: float, high: float) -> np.ndarray:
    """The bin of each score; a score below the range has bin -1, one above it BINS."""
    at = np.floor((x - low) * (BINS / (high - low)))
    return np.where(x < low, -1, np.where(x > high, BINS, np.clip(at, 0, BINS - 1))).astype(np.int64)


def _moved(x: np.ndarray, centre: float | None) -> np.ndarray:
    return x if centre is None else np.abs(x - centre)


class Scores:
    """All pair scores of some rows; a subclass runs `each` over blocks of (a ids, b ids, scores) and unions what it returns."""

    def _run(self, each: Scorer, schema: str) -> DataFrame:
        raise NotImplementedError

    def zeros(self) -> int:
        """Pairs that are known to score 0 and that no block holds."""
        return 0

    def histogram(self, low: float, high: float, centre: float | None = None) -> np.ndarray:
        """BINS + 2 counts of the scores, or of their distances from `centre`: below `low`, the bins, above `high`."""

        def count(a, b, x):
            at, n = np.unique(_bins(_moved(x, centre), low, high), return_counts=True)
            return pd.DataFrame({"bin": at, "n": n})

        out = np.zeros(BINS + 2, np.int64)
        for r in self._run(count, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
            out[r["bin"] + 1] += r["n"]
        if self.zeros():
            out[_bins(_moved(np.zeros(1), centre), low, high)[0] + 1] += self.zeros()
        return out

    def values(self, low: float, high: float, centre: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(distinct values in order, counts) within the range; the caller knows that they are few."""

        def pick(a, b, x):
            y = _moved(x, centre)
            value, n = np.unique(y[(y >= low) & (y <= high)], return_counts=True)
            return pd.DataFrame({"value": value, "n": n})

        rows = self._run(pick, "value double, n long").groupBy("value").agg(F.sum("n").alias("n")).collect()
        found = {r["value"]: r["n"] for r in rows}
        zero = float(_moved(np.zeros(1), centre)[0])
        if self.zeros() and low <= zero <= high:
            found[zero] = found.get(zero, 0) + self.zeros()
        value = np.array(sorted(found), float)
        return value, np.array([found[v] for v in value.tolist()], np.int64)

    def at_ranks(self, ranks: tuple[int, ...], low: float, high: float, centre: float | None = None) -> list[float]:
        """The scores of the given ranks from 0, all of which lie between `low` and `high`."""
        found = []
        for rank in ranks:
            a, b, before = low, high, 0
            while True:
                h = self.histogram(a, b, centre)
                inner = np.cumsum(h[1:-1]) + h[0]
                k = int(np.searchsorted(inner, rank, side="right"))
                width = (b - a) / BINS
                # A hair wider than the bin, so that a score on its edge is inside whichever way it was rounded.
                a, b = a + k * width - 1e-9 * width, a + (k + 1) * width + 1e-9 * width
                if h[k + 1] <= FEW_VALUES or b - a < 1e-15:
                    break
            value, n = self.values(a, b, centre)
            before = int(self.histogram(a, b, centre)[0])
            found.append(float(value[np.searchsorted(before + np.cumsum(n), rank, side="right")]))
        return found

    def count(self) -> int:
        return int(self.histogram(-2.0, 2.0).sum())

    def least_gap(self) -> float:
        """The least difference between two scores that are neighbours in order."""
        scores = self._run(lambda a, b, x: pd.DataFrame({"score": np.unique(x)}), "score double")
        if self.zeros():
            scores = scores.union(scores.sparkSession.createDataFrame([(0.0,)], "score double"))
        scores = scores.distinct().repartitionByRange("score").sortWithinPartitions("score")

        def gaps(frames):
            first = last = least = None
            for f in frames:
                x = f["score"].to_numpy()
                if not len(x):
                    continue
                y = x if last is None else np.r_[last, x]
                if len(y) > 1:
                    least = min(float(np.diff(y).min()), least if least is not None else np.inf)
                first, last = x[0] if first is None else first, x[-1]
            yield pd.DataFrame({"first": [first], "last": [last], "least": [least]} if first is not None else {"first": [], "last": [], "least": []})

        rows = sorted((r["first"], r["last"], r["least"]) for r in scores.mapInPandas(gaps, "first double, last double, least double").collect())
        edges = [b[0] - a[1] for a, b in zip(rows, rows[1:])] + [r[2] for r in rows if r[2] is not None]
        return min((e for e in edges if e > 0), default=0.0)

    def at_least(self, cut: float, more_than: float | None = None) -> DataFrame:
        """(a_id, b_id, score) of the pairs of at least `cut`."""

        def pick(a, b, x):
            keep = x >= cut
            return pd.DataFrame({"a_id": a[keep], "b_id": b[keep], "score": x[keep]})

        return self._run(pick, PAIR)

    def top(self, k: int) -> DataFrame:
        """The k pairs of the highest score, of equals those of the highest ids; a task gives up its k best."""

        def pick(a, b, x):
            if len(x) > k:
                keep = x >= np.partition(x, len(x) - k)[len(x) - k]
                a, b, x = a[keep], b[keep], x[keep]
            order = np.lexsort((-b, -a, -x))[:k]
            return pd.DataFrame({"a_id": a[order], "b_id": b[order], "score": x[order]})

        return self._run(pick, PAIR).orderBy(F.desc("score"), F.desc("a_id"), F.desc("b_id")).limit(k)

    def best(self) -> DataFrame:
        """(a_id, b_id, score) of the best partner of each a, the one of the least id among equals; only scores above 0."""

        def pick(a, b, x):
            order = np.lexsort((b, -x, a))
            order = order[x[order] > 0]
            first = order[np.r_[True, a[order][1:] != a[order][:-1]][: len(order)]]
            return pd.DataFrame({"a_id": a[first], "b_id": b[first], "score": x[first]})

        found = self._run(pick, PAIR).groupBy("a_id").agg(F.max(F.struct("score", (-F.col("b_id")).alias("m"))).alias("it"))
        return found.select("a_id", (-F.col("it.m")).alias("b_id"), F.col("it.score").alias("score"))


class VectorScores(Scores):
    """Cosines of every pair (a_id < b_id) of `vectors` (id, vector): rows are dealt into blocks, a pair of blocks is a matrix product."""

    def __init__(self, vectors: DataFrame, block_rows: int = BLOCK_ROWS):
        blocks = max(1, -(-vectors.count() // block_rows))
        dealt = vectors.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("own"))
        self.pairs = dealt.select("id", "vector", "own", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")).select(
            "id", "vector", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
        )

    def _run(self, each: Scorer, schema: str) -> DataFrame:
        def score(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            low, high = key
            x = np.stack(rows["vector"].to_numpy()).astype(float)
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
            ids, own = rows["id"].to_numpy(), rows["own"].to_numpy()
            i, j = np.flatnonzero(own == low), np.flatnonzero(own == high)
            product = x[i] @ x[j].T
            a, b = np.broadcast_arrays(ids[i][:, None], ids[j][None])
            keep = a < b if low == high else np.ones(product.shape, bool)
            a, b = a[keep], b[keep]
            return each(np.minimum(a, b), np.maximum(a, b), product[keep])

        return self.pairs.groupBy("low", "high").applyInPandas(score, schema)


class TokenScores(Scores):
    """Jaccard similarities of the token sets of `items` and `rows` (id, text), for pairs that share a token.

    Items are broadcast in blocks of about `block_tokens` tokens and every block sees all rows, so no token gathers
    its rows in one task.  With `within`, items and rows are the same table, of which every two rows are a pair once.
    """

    def __init__(self, items: DataFrame, rows: DataFrame, within: bool = False, block_tokens: int = BLOCK_TOKENS):
        self.spark, self.within = rows.sparkSession, within
        sets = items.select("id", tokens(F.coalesce("text", F.lit(""))).alias("t"))
        n_items, n_tokens = sets.agg(F.count("*"), F.coalesce(F.sum(F.size("t")), F.lit(0))).first()
        blocks = max(1, -(-n_tokens // block_tokens))
        self.blocks = [sets if blocks == 1 else sets.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k) for k in range(blocks)]
        self.rows = rows.select("id", tokens(F.coalesce("text", F.lit(""))).alias("t"))
        self.all_pairs, self._zeros, self._held = n_items, None, {}

    def zeros(self) -> int:
        if self._zeros is None:
            found = sum(r["n"] for r in self._run(lambda a, b, x: pd.DataFrame({"n": [len(x)]}), "n long").groupBy().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).collect())
            n = self.all_pairs
            self._zeros = (n * (n - 1) // 2 if self.within else n * self.rows.count()) - found
        return self._zeros

    def _block(self, k: int):
        """A block's items as (ids, sizes, vocabulary, where each word's items begin, items), broadcast once."""
        if k not in self._held:
            got = sorted((r["id"], sorted(r["t"])) for r in self.blocks[k].collect())
            ids, sizes = np.array([g[0] for g in got], np.int64), np.array([len(g[1]) for g in got], np.int64)
            word, of = np.array([w for g in got for w in g[1]], object), np.repeat(np.arange(len(got)), sizes)
            vocabulary, at = np.unique(word.astype(str), return_inverse=True) if len(word) else (np.zeros(0, str), np.zeros(0, np.int64))
            order = np.argsort(at, kind="stable")
            first = np.searchsorted(at[order], np.arange(len(vocabulary) + 1))
            self._held[k] = self.spark.sparkContext.broadcast((ids, sizes, pa.array(vocabulary.tolist(), pa.string()), first, of[order]))
        return self._held[k]

    def _run(self, each: Scorer, schema: str) -> DataFrame:
        found = None
        for k in range(len(self.blocks)):
            own = self._scored(self._block(k), each, schema)
            found = own if found is None else found.union(own)
        return found

    def _scored(self, block, each: Scorer, schema: str) -> DataFrame:
        within = self.within

        def score(batches):
            ids, sizes, vocabulary, first, items = block.value
            # Rows that are scored together: a dense table of shared counts bounds their number.
            step = max(1, (1 << 22) // max(1, len(ids)))
            for whole in batches:
                for batch in (whole.slice(k, step) for k in range(0, whole.num_rows, step)):
                    rows, listed = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
                    size = np.asarray(pc.fill_null(pc.list_value_length(listed), 0)).astype(np.int64)
                    word = np.asarray(pc.fill_null(pc.index_in(listed.flatten(), value_set=vocabulary), -1)).astype(np.int64)
                    owner = np.repeat(np.arange(len(rows)), size)[word >= 0]
                    word = word[word >= 0]
                    per = first[word + 1] - first[word]
                    shared = np.zeros(len(rows) * len(ids), np.int64)
                    upto = np.cumsum(per)
                    cuts = np.unique(np.r_[0, np.searchsorted(upto, np.arange(1 << 21, int(per.sum()), 1 << 21)), len(word)]).tolist()
                    for a, b in zip(cuts, cuts[1:]):
                        w, o, p = word[a:b], owner[a:b], per[a:b]
                        at = np.repeat(first[w] - np.cumsum(p) + p, p) + np.arange(p.sum())
                        shared += np.bincount(np.repeat(o * len(ids), p) + items[at], minlength=len(shared))
                    at = np.flatnonzero(shared)
                    row, item = at // max(1, len(ids)), at % max(1, len(ids))
                    x = shared[at] / (sizes[item] + size[row] - shared[at])
                    keep = ids[item] < rows[row] if within else np.ones(len(at), bool)
                    yield each(ids[item][keep], rows[row][keep], x[keep])

        def framed(batches):
            for f in score(batches):
                yield pa.RecordBatch.from_pandas(f, preserve_index=False)

        return self.rows.mapInArrow(framed, schema)


class ListedScores(Scores):
    """The scores in column `score` of a table, and `extra` more of 0."""

    def __init__(self, scores: DataFrame, extra: int = 0):
        self.scores, self.extra = scores.select(F.col("score").cast("double").alias("score")), extra

    def zeros(self) -> int:
        return self.extra

    def _run(self, each: Scorer, schema: str) -> DataFrame:
        def run(frames):
            for f in frames:
                x = f["score"].to_numpy()
                yield each(np.zeros(len(x), np.int64), np.zeros(len(x), np.int64), x)

        return self.scores.mapInPandas(run, schema)
