"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification (operator 8).

Distances are in words (lower-cased runs of letters, digits and non-ASCII characters).  The CGK walk copies the
word under a pointer at every step and moves the pointer on or not by a random bit of (step, word), so texts at
a small edit distance get strings at a small Hamming distance.  An item is embedded in overlapping segments,
each with its own walk, as is the window of a document that an item may fill.  A repetition samples SAMPLED
steps of a segment's string; a window is a candidate for an item where all sampled words agree.  Walks start at
every word of every document and stop at the first sampled step at which no segment of any item agrees, so
nearly all positions take a step or two.

A pair at the largest distance keeps a given word with chance 3/4; with a repetition's other steps agreeing
in about a third of the walks, REPETITIONS of them find a segment in 0.75 * (1 - 0.65**6) = 0.69 of the cases, and
an item of EXACT_WORDS or more has four segments or more: recall 0.99 at the limit, nearly 1 below.  Shorter items are
not sampled but found exactly: cut into one piece more than edits are allowed, an item keeps a piece whole, so every
window around a whole piece is a candidate.  Candidates are verified by the exact edit distance between the item and
the best-aligned window, with a bit-parallel column per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, table, tidy
from .maxent import WordTable
from .words import U, Chunk, chunks, mix

EDIT_SHARE = (1, 4)  # at most a quarter of the item's words
EXACT_WORDS = 16  # items of fewer words are found by whole pieces
STEPS = 16
SAMPLED = 3
REPETITIONS = 6
STRIDE, LEAST_SEGMENT = 3, 6
BLOCK_WORDS = 2_000_000  # of items searched for at once
_SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words_of(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and for each text the index of its first."""
    start, end, first = c.words(_SEPARATOR)
    h = c.span_hash(start, end)
    return np.where(h == 0, U(1), h), first


def item_words(texts: list[str | None]) -> list[np.ndarray]:
    found = []
    for c in chunks(pa.array(texts, pa.string())):
        h, first = words_of(c)
        found += [h[first[k] : first[k + 1]] for k in range(c.n)]
    return found


def _runs(own: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` word numbers."""
    n = len(own) - length + 1
    key = np.zeros(max(n, 0), np.uint64)
    for k in range(length):
        key = mix(key * U(0xC2B2AE3D27D4EB4F) + own[k : n + k].astype(np.uint64) + U(1))
    return key


class Sampler:
    """The sampled strings of all segments of the items, over numbers of the items' words; any other word is 0."""

    def __init__(self, items: list[np.ndarray], seed: int = 8):
        random = np.random.default_rng(seed)
        self.items = items
        self.vocabulary = np.unique(np.concatenate(items)) if items else np.zeros(0, np.uint64)
        self.base = len(self.vocabulary) + 1
        self.numbered = numbered = [np.searchsorted(self.vocabulary, w) + 1 for w in items]
        segments = [(i, o) for i, w in enumerate(items) if len(w) >= EXACT_WORDS for o in range(0, len(w) - LEAST_SEGMENT + 1, STRIDE)]
        self.pieces = self._pieces()
        self.plans = []
        for _ in range(REPETITIONS):
            steps = np.sort(np.r_[0, 1 + random.choice(STEPS - 1, SAMPLED - 1, replace=False)]).tolist()
            moves = random.integers(0, 2, (STEPS, self.base), dtype=np.int8)
            owners: dict[int, list[tuple[int, int]]] = {}
            pairs, starts = [], np.zeros(self.base, bool)
            for i, o in segments:
                w, p, keys = numbered[i], o, []
                for t in range(steps[-1] + 1):
                    if p >= len(w):
                        break
                    if t in steps:
                        keys.append((keys[-1] if keys else 0) * self.base + int(w[p]))
                    p += int(moves[t, w[p]])
                if len(keys) == SAMPLED:
                    starts[keys[0]] = True
                    pairs.append(keys[1])
                    owners.setdefault(keys[-1], []).append((i, o))
            last = sorted(owners)
            listed = np.array([own for k in last for own in owners[k]], np.int64).reshape(-1, 2)
            first = np.cumsum([0] + [len(owners[k]) for k in last])
            self.plans.append((steps, moves, starts, self._marks(np.array(pairs, np.int64)), np.array(last, np.int64), first, listed[:, 0], listed[:, 1]))

    def _pieces(self) -> list[tuple]:
        """(length, first words, keys, where each key's begin, items, offsets) of the pieces of the short items, by length."""
        owners: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for i, w in enumerate(self.numbered):
            if 0 < len(w) < EXACT_WORDS:
                parts = limit_of(len(w)) + 1
                cuts = [len(w) * k // parts for k in range(parts + 1)]
                for low, high in zip(cuts, cuts[1:]):
                    key = int(_runs(w[low:high].astype(np.int64), high - low)[0])
                    owners.setdefault(high - low, {}).setdefault(key, []).append((i, low))
        made = []
        for length, own in sorted(owners.items()):
            keys = sorted(own)
            listed = np.array([x for k in keys for x in own[k]], np.int64).reshape(-1, 2)
            starts = np.zeros(self.base, bool)
            starts[[self.numbered[i][o] for i, o in listed.tolist()]] = True
            made.append((length, starts, np.array(keys, np.uint64), np.cumsum([0] + [len(own[k]) for k in keys]), listed[:, 0], listed[:, 1]))
        return made

    def whole_pieces(self, own: np.ndarray, text_end: np.ndarray) -> tuple[np.ndarray, ...]:
        """(item, start of its window, word of the piece) of every piece of a short item that stands in a text."""
        found = [(np.zeros(0, np.int64),) * 3]
        for length, starts, keys, first, item, offset in self.pieces:
            at = np.flatnonzero(starts[own])
            at = at[at + length <= text_end[at]]
            key = _runs(own, length)[at] if len(at) else np.zeros(0, np.uint64)
            k = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            at, k = at[keys[k] == key], k[keys[k] == key]
            per = first[k + 1] - first[k]
            entry = np.repeat(first[k], per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
            found.append((item[entry], np.repeat(at, per) - offset[entry], np.repeat(at, per)))
        items, windows, at = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(items, kind="stable")
        return items[order], windows[order], at[order]

    @staticmethod
    def _place(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * U(0x9E3779B97F4A7C15)) >> U(42)).astype(np.int64)

    @classmethod
    def _marks(cls, keys: np.ndarray) -> np.ndarray:
        marks = np.zeros(1 << 22, bool)
        marks[cls._place(keys)] = True
        return marks

    def candidates(self, own: np.ndarray, text_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (item, start of its window) over word numbers `own`; `text_end[k]`: where the text of word k ends."""
        items, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        n = len(own)
        own = np.r_[own, np.zeros(STEPS, np.int64)]
        for steps, moves, starts, marks, last, first, item, offset in self.plans:
            at = np.flatnonzero(starts[own[:n]])
            p, key = at, np.zeros(len(at), np.int64)
            for t in range(steps[-1] + 1):
                word = own[p]
                if t in steps:
                    key = key * self.base + word
                    if t == steps[-1]:
                        live = np.isin(key, last)
                    elif t > 0:
                        live = marks[self._place(key)]
                    else:
                        live = None
                    if live is not None:
                        live &= (word > 0) & (p < text_end[at])
                        at, p, key, word = at[live], p[live], key[live], word[live]
                p = p + moves[t].take(word)
            k = np.searchsorted(last, key)
            per = first[k + 1] - first[k]
            entry = np.repeat(first[k], per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
            items.append(item[entry])
            windows.append(np.repeat(at, per) - offset[entry])
        # A window may begin before the first word, by fewer words than an item has.
        both = np.unique((np.concatenate(items) << 40) + np.concatenate(windows) + (1 << 32))
        return both >> 40, (both & ((1 << 40) - 1)) - (1 << 32)


def best_alignment(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """(distance, end): the least edit distance of the item to any part of the window, and where that part ends."""
    m = len(item)
    masks: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | (1 << k)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = (m, 0)
    for end, w in enumerate(window.tolist(), 1):
        eq = masks.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | (~(xh | plus) & full), plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        plus, minus = mh | (~(xv | ph) & full), ph & xv
        if score < best[0]:
            best = (score, end)
    return best


def limit_of(n_words: int) -> int:
    return n_words * EDIT_SHARE[0] // EDIT_SHARE[1]


def _search(sampler: Sampler, item_ids: list[int]):
    """(row, item, distance, end word) of every verified match in a text column."""
    table = WordTable(sampler.vocabulary)
    sizes = np.array([len(w) for w in sampler.items])

    def plausible(own: np.ndarray, i: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Windows that hold enough of the item's distinct words: an edit loses one of them at most."""
        distinct = np.unique(sampler.numbered[i])[:64]
        bit = np.zeros(sampler.base, np.uint64)
        bit[distinct] = U(1) << np.arange(len(distinct), dtype=np.uint64)
        at = low[:, None] + np.arange(int((high - low).max(initial=0)))
        held = bit[own[np.minimum(at, len(own) - 1)]]
        held[at >= high[:, None]] = 0
        return np.bitwise_count(np.bitwise_or.reduce(held, axis=1)) >= len(distinct) - limit_of(int(sizes[i]))

    def search(column):
        for c in chunks(column):
            h, first = words_of(c)
            if not len(h) or not len(sizes):
                continue
            own = table.of(h) + 1
            text = np.repeat(np.arange(c.n), np.diff(first))
            items, starts = sampler.candidates(own, first[1:][text])
            best: dict[tuple[int, int], tuple[int, int]] = {}
            cuts = np.searchsorted(items, np.arange(len(sizes) + 1))
            short, short_starts, anchors = sampler.whole_pieces(own, first[1:][text])
            short_cuts = np.searchsorted(short, np.arange(len(sizes) + 1))
            for i in np.flatnonzero(np.diff(cuts) + np.diff(short_cuts)).tolist():
                item, slack = sampler.items[i], limit_of(int(sizes[i]))
                if sizes[i] < EXACT_WORDS:
                    own_rows = slice(short_cuts[i], short_cuts[i + 1])
                    k, start = text[anchors[own_rows]], short_starts[own_rows]
                else:
                    start = starts[cuts[i] : cuts[i + 1]]
                    # Edits move a window's ends, so either end may lie in a neighbouring text.
                    ends = np.clip(np.concatenate([start, start + sizes[i] - 1]), 0, len(h) - 1)
                    k, start = text[ends], np.concatenate([start, start])
                low, high = np.maximum(first[k], start - slack), np.minimum(first[k + 1], start + sizes[i] + slack)
                enough = high - low >= sizes[i] - slack
                k, low, high = k[enough], low[enough], high[enough]
                enough = plausible(own, i, low, high)
                for k, low, high in sorted(set(zip(k[enough].tolist(), low[enough].tolist(), high[enough].tolist()))):
                    if best.get((k, i), (1, 0))[0] == 0:
                        continue
                    distance, end = best_alignment(item, h[low:high])
                    if distance <= slack and distance < best.get((k, i), (slack + 1, 0))[0]:
                        best[k, i] = distance, low + end - int(first[k])
            for (k, i), (distance, end) in best.items():
                yield c.first + k, item_ids[i], distance, end

    return search


def find_items(docs: DataFrame, items: list[tuple[int, str | None]]) -> DataFrame:
    """(doc_id, row_hash, item_id, distance, end_word) for every document and item found in it; one block of items."""
    ids, texts = [i for i, _ in items], [t for _, t in items]
    own = [(i, w) for i, w in zip(ids, item_words(texts)) if len(w)]
    sampler = docs.sparkSession.sparkContext.broadcast((Sampler([w for _, w in own]), [i for i, _ in own]))

    def match(batches):
        search = _search(*sampler.value)
        for batch in batches:
            rows = list(search(batch.column(1)))
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(2).take(at), *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3))],
                ["doc_id", "row_hash", "item_id", "distance", "end_word"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("row_hash"))
    return texts.mapInArrow(tidy(match), "doc_id long, row_hash long, item_id long, distance long, end_word long")


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Matches of all items.  Items are searched for in blocks of about `block_words` words, which bound what is broadcast."""
    size = F.greatest(F.size(F.split(F.coalesce("text", F.lit("")), r"\s+")), F.lit(1))
    total = benchmark.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = None
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        rows = [(r[0], r[1]) for r in part.orderBy("item_id", "text").collect()]
        own = find_items(docs, rows)
        found = own if found is None else found.union(own)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` with item_ids (sorted), n_items, best_distance and contaminated.

    A document is contaminated if an item of `benchmark` (item_id, text) lies within an edit distance of a quarter of
    its words (rounded down) to some part of the text.  A null or empty text matches nothing, nor does an item
    without words; an item of fewer than 4 words has to stand there unchanged; items that repeat are each reported; a null doc_id is judged by its text; repeated
    rows are judged alike; very long texts are read whole; empty tables match nothing.  Columns of `docs` that
    clash with a result's are replaced.
    """
    names = ["item_ids", "n_items", "best_distance", "contaminated"]
    docs = docs.drop(*names)
    matches = materialise(benchmark_matches(docs, benchmark), "matches")
    found = matches.groupBy("row_hash").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.min("distance").alias("best_distance"))
    hashed = docs.withColumn("row_hash_", F.xxhash64("doc_id", "text"))
    return (
        hashed.join(found.withColumnRenamed("row_hash", "row_hash_"), "row_hash_", "left")
        .drop("row_hash_")
        .select(
            *docs.columns,
            F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            "best_distance",
            F.col("item_ids").isNotNull().alias("contaminated"),
        )
    )


def op8_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "contaminated", "n_items", F.array_join("item_ids", ",").alias("items"), "best_distance")
