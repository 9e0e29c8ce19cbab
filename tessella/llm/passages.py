"""Removal of repeated passages by longest previous factors in suffix order (operator 9).

A byte goes if a string of WIDTH bytes that covers it also starts earlier, in a smaller doc_id or earlier in the
same document; the first copy stays.  Which starts those are is what a longest-previous-factor array says: a
suffix whose longest match with an earlier suffix reaches WIDTH.

No suffix array spans the corpus.  Every WIDTH-byte string picks the least of its GRAM-byte grams as its anchor,
so equal strings have equal anchors.  Anchors that occur once can't lie in a repeat; they are counted first, by
hash, with a combining aggregate; documents that copy a whole earlier one are set aside before.  The spans around the others (all WIDTH-byte strings that share one anchor) are
grouped by content before they meet by anchor, so thousands of copies of one passage arrive as one row with
its first place; two hashes name the content, one of them not a polynomial.  Under each anchor with several different
spans, the suffixes that can start a match are put in suffix order.  The nearest suffixes on either side that start
earlier, the previous and the next smaller positions, hold a suffix's longest match with any earlier one: the least
common prefix on the way there.  That array of longest previous factors tells what to remove.  Copies of a span other
than its first go whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, table, tidy
from .idfilter import bitmap, bits_for, held, maybe_in, slot, without
from .words import U, Chunk, chunks

WIDTH = 100
GRAM = 24
SPAN = ["gram", "span_hash", "span_check"]  # what names a span's anchor and content
SLICE_BYTES = 1 << 18
JUDGED_SPANS = 2000  # brought into suffix order together, and those of their last gram
_GRAMS = WIDTH - GRAM + 1
_BLOCK_BITS = 21
_BLOCK = (1 << _BLOCK_BITS) - _GRAMS


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size, least = 1, x
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return np.minimum(least[: len(x) - width + 1], least[width - size : width - size + len(x) - width + 1])


def anchors(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, first start, last start) of each run of WIDTH-byte strings of one text that share an anchor."""
    n = len(c.data) - WIDTH + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = c.windows(GRAM)
    valid = np.zeros(len(c.data) + 1, np.int64)
    long = np.diff(c.at) >= WIDTH
    np.add.at(valid, c.at[:-1][long], 1)
    np.add.at(valid, c.at[1:][long] - WIDTH + 1, -1)
    valid = np.cumsum(valid)[:n] > 0
    anchor = np.empty(n, np.int64)
    low = U((1 << _BLOCK_BITS) - 1)
    for b in range(0, n, _BLOCK):
        part = grams[b : min(b + _BLOCK, n) + _GRAMS - 1]
        marked = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        least = _sliding_least(marked, _GRAMS)
        anchor[b : b + len(least)] = (least & low).astype(np.int64) + b
    starts = np.flatnonzero(valid)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    own = anchor[starts]
    head = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)])
    tail = np.r_[head[1:] - 1, len(starts) - 1]
    return grams[own[head]], starts[head], starts[tail]


def _gram_hashes(batches):
    for batch in batches:
        found = [anchors(c)[0] for c in chunks(batch.column(0), fold=False, size=SLICE_BYTES)]
        gram, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], ["gram", "n"])


def _spans(found):
    """Rows (gram, span_hash, doc_id, row_hash, start, span) of the anchors that may be repeated."""

    def spans(batches):
        repeated = found.value
        for batch in batches:
            ids, rows = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            for c in chunks(batch.column(1), fold=False, size=SLICE_BYTES):
                gram, first, last = anchors(c)
                may = held(repeated, gram.view(np.int64))
                gram, first, last = gram[may], first[may], last[may]
                text = np.searchsorted(c.at, first, side="right") - 1
                raw = c.data.tobytes()
                whole = [raw[a:b] for a, b in zip(first.tolist(), (last + WIDTH).tolist())]
                columns = (gram.view(np.int64), c.span_hash(first, last + WIDTH).view(np.int64), ids[c.first + text], rows[c.first + text], first - c.at[text])
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in columns), pa.array(whole, pa.binary())],
                    ["gram", "span_hash", "doc_id", "row_hash", "start", "span"],
                )

    return spans


def _common_prefixes(keys: list[np.ndarray], width: int) -> np.ndarray:
    """How many of their first `width` bytes each suffix has in common with the one before it; the first has none."""
    n = len(keys[0])
    common, open_ = np.zeros(n, np.int64), np.arange(1, n)
    for k, key in enumerate(keys):
        at = min(8 * k, width - 8)
        differ = key[open_] ^ key[open_ - 1]
        same = differ == 0
        ended, x = open_[~same], differ[~same]
        # Bytes of a word are in order from its highest.
        common[ended] = at + sum((x >> U(56 - 8 * b) == 0).astype(np.int64) for b in range(8))
        open_ = open_[same]
    common[open_] = width
    return common


def _nearest_earlier(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each suffix the prefix it shares with the nearest one before it in the order that starts earlier, 0 without any.

    Links pass over suffixes that start later, each by the link of the one it points at, so paths halve in every round.
    """
    link, least = np.arange(len(place)) - 1, common.copy()
    late = np.flatnonzero(link >= 0)
    late = late[place[link[late]] > place[late]]
    while len(late):
        to = link[late]
        new, shared = link[to], np.minimum(least[late], least[to])
        link[late], least[late] = new, shared
        late = late[(new >= 0) & (shared > 0)]
        late = late[place[link[late]] > place[late]]
    least[link < 0] = 0
    return least


def previous_factors(spans: list[bytes], group: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The longest previous factor, up to `width`, of every start of the spans at which `width` bytes remain, in order:
    how much of the text from there also starts earlier in the group.
    """
    size = np.array([len(s) for s in spans], np.int64)
    data = np.frombuffer(b"".join(spans) + bytes(8), np.uint8)
    begin = np.concatenate([[0], np.cumsum(size)])[:-1]
    count = size - width + 1
    start = np.repeat(begin - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(count.sum())
    words = np.zeros(len(data) - 7, np.uint64)
    for k in range(8):
        words = (words << U(8)) | data[k : len(data) - 7 + k]
    keys = [words[start + k] for k in range(0, width - 7, 8)]
    if width % 8:
        keys.append(words[start + width - 8])
    owner = np.repeat(group, count)
    order = np.lexsort([np.arange(len(start)), *keys[::-1], owner])
    common = _common_prefixes([key[order] for key in keys], width) if len(order) else np.zeros(0, np.int64)
    common[1:][owner[order][1:] != owner[order][:-1]] = 0
    before = _nearest_earlier(order, common)
    # The same from the other end: there a suffix follows the one that it preceded.
    after = _nearest_earlier(order[::-1], np.r_[0, common[:0:-1]][: len(order)])[::-1]
    factors = np.empty(len(start), np.int64)
    factors[order] = np.maximum(before, after)
    return factors


def _runs(marked: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.r_[0, marked.astype(np.int8), 0])
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def _repeats(batches):
    """Of spans sorted by gram and first place: which starts of each also start in an earlier span of its gram, as runs.

    A span without such a start has no row.
    """
    kept: list[pa.RecordBatch] = []

    def judge(rows: pa.Table):
        gram = rows.column("gram").to_numpy()
        several = np.r_[False, gram[1:] == gram[:-1]] | np.r_[gram[1:] == gram[:-1], False]
        at, runs = np.flatnonzero(several), []
        if len(at):
            spans = [x.as_py() for x in rows.column("span").take(pa.array(at))]
            earlier = previous_factors(spans, gram[at]) >= WIDTH
            cut = np.concatenate([[0], np.cumsum([len(s) - WIDTH + 1 for s in spans])])
            total = np.concatenate([[0], np.cumsum(earlier)])
            some = np.flatnonzero(total[cut[1:]] > total[cut[:-1]])
            runs = [[{"from": a, "to": b} for a, b in _runs(earlier[cut[k] : cut[k + 1]])] for k in some]
            at = at[some]
        own = rows.take(pa.array(at))
        return pa.RecordBatch.from_arrays(
            [*(own.column(k).combine_chunks() for k in SPAN), pa.array(runs, pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))],
            [*SPAN, "runs"],
        )

    for batch in (whole.slice(k, JUDGED_SPANS) for whole in batches for k in range(0, whole.num_rows, JUDGED_SPANS)):
        gram = batch.column(0).to_numpy()
        cut = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on in the next batch
        if cut:
            yield judge(pa.Table.from_batches([*kept, batch.slice(0, cut)]))
            kept = []
        elif kept and kept[-1].column(0)[-1].as_py() != gram[0]:
            yield judge(pa.Table.from_batches(kept))
            kept = []
        kept.append(batch.slice(cut))
    if kept:
        yield judge(pa.Table.from_batches(kept))


def copied_rows(rows: DataFrame) -> DataFrame:
    """(key, doc_id, size) of the rows whose whole text stands in a smaller doc_id: every byte of theirs goes."""
    small = rows.select("doc_id", "row_hash", F.octet_length("text").alias("size"), F.xxhash64("text").alias("h"), F.crc32("text").alias("c"))
    # As tables, neither side of the join is dealt by its key yet, so a text with very many copies can be split.
    firsts = materialise(small.groupBy("h", "c", "size").agg(F.min("doc_id").alias("first_doc"), F.count("*").alias("n")).where("n > 1"), "first-copies")
    later = small.join(firsts, ["h", "c", "size"]).where("doc_id > first_doc")
    return later.select(F.col("row_hash").alias("key"), "doc_id", "size").distinct()


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, row_hash, cuts): the byte ranges to remove from each of the rows (doc_id, text, row_hash) that has any."""
    spark = rows.sparkSession
    copies = materialise(copied_rows(rows), "copies")
    docs = materialise(without(rows, F.col("row_hash"), copies, "doc_id"), "distinct-texts")
    counted = docs.select("text").mapInArrow(tidy(_gram_hashes), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram")
    counted = materialise(counted, "repeated-grams")
    bits = bits_for(counted.count())
    found = spark.sparkContext.broadcast(bitmap(counted.select(slot(F.col("gram"), bits=bits).alias("slot")), bits))
    spans = materialise(
        docs.mapInArrow(tidy(_spans(found)), "gram long, span_hash long, doc_id long, row_hash long, start long, span binary").withColumns(
            {"size": F.octet_length("span"), "span_check": F.xxhash64("span")}
        ),
        "spans",
    )
    found.destroy()
    # Only grams with different spans need their bytes compared.
    discard(docs, counted)
    # Least and greatest of numbers are kept in a hash table; those of structs would sort every span.
    ends = [f(c).alias(f"{name}_{c}") for c in SPAN[1:] for f, name in ((F.min, "least"), (F.max, "most"))]
    mixed = spans.groupBy("gram").agg(*ends).where(" or ".join(f"least_{c} != most_{c}" for c in SPAN[1:]))
    several = materialise(mixed.select("gram"), "mixed-grams")
    bits = bits_for(several.count())
    at = slot(F.col("gram"), bits=bits)
    compared = spans.select(*SPAN, "doc_id", "start", "span").where(maybe_in(spark, at, several.select(at.alias("slot")), bits))
    distinct = compared.groupBy(*SPAN).agg(F.min(F.struct("doc_id", "start", "span")).alias("it")).select(*SPAN, "it.*")
    ordered = distinct.repartition("gram").sortWithinPartitions("gram", "doc_id", "start")
    judged = materialise(ordered.mapInArrow(tidy(_repeats), "gram long, span_hash long, span_check long, runs array<struct<from:long,to:long>>"), "repeats")
    places = spans.select(*SPAN, "doc_id", "row_hash", "start", "size")
    firsts = materialise(places.groupBy(*SPAN).agg(F.min(F.struct("doc_id", "start")).alias("first")).join(judged, SPAN, "left"), "first-spans")
    is_first = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("start") == F.col("first.start"))
    kinds = "array<struct<from:long,to:long>>"
    cuts = (
        places.join(firsts, SPAN)
        .select(
            "doc_id",
            "row_hash",
            F.when(is_first, F.transform("runs", lambda r: F.struct((F.col("start") + r["from"]).alias("from"), (F.col("start") + r["to"] + WIDTH - 1).alias("to"))))
            .otherwise(F.array(F.struct(F.col("start").alias("from"), (F.col("start") + F.col("size")).alias("to"))))
            .cast(kinds)
            .alias("own"),
        )
        .where(F.size("own") > 0)
        .groupBy("doc_id", "row_hash")
        .agg(F.flatten(F.collect_list("own")).alias("cuts"))
    )
    whole = copies.select("doc_id", F.col("key").alias("row_hash"), F.array(F.struct(F.lit(0).cast("long").alias("from"), F.col("size").cast("long").alias("to"))).alias("cuts"))
    cuts = materialise(cuts.union(whole), "cuts")
    discard(spans, judged, firsts, several)
    return cuts


def merged(cuts: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((c["from"], c["to"]) for c in cuts):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _apply(batches):
    for batch in batches:
        kept, sizes, gone, spans = [], [], [], []
        for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw, at, parts = (text or "").encode(), 0, []
            removed = merged(cuts)
            for a, b in removed:
                parts.append(raw[at:a])
                at = b
            parts.append(raw[at:])
            kept.append(b"".join(parts))
            sizes.append(len(raw))
            gone.append(sum(b - a for a, b in removed))
            spans.append(len(removed))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_bytes, n_removed, n_spans and kept, the remaining bytes.

    kept is binary, since a cut may fall within a character.  A null or empty text has no bytes; a text of fewer
    than 100 bytes is left whole, as is a row without doc_id; rows that repeat a doc_id are one document, of which
    only an earlier start counts as earlier; very long texts are read whole, in blocks; an empty table gives
    an empty one; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row_hash", F.xxhash64("doc_id", "text"))
    cuts = repeated_spans(rows.where("doc_id is not null and octet_length(text) >= 100"))
    bits = bits_for(cuts.count())
    maybe = maybe_in(spark, slot(F.col("row_hash"), bits=bits), cuts.select(slot(F.col("row_hash"), bits=bits).alias("slot")), bits)
    raw = F.coalesce("text", F.lit("")).cast("binary")
    whole = rows.where(~maybe).select(
        "doc_id", F.length(raw).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), raw.alias("kept")
    )
    touched = rows.where(maybe).join(cuts, ["doc_id", "row_hash"], "left").select(
        "doc_id", "text", F.coalesce("cuts", F.array().cast("array<struct<from:long,to:long>>")).alias("cuts")
    )
    return whole.union(touched.mapInArrow(tidy(_apply), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


def op9_suffix_dedup(spark, sf_dir):
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
