"""Near-duplicate groups by an LSH forest over MinHash signatures (operator 2).

A document is the set of its distinct five-word shingles.  Documents with equal sets are one class from the
start.  Every class gets TREES x DEPTH minimum hashes; each tree lays the classes out in the order of its DEPTH
values, and classes that stand near each other and share at least MIN_DEPTH leading values are candidates.  How
deep neighbours agree adapts by itself: in a crowded region the nearest rows in the order are those with the
longest common prefix, in a sparse one those that share MIN_DEPTH values are enough.

Orders are made by a range partitioning on the whole signature, so a region of any size is spread over as many
tasks as its rows need, and a task keeps only the last `window` rows.  Candidates are never all pairs of a
region: first each class is held against its closest neighbours, links confirmed on the full sets join classes
into components, then against the closest of other components, and then only neighbours that are still in
different components are held against each other.

A window holds WINDOW rows, so where more share MIN_DEPTH values it may miss links, and so may the edge between two
tasks' rows.  Rows that share MIN_DEPTH values with one outside their window or their task are crowded: those of
different components are then joined exactly, whatever the size of the region.  Shingles are put in order, rarest among the crowded first; two sets that reach the threshold share one of their first few (the
prefix filter), have near sizes and enough shingles left after it (the positional filter).  What a template's copies
have in common comes last in that order, so texts just under the threshold to each other make few candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import sketch
from .common import connected_components, discard, materialise, table, tidy
from .idfilter import bits_for, maybe_in, slot
from .sets import BITS, pair_overlaps
from .sketch import rarity_levels
from .words import U, chunks, mix, shingles, word_hashes

TREES, DEPTH, MIN_DEPTH = 24, 5, 2
SHINGLE = 5
PERCENT = 75
WINDOW = 48
CLOSEST = 2
#: Two bits of each of so many minimum hashes, the trees' among them, estimate a pair's similarity.  A pair at the
#: threshold agrees in 0.8125 of them on average, with a deviation of 0.025; where less than SKETCH_AGREE agree, 4.5
#: deviations below, the full sets aren't compared.
SKETCH = 240
SKETCH_BYTES = SKETCH // 4
SKETCH_AGREE = 0.70
_MULTIPLIERS = mix(np.arange(1, SKETCH + 1, dtype=np.uint64) * U(0xA0761D6478BD642F)) | U(1)
_POPULATION = np.array([bin(k).count("1") for k in range(256)], np.uint8)


def _signatures(batches):
    for batch in batches:
        rows = []
        for c in chunks(batch.column(1)):
            value, first = shingles(*word_hashes(c), SHINGLE)
            count = np.diff(first)
            full = np.flatnonzero(count)
            sums = np.zeros((2, c.n), np.uint64)
            low = np.zeros((c.n, SKETCH), ">u4")
            if len(full):
                at = first[:-1][full]
                sums[0, full] = np.add.reduceat(value, at)
                sums[1, full] = np.add.reduceat(mix(value ^ U(0x5851F42D4C957F2D)), at)
                for k, m in enumerate(_MULTIPLIERS):
                    low[full, k] = np.minimum.reduceat(value * m, at) >> U(32)
            two = np.unpackbits(((mix(low.astype(np.uint64)) & U(3)).astype(np.uint8) << 6)[..., None], axis=2, count=2)
            rows.append((count, sums, np.ascontiguousarray(low[:, : TREES * DEPTH]), np.packbits(two.reshape(c.n, -1), axis=1)))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.concatenate([r[0] for r in rows]), pa.int64()),
                    *(pa.array(np.concatenate([r[1][k] for r in rows]).view(np.int64)) for k in range(2)),
                    *(pa.array([x.tobytes() for r in rows for x in r[k]], pa.binary()) for k in (2, 3)),
                ],
                ["row_id", "n_shingles", "set_a", "set_b", "signature", "sketch"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """(row_id, n_shingles, set_a, set_b, signature, sketch) of (row_id, text); set_a and set_b identify the set."""
    schema = "row_id long, n_shingles long, set_a long, set_b long, signature binary, sketch binary"
    return docs.select("row_id", "text").mapInArrow(tidy(_signatures), schema)


def _explode_trees(batches):
    """A row per tree: its number and values as one sortable key, then the id, size, component and sketch."""
    for batch in batches:
        node, size, component = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        low = np.stack([np.frombuffer(x.as_buffer(), ">u4") for x in batch.column(3)]) if batch.num_rows else np.zeros((0, TREES * DEPTH), ">u4")
        for tree in range(TREES):
            own = np.ascontiguousarray(low[:, tree * DEPTH : (tree + 1) * DEPTH])
            keys = [bytes([tree]) + x.tobytes() for x in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(node), pa.array(size), pa.array(component), batch.column(4)],
                ["key", "node", "size", "component", "sketch"],
            )


def _neighbours(lags: int, apart: bool, nearest: bool):
    """Candidate pairs among rows in key order: within `lags` rows, MIN_DEPTH leading values shared, sizes and sketches near.

    With `apart`, only pairs of different components; with `nearest`, only the first such of each row.  A row that
    shares MIN_DEPTH values with one out of reach, further away or in another task, is paired with itself.
    """
    width = 1 + 4 * DEPTH

    def near(batches):
        kept, opening = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width)
            sketch = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, SKETCH_BYTES)
            node, size, component = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
            fresh = 0
            if kept is not None:
                fresh = len(kept[0])
                key, sketch, node, size, component = (np.concatenate(x) for x in zip(kept, (key, sketch, node, size, component)))
            prefix = np.ascontiguousarray(key[:, : 1 + 4 * MIN_DEPTH]).view(f"V{1 + 4 * MIN_DEPTH}").ravel()
            out, done = [], np.zeros(len(node), bool)
            if opening is None:
                opening = prefix[0]
            crowded = [node[fresh:][prefix[fresh:] == opening]]
            for lag in range(1, min(lags, len(node) - 1) + 1):
                later = np.arange(max(lag, fresh), len(node))
                later = later[prefix[later] == prefix[later - lag]]
                if not len(later):
                    break  # equal prefixes stand together: none this far apart, none further
                a, b = later - lag, later
                if lag == lags:
                    crowded += [node[a], node[b]]
                fits = node[a] != node[b]
                fits &= 100 * np.minimum(size[a], size[b]) >= PERCENT * np.maximum(size[a], size[b])
                if apart:
                    fits &= component[a] != component[b]
                a, b = a[fits], b[fits]
                differ = sketch[a] ^ sketch[b]
                differ = _POPULATION[(differ | (differ >> 1)) & 0x55].sum(1)
                same = 1 - differ / (4 * SKETCH_BYTES)
                close = same >= SKETCH_AGREE
                if nearest:
                    close &= ~done[b]
                    done[b[close]] = True
                out.append((node[a[close]], node[b[close]], same[close]))
            kept, closing = [x[-lags:].copy() for x in (key, sketch, node, size, component)], (prefix[-lags:] == prefix[-1]).copy()
            alone = np.unique(np.concatenate(crowded))
            out.append((alone, alone, np.ones(len(alone))))
            yield listed(out)
        if kept is not None:
            alone = kept[2][closing]
            yield listed([(alone, alone, np.ones(len(alone)))])

    def listed(out):
        a, b, same = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(same)], ["a", "b", "same"])

    return near


def _candidates(classes: DataFrame, lags: int, apart: bool, nearest: bool = False) -> DataFrame:
    rows = classes.select("node", "n_shingles", "component", "signature", "sketch").mapInArrow(tidy(_explode_trees), "key binary, node long, size long, component long, sketch binary"
    )
    ordered = rows.repartitionByRange("key", "node").sortWithinPartitions("key", "node")
    return ordered.mapInArrow(tidy(_neighbours(lags, apart, nearest)), "a long, b long, same double").groupBy("a", "b").agg(F.max("same").alias("same"))


def _sets(batches):
    for batch in batches:
        made = []
        for c in chunks(batch.column(1)):
            value, first = shingles(*word_hashes(c), SHINGLE)
            value, cuts = value >> U(64 - BITS), first.tolist()
            made += [value[x:y].tobytes() for x, y in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["row_id", "members"])


def _confirm(batches):
    for batch in batches:
        for first, last, m, n, shared in pair_overlaps(batch.column(2), batch.column(3)):
            union = m + n - shared
            linked = pa.array((100 * shared >= PERCENT * union) & (union > 0))
            yield pa.RecordBatch.from_arrays([batch.column(k)[first:last].filter(linked) for k in (0, 1)], ["src", "dst"])


def _texts_of(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of `texts` whose row_id is in the table `wanted`, and few others, found before anything is shuffled.
    The joins that follow are exact."""
    bits = bits_for(wanted.count())
    maybe = maybe_in(texts.sparkSession, slot(F.col("row_id"), bits=bits), wanted.select(slot(F.col("row_id"), bits=bits).alias("slot")), bits)
    return texts.where("row_id is not null").where(maybe)


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold.  Only sets of paired classes are shuffled."""
    wanted = materialise(pairs.select(F.col("a").alias("row_id")).union(pairs.select("b")).distinct(), "paired")
    some = materialise(_texts_of(wanted, texts).mapInArrow(tidy(_sets), "row_id long, members binary"), "pair-sets")
    left = some.select(F.col("row_id").alias("a"), F.col("members").alias("members_a"))
    right = some.select(F.col("row_id").alias("b"), F.col("members").alias("members_b"))
    links = pairs.join(left, "a").join(right, "b").select("a", "b", "members_a", "members_b").mapInArrow(tidy(_confirm), "src long, dst long")
    links = materialise(links, "links")
    discard(some, wanted)
    return links


def _closest(pairs: DataFrame) -> DataFrame:
    """The CLOSEST pairs of each class."""
    either = pairs.select(F.col("a").alias("x"), "a", "b", "same").union(pairs.select(F.col("b").alias("x"), "a", "b", "same"))
    best = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("same"), "a", "b"))
    return either.withColumn("place", best).where(F.col("place") <= CLOSEST).select("a", "b").distinct()


def _prefixes(rarity):
    """The first shingles of each set (node, component, text), rarest first: as many as a partner at the threshold cannot all lack."""

    def rows(batches):
        levels = rarity.value
        for batch in batches:
            node, component = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for c in chunks(batch.column(2)):
                value, first = shingles(*word_hashes(c), SHINGLE)
                size = np.diff(first)
                text = np.repeat(np.arange(c.n), size)
                level = levels[(value & U(sketch.SLOTS - 1)).astype(np.int64)]
                order = np.lexsort((value, level, text))
                value, level = value[order], level[order]
                rank, sizes = np.arange(len(value)) - first[text], size[text]
                posted = np.flatnonzero((rank < sizes - -(-PERCENT * sizes // 100) + 1) & (level > 0))
                of = c.first + text[posted]
                columns = [value[posted].view(np.int64), node[of], component[of], sizes[posted], rank[posted]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["shingle", "node", "component", "size", "rank"])

    return rows


def _crowded_pairs(crowded: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Every pair (a, b) of `crowded` classes (node) of different components that the exact filters let through."""
    spark = classes.sparkSession
    own = materialise(classes.select(F.col("node").alias("row_id"), "component").distinct().join(crowded.select(F.col("node").alias("row_id")), "row_id", "left_semi"), "crowded")
    some = materialise(_texts_of(own.select("row_id"), texts).join(own, "row_id").select("row_id", "component", "text"), "crowded-texts")
    rarity = spark.sparkContext.broadcast(rarity_levels(some, lambda c: shingles(*word_hashes(c), SHINGLE)[0])[0])
    schema = "shingle long, node long, component long, size long, rank long"
    posting = all_postings = materialise(some.mapInArrow(tidy(_prefixes(rarity)), schema), "crowded-postings")
    rarity.destroy()
    # Most shingles that many rows post are of one component, so nothing of theirs is left to join.
    mixed = materialise(posting.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("shingle"), "mixed")
    bits = bits_for(mixed.count())
    at = slot(F.col("shingle"), bits=bits)
    posting = posting.where(maybe_in(spark, at, mixed.select(at.alias("slot")), bits))
    x, y = posting.alias("x"), posting.alias("y")
    need = f"ceil({PERCENT} * (x.size + y.size) / (100 + {PERCENT}))"
    found = x.join(
        y,
        (F.col("x.shingle") == F.col("y.shingle"))
        & F.expr("x.node < y.node and x.component != y.component")
        & F.expr(f"100 * least(x.size, y.size) >= {PERCENT} * greatest(x.size, y.size)")
        & F.expr(f"least(x.size - x.rank, y.size - y.rank) >= {need}"),
    )
    pairs = materialise(found.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), "pairs")
    discard(some, own, all_postings, mixed)
    return pairs


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_shingles, component_id and kept.

    Links join documents whose shingle sets satisfy 100 * intersection >= 75 * union; a component is what
    links reach, named by its smallest doc_id, whose document alone is kept.  A null or empty text, or one
    without words, has no shingles and is linked with nothing; fewer than five words are one shingle.  doc_id
    identifies a document: rows that repeat it are one document, linked where any of their texts is.  A row without
    doc_id is compared with nothing, has a null component and is kept.  Very long texts are read whole; an empty table gives an empty one; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("row_id"), F.col("text").cast("string").alias("text"))
    made = materialise(signatures(texts), "signatures")
    named = made.where("n_shingles > 0 and row_id is not null")
    members = named.groupBy("set_a", "set_b", "n_shingles").agg(F.min("row_id").alias("node"), F.min("signature").alias("signature"), F.min("sketch").alias("sketch"))
    classes = materialise(members.withColumn("component", F.col("node")), "classes")
    same_set = named.join(classes.select("set_a", "set_b", "n_shingles", "node"), ["set_a", "set_b", "n_shingles"]).select("row_id", "node").distinct()
    same_set = materialise(same_set, "members")
    # The sets of rows that repeat a doc_id are one document's.
    repeated = same_set.groupBy("row_id").agg(F.min("node").alias("src"), F.max("node").alias("last")).where("src != last")
    links = same_set.join(repeated, "row_id").where("node != src").select("src", F.col("node").alias("dst"))
    grown, tried, crowded, component = classes, None, None, None
    # Each round's candidates: the closest rows, then the closest of another component, then all of other components
    # within the window, then all of other components among those that the window does not cover.
    for lags, apart, nearest in ((1, False, True), (WINDOW, True, True), (WINDOW, True, False), (None, True, False)):
        if lags:
            found = materialise(_candidates(grown, lags, apart, nearest), "candidates")
            pairs, crowded = found.where("a < b"), found.where("a = b").select(F.col("a").alias("node"))
            if nearest:
                pairs = _closest(pairs)
        else:
            pairs = found = _crowded_pairs(crowded, grown, texts)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs.select("a", "b"), "pairs")
        if lags is None and pairs.isEmpty():
            break
        links = links.union(_linked(pairs, texts))
        tried = pairs if tried is None else tried.union(pairs)
        component = materialise(connected_components(links), "components")
        grown = classes.drop("component").join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))

    of_row = same_set.join(component, "node", "left").groupBy("row_id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    return (
        made.select("row_id", "n_shingles")
        .join(of_row, "row_id", "left")
        .select(
            F.col("row_id").alias("doc_id"),
            "n_shingles",
            F.when(F.col("row_id").isNotNull(), F.coalesce("component_id", "row_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def op2_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then []
                      when len(w) < 5 then [array_to_string(w, ' ')]
                      else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from words),
items as (select doc_id, unnest(s) as shingle from sets),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from items a join items b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from common join sets x on x.doc_id = a join sets y on y.doc_id = b
  where 100 * shared >= 75 * (len(x.s) + len(y.s) - shared)),
steps as (select a as u, b as v from links union all select b, a from links),
reach(u, v) as (select u, v from steps union select r.u, s.v from reach r join steps s on r.v = s.u),
least_of as (select u, min(v) as m from reach group by u)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) as component_id,
       s.doc_id = least(s.doc_id, coalesce(m, s.doc_id)) as kept
from sets s left join least_of on u = s.doc_id
"""
