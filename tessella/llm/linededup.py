"""Line deduplication by an exact set-similarity join (operator 7).

A line is the set of its distinct lower-cased words.  Words are put in a fixed order, rarest first; two lines
whose Jaccard similarity reaches the threshold must then share a word among their first few (the prefix
filter), have near sizes (the length filter), and have enough words left after the shared one (the positional
filter).  Parities of the sets, which bound their difference from below, drop most of what is left, and the
rest is verified on the full sets.  A line is removed if an earlier line, by document and place, is similar
enough: one such line is enough, so each line is first held against the nearest few that pass the filters
under every word, and only a line that none of those removes is held against all, for which the texts are read again
and posted under such lines' keys alone.

No word gathers a large group.  Lines post their words one by one, but of the most frequent they post the pairs among
one word more of the prefix, of which two similar lines share one too.  Lines of many words, which would post too many
pairs, post those words alone, but meet only other such lines; lines between the two kinds post both.  Lines of up
to three words are similar only to equal ones and post their whole set.  Of lines with equal sets in one batch the
earliest speaks for all; later ones go at once.  Lines under one key stand in the order of their sizes, so each is
held against those of near size alone.

Postings are shuffled as packed blocks, a row for each batch and bucket of keys, and rarity comes from a sketch of
fixed size.  A word is known by 50 bits of its hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .blocks import pack, unpack
from .common import discard, materialise, table, tidy, unused
from .idfilter import bitmap, bits_for, held, maybe_in, slot
from .sets import BITS, pair_overlaps
from .words import SMALL_CHUNK, U, Chunk, chunks, mix, word_hashes

SIMILARITY = (4, 5)  # at least 4/5
WHOLE = 3  # lines of so many words have no similar line but equal ones
FREQUENT, FREQUENT_SHARE = 128, 1 << 18  # words that occur so often, and make up more than one in so many, are posted in pairs
LONG = 96  # lines of so many words post frequent words alone; those of up to a quarter more post pairs too
WORD_BITS = BITS
SET_BITS = 40  # of a set's hash; a copy must have the key, size and parities too
HELD_POSTINGS = 1 << 18  # in a task before it packs them
PARTITION_POSTINGS = 500_000  # that one task pairs, about
BUCKETS = 2  # in a task's keys: each is a block of every batch, and small blocks are mostly head
FEW_DOCUMENTS = 100_000  # that are picked by a broadcast join, before their texts go to Python
COPY = -1
WIDE = 96  # sets of fewer words keep 64 parities, others 128
CLOSE_PARTNERS, FIRST_PARTNERS = 2, 32  # tried first under a key; a line that none of them removes is then held against all
_WORDS = U((1 << WORD_BITS) - 1)
PLACES = ["p_doc", "p_line", "q_doc", "q_line"]
PAIR = "p_doc long, p_line long, q_doc long, q_line long, q_set long, more boolean, sure boolean"


def _differences(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: np.ndarray) -> np.ndarray:
    """In how many parities sets differ, the smaller of each two having `size` words."""
    few = np.bitwise_count(a[0] ^ a[1] ^ b[0] ^ b[1])
    return np.where(size < WIDE, few, np.bitwise_count(a[0] ^ b[0]) + np.bitwise_count(a[1] ^ b[1])).astype(np.int64)


class LineWords:
    """The distinct words of each line of a chunk that has any, by line and then rarest first.

    With `only`, a weight from 0 to 2 for each slot of a word, of the lines whose words weigh 2 at least, and of those of
    LONG words that weigh anything: no others are posted under the keys that `_asked_words` finds.
    """

    def __init__(self, c: Chunk, levels: np.ndarray, only: np.ndarray | None = None):
        start, end, _ = c.words()
        begin, _, first_line = c.lines()
        count = np.diff(np.r_[np.searchsorted(start, begin), len(start)])
        line = np.repeat(np.arange(len(begin)), count)
        word = c.span_hash(start, end) >> U(64 - WORD_BITS)
        if only is not None:
            slots = (word & U(sketch.SLOTS - 1)).view(np.int64)
            met = np.flatnonzero(only.take(slots))
            weight = np.bincount(line[met], only.take(slots[met]), len(begin))
            some = np.flatnonzero(np.repeat((weight >= 2) | ((weight > 0) & (count >= LONG)), count))
            word, line = word.take(some), line.take(some)
        packed = levels.take((word & U(sketch.SLOTS - 1)).view(np.int64)).astype(np.uint64) << U(WORD_BITS)
        packed |= word
        packed |= (line & 255).view(np.uint64) << U(56)
        # 256 lines are sorted together: a plain sort of numbers is many times faster than one of places.
        cuts = np.r_[np.searchsorted(line, np.arange(0, len(begin), 256)), len(line)].tolist()
        for low, high in zip(cuts, cuts[1:]):
            packed[low:high].sort()
        fresh = np.ones(len(packed), bool)
        fresh[1:] = (packed[1:] != packed[:-1]) | (line[1:] != line[:-1])
        packed, line = packed[fresh], line[fresh]
        self._fill(packed, line)
        own = line[self.head]
        self.text = np.searchsorted(first_line, own, side="right") - 1
        self.place = own - first_line[self.text]

    def _fill(self, packed: np.ndarray, line: np.ndarray) -> None:
        self.word, self.level = packed & _WORDS, (packed >> U(WORD_BITS) & U(63)).astype(np.int64)
        self.head = np.flatnonzero(np.r_[True, line[1:] != line[:-1]][: len(line)])
        self.size = np.diff(np.r_[self.head, len(line)])
        self.owner = np.repeat(np.arange(len(self.head)), self.size)
        self.rank = np.arange(len(line)) - np.repeat(self.head, self.size)

    @classmethod
    def of_sets(cls, sets: pa.Array, levels: np.ndarray) -> LineWords:
        """Lines that are known by their words alone, each the bytes of distinct numbers."""
        made, own = cls.__new__(cls), [np.frombuffer(x.as_buffer(), np.uint64) for x in sets]
        word, line = np.concatenate([np.zeros(0, np.uint64), *own]), np.repeat(np.arange(len(own)), [len(x) for x in own])
        packed = levels[(word & U(sketch.SLOTS - 1)).astype(np.int64)].astype(np.uint64) << U(WORD_BITS) | word
        order = np.lexsort((packed, line))
        made._fill(packed[order], line[order])
        return made

    def set_hashes(self) -> np.ndarray:
        return np.add.reduceat(mix(self.word), self.head) >> U(64 - SET_BITS) if len(self.head) else np.zeros(0, np.uint64)

    def parities(self) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each set, each the parity of its words there: two sets differ in at least as many words as bits.

        Smaller sets have half as many, folded: zeros take no room in a compressed block.
        """
        bit, side = U(1) << (self.word >> U(5) & U(63)), (self.word >> U(11) & U(1)).astype(bool)
        p0, p1 = (np.bitwise_xor.reduceat(np.where(side == k, bit, U(0)), self.head) for k in (False, True))
        wide = self.size >= WIDE
        return np.where(wide, p0, p0 ^ p1), np.where(wide, p1, U(0))

    def postings(self, own_set: np.ndarray, frequent: int = FREQUENT, long: int = LONG) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, key, left): what each line is posted under, and how many words it can share with a line that it
        meets there first."""
        num, den = SIMILARITY
        frequent = int(sketch.level_of(frequent))
        whole = np.flatnonzero((self.size <= WHOLE) & (self.level[self.head] > 0))
        # Only the words up to one after the prefix matter, and none of a line that posts its whole set.
        length = np.where(self.size > WHOLE, self.size - -(-num * self.size // den) + 1, -1)
        near = np.flatnonzero(self.rank <= np.repeat(length, self.size))
        owner, word, level, rank = (x.take(near) for x in (self.owner, self.word, self.level, self.rank))
        size, inside = self.size.take(owner), rank < length.take(owner)
        room, many = size - rank, level >= frequent
        single, alone = np.flatnonzero(inside & ~many & (level > 0)), np.flatnonzero(inside & many & (size >= long))
        lines = [whole, owner[single], owner[alone]]
        keys = [mix(own_set[whole] + U(3)), mix(word[single]), mix(word[alone] ^ U(0x51ED270B35AE3D1B))]
        left = [self.size[whole], room[single], room[alone]]
        # The frequent words of a line's prefix stand together at its end.
        at = np.flatnonzero(many & (4 * size < 5 * long))
        owner, word, room = owner.take(at), word.take(at), room.take(at)
        for far in range(1, len(at)):
            a = np.flatnonzero(owner[:-far] == owner[far:])
            if not len(a):
                break
            lines.append(owner.take(a))
            keys.append(mix(word.take(a) * U(0x9E3779B97F4A7C15) + word.take(a + far)))
            left.append(room.take(a + far) + 1)
        return np.concatenate(lines), np.concatenate(keys), np.concatenate(left)


def _posted(levels, buckets: int, frequent: int, only=None, keys=None):
    """Rows (bucket, block) of a block's columns: key, document, line, set, two parities, size and mark.

    mark is COPY for a line whose set an earlier line of the same batch has, which is posted nowhere; else twice
    `left`, and one more at the line's least key.  With `only`, weights of words, and `keys`, a bitmap, lines that weigh
    too little are left out, and what is posted under other keys.
    """

    def flush(made):
        doc, place, own, p0, p1, size = (np.concatenate([x[k] for x in made]) for k in range(6))
        n = np.cumsum([0] + [len(x[0]) for x in made])
        of = np.concatenate([x[6] + at for x, at in zip(made, n)])
        key, left = (np.concatenate([x[k] for x in made]) for k in (7, 8))
        order = np.lexsort((place, doc, own))
        before, after = order[:-1], order[1:]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (own[before] != own[after]) | (p0[before] != p0[after]) | (p1[before] != p1[after]) | (size[before] != size[after])
        lead = np.empty(len(order), np.int64)
        lead[order] = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        leads = lead == np.arange(len(order))
        copy = np.flatnonzero(~leads & ((doc != doc[lead]) | (place != place[lead])))
        least = np.full(len(doc), np.iinfo(np.uint64).max)
        np.minimum.at(least, of, key)
        kept = leads[of]
        of, key, left = of[kept], key[kept], left[kept]
        mark = 2 * left + (key == least[of])
        of = np.concatenate([of, copy])
        key = np.concatenate([key, mix(own[copy] ^ mix(doc[copy].view(np.uint64) + place[copy].view(np.uint64)))])
        mark = np.concatenate([mark, np.full(len(copy), COPY)])
        bucket = (key >> U(40)) % U(buckets)
        # Lines of like sizes stand together, for their columns have like bytes.
        order = np.argsort(np.minimum(size[of], 0xFFFF).astype(np.uint16), kind="stable")
        order = order[np.argsort(bucket[order].astype(np.uint16 if buckets <= 1 << 16 else np.int64), kind="stable")]
        columns = [x[order] for x in (key & U(0xFFFFFFFF), doc[of], place[of], own[of], p0[of], p1[of], size[of], mark)]
        bucket = bucket[order].astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
        ends = np.r_[cuts[1:], len(bucket)]
        blocks = [pack([x[a:b] for x in columns]) for a, b in zip(cuts.tolist(), ends.tolist())]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts], pa.int64()), pa.array(blocks, pa.binary())], ["bucket", "block"])

    def rows(batches):
        made, n = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for c in chunks(batch.column(1), size=SMALL_CHUNK):
                lines = LineWords(c, levels.value, only and only.value)
                if not len(lines.size):
                    continue
                own = lines.set_hashes()
                of, key, left = lines.postings(own, frequent)
                made_of = (ids[c.first + lines.text], lines.place, own, *lines.parities(), lines.size)
                if keys is not None:
                    met = held(keys.value, key.view(np.int64))
                    some, of = np.unique(of[met], return_inverse=True)
                    key, left, made_of = key[met], left[met], tuple(x[some] for x in made_of)
                if len(of):
                    made.append((*made_of, of, key, left))
                    n += len(of)
                if n >= HELD_POSTINGS:
                    yield flush(made)
                    made, n = [], 0
        if made:
            yield flush(made)

    return rows


def _partners(wanted=None):
    """Blocks in the order of their buckets to pairs of an earlier and a later line (PAIR).

    Lines with an equal set before them are `sure`.  Any other is held against those before it under the same key,
    the nearest first, by length, position and parity, until FIRST_PARTNERS fit or CLOSE_PARTNERS are close, with
    half the difference that is allowed; `more` says that others were left.  With `wanted`, only the later lines in that bitmap are held against others, and against all.
    """

    def pairs(batches):
        bucket, blocks = None, []
        for batch in batches:
            for own, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                if blocks and own != bucket:
                    yield _paired(blocks, wanted and wanted.value)
                    blocks = []
                bucket = own
                blocks.append(unpack(block.as_buffer()))
        if blocks:
            yield _paired(blocks, wanted and wanted.value)

    return pairs


def _in_order(doc: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Numbers in the order of (doc, line), equal where both are."""
    if not len(doc):
        return doc
    base = int(doc.min())
    if int(doc.max()) - base < 1 << 40 and int(line.max()) < 1 << 23:
        return (doc - base) << 23 | line
    order = np.lexsort((line, doc))
    place = np.empty(len(doc), np.int64)
    place[order] = np.cumsum(np.r_[False, (doc[order][1:] != doc[order][:-1]) | (line[order][1:] != line[order][:-1])])
    return place


def _sorted(key: np.ndarray) -> np.ndarray:
    """The stable order of unsigned numbers, by plain sorts, which are several times faster than a stable one."""
    order = np.argsort(key)
    key = key.take(order)
    group = np.cumsum(np.r_[False, key[1:] != key[:-1]][: len(key)], dtype=np.uint64)
    return (np.sort(group << U(32) | order.view(np.uint64)) & U(0xFFFFFFFF)).view(np.int64)


def _paired(blocks: list[list[np.ndarray]], wanted=None, most: int = FIRST_PARTNERS) -> pa.RecordBatch:
    num, den = SIMILARITY
    columns = [np.concatenate(x) for x in zip(*blocks)]
    copy = columns[7] == COPY
    copies = [x[copy] for x in columns[1:4]]
    columns = [x[~copy] for x in columns]
    place = _in_order(columns[1], columns[2])
    order = np.argsort(place)
    order = order[_sorted((columns[0] << U(32) ^ columns[3] >> U(SET_BITS - 32)).take(order))]
    key, doc, line, own, p0, p1, size, mark = columns
    before, after = order[:-1], order[1:]
    equal = np.ones(len(before), bool)
    for x in (key, own, p0, p1, size):
        equal &= x[before] == x[after]
    repeated = after[equal & (place[before] != place[after]) & (mark[after] & 1 == 1)]
    copies = [np.concatenate([x, y[repeated]]) for x, y in zip(copies, (doc, line, own))]
    order = order[~np.r_[False, equal][: len(order)]]
    order = order[_sorted(key.take(order) << U(32) | size.take(order).view(np.uint64))]
    key, doc, line, own, p0, p1, size, mark, place = (x.take(order) for x in (key, doc, line, own, p0, p1, size, mark, place))
    left = mark >> 1

    head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    length = np.diff(np.r_[head, len(key)])
    low, high = np.repeat(head, length), np.repeat(head + length, length)
    asked = high - low > 1
    if wanted is not None:
        asked &= held(wanted, doc, line)
    found, close = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    most, near = (most, CLOSE_PARTNERS) if wanted is None else (len(key) + 1, len(key) + 1)
    # Lines to be held against the next smaller and the next larger, until those are of no near size.
    sides, far = [np.flatnonzero(asked)] * 2, 0
    pairs = [(np.zeros(0, np.int64),) * 2]
    while len(sides[0]) or len(sides[1]):
        far += 1
        for k, step in enumerate((-far, far)):
            q = sides[k]
            q = q[q + step >= low.take(q)] if k == 0 else q[q + step < high.take(q)]
            # Sizes grow under a key: the earlier is no larger before, and no smaller after.
            other, own_size = size.take(q + step), size.take(q)
            sides[k] = q = q[den * other >= num * own_size] if k == 0 else q[num * other <= den * own_size]
            q = q[place.take(q + step) < place.take(q)]
            p = q + step
            sizes = size.take(q) + size.take(p)
            need = -(-num * sizes // (num + den))
            fits = np.flatnonzero(np.minimum(left.take(q), left.take(p)) >= need)
            q, p, allowed = q.take(fits), p.take(fits), (sizes - 2 * need).take(fits)
            differ = _differences((p0[q], p1[q]), (p0[p], p1[p]), np.minimum(size[q], size[p]))
            fits = differ <= allowed
            q, p, differ, allowed = q[fits], p[fits], differ[fits], allowed[fits]
            found[q] += 1
            # Parities of very different long sets agree in half of the bits, so a larger difference says nothing.
            close[q] += 2 * differ <= np.minimum(allowed, 32)
            pairs.append((p, q))
        sides = [q[(found[q] < most) & (close[q] < near)] for q in sides]
    p, q = (np.concatenate(x) for x in zip(*pairs))
    sure = np.arange(len(p) + len(copies[0])) >= len(p)
    more = np.concatenate([(found[q] >= most) | (close[q] >= near), np.zeros(len(copies[0]), bool)])
    columns = [pa.array(np.concatenate([x, y])) for x, y in ((doc[p], copies[0]), (line[p], copies[1]), (doc[q], copies[0]), (line[q], copies[1]), (own[q].view(np.int64), copies[2].view(np.int64)))]
    return pa.RecordBatch.from_arrays([*columns, pa.array(more), pa.array(sure)], [*PLACES, "q_set", "more", "sure"])


def _wanted_sets(found):
    """(doc_id, line, set_a, words) of the lines in the bitmaps `found` of documents and of lines, and of few others."""

    def pick(batches):
        documents, lines = found.value
        for batch in batches:
            batch = batch.filter(pa.array(held(documents, batch.column(0).to_numpy(zero_copy_only=False))))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for c in chunks(batch.column(1)):
                start, end, first = c.lines()
                text = np.repeat(np.arange(c.n), np.diff(first))
                place = np.arange(len(start)) - first[text]
                some = np.flatnonzero(held(lines, ids[c.first + text], place))
                if not len(some):
                    continue
                parts = [c.data[a:b] for a, b in zip(start[some].tolist(), end[some].tolist())]
                own = LineWords(Chunk(0, np.concatenate(parts), np.r_[0, np.cumsum([len(x) for x in parts])]), np.zeros(sketch.SLOTS, np.uint8))
                at, cuts = some[own.text], np.r_[own.head, len(own.word)].tolist()
                sets = [own.word[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
                columns = [pa.array(ids[c.first + text[at]]), pa.array(place[at]), pa.array(own.set_hashes().view(np.int64)), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "line", "set_a", "words"])

    return pick


def _verify(batches):
    """Pairs of sets, each as sorted words: where they reach the threshold, the later one's place."""
    num, den = SIMILARITY
    for batch in batches:
        for first, last, m, n, shared in pair_overlaps(batch.column(3), batch.column(4)):
            similar = pa.array(den * shared >= num * (m + n - shared))
            yield pa.RecordBatch.from_arrays([batch.column(k)[first:last].filter(similar) for k in range(3)], ["doc_id", "line", "set_a"])


def _similar(texts: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, line, set_a) of the later lines of `pairs` that are similar to the earlier one, on their full sets; and
    the table of those sets."""
    spark = texts.sparkSession
    p, q = (F.struct(F.col(f"{x}_doc").alias("doc_id"), F.col(f"{x}_line").alias("line")) for x in "pq")
    places = materialise(pairs.select(F.explode(F.array(p, q)).alias("at")).select("at.*").distinct(), "places")
    lines = bitmap(places.select(slot(F.col("doc_id"), F.col("line"), bits=(bits := bits_for(places.count()))).alias("slot")), bits)
    documents = bitmap(places.select(slot(F.col("doc_id"), bits=bits).alias("slot")), bits)
    found = spark.sparkContext.broadcast((documents, lines))
    own = materialise(places.select("doc_id").distinct(), "documents")
    if own.count() <= FEW_DOCUMENTS:
        texts = texts.join(F.broadcast(own), "doc_id", "left_semi")
    # The few other lines that the bitmaps let through meet no pair.
    some = materialise(texts.mapInArrow(tidy(_wanted_sets(found)), "doc_id long, line long, set_a long, words binary"), "line-sets")
    found.destroy()
    left = some.select(F.col("doc_id").alias("p_doc"), F.col("line").alias("p_line"), F.col("words").alias("p_words"))
    right = some.select(F.col("doc_id").alias("q_doc"), F.col("line").alias("q_line"), "set_a", F.col("words").alias("q_words"))
    both = pairs.join(left, ["p_doc", "p_line"]).join(right, ["q_doc", "q_line"]).select("q_doc", "q_line", "set_a", "p_words", "q_words")
    similar = materialise(both.mapInArrow(tidy(_verify), "doc_id long, line long, set_a long").distinct(), "similar-lines")
    discard(places, own)
    return similar, some


def _asked_words(levels, frequent: int):
    """(slot, weight, key): the slots of the words of each set that it is posted under, or may be, and the keys; each row
    has one of them.  A word that alone makes a key weighs 2, one that is posted in pairs, or alone in long lines, 1."""
    num, den = SIMILARITY

    def pick(batches):
        for batch in batches:
            lines = LineWords.of_sets(batch.column(0), levels.value)
            size = lines.size[lines.owner]
            prefix = (lines.rank < size - -(-num * size // den) + 2) | (size <= WHOLE)
            weight = np.where((lines.level < int(sketch.level_of(frequent))) | (size <= WHOLE), 2, 1)
            weighed = np.unique(((lines.word & U(sketch.SLOTS - 1)).astype(np.int64) << 2 | weight)[prefix])
            key = np.unique(lines.postings(lines.set_hashes(), frequent)[1]).view(np.int64)
            none = [pa.nulls(len(x), pa.int64()) for x in (key, weighed)]
            columns = [pa.concat_arrays([pa.array(x), none[0]]) for x in (weighed >> 2, weighed & 3)]
            yield pa.RecordBatch.from_arrays([*columns, pa.concat_arrays([none[1], pa.array(key)])], ["slot", "weight", "key"])

    return pick


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line, set_a) of every line that an earlier one is similar to; `set_a` tells apart rows that repeat a doc_id."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    found, total = sketch.rarity_levels(texts, lambda c: word_hashes(c)[0] >> U(64 - WORD_BITS))
    levels, frequent = spark.sparkContext.broadcast(found), max(FREQUENT, total // FREQUENT_SHARE)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (5 * PARTITION_POSTINGS))

    def pairs_of(wanted=None, only=None, keys=None) -> DataFrame:
        blocks = texts.mapInArrow(tidy(_posted(levels, BUCKETS * parts, frequent, only, keys)), "bucket long, block binary")
        return blocks.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_partners(wanted)), PAIR)

    pairs = materialise(pairs_of().groupBy(*PLACES, "q_set", "sure").agg(F.max("more").alias("more")), "line-pairs")
    later = [F.col("q_doc").alias("doc_id"), F.col("q_line").alias("line"), F.col("q_set").alias("set_a")]
    copies = pairs.where("sure").select(later)
    candidates = pairs.where("not sure")
    similar, sets = _similar(texts, candidates.select(PLACES).distinct())
    crowded = candidates.where("more").select(later).distinct()
    open_lines = materialise(crowded.join(similar.union(copies), ["doc_id", "line", "set_a"], "left_anti").select("doc_id", "line").distinct(), "open-lines")
    if n := open_lines.count():
        wanted = spark.sparkContext.broadcast(bitmap(open_lines.select(slot(F.col("doc_id"), F.col("line"), bits=bits_for(n)).alias("slot")), bits_for(n)))
        words = sets.join(open_lines, ["doc_id", "line"], "left_semi").select("words").mapInArrow(tidy(_asked_words(levels, frequent)), "slot long, weight long, key long")
        words = materialise(words.distinct(), "open-words")
        own = words.where("key is not null")
        bits = bits_for(own.count())
        keys = spark.sparkContext.broadcast(bitmap(own.select(slot(F.col("key"), bits=bits).alias("slot")), bits))
        weights = np.zeros(sketch.SLOTS, np.uint8)
        for k in (1, 2):
            marks = bitmap(words.where(F.col("weight") == k).select("slot"), sketch.SLOTS)
            weights[np.unpackbits(marks.view(np.uint8), bitorder="little").astype(bool)] = k
        only = spark.sparkContext.broadcast(weights)
        rest = materialise(pairs_of(wanted, only, keys).where("not sure").select(PLACES).distinct(), "line-pairs")
        more, more_sets = _similar(texts, rest)
        similar = similar.union(more)
        wanted.destroy()
        only.destroy()
        keys.destroy()
        discard(words, rest, more_sets)
    levels.destroy()
    discard(open_lines, sets)
    return copies.union(similar).distinct()


def _without(at: int):
    """Texts without their removed lines; the removed column (array of struct(line, set_a)) is the last."""

    def rebuild(batches):
        no_levels = np.zeros(sketch.SLOTS, np.uint8)
        for batch in batches:
            listed, source = batch.column(batch.num_columns - 1), batch.column(at)
            per = np.asarray(pc.fill_null(pc.list_value_length(listed), 0))
            touched = np.flatnonzero((per > 0) & np.asarray(source.is_valid()))
            entries = listed.take(pa.array(touched)).flatten()
            row = np.repeat(np.arange(len(touched)), per[touched])
            entry_line, entry_set = (np.asarray(entries.field(k)).astype(np.int64) for k in (0, 1))
            gone, made = np.zeros(len(source), np.int64), source.to_pylist() if len(touched) else None
            for c in chunks(source.take(pa.array(touched))):
                lines, (start, end, first) = LineWords(c, no_levels), c.lines()
                own = lines.set_hashes().view(np.int64)
                key = first[lines.text] + lines.place
                mine = (row >= c.first) & (row < c.last)
                # A place past the text's last line, of another row with its doc_id, is nothing here.
                text = row[mine] - c.first
                fits = entry_line[mine] < np.diff(first)[text]
                wanted, sets = first[text[fits]] + entry_line[mine][fits], entry_set[mine][fits]
                k = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
                same = (key[k] == wanted) & (own[k] == sets) if len(key) else np.zeros(len(wanted), bool)
                drop = np.zeros(len(start), bool)
                drop[wanted[same]] = True
                raw, cuts = c.data.tobytes(), first.tolist()
                start, end = start.tolist(), end.tolist()
                for t in np.unique(text):
                    span = range(cuts[t], cuts[t + 1])
                    to = touched[c.first + t]
                    gone[to] = drop[cuts[t] : cuts[t + 1]].sum()
                    if gone[to]:
                        made[to] = b"\n".join([raw[start[j] : end[j]] for j in span if not drop[j]]).decode()
            columns = list(batch.columns[:-1])
            if made is not None:
                columns[at] = pa.array(made, pa.string())
            total = pc.fill_null(pc.add(pc.count_substring(source, "\n"), 1), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, total, pa.array(gone)], [*batch.schema.names[:-1], "n_lines", "n_removed"])

    return rebuild


def dedup_lines(docs: DataFrame) -> DataFrame:
    """`docs` with later similar lines taken out of text, and the columns n_lines and n_removed.

    Lines are split at newlines and compared as sets of lower-cased words; one is removed if the Jaccard
    similarity with a line of a smaller doc_id, or an earlier one of its own document, is 0.8 or more.  Lines
    without words stay.  A null text stays null with 0 lines, an empty one has one line; a row without doc_id is
    left as it is; rows that repeat a doc_id stand at the same place, so neither is the earlier, and each loses its
    own lines; very long texts are read whole; an empty table gives an empty one.  Columns named n_lines or
    n_removed are replaced, others are carried whatever their names.
    """
    docs = docs.drop("n_lines", "n_removed")
    source, listed_as = unused(docs, "removed_from"), unused(docs, "removed_lines")
    gone = removed_lines(docs).groupBy("doc_id").agg(F.collect_set(F.struct("line", "set_a")).alias(listed_as))
    gone = materialise(gone, "removed-lines")
    key = F.col("doc_id").cast("long")
    bits = bits_for(gone.count())
    maybe = maybe_in(docs.sparkSession, slot(key, bits=bits), gone.select(slot(F.col("doc_id"), bits=bits).alias("slot")), bits)
    listed = gone.select(F.col("doc_id").alias(source), listed_as)
    touched = docs.where(maybe).join(listed, key == F.col(source), "left").drop(source)
    clear = docs.where(~maybe).withColumn(listed_as, F.lit(None).cast(gone.schema[listed_as].dataType))
    joined = clear.union(touched)
    schema = docs.schema.add("n_lines", "long").add("n_removed", "long")
    return joined.mapInArrow(tidy(_without(docs.columns.index("text"))), schema)


def op7_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gone = removed_lines(docs).groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("removed"))
    # A split at newlines would run a pattern over every text.
    n_lines = F.coalesce(F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
    return (
        docs.select("doc_id", n_lines.alias("n_lines"))
        .join(gone, "doc_id", "left")
        .select("doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce(F.array_join("removed", ","), F.lit("")).alias("removed_lines"))
    )


OP7_SQL = """
with lines as (
  select doc_id, u.line - 1 as line,
         list_distinct(regexp_extract_all(translate(u.content, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) as w
  from documents, unnest(string_split(text, chr(10))) with ordinality as u(content, line)),
wide as (select doc_id, line, list_sort(w) as w from lines where len(w) > 0),
classes as (select w, min((doc_id, line)) as first from wide group by w),
numbered as (select row_number() over () as id, w, first from classes),
words as (select id, first, len(w) as size, unnest(w) as word from numbered),
common as (
  select a.id as a, b.id as b, any_value(a.size) + any_value(b.size) as sizes, count(*) as shared
  from words a join words b on a.word = b.word and a.first < b.first
   and 5 * least(a.size, b.size) >= 4 * greatest(a.size, b.size)
  group by 1, 2),
alike as (select distinct b as id from common where 5 * shared >= 4 * (sizes - shared)),
gone as (
  select v.doc_id, v.line from wide v join numbered n using (w)
  where (v.doc_id, v.line) > n.first or n.id in (select id from alike)),
per_doc as (select doc_id, count(*) as n, string_agg(cast(line as varchar), ',' order by line) as removed from gone group by doc_id)
select d.doc_id, cast(coalesce(len(string_split(d.text, chr(10))), 0) as bigint) as n_lines,
       cast(coalesce(p.n, 0) as bigint) as n_removed, coalesce(p.removed, '') as removed_lines
from documents d left join per_doc p using (doc_id)
"""
