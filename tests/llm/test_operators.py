"""Brute-force comparisons and edge cases of the training-data operators."""

import collections
import hashlib
import math
import random
import threading
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessella.llm import blocks, common, decontaminate, idfilter, linededup, maxent, neardup, packing, passages, quality, sharding, sketch, tokencount, tokens, urlrules, words
from tessella.llm import sets as sets_module
from tessella.llm.common import connected_components
from tessella.llm.tokens import TokenIds
from tessella.llm.trees import fit

SCHEMA = "doc_id long, text string, lang string, source string, size long, shard int, kept boolean"
VOCABULARY = ["the", "of", "and", "lion", "Tree", "río", "straße", "x", "blue,", "go.", "42", "éa"]


def text_of(rng, n):
    return " ".join(rng.choice(VOCABULARY) + str(rng.randrange(60)) for _ in range(n))


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        text = text_of(rng, rng.randrange(3, 120))
        if rows and rng.random() < 0.4:
            own = (rng.choice(rows)[1] or "a b c d e f").split(" ")
            for _ in range(rng.randrange(0, 6)):
                own[rng.randrange(len(own))] = "edit" + str(rng.randrange(1000))
            text = " ".join(own)
        if rng.random() < 0.5:
            text = text.replace(" the", "\nthe")
        rows.append((k, text))
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "one two"), (904, "one two"), (905, rows[0][1]), (906, rows[0][1]), (907, "w" * 5000), (908, text_of(rng, 9000))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", None if d is None or d % 7 == 0 else f"s{d % 3}", 5, 1, True) for d, t in rows], SCHEMA)


def split(text):
    return (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split()


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_words_lines_and_spans():
    texts = ["Ab  c\x0bD", "", None, "e\n\nF ", "\n", "x" * 50]
    for size in (1, 1 << 20):
        got, lines = [], []
        for c in words.chunks(pa.array(texts), size=size):
            s, e, f = c.words()
            h = c.span_hash(s, e)
            got += [list(h[f[k] : f[k + 1]]) for k in range(c.n)]
            s, e, f = c.lines()
            lines += [[c.data[s[j] : e[j]].tobytes().decode() for j in range(f[k], f[k + 1])] for k in range(c.n)]
        assert [len(g) for g in got] == [len(split(t)) for t in texts]
        assert lines == [(t or "").split("\n") for t in texts]
    a, b = (next(words.chunks(pa.array([t]))) for t in ("q ABC", "abc zz"))
    assert words.word_hashes(a)[0][1] == words.word_hashes(b)[0][0]


def test_sorted_and_packed_columns():
    rng = np.random.default_rng(7)
    for n, top in ((0, 1), (1, 1), (5000, 40), (5000, 1 << 63)):
        key = rng.integers(0, top, n, dtype=np.uint64)
        assert (linededup._sorted(key) == np.argsort(key, kind="stable")).all()
        columns = [key, rng.integers(-(1 << 40), 1 << 40, n), rng.integers(0, 300, n, dtype=np.uint64)]
        raw = blocks.pack(columns)
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(blocks.unpack(raw), columns))


def test_words_by_arithmetic_or_table():
    (c,) = words.chunks(pa.array(["".join(map(chr, range(128))), "\x00\x08a\x0e \xa0\u2003b", "", "\t\n"]))
    assert all((a == b).all() for a, b in zip(c.words(), c.words(words.SPACE.copy())))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_near_duplicates(spark, rows):
    sets = {}
    for d, t in rows:
        w = split(t)
        sets[d] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(frame(spark, rows + [(None, rows[0][1])])).collect()}
    assert got.pop(None)[1:] == (None, True)
    assert got == {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def test_near_duplicates_in_a_crowd(spark):
    """Texts at 0.72 to each other, more than a window holds, and among them pairs at 0.76."""
    core = [f"core{k}" for k in range(184)]
    rows, pairs = [], 100
    for k in range(1500):
        own = [f"w{k}x{j}" for j in range(35)]
        if k >= 1500 - pairs:
            own[:6] = [f"w{k - 1500 + pairs}x{j}" for j in range(6)]
        rows.append((k, " ".join(core + own)))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    missed = [k for k in range(1500 - pairs, 1500) if got[k] != k - 1500 + pairs]
    assert not missed, f"{len(missed)} of {pairs} pairs missed"
    assert all(got[k] == k for k in range(1500 - pairs))


def test_near_duplicates_of_one_original(spark):
    """One original and 4,000 copies, each with 5 of 200 words changed: at 0.77 to the original, not to each other."""
    rng = random.Random(12)
    words_of = [f"o{k}" for k in range(200)]
    rows = [(0, " ".join(words_of))]
    for k in range(1, 4001):
        own = list(words_of)
        for at in rng.sample(range(0, 200, 6), 5):
            own[at] = f"c{k}x{at}"
        rows.append((k, " ".join(own)))
    links = [k for k, t in rows[1:] if 4 * len(shingle_set(t) & shingle_set(rows[0][1])) >= 3 * len(shingle_set(t) | shingle_set(rows[0][1]))]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    assert len(links) > 3900 and all(got[k] == 0 for k in links)


def shingle_set(text):
    w = split(text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates_of_repeated_ids(spark):
    a, b, c = ("a b c d e f g", "h i j k l m n", "q r s t u v w")
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(frame(spark, [(1, a), (3, b), (5, a), (5, b), (5, None), (7, c), (8, c)])).collect())
    assert got == [(1, 3, 1, True), (3, 3, 1, False), (5, 0, 1, False), (5, 3, 1, False), (5, 3, 1, False), (7, 3, 7, True), (8, 3, 7, False)]


def test_packing(spark, rows):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(TokenIds.open()._model and __import__("public_tokenizers").path("word_bpe_49k.json"))
    got = packing.pack_documents(frame(spark, rows), length=256, packer_tokens=20_000).collect()
    placed, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        placed[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for own in placed.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    for d, t in rows:
        ids = model.encode(t or "", add_special_tokens=False).ids + [1]
        parts = [ids[k : k + 256] for k in range(0, len(ids), 256)]
        own = sorted(by_doc[d], key=lambda r: r.piece)
        assert [(r.start, r.length, r.ids_crc32) for r in own] == [(256 * k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(parts)]
    least = -(-sum(r.length for r in got) // 256)
    assert len(placed) <= least + 2 * 3  # three packers each leave their last sequences open


def test_best_fit_closes_the_fullest():
    bins = packing.BestFit(10, open_bins=2)
    assert [bins.place(n) for n in (6, 7, 9, 4, 1)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 9)]


def test_sharding(spark, rows):
    got = sharding.interleaved_shards(frame(spark, rows + [(None, "x"), (3, rows[3][1])]), n_shards=7).collect()
    assert len(got) == len(rows) + 2
    sizes = collections.Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    for r in got:
        if r.doc_id == 900:
            assert (r["size"], r.text_crc32) == (16, 0)
    # By brute force: rank within the source by digest, order by fractional rank, cut into equal shards.
    digest = lambda r: hashlib.md5(f"{sharding.SEED}:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
    ties = lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32, r["size"])
    placed = []
    for source in {r.source for r in got}:
        own = sorted((r for r in got if r.source == source), key=lambda r: (digest(r), ties(r)))
        placed += [((k + 0.5) / len(own), "" if source is None else "=" + source, ties(r), r) for k, r in enumerate(own)]
    expected = []
    for place, (*_, r) in enumerate(sorted(placed, key=lambda x: x[:3])):
        shard = place * 7 // len(placed)
        expected.append((str(r.doc_id), r.text_crc32, shard, place - -(-shard * len(placed) // 7)))
    assert sorted(expected) == sorted((str(r.doc_id), r.text_crc32, r.shard, r.slot) for r in got)
    for source in {r.source for r in got}:
        share = [sum(r.shard == s and r.source == source for r in got) for s in sizes]
        assert max(share) - min(share) <= 2


def test_quality_counts(spark, rows):
    rng = random.Random(2)
    many = rows + [(950, "\n".join(["a b c", "a b c", " ", " ", "d"] * 30)), (951, " ".join(rng.choice("abc#$") for _ in range(300)))]
    forest = fit(np.zeros((0, len(quality.FEATURES))), np.zeros(0), quality.MONOTONE)
    for r in quality.judge_quality(frame(spark, many), forest).collect():
        text = r.text or ""
        w = text.encode().split()
        tri = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(k, k + 3)}
        seen, dup = set(), 0
        for line in text.split("\n"):
            if line.encode().split():
                dup += line in seen
                seen.add(line)
        expected = (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), dup, len(covered))
        assert tuple(r[c] for c in quality.COUNTS) == expected, r.doc_id
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (r.base_failed and r.kept)


def test_trees_learn_and_stay_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] < 0.6) & (x[:, 1] > 0.2)).astype(float)
    forest = fit(x, y, [-1, 1, 0], trees=30)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.97
    base = rng.random((200, 3))
    for f, sign in ((0, -1), (1, 1)):
        last = None
        for v in np.linspace(0, 1, 21):
            moved = base.copy()
            moved[:, f] = v
            m = forest.margin(moved)
            assert last is None or (sign * (m - last) >= -1e-9).all()
            last = m


def test_token_caches_are_bounded_and_texts_read_as_needed(monkeypatch):
    """Both caches of a worker hold CACHE_ENTRIES at most, and a slice takes no texts beyond its own out of a batch."""
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 100)
    ids = TokenIds(tokens.vocabulary_path())
    for k in range(40):
        ids.of_all([" ".join(f"{a}{a}{chr(97 + k % 26)}{chr(97 + k // 26)}{b}-zz" for a in "abcdef" for b in "xyz")])
        assert len(ids._cache) <= 101 and len(ids._runs) <= 100
    assert len(ids._runs) > 50
    taken = []
    source = (taken.append(k) or x for k, x in enumerate(["a" * 600_000, None, "b", "c" * 600_000, "d"]))
    slices = tokens.in_slices(source)
    assert next(slices) == (0, ["a" * 600_000]) and taken == [0]
    assert [(first, len(own)) for first, own in slices] == [(1, 3), (4, 1)]


def test_distinct_pieces_are_encoded_once(monkeypatch):
    texts = ["Don't WE'LL 12ab a", "", "a a\n\na  b!?", "\x00 \u0130x \u01c5 e\u0301 \u00aa\u00ba <|x|> \u65e5\u672c", "b!? " * 50, "\n"]
    ids, asked = TokenIds(tokens.vocabulary_path()), []
    of_missing = ids._of_missing
    monkeypatch.setattr(ids, "_of_missing", lambda missing: asked.extend(missing) or of_missing(missing))
    first = ids.of_all(texts)
    assert sorted(asked) == sorted({p for t in texts for p in t.replace("\n", " ").split(" ")} - {""})
    assert ids.of_all(texts) == first and len(asked) == len(set(asked)) and ids.of_all([]) == []
    assert [np.frombuffer(x, "<u4").tolist() for x in first] == [ids._model.encode(t, add_special_tokens=False).ids for t in texts]


def test_token_counts(spark, rows, tmp_path):
    ids = TokenIds.open()
    expected = {d: len(ids.of_all([t or ""])[0]) // 4 for d, t in rows}
    for block in (16, 1 << 10):
        got = tokencount.count_document_tokens(frame(spark, rows), block=block).collect()
        assert {r.doc_id: r.n_tokens for r in got} == expected and all(r.terminated for r in got)
    files = {"a": [5, 6, 9, 9, 7, 9, 8, 8], "b": [9], "c": [65535, 3, 9, 4, 4, 4, 4, 4, 4, 4, 4, 9], "d": [], "e": [1]}
    for name, own in files.items():
        (tmp_path / f"{name}.bin").write_bytes(np.array(own, "<u2").tobytes() + b"x" * (name == "e"))
    read = tokencount.read_token_files(spark, str(tmp_path), block=4)
    got = sorted((r.file[-5:-4], r.ordinal, r.n_tokens, r.terminated) for r in tokencount.count_tokens(read, eod=9, block=4).collect())
    assert got == [("a", 0, 2, True), ("a", 1, 0, True), ("a", 2, 1, True), ("a", 3, 2, False), ("b", 0, 0, True), ("c", 0, 2, True), ("c", 1, 8, True), ("e", 0, 1, False)]
    spelled = frame(spark, [(1, "a <|endoftext|> b"), (2, "<|endoftext|>")])
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(__import__("public_tokenizers").path("word_bpe_49k.json"))
    sizes = {d: len(plain.encode(t, add_special_tokens=False).ids) for d, t in ((1, "a <|endoftext|> b"), (2, "<|endoftext|>"))}
    assert {r.doc_id: r.n_tokens for r in tokencount.count_document_tokens(spelled).collect()} == sizes


def similar_later_lines(rows):
    """(row, line) of every line with words that a line of an earlier document or place is similar to."""
    lines = [(k, d, j, frozenset(split(x))) for k, (d, t) in enumerate(rows) if t is not None and d is not None for j, x in enumerate(t.split("\n"))]
    lines = [x for x in lines if x[3]]
    return {(k, j) for k, d, j, s in lines if any((e, i) < (d, j) and 5 * len(s & o) >= 4 * len(s | o) for _, e, i, o in lines)}


def test_line_dedup(spark, rows):
    gone = similar_later_lines(rows)
    assert len(gone) > 20
    got = {r.doc_id: r for r in linededup.dedup_lines(frame(spark, rows + [(None, rows[0][1])])).collect()}
    assert got[None].text == rows[0][1]
    for k, (d, t) in enumerate(rows):
        own = [j for i, j in gone if i == k]
        kept = None if t is None else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in own)
        assert (got[d].text, got[d].n_lines, got[d].n_removed) == (kept, 0 if t is None else len(t.split("\n")), len(own))


def test_line_dedup_of_repeated_ids_and_short_lines(spark):
    rows = [(5, "one\ntwo three four five\n\nsix"), (1, "one"), (2, "two three four five six\nSIX\nsix"), (5, "alone here\ntwo five four three"), (5, "alone here"), (7, "\n \nalone here")]
    schema = "doc_id long, text string, removed_from string, Removed_Lines string, n_lines string"
    docs = spark.createDataFrame([(d, t, "x", str(k), "y") for k, (d, t) in enumerate(rows)], schema)
    got = {int(r.Removed_Lines): r for r in linededup.dedup_lines(docs).collect()}
    gone = similar_later_lines(rows)
    assert gone == {(0, 0), (0, 1), (0, 3), (2, 2), (3, 1), (5, 2)}
    for k, (_, t) in enumerate(rows):
        assert got[k].text == "\n".join(x for j, x in enumerate(t.split("\n")) if (k, j) not in gone)
        assert got[k].removed_from == "x" and got[k].n_removed == sum(i == k for i, _ in gone)


@pytest.mark.parametrize("frequent, long", [(1 << 30, 1 << 30), (2, 1 << 30), (2, 2), (8, 12), (40, 20)])
def test_similar_lines_meet(frequent, long):
    """Every two similar lines meet under a key at which the filters let them through, whatever is frequent or long."""
    rng = random.Random(frequent + long)
    names = [f"w{k}" for k in range(60)]
    lines = []
    for _ in range(300):
        own = [rng.choice(names[: rng.choice([5, 20, 60])]) for _ in range(rng.randrange(1, 30))]
        if lines and rng.random() < 0.5:
            own = rng.choice(lines).split()
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(names)
            rng.shuffle(own)
        lines.append(" ".join(own))
    c = next(words.chunks(pa.array(lines)))
    start, end, _ = c.words()
    counts = np.bincount((c.span_hash(start, end) >> np.uint64(14) & np.uint64(sketch.SLOTS - 1)).astype(np.int64), minlength=sketch.SLOTS)
    own = linededup.LineWords(c, sketch.level_of(counts))
    hashes, (p0, p1) = own.set_hashes(), own.parities()
    of, key, left = own.postings(hashes, frequent, long)
    ids, zero = np.arange(len(lines)), np.zeros(len(of), np.int64)
    block = [key, ids[of], zero, hashes[of], p0[of], p1[of], own.size[of], 2 * left]
    found = linededup._paired([block], wanted=np.full(4, 0xFFFFFFFF, np.uint32))
    met = {(p, q) for p, q in zip(found.column("p_doc").to_pylist(), found.column("q_doc").to_pylist())}
    sets = [frozenset(x.split()) for x in lines]
    assert (own.size == [len(s) for s in sets]).all()
    seen = set()
    for q, s in enumerate(sets):
        for p, o in enumerate(sets[:q]):
            if 5 * len(s & o) >= 4 * len(s | o) and s != o and s not in seen and o not in sets[:p]:
                assert (p, q) in met, (lines[p], lines[q])
        seen.add(s)


def test_a_worker_that_waits_forgets_its_token_caches():
    """The caches stay for a task that follows at once, and go when none does."""
    went = threading.Event()
    own = TokenIds.open()
    TokenIds.forget_soon(went.set, 0.2)
    TokenIds.keep()
    assert not went.wait(0.5) and TokenIds.open() is own
    assert list(common.tidy(iter, tokens=True)([1, 2])) == [1, 2] and TokenIds.open() is own
    TokenIds.forget_soon(went.set, 0.05)
    assert went.wait(5) and TokenIds.open() is not own
    assert list(common.tidy(iter, tokens=True)([3])) == [3]
    time.sleep(4 * tokens.IDLE_SECONDS)
    assert not TokenIds._by_path


def test_open_lines_are_met_under_their_keys_alone():
    """What the second pass posts is what the first does under the open lines' keys, whether words are rare or not and lines
    short or long; lines are open here that the first pass can't settle."""
    rng = random.Random(11)
    lines = []
    for _ in range(400):
        names = [f"w{k}" for k in range(rng.choice([30, 400, 4000]))]
        own = [rng.choice(names) for _ in range(rng.choice([2, 3, 8, 30, 150]))]
        if lines and rng.random() < 0.4:
            own = rng.choice(lines).split()
            own[rng.randrange(len(own))] = rng.choice(names)
        lines.append(" ".join(own))
    table = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(lines)], ["doc_id", "text"])
    c = next(words.chunks(table.column(1)))
    start, end, _ = c.words()
    counts = np.bincount((c.span_hash(start, end) >> np.uint64(14) & np.uint64(sketch.SLOTS - 1)).astype(np.int64), minlength=sketch.SLOTS)

    class Sent:
        def __init__(self, value):
            self.value = value

    levels, frequent = Sent(sketch.level_of(counts)), 16
    every = linededup.LineWords(c, levels.value)
    cuts = np.r_[every.head, len(every.word)]
    asked = [k for k in range(400) if k % 40 == 0]
    sets = pa.array([np.sort(every.word[cuts[k] : cuts[k + 1]]).tobytes() for k in asked], pa.binary())
    made = linededup.LineWords.of_sets(sets, levels.value)
    assert (made.set_hashes() == every.set_hashes()[asked]).all()
    (found,) = linededup._asked_words(levels, frequent)([pa.RecordBatch.from_arrays([sets], ["words"])])
    of, key, left = every.postings(every.set_hashes(), frequent)
    wanted = set(found.column("key").drop_null().to_numpy().view(np.uint64).tolist())
    assert wanted == set(key[np.isin(of, asked)].tolist()) and len(wanted) < len(set(key.tolist())) / 4
    weights = np.zeros(sketch.SLOTS, np.uint8)
    for slot, weight in sorted(zip(found.column("slot").drop_null().to_pylist(), found.column("weight").drop_null().to_pylist()), key=lambda x: x[1]):
        weights[slot] = weight
    keys = np.zeros(1 << 17, np.uint32)
    at = idfilter.slots(np.array(sorted(wanted), np.uint64).view(np.int64), 0, 32 * len(keys))
    np.bitwise_or.at(keys, at // 32, np.uint32(1) << (at % 32).astype(np.uint32))

    def posted(*filters):
        rows = [blocks.unpack(x.as_buffer()) for batch in linededup._posted(levels, 1, frequent, *filters)([table]) for x in batch.column(1)]
        key, doc, place, own, _, _, size, mark = (np.concatenate(x) for x in zip(*rows))
        some = (mark != linededup.COPY) & np.isin(key, np.array(sorted(wanted), np.uint64) & np.uint64(0xFFFFFFFF))
        return len(key), set(zip(*(x[some].tolist() for x in (key, doc, place, own, size, mark >> 1))))

    n, whole = posted()
    few, part = posted(Sent(weights), Sent(keys))
    assert part == whole and few < n / 2


def test_parities_differ_in_no_more_than_the_words():
    """Sets about the size under which fewer parities are kept, each against one with a few words changed."""
    rng = random.Random(5)
    sizes = [linededup.WIDE + d for d in range(-8, 9)] + [4, 20, 60, 200]
    sets = []
    for n in sizes:
        own = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        sets += [own, own[rng.randrange(3) :] + [f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(4))]]
    own = linededup.LineWords(next(words.chunks(pa.array([" ".join(x) for x in sets]))), np.zeros(sketch.SLOTS, np.uint8))
    p0, p1 = own.parities()
    for k in range(len(sets)):
        other = np.arange(len(sets))
        fewer = np.minimum(own.size[k], own.size)
        found = linededup._differences((p0[[k]], p1[[k]]), (p0, p1), fewer)
        words_apart = np.array([len(set(sets[k]) ^ set(sets[j])) for j in other])
        assert (found <= words_apart).all() and (found % 2 == words_apart % 2).all()
    assert (p1[own.size < linededup.WIDE] == 0).all() and (p1[own.size >= linededup.WIDE] != 0).all()


def test_overlaps_of_sets():
    rng = np.random.default_rng(6)
    sets = [[np.unique(rng.integers(0, 400, rng.integers(0, 300), dtype=np.uint64) << np.uint64(40)) for _ in range(500)] for _ in range(2)]
    columns = [pa.array([b"x", *(x.tobytes() for x in side)], pa.binary())[1:] for side in sets]
    for size in (1, 700, 1 << 20):
        sets_module.MEMBERS = size
        got = [(k + first, *x) for first, _, m, n, shared in sets_module.pair_overlaps(*columns) for k, x in enumerate(zip(m, n, shared))]
        assert got == [(k, len(x), len(y), len(np.intersect1d(x, y))) for k, (x, y) in enumerate(zip(*sets))]
    assert list(sets_module.pair_overlaps(columns[0][:0], columns[1][:0])) == []


def test_blocks_of_numbers():
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 1 << 63, 50, dtype=np.uint64), rng.integers(-(1 << 62), 1 << 62, 50), np.full(50, 7), np.arange(50) + (1 << 40), np.array([-(1 << 63), (1 << 63) - 1] * 25)]
    got = blocks.unpack(blocks.pack(columns))
    assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(columns, got))
    assert [len(x) for x in blocks.unpack(blocks.pack([x[:0] for x in columns]))] == [0] * 5


def test_rarity(spark, rows):
    found, total = sketch.rarity_levels(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), lambda c: words.word_hashes(c)[0])
    counts = collections.Counter()
    for c in words.chunks(pa.array([t for _, t in rows])):
        counts.update((words.word_hashes(c)[0] & np.uint64(sketch.SLOTS - 1)).tolist())
    expected = np.zeros(sketch.SLOTS, np.uint64)
    expected[list(counts)] = list(counts.values())
    exact = expected < 16
    assert (found[exact] == sketch.level_of(expected)[exact]).all() and abs(found[~exact].astype(int) - sketch.level_of(expected)[~exact]).max() <= 1
    assert abs(total - sum(counts.values())) < 0.1 * total


def test_edit_distance():
    def slow(a, b):
        best = list(range(len(a) + 1))
        least = best[-1]
        for x in b:
            new = [0]
            for k, y in enumerate(a):
                new.append(min(best[k] + (x != y), best[k + 1] + 1, new[k] + 1))
            best = new
            least = min(least, best[-1])
        return least

    rng = random.Random(4)
    for _ in range(300):
        a = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 90))]
        b = [rng.randrange(1, 5) for _ in range(rng.randrange(0, 60))]
        assert decontaminate.best_alignment(np.array(a), np.array(b))[0] == slow(a, b)


def test_decontamination(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    items = [(k, " ".join(word() for _ in range(rng.randrange(15, 60)))) for k in range(30)] + [(98, "too short"), (99, None)]
    docs, planted = [], set()
    for k in range(200):
        own = [word() for _ in range(rng.randrange(10, 200))]
        if k % 2:
            i, t = items[rng.randrange(30)]
            passage = t.split(" ")
            for _ in range(rng.randrange(0, len(passage) // 10 + 1)):
                at = rng.randrange(len(passage))
                passage[at : at + 1] = rng.choice([[], [word()], [passage[at], word()]])
            at = rng.randrange(len(own))
            own[at:at] = passage
            planted.add((k, i))
        docs.append((k, " ".join(own).capitalize() + "."))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(frame(spark, docs + [(None, None), (500, "")]), bench).collect()
    found = {(r.doc_id, i) for r in got for i in r.item_ids}
    assert found == planted
    assert len(got) == 202 and {r.contaminated for r in got if r.doc_id in (None, 500)} == {False}
    blocks = decontaminate.benchmark_matches(frame(spark, docs), bench, block_words=200).select("doc_id", "item_id").distinct().collect()
    assert {(r[0], r[1]) for r in blocks} == planted


def test_short_items_at_their_full_distance():
    """Items of 1 to 15 words, each alone between other texts, with as many edits as are allowed."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items, docs = [], []
    for n in range(1, 16):
        for _ in range(30):
            item = [word() for _ in range(n)]
            passage = list(item)
            for at in sorted(rng.sample(range(n), n // 4), reverse=True):
                passage[at : at + 1] = rng.choice([[], [word()], [passage[at], word()]])
            items.append(item)
            around = rng.randrange(0, 4)
            docs.append([word() for _ in range(around)] + passage + [word() for _ in range(around)])
    hashed = decontaminate.item_words([" ".join(x) for x in items])
    search = decontaminate._search(decontaminate.Sampler(hashed), list(range(len(items))))
    found = {(row, item) for row, item, _, _ in search(pa.array([" ".join(x) for x in docs]))}
    missed = [len(items[k]) for k in range(len(items)) if (k, k) not in found]
    assert not missed, collections.Counter(missed)


def test_items_of_few_words(spark):
    bench = spark.createDataFrame([(1, "Paris"), (2, "forty two"), (3, "...")], "item_id long, text string")
    docs = frame(spark, [(1, "in Paris, once"), (2, "forty-two"), (3, "forty or two"), (4, "...")])
    assert {r.doc_id: r.item_ids for r in decontaminate.decontaminate(docs, bench).collect()} == {1: [1], 2: [2], 3: [], 4: []}


def test_repeated_passages(spark, rows):
    rng = random.Random(6)
    many = [(d, t) for d, t in rows if d < 900] + [r for r in rows if r[0] >= 900]
    shared = text_of(rng, 60)
    many += [(1000 + k, text_of(rng, 20) + shared[: rng.randrange(80, 400)] + text_of(rng, 5)) for k in range(12)] + [(1100, "ab" * 300), (1101, "é" * 200)]
    got = {r.doc_id: r for r in passages.remove_repeats(frame(spark, many + [(None, shared)])).collect()}
    assert got[None].n_removed == 0
    seen, total = set(), 0
    for d, t in sorted(many):
        b = (t or "").encode()
        mark = np.zeros(len(b) + 1, np.int8)
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                mark[k : k + 100] = 1
            seen.add(b[k : k + 100])
        kept = bytes(x for x, m in zip(b, mark) if not m)
        r = got[d]
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(b), int(mark.sum()), int((np.diff(mark, prepend=0) == 1).sum()), kept), d
        total += int(mark.sum())
    assert total > 1000


def test_longest_previous_factors():
    rng = random.Random(8)
    for width, letters in ((12, "ab"), (9, "abc"), (20, "a")):
        spans = ["".join(rng.choice(letters) for _ in range(rng.randrange(width, 60))).encode() for _ in range(40)]
        group = np.array(sorted(rng.randrange(6) for _ in spans))
        got, at = passages.previous_factors(spans, group, width), 0
        for k, s in enumerate(spans):
            for start in range(len(s) - width + 1):
                earlier = [(j, i) for j in range(k + 1) if group[j] == group[k] for i in range(len(spans[j]) - width + 1) if (j, i) < (k, start)]
                own = s[start : start + width]
                best = max((next((n for n in range(width) if spans[j][i + n] != own[n]), width) for j, i in earlier), default=0)
                assert got[at] == best
                at += 1
    assert len(passages.previous_factors([], np.zeros(0, np.int64))) == 0


def test_lm_scores(spark, rows):
    got = {r.doc_id: r for r in maxent.score_corpus(frame(spark, rows)).collect()}
    counts, tokens = collections.Counter(), {}
    for d, t in rows:
        tokens[d] = [*split(t), b" end"]
        if zlib.crc32(str(d).encode()) % 10:
            counts.update(tokens[d])
    total, vocabulary = sum(counts.values()), len(counts)
    for d, own in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (vocabulary + 1))) for w in own)
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(d).encode()) % 10 == 0, len(own), sum(w in counts for w in own), total)
        assert r.base_score == pytest.approx(base) and math.isfinite(r.score) and r.score < 0


def test_lm_is_a_distribution():
    """Over every known word and one unknown of each open place, after training, whatever the history."""
    rng = np.random.default_rng(0)
    n = maxent.HEAD_WORDS + 900
    hashes, shape = words.mix(np.arange(1, n + 1, dtype=np.uint64)), rng.integers(0, maxent.SHAPES, n)
    counts = np.sort(rng.integers(1, 500, n))[::-1].astype(float)
    head = hashes[: maxent.HEAD_WORDS]
    of_head, of_shape = rng.integers(0, maxent.CLOSED, maxent.HEAD_WORDS), rng.integers(0, maxent.OPEN, maxent.SHAPES)
    place = ((hashes >> np.uint64(maxent.PLACE_SHIFT)) & np.uint64(maxent.CLASS_WORDS - 1)).astype(int)
    mass = np.zeros((maxent.OPEN, maxent.CLASS_WORDS))
    rest = np.arange(maxent.HEAD_WORDS, n)
    np.add.at(mass, (of_shape[shape[rest]], place[rest]), counts[rest] + maxent.ADD)
    m = maxent.Model(head, counts[: maxent.HEAD_WORDS], of_head, of_shape, mass, int(counts.sum()), n)
    at = rng.integers(0, n, 5000)
    table, trainer = maxent.WordTable(head), maxent.Trainer(m)
    trainer.learn(hashes[at], shape[at], np.array([0, 2500, 5000]), table)
    m.class_weights, m.place_weights = trainer.weights
    assert np.abs(m.class_weights).max() > 0 and np.abs(m.place_weights).max() > 0
    s = maxent._symbols(hashes, shape, table)
    cls, own = m.places(hashes, s, shape)
    assert (s[rest] >= maxent.HEAD_WORDS).all() and (cls[rest] >= maxent.CLOSED).all() and (cls[: maxent.HEAD_WORDS] < maxent.CLOSED).all()
    assert len(set(zip(cls[: maxent.HEAD_WORDS], own[: maxent.HEAD_WORDS]))) == maxent.HEAD_WORDS
    for history in ([], [3], [700, 5], [1200, 4, 1]):
        before = np.array([*history, 0], int)
        row = m.history(maxent._symbols(hashes[before], shape[before], table), np.array([0, len(before)]))[-1:]
        classes = np.exp([maxent._log_softmax_at(maxent._scores(m.class_weights, row, m.class_bias), [k])[0] for k in range(maxent.CLASSES)])
        inner = np.stack([maxent._scores(m.place_weights, m.place_rows(row, np.array([k])), m.place_bias[[k]])[0] for k in range(maxent.CLASSES)])
        places = classes[:, None] * inner / inner.sum(1, keepdims=True)
        share = np.where(cls < maxent.CLOSED, 1.0, (counts + maxent.ADD) / m.mass[cls, own])
        unseen = (places / m.mass)[maxent.CLOSED :].sum() * maxent.ADD
        assert (places[cls, own] * share).sum() + unseen == pytest.approx(1, abs=1e-4)
    t = maxent.WordTable(hashes)
    assert (t.of(hashes) == np.arange(n)).all() and (t.of(hashes + np.uint64(1)) == -1).all()


def test_lm_learns_what_follows_rare_words(spark):
    """Held-out texts whose words are all but unpredictable alone, and known after the word before."""
    rng = random.Random(5)
    names = [f"{rng.randrange(1 << 30):x}{e}" for e in ("ing", "ed", "ly", "ness") for _ in range(300)]
    after = {w: rng.sample(names, 2) for w in names}
    rows = []
    for k in range(400):
        own = [rng.choice(names)]
        while len(own) < 120:
            own.append(rng.choice(after[own[-1]]))
        rows.append((k, " ".join(own)))
    got = [r for r in maxent.score_corpus(frame(spark, rows)).collect() if r.held_out]
    assert len(got) > 20 and sum(r.score for r in got) > sum(r.base_score for r in got) * 0.97


def test_url_rules(spark):
    page = "spark", "page_id long, url string, html string, host string, verdict string"
    link = '<html><link rel="canonical" href="%s">'
    rows = [
        (1, "https://A.Example.COM/de/x?q#f", "", "", ""),
        (2, "http://example.net/en/1", None, "", ""),
        (3, "http://sub.example.net/fr", "", "", ""),
        (4, "http://x.net", "", "", ""),
        (5, None, None, "", ""),
        (6, "no-scheme/de/", "", "", ""),
        (7, "http://clean.org/a", link % "http://bad.net/spam", "", ""),
        (8, "http://clean.org/b", "<meta http-equiv='refresh' content='0; url=http://clean.org/a'>", "", ""),
        (9, "http://ok.org/a", link % "http://other.org/fr/1", "", ""),
        (10, "http://ok.org/b", link % "http://ok.org/a", "", ""),
        (11, "http://notexample.com/de/", "", "", ""),
    ]
    redirects = spark.createDataFrame([("http://other.org/fr/1", "http://bad.net/2")], "src_url string, dst_url string")
    got = {r.page_id: r for r in urlrules.judge_urls(spark.createDataFrame(rows, page[1]), redirects).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.com", "/de/x", "example.com/de/", "block")
    assert {k: (r.rule, r.verdict) for k, r in got.items() if k > 1} == {
        2: ("example.net/en/", "allow"), 3: ("net/", "block"), 4: (None, "allow"), 5: (None, "allow"), 6: (None, "allow"), 7: (None, "block"),
        8: (None, "block"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"),
    }
    assert got[5].host == got[6].path == ""


def test_relative_links(spark):
    link = '<html><link rel="canonical" href="%s">'
    rows = [
        (1, "http://a.org/x/1?q=/z", link % "/de/x"),
        (2, "http://a.org/de/x", link % "//bad.net/y"),
        (3, "http://a.org/x/y/2", link % "../1?q=/z"),
        (4, "http://a.org/x/y/3", "<meta http-equiv=refresh content='0; url=2'>"),
        (5, "http://a.org/x/y/3?page=2", link % "3"),
        (6, "http://b.org/q", link % "go?to=http://bad.net/y"),
        (7, "http://b.org/r", link % "mailto:a@b?u=http://bad.net/y"),
        (8, "http://b.org/s", "<base href='//bad.net/t/'>" + link % "u"),
        (9, "no-scheme", link % "/de/x"),
        (10, "http://c.org", link % "."),
        (11, "http://c.org/", link % "//bad.net/y"),
    ]
    got = {r.page_id: r.verdict for r in urlrules.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {k for k, v in got.items() if v == "block"} == {1, 2, 3, 4, 5, 8, 10, 11}


def test_aliases_by_brute_force(spark):
    """Components over random links against a union-find over links that the standard library resolves."""
    from urllib.parse import urldefrag, urljoin

    rng = random.Random(11)
    hosts = ["a.org", "b.example.com", "bad.net", "c.io", "d.io", "e.io"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['fr/', 'de/', 'x/', ''])}{k}" for k in range(120)]
    links = {u: rng.choice([rng.choice(urls), "//bad.net/q", "../up", "side", "/fr/z", "?p=1", "./here#part"]) for u in urls if rng.random() < 0.5}
    pages = spark.createDataFrame([(k, u, f'<link href="{links[u]}" rel=canonical>' if u in links else "<p>") for k, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in urlrules.judge_urls(pages).collect()}

    def verdict(url):
        host, _, path = url.split("://")[1].partition("/")
        fits = [(len(h + p), a) for a, h, p in urlrules.RULES if (host == h or host.endswith("." + h)) and ("/" + path).startswith(p)]
        return max(fits)[1] if fits else None

    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, to in links.items():
        root[find(urldefrag(urljoin(u, to))[0])] = find(u)
    members = collections.defaultdict(set)
    for u in root:
        members[find(u)].add(verdict(u))
    for k, u in enumerate(urls):
        own = members[find(u)]
        assert got[k] == (verdict(u) or ("block" if "block" in own and "allow" not in own else "allow")), u


def test_decontamination_by_brute_force():
    """Every document against every item, by the plain edit distance: what is found, by length of item, at up to its full distance."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = [[word() for _ in range(n)] for n in (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 16, 18, 20, 25, 30, 40, 50, 60) for _ in range(12)]
    docs = []
    for item in items:
        passage = list(item)
        for at in sorted(rng.sample(range(len(item)), rng.choice([0, len(item) // 8, len(item) // 4])), reverse=True):
            passage[at : at + 1] = rng.choice([[], [word()], [passage[at], word()]])
        docs.append([word() for _ in range(30)] + passage + [word() for _ in range(30)])
    hashed, texts = decontaminate.item_words([" ".join(x) for x in items]), decontaminate.item_words([" ".join(x) for x in docs])
    search = decontaminate._search(decontaminate.Sampler(hashed), list(range(len(items))))
    found = {(row, item): distance for row, item, distance, _ in search(pa.array([" ".join(x) for x in docs]))}
    true = {}
    for i, item in enumerate(hashed):
        known = set(item.tolist())
        for d, text in enumerate(texts):
            if len(known & set(text.tolist())) >= len(known) - decontaminate.limit_of(len(item)):
                distance = decontaminate.best_alignment(item, text)[0]
                if distance <= decontaminate.limit_of(len(item)):
                    true[d, i] = distance
    assert set(found) <= set(true) and all(found[k] == true[k] for k in found)
    by_size = collections.Counter(len(items[i]) for _, i in true)
    missed = collections.Counter(len(items[i]) for _, i in set(true) - set(found))
    print("missed", dict(missed), "of", dict(by_size))
    assert sum(missed.values()) <= 0.03 * len(true) and not [n for n in missed if n < decontaminate.EXACT_WORDS]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert neardup.near_duplicates(none).count() == packing.pack_documents(none).count() == sharding.interleaved_shards(none).count() == 0
    assert tokencount.count_document_tokens(none).count() == linededup.dedup_lines(none).count() == decontaminate.decontaminate(none, bench).count() == 0
    assert passages.remove_repeats(none).count() == maxent.score_corpus(none).count() == 0
    assert quality.judge_quality(none, quality.fit_quality(none, labels)).count() == 0
    assert urlrules.judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rows = corpus(8, 80)
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, int(d % 9 > 0), 0) for d, _ in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, rows[1][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {"doc_id", "sequence_id", "offset"} <= set(got[0].asDict())
    assert {r.doc_id for r in got} <= {d for d, _ in rows} and all(r.doc_id != 1 for r in got)
    assert hashlib and len(corpus_pipeline.STAGES) == 5


def test_a_stage_begins_with_a_collected_heap(spark, tmp_path):
    """Heap that the stage before has grown is given back: a full collection, which small tables don't cause."""
    import corpus_pipeline

    def collections_of():
        beans = spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    docs = frame(spark, corpus(5, 5)).select("doc_id", "text")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "no such words here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        before = collections_of()
        stage(spark, docs, str(tmp_path)).count()
        assert collections_of() > before, name
