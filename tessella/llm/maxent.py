"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax (operator 1).

P(word | history) = P(class | history) * P(place | class, history) * P(word | place).  The most frequent words fill
CLOSED classes of CLASS_WORDS places, a word to a place; every other word, known or not, is in one of OPEN classes
chosen by its ending, at a place chosen by its hash, where its share is that of its count.  Both softmaxes add, to the
logarithm of the corpus counts, weights of hashed features of the history: the word before, the two before, and,
skipping, the second and the third before (for a place, the word before and the second).  Without weights the model is
the unigram model with 0.1 added to every count.

Classes gather words that follow the same words: k-means over what precedes them, counted in one pass.  Weights are
trained by distributed gradient updates: every task makes AdaGrad steps over its share of the training tokens,
and the tasks' changes to a row are averaged by the tokens that touched it.  What is broadcast has a fixed size:
the weights, and the counts of the TABLE_WORDS most frequent words.  The counts of all other words stay in a
distributed table that meets the documents' rare words in a join.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, table, tidy
from .words import U, Chunk, chunks, mix

CLOSED, CLASS_WORDS, OPEN = 16, 32, 16
CLASSES = CLOSED + OPEN
PLACE_SHIFT = 40
HEAD_WORDS = CLOSED * CLASS_WORDS
SHAPES, SHAPE_BYTES = 2048, 3
ROWS = 1 << 16
FEATURES = 4
#: of which the place within a class takes the word before and, skipping, the second before
PLACE_FEATURES = slice(0, 4, 2)
TABLE_WORDS = 1 << 18
PROFILE_WORDS = 64
COUNT_ROWS, SENT_ROWS = 1 << 17, 1 << 13
BATCH = 2048
RATE = 0.15
ROUNDS = 1
ADD = 0.1
END_HASH = U(0x1DE1E7ED5EED5EED)


def tokens_of(c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, shape, first): the words of each text and its end, in order; `first` as in Chunk.words."""
    start, end, first = c.words()
    h = c.span_hash(start, end)
    tail = c.span_hash(np.maximum(start, end - SHAPE_BYTES), end)
    shape = (tail % U(SHAPES)).astype(np.int64)
    at = first[1:]
    return np.insert(h, at, END_HASH), np.insert(shape, at, 0), first + np.arange(len(first))


class WordTable:
    """Index of each of a fixed set of hashes, -1 for any other: a few levels of direct addressing."""

    def __init__(self, hashes: np.ndarray):
        self.n, self.levels = len(hashes), []
        left = np.arange(self.n)
        size = 1 << max(4, int(4 * self.n).bit_length())
        shift = 0
        while len(left):
            at = ((hashes[left] >> U(shift)) & U(size - 1)).astype(np.int64)
            _, own = np.unique(at, return_index=True)
            index = np.full(size, -1, np.int32)
            index[at[own]] = left[own]
            key = np.zeros(size, np.uint64)
            key[at[own]] = hashes[left[own]]
            self.levels.append((shift, size, key, index))
            keep = np.ones(len(left), bool)
            keep[own] = False
            left = left[keep]
            shift += 11
            size = max(16, size // 4)

    def of(self, h: np.ndarray) -> np.ndarray:
        found = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        for shift, size, key, index in self.levels:
            at = ((h[todo] >> U(shift)) & U(size - 1)).astype(np.int64)
            hit = (key[at] == h[todo]) & (index[at] >= 0)
            found[todo[hit]] = index[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        return found


def _combined(word: np.ndarray, shape: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct word once, its counts summed."""
    order = np.argsort(word)
    word = word[order]
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else np.zeros(0, np.int64)
    return word[first], shape[order[first]], np.add.reduceat(n[order], first) if len(first) else n


def _count(batches):
    """The words of each batch; beside what is distinct in it, only a chunk's tokens are held at once."""
    for batch in batches:
        found = []
        for c in chunks(batch.column(0)):
            h, shape, _ = tokens_of(c)
            found.append(_combined(h, shape.astype(np.int32), np.ones(len(h), np.int64)))
            if sum(len(x[0]) for x in found[1:]) > COUNT_ROWS + len(found[0][0]):
                found = [_combined(*map(np.concatenate, zip(*found)))]
        if found:
            word, shape, n = _combined(*map(np.concatenate, zip(*found)))
            for at in range(0, len(word), COUNT_ROWS):
                part = slice(at, at + COUNT_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(word[part].view(np.int64)), pa.array(shape[part]), pa.array(n[part])], ["word", "shape", "n"])


def _summed(values: np.ndarray, width: int):
    """A task's dense sums as sparse rows (at, n)."""
    at = np.flatnonzero(values)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(values[at])], ["at", "n"])


def _symbols(h: np.ndarray, shape: np.ndarray, head: WordTable) -> np.ndarray:
    index = head.of(h)
    return np.where(index >= 0, index, HEAD_WORDS + shape)


def _profile(head_hashes: np.ndarray):
    """How often each symbol follows each of the most frequent words, or another."""

    def profile(batches):
        head = WordTable(head_hashes)
        sums = np.zeros((HEAD_WORDS + SHAPES) * (PROFILE_WORDS + 1), np.int64)
        for batch in batches:
            for c in chunks(batch.column(0)):
                h, shape, first = tokens_of(c)
                s = _symbols(h, shape, head)
                before = np.r_[PROFILE_WORDS, np.minimum(s[:-1], PROFILE_WORDS)] if len(s) else s
                sums += np.bincount(s * (PROFILE_WORDS + 1) + before, minlength=len(sums))
        yield _summed(sums, 0)

    return profile


def _clusters(x: np.ndarray, weight: np.ndarray, k: int, rounds: int = 25, seed: int = 1) -> np.ndarray:
    """Weighted k-means; rows without weight go to cluster 0."""
    label = np.zeros(len(x), np.int64)
    live = np.flatnonzero(weight > 0)
    if len(live) <= k:
        label[live] = np.arange(len(live))
        return label
    random = np.random.default_rng(seed)
    points, w = x[live], weight[live]
    centres = points[[int(w.argmax())]]
    while len(centres) < k:
        far = ((points[:, None] - centres[None]) ** 2).sum(2).min(1) * w
        far = far if far.sum() > 0 else w
        centres = np.vstack([centres, points[random.choice(len(points), p=far / far.sum())]])
    for _ in range(rounds):
        own = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        for j in range(k):
            if (mine := own == j).any():
                centres[j] = np.average(points[mine], axis=0, weights=w[mine])
    label[live] = own
    return label


class Model:
    """Everything of fixed size: classes, corpus counts of the frequent words, and weights."""

    def __init__(self, head_hashes, head_counts, label_of_head, class_of_shape, open_mass, total, vocabulary):
        self.head_hashes, self.total, self.vocabulary = head_hashes, total, vocabulary
        #: class and place in it of each head word
        order = np.lexsort((-head_counts, label_of_head))
        self.head_class, self.head_place = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        self.head_class[order] = np.arange(len(order)) // CLASS_WORDS
        self.head_place[order] = np.arange(len(order)) % CLASS_WORDS
        self.class_of_shape = CLOSED + class_of_shape
        #: counts, with what is added, of each place; those of open classes keep room for words never seen
        self.mass = np.zeros((CLASSES, CLASS_WORDS))
        self.mass[self.head_class, self.head_place] = head_counts + ADD
        self.mass[CLOSED:] = open_mass + ADD
        whole = self.mass.sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.place_bias = np.where(self.mass > 0, np.log(self.mass / whole[:, None]), -1e9).astype(np.float32)
            self.class_bias = np.where(whole > 0, np.log(whole / whole.sum()), -1e9).astype(np.float32)
        self.class_weights = np.zeros((ROWS, CLASSES), np.float32)
        self.place_weights = np.zeros((ROWS, CLASS_WORDS), np.float32)

    def history(self, s: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Feature rows of each token, from the symbols before it in its text."""
        n = len(s)
        rank = np.arange(n) - np.repeat(first[:-1], np.diff(first))
        nothing = HEAD_WORDS + SHAPES
        b = [np.where(rank >= k, np.r_[np.zeros(k, np.int64), s[: n - k]][:n], nothing).astype(np.uint64) for k in (1, 2, 3)]
        keys = (b[0] * U(4), (b[0] * U(4096) + b[1]) * U(4) + U(1), b[1] * U(4) + U(2), b[2] * U(4) + U(3))
        return np.stack([(mix(k + U(77)) & U(ROWS - 1)).astype(np.uint16) for k in keys], 1)

    def places(self, h: np.ndarray, s: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, place in it) of each token."""
        cls, place = self.class_of_shape[shape], ((h >> U(PLACE_SHIFT)) & U(CLASS_WORDS - 1)).astype(np.int64)
        closed = np.flatnonzero(s < HEAD_WORDS)
        cls[closed], place[closed] = self.head_class[s[closed]], self.head_place[s[closed]]
        return cls, place

    @staticmethod
    def place_rows(features: np.ndarray, cls: np.ndarray) -> np.ndarray:
        return (features[:, PLACE_FEATURES] * np.uint16(31) + (cls * 1009).astype(np.uint16)[:, None]) & np.uint16(ROWS - 1)


def _scores(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Exponents of both softmaxes' terms; biases are logarithms of shares, so only weights could make them large."""
    total = weights.take(rows[:, 0], 0) + bias
    for k in range(1, rows.shape[1]):
        total += weights.take(rows[:, k], 0)
    return np.exp(np.minimum(total, 80, out=total), out=total)


def _log_softmax_at(z: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(z[np.arange(len(z)), at], 1e-37) / (z @ np.ones(z.shape[1], np.float32)))


class Trainer:
    """AdaGrad steps on both softmaxes, with one step size for a row of weights."""

    def __init__(self, model: Model):
        self.model = model
        self.weights = [model.class_weights.copy(), model.place_weights.copy()]
        self.squares = [np.full(ROWS, 1.0, np.float32) for _ in self.weights]
        self.touched = [np.zeros(ROWS, np.int64) for _ in self.weights]

    def _step(self, k: int, rows: np.ndarray, bias: np.ndarray, target: np.ndarray) -> None:
        w, h = self.weights[k], self.squares[k]
        z = _scores(w, rows, bias)
        z /= (z @ np.ones(z.shape[1], np.float32))[:, None]
        z[np.arange(len(z)), target] -= 1
        flat = rows.ravel()
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        head = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        gradient = np.add.reduceat(z.take(order // rows.shape[1], 0), head, axis=0)
        at = ordered[head]
        h[at] += np.einsum("ij,ij->i", gradient, gradient) / gradient.shape[1]
        gradient *= (RATE / np.sqrt(h[at]))[:, None]
        w[at] -= gradient
        self.touched[k] += np.bincount(flat, minlength=ROWS)

    def learn(self, h: np.ndarray, shape: np.ndarray, first: np.ndarray, head: WordTable) -> None:
        m = self.model
        s = _symbols(h, shape, head)
        rows, (cls, place) = m.history(s, first), m.places(h, s, shape)
        for b in range(0, len(s), BATCH):
            r, c, p = rows[b : b + BATCH], cls[b : b + BATCH], place[b : b + BATCH]
            self._step(0, r, m.class_bias, c)
            self._step(1, m.place_rows(r, c), m.place_bias[c], p)


def _train(shared):
    names = ["at", "n", *(f"w{k}" for k in range(CLASSES))]

    def train(batches):
        model = shared.value
        trainer, head = Trainer(model), WordTable(model.head_hashes)
        for batch in batches:
            for c in chunks(batch.column(0)):
                trainer.learn(*tokens_of(c), head)
        for k, start in enumerate((model.class_weights, model.place_weights)):
            touched = np.flatnonzero(trainer.touched[k])
            for b in range(0, len(touched), SENT_ROWS):
                at = touched[b : b + SENT_ROWS]
                change = (trainer.weights[k][at] - start[at]) * trainer.touched[k][at, None].astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at + k * ROWS), pa.array(trainer.touched[k][at]), *(pa.array(change[:, j]) for j in range(CLASSES))], names
                )

    return train


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, shape, n) of the tokens of `texts` (text); word is a 64-bit hash."""
    return materialise(
        texts.mapInArrow(tidy(_count), "word long, shape int, n long").groupBy("word", "shape").agg(F.sum("n").alias("n")), "word-counts"
    )


def train(texts: DataFrame, counts: DataFrame, rounds: int = ROUNDS) -> Model:
    """A model of `texts` (text), whose word counts are `counts`."""
    total, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    head = counts.orderBy(F.desc("n"), "word").limit(HEAD_WORDS).toPandas()
    hashes = head["word"].to_numpy(np.int64).view(np.uint64)
    head_counts = head["n"].to_numpy(float)
    width = PROFILE_WORDS + 1
    found = texts.mapInArrow(tidy(_profile(hashes)), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    profile = np.zeros((HEAD_WORDS + SHAPES) * width)
    profile[found["at"].to_numpy(np.int64)] = found["n"]
    profile = profile.reshape(-1, width)
    weight = profile.sum(1)
    points = np.sqrt(profile / np.maximum(weight, 1)[:, None])
    label_of_head = _clusters(points[:HEAD_WORDS], weight[:HEAD_WORDS], CLOSED)[: len(hashes)]
    class_of_shape = _clusters(points[HEAD_WORDS:], weight[HEAD_WORDS:], OPEN)
    others = counts.join(F.broadcast(counts.sparkSession.createDataFrame(head[["word"]], "word long")), "word", "left_anti")
    place = F.shiftrightunsigned("word", PLACE_SHIFT).bitwiseAND(F.lit(CLASS_WORDS - 1)).alias("place")
    # One row a shape and place, at most SHAPES * CLASS_WORDS.
    places = others.groupBy("shape", place).agg(F.sum(F.col("n") + ADD).alias("mass")).toArrow()
    shape, place, added = (places[c].to_numpy() for c in ("shape", "place", "mass"))
    mass = np.zeros((OPEN, CLASS_WORDS))
    np.add.at(mass, (class_of_shape[shape], place), added)
    model = Model(hashes, head_counts, label_of_head, class_of_shape, mass, int(total), int(vocabulary))
    for _ in range(rounds):
        shared = texts.sparkSession.sparkContext.broadcast(model)
        schema = "at long, n long, " + ", ".join(f"w{k} float" for k in range(CLASSES))
        means = ((F.sum(f"w{k}") / F.sum("n")).cast("float").alias(f"w{k}") for k in range(CLASSES))
        # Dealt before they are summed: a task has each row once, so sums ahead of the shuffle would only widen it.
        changes = texts.mapInArrow(tidy(_train(shared)), schema).repartition("at").groupBy("at").agg(*means).toArrow()
        shared.unpersist()
        at, change = changes["at"].to_numpy(), np.stack([changes[f"w{k}"].to_numpy() for k in range(CLASSES)], 1)
        model.class_weights[at[at < ROWS]] += change[at < ROWS]
        model.place_weights[at[at >= ROWS] - ROWS] += change[at >= ROWS]
    return model


def _score(shared):
    """Per text: what the model and the frequent words' counts give, and the words that only the count table knows."""
    names = ["row", "doc_id", "n_tokens", "known", "base", "score", "rare", "times"]

    def score(batches):
        model, table_hashes, table_counts = shared.value
        head, known = WordTable(model.head_hashes), WordTable(table_hashes)
        row = TaskContext.get().partitionId() << 40
        whole = np.log10(model.total + ADD * (model.vocabulary + 1))
        log_mass = np.log10(np.maximum(model.mass, 1e-300))
        for batch in batches:
            out = []
            for c in chunks(batch.column(1)):
                h, shape, first = tokens_of(c)
                s = _symbols(h, shape, head)
                rows, (cls, place) = model.history(s, first), model.places(h, s, shape)
                log_p = np.empty(len(s))
                for b in range(0, len(s), BATCH):
                    r, k, p = rows[b : b + BATCH], cls[b : b + BATCH], place[b : b + BATCH]
                    log_p[b : b + BATCH] = _log_softmax_at(_scores(model.class_weights, r, model.class_bias), k)
                    log_p[b : b + BATCH] += _log_softmax_at(_scores(model.place_weights, model.place_rows(r, k), model.place_bias[k]), p)
                index = known.of(h)
                frequent = index >= 0
                log_count = np.where(frequent, np.log10(table_counts[np.maximum(index, 0)] + ADD) if len(table_counts) else 0.0, 0.0)
                log10_p = log_p / np.log(10) + np.where(cls < CLOSED, 0.0, log_count - log_mass[cls, place])
                owner = np.repeat(np.arange(c.n), np.diff(first))
                sums = [np.bincount(owner, x, c.n) for x in (frequent, log_count - whole, log10_p)]
                at = np.flatnonzero(~frequent)
                at = at[np.lexsort((h[at], owner[at]))]
                new = np.r_[True, (h[at][1:] != h[at][:-1]) | (owner[at][1:] != owner[at][:-1])] if len(at) else np.zeros(0, bool)
                begin = np.flatnonzero(new)
                times = np.diff(np.r_[begin, len(at)])
                cuts = np.searchsorted(owner[at][begin], np.arange(c.n + 1))
                out.append((np.diff(first), *sums, h[at][begin], times, np.diff(cuts)))
            if out:
                n, hits, base, total, rare, times, per = (np.concatenate(x) for x in zip(*out))
                cuts = pa.array(np.r_[0, np.cumsum(per)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(len(n))),
                        batch.column(0),
                        pa.array(n, pa.int64()),
                        pa.array(hits.astype(np.int64)),
                        pa.array(base),
                        pa.array(total),
                        pa.ListArray.from_arrays(cuts, pa.array(rare.view(np.int64))),
                        pa.ListArray.from_arrays(cuts, pa.array(times, pa.int32())),
                    ],
                    names,
                )
                row += len(n)

    return score


def score_documents(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    # The frequent words are those above a count that at most TABLE_WORDS words reach.
    level = F.floor(F.log2("n") * 32)
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).toPandas().sort_values("level", ascending=False)
    fitting = levels["level"][levels["words"].cumsum() <= TABLE_WORDS]
    least = int(fitting.min()) if len(fitting) else 1 << 30
    frequent = counts.where(level >= least).select("word", "n").toPandas().sort_values("word")
    hashes = frequent["word"].to_numpy(np.int64).view(np.uint64)
    shared = spark.sparkContext.broadcast((model, hashes, frequent["n"].to_numpy(float)))
    schema = "row long, doc_id long, n_tokens long, known long, base double, score double, rare array<long>, times array<int>"
    scored = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(_score(shared)), schema), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("it")).select("row", F.col("it.rare").alias("word"), F.col("it.times").alias("times"))
    log_count = F.log10(F.coalesce("n", F.lit(0)) + ADD)
    sums = (
        rare.join(counts.select("word", "n"), "word", "left")
        .groupBy("row")
        .agg(F.sum(F.col("times") * log_count).alias("rare_log"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"))
    )
    added = F.coalesce("rare_log", F.lit(0.0))
    return scored.drop("rare", "times").join(sums, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        (F.col("base") + added).alias("base_score"),
        (F.col("score") + added).alias("score"),
    )


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def score_corpus(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Train on the rows of `docs` (doc_id, text) that aren't held out, and score all.

    A row is held out if crc32 of its doc_id's digits is divisible by ten (a null doc_id: of no digits, so it is).  A
    null or empty text is the end token alone; texts are read whole; repeated rows count and are scored each; without
    training rows every token has probability one in the base and the model is uniform over classes; an empty table
    gives an empty one; other columns are ignored.
    """
    learning = docs.where(~held_out(docs["doc_id"])).select(F.col("text").cast("string").alias("text"))
    counts = word_counts(learning)
    model = train(learning, counts, rounds)
    scored = score_documents(docs, model, counts)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op1_lm_scoring(spark, sf_dir):
    return score_corpus(table(spark, sf_dir, "documents"))
