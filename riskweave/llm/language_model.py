"""Scoring texts with a log-bilinear neural model trained with noise-contrastive estimation.

Words are runs of characters other than ASCII white space, A-Z lower-cased; every text ends with one
end token. Documents whose crc32(doc_id as text) modulo ``FOLDS`` is 0 are held out; the others are
learned from.

1. All training words are counted as 64-bit hashes, merged in slices, tasks and then by a shuffle. The
   base is the smoothed share p0(w) = (c + 0.1) / (N + 0.1 (V + 1)); its last place is for all words
   never seen.
2. The ``CLASSES`` - 2 most frequent words are classes of their own, as is the end; all others are one
   class. A token's class is predicted from the classes of the two tokens before it: score
   s = (r[c1] C1 + r[c2] C2) . q[w] + b[w], with b starting at the class's log share.
3. Training passes over all training tokens ``PASSES`` times, whatever the table's size. In each of
   ``ROUNDS`` rounds, trainers (a task each) go on from the same state, over their documents of that
   round, and their states are averaged by tokens. Noise words of a minibatch are shared, so gradients
   are matrix products.
4. A token's probability is softmax(s) at its class times p0(word) / p0(class), so probabilities of all
   known words, the end and the one place for unknown words add up to one. Products r C1 q and r C2 q
   are tables over classes; the normaliser of a pair of context classes is a row of a batched matrix
   product, computed once a worker.
5. Counts of up to ``SENT`` frequent words are sent to the tasks; occurrences of other words meet their
   counts in a shuffled join.

Equal texts have equal scores. Null and empty texts are the end token alone. A null doc_id is held out.
Repeated rows count as often as they come. Without training documents N and V are 0 and every token has
p0 = 1. An empty table gives no rows. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import prepare, slices
from riskweave.llm.shingles import words
from riskweave.session import materialise

FOLDS = 10
SMOOTH = 0.1
CLASSES = 1_024
SIZE = 32
NOISE = 64
BATCH = 4_096
#: Tokens of a step of training.
STEP = 1_024
RATE = 0.05
ROUNDS = 4
#: How often a round goes over its documents.
PASSES = 1
#: A trainer has so many tokens a round, if there are; no more trainers than TRAINERS.
TRAINER = 250_000
TRAINERS = 256
#: Frequent words whose counts are sent to the tasks.
SENT = 200_000
#: Bytes of text hashed at a time; distinct words a task merges before it hands them on.
HASHED = 4 << 20
MERGED = 1_000_000
#: Hash that stands for the end, and its class; the class of all words that have none of their own.
END = np.uint64(0x9E3779B97F4A7C15)
END_CLASS, REST_CLASS = 0, 1
KINDS = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, rare array<long>, classes binary"


def is_held_out(column: pa.Array) -> np.ndarray:
    """By crc32 of the decimal doc_id; a null one is held out."""
    return np.array([i is None or zlib.crc32(str(i).encode()) % FOLDS == 0 for i in column.to_pylist()], bool)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of each text's tokens, their hashes), the end token included."""
    offsets, hashes = words(column)
    return offsets + np.arange(len(offsets)), np.insert(hashes, offsets[1:], END)


def counted(docs: DataFrame) -> DataFrame:
    """(word, c): training tokens by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            word, place = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
            return word, np.bincount(place, np.concatenate([c for _, c in held])).astype(np.int64)

        def out(word: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(word.view(np.int64)), "c": pa.array(count)})

        for batch in slices(batches, size=HASHED):
            learned = batch.filter(pa.array(~is_held_out(batch["doc_id"])))
            if learned.num_rows:
                held.append(np.unique(tokens(learned["text"])[1], return_counts=True))
            if sum(len(w) for w, _ in held) > MERGED:
                held = [merged()]
                if len(held[0][0]) > MERGED // 2:
                    yield out(*held.pop())
        if held:
            yield out(*merged())

    rows = docs.mapInArrow(run, "word long, c long")
    return materialise(rows.groupBy("word").agg(F.sum("c").alias("c")))


def frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(sorted hashes, counts) of the most frequent words, ``SENT`` at most: all above some count."""
    step = F.floor(8 * F.log2("c")).alias("step")
    room, least = SENT, None
    for r in counts.groupBy(step).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect():  # 500 rows or so
        room -= r.n
        if room < 0:
            break
        least = r.step
    found = counts.filter(F.floor(8 * F.log2("c")) >= least) if least is not None else counts.limit(0)
    table = found.toArrow()
    word, count = table["word"].to_numpy().view(np.uint64), table["c"].to_numpy()
    order = np.argsort(word)
    return word[order], count[order]


class Base:
    """Smoothed shares of words, and the classes: what the tasks are sent."""

    def __init__(self, word: np.ndarray, count: np.ndarray, total: int, kinds: int):
        self.word, self.total = word, total
        self.below = np.log10(total + SMOOTH * (kinds + 1)) if total else np.log10(SMOOTH)
        self.count = count
        own = np.lexsort((word, -count))
        own = own[word[own] != END][: CLASSES - 2]
        self.place = np.full(len(word), REST_CLASS, np.uint16)
        self.place[own] = 2 + np.arange(len(own))
        self.place[word == END] = END_CLASS
        share = np.bincount(self.place, (count + SMOOTH) / 10**self.below, CLASSES) if total else np.zeros(CLASSES)
        share[REST_CLASS] = 0
        share[REST_CLASS] = max(1 - share.sum(), 1e-12) if total else 1
        #: log10 of each class's share; classes without words have none and are never predicted.
        self.mass = np.log10(share, out=np.full(CLASSES, -np.inf), where=share > 0)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count or -1, class) of tokens; -1 where the word was not sent."""
        if not len(self.word):
            return np.full(len(hashes), -1), np.full(len(hashes), REST_CLASS, np.uint16)
        at = np.searchsorted(self.word, hashes)
        at[at == len(self.word)] = 0
        met = self.word[at] == hashes
        return np.where(met, self.count[at], -1), np.where(met, self.place[at], np.uint16(REST_CLASS))

    def log_share(self, count):
        return np.log10(count + SMOOTH) - self.below


def encoded(docs: DataFrame, base: Base) -> DataFrame:
    """``KINDS``: what the sent counts tell of each text, its other words, its tokens' classes in two bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, size=HASHED):
            offsets, hashes = tokens(batch["text"])
            count, place = base.look_up(hashes)
            met = count >= 0
            sums = np.concatenate(([0], np.cumsum(np.where(met, base.log_share(np.maximum(count, 0)), 0))))
            known = np.concatenate(([0], np.cumsum(met)))
            rare = np.concatenate(([0], np.cumsum(~met)))[offsets]
            data = place.astype("<u2").tobytes()
            cuts = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict({
                "row": pa.array(np.arange(row, row + n)), "doc_id": batch["doc_id"].cast(pa.int64()),
                "held_out": pa.array(is_held_out(batch["doc_id"])), "n_tokens": pa.array(np.diff(offsets)),
                "n_known": pa.array(np.diff(known[offsets])), "base": pa.array(np.diff(sums[offsets])),
                "rare": pa.ListArray.from_arrays(pa.array(rare.astype(np.int32)), pa.array(hashes[~met].view(np.int64))),
                "classes": pa.array([data[2 * a : 2 * b] for a, b in cuts], pa.binary()),
            })
            row += n

    return materialise(docs.mapInArrow(run, KINDS))


class Model:
    """The log-bilinear model: parameters and their squared gradients, as one vector of numbers."""

    SHAPES = [(CLASSES, SIZE), (CLASSES, SIZE), (SIZE, SIZE), (SIZE, SIZE), (CLASSES,)]

    def __init__(self, state: np.ndarray):
        self.state = state
        parts, at = [], 0
        for shape in self.SHAPES * 2:
            size = int(np.prod(shape))
            parts.append(state[at : at + size].reshape(shape))
            at += size
        self.r, self.q, self.c1, self.c2, self.b = parts[:5]
        self.squares = parts[5:]

    @classmethod
    def fresh(cls, mass: np.ndarray) -> Model:
        source = np.random.default_rng(20_240_611)
        model = cls(np.zeros(2 * sum(int(np.prod(s)) for s in cls.SHAPES), np.float32))
        model.r[:] = source.normal(0, 0.3, model.r.shape)
        model.c1[:], model.c2[:] = np.eye(SIZE), np.eye(SIZE) * 0.5
        # q starts at zero: at first every context predicts the classes' shares.
        model.b[:] = np.where(np.isfinite(mass), mass * np.log(10), -100)
        for square in model.squares:
            square[:] = 1e-3
        return model

    def learn(self, word: np.ndarray, c1: np.ndarray, c2: np.ndarray, noise: np.ndarray, log_noise: np.ndarray) -> None:
        """One step of noise-contrastive estimation on a minibatch; ``log_noise``: log(NOISE x share) by class."""
        r1, r2 = self.r[c1], self.r[c2]
        guess = r1 @ self.c1 + r2 @ self.c2
        q, qn = self.q[word], self.q[noise]
        data = 1 / (1 + np.exp(np.einsum("ij,ij->i", guess, q) + self.b[word] - log_noise[word]))
        fake = -1 / (1 + np.exp(-(guess @ qn.T + self.b[noise] - log_noise[noise])))
        back = data[:, None] * q + fake @ qn
        slopes = [np.zeros_like(x) for x in (self.r, self.q)]
        scatter(slopes[0], np.concatenate((c1, c2)), np.concatenate((back @ self.c1.T, back @ self.c2.T)))
        scatter(slopes[1], np.concatenate((word, noise)), np.concatenate((data[:, None] * guess, fake.T @ guess)))
        bias = np.bincount(word, data, CLASSES) + np.bincount(noise, fake.sum(0), CLASSES)
        slopes += [r1.T @ back, r2.T @ back, bias.astype(np.float32)]
        for value, square, slope in zip((self.r, self.q, self.c1, self.c2, self.b), self.squares, slopes, strict=True):
            slope /= len(word)
            square += slope * slope
            value += RATE * slope / np.sqrt(square)


def scatter(target: np.ndarray, index: np.ndarray, rows: np.ndarray) -> None:
    """Add rows to the target's rows named by ``index``."""
    order = np.argsort(index, kind="stable")
    at = index[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    target[at[first]] += np.add.reduceat(rows[order], first, axis=0)


def contexts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, class, class before, class before that) of the tokens of encoded texts; ends stand before a text."""
    bounds = np.concatenate(([0], np.cumsum(pc.binary_length(column).to_numpy(False).astype(np.int64) // 2)))
    word = np.frombuffer(b"".join(column.to_pylist()), "<u2").astype(np.int64)
    c1 = np.concatenate(([END_CLASS], word[:-1]))[: len(word)]
    c1[bounds[:-1]] = END_CLASS
    c2 = np.concatenate(([END_CLASS], c1[:-1]))[: len(word)]
    c2[bounds[:-1]] = END_CLASS
    return bounds, word, c1, c2


def trained(rows: DataFrame, mass: np.ndarray, total: int) -> Model:
    """The model after ``ROUNDS`` rounds, each over its share of the training documents."""
    model = Model.fresh(mass)
    share = np.where(np.isfinite(mass), 10.0**mass, 0)
    edges = np.cumsum(share) / share.sum()
    log_noise = np.log(NOISE * np.maximum(share / share.sum(), 1e-30)).astype(np.float32)
    trainers = int(max(1, min(TRAINERS, total // ROUNDS // TRAINER)))
    learned = rows.filter("not held_out")
    segment = 1 << 14
    for turn in range(ROUNDS if total else 0):
        state = model.state

        def run(batches: Iterator[pa.RecordBatch], state=state, turn=turn) -> Iterator[pa.RecordBatch]:
            own, met = Model(state.copy()), 0
            source = np.random.default_rng([turn, TaskContext.get().partitionId()])
            for batch in batches:
                _, word, c1, c2 = contexts(batch["classes"])
                for _ in range(PASSES):
                    order = source.permutation(len(word))
                    for begin in range(0, len(word), STEP):
                        at = order[begin : begin + STEP]
                        noise = np.minimum(np.searchsorted(edges, source.random(NOISE), "right"), CLASSES - 1)
                        own.learn(word[at], c1[at], c2[at], noise, log_noise)
                    met += len(word)
            if met:
                values = np.append(own.state.astype(np.float64) * met, met)
                cuts = range(0, len(values), segment)
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array(range(len(cuts)), pa.int64()),
                    "sums": pa.array([values[k : k + segment].tobytes() for k in cuts], pa.binary()),
                })

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {}
            for batch in batches:
                for k, raw in zip(batch["segment"].to_pylist(), batch["sums"].to_pylist(), strict=True):
                    sums[k] = sums.get(k, 0) + np.frombuffer(raw)
            yield pa.RecordBatch.from_pydict({
                "segment": pa.array(list(sums), pa.int64()), "sums": pa.array([v.tobytes() for v in sums.values()], pa.binary())
            })

        share_of = learned.filter(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == turn).select("classes")
        kind = "segment long, sums binary"
        states = share_of.coalesce(trainers).mapInArrow(run, kind)
        sums = states.repartition("segment").mapInArrow(add, kind).collect()  # the size of one state
        if sums:
            values = np.concatenate([np.frombuffer(r["sums"]) for r in sorted(sums)])
            model = Model((values[:-1] / values[-1]).astype(np.float32))
    return model


class Scorer:
    """Normalised log10 probabilities of classes after two others."""

    def __init__(self, model: Model):
        self.after1, self.after2 = (model.r @ c @ model.q.T for c in (model.c1, model.c2))
        self.bias = model.b
        self.whole = np.full(CLASSES * CLASSES, np.nan, np.float32)

    def __call__(self, word: np.ndarray, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        pair = c1 * CLASSES + c2
        met = np.zeros(len(self.whole), bool)
        met[pair] = True
        new = np.flatnonzero(met & np.isnan(self.whole))
        for begin in range(0, len(new), BATCH):
            at = new[begin : begin + BATCH]
            scores = self.after1[at // CLASSES] + self.after2[at % CLASSES] + self.bias
            top = scores.max(1)
            self.whole[at] = top + np.log(np.exp(scores - top[:, None]).sum(1))
        chosen = self.after1[c1, word] + self.after2[c2, word] + self.bias[word]
        return (chosen.astype(np.float64) - self.whole[pair]) / np.log(10)


def gains(rows: DataFrame, model: Model, mass: np.ndarray) -> DataFrame:
    """(row, gain): how much likelier than by shares alone the model holds a text's classes, in log10."""
    state = model.state

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(state))
        for batch in slices(batches, "classes", HASHED):
            offsets, word, c1, c2 = contexts(batch["classes"])
            sums = np.concatenate(([0], np.cumsum(scorer(word, c1, c2) - mass[word])))
            columns = {c: batch[c] for c in batch.schema.names if c != "classes"}
            yield pa.RecordBatch.from_pydict(columns | {"gain": pa.array(np.diff(sums[offsets]))})

    kinds = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, gain double"
    names = [k.split()[0] for k in kinds.split(", ")]
    return rows.select(*names[:-1], "classes").mapInArrow(run, kinds)


def score(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    prepare(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    counts = counted(docs)
    kinds, total = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    base = Base(*frequent(counts), total, kinds)
    rows = encoded(docs, base)
    told = gains(rows, trained(rows, base.mass, total), base.mass)
    # Words whose counts were not sent meet them here; none of them is frequent.
    rare = rows.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("n"))
    rare = rare.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    share = F.log10(F.col("c") + SMOOTH) - float(base.below)
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * share).alias("rest")
    )
    base_score = F.col("base") + F.coalesce("rest", F.lit(0.0))
    return told.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base_score.alias("base_score"), (base_score + F.col("gain")).alias("score"),
    )
