"""Toxicity by follow-the-regularised-leader (FTRL-proximal) logistic regression over hashed word n-grams.

Features of a text are its different words, word pairs and pairs with one or two words between them, hashed into a fixed
number of coordinates. Each coordinate has its own learning rate and an L1 penalty, so that nearly all weights end at
exactly zero; the rest, a few thousand numbers, are what the scoring tasks get.

Learning takes a sample of labelled rows, about ``SAMPLE_ROWS`` of them and chosen by a hash of their ids, however many
there are. The sample is dealt to ``LEARNERS`` tasks that learn side by side; their states are averaged over every coordinate
that one of them has touched, whether it has a weight yet or not, and handed on, for ``ROUNDS`` rounds. What travels is the
change since the round began, in ranges of ``RANGE`` coordinates. The averaging runs in Spark and what reaches the driver is
bounded by ``DIMENSIONS``. Scoring is one pass over all whole texts without a shuffle.

Edge cases: a null or empty text has no feature and scores the learned intercept. Labels that are null, or whose id is
null, teach nothing. Without any label every score is 1/11. An id whose labels contradict each other teaches their mean,
and one that is there several times, however often, teaches once, by the text whose coordinates as stored come first as bytes.
Thus a repeated id makes neither the sample nor a learner's share larger. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import words
from sluice.session import scratch_folder, through_table

DIMENSIONS = 1 << 22
#: Coordinates of a range, so that a place in one has 16 bits.
RANGE = 1 << 16
#: What stands for a step of so many coordinates without one.
FAR = 0xFFFF
#: Expected size of the sample that the model is learned from.
SAMPLE_ROWS = 10_000
LEARNERS = 4
ROUNDS = 4
EPOCHS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.0, 1.0
FOLDS = 5
#: Setting by which a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def held_out(key: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text leaves no remainder."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _every_feature(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Coordinate and text of every n-gram and skip-gram, with repeats."""
    data, at = words.buffer(texts)
    data = words.LOWER[data]
    starts, ends, first = words.spans(data, at, words.LETTERS)
    word, text = words.hashes(data, starts, ends), words.of_text(first)
    codes, of = [word], [text]
    for gap in (1, 2, 3):
        near = text[gap:] == text[:-gap]
        codes.append(words.mixed(word[:-gap] * np.uint64(2 * gap + 1) + word[gap:] * np.uint64(words.BASE))[near])
        of.append(text[gap:][near])
    return (np.concatenate(codes) % np.uint64(DIMENSIONS)).astype(np.int32), np.concatenate(of), len(at) - 1


def features(texts: pa.Array) -> list[np.ndarray]:
    """The different coordinates of each text."""
    code, text, n = _every_feature(texts)
    code, begin = words.distinct_per_text(code, text, n)
    return [code[begin[k] : begin[k + 1]] for k in range(n)]


def stored_ids(codes: np.ndarray) -> bytes:
    """Ordered coordinates as 16-bit steps, half the size of the numbers themselves."""
    far, near = np.divmod(np.diff(codes, prepend=0), FAR)
    out = np.full(len(codes) + int(far.sum()), FAR, "<u2")
    out[np.arange(len(codes)) + np.cumsum(far)] = near
    return out.tobytes()


def read_ids(raw: bytes) -> np.ndarray:
    """The coordinates again."""
    steps = np.frombuffer(raw, "<u2")
    return np.cumsum(steps, dtype=np.int32)[steps != FAR]


def packed(z: np.ndarray, n: np.ndarray) -> bytes:
    """A range's numbers without loss: which coordinates have any, and the different pairs, of which words of one text
    share one."""
    met = np.zeros(RANGE, bool)
    met[: len(z)] = (z != 0) | (n != 0)
    at = np.flatnonzero(met)
    pairs, code = np.unique(np.stack([z[at], n[at]], axis=1).astype(np.float32).view(np.uint64).ravel(), return_inverse=True)
    return np.packbits(met).tobytes() + code.astype("<u2").tobytes() + pairs.tobytes()


def unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the range and their numbers."""
    at = np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8, RANGE // 8)))
    code = np.frombuffer(raw, "<u2", len(at), RANGE // 8)
    pairs = np.frombuffer(raw, np.float32, offset=RANGE // 8 + 2 * len(at)).reshape(-1, 2)[code]
    return at, pairs[:, 0], pairs[:, 1]


class Ftrl:
    """State of the learner: for each coordinate the adjusted sum of gradients and the sum of their squares."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    @classmethod
    def fresh(cls) -> Ftrl:
        return cls(np.zeros(DIMENSIONS + 1, np.float32), np.zeros(DIMENSIONS + 1, np.float32))

    def ranges(self) -> Iterator[tuple[int, bytes]]:
        """Number and packed content of each range that has any."""
        for k in range(0, DIMENSIONS + 1, RANGE):
            z, n = self.z[k : k + RANGE], self.n[k : k + RANGE]
            if z.any() or n.any():
                yield k // RANGE, packed(z, n)

    def add(self, k: int, raw: bytes, share: int = 1) -> None:
        at, z, n = unpacked(raw)
        self.z[k * RANGE + at] += z / np.float32(share)
        self.n[k * RANGE + at] += n / np.float32(share)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        penalty = np.where(at == DIMENSIONS, np.float32(0), np.float32(L1))  # the intercept is free
        return np.where(np.abs(z) <= penalty, 0, -(z - np.sign(z) * penalty) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        old = self.n[at]
        new = old + gradient * gradient
        self.z[at] += gradient - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
        self.n[at] = new


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", sample: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Coordinates and weights that are not zero, and the intercept."""
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out("id"))
    usable = known.groupBy("id").agg(F.avg("y").alias("y"))
    there = usable.count()
    if not there:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), float(np.log(0.1))
    # Bounded by the parameter, so it can go to every task.
    chosen = F.broadcast(usable.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(there)) < sample))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(chosen, "id").select("id", "y", "text")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for part in words.slices(batch.column(2)):
                ids = [stored_ids(x) for x in features(part)]
                own = batch.slice(done, len(part))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(ids, pa.binary())], ["id", "y", "ids"])
                done += len(part)

    kind = docs.schema[key].dataType.simpleString()
    # Ids alone are read to find those that are there again; features are shuffled for these only.
    met = docs.select(F.col(key).alias("id")).join(chosen.select("id"), "id").groupBy("id").agg(F.count("*").alias("rows"))
    again = F.broadcast(through_table(met.where("rows > 1").select("id"), scratch_folder(spark, "repeated")))
    columns = f"id {kind}, y double, ids binary"
    once = rows.join(again, "id", "left_anti").select("id", "y", "text").mapInArrow(described, columns)
    if not again.isEmpty():
        several = rows.join(again, "id", "left_semi").select("id", "y", "text").mapInArrow(described, columns)
        once = once.unionByName(several.groupBy("id").agg(F.min("y").alias("y"), F.min("ids").alias("ids")))
    once = once.withColumns({"learner": F.pmod(F.xxhash64("id", F.lit(11)), F.lit(LEARNERS)).cast("int"), "turn": F.xxhash64("id", F.lit(13))})
    stored = through_table(once, scratch_folder(spark, "toxicity"))
    state, before = Ftrl.fresh(), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, True)  # what a round has shuffled is of no use to the next
    try:
        for _ in range(ROUNDS):
            state = _round(spark, stored, state)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    every = np.arange(DIMENSIONS + 1)
    weights = state.weights(every).astype(np.float32)
    used = np.flatnonzero(weights[:-1]).astype(np.int32)
    return used, weights[used], float(weights[-1])


def _round(spark: SparkSession, rows: DataFrame, start: Ftrl) -> Ftrl:
    """All learners go on from the same state; the mean of theirs is the next."""
    begin = spark.sparkContext.broadcast(list(start.ranges()))  # at most DIMENSIONS numbers

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        state, old = Ftrl.fresh(), Ftrl.fresh()
        for k, raw in begin.value:
            state.add(k, raw)
            old.add(k, raw)
        learner = int(group["learner"].iloc[0])
        group = group.sort_values(["turn", "y"])
        docs = [np.append(read_ids(ids), np.int32(DIMENSIONS)) for ids in group["ids"]]
        for _ in range(EPOCHS):
            for at, y in zip(docs, group["y"], strict=True):
                state.learn(at, float(y))
        # Both add up below the penalty as well, so all that has changed travels.
        changed = Ftrl(state.z - old.z, state.n - old.n)
        return pd.DataFrame([(k, learner, raw) for k, raw in changed.ranges()], columns=["range", "learner", "content"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((2, RANGE))
        for raw in group.sort_values("learner")["content"]:
            at, *own = unpacked(raw)
            total[:, at] += own
        return pd.DataFrame([(group["range"].iloc[0], packed(*total))], columns=["range", "content"])

    changes = (
        rows.groupBy("learner").applyInPandas(learn, "range int, learner int, content binary")
        .groupBy("range").applyInPandas(add, "range int, content binary")
        .toPandas()
    )
    begin.destroy()  # its files on the executors as well
    state = Ftrl(start.z.copy(), start.n.copy())
    for row in changes.itertuples():
        state.add(row.range, row.content, LEARNERS)
    return state


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``held_out``, ``score`` and ``predicted`` of every document."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # at most DIMENSIONS numbers, a few thousand after the penalty

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, weights, intercept = shared.value
        table = np.zeros(DIMENSIONS, np.float32)
        table[at] = weights
        for batch in batches:
            done = 0
            for part in words.slices(batch.column(2)):
                code, of, n = _every_feature(part)
                known = table[code] != 0
                code, of = code[known], of[known]
                code, begin = words.distinct_per_text(code, of, n)
                total = np.zeros(len(code) + 1)
                np.cumsum(table[code], out=total[1:])
                value = 1 / (1 + np.exp(-np.clip(np.diff(total[begin]) + intercept, -30, 30)))
                own = batch.slice(done, n)
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(value), pa.array((value >= 0.5).astype(np.int32))], [key, "held_out", "score", "predicted"])
                done += n

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, held_out(key).alias("held_out"), text).mapInArrow(run, f"`{key}` {kind}, held_out boolean, score double, predicted int")


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query: scores of all documents by a model of the labels outside the held-out fold."""
    return score(docs, train(docs, labels))
