"""Operator 9: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import Shared, lower_words, map_slices, slices, stored, texts

# Labelled documents that the model is fitted on at most (those with the smallest id hashes).
SAMPLE_ROWS = 8192
DIMENSIONS = 1 << 18
# Workers that train side by side; their states are averaged after each round.
WORKERS = 6
ROUNDS = 3


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, words: list[bytes]) -> float:
        """Probability of label 1: a sparse dot product over the n-grams of the text."""
        index = ngrams(words)
        total = self.bias + (float(self.weights[index].sum()) / np.sqrt(len(index)) if len(index) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def ngrams(words: list[bytes]) -> np.ndarray:
    """Hashed word unigrams, word bigrams (a word beside itself is one bigram of its own) and two-byte word ends."""
    if not words:
        return np.zeros(0, dtype=np.int64)
    one = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
    two ^= two >> np.uint64(29)
    two[one[:-1] == one[1:]] = 12345
    joined = np.frombuffer(b" ".join(words), dtype=np.uint8).astype(np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 2
    tail = joined[ends] * np.uint64(257) + joined[np.maximum(ends - 1, 0)]
    tail = tail * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(20)
    return (np.concatenate([one, two, tail]) % np.uint64(DIMENSIONS)).astype(np.int64)


class Leader:
    """FTRL-proximal state; coordinate 0 of a separate pair is the bias."""

    def __init__(self, z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float):
        self.z, self.n, self.alpha, self.beta, self.l1, self.l2 = z, n, alpha, beta, l1, l2

    def weights(self, index) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / rate)

    def update(self, index: np.ndarray, value: np.ndarray, label: float) -> None:
        w = self.weights(index)
        p = 1 / (1 + np.exp(-np.clip(float(w @ value), -35, 35)))
        g = (p - label) * value
        step = (np.sqrt(self.n[index] + g * g) - np.sqrt(self.n[index])) / self.alpha
        self.z[index] += g - step * w
        self.n[index] += g * g


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    rounds: int = ROUNDS,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.1,
) -> Model:
    """The model fitted on at most sample_rows labelled ids, chosen by the id's hash.

    A label counts if neither it nor the id is NULL; several labels of an id are averaged (label 1 from one half on).
    WORKERS workers update their own state over their share of the sample; the states are averaged after every round and
    carried into the next. Without labelled rows the model is the even score 0.5.
    """
    spark = docs.sparkSession
    chosen = labels.select(F.col("doc_id").alias("labelled"), F.col(label).cast("double").alias("y")).dropna()
    chosen = chosen.groupBy("labelled").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("labelled"), "labelled").limit(sample_rows)
    # At most sample_rows pairs of numbers, so the broadcast is bounded.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    order = F.xxhash64("doc_id", F.lit(7))
    sample = stored(sample.select("y", "text", order.alias("place"), F.pmod(order, F.lit(WORKERS)).alias("worker")))
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    for _ in range(rounds):
        state = Shared(spark, (z, n))

        def run(batches):
            own = Leader(*[x.copy() for x in state.value], alpha, beta, l1, l2)
            seen = False
            for part in slices(batches):
                for y, text in zip(part.column("y").to_pylist(), texts(part)):
                    index, count = np.unique(ngrams(lower_words(text)), return_counts=True)
                    value = count / np.sqrt(max(1, count.sum()))
                    own.update(np.append(index, DIMENSIONS), np.append(value, 1.0), y)
                    seen = True
            if seen:
                used = np.flatnonzero(own.n)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(own.z[used]), pa.array(own.n[used])], names=["k", "z", "n"])

        parts = sample.repartition(WORKERS, "worker").sortWithinPartitions("place", "y").mapInArrow(run, "k long, z double, n double")
        # At most one row per dimension and worker, summed per dimension.
        rows = parts.withColumn("one", F.when(F.col("k") == DIMENSIONS, 1)).groupBy("k").agg(F.sum("z").alias("z"), F.sum("n").alias("n"), F.count("one").alias("w")).toPandas()
        if rows.empty:
            break
        workers = max(1, int(rows["w"].max()))
        z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
        z[rows["k"]], n[rows["k"]] = rows["z"] / workers, rows["n"] / workers
    final = Leader(z, n, alpha, beta, l1, l2).weights(slice(None))
    return Model(final[:-1].astype(np.float32), float(final[-1]))


def scored(docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns `keep` of docs (all by default) and `score`, the probability of label 1.

    NULL and empty texts have no n-grams and get the score of the bias alone. Rows are scored one by one, so repeated
    rows are alike and nothing is shuffled. A column of docs called score is replaced.
    """
    shared = Shared(docs.sparkSession, model)
    names = [c for c in (keep or docs.columns) if c != "score"]
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)

    def run(batch: pa.RecordBatch) -> dict:
        own = shared.value
        return {n: batch.column(n) for n in names} | {"score": [own.score(lower_words(t)) for t in texts(batch)]}

    return map_slices(docs.select(*dict.fromkeys([*names, "text"])), run, f"{fields}, score double")
