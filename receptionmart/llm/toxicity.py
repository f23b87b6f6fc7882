"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashed single words, word pairs and pairs with one word between them of a whole text. The
learner sees a bounded sample of labelled texts, ``sample_rows`` at most (those with the smallest id hashes), as a
stream in one task: its state is two arrays of a fixed size, whatever the input. Per-coordinate rates adapt to how
often a feature is met and the L1 term keeps weights of weak features at exactly zero, so the result is a short list of
weights, of at most ``2 ** bits``, that every scoring task gets. Scoring is a single pass without a shuffle.

Defined cases: null and empty texts have no features and get the score of the bias; labels other than 0 and 1, and
null labels or ids, are not learned from; repeated rows count as often as they come; without any labelled row all
scores are 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_batches

# ASCII signs that are not part of words become spaces.
_PLAIN = bytes(b if b > 127 or chr(b).isalnum() or b == ord("'") else 32 for b in range(256))


# Places of the state that are turned into weights at a time.
SLICE = 1 << 17


@dataclass(frozen=True)
class Learner:
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 3.0
    l2: float = 0.0
    bits: int = 22
    epochs: int = 3
    sample_rows: int = 12_000
    threshold: float = 0.3


def features(text: str, bits: int) -> np.ndarray:
    """Hashed features of a text, with repeats."""
    words = text.lower().encode().translate(_PLAIN).split()
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] >> np.uint64(7))
    skip = (h[:-2] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (h[2:] >> np.uint64(11))
    return (np.concatenate([h, pair, skip]) >> np.uint64(64 - bits)).astype(np.uint32)


class Ftrl:
    """Weights follow from the state: zero where the summed gradient stays within the L1 bound."""

    def __init__(self, learner: Learner):
        self.p = learner
        # The last place is the bias, which has no L1 bound.
        self.z, self.n = np.zeros((1 << learner.bits) + 1), np.zeros((1 << learner.bits) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n, p = self.z[at], self.n[at], self.p
        bound = np.where(at == 1 << p.bits, 0.0, p.l1)
        rate = (p.beta + np.sqrt(n)) / p.alpha + p.l2
        return np.where(np.abs(z) <= bound, 0.0, (np.sign(z) * bound - z) / rate)

    def learn(self, found: np.ndarray, label: int) -> None:
        at = np.append(found.astype(np.int64), 1 << self.p.bits)
        w = self.weights(at)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.p.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g

    def model(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and weights that are not zero, gathered from slices of the state."""
        found = []
        for start in range(0, len(self.z), SLICE):
            at = np.arange(start, min(start + SLICE, len(self.z)))
            w = self.weights(at)
            found.append((at[w != 0], w[w != 0]))
        return np.concatenate([at for at, _ in found]), np.concatenate([w for _, w in found])


def train(texts: DataFrame, labels: DataFrame, learner: Learner) -> np.ndarray:
    """Dense weights, the bias last. ``texts`` is (doc_id, text), ``labels`` (doc_id, label)."""
    good = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    sample = good.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id", "label").limit(learner.sample_rows)
    rows = texts.join(F.broadcast(sample), "doc_id")  # at most sample_rows rows of three numbers
    bits = learner.bits

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in text_batches(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("order"), batch.column("label"), pa.array([np.unique(features(t, bits)).tobytes() for t in found], pa.binary())],
                ["order", "label", "features"],
            )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Ftrl(learner)
        for batch in batches:
            for label, raw in zip(batch.column("label").to_pylist(), batch.column("features").to_pylist()):
                state.learn(np.frombuffer(raw, np.uint32), label)
        at, w = state.model()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(w, pa.float64())], ["place", "weight"])

    stream = (
        rows.select("order", F.col("label").cast("int").alias("label"), "text")
        .mapInArrow(extract, "order bigint, label int, features binary")
        .withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(learner.epochs))))
        .repartition(1)
        .sortWithinPartitions("epoch", "order", "label", "features")
        .select("label", "features")
    )
    weights = np.zeros((1 << bits) + 1, np.float32)
    model = stream.mapInArrow(fit, "place bigint, weight double").toArrow()  # at most 2 ** bits rows, few by L1
    weights[model["place"].to_numpy()] = model["weight"].to_numpy()
    return weights


def score_toxicity(
    df: DataFrame, labels: DataFrame, learn_from: DataFrame, learner: Learner = Learner(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of ``df`` with ``score`` and ``predicted``, which replace columns of these names.

    ``labels`` is (id, label) of the rows that may be learned from, ``learn_from`` holds their texts.
    """
    bounded_batches(df.sparkSession)
    texts = learn_from.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    marks = labels.select(F.col(labels.columns[0]).alias("doc_id"), F.col(labels.columns[1]).alias("label"))
    weights = train(texts, marks, learner)
    bits, threshold = learner.bits, learner.threshold
    model = df.sparkSession.sparkContext.broadcast((np.flatnonzero(weights).astype(np.int32), weights[weights != 0]))
    kept = df.select(*[c for c in df.columns if c not in ("score", "predicted")])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", score double, predicted int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w = model.value
        dense = np.zeros((1 << bits) + 1, np.float32)
        dense[at] = w
        used = dense != 0
        for batch, found in text_batches(batches, text_col):
            scores = []
            for text in found:
                f = features(text, bits)
                hit = np.unique(f[used[f]])
                scores.append(float(dense[hit].sum(dtype=float) + dense[-1]))
            s = 1.0 / (1.0 + np.exp(-np.clip(np.array(scores, float), -35, 35)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"],
            )

    return kept.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2
