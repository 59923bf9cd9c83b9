"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashes of its lower-cased words, of their first 4, 5
and 7 characters (inflected forms share them), of two words in a row, and of two words
with one between them. The model is learned with the FTRL-proximal
rule: every coordinate has its own learning rate from the gradients it has seen, and L1
keeps all but a few weights at zero, so that what is broadcast is small.

Learning reads a bounded sample of the labelled rows (``TRAIN_ROWS`` of each label, first
by hash of doc_id; rows with crc32(doc_id) divisible by 5 are never read), in one task, in
a fixed order. Scoring is a map over whole texts; labels, lang, source and doc_id are no
inputs of a score.

Results in special cases: null and empty texts score by the intercept alone; texts are
scored whole; equal texts have equal scores; a null doc_id is not held out and its label
is not used; without labels of both kinds every score is the share of toxic labels, 0.5
without any; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callgrid.llm.neardup import word_hashes

#: At most so many rows of each label are learned from.
TRAIN_ROWS = 4000
#: Bits of the hashed feature space.
BITS = 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 1.0
EPOCHS = 5
FOLDS = 5

#: Leading characters of a word that are features of their own.
STEMS = (4, 5, 7)

_U = np.uint64
#: Words are parted by white space, control characters and ASCII punctuation.
PARTING = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


@dataclass(frozen=True)
class Model:
    """Non-zero weights by feature, and the intercept."""
    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def score(self, found: np.ndarray) -> float:
        at = np.searchsorted(self.features, found)
        at[at == len(self.features)] = 0
        total = self.intercept
        if len(self.features):
            total += float(self.weights[at][self.features[at] == found].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -35, 35))))


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from learning: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(text: str | None) -> np.ndarray:
    """Distinct hashed features of a text, in order."""
    lowered = (text or "").lower()
    w = word_hashes(lowered, False, PARTING)
    if not len(w):
        return np.empty(0, np.int64)
    stems = [word_hashes(lowered, False, PARTING, n) * _U(0xD6E8FEB86659FD93) for n in STEMS]
    pair = lambda a, b, k: (a * _U(0x9E3779B97F4A7C15) + b + _U(k)) * _U(0xBF58476D1CE4E5B9)
    grams = np.concatenate([w, *stems, pair(w[:-1], w[1:], 1), pair(w[:-2], w[2:], 2)])
    return np.unique((grams >> _U(64 - BITS)).astype(np.int64))


def learn(rows: list[tuple[np.ndarray, int]], seed: int = 7) -> Model:
    """FTRL-proximal over (features, label) rows, in seeded order."""
    labels = np.array([y for _, y in rows], float)
    if not len(rows) or labels.min() == labels.max():
        share = float(np.clip(labels.mean(), 0.01, 0.99)) if len(rows) else 0.5
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log(share / (1 - share))))
    size = (1 << BITS) + 1  # the last one is the intercept, which L1 leaves alone
    z, n, l1 = np.zeros(size), np.zeros(size), np.full(size, L1)
    l1[-1] = 0

    def weight(i: np.ndarray) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * l1[i]) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= l1[i], 0.0, w)

    order = np.random.Generator(np.random.PCG64(seed))
    for _ in range(EPOCHS):
        for k in order.permutation(len(rows)):
            found, y = rows[k]
            i = np.append(found, size - 1)
            w = weight(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            s = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - s * w
            n[i] += g * g
    every = np.arange(size)
    w = weight(every)
    kept = np.flatnonzero(w[:-1])
    return Model(kept, w[kept], float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Learn from a bounded sample of ``labels`` (doc_id, toxic) outside the held-out fold.

    Only the sample's ids, at most twice ``rows``, are broadcast, and only its features come together in one task.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [usable.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for y in (0, 1)]
    chosen = chosen[0].union(chosen[1]).select(F.col("doc_id").alias("own_id"), "toxic")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("own_id")).select("doc_id", "text", "toxic")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [features(t).astype(np.int32).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.array(found, pa.binary())], names=["doc_id", "toxic", "found"])

    kinds = {f.name: f.dataType.simpleString() for f in texts.schema}
    sample = texts.mapInArrow(extract, f"doc_id {kinds['doc_id']}, toxic {kinds['toxic']}, found binary")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in zip(b.column("doc_id").to_pylist(), b.column("found").to_pylist(), b.column("toxic").to_pylist())]
        rows.sort(key=lambda r: r[:2])
        model = learn([(np.frombuffer(f, np.int32).astype(np.int64), y) for _, f, y in rows])
        yield pa.RecordBatch.from_arrays([pa.array([*model.features.tolist(), -1]), pa.array([*model.weights.tolist(), model.intercept])], names=["feature", "weight"])

    learned = sorted((r.feature, r.weight) for r in sample.repartition(1).mapInArrow(train, "feature long, weight double").collect())
    return Model(np.array([f for f, _ in learned[1:]], np.int64), np.array([w for _, w in learned[1:]]), learned[0][1] if learned else 0.0)


def score(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels, **how)
    docs = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = np.array([model.score(features(t)) for t in b.column("text").to_pylist()], float)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    scored = docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
