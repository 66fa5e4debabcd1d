"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text counts as the set of its words, pairs of adjacent words and pairs of words with one between
them, each hashed into one of ``BUCKETS`` buckets.  The model is fitted on a bounded sample of the
labelled rows: at most ``SAMPLE_PER_CLASS`` of either label, those with the smallest hash of their
id, which is the same sample on every run.  FTRL-proximal keeps a learning rate per bucket and
its L1 term sets most weights to exactly 0, so the weights are a short list, sent to every task.

Scores see the text only.  Defined cases: a null or empty text scores the base rate of the intercept.
Equal rows get equal scores; a null id is hashed as ''.  Label rows without a document, or with a null
label, teach nothing; if one label has no rows, every score is 0.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.llm.words import fold_table, mix, slices, text_bytes, word_hashes

BITS = 20
BUCKETS = 1 << BITS
SAMPLE_PER_CLASS = 4000
THRESHOLD = 0.7


@dataclass(frozen=True)
class Ftrl:
    """alpha / (beta + sqrt(sum of squared gradients)) is a bucket's rate."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 16.0
    l2: float = 0.5
    epochs: int = 3
    seed: int = 7
    #: What an error on a toxic row counts, against 1 for the others.
    toxic_weight: float = 6.0


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every word, pair and skip-gram, repeats included."""
    words, rows = word_hashes(data, offsets, fold_table(letters_only=True))
    found, where = [words], [rows]
    for gap, salt in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
        same = rows[gap:] == rows[:-gap] if len(rows) > gap else np.zeros(0, bool)
        pair = words[:-gap][same] * np.uint64(salt) + words[gap:][same] if len(same) else words[:0]
        found.append(mix(pair))
        where.append(rows[gap:][same] if len(same) else rows[:0])
    return (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate(where)


def fit(samples: list[np.ndarray], labels: np.ndarray, how: Ftrl) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets with a weight, their weights, and the intercept."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    order = np.random.default_rng(how.seed)

    def weights(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        w = -(zi - np.sign(zi) * how.l1) / ((how.beta + np.sqrt(n[at])) / how.alpha + how.l2)
        return np.where(np.abs(zi) <= how.l1, 0.0, w)

    sets = [np.append(s, BUCKETS) for s in samples]
    for _ in range(how.epochs):
        for i in order.permutation(len(sets)):
            at = sets[i]
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - labels[i]
            gradient *= how.toxic_weight if labels[i] else 1.0
            z[at] += gradient - (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / how.alpha * w
            n[at] += gradient**2
    w = weights(np.arange(BUCKETS + 1))
    kept = np.flatnonzero(w[:-1])
    return kept, w[kept], float(w[-1])


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(3))


def _feature_sets(docs: DataFrame) -> DataFrame:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bucket, row = features(*text_bytes(batch.column("text")))
            order = np.unique(row * BUCKETS + bucket)
            ends = np.searchsorted(order, np.arange(len(batch) + 1) * BUCKETS)
            values = pa.array((order % BUCKETS).astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), lists], names=["toxic", "buckets"])

    return docs.mapInArrow(sets, "toxic int, buckets array<int>")


def train(docs: DataFrame, labels: DataFrame, how: Ftrl = Ftrl()) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Fit on the labelled rows that are not held out; None if one label is missing."""
    usable = labels.where((remainder(F.col("doc_id")) != 1) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    by_hash = F.xxhash64("doc_id")
    sample = [usable.where(F.col("toxic") == y).orderBy(by_hash, "doc_id").limit(SAMPLE_PER_CLASS) for y in (1, 0)]
    # The sample is bounded above, and so is what the driver gets of it.
    chosen = F.broadcast(sample[0].unionAll(sample[1]))
    rows = _feature_sets(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic")).toArrow()
    y = rows.column("toxic").to_numpy()
    if len(np.unique(y)) < 2:
        return None
    sets = [np.asarray(x.values, dtype=np.int64) for x in rows.column("buckets")]
    order = np.lexsort((np.array([int(s.sum()) for s in sets]), [len(s) for s in sets], y))
    return fit([sets[i] for i in order], y[order].astype(float), how)


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float] | None) -> DataFrame:
    """Add ``score`` to the rows of a table with a column ``text``, in place of one of that name."""
    docs = docs.drop("score")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        weight = np.zeros(BUCKETS)
        if model is not None:
            weight[model[0]] = model[1]
        for batch in slices(batches, "text"):
            bucket, row = features(*text_bytes(batch.column("text")))
            hit = weight[bucket] != 0
            pairs = np.unique(row[hit] * BUCKETS + bucket[hit])
            total = np.bincount(pairs // BUCKETS, weight[pairs % BUCKETS], len(batch))
            p = 1 / (1 + np.exp(-np.clip(total + model[2], -30, 30))) if model is not None else np.zeros(len(batch))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(p)], names=[*names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(score, f"{fields}, score double")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(docs, labels)
    return scored(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (remainder(F.col("doc_id")) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
