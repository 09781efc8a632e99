"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

The pairwise term takes time linear in the features by the sum-of-squares identity. The model is fitted in numpy on at
most ``sample`` labelled rows (chosen by a hash of the id) with Adagrad steps; documents are scored on the executors.

Defined results: null and empty texts have no words and get the score of their structure; rows with null labels or ids
without a label teach nothing; without any labelled row every score is 0.5; ids and repeated rows pass through; very long
texts are scored whole; equal texts get equal scores; columns beside text, id and those asked for are not read; an empty table gives
an empty result. Label, language, source and id are never features.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, hash_sample, joined, utf8, word_hashes

WORDS = 1 << 14
CLASSES = [np.zeros(256, np.float32) for _ in range(6)]
CLASSES[0][65:91] = 1  # capitals
CLASSES[1][48:58] = 1  # digits
CLASSES[2][[33, 44, 46, 58, 59, 63]] = 1  # sentence marks
CLASSES[3][[x for x in range(33, 127) if not chr(x).isalnum() and chr(x) not in "!,.:;?"]] = 1  # other signs
CLASSES[4][10] = 1  # line feeds
CLASSES[5][128:] = 1  # beyond ASCII
STATS = len(CLASSES) + 8
FEATURES = WORDS + STATS


class Batch(NamedTuple):
    """Sparse rows: feature and value of each entry, and where each row begins (with the end)."""

    index: np.ndarray
    value: np.ndarray
    at: np.ndarray


def features(texts: list[bytes], meta: np.ndarray) -> Batch:
    """Word features of each text (log counts, scaled to length one), then its statistics. meta: a number per text."""
    hashes, counts, _ = word_hashes(texts)
    n = len(texts)
    doc = np.repeat(np.arange(n), counts)
    slot = (hashes >> np.uint64(20)).astype(np.int64) % WORDS
    pair, tf = np.unique(doc * WORDS + slot, return_counts=True)
    row, word = pair // WORDS, pair % WORDS
    weight = np.log1p(tf)
    norm = np.sqrt(np.bincount(row, weight * weight, n)) + 1e-9
    buf, off = joined(texts)
    size = np.maximum(np.diff(off) - 1, 1)
    stats = np.zeros((n, STATS))
    for k, table in enumerate(CLASSES):
        total = np.concatenate([[0], np.cumsum(table[buf], dtype=np.float64)])
        stats[:, k] = (total[off[1:] - 1] - total[off[:-1]]) / size if n else 0
    some = np.maximum(counts, 1)
    ends = np.cumsum(counts)
    top = np.zeros(n)
    np.maximum.at(top, row, tf)
    exact = np.unique(np.stack([doc.astype(np.uint64), hashes], 1), axis=0)[:, 0].astype(np.int64) if len(doc) else doc
    k = len(CLASSES)
    stats[:, k] = np.log1p(counts)
    stats[:, k + 1] = np.diff(off) / (some + 1.0)
    stats[:, k + 2] = np.bincount(exact, minlength=n) / some
    stats[:, k + 3] = top / some
    same = np.concatenate([[0], np.cumsum(np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])]) if len(doc) else np.zeros(0))])
    stats[:, k + 4] = (same[ends] - same[ends - counts]) / some
    stats[:, k + 5] = counts == 0
    stats[:, k + 6] = np.log1p(np.abs(meta))
    stats[:, k + 7] = meta < 0
    index = np.concatenate([word, np.tile(np.arange(WORDS, FEATURES), n)])
    value = np.concatenate([weight / norm[row], stats.ravel()])
    of = np.concatenate([row, np.repeat(np.arange(n), STATS)])
    order = np.argsort(of, kind="stable")
    return Batch(index[order].astype(np.int32), value[order].astype(np.float32), np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]))


class Machine(NamedTuple):
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def scaled(self, b: Batch) -> np.ndarray:
        value = b.value.astype(np.float32).copy()
        s = b.index >= WORDS
        k = b.index[s] - WORDS
        value[s] = np.clip((value[s] - self.mean[k]) / self.spread[k], -4, 4)
        return value

    def margin(self, b: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linear and pairwise terms of each row; also the scaled values and the factor sums."""
        value = self.scaled(b)
        vx = self.factor[b.index] * value[:, None]
        sums = np.add.reduceat(vx, b.at[:-1], 0)
        pairs = 0.5 * (sums * sums - np.add.reduceat(vx * vx, b.at[:-1], 0)).sum(1)
        return self.bias + np.add.reduceat(self.weight[b.index] * value, b.at[:-1]) + pairs, value, sums

    def score(self, b: Batch) -> np.ndarray:
        if len(b.at) < 2:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.margin(b)[0].astype(np.float64), -30, 30)))


def gradient(m: Machine, part: Batch, label: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Of the mean logistic loss: by the bias, then the features that occur, by their weights and by their factors."""
    z, value, sums = m.margin(part)
    lengths = np.diff(part.at)
    err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label).astype(np.float32) / len(label)
    e = np.repeat(err, lengths)
    touched, back = np.unique(part.index, return_inverse=True)
    dw = np.bincount(back, e * value, len(touched)).astype(np.float32)
    each = e[:, None] * (value[:, None] * np.repeat(sums, lengths, 0) - m.factor[part.index] * (value * value)[:, None])
    dv = np.zeros((len(touched), m.factor.shape[1]), np.float32)
    np.add.at(dv, back, each)
    return float(err.sum()), touched, dw, dv


def fitted(b: Batch, label: np.ndarray, factors: int = 8, epochs: int = 12, rate: float = 0.1, decay: float = 1e-5, size: int = 64) -> Machine:
    """Logistic loss, Adagrad over mini-batches, a fixed seed."""
    rng = np.random.default_rng(7)
    n = len(label)
    stats = b.value[b.index >= WORDS].reshape(n, STATS) if n else np.zeros((1, STATS), np.float32)
    m = Machine(0.0, np.zeros(FEATURES, np.float32), rng.normal(0, 0.05, (FEATURES, factors)).astype(np.float32), stats.mean(0), stats.std(0) + 1e-3)
    if not n:
        return m._replace(factor=m.factor * 0)
    gw, gv, gb = np.full(FEATURES, 1e-3, np.float32), np.full((FEATURES, factors), 1e-3, np.float32), 1e-3
    for _ in range(epochs):
        order = rng.permutation(n)
        for s in range(0, n, size):
            rows = order[s : s + size]
            lengths = b.at[rows + 1] - b.at[rows]
            take = np.repeat(b.at[rows] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            part = Batch(b.index[take], b.value[take], np.concatenate([[0], np.cumsum(lengths)]))
            db, touched, dw, dv = gradient(m, part, label[rows])
            dw += decay * m.weight[touched]
            dv += decay * m.factor[touched]
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            m.weight[touched] -= rate * dw / np.sqrt(gw[touched])
            m.factor[touched] -= 0.5 * rate * dv / np.sqrt(gv[touched])
            gb += db * db
            m = m._replace(bias=m.bias - rate * db / gb**0.5)
    return m


def _inputs(docs: DataFrame, doc_id: str, text: str, metadata: str | None, *more: Column) -> DataFrame:
    meta = F.coalesce(F.col(metadata).cast("double"), F.lit(-1.0)) if metadata else F.lit(0.0)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), meta.alias("meta"), *more)


def learned(docs: DataFrame, labels: DataFrame, teaches: Column, doc_id: str = "doc_id", text: str = "text", metadata: str | None = "n_chars", label: str = "quality", sample: int = 6000) -> Machine:
    """Fits on at most ``sample`` of the labels for which ``teaches`` (a condition on the id) holds."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).where(teaches)
    taken = hash_sample(known.select(doc_id, label), [doc_id], sample).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    bounded_batches(docs.sparkSession)
    rows = _inputs(docs, doc_id, text, metadata).join(F.broadcast(taken), "doc_id")  # at most ``sample`` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, meta = utf8(batch.column("text")), batch.column("meta").to_numpy()
            for a, b in chunks(texts):
                f = features(texts[a:b], meta[a:b])
                lists = [pa.ListArray.from_arrays(pa.array(f.at, pa.int32()), pa.array(x)) for x in (f.index, f.value)]
                yield pa.RecordBatch.from_arrays([batch.column("y").slice(a, b - a), batch.column("doc_id").slice(a, b - a), *lists], names=["y", "doc_id", "index", "value"])

    made = rows.mapInArrow(run, "y int, doc_id long, index array<int>, value array<float>")
    # ids may repeat in the documents: still at most ``sample`` rows come here
    got = made.orderBy(F.xxhash64("doc_id"), F.xxhash64("index", "value"), "y").limit(sample).toArrow().combine_chunks()
    if not got.num_rows:
        return fitted(Batch(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(1, int)), np.zeros(0))
    index, value = got.column("index").combine_chunks(), got.column("value").combine_chunks()
    at = np.concatenate([[0], np.cumsum(index.value_lengths().to_numpy())])
    return fitted(Batch(index.flatten().to_numpy(), value.flatten().to_numpy(), at), got.column("y").to_numpy().astype(np.float32))


def scored(docs: DataFrame, machine: Machine, doc_id: str = "doc_id", text: str = "text", metadata: str | None = "n_chars", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``keep`` and score of every row, over its whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(machine)  # a fixed size
    held = F.struct(*keep) if keep else F.lit(0)
    rows = _inputs(docs, doc_id, text, metadata, held.alias("held"))
    held_type = rows.schema["held"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, meta = utf8(batch.column("text")), batch.column("meta").to_numpy()
            parts = [model.value.score(features(texts[a:b], meta[a:b])) for a, b in chunks(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held"), pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=["doc_id", "held", "score"])

    out = rows.mapInArrow(run, f"doc_id long, held {held_type}, score double")
    return out.select("doc_id", "held.*", "score") if keep else out.drop("held")
