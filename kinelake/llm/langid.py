"""Language identification by a byte convolutional network, trained in numpy.

A window of ``WINDOW`` bytes is embedded byte by byte, filters of several widths run over it, each filter's maximum over
the window goes through a softmax layer. A text is cut into consecutive windows, from its first byte to its last; its
language is the one with the largest mean probability over the windows, its score that mean. Training takes up to
``sample`` labelled texts, chosen by a hash of the id, and of each the ``EACH`` windows with the least hashes among all windows
of the whole text.

Defined results: null texts and texts without a letter (a character of a Unicode letter class) are ``und`` with score 0; nulls in the label column teach nothing;
with no labelled row at all everything is ``und``; repeated rows and extra columns change nothing; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, chunks, hash_bound

WINDOW, EMBED, WIDTHS, FILTERS, EACH = 256, 6, (2, 3, 4), 12, 4
#: Letters, and numerals that aren't decimal digits.
LETTERLIKE = re.compile(r"[^\W\d_]")
#: Digits, ASCII signs and control characters are blanks to the network.
SHOWN = np.full(256, 32, np.uint8)
SHOWN[65:91], SHOWN[97:123], SHOWN[128:] = np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTERLIKE.finditer(text))


def windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n, WINDOW) bytes of all windows, the last of each text padded with blanks, and the text of each."""
    raw = [t.lower().encode() for t in texts]
    n = np.array([max(1, -(-len(r) // WINDOW)) for r in raw], np.int64)
    out = np.full((n.sum(), WINDOW), 32, np.uint8)
    flat, at = out.reshape(-1), (np.cumsum(n) - n) * WINDOW
    for a, r in zip(at.tolist(), raw):
        flat[a : a + len(r)] = np.frombuffer(r, np.uint8)
    return SHOWN[out], np.repeat(np.arange(len(texts)), n)


def drawn(text: str) -> np.ndarray:
    """The ``EACH`` windows of a text with the least hashes, those that show something first."""
    x = windows([text])[0]
    blank = ~(x != 32).any(1)
    order = sorted(range(len(x)), key=lambda i: (bool(blank[i]), xxhash.xxh3_64_intdigest(x[i].tobytes(), i), i))
    return x[sorted(order[:EACH])]


class Network(NamedTuple):
    names: list[str]
    embed: np.ndarray  # (256, EMBED)
    filters: np.ndarray  # (max width * EMBED, filters of all widths); rows beyond a filter's width are 0
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def patches(self, x: np.ndarray) -> np.ndarray:
        e = self.embed[x].reshape(len(x), -1)
        wide = max(WIDTHS) * EMBED
        view = np.lib.stride_tricks.sliding_window_view(e, wide, axis=1)[:, ::EMBED]
        return np.ascontiguousarray(view)

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = self.patches(x)
        out = (p.reshape(-1, p.shape[2]) @ self.filters).reshape(p.shape[0], p.shape[1], -1)
        return p, out, np.maximum(out.max(1) + self.bias, 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = []
        for s in range(0, len(x), 256):
            z = self.pooled(x[s : s + 256])[2] @ self.dense + self.dense_bias
            z = np.exp(z - z.max(1, keepdims=True))
            out.append(z / z.sum(1, keepdims=True))
        return np.concatenate(out) if out else np.zeros((0, len(self.names)), np.float32)


def gradient(net: Network, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross entropy, for each parameter. Through a maximum the gradient goes to its place only."""
    patch, out, h = net.pooled(x)
    z = h @ net.dense + net.dense_bias
    z = np.exp(z - z.max(1, keepdims=True))
    z /= z.sum(1, keepdims=True)
    z[np.arange(len(x)), y] -= 1
    z /= len(x)
    dh = (z @ net.dense.T) * (h > 0)
    best = out.argmax(1)  # (rows, filters)
    hit = patch[np.arange(len(x))[:, None], best]  # (rows, filters, width * EMBED)
    grad = {"dense": h.T @ z, "dense_bias": z.sum(0), "bias": dh.sum(0), "filters": np.einsum("rf,rfk->kf", dh, hit) * mask}
    back = (dh[:, :, None] * net.filters.T[None]).reshape(-1, max(WIDTHS), EMBED)
    at = (best[:, :, None] + np.arange(max(WIDTHS))).reshape(len(x), -1)
    grad["embed"] = np.zeros_like(net.embed)
    np.add.at(grad["embed"], np.take_along_axis(x, at, 1).ravel(), back.reshape(-1, EMBED))
    return grad


def fitted(x: np.ndarray, y: np.ndarray, names: list[str], epochs: int = 6, rate: float = 0.004, size: int = 64) -> Network:
    """Cross entropy, Adam over mini-batches, a fixed seed."""
    rng = np.random.default_rng(11)
    f = FILTERS * len(WIDTHS)
    mask = np.zeros((max(WIDTHS) * EMBED, f), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[: w * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
    p = {
        "embed": rng.normal(0, 0.5, (256, EMBED)), "filters": rng.normal(0, 0.3, mask.shape) * mask, "bias": np.zeros(f),
        "dense": rng.normal(0, 0.2, (f, len(names))), "dense_bias": np.zeros(len(names)),
    }
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for s in range(0, len(order), size):
            rows = order[s : s + size]
            grad = gradient(Network(names, **p), x[rows], y[rows], mask)
            t += 1
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] = (p[k] - rate * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-7)).astype(np.float32)
    return Network(names, **p)


def learned(docs: DataFrame, teaches: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = 3000) -> Network | None:
    """Fits on at most ``sample`` texts with a language for which ``teaches`` holds; None if there is none."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).where(teaches)
    # the hash decides, so the sample is spread over languages as the table is
    bound = hash_bound(known, doc_id, sample)
    if bound is None:
        return None
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            cut, langs, keys = [], [], []
            for t, lang, key in zip(texts, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if has_letter(t):
                    chosen = drawn(t)
                    cut.append(chosen.tobytes()), langs.append(lang), keys.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary()), pa.array(langs, pa.string()), pa.array(keys, pa.int64())], names=["w", "l", "h"])

    taken = known.where(F.xxhash64(doc_id) <= bound).select(F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("l"), F.xxhash64(doc_id).alias("h"))
    rows = taken.mapInArrow(run, "w binary, l string, h long").orderBy("h", "w", "l").limit(sample).collect()  # at most EACH windows a row
    if not rows:
        return None
    names = sorted({r.l for r in rows})
    x = np.concatenate([np.frombuffer(r.w, np.uint8).reshape(-1, WINDOW) for r in rows])
    label = np.repeat([names.index(r.l) for r in rows], [len(r.w) // WINDOW for r in rows])
    return fitted(x, label, names)


def identified(docs: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row, over its whole text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    model = spark.sparkContext.broadcast(network)  # a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = model.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            told = [i for i, t in enumerate(texts) if net is not None and has_letter(t)]
            for a, b in chunks([texts[i] for i in told], 500_000):
                x, of = windows([texts[i] for i in told[a:b]])
                mean = np.add.reduceat(net.probabilities(x), np.searchsorted(of, np.arange(b - a)), 0) / np.bincount(of)[:, None]
                for i, k, s in zip(told[a:b], mean.argmax(1), mean.max(1)):
                    names[i], scores[i] = net.names[k], min(1.0, float(s))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")
