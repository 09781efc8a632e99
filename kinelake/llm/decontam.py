"""Benchmark decontamination: rare n-gram seeds join documents to test items, alignment scores what they share.

Words are lower-cased runs of letters and digits (any byte above ASCII counts as a letter). An n-gram that at most ``RARE`` items
have is a seed: the places around a seed that a document shares with an item are aligned with it (Smith-Waterman).

No seed finds every edited copy, so pairs are completed by a condition that each good alignment meets. An alignment that
reaches the share ``least`` of the best possible score matches at least that share of an item's L words and spans a bounded
number of the document's words. So all but L - need of the item's distinct words are in that span, and of any L - need + t
distinct words at least t. For each item the words that are rarest in the text at hand are taken, and only places where t of
them are close enough are looked at. The work grows with such places, not with documents times items.

Places are windows that overlap by what an alignment can span, so the score is Smith-Waterman's over the whole text. A window is
aligned only if it has enough of the item's words, in the item's order. ``seeds`` counts the n-grams of the item in the best
window; ``by_seed`` tells whether a rare one led there.

Items are taken in blocks of ``block``, each broadcast on its own: what a block holds doesn't grow with the data. Several
blocks are worked off one after the other, each into a table.

Defined results: null and empty texts match nothing; items of fewer than ``n`` words are too short to tell a copy and match nothing;
items of the same text are reported each; repeated rows are reported once per (doc_id, item_id); null ids are kept; very long texts
are taken whole; other columns, whatever their names, are not read; empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PrefixHash, bounded_batches, chunks, joined, mixed, utf8, written

KEPT = np.full(256, 32, np.uint8)
KEPT[128:] = np.arange(128, 256)
KEPT[48:58] = np.arange(48, 58)
KEPT[97:123] = np.arange(97, 123)
KEPT[65:91] = np.arange(97, 123)

MATCH, MISMATCH, GAP = 2, -1, -1


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and where each text's begin (with the end)."""
    buf, off = joined(texts)
    buf = KEPT[buf]
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = buf != 32
    turn = np.diff(inside)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    hashes = mixed(PrefixHash(buf).of(start, end) + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(start, off)


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on (places near the end included only if n words are left)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = mixed(h * np.uint64(31) + words[k : k + m])
    return h


def aligned(item: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Best local alignment score of an item with each row of windows (padded with -1), linear gaps."""
    n, w = windows.shape
    slope = np.arange(w + 1) * -GAP
    best, row = np.zeros(n, np.int64), np.zeros((n, w + 1), np.int64)
    for x in item:
        step = np.where(windows == x, MATCH, MISMATCH)
        new = np.zeros_like(row)
        np.maximum(row[:, :-1] + step, row[:, 1:] + GAP, out=new[:, 1:])
        np.maximum(new, 0, out=new)
        row = np.maximum.accumulate(new + slope, 1) - slope  # gaps along the window
        np.maximum(best, row.max(1), out=best)
    return best


#: A seed is an n-gram that at most so many items have. Hits that are sorted at once.
RARE, HITS = 20, 2_000_000


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", n: int = 4, least: float = 0.5, block: int = 20_000) -> DataFrame:
    """(doc_id, item_id, score, seeds, by_seed): pairs whose alignment reaches ``least`` of the item's full score."""
    bounded_batches(docs.sparkSession)
    items = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    blocks = max(1, -(-items.count() // block))
    if blocks == 1:
        return of_block(texts, items, n, least)
    parts = [written(of_block(texts, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b), n, least), "aligned-pairs") for b in range(blocks)]
    return reduce(DataFrame.unionByName, parts)


class Items:
    """A block of items: their words, which items have a word, and which have a rare n-gram."""

    def __init__(self, rows: list[tuple[int, bytes]], n: int, least: float):
        hashes, at = words_of([t for _, t in rows])
        long = [i for i in range(len(rows)) if at[i + 1] - at[i] >= n]
        self.n, self.least = n, least
        self.names = [rows[i][0] for i in long]
        self.words = [hashes[at[i] : at[i + 1]] for i in long]
        self.size = np.array([len(w) for w in self.words], np.int64)
        self.need = np.array([ceil(least * x - 1e-9) for x in self.size], np.int64)
        self.span = np.array([ceil((3 - 2 * least) * x) for x in self.size], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *self.words])
        self.known = np.unique(flat)
        owner, word = np.repeat(np.arange(len(long)), self.size), np.searchsorted(self.known, flat)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        # distinct words of each item, with their places as bits (items of up to 64 words)
        self.key, first = np.unique(owner * max(1, len(self.known)) + word, return_inverse=True)
        self.bits = np.zeros(len(self.key), np.uint64)
        np.bitwise_or.at(self.bits, first, np.uint64(1) << (place % 64).astype(np.uint64))
        self.owner, self.word = self.key // max(1, len(self.known)), self.key % max(1, len(self.known))
        spare = self.size - self.need  # so many distinct words an alignment may lack
        distinct = np.bincount(self.owner, minlength=len(long))
        self.times = np.clip(distinct - spare, 1, 3)
        self.taken = np.minimum(distinct, spare + self.times)
        grams = [np.unique(ngrams(w, n)) for w in self.words]
        all_grams, of = np.concatenate([np.zeros(0, np.uint64), *grams]), np.repeat(np.arange(len(long)), [len(g) for g in grams])
        order = np.argsort(all_grams, kind="stable")
        all_grams, of = all_grams[order], of[order]
        seed, start, many = np.unique(all_grams, return_index=True, return_counts=True)
        rare = many <= RARE
        self.seed, self.seed_items = seed[rare], of[np.repeat(rare, many)]
        self.seed_begin = np.concatenate([[0], np.cumsum(many[rare])])


def spread(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """begin, begin + 1, .. for each of several stretches, one after the other."""
    return np.repeat(begin - (np.cumsum(many) - many), many) + np.arange(many.sum())


class Places:
    """Windows (item, document, number) of a batch of texts that may hold a good alignment."""

    def __init__(self, items: Items, h: np.ndarray, at: np.ndarray):
        self.items, self.h, self.at = items, h, at
        self.word = np.minimum(np.searchsorted(items.known, h), len(items.known) - 1)
        self.word[items.known[self.word] != h] = len(items.known)

    def windows(self, item: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Rows (item, document, number): where an alignment may start that has the words at first and last."""
        it = self.items
        doc = np.searchsorted(self.at, first, "right") - 1
        begin, step = self.at[doc], it.size[item]
        low = np.maximum(last - it.span[item] + 1 - begin, 0) // step
        many = (first - begin) // step - low + 1
        rows = np.stack([np.repeat(item, many), np.repeat(doc, many), spread(low, many)], 1)
        return np.unique(rows, axis=0)

    def seeded(self) -> np.ndarray:
        it = self.items
        g = ngrams(self.h, it.n)
        if not len(g) or not len(it.seed):
            return np.zeros((0, 3), np.int64)
        place = np.minimum(np.searchsorted(it.seed, g), len(it.seed) - 1)
        at = np.flatnonzero(it.seed[place] == g)
        at = at[np.searchsorted(self.at, at, "right") == np.searchsorted(self.at, at + it.n - 1, "right")]  # within one text
        many = (it.seed_begin[place[at] + 1] - it.seed_begin[place[at]])
        item, at = it.seed_items[spread(it.seed_begin[place[at]], many)], np.repeat(at, many)
        return self.windows(item, at, at + it.n - 1)

    def completed(self) -> Iterator[np.ndarray]:
        """Windows by the rarest words, for some items at a time."""
        it = self.items
        where = np.flatnonzero(self.word < len(it.known))
        where = where[np.argsort(self.word[where], kind="stable")]
        count = np.bincount(self.word[where], minlength=len(it.known))
        begin = np.cumsum(count) - count
        # the rarest words of each item in these texts
        order = np.lexsort((count[it.word], it.owner))
        owner = it.owner[order]
        rank = np.arange(len(order)) - np.searchsorted(owner, owner)
        keep = order[(rank < it.taken[owner]) & (count[it.word[order]] > 0)]
        hits = np.bincount(it.owner[keep], weights=count[it.word[keep]], minlength=len(it.size)).astype(np.int64)
        part = np.cumsum(hits) // HITS
        for p in np.unique(part[hits > 0]).tolist():
            own = keep[part[it.owner[keep]] == p]
            many = count[it.word[own]]
            item, pos = np.repeat(it.owner[own], many), where[spread(begin[it.word[own]], many)]
            order = np.lexsort((pos, item))
            item, pos = item[order], pos[order]
            first = np.arange(len(item))
            last = first + it.times[item] - 1
            ok = last < len(item)
            first, last = first[ok], last[ok]
            ok = (item[first] == item[last]) & (pos[last] - pos[first] < it.span[item[first]])
            first, last = first[ok], last[ok]
            ok = np.searchsorted(self.at, pos[first], "right") == np.searchsorted(self.at, pos[last], "right")
            yield self.windows(item[first[ok]], pos[first[ok]], pos[last[ok]])

    def bounds(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = self.items.size[rows[:, 0]]
        low = self.at[rows[:, 1]] + rows[:, 2] * step
        return low, np.minimum(low + step + self.items.span[rows[:, 0]], self.at[rows[:, 1] + 1])

    def likely(self, rows: np.ndarray) -> np.ndarray:
        """Those with enough of the item's words, in its order."""
        it, out = self.items, [np.zeros((0, 3), np.int64)]
        size = it.size[rows[:, 0]]
        rows = rows[np.argsort(size, kind="stable")]
        size = np.sort(size)
        start = 0
        while start < len(rows):
            end = min(start + max(1, 400_000 // int(size[start] * 4)), int(np.searchsorted(size, size[start], "right")))
            part = rows[start:end]
            low, high = self.bounds(part)
            span = low[:, None] + np.arange(int((high - low).max()))
            word = np.where(span < high[:, None], self.word[np.minimum(span, len(self.h) - 1)], len(it.known))
            key = part[:, :1] * max(1, len(it.known)) + word
            place = np.minimum(np.searchsorted(it.key, key), len(it.key) - 1)
            bits = np.where((it.key[place] == key) & (word < len(it.known)), it.bits[place], np.uint64(0))
            need = it.need[part[:, 0]]
            enough = np.flatnonzero((bits != 0).sum(1) >= need)
            if size[start] <= 64 and len(enough):
                enough = enough[in_order(bits[enough], int(size[start])) >= need[enough]]
            out.append(part[enough])
            start = end
        return np.concatenate(out)


def in_order(bits: np.ndarray, size: int) -> np.ndarray:
    """How many of an item's words each row of windows has in the same order at most (bit-parallel longest common
    subsequence). bits: for each word of a window its places among the item's ``size`` <= 64 words."""
    rest = np.full(len(bits), 2**64 - 1, np.uint64)
    for column in bits.T:
        both = rest & column
        rest = (rest + both) | (rest - both)
    return size - np.bitwise_count(rest & np.uint64(2**size - 1)).astype(np.int64)


def best_alignments(places: Places, rows: np.ndarray, by_seed: bool, best: dict) -> None:
    """Aligns windows and keeps the best of each (item, document): score, n-grams, whether a seed led there."""
    it = places.items
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    for part in np.split(rows, np.flatnonzero(np.diff(rows[:, 0])) + 1) if len(rows) else []:
        i = int(part[0, 0])
        item, grams = it.words[i], ngrams(it.words[i], it.n)
        for part in (part[s : s + 500] for s in range(0, len(part), 500)):
            low, high = places.bounds(part)
            span = low[:, None] + np.arange(int((high - low).max()))
            windows = np.where(span < high[:, None], places.h.view(np.int64)[np.minimum(span, len(places.h) - 1)], -1)
            score = aligned(item.view(np.int64), windows) / (MATCH * len(item))
            for r in np.flatnonzero(score >= it.least).tolist():
                seeds = int(np.isin(ngrams(places.h[low[r] : high[r]], it.n), grams).sum())
                pair = (i, int(part[r, 1]))
                best[pair] = max(best.get(pair, (0.0, 0, False)), (float(score[r]), seeds, by_seed))


def of_block(texts: DataFrame, items: DataFrame, n: int, least: float) -> DataFrame:
    rows = [(r.item_id, (r.text or "").encode()) for r in items.collect()]  # a block: bounded
    model = texts.sparkSession.sparkContext.broadcast(Items(rows, n, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = model.value
        if not len(items.known):
            return
        for batch in batches:
            raw, ids = utf8(batch.column(1)), batch.column(0).to_pylist()
            for a, b in chunks(raw):
                h, at = words_of(raw[a:b])
                if not len(h):
                    continue
                places = Places(items, h, at)
                best: dict[tuple[int, int], tuple[float, int, bool]] = {}
                seeded = places.seeded()
                best_alignments(places, places.likely(seeded), True, best)
                code = lambda rows: (rows[:, 0] * (b - a) + rows[:, 1]) * (len(h) + 1) + rows[:, 2]  # noqa: E731, B023
                for more in places.completed():
                    best_alignments(places, places.likely(more[~np.isin(code(more), code(seeded))]), False, best)
                if best:
                    found = list(best.values())
                    columns = [[ids[a + d] for _, d in best], [items.names[i] for i, _ in best], *zip(*found)]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_()))], names=["doc_id", "item_id", "score", "seeds", "by_seed"])

    pairs = texts.mapInArrow(run, "doc_id long, item_id long, score double, seeds long, by_seed boolean")
    best = F.max(F.struct("score", "seeds", "by_seed")).alias("b")
    return pairs.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.score", "b.seeds", "b.by_seed")
