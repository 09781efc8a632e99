"""Language-model scoring by a probabilistic suffix tree over words.

Contexts are sequences of up to ``depth`` words, of any words that occur ``times`` times or more, and such sequences at the start of a
text; those that occur ``times`` times or more are counted. A context is retained if the divergence of its next-word
distribution from that of its longest retained suffix, times its count, exceeds the number of words seen after it.
Distributions are smoothed towards the suffix's: (c + weight * p_suffix) / (n + weight); at the root stands the add-one
distribution of words. A token is scored in the longest retained context of what precedes it; a word that was never learned takes
the place of all such words, so that probabilities over words sum to one.

The contexts are counted in two ways. A broadcast part holds the hottest: contexts of symbols, which are the most frequent words, at
most ``symbols``, plus three of their own (any other word, the end of a text, its start); of each length beyond one the ``contexts`` most
frequent ones whose suffix it holds, too. There all words that are no symbols are one next symbol, and each gets its share of
that symbol's mass; a context retains its suffixes. All other contexts stay distributed and grow with the corpus, of every length up to
``depth`` (of two and three words at least) and of every word: the occurrences of a context meet in one task, where each next word counts on its own.
As the broadcast part holds every suffix of what it holds, what is left hangs from it, and a token is sent once, keyed by its shortest context
that is left; that one holds at most about 1 / min(symbols, contexts) of all tokens.

Words are numbers: the ``tier`` most frequent ones by a broadcast table, all others by a join. ``tier`` doesn't change results. Counts of
all words stay distributed.

Defined results: very long texts are scored whole; null text is empty and has one token, the end; if nothing is learned, every probability is that of the
add-one base; rows that repeat ids and texts are scored each; null ids pass through; columns besides id and text are not
read, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, chunks, mixed, release, utf8, word_hashes


class Words(NamedTuple):
    """Frequent words by hash (sorted) with their places, the most frequent first; by place counts and the symbol (or ``other``); totals."""

    hashes: np.ndarray
    places: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    other: int
    ends: int
    tokens: int
    kinds: int

    @property
    def end(self) -> int:
        return self.other + 1

    @property
    def start(self) -> int:
        return self.other + 2

    @property
    def alphabet(self) -> int:
        return self.other + 3

    @property
    def symbol_of(self) -> np.ndarray:
        """The symbol of each place in the tier and of words outside it."""
        return np.append(self.symbols, self.other)

    def log_base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.tokens + self.kinds + 1.0))


def word_counts(docs: DataFrame) -> DataFrame:
    """hash, n over all texts: counted per batch, then added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["hash", "n"])

        for batch in batches:
            texts = utf8(batch.column(0))
            for a, b in chunks(texts):
                held.append(word_hashes(texts[a:b])[0])
                if sum(map(len, held)) > 2_000_000:
                    yield out()
        if held:
            yield out()

    return docs.select("text").mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, ends: int, times: int, most: int, tier: int) -> Words:
    """The words with at most ``tier`` in all above a count, found from a histogram of counts over fine logarithmic bins."""
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, kinds = (total["n"] or 0) + ends, total["v"] + (ends > 0)
    bins = counts.groupBy(F.floor(F.log2("n") * 64).alias("b")).count().collect()  # some thousands at most
    held, bound = 0, None
    for r in sorted(bins, key=lambda r: -r["b"]):
        if held + r["count"] > tier:
            break
        held, bound = held + r["count"], r["b"]
    top = counts.where(F.floor(F.log2("n") * 64) >= F.lit(bound if bound is not None else 1 << 40)).orderBy("hash").toArrow()
    h, n = top.column("hash").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(h)
    h, n = h[order], n[order]
    order = np.lexsort((h, -n))
    places = np.empty(len(h), np.int32)
    places[order] = np.arange(len(h))
    chosen = int((n[order[:most]] >= times).sum())
    symbols = np.minimum(np.arange(len(h), dtype=np.int32), chosen)
    return Words(h, places, n[order], symbols, chosen, ends, tokens, kinds)


CODED = "row long, doc_id long, learns boolean, n long, base double, known long, words array<int>, rare array<long>"


def coded(docs: DataFrame, words: Words) -> DataFrame:
    """Each text as places in the tier (its size: a word outside), with the base score and known tokens of its frequent words
    and end; the hashes of the others."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        log = np.append(w.log_base(w.counts), 0.0)
        for batch in batches:
            texts = utf8(batch.column("text"))
            for a, b in chunks(texts):
                h, counts, _ = word_hashes(texts[a:b])
                at = np.minimum(np.searchsorted(w.hashes, h), max(0, len(w.hashes) - 1))
                at = np.where(w.hashes[at] == h, w.places[at], len(w.hashes)) if len(w.hashes) else np.zeros(len(h), np.int64)
                hit = at < len(w.hashes)
                doc = np.repeat(np.arange(b - a), counts)
                base = np.bincount(doc, log[at], b - a) + w.log_base(np.float64(w.ends))
                known = np.bincount(doc, hit, b - a).astype(np.int64) + (w.ends > 0)
                off = np.concatenate([[0], np.cumsum(counts)])
                misses = np.concatenate([[0], np.cumsum(np.bincount(doc, ~hit, b - a))]).astype(np.int32)
                part = batch.slice(a, b - a)
                lists = [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(pa.array(misses), pa.array(h[~hit].view(np.int64)))]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), part.column("learns"), pa.array(counts + 1, pa.int64()), pa.array(base), pa.array(known), *lists], names=["row", "doc_id", "learns", "n", "base", "known", "words", "rare"])

    return docs.select("row", "doc_id", "learns", "text").mapInArrow(run, CODED)


def resolved(texts: DataFrame, counts: DataFrame, words: Words) -> DataFrame:
    """The texts with number (plus one) and count of each of their words outside the tier (0: never learned), and these words' base scores."""
    rare = texts.select("row", F.posexplode("rare").alias("at", "hash")).join(counts, "hash", "left")
    c = F.coalesce("n", F.lit(0))

    def in_order(value: Column) -> Column:
        """The values by their places: both in one number, of 32 bits each."""
        return F.sort_array(F.collect_list(F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(value)))

    def values(name: str) -> Column:
        return F.coalesce(F.transform(name, lambda x: x.bitwiseAND(F.lit((1 << 32) - 1))), F.array().cast("array<long>")).alias(name)

    rare = rare.groupBy("row").agg(
        F.sum(F.log10((c + 1.0) / F.lit(words.tokens + words.kinds + 1.0))).alias("rare_base"), F.count("n").alias("rare_known"),
        in_order(F.coalesce(F.col("id") + 1, F.lit(0))).alias("rare"), in_order(c).alias("rare_n"),
    )
    # rows are numbered anew in their new order, as neighbours pack better
    return texts.drop("rare").join(rare, "row", "left").select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "learns", "n", (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base"), (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("known"),
        "words", values("rare"), values("rare_n"),
    )


def sequences(column: pa.Array, w: Words, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one array: ``depth`` starts, the symbols, an end; the places of words; which places are predicted."""
    flat, sizes = w.symbol_of[column.flatten().to_numpy()], column.value_lengths().to_numpy(zero_copy_only=False)
    at = np.cumsum(sizes + depth + 1) - sizes - 1
    out = np.full(int((sizes + depth + 1).sum()), w.start, np.int32)
    inner = np.arange(len(flat)) + np.repeat(at - np.cumsum(sizes) + sizes, sizes)
    out[inner] = flat
    out[at + sizes] = w.end
    return out, inner, np.sort(np.concatenate([inner, at + sizes]))


def among(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The place of each code in a sorted table, -1 if absent."""
    if not len(table):
        return np.full(len(codes), -1, np.int64)
    at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
    return np.where(table[at] == codes, at, -1)


class Walk:
    """Places of held contexts, length by length: a context and the symbol after it lead to the context that is longer by that symbol."""

    def __init__(self, held: list[np.ndarray], alphabet: int):
        self.turns = []
        for shorter, codes in zip([np.zeros(1, np.int64), *held], held):
            turn = np.full((len(shorter) + 1, alphabet), -1, np.int32)  # the last row: of contexts that aren't held
            turn[among(codes // alphabet, shorter), codes % alphabet] = np.arange(len(codes))
            self.turns.append(turn)

    def places(self, seq: np.ndarray) -> Iterator[np.ndarray]:
        """For each length from one on the place of the context before each item, -1 if it isn't held."""
        here = np.zeros(len(seq), np.int32)
        for turn in self.turns:
            there = np.full(len(seq), -1, np.int32)
            there[1:] = turn[here[:-1], seq[:-1]]
            yield (here := there)

    def lengths(self, seq: np.ndarray) -> np.ndarray:
        """The length of the longest held suffix of the context before each item."""
        out = np.zeros(len(seq), np.int8)
        for k, place in enumerate(self.places(seq), 1):
            out[place >= 0] = k
        return out


def tallied(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below ``most``, sorted, and their counts."""
    if 8 * len(keys) < most:
        return np.unique(keys, return_counts=True)
    n = np.bincount(keys)
    some = np.flatnonzero(n)
    return some, n[some]


def next_counts(texts: DataFrame, w: Words, held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context code, symbol, count) for the last of the held lengths."""
    shared = texts.sparkSession.sparkContext.broadcast((w, held))
    length, a = len(held), w.alphabet

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, held = shared.value
        walk = Walk(held, a)
        for batch in batches:
            seq, _, at = sequences(batch.column(0), w, length)
            *_, place = walk.places(seq)
            place, symbol = place[at].astype(np.int64), seq[at]
            inside = place >= 0
            pair, n = tallied(place[inside] * a + symbol[inside], len(held[-1]) * a)
            yield pa.RecordBatch.from_arrays([pa.array(held[-1][pair // a] * a + pair % a), pa.array(n, pa.int64())], names=["pair", "n"])

    bounded_batches(texts.sparkSession)
    counts = texts.where("learns").select("words").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    t = counts.toArrow()  # at most contexts * symbols
    pair, n = t.column("pair").to_numpy(), t.column("n").to_numpy()
    order = np.argsort(pair)
    return pair[order] // a, pair[order] % a, n[order]


class State(NamedTuple):
    """Retained contexts of one length: codes, log10 of what the parent's share is; pairs (context * alphabet + symbol) with log10 p."""

    codes: np.ndarray
    back: np.ndarray
    pairs: np.ndarray
    logs: np.ndarray


def log_next(states: list[State], root: np.ndarray, alphabet: int, codes: list[np.ndarray], symbol: np.ndarray, length: int | None = None) -> np.ndarray:
    """log10 p(symbol | longest retained suffix); codes[k - 1] is the context of length k of each place."""
    out = root[symbol].copy()
    for k, s in enumerate(states if length is None else states[:length]):
        place = among(codes[k], s.codes)
        here = np.flatnonzero(place >= 0)
        pair = among(codes[k][here] * alphabet + symbol[here], s.pairs)
        out[here] = np.where(pair >= 0, s.logs[np.maximum(pair, 0)] if len(s.logs) else 0.0, out[here] + s.back[place[here]])
    return out


def learned(texts: DataFrame, w: Words, depth: int, times: int, most: int, weight: float) -> tuple[list[State], np.ndarray, list[np.ndarray]]:
    """The tree by length of context, log10 of the root's distribution over symbols, and the contexts counted by length."""
    a = w.alphabet
    by_symbol = np.zeros(w.other)
    by_symbol[w.symbols[w.symbols < w.other]] = w.counts[w.symbols < w.other]
    p = np.append((by_symbol + 1) / (w.tokens + w.kinds + 1.0), [0.0, (w.ends + 1) / (w.tokens + w.kinds + 1.0), 0.0])
    p[w.other] = 1 - p.sum()
    root = np.log10(np.maximum(p, 1e-300))
    states: list[State] = []
    keep_all: list[tuple[np.ndarray, ...]] = []
    wanted, counted = np.arange(a), []
    for length in range(1, depth + 1):
        context, symbol, n = next_counts(texts, w, [*counted, wanted])
        if not len(context):
            break
        kinds, first, of = np.unique(context, return_index=True, return_inverse=True)
        total = np.bincount(of, n)
        often = total >= times
        counted.append(kinds)
        # contexts one symbol longer occur at most as often as the last part of them; those with other words are counted word by word elsewhere
        longer = (n >= times) & (symbol != w.end) & (symbol != w.other) & (context != w.other)
        longer = np.flatnonzero(longer & (among((context * a + symbol) % a**length, kinds) >= 0))
        longer = longer[np.lexsort((context[longer] * a + symbol[longer], -n[longer]))[:most]]
        wanted = np.unique(context[longer] * a + symbol[longer])
        rows = often[of]
        context, symbol, n, of = context[rows], symbol[rows], n[rows], (np.cumsum(often) - 1)[of[rows]]
        keep_all.append((kinds[often], total[often], context, symbol, n, of))
        if not len(wanted):
            break
    # divergence tests, longest first, so that a retained context retains its suffixes
    tests: list[np.ndarray] = []
    logs: list[np.ndarray] = []
    full: list[State] = []
    for length, (kinds, total, context, symbol, n, of) in enumerate(keep_all, 1):
        parents = [context % a**k for k in range(1, length)]
        parent = log_next(full, root, a, parents, symbol, length - 1)
        own = np.log10((n + weight * 10**parent) / (total[of] + weight))
        gain = np.bincount(of, n * (np.log(n / total[of]) - parent * np.log(10)), len(kinds))
        tests.append(gain > np.bincount(of, minlength=len(kinds)))
        logs.append(own)
        full.append(State(kinds, np.log10(weight / (total + weight)), context * a + symbol, own))
    for length in range(len(keep_all) - 1, 0, -1):
        suffix = np.unique(keep_all[length][0][tests[length]] % a**length)
        tests[length - 1] |= np.isin(keep_all[length - 1][0], suffix)
    # values again, with only the retained contexts as parents
    for length, (kinds, total, context, symbol, n, of) in enumerate(keep_all, 1):
        r = tests[length - 1]
        rows = r[of]
        context, symbol, n, of = context[rows], symbol[rows], n[rows], of[rows]
        parent = log_next(states, root, a, [context % a**k for k in range(1, length)], symbol, length - 1)
        states.append(State(kinds[r], np.log10(weight / (total[r] + weight)), context * a + symbol, np.log10((n + weight * 10**parent) / (total[of] + weight))))
    return states, root, counted


class Tree:
    """The broadcast part in tables: log10 p of every symbol after every counted context, by the longest retained suffix."""

    def __init__(self, states: list[State], root: np.ndarray, counted: list[np.ndarray]):
        a = len(root)
        self.walk = Walk(counted, a)
        self.first = np.cumsum([0, 1, *map(len, counted)])
        self.logs = np.empty((self.first[-1], a))
        self.logs[0] = root
        for k, (state, codes) in enumerate(zip(states, counted)):
            shorter, log = self.logs[self.first[k] : self.first[k + 1]], self.logs[self.first[k + 1] : self.first[k + 2]]
            log[:] = shorter[among(codes % a**k, counted[k - 1]) if k else np.zeros(len(codes), np.int64)]
            log[among(state.codes, codes)] += state.back[:, None]
            log[among(state.pairs // a, codes), state.pairs % a] = state.logs

    def rows(self, seq: np.ndarray) -> np.ndarray:
        """The row of ``logs`` of the longest counted suffix of the context before each item."""
        row = np.zeros(len(seq), np.int32)
        for k, place in enumerate(self.walk.places(seq), 1):
            here = place >= 0
            row[here] = place[here] + self.first[k]
        return row


# ---------------------------------------------------------------- contexts that stay distributed


def packed(parts: list[np.ndarray]) -> bytes:
    """Arrays of one length, byte by byte of their items, compressed."""
    planes = [np.ascontiguousarray(p.view(np.uint8).reshape(len(p), p.itemsize).T) for p in parts]
    return pa.compress(b"".join(p.tobytes() for p in planes), codec="zstd", asbytes=True)


def steps(sorted_codes: np.ndarray) -> np.ndarray:
    """Sorted numbers as differences, which pack better; ``np.cumsum`` gives them back."""
    return np.diff(sorted_codes, prepend=sorted_codes.dtype.type(0))


def unpacked(data: bytes, n: int, kinds: list[str]) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    buf = np.frombuffer(pa.decompress(data, decompressed_size=n * sum(sizes), codec="zstd", asbytes=True), np.uint8)
    ends = np.cumsum(sizes) * n
    return [np.ascontiguousarray(buf[e - n * z : e].reshape(z, n).T).view(k).ravel() for e, z, k in zip(ends, sizes, kinds)]


def sorted_by(keys: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """The order by unsigned keys of some bits each, most significant first: of one number where the bits fit."""
    if sum(b for _, b in keys) > 64:
        return np.lexsort([k for k, _ in keys[::-1]])
    (code, _), *rest = keys
    code = code.astype(np.uint64)
    for k, b in rest:
        code = code << np.uint64(b) | k
    return np.argsort(code)


def record(depth: int) -> list[str]:
    """Of a token: the last two words, as differences; the words before them (all plus one; 0: no such context); the next word and, outside
    the tier, its count; the row; whether it learns and, from the second bit on, the length of the longest context that the broadcast part counts."""
    return ["<u8", *["<u4"] * (depth - 2), "<u4", "<u4", "<i8", "<u1"]


def deep_gains(texts: DataFrame, w: Words, learnt: tuple[list[State], np.ndarray, list[np.ndarray]], numbers: int, depth: int, times: int, weight: float) -> DataFrame:
    """row, deep: what contexts outside the broadcast part add to the log10 probability of a text. ``numbers``: of the words outside the tier."""
    spark = texts.sparkSession
    buckets = max(8, w.tokens >> 20)
    model = spark.sparkContext.broadcast((w, learnt))
    # numbers: the tier; a word never learned; the end; the start; words outside the tier
    outside = len(w.hashes)
    unseen, end, start, first_rare = range(outside, outside + 4)
    bits = (first_rare + numbers).bit_length()
    low, most = (1 if depth else 2), max(3, depth)
    kinds = record(most)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, (*_, counted) = model.value
        walk = Walk(counted, w.alphabet)
        often = np.append(w.counts >= times, False)  # no context of rarer words occurs often enough
        for whole in batches:
            ends = np.cumsum(whole.column("words").value_lengths().to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(ends // 1_000_000)) + 1), len(ends)]
            for batch in (whole.slice(i, j - i) for i, j in zip(cuts, cuts[1:]) if j > i):
                column = batch.column("words")
                flat, sizes = column.flatten().to_numpy(), column.value_lengths().to_numpy(zero_copy_only=False)
                seq, inner, at = sequences(column, w, most)
                number, count, word = np.full(len(seq), start, np.uint32), np.zeros(len(seq), np.uint32), np.zeros(len(seq), bool)
                number[inner], number[seq == w.end], word[inner] = flat, end, often[flat]
                rare = inner[flat == outside]
                ids, n = (batch.column(c).flatten().to_numpy() for c in ("rare", "rare_n"))
                number[rare], count[rare], word[rare] = np.where(ids > 0, ids - 1 + first_rare, unseen), n, n >= times
                # what the broadcast part counts of a context; a word that is no symbol looks there like any other such word
                held = walk.lengths(seq)[at]
                held[seq[at - 1] == w.other] = 0
                longest, open_ = np.zeros(len(at), np.int8), np.ones(len(at), bool)
                for k in range(1, most + 1):  # one start at most, as the first of a context
                    begins = number[at - k] == start
                    open_ &= word[at - k] | (begins & (k <= depth))
                    longest[open_] = k
                    open_ &= ~begins
                key = np.maximum(held + 1, low)
                take = np.flatnonzero(longest >= key)
                held, longest, key, place = held[take], longest[take], key[take], at[take]
                words = [np.where(longest >= k, number[place - k] + np.uint32(1), np.uint32(0)) for k in range(1, most + 1)]
                h = mixed(words[0].astype(np.uint64))
                for k in range(2, most + 1):
                    h = np.where(key >= k, mixed(h + words[k - 1]), h)
                bucket = (h % np.uint64(buckets)).astype(np.int32)
                del h, seq, inner, at, word, key
                row = np.repeat(batch.column("row").to_numpy(), sizes + 1)[take]
                flags = np.repeat(batch.column("learns").to_numpy(zero_copy_only=False).astype(np.uint8), sizes + 1)[take] | held.astype(np.uint8) << 1
                code = words[0].astype(np.uint64) << np.uint64(bits) | words[1]
                order = sorted_by([(bucket, buckets.bit_length()), (code, 2 * bits)])
                code, *parts = [x[order] for x in (code, *words[2:], number[place], count[place], row, flags)]
                b, first = np.unique(bucket[order], return_index=True)
                stop = np.append(first[1:], len(order))
                data = [packed([steps(code[i:j]), *(x[i:j] for x in parts)]) for i, j in zip(first, stop)]
                block = pa.array(np.full(len(b), batch.column("row")[0].as_py()), pa.int64())
                yield pa.RecordBatch.from_arrays([block, pa.array(b, pa.int32()), pa.array(stop[: len(b)] - first), pa.array(data, pa.binary())], names=["block", "bucket", "size", "data"])

    def broadcast_log(words: list[np.ndarray], held: np.ndarray, nxt: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the broadcast part says: the row of its longest context, log10 of p; a word gets its share of its symbol."""
        w, (states, root, counted) = model.value
        tree, symbol_of = Tree(states, root, counted), np.concatenate([w.symbols, [w.other, w.end, w.start, w.other]])
        symbols = [symbol_of[np.minimum(x.astype(np.int64) - 1, first_rare)] for x in words]
        row = np.zeros(len(nxt), np.uint32)
        for k in range(1, len(counted) + 1):
            here = np.flatnonzero((held >= k) | (k == 1))
            place = np.zeros(len(here), np.int32)
            for turn, x in zip(tree.walk.turns, symbols[:k][::-1]):
                place = turn[place, x[here]]
            row[here] = np.where(place >= 0, place + tree.first[k], 0)
        symbol = symbol_of[np.minimum(nxt, first_rare)]
        log = tree.logs[row, symbol]
        other = np.flatnonzero(symbol == w.other)
        n = np.append(w.counts, 0)[np.minimum(nxt[other], outside)] + count[other]
        log[other] += w.log_base(n) - root[w.other]
        return row, log

    def states_of(table: pa.Table) -> pa.Table:
        sizes = table.column("size").to_numpy()
        held = [unpacked(d.as_py(), int(n), kinds) for n, d in zip(sizes, table.column("data"))]
        for h in held:
            h[0] = np.cumsum(h[0])
        code, *words, nxt, count, row, flags = (np.concatenate([h[k] for h in held]) for k in range(len(kinds)))
        words = [(code >> np.uint64(bits)).astype(np.uint32), (code & np.uint64((1 << bits) - 1)).astype(np.uint32), *words]
        held, learns = flags >> 1, flags & 1
        del code
        rank, log = broadcast_log(words, held, nxt, count)
        p = 10**log
        # contexts of the broadcast part, and those of each length that are left, as numbers; what holds none yet begins with no word
        above = int(rank.max(initial=0)) + 1
        rank = np.where(held > 0, rank, np.uint32(0)) if low == 1 else words[0].copy()
        left = np.ones(len(p), bool)
        names = np.unique(nxt, return_inverse=True)[1].astype(np.uint32)
        for k in range(low, most + 1):
            at = np.flatnonzero(left & (held < k) & (words[k - 1] > 0))
            left[held < k] = False
            if not len(at):
                continue
            context, nexts = words[k - 1][at], names[at]
            order = sorted_by([(rank[at], int(rank[at].max()).bit_length()), (context, bits), (nexts, int(nexts.max()).bit_length())])
            at, context, nexts = at[order], context[order], nexts[order]
            turn = np.append(True, (rank[at[1:]] != rank[at[:-1]]) | (context[1:] != context[:-1]))
            turn2 = turn.copy()
            turn2[1:] |= nexts[1:] != nexts[:-1]
            of, lead = np.cumsum(turn) - 1, at[turn2]
            pair = np.cumsum(turn2) - 1
            total, n = np.bincount(of, learns[at]), np.bincount(pair, learns[at])
            owner, some = of[turn2], n > 0
            gain = np.bincount(owner[some], n[some] * np.log(n[some] / total[owner[some]] / p[lead[some]]), len(total))
            kept = (total >= times) & (gain > np.bincount(owner[some], minlength=len(total)))
            p[at] = np.where(kept[of], (n[pair] + weight * p[at]) / (total[of] + weight), p[at])
            # a longer context occurs at most as often
            rank[at], left[at] = (of + above).astype(np.uint32), total[of] >= times
        gains = np.log10(p) - log
        ends = np.cumsum(sizes)
        out = []
        for begin, stop in zip(ends - sizes, ends):
            rows, of = np.unique(row[begin:stop], return_inverse=True)
            g = np.bincount(of, gains[begin:stop])
            out.append((rows[g != 0], g[g != 0].astype(np.float32)))
        data = [packed(list(x)) for x in out]
        return pa.table({"block": table.column("block"), "size": pa.array([len(x[0]) for x in out], pa.int64()), "data": pa.array(data, pa.binary())})

    def sums(table: pa.Table) -> pa.Table:
        held = [unpacked(d.as_py(), n.as_py(), ["<i8", "<f4"]) for n, d in zip(table.column("size"), table.column("data"))]
        rows, of = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
        return pa.table({"row": rows, "deep": np.bincount(of, np.concatenate([h[1] for h in held]), len(rows))})

    sent = texts.select("row", "learns", "words", "rare", "rare_n").mapInArrow(records, "block long, bucket int, size long, data binary")
    # a task for each bucket, so that what a task reads does not grow with the corpus
    found = sent.repartitionById(buckets, "bucket").groupBy("bucket").applyInArrow(states_of, "block long, size long, data binary").where("size > 0")
    return found.groupBy("block").applyInArrow(sums, "row long, deep double")


def prepared(docs: DataFrame, scratch: Scratch, times: int, symbols: int, tier: int) -> tuple[DataFrame, Words, int]:
    """The texts in numbers, written; the frequent words; an upper bound of the numbers of all others."""
    taught = docs.where("learns")
    counts = scratch.written(word_counts(taught).withColumn("id", F.monotonically_increasing_id()), "word-counts")
    words = frequent(counts, taught.count(), times, symbols, tier)
    # ids count the rows of each partition; interleaved, they are close to the number of words
    part, at = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    parts, longest = counts.agg(F.coalesce(F.max(part), F.lit(0)) + 1, F.coalesce(F.max(at), F.lit(0)) + 1).first()
    if parts * longest >= 1 << 31:
        raise ValueError("over 2 billion distinct words")
    numbered = counts.select("hash", "n", (at * F.lit(parts) + part).alias("id"))
    texts = scratch.written(coded(docs, words), "coded-texts")
    release(docs.sparkSession)
    texts = scratch.written(resolved(texts, numbered, words), "texts")
    scratch.drop("word-counts", "coded-texts")
    return texts, words, parts * longest


def scored(docs: DataFrame, learns: Column, doc_id: str = "doc_id", text: str = "text", depth: int = 4, times: int = 2, symbols: int = 1024, contexts: int = 2048, tier: int = 1 << 17, weight: float = 20.0, deep: bool = True) -> DataFrame:
    """doc_id, learns, n_tokens, n_known, train_tokens, base_score, score (log10) of every row; without ``deep`` by the broadcast part alone."""
    if (symbols + 3) * max(symbols, contexts) > 1 << 26:
        raise ValueError("the broadcast part would be too large")
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))
    texts, words, numbers = prepared(rows, Scratch(spark), times, symbols, tier)
    learnt = learned(texts, words, depth, times, contexts, weight)
    release(spark)  # what came before is on disk no longer when the contexts are exchanged
    model = spark.sparkContext.broadcast(learnt)

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, tree = model.value[1], Tree(*model.value)
        for batch in batches:
            column = batch.column("words")
            seq, _, at = sequences(column, words, max(1, depth))
            gain = tree.logs[tree.rows(seq)[at], seq[at]] - root[seq[at]]
            sizes = column.value_lengths().to_numpy(zero_copy_only=False) + 1
            total = np.add.reduceat(gain, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("row", "doc_id", "learns", "n", "base", "known")), pa.array(total)], names=["row", "doc_id", "learns", "n", "base", "known", "gain"])

    scores = texts.select("row", "doc_id", "learns", "n", "base", "known", "words").mapInArrow(gains, "row long, doc_id long, learns boolean, n long, base double, known long, gain double")
    if deep and words.tokens:
        scores = scores.join(deep_gains(texts, words, learnt, numbers, depth, times, weight), "row", "left")
        scores = scores.withColumn("gain", F.col("gain") + F.coalesce("deep", F.lit(0.0)))
    return scores.select(
        "doc_id", "learns", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), (F.col("base") + F.col("gain")).alias("score"),
    )
