"""Exact repeats of ``length`` bytes by a hash-compared suffix sort.

Every window of ``length`` bytes has an anchor: the start of its smallest ``gram``-byte string by hash, the first on ties.
Equal windows have equal anchors at equal places, so windows need comparing only with windows of the same anchor string.
Consecutive windows of one anchor form a context, the bytes that they cover. Contexts are counted by digest; where an
anchor has several different contexts, one copy of each is sorted twice as suffixes, from the anchor on and from the
anchor backwards. The sort is a mergesort that compares two suffixes by the length of their common extension, found by
binary search over prefix polynomial hashes; every extension between neighbours is then verified byte by byte, and a
collision makes the batch sort again with another base. A window with a bytes before its anchor equals another one if
both are in one class at depth a backwards and at depth length - a forwards; classes follow from the sorted neighbours.

Anchors with more than ``HOT`` different contexts are split among tasks by more of the bytes that the windows share: windows
that begin low to high bytes before the anchor all hold the low bytes before it and the length - high bytes after it, so
only contexts with these bytes alike need sorting together. Ranges of ``WIDTH`` starts are split so; where more than ``HOT``
contexts still share such bytes, each window is grouped by its own bytes, which is exact and combines before the shuffle.

Equal contexts are told by a 64-bit anchor hash and a 128-bit BLAKE2 digest; all other equality is verified on bytes.

Defined results: null text is empty and keeps nothing; texts shorter than ``length`` stay; very long texts are read in
overlapping pieces of ``PIECE`` bytes; rows that repeat an id and its text are separate occurrences of their text; a null id
is treated like any other, as is any value of it; columns besides id, text and those in ``keep`` are not read; empty tables
give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, PrefixHash, bounded_batches, joined, mixed, powers, utf8, written

HOT, WIDTH = 1_000, 16
PIECE = 1_000_000
PLACE = "struct<d:long,r:long,a:int>"


def stored(docs: DataFrame, doc_id: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """row (a number of its own), id, held (columns to keep) and the text compressed, written down."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    held = F.struct(*keep) if keep else F.lit(None).cast("int")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).cast("long").alias("id"), held.alias("held"), t.alias("text"))
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([pack(t) for t in utf8(batch.column(3))], pa.binary())], names=["row", "id", "held", "packed"])

    return written(rows.mapInArrow(run, f"row long, id long, held {rows.schema['held'].dataType.simpleString()}, packed binary"), "texts")


def unpacked(column: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(x) for x in column.to_pylist()]


# ---------------------------------------------------------------- anchors and contexts


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """The minimum of each w consecutive values, by minima from block starts and to block ends."""
    n = len(x)
    if n < w:
        return x[:0]
    full = -(-n // w) * w
    pad = np.full(full, np.iinfo(x.dtype).max, x.dtype)
    pad[:n] = x
    blocks = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def contexts(buf: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Of a joined buffer: (text, anchor, first window start, last window start, anchor hash) of each context."""
    n = len(buf) - gram
    if n < length - gram + 1:  # no window
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    at = np.arange(n)
    h = mixed(PrefixHash(buf).of(at, at + gram))
    low = sliding_min((h >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64), length - gram + 1)
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.arange(len(anchor))
    text = np.searchsorted(off, start, "right") - 1
    good = start + length <= off[text + 1] - 1
    start, anchor, text = start[good], anchor[good], text[good]
    if not len(start):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)]))
    last = np.concatenate([new[1:], [len(start)]]) - 1
    return text[new], anchor[new], start[new], start[last], h[anchor[new]]


def pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in lists of about ``PIECE`` bytes: index, offset and bytes; longer texts overlap by length - 1."""
    index, start, held, size = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - length + 1), PIECE - length + 1):
            b = t[a : a + PIECE]
            if len(b) < length:
                continue
            if size + len(b) > PIECE and held:
                yield index, start, held
                index, start, held, size = [], [], [], 0
            index.append(i), start.append(a), held.append(b)
            size += len(b)
    if held:
        yield index, start, held


def anchor_counts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(gram, n): how many contexts have an anchor string."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, held in pieces(unpacked(batch.column(0)), length):
                h, n = np.unique(contexts(*joined(held), length, gram)[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int32())], names=["gram", "n"])

    return docs.select("packed").mapInArrow(run, "gram long, n int").groupBy("gram").agg(F.sum("n").alias("n"))


def occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per different context of a piece of a document: row, id, ats (bytes of its anchors, in order), low, high (bytes
    of its windows before the anchor: least and most), gram (anchor hash), digest (of the context's bytes)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = batch.column(0).to_numpy(), unpacked(batch.column(2))
            for index, begin, held in pieces(texts, length):
                buf, off = joined(held)
                text, anchor, first, last, h = contexts(buf, off, length, gram)
                raw = memoryview(buf)
                digest = b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), (last + length).tolist())])
                d1, d2 = np.frombuffer(digest, np.int64).reshape(-1, 2).T
                of, piece = np.array(index, np.int64)[text], text
                at = (anchor - off[text] + np.array(begin, np.int64)[text]).astype(np.int32)
                order = np.lexsort((at, d2, d1, h, piece))
                piece, h, d1, d2, of, at = piece[order], h[order], d1[order], d2[order], of[order], at[order]
                low, high = ((anchor - x)[order].astype(np.int32) for x in (last, first))
                new = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (h[1:] != h[:-1]) | (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])])) if len(at) else np.zeros(0, np.int64)
                ats = pa.ListArray.from_arrays(pa.array(np.append(new, len(at)), pa.int32()), pa.array(at))
                both = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(new), [None, pa.py_buffer(np.stack([d1[new], d2[new]], 1).tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(rows[of[new]]), batch.column(1).take(pa.array(of[new])), ats, *(pa.array(x[new]) for x in (low, high, h.view(np.int64))), both], names=["row", "id", "ats", "low", "high", "gram", "digest"])

    return docs.select("row", "id", "packed").mapInArrow(run, "row long, id long, ats array<int>, low int, high int, gram long, digest binary")


def with_text(rows: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """rows (place, low, high, gram, digest, hot) with ``context``, cut from the documents that have any."""
    lists = rows.groupBy(F.col("place.r").alias("row")).agg(F.collect_list(F.struct("low", "high", "gram", "digest", "hot", "place")).alias("wanted"))
    both = docs.select("row", "packed").join(lists, "row")
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, wanted = unpacked(batch.column("packed")), batch.column("wanted")
            lists = wanted.flatten()
            of = np.repeat(np.arange(len(texts)), wanted.value_lengths().to_numpy(zero_copy_only=False))
            low, high, g, d, hot, place = (lists.field(i) for i in range(6))
            cut = [texts[t][a - h : a - m + length] for t, a, m, h in zip(of.tolist(), place.field(2).to_pylist(), low.to_pylist(), high.to_pylist())]
            for s in range(0, len(cut), 5000):
                part = slice(s, s + 5000)
                yield pa.RecordBatch.from_arrays([g[part], d[part], low[part], high[part], hot[part], place[part], pa.array(cut[part], pa.binary())], names=["gram", "digest", "low", "high", "hot", "place", "context"])

    return both.select("packed", "wanted").mapInArrow(run, f"gram long, digest binary, low int, high int, hot boolean, place {PLACE}, context binary")


# ---------------------------------------------------------------- the sort


class Suffixes:
    """Suffixes of a buffer: starts, lengths; compared by common extension."""

    def __init__(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray, base: int = BASE):
        self.buf, self.start, self.size = np.append(buf, 0), start, size
        n = len(buf)
        self.power = powers(base, n + 1)
        inverse = powers(pow(base, -1, 1 << 64), n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * inverse[:n], out=self.prefix[1:])

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes i and j, by binary search over hashes."""
        a, b = self.start[i], self.start[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.size[i], self.size[j])
        pa_, pb_, ba, bb = self.prefix[a], self.prefix[b], self.power[a], self.power[b]
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            same = (self.prefix[a + mid] - pa_) * ba == (self.prefix[b + mid] - pb_) * bb
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i comes before suffix j; equal ones by index."""
        n = self.common(i, j)
        si, sj = self.size[i], self.size[j]
        end = (n == si) | (n == sj)
        x, y = self.buf[self.start[i] + np.where(end, 0, n)], self.buf[self.start[j] + np.where(end, 0, n)]
        return np.where(end, (si < sj) | ((si == sj) & (i < j)), x < y)

    def verified(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> bool:
        """Whether the first n bytes of suffixes i and j are equal, byte by byte, for all pairs."""
        step = max(1, 1_000_000 // max(1, int(n.max(initial=1))))
        for s in range(0, len(i), step):
            m = n[s : s + step]
            inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            if not np.array_equal(self.buf[np.repeat(self.start[i[s : s + step]], m) + inner], self.buf[np.repeat(self.start[j[s : s + step]], m) + inner]):
                return False
        return True


def merge_sorted(s: Suffixes, at: np.ndarray) -> np.ndarray:
    """The suffixes of each group (bounds ``at``) in order: runs of doubling width are merged, all groups at once; an
    element's place in a merged run is its place in its own plus the number of smaller ones in the other, by bisection."""
    order = np.arange(at[-1])
    size = np.repeat(np.diff(at), np.diff(at))
    first = np.repeat(at[:-1], np.diff(at))
    width = 1
    while (live := np.flatnonzero(size > width)).size:
        here = live - first[live]
        run = here // width
        mate = (run ^ 1) * width
        low = np.minimum(mate, size[live])
        start, high = low.copy(), np.minimum(mate + width, size[live])
        mine = order[live]
        while (busy := np.flatnonzero(low < high)).size:
            mid = (low[busy] + high[busy]) >> 1
            before = s.less(order[first[live[busy]] + mid], mine[busy])
            low[busy] = np.where(before, mid + 1, low[busy])
            high[busy] = np.where(before, high[busy], mid)
        place = (run // 2) * 2 * width + here - run * width + (low - start)
        order[first[live] + place] = mine
        width *= 2
    return order


def neighbours(buf: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order and the common extension of each suffix with the one before it (-1 at the start of a group)."""
    base = BASE
    while True:
        s = Suffixes(buf, start, size, base)
        order = merge_sorted(s, at)
        common = np.full(len(order), -1, np.int64)
        inner = np.setdiff1d(np.arange(len(order)), at[:-1])
        common[inner] = s.common(order[inner - 1], order[inner])
        if s.verified(order[inner - 1], order[inner], common[inner]):
            return order, common
        base = (base * 0x2545F4914F6CDD1D + 2) | 1  # a collision: once more with another base


def classified(texts: list[bytes], before: np.ndarray, low: np.ndarray, at: np.ndarray, rank: np.ndarray, length: int) -> np.ndarray:
    """(contexts, window) states: 0 no other context has the window, 1 one of lower rank has it, 2 others have it, of higher rank.

    before: bytes before the anchor. low: the least number of bytes of a window before the anchor. at: group bounds."""
    sizes = np.array([len(t) for t in texts])
    buf = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum(sizes) - sizes
    anchor = begin + before
    forward = neighbours(buf, anchor, sizes - before, at)
    backward = neighbours(buf[::-1].copy(), len(buf) - anchor, before, at)
    n, most = len(texts), int(before.max(initial=0))
    state = np.zeros((n, most + 1), np.int8)
    for a in range(most + 1):
        here = np.flatnonzero((low <= a) & (a <= before))
        if len(here) < 2:
            continue
        key = np.zeros(n, np.int64)
        for (order, common), depth in ((forward, length - a), (backward, a)):
            part = np.empty(n, np.int64)
            part[order] = np.cumsum(common < depth)
            key = key * (n + 1) + part
        k = key[here]
        order = np.lexsort((rank[here], k))
        k = k[order]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        alone = new & np.concatenate([new[1:], [True]])
        state[here[order], a] = np.where(alone, 0, np.where(new, 2, 1))
    return state


CUT = "gram long, digest binary, state int, low int, high int"


def runs(g: pa.Array, d: pa.Array, state: np.ndarray) -> pa.RecordBatch:
    """Runs of equal non-zero state as rows."""
    padded = np.zeros((len(state), state.shape[1] + 2), np.int8)
    padded[:, 1:-1] = state
    change = np.diff(padded, axis=1) != 0
    row, col = np.nonzero(change[:, :-1] & (state > 0))
    erow, ecol = np.nonzero(change[:, 1:] & (state > 0))
    assert np.array_equal(row, erow)
    return pa.RecordBatch.from_arrays([g.take(pa.array(row)), d.take(pa.array(row)), pa.array(state[row, col].astype(np.int32)), pa.array(col.astype(np.int32)), pa.array(ecol.astype(np.int32))], names=["gram", "digest", "state", "low", "high"])


def sorted_cuts(rows: DataFrame, length: int) -> DataFrame:
    """Cuts of contexts (gram, key, digest, low, high, place, context); those of a (gram, key) come together in a task."""
    bounded_batches(rows.sparkSession)

    def keys(t: pa.Table) -> np.ndarray:
        return np.stack([t.column(k).to_numpy() for k in ("gram", "key")], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 4096:
                continue
            now = pa.Table.from_batches(held).combine_chunks()
            g = keys(now)
            other = np.flatnonzero(np.any(g != g[-1], axis=1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield solve(now.slice(0, cut))
            held = now.slice(cut).to_batches()
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    def solve(t: pa.Table) -> pa.RecordBatch:
        g = keys(t)
        at = np.concatenate([[0], np.flatnonzero(np.any(g[1:] != g[:-1], axis=1)) + 1, [len(g)]])
        place = t.column("place").combine_chunks()
        rank = np.empty(len(g), np.int64)
        rank[np.lexsort([place.field(i).to_numpy() for i in (2, 1, 0)])] = np.arange(len(g))
        state = classified(t.column("context").to_pylist(), t.column("high").to_numpy().astype(np.int64), t.column("low").to_numpy().astype(np.int64), at, rank, length)
        return runs(t.column("gram").combine_chunks(), t.column("digest").combine_chunks(), state)

    return rows.repartition("gram", "key").sortWithinPartitions("gram", "key").select("gram", "key", "digest", "low", "high", "place", "context").mapInArrow(run, CUT)


def narrowed(rows: DataFrame, length: int, width: int) -> DataFrame:
    """Each context cut into the ranges of ``width`` window starts that it has; key: of the range and the bytes that all its
    windows share. Contexts of different keys have no window in common; equal keys by chance do no harm, as bytes are compared."""
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, low, high = batch.column("context").to_pylist(), batch.column("low").to_pylist(), batch.column("high").to_pylist()
            of, key, lows, highs, cut = [], [], [], [], []
            for r, (t, m, h) in enumerate(zip(text, low, high)):
                for lo in range(m // width * width, h + 1, width):
                    hi = lo + width - 1
                    a, b = max(m, lo), min(h, hi)
                    of.append(r), key.append(xxhash.xxh3_64_intdigest(t[h - lo : h - hi + length], lo)), lows.append(a), highs.append(b), cut.append(t[h - b : h - a + length])
            take = pa.array(of, pa.int64())
            keys = pa.array(np.array(key, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("gram").take(take), keys, batch.column("digest").take(take), pa.array(lows, pa.int32()), pa.array(highs, pa.int32()), batch.column("place").take(take), pa.array(cut, pa.binary())], names=["gram", "key", "digest", "low", "high", "place", "context"])

    return rows.select("gram", "digest", "low", "high", "place", "context").mapInArrow(run, f"gram long, key long, digest binary, low int, high int, place {PLACE}, context binary")


def grouped_cuts(rows: DataFrame, length: int) -> DataFrame:
    """The same for contexts that share so many bytes that a task should not sort them: windows grouped by their bytes."""
    starts = F.explode(F.sequence("low", "high"))
    windows = rows.withColumn("a", starts).select("gram", "digest", "a", "place", F.expr(f"substring(context, high - a + 1, {length})").alias("window"))
    shared = windows.groupBy("gram", "a", "window").agg(F.count("*").alias("n"), F.min("place").alias("least")).where("n > 1")
    found = windows.join(shared, ["gram", "a", "window"])
    state = F.when(F.col("place") == F.col("least"), 2).otherwise(1)
    return found.select("gram", "digest", state.alias("state"), F.col("a").alias("low"), F.col("a").alias("high"))


def cuts_of(rows: DataFrame, length: int, hot: int) -> DataFrame:
    """Cuts of contexts (with text); those of hot anchors are split by more shared bytes first."""
    whole = rows.where("not hot").withColumn("key", F.lit(0).cast("long"))
    split = rows.where("hot")
    if split.isEmpty():
        return sorted_cuts(whole, length)
    split = written(narrowed(split, length, max(1, min(WIDTH, length // 2))), "split-contexts")
    full = written(split.groupBy("gram", "key").count().where(F.col("count") > hot).select("gram", "key"), "full-keys")
    cuts = sorted_cuts(whole.drop("hot").unionByName(split.join(full, ["gram", "key"], "left_anti")), length)
    if full.isEmpty():
        return cuts
    return cuts.unionByName(grouped_cuts(split.join(full, ["gram", "key"], "left_semi"), length))


# ---------------------------------------------------------------- documents


def repeated_ranges(docs: DataFrame, length: int = 200, gram: int = 32, keep_first: bool = False, hot: int = HOT) -> DataFrame:
    """docs: stored(). A row per context that repeats: row, ranges (start and end in bytes; they may overlap).

    keep_first spares, of each window's occurrences, the one with the least (id, row, byte); a null id comes first."""
    shared = written(anchor_counts(docs, length, gram).where("n > 1").select("gram"), "shared-anchors")
    occ = written(occurrences(docs, length, gram).join(shared, "gram"), "contexts")
    place = F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("d"), F.col("row").alias("r"), F.col("ats")[0].alias("a"))
    classes = occ.groupBy("gram", "digest").agg(F.sum(F.size("ats")).alias("n"), F.min(F.struct(place.alias("place"), "low", "high")).alias("f"))
    classes = written(classes.select("gram", "digest", "n", "f.*"), "context-classes")
    several = written(classes.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1").select("gram", (F.col("kinds") > hot).alias("hot")), "several-contexts")
    compared = written(with_text(classes.join(several, "gram"), docs, length), "compared-contexts")
    cuts = cuts_of(compared, length, hot)
    none = F.lit(None).cast(PLACE).alias("place")
    copies = classes.where("n > 1").select("gram", "digest", F.col("low").alias("from"), F.col("high").alias("to"), F.col("place") if keep_first else none)
    other = cuts.where("state = 1" if keep_first else "state > 0").select("gram", "digest", F.col("low").alias("from"), F.col("high").alias("to"), none)
    # one row per context, written so that hot contexts' occurrences can be split among tasks
    all_cuts = written(copies.unionByName(other).groupBy("gram", "digest").agg(F.collect_list(F.struct("from", "to", "place.r", "place.a")).alias("cuts")), "cuts")
    found = occ.join(all_cuts, ["gram", "digest"])

    def stretches(at):
        own = lambda c: c["r"].eqNullSafe(F.col("row")) & c["a"].eqNullSafe(at)
        return F.transform(F.filter("cuts", lambda c: ~own(c)), lambda c: F.struct((at - c["to"]).alias("start"), (at - c["from"] + length).alias("end")))

    ranges = F.flatten(F.transform("ats", stretches))
    return found.select("row", ranges.alias("ranges")).where(F.size("ranges") > 0)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 200, gram: int = 32, keep_first: bool = False, keep: tuple[str, ...] = (), hot: int = HOT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, original, kept (what is left, in whole characters) and
    the columns in ``keep``. ``kept`` is null where it isn't asked for by ``keep_first`` or ``keep``."""
    rows = stored(docs, doc_id, text, keep)
    ranges = repeated_ranges(rows, length, gram, keep_first, hot)
    lists = written(ranges.groupBy("row").agg(F.flatten(F.collect_list("ranges")).alias("ranges")), "repeats")
    both = rows.join(lists, "row", "left")
    bounded_batches(docs.sparkSession)
    texts = keep_first or bool(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, cut in zip(unpacked(batch.column("packed")), batch.column("ranges")):
                kept, removed, spans = raw, 0, 0
                if cut.is_valid:
                    edge = np.zeros(len(raw) + 1, np.int32)
                    np.add.at(edge, cut.values.field(0).to_numpy(), 1)
                    np.add.at(edge, cut.values.field(1).to_numpy(), -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed, spans = int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), *((raw.decode("utf-8", "replace"), kept.decode("utf-8", "ignore")) if texts else (None, None))))
            columns = list(zip(*out)) or [()] * 6
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(),) * 3 + (pa.string(),) * 3)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held"), *arrays], names=["doc_id", "held", "n_bytes", "n_removed", "n_spans", "kept_sha256", "original", "kept"])

    held = rows.schema["held"].dataType.simpleString()
    found = both.select("id", "held", "packed", "ranges").mapInArrow(run, f"doc_id long, held {held}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, original string, kept string")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "original", "kept"]
    return found.select(*names, *(F.col(f"held.{c}").alias(c) for c in keep))
