"""All pairs of similar texts, up to connected components: a prefix-filtered join of shingle sets.

All shingles have one order, frequent ones last: by how often the shingles of their bucket occur in the corpus, counted over all
texts in ``2**ORDER_BITS`` buckets (any order gives the same result). Two sets of sizes n and m with a Jaccard similarity of s or
more share a shingle among the first n - ceil(s n) + 1 and m - ceil(s m) + 1 in that order. So the texts that meet at a shingle of
their prefixes hold every similar pair. Shingles that one text alone has in its prefix bring nobody together and leave first; of
shingles with the same texts one is enough.

Texts that meet are compared where they meet, in one task, by a bound that never drops a similar pair: each set has a parity bitmap
(a shingle flips one bit), and bitmaps differ in at most as many bits as the sets differ in shingles. A bitmap has at least
as many bits as the set has shingles (a power of two, ``BITS`` at least), so that the bound is as sharp for long texts as for short
ones; of two lengths the longer bitmap is folded. What passes is verified on the sets themselves.

Only components matter, so texts that links known before already join need not be compared, and a shingle whose texts are all in
one component takes no part. In the first rounds a text hands on its nearest partners of other components by bitmap, a number
linear in the rows, which joins groups of copies; the last round hands on all partners that are left in other components
and weren't compared before. Nothing is cut; shingles that more than ``BUCKET`` rows share are dealt out as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, release, small, utf8, written
from .simhash import BUCKET, blocked, components, links as fingerprint_links, majority, shingle_hashes, similar_pairs

#: Buckets in which shingles are counted for the order, and how many one row of counts has.
ORDER_BITS, ORDER_BLOCK = 22, 1 << 16
#: Bits that tell which prefix shingles several texts have (a bit that shingles share only keeps more of them).
SHARED_BITS = 26
#: Least bits of a bitmap; all bitmaps fold to this length.
BITS = 512
LANES = BITS // 64
#: How many of its nearest partners a text hands on in each round; the last hands on all.
ROUNDS = (2, 16, None)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, words), np.uint64))


def described(texts: DataFrame, words: int) -> DataFrame:
    """Of texts (id, text): id, f0 (fingerprint of the set) and digest (of the set); and rows (block, counts): how many shingles of
    the sets fall in each bucket, per task, 65,535 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << ORDER_BITS, np.int64)
        names = ["id", "f0", "digest", "block", "counts"]
        for batch in batches:
            each = [shingle_set(t, words) for t in utf8(batch.column(1))]
            flat, n = np.concatenate([np.zeros(0, np.uint64), *each]), len(each)
            total += np.bincount((flat >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=len(total))
            prints = majority(flat, np.array([len(x) for x in each], np.int64))
            digest = [xxhash.xxh3_128_digest(x.tobytes()) for x in each]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), pa.array(digest, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        counts = np.minimum(total, 65_535).astype(np.uint16).reshape(-1, ORDER_BLOCK)
        full = np.flatnonzero(counts.any(1))
        none = [pa.nulls(len(full), t) for t in (pa.int64(), pa.int64(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(full.astype(np.int32)), pa.array([counts[i].tobytes() for i in full], pa.binary())], names=names)

    return texts.select("id", "text").mapInArrow(run, "id long, f0 long, digest binary, block int, counts binary")


def bucket_weights(counts: DataFrame) -> np.ndarray:
    """The sums of rows (block, counts), for all buckets, in eighths of a power of two: a byte each, whatever the data. Added up within
    tasks first."""

    def added(kind: type, last: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    sums[block] = sums.get(block, 0) + np.frombuffer(raw, kind).astype(np.int64)
            out = [np.minimum(8 * np.log2(x + 1.0), 255).astype(np.uint8) if last else x for x in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in out], pa.binary())], names=["block", "counts"])

        return run

    schema = "block int, counts binary"
    t = counts.mapInArrow(added(np.uint16, False), schema).repartition("block").mapInArrow(added(np.int64, True), schema).toArrow()
    out = np.zeros(((1 << ORDER_BITS) // ORDER_BLOCK, ORDER_BLOCK), np.uint8)
    for block, raw in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
        out[block] = np.frombuffer(raw, np.uint8)
    return out.ravel()


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Parities: which bits an odd number of shingles falls on. As many bits as shingles at least."""
    bits = max(BITS, 1 << (len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(maps: np.ndarray, lanes: int) -> np.ndarray:
    """Bitmaps (rows of one length) brought down to ``lanes`` words."""
    while maps.shape[1] > lanes:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def prefix_of(s: np.ndarray, least: float, weights: np.ndarray) -> np.ndarray:
    k = len(s) - ceil(least * len(s) - 1e-9) + 1 if len(s) else 0
    return s[np.lexsort((s, weights[(s >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]))[:k]]


def prefixes(texts: DataFrame, words: int, least: float, weights: np.ndarray, shared: np.ndarray | None = None) -> DataFrame:
    """(h, id, size, bits): the shingles of each text's prefix. With ``shared`` only those whose bit is set, and for each text a
    row with its size and bitmap and a null h."""
    model = texts.sparkSession.sparkContext.broadcast((weights, shared))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, shared = model.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            sets = [shingle_set(t, words) for t in utf8(batch.column(1))]
            each = [prefix_of(s, least, weights) for s in sets]
            h, owner = np.concatenate([np.zeros(0, np.uint64), *each]), np.repeat(ids, [len(x) for x in each])
            if shared is not None:
                place = (h >> np.uint64(64 - SHARED_BITS)).astype(np.int64)
                keep = np.unpackbits(shared[place >> 3, None], axis=1, bitorder="little")[np.arange(len(h)), place & 7] == 1 if len(h) else np.zeros(0, bool)
                h, owner = h[keep], owner[keep]
            n = len(h)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(owner), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=["h", "id", "size", "bits"])
            if shared is not None:
                full = [i for i, s in enumerate(sets) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(full), pa.int64()), pa.array(ids[full]), pa.array([len(sets[i]) for i in full], pa.int32()), pa.array([bitmap(sets[i]).tobytes() for i in full], pa.binary())], names=["h", "id", "size", "bits"])

    return texts.select("id", "text").mapInArrow(run, "h long, id long, size int, bits binary")


def shared_bits(shingles: DataFrame) -> np.ndarray:
    """A bit for each h in several rows; the driver gets ``2**SHARED_BITS`` bits at most."""
    place = f"shiftrightunsigned(h, {64 - SHARED_BITS})"
    several = shingles.groupBy("h").count().where("count > 1")
    bits = several.select(F.expr(f"shiftright({place}, 6)").alias("w"), F.expr(f"shiftleft(1L, cast({place} & 63 as int))").alias("b"))
    t = bits.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (SHARED_BITS - 6), np.uint64)
    out[t.column("w").to_numpy()] = t.column("b").to_numpy().view(np.uint64)
    return out.view(np.uint8)


# ---------------------------------------------------------------- where texts meet


class Sketches:
    """Sizes and bitmaps of rows, bitmaps of one length together."""

    def __init__(self, size: np.ndarray, bits: list[bytes]):
        self.size = size.astype(np.int64)
        length = np.array([len(b) // 8 for b in bits], np.int64)
        self.length, self.place, self.maps = length, np.zeros(len(bits), np.int64), {}
        for n in np.unique(length).tolist():
            own = np.flatnonzero(length == n)
            self.place[own] = np.arange(len(own))
            self.maps[n] = np.frombuffer(b"".join(bits[i] for i in own.tolist()), np.uint64).reshape(-1, n)
        self.short = np.zeros((len(bits), LANES), np.uint64)
        for n, maps in self.maps.items():
            self.short[length == n] = folded(maps, LANES)

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """In how many bits the bitmaps of rows i and j differ, at the length of the shorter."""
        out = np.zeros(len(i), np.int64)
        a, b = self.length[i], self.length[j]
        for n in np.unique(np.stack([a, b], 1), axis=0).tolist() if len(i) else []:
            rows = np.flatnonzero((a == n[0]) & (b == n[1]))
            step = max(1, 4_000_000 // max(n))
            for part in (rows[k : k + step] for k in range(0, len(rows), step)):
                x, y = self.maps[n[0]][self.place[i[part]]], self.maps[n[1]][self.place[j[part]]]
                out[part] = np.bitwise_count(folded(x, min(n)) ^ folded(y, min(n))).sum(1, dtype=np.int64)
        return out


def partners(edge: np.ndarray, c: np.ndarray, sketches: Sketches, least: float, take: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of rows of one bucket (bounds ``edge``) and different components that can be similar: of each row its
    ``take`` nearest, or all, each pair once."""
    size = sketches.size
    many = np.repeat(np.diff(edge), np.diff(edge))
    first = np.repeat(edge[:-1], np.diff(edge))
    upto = np.cumsum(many)
    out = [(np.zeros(0, np.int64),) * 2]
    low = 0
    while low < len(c):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + 1_000_000, "right")))
        m = many[low:high]
        i = np.repeat(np.arange(low, high), m)
        j = np.repeat(first[low:high], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        ok = (c[i] != c[j]) if take else (c[i] != c[j]) & (i < j)
        i, j = i[ok], j[ok]
        total = size[i] + size[j]
        needed = np.ceil(total * (least / (1 + least)) - 1e-9).astype(np.int64)
        ok = np.minimum(size[i], size[j]) >= needed
        i, j, most = i[ok], j[ok], (total - 2 * needed)[ok]
        apart = np.zeros(len(i), np.int64)
        for lane in sketches.short.T:
            apart += np.bitwise_count(lane[i] ^ lane[j])
        ok = apart <= most
        i, j, most = i[ok], j[ok], most[ok]
        apart = sketches.apart(i, j)
        ok = apart <= most
        i, j, apart = i[ok], j[ok], apart[ok]
        if take and len(i):
            order = np.lexsort((j, apart, i))
            i, j = i[order], j[order]
            near = np.arange(len(i)) - np.searchsorted(i, i) < take
            i, j = i[near], j[near]
        out.append((i, j))
        low = high
    return tuple(np.concatenate(x) for x in zip(*out))


def meetings(rows: DataFrame, keys: list[str], least: float, take: int | None) -> DataFrame:
    """Pairs (a, b) of rows (keys, c, id, size, bits) that meet at a key; see ``partners``."""

    def of_buckets(t: pa.Table) -> pa.RecordBatch:
        key = np.stack([t.column(k).to_numpy() for k in keys], 1)
        edge = np.concatenate([[0], np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1, [len(key)]])
        ident = t.column("id").to_numpy()
        i, j = partners(edge, t.column("c").to_numpy(), Sketches(t.column("size").to_numpy(), t.column("bits").to_pylist()), least, take)
        i, j = ident[i], ident[j]
        found = np.unique(np.stack([np.minimum(i, j), np.maximum(i, j)], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 50_000 and sum(b.nbytes for b in held) < 32 << 20:
                continue
            now = pa.Table.from_batches(held).combine_chunks()
            key = np.stack([now.column(k).to_numpy() for k in keys], 1)
            other = np.flatnonzero(np.any(key != key[-1], axis=1))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield of_buckets(now.slice(0, cut))
            held = now.slice(cut).to_batches()
        if held:
            yield of_buckets(pa.Table.from_batches(held).combine_chunks())

    return rows.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "c", "id", "size", "bits").mapInArrow(run, "a long, b long").distinct()


def shared_prefixes(texts: DataFrame, words: int, least: float, weights: np.ndarray, apart: DataFrame | None, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(h, id) of prefix shingles that bring texts together, and (id, size, bits) of these texts."""
    without = lambda df: df if apart is None else df.join(small(apart), "id", "left_anti")
    bits = shared_bits(without(prefixes(texts, words, least, weights)))
    release(texts.sparkSession)
    each = scratch.written(without(prefixes(texts, words, least, weights, bits)), "prefixes")
    rows = each.where("h is not null").select("h", "id")
    # shingles with the same texts: the number of texts and two xors of their hashes agree
    lists = rows.groupBy("h").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    one = lists.where("n > 1").groupBy("n", "x", "y").agg(F.min("h").alias("h")).select("h")
    shared = scratch.written(rows.join(one, "h", "left_semi"), "shared")
    maps = scratch.written(each.where("h is null").select("id", "size", "bits").join(shared.select("id").distinct(), "id", "left_semi"), "bitmaps")
    scratch.drop("prefixes")
    return shared, maps


def similar_components(texts: DataFrame, links: DataFrame, words: int, least: float, bucket: int = BUCKET, apart: DataFrame | None = None, weights: np.ndarray | None = None) -> DataFrame:
    """(node, component) of all pairs of texts (id, text) with a similarity of ``least`` or more, for nodes that have any.
    ``links`` (a, b) must be such pairs; they save comparisons and change nothing. Ids must be unique. ``apart``: ids (id) of
    texts to leave out. ``weights``: see ``bucket_weights``."""
    scratch = Scratch(texts.sparkSession)
    if weights is None:
        weights = bucket_weights(described(texts, words).where("block is not null").select("block", "counts"))
    shared, maps = shared_prefixes(texts, words, least, weights, apart, scratch)
    shared, keys = blocked(shared, ["h"], "id", bucket)
    compared, found = None, components(links)
    for take in ROUNDS:
        now = shared.join(found.withColumnRenamed("node", "id"), "id", "left").select(*keys, "id", F.coalesce("component", "id").alias("c"))
        several = now.groupBy(*keys).agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select(*keys)
        pairs = meetings(now.join(several, keys, "left_semi").join(maps, "id"), keys, least, take)
        pairs = written(pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti"), "meeting-pairs")
        compared = pairs if compared is None else compared.union(pairs)
        more = similar_pairs(pairs, texts, words, least)
        if not more.isEmpty():
            links = links.union(more)
            found = components(links)
    scratch.clear()
    return found


def near_duplicates(docs: DataFrame, doc_id: str, text: str, words: int = 5, similarity: float = 0.8, distance: int = 4) -> DataFrame:
    """doc_id, component_id for every row: components of all pairs whose shingle sets have that similarity; ids must be unique.

    Texts of equal sets are one node. Fingerprints of the sets (each shingle once) within ``distance`` are found by generalised
    pigeonhole search and propose links, a number linear in the rows; they count only if they hold for the sets. No distance of
    fingerprints guarantees a similarity, so the join then finds all pairs that are left."""
    bounded_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    each = scratch.written(described(texts, words), "described")
    weights = bucket_weights(each.where("block is not null").select("block", "counts"))
    prints = scratch.written(each.where("block is null").select("id", "f0", "digest"), "fingerprints")
    scratch.drop("described")
    nodes = scratch.written(prints.groupBy("digest", "f0").agg(F.min("id").alias("node")), "distinct-sets")
    again = scratch.written(prints.select("id").join(nodes.select(F.col("node").alias("id")), "id", "left_anti"), "repeated-sets")
    close = scratch.written(fingerprint_links(nodes, distance).distinct(), "close-pairs")
    found = similar_components(texts, similar_pairs(close, texts, words, similarity), words, similarity, apart=again, weights=weights)
    named = nodes.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    out = written(prints.select(F.col("id").alias("doc_id"), "digest").join(named, "digest").drop("digest"), "near-duplicates")
    scratch.clear()
    release(docs.sparkSession)
    return out
