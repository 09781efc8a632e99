"""SimHash near-duplicates by generalised pigeonhole search.

Fingerprints come from hashed word shingles. The fingerprint's bits are dealt into partitions (correlated bits together) and
each partition gets its own threshold; when the thresholds plus one sum to the distance plus one, two fingerprints within
the distance agree up to the threshold in at least one partition. Thresholds are chosen by dynamic programming over
estimated candidate and probe counts. Every fingerprint goes into the bucket of each partition's value and, for a threshold
t, of every value at up to t bits from it; rows of a bucket are compared by distance and only a spanning forest of the
links is kept, so that a bucket of close copies doesn't become all its pairs.

Buckets above ``BUCKET`` rows are dealt out as pairs of blocks. Components are found by alternating large-star and
small-star steps on distributed edge tables.

Defined results: null text is empty; a text without words has the zero fingerprint and links like any other; a text of
fewer words than a shingle is one shingle; very long texts are taken whole; repeated ids are separate rows; rows with a null
id link like any other (their component is null where no row in it has an id); columns besides id and text are not read, whatever their names; empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, bounded_batches, chunks, hash_sample, mixed, small, utf8, written

SEED = 42
#: Rows of one bucket that one task compares; larger buckets are dealt out as pairs of blocks.
BUCKET = 20_000
#: Fingerprints on which partitions and thresholds are planned (results don't depend on them).
PLAN_SAMPLE = 4_000


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: bytes, words: int) -> list[int]:
    w = text.lower().split()  # bytes: lower() maps A-Z only, split() at ASCII white space only
    if not w:
        return []
    if len(w) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(w), SEED)]
    flat = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w])
    starts = (ends - [len(x) + 1 for x in w])[: len(w) - words + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(flat[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document the bits set in over half of its hashes."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    at = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
    for b in range(64):
        bit = ((hashes >> np.uint64(b)) & np.uint64(1)).astype(np.int64)
        out[full] |= (np.add.reduceat(bit, at) * 2 > counts[full]).astype(np.uint64) << np.uint64(b)
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, lanes: int = 1, sets: bool = False) -> DataFrame:
    """doc_id and f0.. (64 bits each). Lane 0 takes the shingle hashes themselves, further lanes a mix of them. With
    ``sets`` each different shingle counts once, and ``digest`` tells equal sets."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            lane: list[list[np.ndarray]] = [[] for _ in range(lanes)]
            digest: list[bytes] = []
            for a, b in chunks(texts, 1_000_000):
                each = [shingle_hashes(t, words) for t in texts[a:b]]
                if sets:
                    each = [np.unique(np.array(x, np.uint64)) for x in each]
                    digest += [xxhash.xxh3_128_digest(x.tobytes()) for x in each]
                counts = np.array([len(x) for x in each])
                h = np.fromiter((y for x in each for y in x), np.uint64, counts.sum())
                for k in range(lanes):
                    lane[k].append(majority(mixed(h + np.uint64(k)) if k else h, counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(np.concatenate(x).view(np.int64) if x else [], pa.int64()) for x in lane), *([pa.array(digest, pa.binary())] if sets else [])], names=["doc_id", *(f"f{k}" for k in range(lanes)), *(["digest"] if sets else [])])

    schema = ", ".join(["doc_id long", *(f"f{k} long" for k in range(lanes)), *(["digest binary"] if sets else [])])
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


# ---------------------------------------------------------------- partitions and thresholds


def bits_of(prints: np.ndarray) -> np.ndarray:
    """(n, lanes) uint64 to (n, 64 * lanes) of 0 and 1; bit b of lane k is column 64 k + b."""
    shifts = np.arange(64, dtype=np.uint64)
    return ((prints[:, :, None] >> shifts) & np.uint64(1)).astype(np.int8).reshape(len(prints), 64 * prints.shape[1])


def partitioned(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Greedy: start each partition at the free bit with the strongest ties, add the bit most correlated with it."""
    n = bits.shape[1]
    x = bits - bits.mean(0) if len(bits) else np.zeros((1, n))
    norm = np.sqrt((x * x).sum(0)) + 1e-9
    tie = np.abs((x.T @ x) / np.outer(norm, norm))
    np.fill_diagonal(tie, 0)
    free, out = set(range(n)), []
    for width in [n // parts + (i < n % parts) for i in range(parts)]:
        idx = sorted(free)
        own = [idx[int(tie[np.ix_(idx, idx)].sum(1).argmax())]]
        free.discard(own[0])
        while len(own) < width:
            idx = sorted(free)
            own.append(idx[int(tie[np.ix_(idx, own)].sum(1).argmax())])
            free.discard(own[-1])
        out.append(sorted(own))
    return out


def allocated(bits: np.ndarray, groups: list[list[int]], distance: int, rows: int, probe_cost: float = 30.0) -> tuple[float, list[int]]:
    """Thresholds (-1: partition unused) with sum of (threshold + 1) = distance + 1 and the least estimated cost."""
    rng = np.random.default_rng(0)
    n = len(bits)
    a, b = rng.integers(0, max(n, 1), (2, 200_000 if n > 1 else 0))
    differ = bits[a[a != b]] ^ bits[b[a != b]]
    need = distance + 1
    best = [(0.0, [])] + [(np.inf, [])] * need
    for group in groups:
        apart = differ[:, group].sum(1)
        cost = []
        for t in range(-1, min(4, len(group))):
            near = (apart <= t).mean() if len(apart) else 0.0
            near = max(near, sum(comb(len(group), i) for i in range(t + 1)) / 2.0 ** len(group))
            cost.append(0.0 if t < 0 else near * rows * rows / 2 + probe_cost * rows * (1 + sum(comb(len(group), i) for i in range(1, t + 1)) / 2))
        step = [(np.inf, [])] * (need + 1)
        for have, (c, chosen) in enumerate(best):
            for k, more in enumerate(cost):
                if have + k <= need and c + more < step[have + k][0]:
                    step[have + k] = (c + more, [*chosen, k - 1])
        best = step
    return best[need]


def planned(sample: np.ndarray, distance: int, rows: int, parts: range = range(2, 9)) -> list[tuple[list[int], int]]:
    """The partitions in use and their thresholds."""
    bits = bits_of(sample)
    options = []
    for m in parts:
        groups = partitioned(bits, m)
        if max(map(len, groups)) <= 62:
            cost, thresholds = allocated(bits, groups, distance, rows)
            options.append((cost, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]))
    return min(options, key=lambda x: x[0])[1]


# ---------------------------------------------------------------- buckets and links


def part_values(prints: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(prints), np.int64)
    for place, bit in enumerate(group):
        out |= ((prints[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1)).astype(np.int64) << place
    return out


def bucketed(nodes: DataFrame, plan: list[tuple[list[int], int]], lanes: int) -> DataFrame:
    """node, f0.. into rows (part, value, node, f0..): one per partition for its own value, one per probe of a larger
    value (two fingerprints at a distance probe each other; the one with the smaller value does)."""
    names = [f"f{k}" for k in range(lanes)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.stack([batch.column(f"f{k}").to_numpy().view(np.uint64) for k in range(lanes)], 1)
            node = batch.column("node").to_numpy()
            for i, (group, threshold) in enumerate(plan):
                own = part_values(prints, group)
                for t in range(threshold + 1):
                    for flip in combinations(range(len(group)), t):
                        value = own ^ sum(1 << x for x in flip)
                        take = np.flatnonzero(value > own) if t else np.arange(len(own))
                        if len(take):
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(take), i, np.int32)), pa.array(value[take]), pa.array(np.full(len(take), t == 0)), pa.array(node[take]), *(pa.array(prints[take, k].view(np.int64)) for k in range(lanes))], names=["part", "value", "own", "node", *names])

    schema = ", ".join(["part int, value long, own boolean, node long", *(f"{x} long" for x in names)])
    return nodes.select("node", *names).mapInArrow(run, schema)


def forest(node: np.ndarray, prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links among these rows."""
    left = np.arange(1, len(node))
    queue, edges = [0], []
    while True:
        if not queue:
            if not len(left):
                return edges
            queue, left = [int(left[0])], left[1:]
        at = queue.pop()
        if len(left):
            near = np.bitwise_count(prints[left] ^ prints[at]).sum(1, dtype=np.int64) <= distance
            if near.any():
                found = left[near]
                edges += [(int(node[at]), int(node[x])) for x in found]
                queue += found.tolist()
                left = left[~near]


def bucket_links(rows: DataFrame, keys: list[str], lanes: int, distance: int) -> DataFrame:
    """Links (a, b) within each bucket; a bucket's rows come together, sorted by its key."""
    names = [f"f{k}" for k in range(lanes)]
    spark = rows.sparkSession
    bounded_batches(spark)

    def of_groups(key: np.ndarray, own: np.ndarray, node: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        edge = np.any(key[1:] != key[:-1], axis=1)
        at = np.concatenate([[0], np.flatnonzero(edge) + 1, [len(key)]])
        size = np.diff(at)
        two = at[:-1][size == 2]
        near = two[np.bitwise_count(prints[two] ^ prints[two + 1]).sum(1, dtype=np.int64) <= distance] if len(two) else two
        pairs = [(near, near + 1)]
        known = np.concatenate([[0], np.cumsum(own)])
        for a, n in zip(at[:-1][size > 2].tolist(), size[size > 2].tolist()):
            if known[a + n] > known[a]:  # without a row of its own value, the pairs meet in other buckets
                found = forest(np.arange(a, a + n), prints[a : a + n], distance)
                if found:
                    pairs.append(tuple(np.array(found).T))
        i, j = (np.concatenate(x) for x in zip(*pairs))
        a, b = node[i], node[j]
        keep = a != b
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = (np.stack([batch.column(k).to_numpy() for k in keys], 1), batch.column("own").to_numpy(zero_copy_only=False), batch.column("node").to_numpy(), np.stack([batch.column(x).to_numpy().view(np.uint64) for x in names], 1))
            now = now if held is None else tuple(np.concatenate(x) for x in zip(held, now))
            last = np.any(now[0] != now[0][-1], axis=1)
            cut = int(np.flatnonzero(last)[-1]) + 1 if last.any() else 0
            if cut:
                yield of_groups(*(x[:cut] for x in now))
            held = tuple(x[cut:] for x in now)
        if held is not None and len(held[0]):
            yield of_groups(*held)

    return rows.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "own", "node", *names).mapInArrow(run, "a long, b long")


def blocked(rows: DataFrame, keys: list[str], row: str, bucket: int) -> tuple[DataFrame, list[str]]:
    """Rows of keys that more than ``bucket`` rows have, dealt into blocks by ``row``, once for each pair of blocks; any two
    rows of a key share one. Returns the rows and the keys that now bring rows together."""
    full = rows.groupBy(*keys).count().where(F.col("count") > bucket)
    full = written(full.select(*keys, F.ceil(F.col("count") / F.lit(float(bucket))).cast("int").alias("blocks")), "hot-keys")
    if full.isEmpty():
        return rows, keys
    rows = rows.join(full, keys, "left")
    own = F.pmod(F.xxhash64(row), F.col("blocks")).cast("int")
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    single = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    rows = rows.withColumn("pair", F.explode(F.when(F.col("blocks").isNull(), single).otherwise(pair)))
    return rows.withColumn("i", F.col("pair.i")).withColumn("j", F.col("pair.j")).drop("pair"), [*keys, "i", "j"]


def links(nodes: DataFrame, distance: int = 4, lanes: int = 1, plan: list[tuple[list[int], int]] | None = None, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) whose components are those of all links at ``distance`` or less. nodes: node, f0.., one row each."""
    names = [f"f{k}" for k in range(lanes)]
    if plan is None:
        taken = hash_sample(nodes.select(*names), names, PLAN_SAMPLE).toPandas()
        plan = planned(taken.to_numpy(np.int64).reshape(-1, lanes).view(np.uint64), distance, nodes.count())
    rows, keys = blocked(bucketed(nodes, plan, lanes), ["part", "value"], "node", bucket)
    if "blocks" in rows.columns:  # a block may lack the rows of the key's own value
        rows = rows.withColumn("own", F.col("own") | F.col("blocks").isNotNull())
    return bucket_links(rows, keys, lanes, distance)


# ---------------------------------------------------------------- components


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge. Alternating stars."""
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(rounds):  # a logarithmic number is enough
        # large star: larger neighbours go to the smallest of the neighbourhood
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        # small star: smaller neighbours and the node itself go to the smallest
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.explode(F.array(F.struct("m", F.col("a").alias("v")), F.struct("m", F.col("b").alias("v")))).alias("e"))
        edges = written(small.select(F.col("e.m").alias("a"), F.col("e.v").alias("b")).where("a <> b").distinct(), "edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(edges.select("a", "a").distinct())


def packed_set(shingles: np.ndarray) -> bytes:
    """48 bits of each hash, so that a set takes six bytes a shingle."""
    return (np.unique(shingles) >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked_set(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def similar_pairs(pairs: DataFrame, docs: DataFrame, words: int, least: float) -> DataFrame:
    """Of pairs (a, b) of ids of docs (id, text), those whose sets of hashed shingles have a Jaccard similarity of ``least``, as a table.
    A text's set is made once, however many pairs it is in."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [packed_set(np.array(shingle_hashes(t, words), np.uint64)) for t in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "s"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yes = []
            for x, y in zip(batch.column("s").to_pylist(), batch.column("t").to_pylist()):
                x, y = unpacked_set(x), unpacked_set(y)
                both = len(np.intersect1d(x, y))
                yes.append(both >= least * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(yes, pa.bool_()))

    bounded_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    ids = small(scratch.written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids"))
    known = scratch.written(docs.join(ids, "id", "left_semi").select("id", "text").mapInArrow(sets, "id long, s binary"), "sets")
    both = pairs.join(known.select(F.col("id").alias("a"), "s"), "a").join(known.select(F.col("id").alias("b"), F.col("s").alias("t")), "b")
    out = written(both.select("a", "b", "s", "t").mapInArrow(alike, "a long, b long"), "links")
    scratch.clear()
    return out


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, distance: int = 4, lanes: int = 1, plan: list[tuple[list[int], int]] | None = None) -> DataFrame:
    """doc_id, f0.., component_id for every row. Nodes are fingerprints, so rows without an id link too."""
    names = [f"f{k}" for k in range(lanes)]
    prints = written(fingerprints(docs, doc_id, text, words, lanes), "fingerprints")
    nodes = prints.groupBy(*names).agg(F.min("doc_id").alias("least"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "distinct-fingerprints")
    found = components(links(nodes, distance, lanes, plan))
    joined = nodes.join(found, "node")
    named = joined.groupBy("component").agg(F.min("least").alias("smallest"))
    named = nodes.join(joined.join(named, "component").select("node", "smallest"), "node", "left")
    named = named.select(*names, F.when(F.col("smallest").isNull(), F.col("least")).otherwise(F.col("smallest")).alias("component_id"))
    return prints.join(named, names)
