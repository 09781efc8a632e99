"""Prefix trie of conversations, built from ternary search trees over ranges of dictionary-encoded turns.

A turn (role, text) is known by the SHA-256 of its length-marked parts; distinct turns get a number (the dictionary), and a
conversation is its array of numbers. Equal conversations are counted together first. The distinct arrays are dealt into
range shards of about ``TURNS`` turns; each shard puts its arrays into a ternary search tree, medians first, so that the tree
is balanced, and an iterative traversal adds up members, leaves and savings from the leaves to the root.

Arrays that share a prefix are neighbours in that order, so only the prefixes of a shard's first and last array can go on in
another shard. These boundary nodes leave the shard as partial sums, keyed by their path; all others are complete. Partial
sums of a path are added, and each boundary node then gives its own part to the boundary nodes above it. Their number is
bounded by shards times depth, not by rows.

Ids that end at a node are hashed in order: ranges of (node, id) are joined into chunks of text in parallel, and a node's
chunks are hashed as a stream, so that no task holds a node's ids.

Defined results: null role or text is empty; turns are ordered by turn (null first), equal ones by role and by the turn's
hash; rows without a conversation id belong to none and take no part; repeated rows are turns of their own; a very long
conversation is one array; an empty table gives an empty result; columns besides id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, bounded_batches, small, written

#: Turns of one range shard at most, about; bytes of joined ids in one chunk, about.
TURNS, CHUNK = 200_000, 1 << 16


def hashed_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, code, n_words): code tells different (role, text)."""
    r, t = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    code = F.unhex(F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t).cast("binary"), 256))
    return rows.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), r.alias("role"), code.alias("code"), F.regexp_count(t, F.lit(WORD)).cast("long").alias("n_words"))


def encoded(turns: DataFrame) -> DataFrame:
    """(conv_id, path): the turns in order, each as struct(id, w) of its dictionary number and its words."""
    codes = turns.groupBy("code").agg(F.max("n_words").alias("w"))
    numbers = small(written(codes.withColumn("id", F.monotonically_increasing_id()), "turn-numbers"))
    known = turns.select("conv_id", "turn", "role", "code").join(numbers, "code")
    each = F.struct(F.col("turn").isNotNull().alias("given"), "turn", "role", "code", "id", "w")
    ordered = known.groupBy("conv_id").agg(F.sort_array(F.collect_list(each)).alias("t"))
    return ordered.select("conv_id", F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["w"].alias("w"))).alias("path"))


def rebased(paths: DataFrame, base: Column, length: Column, most: int) -> DataFrame:
    """Each conversation with its first ``length`` (at most ``most``) turns replaced by those of conversation ``base``."""
    heads = paths.select(F.col("conv_id").alias("base"), F.slice("path", 1, most).alias("head"))
    own = paths.withColumn("base", base).withColumn("h", length)
    rest = F.slice("path", F.col("h") + 1, F.greatest(F.size("path") - F.col("h"), F.lit(0)))
    head = F.slice(F.coalesce("head", F.slice("path", 1, 0)), F.lit(1), F.col("h"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("path"))


class Tree:
    """A ternary search tree over sequences of numbers. A node is a prefix: its last number, the nodes for smaller and larger
    numbers at the same place, and the node where the next number starts. Node 0 stands for the empty prefix."""

    def __init__(self) -> None:
        self.key, self.less, self.more, self.next = [-1], [0], [0], [0]
        self.words, self.convs, self.least, self.end = [0], [0], [None], [None]

    def insert(self, path: list[int], words: list[int], convs: int, least: int, number: int) -> None:
        at = 0
        self.count(0, convs, least)
        for x, w in zip(path, words):
            links, slot = self.next, at
            while (node := links[slot]) and self.key[node] != x:  # along the smaller and larger numbers at this place
                links, slot = (self.less if x < self.key[node] else self.more), node
            if not node:
                node = links[slot] = len(self.key)
                for column, value in ((self.key, x), (self.less, 0), (self.more, 0), (self.next, 0), (self.words, w), (self.convs, 0), (self.least, None), (self.end, None)):
                    column.append(value)
            self.count(node, convs, least)
            at = node
        self.end[at] = number

    def count(self, at: int, convs: int, least: int) -> None:
        self.convs[at] += convs
        if self.least[at] is None or least < self.least[at]:
            self.least[at] = least

    def child(self, at: int, x: int) -> int:
        at = self.next[at]
        while self.key[at] != x:
            at = (self.less if x < self.key[at] else self.more)[at]
        return at

    def children(self, at: int) -> list[int]:
        out, stack = [], [self.next[at]]
        while stack:
            if c := stack.pop():
                out.append(c)
                stack += [self.less[c], self.more[c]]
        return out


def balanced(n: int) -> Iterator[int]:
    """0 to n - 1, each median before the halves beside it."""
    stack = [(0, n)]
    while stack:
        low, high = stack.pop()
        if low < high:
            mid = (low + high) // 2
            yield mid
            stack += [(low, mid), (mid + 1, high)]


NODE = "path array<long>, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, number long, parent array<long>"


def shard_nodes(rows: list[tuple[list[int], list[int], int, int, int]]) -> Iterator[dict]:
    """The nodes of a shard's sorted rows (path, words, members, least id, number). Boundary nodes have a ``path`` and only what
    complete nodes below them give; complete nodes have none, but the ``parent`` if that is a boundary node."""
    tree = Tree()
    for i in balanced(len(rows)):
        tree.insert(*rows[i])
    edge = {0: ()}  # boundary nodes and their paths
    for path in (rows[0][0], rows[-1][0]):
        at = 0
        for d, x in enumerate(path):
            at = tree.child(at, x)
            edge[at] = tuple(path[: d + 1])
    order, stack = [], [(0, 0, 0)]
    while stack:
        at, depth, parent = stack.pop()
        order.append((at, depth, parent))
        stack += [(c, depth + 1, at) for c in tree.children(at)]
    n = len(tree.key)
    kids, leaves, saved = [0] * n, [0] * n, [0] * n
    for at, depth, parent in reversed(order):
        if at not in edge:
            leaves[at] += kids[at] == 0
            saved[at] += (tree.convs[at] - 1) * tree.words[at]
            kids[parent] += 1
            leaves[parent] += leaves[at]
            saved[parent] += saved[at]
    for at, depth, parent in order:
        inner = at not in edge
        yield {
            "path": None if inner else list(edge[at]), "conv_id": tree.least[at], "depth": depth,
            "parent_conv_id": tree.least[parent] if inner and parent not in edge else None,
            "n_convs": tree.convs[at], "n_children": kids[at], "n_leaves": leaves[at], "saved_tokens": saved[at], "words": tree.words[at],
            "number": tree.end[at], "parent": list(edge[parent]) if inner and parent in edge else None,
        }


def trie_nodes(distinct: DataFrame, shards: int) -> DataFrame:
    """Complete and boundary nodes of the distinct paths (path, n_convs, conv_id, number); see ``shard_nodes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:  # a range shard: bounded
            rows += zip(*(batch.column(c).to_pylist() for c in ("ids", "w", "n_convs", "conv_id", "number")))
        if rows:
            held = []
            for node in shard_nodes(rows):
                held.append(node)
                if len(held) == 20_000:
                    yield pa.RecordBatch.from_pylist(held, arrow)
                    held = []
            yield pa.RecordBatch.from_pylist(held, arrow)

    longs = pa.list_(pa.int64())
    arrow = pa.schema([(x.rsplit(" ", 1)[0].split()[0], longs if "array" in x else pa.int64()) for x in NODE.split(", ")])
    ranged = distinct.withColumn("ids", F.col("path.id")).withColumn("w", F.col("path.w")).repartitionByRange(shards, "ids").sortWithinPartitions("ids")
    return ranged.select("ids", "w", "n_convs", "conv_id", "number").mapInArrow(run, NODE)


def merged_edges(edges: DataFrame) -> DataFrame:
    """Boundary nodes of all shards by path, with the sums of everything below them."""
    one = edges.groupBy("path").agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("inner_leaves"), F.sum("saved_tokens").alias("inner_saved"), F.max("words").alias("words"), F.max("number").alias("number"))
    one = written(one.withColumn("depth", F.size("path").cast("long")), "boundary-nodes")
    above = one.where("depth > 0").select(F.slice("path", F.lit(1), (F.col("depth") - 1).cast("int")).alias("path"), "conv_id")
    kids = above.groupBy("path").agg(F.count("*").alias("edge_children"))
    whole = one.join(kids, "path", "left").withColumn("n_children", F.col("inner_children") + F.coalesce("edge_children", F.lit(0)))
    whole = whole.withColumn("leaves", F.col("inner_leaves") + (F.col("n_children") == 0).cast("long")).withColumn("saved", F.col("inner_saved") + (F.col("n_convs") - 1) * F.col("words"))
    up = whole.withColumn("d", F.explode(F.sequence(F.lit(0), F.col("depth").cast("int")))).select(F.slice("path", F.lit(1), F.col("d")).alias("path"), "leaves", "saved")
    sums = up.groupBy("path").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    parents = one.select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = whole.withColumn("parent", F.when(F.col("depth") > 0, F.slice("path", F.lit(1), F.greatest(F.col("depth") - 1, F.lit(0)).cast("int"))))
    return whole.drop("leaves", "saved").join(sums, "path").join(parents, "parent", "left")


def id_hashes(ends: DataFrame) -> DataFrame:
    """(number, ends_sha256) of rows (number, conv_id): SHA-256 of the ids as text, ascending, comma-joined."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, first, held, size = None, None, [], 0

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([first], pa.int64()), pa.array([",".join(held)])], names=["number", "first", "ids"])

        out: list[pa.RecordBatch] = []
        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (n != number or size > CHUNK):
                    out.append(chunk())
                    held = []
                if not held:
                    number, first, size = n, c, 0
                held.append(str(c))
                size += len(held[-1]) + 1
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
                out = []
        if held:
            yield chunk()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, state = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if n != number:
                    if state:
                        done.append((number, state.hexdigest()))
                    number, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.int64()), pa.array([x for _, x in done], pa.string())], names=["number", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([state.hexdigest()])], names=["number", "ends_sha256"])

    ranged = ends.select("number", "conv_id").repartitionByRange("number", "conv_id").sortWithinPartitions("number", "conv_id")
    parts = ranged.mapInArrow(chunks, "number long, first long, ids string")
    return parts.repartition("number").sortWithinPartitions("number", "first").mapInArrow(hashes, "number long, ends_sha256 string")


def prefix_trie(paths: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, path): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256."""
    bounded_batches(paths.sparkSession)
    paths = written(paths, "paths")
    distinct = paths.groupBy("path").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    distinct = written(distinct.withColumn("number", F.monotonically_increasing_id()), "distinct-paths")
    turns = distinct.agg(F.sum(F.size("path") + 1)).first()[0] or 0
    shards = max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-turns // TURNS))
    nodes = written(trie_nodes(distinct, shards), "trie-nodes")
    edges = written(merged_edges(nodes.where("path is not null")), "merged-boundary")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "number"]
    above = small(edges.select(F.col("path").alias("parent"), F.col("conv_id").alias("above")))
    inner = nodes.where("path is null").join(above, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    ends = id_hashes(paths.join(distinct.select("path", "number"), "path").select("number", "conv_id"))
    every = inner.select(*columns).unionByName(edges.select(*columns))
    named = every.where("number is not null").join(ends, "number").drop("number")
    rest = every.where("number is null").drop("number").withColumn("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    return named.unionByName(rest)
