"""Approximate nearest neighbours by largest cosine, with a vantage-point tree per shard.

On vectors scaled to length one the Euclidean distance is a metric that orders as the cosine does. Equal vectors are one
*kind*, which keeps its k + 1 smallest ids, all that any query can return; a vector that many queries share is searched once.

Kinds are dealt into shards by vantage points: a top tree over a bounded sample sends each to a leaf (leaves larger than a
shard are split by a hash), so that what is near lies together. A shard keeps its kinds in a vantage-point tree of its own: an
inner node holds a vantage point and the median distance to it, a leaf holds vectors. With tau the distance of a query's
(k + 1)-th best so far, itself included, the side of a node that lies beyond the median is skipped if the query's distance to
the median shell is above ``factor`` * tau. Factor 1 skips only what the triangle inequality rules out, so the search
is exact; a smaller factor skips more.

A query is sent to its own leaf of the top tree first. The tau found there, by the same rule, rules out whole shards of the
others; it goes along to those that are left. So what is sent grows with the queries and the shards that they can't rule
out. A task holds one tree and one block of queries at a time. Found rows are scored in double precision on the original
vectors.

Defined results: vectors that are null, zero or have null or non-finite components, and null ids, take no part; vectors
of a length other than the queries' are not compared with them; ties go to the smaller id; of rows that repeat an id with other
vectors the best score counts (each takes one of the k + 1 places); other columns, whatever their names, are not read; empty tables
give an empty result, as does a table without queries.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, small, written

LEAF = 96
#: Distances near 0 are roots of differences near 0, known to about 1e-8.
SLACK = 1e-7


class Node(NamedTuple):
    vantage: np.ndarray
    shell: float
    near: Node | np.ndarray | int
    far: Node | np.ndarray | int


def built(x: np.ndarray, rows: np.ndarray, rng: np.random.Generator, leaf: int = LEAF) -> Node | np.ndarray:
    """A tree over x[rows]; leaves are row numbers. The vantage point is the one with the widest spread of a few tried."""
    if len(rows) <= leaf:
        return rows
    tried = rng.choice(rows, min(5, len(rows)), replace=False)
    seen = rng.choice(rows, min(200, len(rows)), replace=False)
    v = x[tried[int(np.argmax([np.std(1 - x[seen] @ x[t]) for t in tried]))]]
    d = np.sqrt(np.maximum(0, 2 - 2 * (x[rows] @ v)))
    shell = float(np.median(d))
    inside = d <= shell
    if inside.all():
        return rows
    return Node(v, shell, built(x, rows[inside], rng, leaf), built(x, rows[~inside], rng, leaf))


class Search:
    """The k best rows of a tree for each query of a block."""

    def __init__(self, x: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.x, self.q, self.k, self.factor = x, queries, k, factor
        self.best = np.full((len(queries), k), -2.0)
        self.row = np.full((len(queries), k), -1, np.int64)

    def walk(self, node: Node | np.ndarray, who: np.ndarray) -> None:
        if isinstance(node, np.ndarray):
            for s in range(0, len(node), 4096):
                rows = node[s : s + 4096]
                score = np.concatenate([self.best[who], self.q[who] @ self.x[rows].T], 1)
                row = np.concatenate([self.row[who], np.broadcast_to(rows, (len(who), len(rows)))], 1)
                top = np.argpartition(-score, self.k - 1, 1)[:, : self.k]
                self.best[who], self.row[who] = np.take_along_axis(score, top, 1), np.take_along_axis(row, top, 1)
            return
        d = np.sqrt(np.maximum(0, 2 - 2 * (self.q[who] @ node.vantage)))
        inside = d <= node.shell
        for first, second, go in ((node.near, node.far, inside), (node.far, node.near, ~inside)):
            own, gap = who[go], np.abs(d[go] - node.shell)
            if len(own):
                self.walk(first, own)
                tau = np.sqrt(np.maximum(0, 2 - 2 * self.best[own].min(1)))
                more = own[gap <= self.factor * tau + 1e-9]
                if len(more):
                    self.walk(second, more)


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """Vectors of length d as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def scaled(x: np.ndarray) -> np.ndarray:
    y = x / np.abs(x).max(1, keepdims=True)
    return y / np.sqrt((y * y).sum(1, keepdims=True))


def cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors get equal scores; scaled first against overflow."""
    x, q = x / np.abs(x).max(1, keepdims=True), q / np.abs(q).max(1, keepdims=True)
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum(1)))


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where("id is not null").where(v.isNotNull()).where(finite & F.exists("v", lambda x: x != 0)).withColumn("d", F.size("v"))


# ---------------------------------------------------------------- shards by vantage points


def numbered(node: Node | np.ndarray, count: Iterator[int]) -> Node | int:
    """The same tree with a number for each leaf."""
    return Node(node.vantage, node.shell, numbered(node.near, count), numbered(node.far, count)) if isinstance(node, Node) else next(count)


def top_trees(kinds: DataFrame, n: int, shard: int, sample: int) -> dict[int, Node | int]:
    """For each dimension a tree whose leaves are to get about ``shard`` of n kinds, over about ``sample`` of them chosen by
    hash, and at least four of the sample in a leaf."""
    part = kinds.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(min(1.0, sample / max(n, 1)) * (1 << 30))).select("d", "v").toArrow()
    of, out = part.column("d").to_numpy(), {}
    for d in np.unique(of).tolist():
        x = scaled(matrix(part.column("v").filter(pa.array(of == d)), d))
        x = x[np.lexsort(x.T)]  # whatever order the sample came in
        out[d] = numbered(built(x, np.arange(len(x)), np.random.default_rng(0), max(4, shard * sample // max(n, sample))), iter(range(len(x))))
    return out


def distance(unit: np.ndarray, vantage: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (unit @ vantage)))


def home(top: Node | int, unit: np.ndarray) -> np.ndarray:
    """The leaf of each vector."""
    out, todo = np.zeros(len(unit), np.int32), [(top, np.arange(len(unit)))]
    while todo:
        node, who = todo.pop()
        if not isinstance(node, Node):
            out[who] = node
        elif len(who):
            inside = distance(unit[who], node.vantage) <= node.shell
            todo += [(node.near, who[inside]), (node.far, who[~inside])]
    return out


def within(top: Node | int, unit: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of all leaves that aren't ruled out: no shell on the way is more than the row's limit away."""
    out, todo = [(np.zeros(0, np.int64), np.zeros(0, np.int32))], [(top, np.arange(len(unit)))]
    while todo:
        node, who = todo.pop()
        if not isinstance(node, Node):
            out.append((who, np.full(len(who), node, np.int32)))
        elif len(who):
            d = distance(unit[who], node.vantage)
            both = np.abs(d - node.shell) <= limit[who] + SLACK
            todo += [(node.near, who[both | (d <= node.shell)]), (node.far, who[both | (d > node.shell)])]
    return tuple(np.concatenate(x) for x in zip(*out))


def dealt(kinds: DataFrame, tops: dict[int, Node | int]) -> DataFrame:
    """Rows (kind, d, v, ids) with their leaf."""
    model = kinds.sparkSession.sparkContext.broadcast(tops)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, leaf = batch.column(1).to_numpy(), np.zeros(batch.num_rows, np.int32)
            for d in np.unique(of).tolist():
                own = np.flatnonzero(of == d)
                leaf[own] = home(model.value.get(d, 0), scaled(matrix(batch.column(2).take(pa.array(own)), d)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["kind", "d", "v", "ids", "leaf"])

    return kinds.select("kind", "d", "v", "ids").mapInArrow(run, "kind long, d int, v array<double>, ids array<long>, leaf int")


def others(asked: DataFrame, tops: dict[int, Node | int], factor: float) -> DataFrame:
    """(kind, d, leaf, v, floor) of rows (kind, d, home, v, floor) for every leaf but the home that the floor, the (k + 1)-th best score so
    far, doesn't rule out (null: none is ruled out)."""
    model = asked.sparkSession.sparkContext.broadcast(tops)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, floor = batch.column(1).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
            limit = np.where(np.isnan(floor), np.inf, factor * np.sqrt(np.maximum(0, 2 - 2 * floor)))
            for d in np.unique(of).tolist():
                own = np.flatnonzero(of == d)
                row, leaf = within(model.value.get(d, 0), scaled(matrix(batch.column(3).take(pa.array(own)), d)), limit[own])
                row = own[row]
                other = leaf != batch.column(2).to_numpy()[row]
                row, leaf = row[other], leaf[other]
                for s in range(0, len(row), 4096):
                    part = batch.take(pa.array(row[s : s + 4096]))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(leaf[s : s + 4096]), part.column(3), part.column(4)], names=["kind", "d", "leaf", "v", "floor"])

    return asked.select("kind", "d", "home", "v", "floor").mapInArrow(run, "kind long, d int, leaf int, v array<double>, floor double")


# ---------------------------------------------------------------- search


class Prepared(NamedTuple):
    """kinds (kind, d, v, ids, leaf), queries (id, kind), parts (d, leaf, parts), the top trees and the number of shards."""

    kinds: DataFrame
    queries: DataFrame
    parts: DataFrame
    tops: dict
    shards: int

    def asked(self) -> DataFrame:
        return self.kinds.join(self.queries.select("kind").distinct(), "kind", "left_semi")


def prepared(vectors: DataFrame, is_query: Column, vec_id: str, vector: str, k: int, shard: int, sample: int) -> Prepared:
    bounded_batches(vectors.sparkSession)
    rows = written(usable(vectors, vec_id, vector).dropDuplicates(["id", "v"]), "vectors")
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))  # cut within tasks first
    few = rows.withColumn("n", place).where(F.col("n") <= k + 1).groupBy("d", "v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    kinds = written(few.select(F.monotonically_increasing_id().alias("kind"), "d", "v", "ids"), "kinds")
    queries = written(rows.where(is_query).select("id", "v").join(kinds.select("kind", "v"), "v").select("id", "kind"), "queries")
    tops = top_trees(kinds, kinds.count(), shard, sample)
    kinds = written(dealt(kinds, tops), "dealt")
    parts = written(kinds.groupBy("d", "leaf").agg(F.ceil(F.count("*") / shard).cast("int").alias("parts")), "parts")
    return Prepared(kinds, queries, parts, tops, max(1, parts.agg(F.sum("parts")).first()[0] or 0))


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, factor: float = 0.55, shard: int = 8192, block: int = 16_384, sample: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row for which ``is_query`` (on its id ``id``) holds.

    Shards hold about ``shard`` distinct vectors, blocks at most ``block`` queries. ``sample`` is how many vectors the driver holds to make
    the top tree.
    """
    p = prepared(vectors, is_query, vec_id, vector, k, shard, sample)
    parts = small(p.parts)  # a row per leaf of the top trees and per other dimension
    part = F.pmod(F.xxhash64("kind"), F.col("parts")).cast("int")
    index = written(indexed(p.kinds.join(parts, ["d", "leaf"]).withColumn("part", part)), "trees")
    every = lambda q: q.join(parts, ["d", "leaf"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    groups = max(1, min(p.shards, max(256, p.shards // 16)))
    asked = p.asked().select("kind", "d", "leaf", "v", F.lit(None).cast("double").alias("floor"))
    first = written(best(searched(index, every(asked), k + 1, factor, block, groups), k + 1), "found-at-home")
    floors = first.where(F.col("rank") == k + 1).select("kind", F.col("score").alias("floor"))
    more = others(asked.drop("floor").withColumnRenamed("leaf", "home").join(floors, "kind", "left"), p.tops, factor)
    second = searched(index, every(more), k + 1, factor, block, groups)
    found = best(first.drop("rank").unionByName(second), k + 1).drop("rank")
    found = p.queries.join(found, "kind").where("id <> vec_id").groupBy(F.col("id").alias("query_id"), "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each kind, with their rank."""
    order = Window.partitionBy("kind").orderBy(F.desc("score"), "vec_id")
    return found.groupBy("kind", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


INDEX = "d int, leaf int, part int, ids array<long>, at array<int>, v array<double>, tree binary"


def indexed(rows: DataFrame) -> DataFrame:
    """One row per shard: its vectors, the ids of each, and the tree."""

    def run(keys, t):
        x, ids = matrix(t.column("v"), keys[0].as_py()), t.column("ids").combine_chunks()
        at = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy())]).astype(np.int32)
        tree = pickle.dumps(built(scaled(x), np.arange(len(x)), np.random.default_rng(0)))
        columns = {n: pa.array([k.as_py()], pa.int32()) for n, k in zip(("d", "leaf", "part"), keys)}
        columns |= {n: pa.array([v], pa.list_(pa.from_numpy_dtype(v.dtype))) for n, v in (("ids", ids.flatten().to_numpy()), ("at", at), ("v", x.ravel()))}
        return pa.table(columns | {"tree": pa.array([tree], pa.binary())})

    return rows.groupBy("d", "leaf", "part").applyInArrow(run, INDEX)


class Tree(NamedTuple):
    """A shard: distinct vectors, as they are and scaled, the ids of each, and the tree over them."""

    raw: np.ndarray
    unit: np.ndarray
    ids: np.ndarray
    at: np.ndarray
    top: Node | np.ndarray


def found_in(t: Tree, q: np.ndarray, floor: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, vec_id and score of the k best of a shard for each query, but none below the query's floor (NaN: no floor)."""
    s = Search(t.unit, scaled(q), min(k, len(t.unit)), factor)
    known = ~np.isnan(floor)
    s.best[known] = floor[known, None] - 1e-9
    s.walk(t.top, np.arange(len(q)))
    who, what = np.nonzero(s.row >= 0)
    kind = s.row[who, what]
    score = cosine(t.raw[kind], q[who])
    many = t.at[kind + 1] - t.at[kind]
    each = np.repeat(np.arange(len(kind)), many)
    vec, who, score = t.ids[np.repeat(t.at[kind] - np.cumsum(many) + many, many) + np.arange(many.sum())], who[each], score[each]
    order = np.lexsort((vec, -score, who))
    who, vec, score = who[order], vec[order], score[order]
    keep = np.arange(len(who)) - np.searchsorted(who, who) < k
    return who[keep], vec[keep], score[keep]


def searched(index: DataFrame, asked: DataFrame, k: int, factor: float, block: int, groups: int) -> DataFrame:
    """(kind, vec_id, score): the k best of each shard for the rows (kind, d, leaf, part, v, floor) sent to it. A shard's tree comes first, then
    its queries."""
    key = ["d", "leaf", "part"]
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("at", "array<int>"), ("tree", "binary"))]
    shards = index.select(*key, F.lit(0).alias("role"), F.lit(None).cast("long").alias("kind"), F.lit(None).cast("double").alias("floor"), "ids", "at", "v", "tree")
    rows = shards.unionByName(asked.select(*key, F.lit(1).alias("role"), "kind", "floor", F.lit(None).cast("array<long>").alias("ids"), nothing[0], "v", nothing[1]))
    rows = rows.repartition(groups, *key).sortWithinPartitions(*key, "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tree, held = None, None, []  # held: queries of the shard that wait for a full block

        def answers() -> pa.RecordBatch:
            kind, floor, v = (np.concatenate(x) for x in zip(*held))
            held.clear()
            who, vec, score = found_in(tree, v, floor, k, factor)
            return pa.RecordBatch.from_arrays([pa.array(kind[who]), pa.array(vec), pa.array(score)], names=["kind", "vec_id", "score"])

        for batch in batches:
            where = np.stack([batch.column(n).to_numpy() for n in (*key, "role")], 1)
            edge = [0, *(np.flatnonzero(np.any(where[1:] != where[:-1], axis=1)) + 1).tolist(), len(where)]
            for a, b in zip(edge, edge[1:]):
                if a == b:
                    continue
                at, part = tuple(where[a, :3].tolist()), batch.slice(a, b - a)
                if at != now:
                    if held:
                        yield answers()
                    now, tree = at, None
                if where[a, 3] == 0:
                    cell = lambda n: part.column(n)[0]  # noqa: B023, E731
                    x = cell("v").values.to_numpy().reshape(-1, at[0])
                    tree = Tree(x, scaled(x), cell("ids").values.to_numpy(), cell("at").values.to_numpy(), pickle.loads(cell("tree").as_py()))
                elif tree is not None:
                    floor = part.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
                    held.append((part.column("kind").to_numpy(zero_copy_only=False).astype(np.int64), floor, matrix(part.column("v"), at[0])))
                    if sum(len(h[0]) for h in held) >= block:
                        yield answers()
        if held:
            yield answers()

    return rows.mapInArrow(run, "kind long, vec_id long, score double")
