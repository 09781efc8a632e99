import numpy as np

from kinelake.llm import vptree
from kinelake.llm.queries import QUERIES


def brute(ids, x, asked, k=5):
    y = x / np.sqrt((x * x).sum(1, keepdims=True))
    out = {}
    for a in asked:
        score = y @ y[list(ids).index(a)]
        order = sorted((round(-s, 12), i) for i, s in zip(ids, score) if i != a)
        out[a] = [i for _, i in order[:k]]
    return out


def test_exact_at_factor_one_and_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    want = brute(ids, x, [i for i in ids if i % 50 == 0])
    from pyspark.sql import functions as F

    got = vptree.nearest(df, F.col("id") % 50 == 0, factor=1.0, shard=300, block=17).collect()
    for r in got:
        assert want[r.query_id][r.rank - 1] == r.vec_id
    assert len(got) == 5 * len(want)
    for shard, sample in ((700, 8192), (300, 400), (60, 2000)):  # at the factor of the query, over many shards
        near = vptree.nearest(df, F.col("id") % 50 == 0, shard=shard, block=50, sample=sample).collect()
        assert sum(r.vec_id in want[r.query_id] for r in near) >= 0.95 * len(near) == 0.95 * 5 * len(want)
    quick = QUERIES["op2_nearest"](spark, sf).collect()
    assert len(quick) == 5 * len(want)
    assert sum(r.vec_id in want[r.query_id] for r in quick) >= 0.95 * len(quick)


def test_ties_nulls_duplicates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(200, 0, -1)] + [(0, [2.0, 0.0]), (500, [0.0, 1.0]), (500, [0.0, 1.0])]
    rows += [(-1, None), (-2, [0.0, 0.0]), (-3, [nan, 1.0]), (-4, [inf, 1.0]), (-5, [None, 1.0]), (None, [1.0, 1.0]), (-6, [1.0, 1.0, 1.0]), (-50, [5e-324, 1e300])]
    df = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score double")
    from pyspark.sql import functions as F

    got = vptree.nearest(df, F.col("id") % 50 == 0, factor=1.0, shard=40, block=2).orderBy("query_id", "rank").collect()
    of = {}
    for r in got:
        of.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert [v for v, _ in of[0]] == [1, 2, 3, 4, 5] and [v for v, _ in of[50]] == [0, 1, 2, 3, 4]
    assert of[500][0] == (-50, 1.0) and of[500][1] == (0, 0.0)
    assert set(of) == {0, 50, 100, 150, 200, 500, -50}
    assert vptree.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert vptree.nearest(df, F.col("id") == 77_777, shard=40).count() == 0


def test_whole_shards_are_ruled_out(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    x = np.repeat(centres, 51, axis=0) + rng.normal(size=(2040, 16)) * 0.3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    query = F.col("id") % 50 == 0
    p = vptree.prepared(df, query, "vec_id", "embedding", 5, 60, 2040)
    assert p.shards >= 34
    exact = vptree.nearest(df, query, factor=1.0, shard=60, sample=2040).collect()
    want = brute(range(2040), x, range(0, 2040, 50))
    assert all(want[r.query_id][r.rank - 1] == r.vec_id for r in exact) and len(exact) == 5 * len(want)
    tau = {r.query_id: r.score for r in exact if r.rank == 5}
    floors = spark.createDataFrame(list(tau.items()), "id long, floor double").join(p.queries, "id").select("kind", "floor")
    sent = vptree.others(p.asked().withColumnRenamed("leaf", "home").join(floors, "kind"), p.tops, 0.55).count() + len(want)
    assert sent < 0.5 * p.shards * len(want)
    near = vptree.nearest(df, query, shard=60, sample=2040).collect()
    assert sum(r.vec_id in want[r.query_id] for r in near) >= 0.95 * len(near) == 0.95 * 5 * len(want)


def test_a_vector_that_many_share(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 8))
    x[::3] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    p = vptree.prepared(df, F.col("id") % 50 == 0, "vec_id", "embedding", 5, 20, 100)
    assert p.kinds.count() == 201 and p.asked().count() == 5 and p.queries.count() == 6
    got = {}
    for r in vptree.nearest(df, F.col("id") % 50 == 0, factor=1.0, shard=20, sample=100).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute(range(300), x, range(0, 300, 50))
