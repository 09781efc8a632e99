"""Scoring of long texts and the choice among attempts."""

import hashlib
import math
import time

from pyspark.sql import functions as F

from kinelake.plans import inference as I


def plain_embedding(text, dim=32):
    words = (text or "").replace("/", " ").replace(":", " ").split() or [text or "empty"]
    v = [0.0] * dim
    for h in (hashlib.sha256(w.encode()).digest() for w in words):
        v[h[0] % dim] += 1.0 if h[1] % 2 == 0 else -1.0
    length = math.sqrt(sum(x * x for x in v))
    return [x / length if length else x for x in v]


def test_embedding_takes_one_step_per_token(spark):
    texts = [None, "", " ", "/:", "a", "a/b:c\n\td", "né ☃"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", I.text_embedding(F.col("text")).alias("e")).collect()
    for r in rows:
        assert max(abs(a - b) for a, b in zip(r.e, plain_embedding(r.text))) <= 5.1e-7
    long = spark.range(400, numPartitions=8).select(F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda i: (i * (F.col("id") + 1)).cast("string"))).alias("text"))
    start = time.time()
    out = long.select("text", I.text_embedding(F.col("text")).alias("e")).cache()
    out.write.format("noop").mode("overwrite").save()
    assert time.time() - start < 25
    r = out.first()
    assert max(abs(a - b) for a, b in zip(r.e, plain_embedding(r.text))) <= 5.1e-7


def test_first_of_equal_attempts_by_place(spark, tmp_path):
    import duckdb

    from kinelake import registry

    # files of unequal sizes, which Spark doesn't read in their order
    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    head = "CAST({k} AS BIGINT) AS l_orderkey, CAST(1 + i % 2 AS INT) AS l_linenumber, CAST(5 AS DECIMAL(15, 2)) AS l_extendedprice, '{flag}' AS l_returnflag"
    for name, n, flag in (("a", 50, "R"), ("b", 5000, "N"), ("c", 500, "R")):
        duckdb.sql(f"COPY (SELECT {head.format(k=f'i % {n // 2}', flag=flag)} FROM range({n}) r(i)) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    con = duckdb.connect()
    con.execute("SET threads = 1")  # with more, DuckDB itself differs from run to run in such ties
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/*.parquet'")
    want = con.execute(registry.ORACLES["T23_last_attempts"]).fetchall()
    got = registry.QUERIES["T23_last_attempts"](spark, str(tmp_path)).select("job_id", "attempt", "status").collect()
    assert sorted(map(tuple, got)) == sorted(want)
