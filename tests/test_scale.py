"""Operators for long recordings, large groups and spans of days: equal to the plain ones, in parts of bounded size."""

import math
import random
import time
from collections import Counter
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.operators import aggregates, joins, scans, selection, series, sketches
from kinelake.plans import ops
from kinelake.sources import scratch
from kinelake.streaming import streams

POSE = "dataset_id string, version string, episode_id string, frame_idx long, timestamp_sec double, x double, y double, z double, qx double, qy double, qz double, qw double, roll double, pitch double, yaw double, is_press_candidate boolean, velocity_mps double, delta_d double"


def recordings(spark, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for e, (n, step) in enumerate([(1, 1), (6, 1), (7, 1), (8, 1), (60, 1), (90, 3)]):  # the last has gaps in its numbers
        axes = np.eye(4)[rng.integers(0, 3, n)] * rng.choice([-1.0, 1.0], (n, 1))  # dots of exactly 0 and +-1
        q = np.where(rng.random((n, 1)) < 0.6, axes, rng.normal(size=(n, 4)))
        angle = np.where(rng.random((n, 3)) < 0.2, rng.choice([-math.pi, math.pi, 0.0], (n, 3)), rng.uniform(-math.pi, math.pi, (n, 3)))
        for i in range(n):
            rows.append(("d", None if e == 4 else "v", f"e{e}", 5 + i * step, i / 30, *map(float, rng.normal(size=3)), *map(float, q[i]), *map(float, angle[i]), bool(rng.random() < 0.3), float(rng.choice([0.0, 1.0])), float(rng.random())))
    return spark.createDataFrame(rows, POSE)


def rows_of(df, *columns):
    df = df.select(*columns) if columns else df
    return sorted((tuple(round(v, 9) + 0.0 if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_segmented_scans_equal_windows(spark, chunk):
    p = recordings(spark)
    keys = [*series.EPISODE, "frame_idx"]
    assert rows_of(scans.continuous(p, chunk), *p.columns) == rows_of(series.continuous(p), *p.columns)
    assert rows_of(scans.unwrapped(p, chunk=chunk), *p.columns) == rows_of(series.unwrapped(p), *p.columns)
    d = p.select(*keys, F.when(F.col("frame_idx") > 9, F.col("x")).alias("dx"), F.when(F.col("frame_idx") % 2 == 0, F.col("y")).alias("dy"), F.col("z").alias("dz"))
    assert rows_of(scans.integrated(d, chunk=chunk)) == rows_of(series.integrated(d))
    assert rows_of(scans.segments(p, chunk=chunk)) == rows_of(series.segments(p))


def test_one_long_recording_runs_in_many_tasks(spark):
    q = spark.range(0, 400_000, numPartitions=8).select(F.lit("d").alias("dataset_id"), F.lit("v").alias("version"), F.lit("e").alias("episode_id"), F.col("id").alias("frame_idx"), F.sin(F.col("id") / 3).alias("qx"), F.cos(F.col("id") / 3).alias("qy"), F.lit(0.0).alias("qz"), F.lit(0.0).alias("qw"), F.lit(1.0).alias("dx"), F.lit(1.0).alias("dy"), F.lit(1.0).alias("dz"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for out in (scans.continuous(q, 10_000), scans.integrated(q, chunk=10_000)):
            per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert len(per_task) > 2 and max(per_task) < 300_000 and sum(per_task) == 400_000
            plan = out._jdf.queryExecution().optimizedPlan().toString()
            sorted_by_recording = [line for line in plan.splitlines() if "Window [" in line and "_chunk" not in line]
            assert not sorted_by_recording
        assert scans.integrated(q, chunk=10_000).agg(F.max("x")).first()[0] == 400_000.0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("gather", [5, 100])
def test_selection_equals_sorting(spark, gather):
    rng = random.Random(gather)
    groups = {
        "normal": [rng.gauss(0, 1) for _ in range(3000)],
        "skewed": [math.exp(rng.gauss(0, 12)) for _ in range(2000)],
        "ties": [float(rng.choice([1, 1, 1, 1, 2, 3])) for _ in range(2500)],
        "one value": [7.0] * 1200,
        "half": [0.0] * 950 + [rng.random() for _ in range(950)],
        "few": [3.0, 1.0, 2.0],
        "single": [5.0],
        None: [float(i) for i in range(500)],
    }
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("few", None), ("none", None)], "k string, v double").repartition(6)
    for q in (0.0, 0.05, 0.5, 0.95, 1.0):
        got = {r.k: r.q for r in selection.quantiles(df, ["k"], "v", q, "q", gather).collect()}
        assert set(got) == set(groups)
        assert all(math.isclose(got[k], float(np.quantile(vs, q)), rel_tol=1e-9, abs_tol=1e-12) for k, vs in groups.items())
        got = {r.k: r.q for r in selection.by_place(df, ["k"], "v", q, "q", gather).collect()}
        assert got == {k: sorted(vs)[min(len(vs) - 1, int(q * len(vs)))] for k, vs in groups.items()}


def test_selection_gathers_a_bounded_part_of_a_group(spark):
    df = spark.range(300_000).select(F.lit("a").alias("k"), F.rand(3).alias("v"))
    state = selection.bracketed(df.where("v is not null"), ["k"], F.floor(0.95 * (F.col("n") - 1)), F.ceil(0.95 * (F.col("n") - 1)), gather=4_000).first()
    assert 0 < state.inside <= 4_000 and state.below <= state.first and state.below + state.inside > state.last


def test_sketches_over_spans_of_days(spark):
    rng = random.Random(8)
    rows = [(d, k, rng.gauss(0, 1) * (1 + d), rng.randrange(9000), rng.random() < 0.5) for d in range(10) for k in "ab" for _ in range(2000)]
    df = spark.createDataFrame(rows, "day int, k string, v double, user int, good boolean")
    daily = sketches.daily_quantiles(df, ["day", "k"], "v")
    for low, high in ((0, 10), (3, 6)):
        now = sketches.span_quantiles(daily.where(F.col("day").between(low, high - 1)), ["k"], 0.95, "p")
        for r in now.collect():
            vs = sorted(x[2] for x in rows if x[1] == r.k and low <= x[0] < high)
            assert r.n == len(vs) and abs(sum(v <= r.p for v in vs) / len(vs) - 0.95) <= sketches.KLL_ERROR
    sets = sketches.daily_distinct(df, ["day", "k"], "user", F.col("good"), ~F.col("good"))
    for r in sketches.span_distinct(sets.where("day < 4"), ["k"]).collect():
        mine = [x for x in rows if x[1] == r.k and x[0] < 4]
        good, bad = {x[3] for x in mine if x[4]}, {x[3] for x in mine if not x[4]}
        for got, want in ((r.n_distinct, good | bad), (r.n_good, good), (r.n_bad, bad)):
            assert abs(got - len(want)) <= sketches.THETA_ERROR * len(want)
        assert abs(r.n_both - len(good & bad)) <= 2 * sketches.THETA_ERROR * len(good | bad)


def test_few_distinct_values_are_counted_exactly(spark):
    df = spark.createDataFrame([(i % 3, i % 50, i % 2 == 0) for i in range(300)], "day int, user int, good boolean")
    r = sketches.span_distinct(sketches.daily_distinct(df, ["day"], "user", F.col("good"), ~F.col("good")), []).first()
    assert (r.n_distinct, r.n_good, r.n_bad, r.n_both) == (50, 25, 25, 0)


STATES = lambda d: d.groupBy("dt").agg(F.count("*").alias("n"))
MERGED = lambda d: d.groupBy("dt").agg(F.sum("n").alias("n"))


def batch_of(spark, *days):
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "event_id long, day string").select("event_id", F.to_date("day").alias("dt"))


def mart(spark, path):
    return {str(r.dt): r.n for r in spark.read.parquet(f"{path}/daily").collect()}


def test_a_replayed_batch_counts_once(spark):
    path = scratch.folder(spark, "mart")
    first, second = batch_of(spark, "2024-01-01", "2024-01-02", "2024-01-02"), batch_of(spark, "2024-01-02", "2024-01-03")
    streams.merged_batch(first, 0, STATES, MERGED, path)
    streams.merged_batch(second, 1, STATES, MERGED, path)
    want = {"2024-01-01": 1, "2024-01-02": 3, "2024-01-03": 1}
    assert mart(spark, path) == want
    streams.merged_batch(second, 1, STATES, MERGED, path)
    streams.merged_batch(first, 0, STATES, MERGED, path)
    assert mart(spark, path) == want and sorted((r.batch, r.n_rows) for r in streams.committed(spark, path).collect()) == [(0, 3), (1, 2)]


def test_what_a_failed_batch_left_is_replaced_and_never_seen(spark):
    path = scratch.folder(spark, "mart")
    streams.merged_batch(batch_of(spark, "2024-01-01"), 0, STATES, MERGED, path)

    def fails(_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        streams.merged_batch(batch_of(spark, "2024-01-01", "2024-01-01", "2024-01-05"), 1, STATES, fails, path)
    streams.merged_batch(batch_of(spark, "2024-01-01"), 2, STATES, MERGED, path)  # batch 1 isn't in the ledger
    assert mart(spark, path) == {"2024-01-01": 2}
    streams.merged_batch(batch_of(spark, "2024-01-01", "2024-01-01"), 1, STATES, MERGED, path)
    assert mart(spark, path) == {"2024-01-01": 4}


def test_a_batch_touches_its_own_days_only(spark):
    from pathlib import Path

    path = scratch.folder(spark, "mart")
    streams.merged_batch(batch_of(spark, "2024-01-01", "2024-01-02"), 0, STATES, MERGED, path)
    names = lambda d: sorted(f.name for f in Path(f"{path}/daily/dt={d}").glob("*.parquet"))
    before = names("2024-01-01"), names("2024-01-02")
    streams.merged_batch(batch_of(spark, "2024-01-02"), 1, STATES, MERGED, path)
    assert names("2024-01-01") == before[0] and names("2024-01-02") != before[1]


@pytest.mark.parametrize("parts", [None, 1, 9])
def test_buckets_equal_a_loop_over_sorted_files(spark, parts):
    rng = random.Random(2)
    files = [(d, f"u{i}", rng.choice([None, 0, rng.randrange(100, 120), rng.randrange(400)])) for d in ("a", "b", None) for i in range(60)] + [("c", f"u{i}", 100 + i) for i in range(20)]
    target, most = 300, 9
    got = {(r.dataset_id, r.uri): r.bucket for r in aggregates.running_buckets(spark.createDataFrame(files, "dataset_id string, uri string, size_bytes long"), target, most, parts=parts).collect()}
    assert len(got) == len(files)
    for d in {f[0] for f in files}:
        ahead, sums = 0, Counter()
        last = {}
        for _, uri, size in sorted((f for f in files if f[0] == d), key=lambda f: (-(f[2] or 0), f[1])):
            bucket = min(ahead // target + 1, most)
            assert got[d, uri] == bucket
            ahead += size or 0
            sums[bucket] += size or 0
            last[bucket] = size or 0
        assert all(sums[b] <= target + max(last.values()) for b in sums if b < most)
    assert [got["c", f"u{i}"] for i in range(19, 16, -1)] == [1, 1, 1]  # 119, 118, 117 come first


def test_summary_takes_durations_of_steps_and_counts_versions(spark):
    day = "date'2024-01-05'"
    ads = spark.sql(f"select {day} dt, d dataset_id, v version, 1.0D qc_pass_rate, cast(null as double) etl_success_rate, 1.0D workflow_success_rate, 90.0D quality_score, 5L ml_ready_rows, 7L raw_bytes, 1L dwd_bytes, 'WARN' alert_level from values ('a', 'v1'), ('a', 'v2') t(d, v)")
    steps = spark.sql(f"select {day} dt, cast(s as double) duration_sec, u archive_log_uri from values (1, 'x'), (2, 'x'), (3, ''), (4, null), (100, 'y') t(s, u)")
    jobs = spark.sql(f"select {day} dt, 4L job_count, 3L success_count, 2.0D samples_per_sec")
    from datetime import date

    r = ops.quality_summary(ads, steps, jobs, date(2024, 1, 5)).first()
    assert (r.datasets, r.raw_bytes, r.archived_logs, r.inference_success_rate, r.worst_alert) == (2, 14, 2, 0.75, "WARN")
    assert math.isclose(r.p95_step_duration_sec, 80.8) and r.avg_etl_success_rate is None
    empty = ops.quality_summary(ads, steps, jobs, date(2024, 1, 6)).first()
    assert (empty.n_rows, empty.inference_jobs, empty.inference_success_rate, empty.worst_alert) == (0, 0, None, "OK")


def test_top_rules_keep_contract_severity_and_family(spark):
    rules = spark.createDataFrame([("2024-01-05", "c1", "r", "fail", "f", 2, 4, 0.5), ("2024-01-05", "c2", "r", "fail", "f", 3, 3, 1.0), ("2024-01-05", "c1", "q", "warn", "f", 3, 9, 0.3), ("2024-01-05", "c1", "z", "fail", "f", 0, 9, 0.0)], "dt string, contract_id string, rule_id string, severity string, dataset_family string, fail_count long, run_count long, fail_rate double")
    assert [(r.rule_id, r.contract_id, r.fail_count) for r in ops.top_rules(rules, 5).collect()] == [("q", "c1", 3), ("r", "c2", 3), ("r", "c1", 2)]


def test_globs_meet_ids_without_a_nested_loop(spark):
    import fnmatch

    rng = random.Random(6)
    globs = [None, "*", "?", "a*", "ab?", "abc", "a.b*", "*c", "ab*c", "", "(x", *("".join(rng.choices("abc*?", k=4)) for _ in range(200))]
    ids = [None, "", "a", "ab", "abc", "abcc", "a.bz", "axbz", "(x", *("".join(rng.choices("abc", k=rng.randint(1, 5))) for _ in range(40))]
    policies = spark.createDataFrame([(i, g, rng.choice([None, "f"])) for i, g in enumerate(globs)], "policy_id int, dataset_pattern string, policy_family string")
    rows = spark.createDataFrame([(d, rng.choice(["f", "g", None])) for d in ids * 2], "dataset_id string, dataset_family string")
    out = joins.pattern_join(policies, rows)
    want = Counter((r.dataset_id, r.dataset_family, p.policy_id) for r in rows.collect() for p in policies.collect()
                   if (p.dataset_pattern is None or r.dataset_id is not None and fnmatch.fnmatchcase(r.dataset_id, p.dataset_pattern)) and p.policy_family in (None, r.dataset_family))
    assert Counter(tuple(r) for r in out.select("dataset_id", "dataset_family", "policy_id").collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_merge_leaves_the_files_of_other_days(spark):
    from pathlib import Path

    path = scratch.folder(spark, "merged")
    row = "k int, v string, first string, dt string"
    joins.merge_daily(path, spark.createDataFrame([(1, "a", "x", "d1"), (2, "b", "y", "d1"), (1, "c", "z", "d2")], row), ["k", "dt"])
    files = lambda d: sorted(f.name for f in Path(f"{path}/dt={d}").glob("*.parquet"))
    before = files("d1"), files("d2")
    joins.merge_daily(path, spark.createDataFrame([(2, None, "q", "d1"), (3, "n", "q", "d1")], row), ["k", "dt"], insert_only=("first",))
    assert files("d2") == before[1] and files("d1") != before[0]
    joins.merge_daily(path, spark.createDataFrame([], row), ["k", "dt"])
    joins.merge_daily(path, spark.createDataFrame([(9, "new", None, "d3")], row), ["k", "dt"])
    got = sorted(tuple(r) for r in spark.read.schema(row).parquet(path).collect())
    assert got == [(1, "a", "x", "d1"), (1, "c", "z", "d2"), (2, "b", "y", "d1"), (3, "n", "q", "d1"), (9, "new", None, "d3")]


def test_adapters_by_id_then_prefix_then_fallback(spark):
    from kinelake.sources import adapters

    rows = [("ab", [0.0] * 7, None), ("abc", None, 1.0), ("x", [1.0] * 7, 2.0), ("none", None, None), (None, [3.0] * 7, None)]
    df = spark.createDataFrame([(d, "v", "e", i, v, *[x] * 7) for i, (d, v, x) in enumerate(rows)], "dataset_id string, version string, episode_id string, frame_idx long, tcp_pose array<double>, " + ", ".join(f"{c} double" for c in adapters.POSE))
    registry = adapters.Registry()
    mine = lambda n: lambda f: f.select(*adapters.SLICE, *(F.lit(float(n)).alias(c) for c in adapters.POSE))
    registry.register("ab", mine(7), "prefix")
    registry.register("a", mine(8), "prefix")
    registry.register("ab", mine(9))
    assert registry.listed() == [("ab", "exact"), ("ab", "prefix"), ("a", "prefix")]
    got = {r.frame_idx: (r.x, r.pose_source) for r in registry.frames(df).collect()}
    assert got == {0: (9.0, "exact:ab"), 1: (7.0, "prefix:ab"), 2: (1.0, "tcp_pose"), 3: (None, "fallback"), 4: (3.0, "tcp_pose")}
    with pytest.raises(ValueError):
        registry.register("a", mine(1), "glob")


def test_silhouettes_in_blocks_equal_a_loop():
    from kinelake.operators import press

    rng = np.random.default_rng(4)
    for n, k in ((1, 1), (5, 1), (2, 2), (30, 3), (700, 4)):
        x, y, c = rng.normal(size=n), rng.normal(size=n), rng.integers(0, k, n)
        c[:k] = np.arange(k)[:n]
        d = np.hypot(x[:, None] - x, y[:, None] - y)
        each = []
        for i in range(n):
            own = (c == c[i]) & (np.arange(n) != i)
            others = [d[i, c == o].mean() for o in set(c.tolist()) - {int(c[i])}]
            if others:
                a = d[i, own].mean() if own.any() else None
                each.append(0.0 if a is None or max(a, min(others)) == 0 else (min(others) - a) / max(a, min(others)))
        got = press.silhouette(x, y, c, block=64)
        assert got is None if not each else math.isclose(got, np.mean(each), abs_tol=1e-12)
    assert press.silhouette(np.zeros(4), np.zeros(4), np.array([0, 0, 1, 1])) == 0.0


def test_documents_of_every_shape_are_parsed_once(spark):
    from kinelake.sources import documents

    rule = '{"rule_id":"r%d","severity":"fail","threshold":%s,"actual":2}'
    cases = [
        ("full", '{"_rule_results":[%s,%s]}' % (rule % (1, "0.5"), rule % (2, '"a"')), "[%s]" % (rule % (9, "1")), None),
        ("array", None, "[%s]" % (rule % (3, "null")), None),
        ("items", None, '{"items":[%s]}' % (rule % (4, "1")), "[%s]" % (rule % (5, "1"))),
        ("broken", "{not json", "[", "7"),
        ("empty", "{}", "[]", '{"items":null}'),
        ("null", None, None, None),
        ("scalar", "3", '"x"', "null"),
    ]
    df = spark.createDataFrame(cases, "run_id string, metrics_json string, failed_rules_json string, warning_rules_json string")
    table = documents.shredded(df, documents.QC_DOCUMENTS)
    got = sorted((r.run_id, r.rule_id, r.status, r.threshold) for r in documents.rule_rows(table).collect())
    assert got == [("array", "r3", "FAIL", None), ("full", "r1", "PASS", "0.5"), ("full", "r2", "PASS", "a"), ("items", "r4", "FAIL", "1"), ("items", "r5", "WARN", "1")]
    shapes = {r.run_id: (r.metrics_json_shape, r.failed_rules_json_shape, r.warning_rules_json_shape) for r in table.collect()}
    assert shapes["full"] == ("object", "array", "missing") and shapes["items"] == ("missing", "object", "array")
    assert shapes["broken"][:2] == ("missing", "missing") and shapes["scalar"] == ("scalar", "scalar", "scalar")
    assert documents.rule_rows(table)._jdf.queryExecution().optimizedPlan().toString().count("parse_json") <= 3  # one for each column


BEATS = "workflow_name string, phase string, step_name string, updated_at timestamp, event_id long"


def beats(rows):
    at = datetime(2024, 5, 1, tzinfo=timezone.utc)
    return [(w, "p", s, at + timedelta(seconds=t), e) for w, s, t, e in rows]


def run_beats(spark, folder, files, known=None):
    for rows in files:  # a file each, read in this order
        made = spark.createDataFrame(beats(rows), BEATS).coalesce(1)
        made.write.mode("append").json(f"{folder}/in")
        time.sleep(1.1)  # files are ordered by their second
    stream = spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).json(f"{folder}/in")
    out = streams.drained(streams.liveness(stream, 100.0, 200.0, "0 seconds", known), f"{folder}/out", f"{folder}/state")
    return [(r.workflow_name, r.step_name, r.event_id, r.state) for r in out.collect()]


def test_liveness_goes_on_from_its_checkpoint(spark, tmp_path):
    first = [[("a", "s", 0, 1), ("b", "s", 10, 2), ("b", "s", 10, 3), ("c", None, 5, 4)], [("a", "s", 120, 5)]]
    want = [("a", "s", 1, "ok"), ("a", "s", 5, "ok"), ("b", "s", 3, "ok"), ("b", "s", 3, "warn"), ("c", None, 4, "ok"), ("c", None, 4, "warn")]
    key = lambda rows: sorted(rows, key=str)
    assert key(run_beats(spark, tmp_path, first)) == key(want)
    want += [("a", "s", 6, "ok"), ("b", "s", 3, "stale"), ("c", None, 4, "stale")]
    assert key(run_beats(spark, tmp_path, [[("a", "s", 215, 6)]])) == key(want)  # states of the first run are still there
    want += [("b", "s", 7, "ok"), ("a", "s", 6, "stale")]  # b comes back; a goes from ok to stale at once
    assert key(run_beats(spark, tmp_path, [[("b", "s", 500, 7)]])) == key(want)


def test_liveness_starts_from_a_table(spark, tmp_path):
    old = spark.createDataFrame(beats([("a", "s", 0, 1), ("a", "s", 0, 2), ("b", "s", 110, 3), ("d", "s", 130, 4), ("e", "s", -90, 5)]), BEATS)
    at = F.lit(datetime(2024, 5, 1, 0, 2, 0, tzinfo=timezone.utc))
    known = streams.liveness_batch(old, 100.0, 200.0, at)
    assert {r.workflow_name: r.state for r in known.collect()} == {"a": "warn", "b": "ok", "d": "ok", "e": "stale"}
    new = [("d", "s", 150, 6), ("f", "s", 215, 7)]
    got = run_beats(spark, tmp_path, [new], known)
    # at 215 a is stale and b warns, though neither sent anything; e was stale before
    assert sorted(got, key=str) == sorted([("a", "s", 2, "stale"), ("b", "s", 3, "warn"), ("d", "s", 6, "ok"), ("f", "s", 7, "ok")], key=str)
