"""Queries over metadata, files, inference and event tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from ..fixtures import frame, placed
from ..functions import exprs as E
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import selection as S
from ..operators import sketches as K
from ..plans import inference as I
from ..plans import ops as O
from ..plans import profiles as Q
from ..plans import warehouse as W
from ..sources import scratch
from ..sources import tables as T
from ..streaming import streams as X
from .base import Family, nudged, rounded
from .warehouse import BAD, ERROR_CASE, FACTS, INFERENCE, OPS, QUALITY_PARTS, RULE_DAILY, SOURCES, md5_of, quality_daily
from .warehouse import dashboard as dashboard_of

family = Family()
add = family.add
DAY = date(2024, 1, 5)
SD = "DATE '2024-01-05'"


def approximate_percentile(d):
    """A sketch per day, merged; whether the estimate's true rank is as near as the sketch promises."""
    rows = d.select("l_returnflag", F.to_date("l_shipdate").alias("dt"), F.col("l_extendedprice").cast("double").alias("v"))
    return rank_checked(rows, ["l_returnflag"], K.span_quantiles(K.daily_quantiles(rows, ["dt", "l_returnflag"], "v"), ["l_returnflag"], 0.95, "p"), 0.95)


def rank_checked(rows, keys, estimates, q):
    ranks = K.rank_of(rows, estimates, keys, "v", "p")
    near = (F.col("low") <= q + K.KLL_ERROR) & (F.col("high") >= q - K.KLL_ERROR)
    return estimates.join(ranks, keys).select(*keys, "n", near.alias("within_bound"))


def weekly_percentile(p):
    rows = p.select("dataset_id", F.to_date("created_at").alias("dt"), F.date_trunc("week", "created_at").alias("week"), F.col("duration_sec").alias("v"))
    weeks = K.daily_quantiles(rows, ["dataset_id", "week", "dt"], "v").groupBy("dataset_id", "week").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("kll", F.lit(K.KLL_K)).alias("kll"))
    return rank_checked(rows, ["dataset_id"], K.span_quantiles(weeks, ["dataset_id"], 0.95, "p"), 0.95)


def places(p):
    """Exact, however large a dataset."""
    keys = ["dataset_id"]
    low = S.by_place(p, keys, "input_bytes", 0.95, "p95", gather=500)
    half = S.quantiles(p.withColumn("input_bytes", F.col("input_bytes").cast("double")), keys, "input_bytes", 0.5, "median", gather=500)
    return low.join(half.select("dataset_id", F.bround("median").cast("long").alias("median")), keys)


def distinct_over_span(s):
    """Distinct workflows per step over all days from daily sketches: exact while few, else within the stated error."""
    rows = s.withColumn("dt", F.to_date("started_at"))
    daily = K.daily_distinct(rows, ["dt", "step_name"], "workflow_name", F.col("phase") == "Succeeded", F.col("phase") == "Failed")
    return K.span_distinct(daily, ["step_name"])


def distinct_users(e):
    """Thousands of users, by sketch and exactly."""
    rows = e.withColumn("dt", F.to_date("ts"))
    daily = K.daily_distinct(rows, ["dt", "event_type"], "user_id", F.col("value") > 50, F.col("value") <= 50)
    both = K.span_distinct(daily, ["event_type"]).join(e.groupBy("event_type").agg(F.count_distinct("user_id").alias("n")), "event_type")
    near = F.abs(F.col("n_distinct") - F.col("n")) <= F.greatest(F.lit(1.0), F.col("n") * K.HLL_ERROR)
    return both.select("event_type", "n", near.alias("within_bound"))

# ---------------------------------------------------------------- counts and quantiles

add("A1_conditional_counts", ["fx_etl_perf"], lambda p: p.groupBy("phase").agg(F.count("*").alias("n"), F.count_if(E.status_in("status", E.SUCCESS)).alias("ok"), F.count_if(E.status_in("status", E.FAILURE)).alias("bad")),
    f"SELECT phase, count(*) AS n, count(*) FILTER (upper(status) IN ('OK', 'WARN', 'SUCCESS', 'SUCCEEDED')) AS ok, count(*) FILTER (upper(status) IN {BAD}) AS bad FROM fx_etl_perf GROUP BY 1")
add("A2_conditional_distinct", ["fx_workflow_steps"], lambda s: s.groupBy("step_name").agg(F.count_distinct("workflow_name").alias("n"), E.distinct_where(F.col("phase") == "Failed", "workflow_name").alias("failed")),
    "SELECT step_name, count(DISTINCT workflow_name) AS n, count(DISTINCT workflow_name) FILTER (phase = 'Failed') AS failed FROM fx_workflow_steps GROUP BY 1")
add("A3_exact_percentile", ["lineitem"], lambda d: S.quantiles(d.select("l_returnflag", F.col("l_extendedprice").cast("double").alias("price")), ["l_returnflag"], "price", 0.95, "p95", gather=2_000), "SELECT l_returnflag, round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.95), 6) AS p95 FROM lineitem GROUP BY 1")
add("A4_approximate_percentile", ["lineitem"], approximate_percentile, "SELECT l_returnflag, count(*) AS n, TRUE AS within_bound FROM lineitem GROUP BY 1")
add("A4_weekly_percentile", ["fx_etl_perf"], weekly_percentile, "SELECT dataset_id, count(*) AS n, TRUE AS within_bound FROM fx_etl_perf WHERE duration_sec IS NOT NULL GROUP BY 1")
add("A5_percentile_by_place", ["fx_etl_perf"], places,
    "SELECT dataset_id, list_sort(list(input_bytes))[1 + least(count(*) - 1, CAST(floor(0.95 * count(*)) AS BIGINT))] AS p95, CAST(round_even(quantile_cont(input_bytes, 0.5), 0) AS BIGINT) AS median FROM fx_etl_perf GROUP BY 1")
add("A2_distinct_over_span", ["fx_workflow_steps"], distinct_over_span, """
SELECT step_name, count(DISTINCT workflow_name) AS n_distinct, count(DISTINCT workflow_name) FILTER (phase = 'Succeeded') AS n_good, count(DISTINCT workflow_name) FILTER (phase = 'Failed') AS n_bad,
    (SELECT count(*) FROM (SELECT workflow_name FROM fx_workflow_steps i WHERE i.step_name = o.step_name AND phase = 'Succeeded' INTERSECT SELECT workflow_name FROM fx_workflow_steps i WHERE i.step_name = o.step_name AND phase = 'Failed')) AS n_both
FROM fx_workflow_steps o GROUP BY 1""")
add("A2_distinct_users_sketched", ["events"], distinct_users, "SELECT event_type, count(DISTINCT user_id) AS n, TRUE AS within_bound FROM events GROUP BY 1")
add("A6_safe_ratio", ["fx_etl_perf"], lambda p: p.groupBy("run_id").agg(F.sum("output_bytes").alias("o"), F.sum("input_bytes").alias("i")).select("run_id", E.ratio("o", "i").alias("kept")),
    "SELECT run_id, round(CASE WHEN sum(input_bytes) > 0 THEN sum(output_bytes) / sum(input_bytes) END, 6) AS kept FROM fx_etl_perf GROUP BY 1")
add("A10_daily_etl", ["fx_etl_perf"], lambda p: W.daily_etl(W.fact_etl_run(p)).drop("etl_family"),
    f"WITH {FACTS}, {QUALITY_PARTS} SELECT dt, dataset_id, version, etl_run_count, etl_success_count, etl_fail_count, total_input_bytes, total_output_bytes, round(p95_etl_duration_sec, 6) AS p95_etl_duration_sec FROM e")
add("A14_bytes_by_layer", ["fx_profiles"], lambda p: p.groupBy("dataset_id").agg(*(F.sum(F.when(F.col("layer").isin(*v), F.coalesce("bytes", F.lit(0)))).alias(k) for k, v in (("raw_bytes", ("raw", "ods")), ("dwd_bytes", ("dwd",))))),
    "SELECT dataset_id, CAST(sum(coalesce(bytes, 0)) FILTER (layer IN ('raw', 'ods')) AS BIGINT) AS raw_bytes, CAST(sum(coalesce(bytes, 0)) FILTER (layer = 'dwd') AS BIGINT) AS dwd_bytes FROM fx_profiles GROUP BY 1")
LABELED = {"etl_runs": ("fx_etl_perf", ["status", "phase"], ("output_bytes",)), "workflow_steps": ("fx_workflow_steps", ["phase", "dataset_family"], ()), "qc_runs": ("fx_qc_runs", ["contract_id", "status"], ()), "profiles": ("fx_profiles", ["layer"], ("bytes", "rows_count")), "ml_ready": ("fx_ml_ready", ["dataset_id", "version"], ("num_train", "num_val", "num_test")), "jobs": ("fx_jobs", ["model_id", "task_type", "status"], ()), "events": ("fx_ev", ["event_type"], ())}
for name, (view, labels, sums) in LABELED.items():
    add(f"A15_labeled_counts_{name}", [view], lambda d, labels=labels, sums=sums: A.labeled_counts(d, labels, sums),
        f"SELECT {', '.join(f'coalesce({c}, {chr(39)}{chr(39)}) AS {c}' for c in labels)}, count(*) AS n{''.join(f', CAST(sum(coalesce({c}, 0)) AS BIGINT) AS sum_{c}' for c in sums)} FROM {view} GROUP BY {', '.join(str(i + 1) for i in range(len(labels)))}")
add("A16_phase_performance", ["fx_etl_perf"], A.phase_performance,
    f"SELECT phase, round(sum(coalesce(duration_sec, 0)), 6) AS duration_sec, CAST(sum(coalesce(input_bytes, 0)) AS BIGINT) AS input_bytes, CAST(sum(coalesce(output_bytes, 0)) AS BIGINT) AS output_bytes, count(*) FILTER (upper(status) IN {BAD}) AS failures FROM fx_etl_perf GROUP BY 1")
add("A17_table_counts", ["orders", "lineitem", "events"], lambda a, b, c: A.table_counts({"orders": a, "lineitem": b, "events": c}), "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
NOW = datetime(2024, 2, 1)
add("A18_heartbeat_age", ["fx_heartbeats"], lambda h: A.ages(h, "phase", "updated_at", F.lit(NOW)), "SELECT phase, round(epoch_us(TIMESTAMP '2024-02-01') / 1e6 - epoch_us(max(updated_at)) / 1e6, 6) AS age_sec FROM fx_heartbeats GROUP BY 1")
add("A19_flag_counts", ["fx_ev"], lambda d: A.flag_counts(d.withColumn("passed", F.when(F.col("k") % 3 == 0, None).otherwise(F.col("k") % 2 == 0)), "passed"),
    "SELECT CASE WHEN k % 3 = 0 THEN 'unknown' WHEN k % 2 = 0 THEN 'pass' ELSE 'fail' END AS outcome, count(*) AS n FROM fx_ev GROUP BY 1")
INFERENCE_VIEWS = ["fx_jobs", "fx_outputs", "fx_models"]


def day_summary(*t, day=DAY):
    *sources, profiles, jobs, outputs, models = t
    return O.quality_summary(dashboard_of(*sources, profiles), archived(W.fact_workflow_step(sources[2], sources[3])), W.dws_inference_job_daily(jobs, outputs, models), day, sources[4], None)


def archived(steps):
    """Steps with a log where they failed."""
    return steps.withColumn("archive_log_uri", F.when(F.col("exit_code") == 1, F.concat(F.lit("s3://logs/"), "pod_name", F.lit(".log"))))


def summary_sql(day: str) -> str:
    return f"""
WITH {FACTS}, {QUALITY_PARTS}, {INFERENCE}, b AS (SELECT dt, dataset_id, version, sum(bytes) FILTER (layer IN ('raw', 'ods')) AS raw_bytes, sum(bytes) FILTER (layer = 'dwd') AS dwd_bytes FROM profiles GROUP BY 1, 2, 3),
d AS (SELECT *, 50 * coalesce(qc_pass_rate, 1) + 30 * coalesce(etl_success_rate, 1) + 20 * coalesce(workflow_success_rate, 1) AS quality_score,
    CASE WHEN coalesce(qc_pass_rate, 1) < 0.8 OR coalesce(etl_success_rate, 1) < 0.8 THEN 2 WHEN coalesce(qc_pass_rate, 1) < 0.95 THEN 1 ELSE 0 END AS level FROM quality LEFT JOIN b USING (dt, dataset_id, version) WHERE dt = {day}),
x AS (SELECT count(*) AS n_rows, count(DISTINCT (dataset_id, version)) AS datasets, avg(qc_pass_rate) AS avg_qc_pass_rate, avg(etl_success_rate) AS avg_etl_success_rate, avg(workflow_success_rate) AS avg_workflow_success_rate,
    avg(quality_score) AS avg_quality_score, CAST(coalesce(sum(ml_ready_rows), 0) AS BIGINT) AS ml_ready_rows, CAST(coalesce(sum(raw_bytes), 0) AS BIGINT) AS raw_bytes, CAST(coalesce(sum(dwd_bytes), 0) AS BIGINT) AS dwd_bytes,
    CASE max(level) WHEN 2 THEN 'CRITICAL' WHEN 1 THEN 'WARN' ELSE 'OK' END AS worst_alert FROM d),
y AS (SELECT quantile_cont(duration_sec, 0.95) AS p95_step_duration_sec, count(DISTINCT pod_name) FILTER (exit_code = 1) AS archived_logs FROM steps WHERE dt = {day}),
z AS (SELECT CAST(coalesce(sum(job_count), 0) AS BIGINT) AS inference_jobs, sum(success_count) / nullif(sum(job_count), 0) AS inference_success_rate, avg(samples_per_sec) AS inference_samples_per_sec FROM inf WHERE dt = {day}),
v AS (SELECT count(*) AS exports FROM fx_ml_ready WHERE CAST(created_at AS DATE) = {day})
SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in ('avg_qc_pass_rate', 'avg_etl_success_rate', 'avg_workflow_success_rate', 'avg_quality_score', 'p95_step_duration_sec', 'inference_success_rate', 'inference_samples_per_sec'))}) FROM x, y, z, v"""


add("A20_quality_summary", [*SOURCES, "fx_profiles", *INFERENCE_VIEWS], day_summary, summary_sql(SD))
METRICS = """o AS (SELECT job_id, count(*) AS total, count(*) FILTER (status = 'OK') AS ok, avg(latency_ms) AS avg_latency_ms, quantile_cont(latency_ms, 0.5) AS p50_latency_ms, quantile_cont(latency_ms, 0.95) AS p95_latency_ms,
    quantile_cont(latency_ms, 0.99) AS p99_latency_ms FROM fx_outputs GROUP BY 1), im AS (SELECT job_id, total, ok, CASE WHEN duration_sec > 0 THEN ok / duration_sec END AS samples_per_sec, avg_latency_ms, p50_latency_ms, p95_latency_ms, p99_latency_ms, (total - ok) / total AS error_rate FROM o JOIN fx_jobs USING (job_id))"""
add("A21_inference_metrics", ["fx_outputs", "fx_jobs"], A.inference_metrics,
    f"WITH {METRICS} SELECT job_id, total, ok, {', '.join(f'round({c}, 6) AS {c}' for c in ('samples_per_sec', 'avg_latency_ms', 'p50_latency_ms', 'p95_latency_ms', 'p99_latency_ms', 'error_rate'))} FROM im")
GRID = lambda j: j.groupBy((F.col("job_no") % 4).alias("concurrency"), (F.col("job_no") % 3).alias("batch")).agg(F.avg(F.col("processed_samples") / F.col("duration_sec")).alias("samples_per_sec"))
SGRID = "SELECT job_no % 4 AS concurrency, job_no % 3 AS batch, avg(processed_samples / duration_sec) AS samples_per_sec FROM fx_jobs GROUP BY 1, 2"
add("A22_best_combination", ["fx_jobs"], lambda j: A.best_combination(GRID(j), ["concurrency", "batch"], "samples_per_sec"), f"SELECT concurrency, batch, round(samples_per_sec, 6) AS samples_per_sec FROM ({SGRID}) ORDER BY samples_per_sec DESC LIMIT 1")
add("P28_benchmark_runs", ["fx_jobs"], GRID, f"SELECT concurrency, batch, round(samples_per_sec, 6) AS samples_per_sec FROM ({SGRID})")
add("A23_shard_summary", ["fx_etl_perf"], lambda p: A.shard_summary(p.select(F.col("run_id").alias("shard_id"), "duration_sec", F.col("input_bytes").alias("rows_count"), "status", "dataset_id"), 100),
    f"SELECT count(DISTINCT run_id) AS found_shards, 100 AS expected_shards, CAST(sum(input_bytes) AS BIGINT) AS rows_count, round(max(duration_sec), 6) AS duration_sec, (SELECT string_agg(DISTINCT dataset_id, ',' ORDER BY dataset_id) FROM fx_etl_perf WHERE upper(status) IN {BAD}) AS failed_datasets FROM fx_etl_perf")
add("A24_inference_report", ["fx_jobs", "fx_outputs"], lambda j, o: A.labeled_counts(o.withColumn("kind", F.when(F.col("status") == "FAILED", E.error_type("error_message"))).join(j.select("job_id", "model_id"), "job_id"), ["model_id", "status", "kind"]),
    f"SELECT model_id, o.status, coalesce(CASE WHEN o.status = 'FAILED' THEN {ERROR_CASE} END, '') AS kind, count(*) AS n FROM fx_outputs o JOIN fx_jobs j USING (job_id) GROUP BY ALL")
add("A25_trajectory_lengths", ["fx_pose"], lambda p: A.trajectory_lengths(p, "episode_id"), "SELECT episode_id, count(*) AS length FROM fx_pose GROUP BY 1")
add("A25_language_missing", ["documents"], lambda d: d.withColumn("t", F.when(F.col("doc_id") % 7 == 0, F.lit(" ")).when(F.col("doc_id") % 5 > 0, F.col("lang"))).agg(A.missing_text_rate(d.withColumn("t", F.col("lang")), "t").alias("missing")),
    "SELECT round(avg(CASE WHEN doc_id % 7 = 0 OR doc_id % 5 = 0 OR lang IS NULL THEN 1.0 ELSE 0 END), 6) AS missing FROM documents")
add("A26_null_rate", ["fx_etl_perf"], lambda p: A.null_rate(p.select("status", "output_bytes", "metrics_json")),
    "SELECT count(*) AS n_rows, CAST(3 * count(*) - count(status) - count(output_bytes) - count(metrics_json) AS BIGINT) AS null_cells, round((3 * count(*) - count(status) - count(output_bytes) - count(metrics_json)) / (3 * count(*)), 6) AS null_rate FROM fx_etl_perf")


def probes_of(p):
    """Probes with their lists as arrays."""
    lengths = F.when(F.col("length_list") != "", F.split("length_list", ",").cast("array<int>"))
    return p.withColumn("columns", F.split("column_list", ",")).withColumn("lengths", lengths)


SLICE = ["dataset_id", "version"]
PARQUET = "kind = 'parquet' AND readable"
add("A27_asset_profile", ["fx_probes"], lambda p: Q.asset_profile(probes_of(p), SLICE), f"""
SELECT dataset_id, version, CAST(sum(size_bytes) AS BIGINT) AS bytes, CAST(nullif(coalesce(sum(row_count) FILTER ({PARQUET}), 0), 0) AS BIGINT) AS rows, count(*) AS files_count,
    CAST(nullif(CASE WHEN coalesce(sum(demo_count) FILTER (kind = 'hdf5'), 0) > 0 THEN sum(demo_count) FILTER (kind = 'hdf5') ELSE count(*) FILTER ({PARQUET}) END, 0) AS BIGINT) AS episodes_count,
    nullif(count(*) FILTER (kind = 'video'), 0) AS videos_count, sha256(string_agg(DISTINCT schema_hash, '|' ORDER BY schema_hash) FILTER ({PARQUET})) AS schema_hash,
    round(avg(null_rate) FILTER ({PARQUET}), 6) AS null_rate, count(*) FILTER (NOT readable) AS probe_failure_count, CASE WHEN count(*) FILTER (NOT readable) > 0 THEN 'WARN' ELSE 'OK' END AS status
FROM fx_probes GROUP BY 1, 2""")
HAS = lambda *hints: "coalesce(bool_or(" + " OR ".join(f"contains(column_list, '{h}')" for h in hints) + ") FILTER (kind = 'parquet'), FALSE)"
METRIC_ROWS = lambda *pairs: "LATERAL (VALUES " + ", ".join(f"('{n}', CAST({x} AS DOUBLE))" for n, x in pairs) + ") u(metric, actual)"
add("P15_lerobot_metrics", ["fx_probes"], lambda p: Q.lerobot_metrics(probes_of(p), SLICE), f"""
WITH g AS (SELECT dataset_id, version, count(*) FILTER (kind = 'parquet') AS np, count(*) FILTER (kind = 'video') AS nv, count(*) FILTER ({PARQUET}) AS rp, count(*) FILTER (kind = 'video' AND readable) AS rv,
    coalesce(sum(demo_count) FILTER (kind = 'hdf5'), 0) AS demos, count(DISTINCT schema_hash) FILTER (kind = 'parquet') AS kinds, {HAS('cam', 'wrist', 'primary', 'secondary')} AS cam, {HAS('language', 'instruction', 'task_description')} AS lang,
    {HAS('action', 'observation.state')} AS act, {HAS('time')} AS tim FROM fx_probes GROUP BY 1, 2)
SELECT dataset_id, version, u.metric, round(u.actual, 6) AS actual FROM g, {METRIC_ROWS(('num_parquet_files', 'np'), ('num_episodes', 'CASE WHEN demos > 0 THEN demos ELSE rp END'), ('num_videos', 'nv'),
    ('parquet_valid_rate', 'coalesce(rp / nullif(np, 0), 1)'), ('video_decode_pass_rate', 'coalesce(rv / nullif(nv, 0), 1)'), ('camera_coverage', 'cam'), ('language_coverage', 'lang'), ('action_column_coverage', 'act'),
    ('timestamp_monotonic_rate', 'CASE WHEN tim THEN 1 ELSE 0.5 END'), ('action_jump_rate', '0'), ('calibration_coverage', '0'), ('schema_hash_unique_count', 'kinds'), ('sampled_parquet_count', 'np'), ('num_frames', '0'), ('chunk_files_total', '0'))}""")
EACH_LENGTH = lambda kind: f"SELECT dataset_id, version, unnest(list_transform(string_split(length_list, ','), lambda x: CAST(x AS INT))) AS n FROM fx_probes WHERE kind = '{kind}' AND readable AND length_list <> ''"
add("P15_demo_metrics", ["fx_probes"], lambda p: Q.demo_metrics(probes_of(p), SLICE), f"""
WITH g AS (SELECT dataset_id, version, count(*) AS files, count(*) FILTER (readable) AS ok, coalesce(sum(demo_count) FILTER (readable), 0) AS demos,
    {', '.join(f'count(*) FILTER (readable AND has_{c}) AS {c}' for c in ('actions', 'obs', 'next_obs', 'rewards', 'dones'))} FROM fx_probes WHERE kind = 'hdf5' GROUP BY 1, 2),
l AS (SELECT dataset_id, version, round_even(quantile_cont(n, 0.5), 0) AS p50, round_even(quantile_cont(n, 0.95), 0) AS p95, min(n) AS low, max(n) AS high, count(*) AS many FROM ({EACH_LENGTH('hdf5')}) WHERE n > 0 GROUP BY 1, 2)
SELECT dataset_id, version, u.metric, round(u.actual, 6) AS actual FROM g LEFT JOIN l USING (dataset_id, version), {METRIC_ROWS(('hdf5_valid_rate', 'ok / files'), ('demo_count', 'demos'), ('num_hdf5_files', 'files'),
    ('action_present_rate', 'actions / greatest(ok, 1)'), ('obs_next_obs_mismatch_rate', 'abs(obs - next_obs) / greatest(ok, 1)'), ('reward_done_length_mismatch_rate', 'abs(rewards - dones) / greatest(ok, 1)'), ('action_range_violation_rate', '0'),
    ('episode_len_p50', 'coalesce(p50, 0)'), ('episode_len_p95', 'coalesce(p95, 0)'), ('episode_len_min', 'coalesce(low, 0)'), ('episode_len_max', 'coalesce(high, 0)'), ('episode_count_total', 'coalesce(many, 0)'))}""")
add("P15_bridge_metrics", ["fx_probes"], lambda p: Q.bridge_metrics(probes_of(p), SLICE), f"""
WITH g AS (SELECT dataset_id, version, count(*) FILTER (kind = 'parquet') AS np, count(*) FILTER ({PARQUET}) AS rp, avg(language_missing_rate) FILTER (kind = 'parquet') AS miss, {HAS('language', 'instruction', 'task_description')} AS lang,
    {HAS('image', 'rgb')} AS img, {HAS('action')} AS act, {HAS('env', 'scene')} AS env, {HAS('skill', 'task')} AS skill, count(*) FILTER ({PARQUET} AND length_list = '') AS lost FROM fx_probes GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY dataset_id, version ORDER BY n) - 1 AS i, count(*) OVER (PARTITION BY dataset_id, version) AS many FROM ({EACH_LENGTH('parquet')}) WHERE n > 0),
l AS (SELECT dataset_id, version, max(n) FILTER (i = many // 2) AS p50, max(n) FILTER (i = least(many - 1, CAST(floor(many * 0.95) AS BIGINT))) AS p95, max(many) AS many FROM o GROUP BY 1, 2)
SELECT dataset_id, version, u.metric, round(u.actual, 6) AS actual FROM g LEFT JOIN l USING (dataset_id, version), {METRIC_ROWS(('num_parquet_files', 'np'), ('parquet_valid_rate', 'rp / greatest(np, 1)'),
    ('language_missing_rate', 'coalesce(miss, CASE WHEN lang THEN 0 ELSE 1 END)'), ('image_ref_missing_rate', 'CASE WHEN img THEN 0 ELSE 1 END'), ('action_column_coverage', 'act'), ('environment_count', 'env'), ('skill_count', 'skill'),
    ('bridge_enrich_failure_count', 'lost'), ('traj_len_p50', 'coalesce(p50, 0)'), ('traj_len_p95', 'coalesce(p95, 0)'), ('episode_count', 'coalesce(many, 0)'))}""")

# ---------------------------------------------------------------- filters and lists

add("F4_filtered_listing", ["fx_etl_perf"], lambda p: p.where((F.col("phase") == "normalize") & F.col("dataset_id").isin("ds_1", "ds_2")).orderBy("job_id").limit(50).select("job_id", "dataset_id", "phase"),
    "SELECT job_id, dataset_id, phase FROM fx_etl_perf WHERE phase = 'normalize' AND dataset_id IN ('ds_1', 'ds_2') ORDER BY job_id LIMIT 50")
add("F6_glob_filter", ["fx_files"], lambda f: O.lake_listing(f, "raw/doc_1*", "*.mp4"), "SELECT split_part(uri, '/', 1) AS layer, count(*) AS objects, CAST(sum(size_bytes) AS BIGINT) AS bytes, count(DISTINCT (dataset_id, version)) AS slices FROM fx_files WHERE uri GLOB 'raw/doc_1*' AND NOT uri GLOB '*.mp4' GROUP BY 1")
add("P29_lake_listing", ["fx_files"], O.lake_listing, "SELECT split_part(uri, '/', 1) AS layer, count(*) AS objects, CAST(sum(size_bytes) AS BIGINT) AS bytes, count(DISTINCT (dataset_id, version)) AS slices FROM fx_files GROUP BY 1")
add("F8_abnormal", [*SOURCES, "fx_profiles"], lambda *t: O.abnormal(dashboard_of(*t)).select("dt", "dataset_id", "version", "alert_level"),
    f"WITH {FACTS}, {QUALITY_PARTS} SELECT dt, dataset_id, version, CASE WHEN coalesce(qc_pass_rate, 1) < 0.8 OR coalesce(etl_success_rate, 1) < 0.8 THEN 'CRITICAL' ELSE 'WARN' END AS alert_level FROM quality WHERE coalesce(qc_pass_rate, 1) < 0.95 OR coalesce(etl_success_rate, 1) < 0.8")
add("L1_top_rules", ["fx_qc_runs"], lambda q: O.top_rules(W.dws_rule_failure_daily(W.fact_qc_rule_result(q)), 3), f"WITH {FACTS}, {RULE_DAILY} SELECT dt, contract_id, rule_id, severity, dataset_family, fail_count, run_count, round(fail_rate, 6) AS fail_rate FROM rule_daily WHERE fail_count > 0 ORDER BY fail_count DESC, rule_id, dt, contract_id, severity, dataset_family LIMIT 3")
add("L2_newest", ["fx_etl_perf"], lambda p: p.orderBy(F.desc_nulls_last("created_at"), "job_id").limit(20).select("job_id", "created_at"), "SELECT job_id, created_at FROM fx_etl_perf ORDER BY created_at DESC NULLS LAST, job_id LIMIT 20")
add("L3_queue_order", ["fx_jobs"], lambda j: j.where("status <> 'SUCCEEDED'").orderBy(F.desc("total_samples"), "created_at", "job_id").limit(10).select("job_id", "total_samples"), "SELECT job_id, total_samples FROM fx_jobs WHERE status <> 'SUCCEEDED' ORDER BY total_samples DESC, created_at, job_id LIMIT 10")
add("L4_sample_limit", ["fx_outputs"], lambda o: o.orderBy("sample_id").limit(100).select("sample_id"), "SELECT sample_id FROM fx_outputs ORDER BY sample_id LIMIT 100")

# ---------------------------------------------------------------- joins, sets, merges

add("J2_full_outer_chain", ["fx_etl_perf", "fx_qc_runs"], lambda p, q: J.full_outer_chain([p.groupBy("dataset_id", "run_id").agg(F.count("*").alias("a")), q.groupBy("dataset_id", "run_id").agg(F.count("*").alias("b"))], ["dataset_id", "run_id"]),
    "SELECT dataset_id, run_id, a, b FROM (SELECT dataset_id, run_id, count(*) AS a FROM fx_etl_perf GROUP BY 1, 2) FULL JOIN (SELECT dataset_id, run_id, count(*) AS b FROM fx_qc_runs GROUP BY 1, 2) USING (dataset_id, run_id)")
add("J3_null_safe_join", ["fx_workflow_steps", "fx_workflow_runs"], lambda s, r: J.null_safe_join(s, r.drop("started_at"), ["workflow_namespace", "workflow_name"]).groupBy("workflow_namespace", "workflow_type").agg(F.count("*").alias("n")),
    "SELECT s.workflow_namespace, workflow_type, count(*) AS n FROM fx_workflow_steps s JOIN fx_workflow_runs r ON s.workflow_namespace IS NOT DISTINCT FROM r.workflow_namespace AND s.workflow_name = r.workflow_name GROUP BY 1, 2")
add("J4_latest_lookup", ["fx_snapshots"], lambda s: J.latest(s, ["dataset_id", "version"], ["created_at", "snapshot_id"], ["snapshot_id", "quality_score"]), "SELECT dataset_id, version, snapshot_id, round(quality_score, 6) AS quality_score FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, version ORDER BY created_at DESC, snapshot_id DESC) AS p FROM fx_snapshots) WHERE p = 1")
add("J5_legacy_rules_only", ["fx_qc_runs"], lambda q: W.fact_qc_rule_result(q).where("rule_id in ('r7', 'r8', 'r9')").select("run_id", "rule_id", "status"), f"SELECT run_id, rule_id, status FROM (WITH {FACTS} SELECT * FROM rules) WHERE rule_id IN ('r7', 'r8', 'r9')")


def policies(spark):
    rows = [("p1", "all", "ds_*", None, ["ads", "ml_ready"], 0.8, 0.7, 3, True), ("p2", "family", None, "fam_1", ["qc"], 0.5, 0.5, 100, True), ("p3", "one", "ds_?", "fam_2", [], None, None, None, True), ("p4", "off", None, None, [], 0.0, 0.0, 0, False)]
    return spark.createDataFrame(rows, "policy_id string, policy_name string, dataset_pattern string, policy_family string, required_outputs array<string>, min_qc_pass_rate double, min_etl_success_rate double, max_failed_workflows int, enabled boolean")


def sla(perf, qc, steps, runs, ml, snaps, profiles, versions):
    ads = dashboard_of(perf, qc, steps, runs, ml, snaps, profiles)
    flows = runs.withColumn("status", F.when(F.col("workflow_type").isNull(), "Failed").otherwise("Succeeded"))
    return O.sla_check(policies(perf.sparkSession), ads, W.dim_dataset(versions, snaps, ml), ml, qc, flows, DAY)


POLICIES = "pol(policy_id, pat, fam, need_ads, need_ml, need_qc, mq, me, mw) AS (VALUES ('p1', 'ds_%', NULL, TRUE, TRUE, FALSE, 0.8, 0.7, 3), ('p2', NULL, 'fam_1', FALSE, FALSE, TRUE, 0.5, 0.5, 100), ('p3', 'ds\\__', 'fam_2', FALSE, FALSE, FALSE, NULL, NULL, NULL))"
add("P17_sla_check", [*SOURCES, "fx_profiles", "fx_versions"], sla, f"""
WITH {FACTS}, {QUALITY_PARTS}, {POLICIES},
fam AS (SELECT dataset_id, version, metrics_json ->> '$.dataset_family' AS dataset_family FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, version ORDER BY created_at DESC, snapshot_id DESC) AS p FROM fx_snapshots) WHERE p = 1),
today AS (SELECT dataset_id, version, dataset_family, qc_pass_rate, etl_success_rate, TRUE AS has_ads FROM quality WHERE dt = {SD}),
sc AS (SELECT * FROM today UNION ALL SELECT dataset_id, version, dataset_family, NULL, NULL, FALSE FROM fx_versions LEFT JOIN fam USING (dataset_id, version) ANTI JOIN today USING (dataset_id, version)),
fw AS (SELECT count(*) FILTER (workflow_type IS NULL) AS failed_workflows FROM fx_workflow_runs WHERE CAST(started_at AS DATE) = {SD}),
x AS (SELECT *, EXISTS (SELECT 1 FROM fx_ml_ready l WHERE l.dataset_id = sc.dataset_id AND l.version = sc.version) AS has_ml, EXISTS (SELECT 1 FROM fx_qc_runs r WHERE CAST(r.started_at AS DATE) = {SD} AND r.dataset_id = sc.dataset_id AND r.version = sc.version) AS has_qc
    FROM sc CROSS JOIN fw JOIN pol ON (pat IS NULL OR sc.dataset_id LIKE pat ESCAPE '\\') AND (fam IS NULL OR fam = sc.dataset_family)),
y AS (SELECT *, concat_ws(',', CASE WHEN need_ads AND NOT has_ads THEN 'ads' END, CASE WHEN need_ml AND NOT has_ml THEN 'ml_ready' END, CASE WHEN need_qc AND NOT has_qc THEN 'qc' END) AS missing_outputs FROM x),
z AS (SELECT *, concat_ws('; ', CASE WHEN missing_outputs <> '' THEN 'missing: ' || missing_outputs END, CASE WHEN qc_pass_rate < mq THEN 'qc_pass_rate' END, CASE WHEN etl_success_rate < me THEN 'etl_success_rate' END, CASE WHEN failed_workflows > mw THEN 'failed_workflows' END) AS why FROM y)
SELECT policy_id, {SD} AS dt, dataset_id, version, CASE WHEN why <> '' THEN 'FAIL' ELSE 'PASS' END AS status, round(qc_pass_rate, 6) AS qc_pass_rate, round(etl_success_rate, 6) AS etl_success_rate, missing_outputs, nullif(why, '') AS failed_reason, failed_workflows FROM z""".replace("LIKE pat ESCAPE '\\'", "LIKE pat ESCAPE '\\'"))  # fmt: skip
add("J6_pattern_join", ["fx_versions"], lambda v: J.pattern_join(policies(v.sparkSession).where("policy_family is null and enabled").select("policy_id", "dataset_pattern", "policy_family"), v.withColumn("dataset_family", F.lit("x"))).select("policy_id", "dataset_id", "version"),
    "SELECT 'p1' AS policy_id, dataset_id, version FROM fx_versions WHERE dataset_id LIKE 'ds%'")
add("J7_outputs_of_jobs", ["fx_outputs", "fx_jobs"], lambda o, j: o.select("job_id").join(j.select("job_id", "model_id"), "job_id").groupBy("model_id").agg(F.count("*").alias("n")), "SELECT model_id, count(*) AS n FROM fx_outputs JOIN fx_jobs USING (job_id) GROUP BY 1")
add("J8_dimension_lookup", ["fx_jobs", "fx_models"], lambda j, m: j.join(m, "model_id", "left").groupBy("backend").agg(F.count("*").alias("n")), "SELECT backend, count(*) AS n FROM fx_jobs LEFT JOIN fx_models USING (model_id) GROUP BY 1")
add("J10_latest_day", ["fx_etl_perf"], lambda p: p.withColumn("dt", F.to_date("created_at")).crossJoin(F.broadcast(p.agg(F.max(F.to_date("created_at")).alias("last")))).where("dt = last").groupBy("dt", "phase").agg(F.count("*").alias("n")),
    "SELECT CAST(created_at AS DATE) AS dt, phase, count(*) AS n FROM fx_etl_perf WHERE CAST(created_at AS DATE) = (SELECT max(CAST(created_at AS DATE)) FROM fx_etl_perf) GROUP BY 1, 2")
add("J11_pending_work", ["fx_files", "fx_files", "fx_files"], lambda a, b, c: J.pending(a, [b.where("size_bytes % 2 = 0"), c.where("size_bytes % 3 = 0")], ["uri"]), "SELECT uri FROM fx_files WHERE NOT (size_bytes % 2 = 0 AND size_bytes % 3 = 0)")
add("J12_lineage_neighbours", ["fx_edges"], lambda e: J.neighbours(e, "ods/ds_1/v1", 10).select("edge_id", "direction", "src_uri", "dst_uri"),
    "SELECT * FROM (SELECT edge_id, 'inbound' AS direction, src_uri, dst_uri FROM fx_edges WHERE dst_uri = 'ods/ds_1/v1' ORDER BY created_at DESC, edge_id DESC LIMIT 10) UNION ALL SELECT * FROM (SELECT edge_id, 'outbound', src_uri, dst_uri FROM fx_edges WHERE src_uri = 'ods/ds_1/v1' ORDER BY created_at DESC, edge_id DESC LIMIT 10)")
add("S1_key_spine", ["fx_etl_perf", "fx_qc_runs", "fx_ml_ready"], lambda *t: J.spine([d.withColumn("dt", F.to_date("created_at")) for d in t], ["dt", "dataset_id", "version"]),
    " UNION ".join(f"SELECT CAST(created_at AS DATE) AS dt, dataset_id, version FROM {t}" for t in ("fx_etl_perf", "fx_qc_runs", "fx_ml_ready")))
add("S2_rule_sources", ["fx_qc_runs"], lambda q: W.fact_qc_rule_result(q).groupBy("rule_id", "status").agg(F.count("*").alias("n")), f"SELECT rule_id, status, count(*) AS n FROM (WITH {FACTS} SELECT * FROM rules) GROUP BY 1, 2")
BACKFILL = f"""WITH {FACTS}, {QUALITY_PARTS}, c AS (SELECT dt, dataset_id, version, phase FROM etl WHERE upper(status) IN ('FAIL', 'FAILED', 'ERROR', 'WARN') UNION SELECT dt, dataset_id, version, 'workflow' FROM steps WHERE upper(phase) IN ('FAIL', 'FAILED', 'ERROR', 'WARN') AND dataset_id IS NOT NULL
    UNION SELECT dt, dataset_id, version, 'build_features' FROM quality WHERE coalesce(qc_pass_rate, 1) < 0.95 OR coalesce(etl_success_rate, 1) < 0.8)
SELECT {md5_of("CAST(dt AS VARCHAR)", "dataset_id", "version", "phase")} AS task_id, dt, dataset_id, version, phase, CASE phase WHEN 'workflow' THEN 'etl' ELSE phase END AS stage, 'PLANNED' AS status FROM c"""


def backfill(perf, qc, steps, runs, ml, snaps, profiles):
    ads = dashboard_of(perf, qc, steps, runs, ml, snaps, profiles)
    return O.backfill_plan(O.backfill_candidates(W.fact_etl_run(perf), W.fact_workflow_step(steps, runs), ads))


add("P18_backfill_plan", [*SOURCES, "fx_profiles"], backfill, BACKFILL)
add("S4_concatenate_slices", ["fx_etl_perf", "fx_profiles"], lambda a, b: a.select("dataset_id", "job_id").unionByName(b.select("dataset_id", "layer"), allowMissingColumns=True).groupBy("dataset_id").agg(F.count("job_id").alias("jobs"), F.count("layer").alias("layers")),
    "SELECT dataset_id, count(job_id) AS jobs, count(layer) AS layers FROM (SELECT dataset_id, job_id, NULL AS layer FROM fx_etl_perf UNION ALL SELECT dataset_id, NULL, layer FROM fx_profiles) GROUP BY 1")
OLD, NEW = "event_id <= 6000", "event_id >= 5000"
cols = ["event_id", "k", "dataset_id"]
add("K1_upsert", ["fx_ev"], lambda e: J.upsert(e.where(OLD).select(*cols), e.where(NEW).select("event_id", (F.col("k") + 1000).alias("k"), "dataset_id"), ["event_id"]), f"SELECT event_id, CASE WHEN {NEW} THEN k + 1000 ELSE k END AS k, dataset_id FROM fx_ev")
add("K2_upsert_keeping", ["fx_ev"], lambda e: J.upsert_keeping(e.where(OLD).select("event_id", "k", F.col("ts").alias("first_seen")), e.where(NEW).select("event_id", F.when(F.col("k") % 2 == 0, F.col("k") + 1000).alias("k"), (F.col("ts") + F.expr("interval 1 day")).alias("first_seen")), ["event_id"], ("first_seen",)),
    f"SELECT event_id, CASE WHEN {NEW} AND k % 2 = 0 THEN k + 1000 WHEN {OLD} THEN k END AS k, CASE WHEN {OLD} THEN ts ELSE ts + INTERVAL 1 DAY END AS first_seen FROM fx_ev")
add("K3_newest_in_batch", ["fx_ev"], lambda e: J.newest(e.select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]), "SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS p FROM fx_ev) WHERE p = 1")

# ---------------------------------------------------------------- scalar operators

SHARE = "('0x' || substr(sha256({}), 1, 16))::UBIGINT"
add("M1_keys", ["fx_workflow_steps"], lambda s: s.select("pod_name", E.key("workflow_namespace", "workflow_name", "pod_name").alias("k")), f"SELECT pod_name, {md5_of('workflow_namespace', 'workflow_name', 'pod_name')} AS k FROM fx_workflow_steps")
add("M3_training_split", ["fx_pose"], lambda p: p.select("dataset_id", "episode_id").distinct().withColumn("split", E.training_split("dataset_id", "episode_id", "v1", {"train": 0.8, "val": 0.1, "test": 0.1})),
    f"WITH e AS (SELECT DISTINCT dataset_id, episode_id FROM fx_pose), s AS (SELECT *, CAST({SHARE.format(chr(34) + 'k' + chr(34))} AS DOUBLE) / 18446744073709551616.0 AS u FROM (SELECT *, dataset_id || '|' || episode_id || '|v1' AS k FROM e)) SELECT dataset_id, episode_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split FROM s")
add("M4_distillation_split", ["fx_outputs"], lambda o: o.select("sample_id", E.distillation_split("sample_id", {"train": 0.9, "val": 0.1}).alias("split")), f"SELECT sample_id, CASE WHEN ({SHARE.format('sample_id')} % 10000) / 10000.0 < 0.9 THEN 'train' ELSE 'val' END AS split FROM fx_outputs")
add("M5_dashboard_scores", ["fx_ev"], lambda e: e.select("event_id", (F.col("k") / 100.0).alias("a"), F.when(F.col("k") % 2 == 0, F.col("k") / 50.0).alias("b"), F.lit(None).cast("double").alias("c")).select("event_id", E.dashboard_score("a", "b", "c").alias("lenient"), E.dashboard_score_strict("a", "b", "c").alias("strict")),
    "SELECT event_id, round(0.5 * k + CASE WHEN k % 2 = 0 THEN 30 * k / 50.0 ELSE 30 END + 20, 6) AS lenient, round(0.6 * k + CASE WHEN k % 2 = 0 THEN 30 * k / 50.0 ELSE 0 END, 2) AS strict FROM fx_ev")
add("M6_failures", ["fx_outputs"], I.failures, f"SELECT job_id, sample_id, {ERROR_CASE} AS error_type, {ERROR_CASE} IN ('OPENAI_TIMEOUT', 'OPENAI_ENDPOINT_UNAVAILABLE', 'UNKNOWN') AS retryable FROM fx_outputs WHERE status = 'FAILED'")


def samples(d):
    return d.select(F.col("doc_id").cast("string").alias("sample_id"), F.col("text").alias("input_text"), F.col("source").alias("dataset_id"), F.concat(F.lit("ep"), "doc_id").alias("episode_id"),
                    F.when(F.col("doc_id") % 3 > 0, (F.col("doc_id") % 100).cast("double")).alias("quality_score"), F.when(F.col("doc_id") % 3 > 1, (F.col("doc_id") % 5).cast("double")).alias("max_velocity_mps"), F.lit(None).cast("double").alias("null_rate"), F.lit("OK").alias("status"))


add("M7_anomaly_scores", ["documents"], lambda d: samples(d).select("sample_id", I.anomaly_score("sample_id", "quality_score", "max_velocity_mps", "null_rate").alias("score")), """
WITH s AS (SELECT CAST(doc_id AS VARCHAR) AS sample_id, CASE WHEN doc_id % 3 > 0 THEN (1 - (doc_id % 100) / 100.0) * 0.5 END AS q, CASE WHEN doc_id % 3 > 1 THEN least((doc_id % 5) / 2.0, 1) * 0.3 END AS v FROM documents)
SELECT sample_id, round(CASE WHEN q IS NULL AND v IS NULL THEN (('0x' || substr(sha256(sample_id), 1, 2))::INT % 1000) / 1000.0 ELSE (coalesce(q, 0) + coalesce(v, 0)) / (CASE WHEN q IS NULL THEN 0 ELSE 0.5 END + CASE WHEN v IS NULL THEN 0 ELSE 0.3 END) END, 6) AS score FROM s""")  # fmt: skip
add("M8_text_embedding", ["conversations"], lambda c: c.select("conv_id", "turn", F.concat_ws(",", F.transform(I.text_embedding(F.col("text")), lambda v: F.format_number(v, 4))).alias("embedding")), """
WITH l AS (SELECT conv_id, turn, text, list_filter(regexp_split_to_array(regexp_replace(coalesce(text, ''), '[/:]', ' ', 'g'), '\\s+'), lambda x: x <> '') AS ws FROM conversations),
t AS (SELECT conv_id, turn, unnest(CASE WHEN len(ws) = 0 THEN [coalesce(nullif(text, ''), 'empty')] ELSE ws END) AS w FROM l), h AS (SELECT conv_id, turn, sha256(w) AS h FROM t),
p AS (SELECT conv_id, turn, ('0x' || substr(h, 1, 2))::INT % 32 AS i, CASE WHEN ('0x' || substr(h, 3, 2))::INT % 2 = 0 THEN 1.0 ELSE -1.0 END AS s FROM h), v AS (SELECT conv_id, turn, i, sum(s) AS v FROM p GROUP BY 1, 2, 3), n AS (SELECT conv_id, turn, sqrt(sum(v * v)) AS n FROM v GROUP BY 1, 2)
SELECT conv_id, turn, string_agg(format('{:.4f}', round(coalesce(v / nullif(n, 0), 0), 6)), ',' ORDER BY i) AS embedding FROM (SELECT conv_id, turn, n, unnest(range(32)) AS i FROM n) LEFT JOIN v USING (conv_id, turn, i) GROUP BY 1, 2""")  # fmt: skip
add("M9_id_embedding", ["documents"], lambda d: d.select("doc_id", F.posexplode(I.id_embedding(F.col("doc_id").cast("string")))).select("doc_id", F.col("pos").alias("i"), F.col("col").alias("v")),
    f"SELECT doc_id, CAST(i AS INT) AS i, round(({SHARE.format('CAST(doc_id AS VARCHAR) || chr(58) || i')} % 1000000) / 1000000.0 * 2 - 1, 6) AS v FROM documents, range(16) r(i)")
add("M10_compared_reports", ["fx_etl_perf"], lambda p: O.compared_reports(*(p.where(c).groupBy(F.col("dataset_id").alias("metric")).agg(F.avg("duration_sec").alias("value")) for c in ("version = 'v1'", "version = 'v2'")), p.select(F.col("dataset_id").alias("metric")).distinct().select("metric", F.lit(False).alias("higher_is_better"), F.lit(0.01).alias("warn"), F.lit(0.05).alias("fail"))).select("metric", "before", "after", "status"),
    "SELECT metric, round(before, 6) AS before, round(after, 6) AS after, CASE WHEN (after - before) / before > 0.05 THEN 'FAIL' WHEN (after - before) / before > 0.01 THEN 'WARN' ELSE 'PASS' END AS status FROM (SELECT dataset_id AS metric, avg(duration_sec) FILTER (version = 'v1') AS before, avg(duration_sec) FILTER (version = 'v2') AS after FROM fx_etl_perf GROUP BY 1) WHERE before IS NOT NULL AND after IS NOT NULL")
add("M11_job_outcomes", ["fx_outputs", "fx_jobs"], lambda o, j: I.job_outcomes(A.inference_metrics(o, j)), f"WITH {METRICS} SELECT job_id, CASE WHEN error_rate > 0.2 THEN 'FAILED' WHEN error_rate > 0 THEN 'PARTIAL' ELSE 'SUCCEEDED' END AS outcome FROM im")
add("M12_family", ["fx_files"], lambda f: O.family_of(f, ["dataset_id", "lang"]), "SELECT dataset_id, lang, CASE WHEN bool_or(uri LIKE '%.hdf5') THEN 'robomimic' WHEN bool_or(uri LIKE '%.parquet') AND bool_or(uri LIKE '%.mp4') THEN 'droid' WHEN bool_or(uri LIKE '%.parquet') THEN 'bridge' ELSE 'unknown' END AS family FROM fx_files GROUP BY 1, 2")
add("M13_nested_paths", ["events"], lambda e: e.sparkSession.createDataFrame([(p,) for p in T.nested_paths(e.select(F.struct("user_id", F.struct("value", "props").alias("inner")).alias("s"), "ts").limit(0).schema)], "path string").join(e.agg(F.count("*").alias("n_rows"))),
    "SELECT unnest(['s.user_id', 's.inner.value', 's.inner.props', 'ts']) AS path, (SELECT count(*) FROM events) AS n_rows")
add("M14_captions", ["documents"], lambda d: samples(d).select("sample_id", I.caption("dataset_id", "episode_id").alias("text")), "SELECT CAST(doc_id AS VARCHAR) AS sample_id, 'Episode ep' || doc_id || ' of dataset ' || source || ' processed by local_cpu rule captioner.' AS text FROM documents")
add("M15_start_times", ["fx_ev"], lambda e: e.select("event_id", F.when(F.col("k") % 3 == 0, F.col("ts")).alias("s"), F.col("ts").alias("f"), F.when(F.col("k") % 3 == 1, F.col("k").cast("double")).alias("d")).select("event_id", E.started("s", "f", "d").alias("started_at")),
    "SELECT event_id, CASE WHEN k % 3 = 1 THEN ts - to_seconds(k) ELSE ts END AS started_at FROM fx_ev")
add("M16_adapters", ["fx_files"], lambda f: O.adapters(f, ["dataset_id", "version"], [("droid", "src1", ".mp4"), ("bridge", "src", ".parquet"), ("robomimic", "x", ".hdf5")]),
    """WITH m(family, place, prefix, layout) AS (VALUES ('droid', 0, 'src1', '.mp4'), ('bridge', 1, 'src', '.parquet'), ('robomimic', 2, 'x', '.hdf5')), h AS (SELECT dataset_id, version, family, place, CASE WHEN starts_with(dataset_id, prefix) THEN 0.4 ELSE 0 END + CASE WHEN bool_or(contains(uri, layout)) THEN 0.6 ELSE 0 END AS c FROM fx_files, m GROUP BY dataset_id, version, family, place, prefix)
    SELECT dataset_id, version, CASE WHEN c >= 0.4 THEN family ELSE 'unknown' END AS family, CAST(c AS DOUBLE) AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, version ORDER BY c DESC, place) AS p FROM h) WHERE p = 1""")  # fmt: skip
add("M17_tasks", ["fx_models"], lambda m: m.withColumn("t", F.when(F.col("backend") == "mock", "Embedding").when(F.col("backend") == "http", "anomaly_scorer")).select("model_id", I.task_of("t").alias("task")), "SELECT model_id, CASE backend WHEN 'mock' THEN 'embedding' WHEN 'http' THEN 'anomaly_score' ELSE 'caption' END AS task FROM fx_models")

# ---------------------------------------------------------------- gates and exports


def file_kinds(f):
    kind = F.when(F.col("uri").endswith("mp4"), "video").when(F.col("uri").endswith("hdf5"), "hdf5").otherwise("parquet")
    return f.select("dataset_id", "version", kind.alias("kind"), "size_bytes", (F.col("size_bytes") % 9 > 0).alias("readable"))


GATED = """f AS (SELECT dataset_id, version, CASE WHEN uri LIKE '%mp4' THEN 'video' WHEN uri LIKE '%hdf5' THEN 'hdf5' ELSE 'parquet' END AS kind, size_bytes, size_bytes % 9 > 0 AS readable FROM fx_files),
g AS (SELECT dataset_id, version, count(*) AS n, count(*) FILTER (size_bytes = 0) AS z, coalesce(count(*) FILTER (kind = 'parquet' AND readable) / nullif(count(*) FILTER (kind = 'parquet'), 0), 1) AS p, coalesce(count(*) FILTER (kind = 'hdf5' AND readable) / nullif(count(*) FILTER (kind = 'hdf5'), 0), 1) AS h,
    coalesce(count(*) FILTER (kind = 'video' AND readable) / nullif(count(*) FILTER (kind = 'video'), 0), 1) AS v FROM f GROUP BY 1, 2)"""
add("P14_gate", ["fx_files"], lambda f: O.gate(O.rule_results(O.file_metrics(file_kinds(f), ["dataset_id", "version"]), O.universal_rules(f.sparkSession), ["dataset_id", "version"]), ["dataset_id", "version"]),
    f"WITH {GATED} SELECT dataset_id, version, CASE WHEN z > 0 OR p < 0.95 OR h < 0.95 OR v < 0.9 THEN 'WARN' ELSE 'PASS' END AS status, '' AS failed_rules, concat_ws(',', CASE WHEN z > 0 THEN 'empty_files_count' END, CASE WHEN h < 0.95 THEN 'hdf5_readable_rate' END, CASE WHEN p < 0.95 THEN 'parquet_readable_rate' END, CASE WHEN v < 0.9 THEN 'video_decode_pass_rate' END) AS warning_rules FROM g")
add("P15_file_metrics", ["fx_files"], lambda f: O.file_metrics(file_kinds(f), ["dataset_id", "version"]),
    f"WITH {GATED} SELECT dataset_id, version, u.metric, round(u.actual, 6) AS actual FROM g, LATERAL (VALUES ('files_count', CAST(n AS DOUBLE)), ('empty_file_count', CAST(z AS DOUBLE)), ('readable_parquet_rate', p), ('readable_hdf5_rate', h), ('video_decode_pass_rate', v)) u(metric, actual)")
add("F5_rule_results", ["fx_files"], lambda f: O.rule_results(O.file_metrics(file_kinds(f), ["dataset_id", "version"]), O.universal_rules(f.sparkSession), ["dataset_id", "version"]).groupBy("rule_id", "status").agg(F.count("*").alias("n")),
    f"WITH {GATED}, r AS (SELECT u.rule_id, u.ok FROM g, LATERAL (VALUES ('object_count_min', n >= 1), ('empty_files_count', z <= 0), ('parquet_readable_rate', p >= 0.95), ('hdf5_readable_rate', h >= 0.95), ('video_decode_pass_rate', v >= 0.9)) u(rule_id, ok)) SELECT rule_id, CASE WHEN ok THEN 'PASS' WHEN rule_id = 'object_count_min' THEN 'FAIL' ELSE 'WARN' END AS status, count(*) AS n FROM r GROUP BY 1, 2")
EXPORT_VIEWS = ["documents", "labels"]


def export_of(d, labels):
    f = d.select(F.col("source").alias("dataset_id"), F.lit("v1").alias("version"), F.concat(F.lit("e"), "doc_id").alias("episode_id"), "doc_id", F.col("n_chars").alias("num_samples"))
    q = labels.join(d.select("doc_id", "source"), "doc_id").select(F.col("source").alias("dataset_id"), F.lit("v1").alias("version"), F.concat(F.lit("e"), "doc_id").alias("episode_id"), (F.col("quality") * 90.0).alias("quality_score"), F.when(F.col("toxic") == 1, "FAIL").otherwise("PASS").alias("quality_status"), F.lit(1).alias("num_samples"))
    qc = d.select(F.col("source").alias("dataset_id"), F.lit("v1").alias("version"), F.when(F.col("source") == "src3", "FAIL").otherwise("PASS").alias("status")).distinct()
    return I.training_export(f, q, qc)


EXPORTED = f"""x AS (SELECT source AS dataset_id, 'v1' AS version, 'e' || doc_id AS episode_id, doc_id, quality * 90.0 AS quality_score, CAST({SHARE.format("source || '|e' || doc_id || '|v1'")} AS DOUBLE) / 18446744073709551616.0 AS u FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND toxic = 0 AND source <> 'src3'),
y AS (SELECT *, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split FROM x)"""
add("P16_training_export", EXPORT_VIEWS, lambda d, q: export_of(d, q)[0].select("dataset_id", "version", "episode_id", "doc_id", "split"), f"WITH {EXPORTED} SELECT dataset_id, version, episode_id, doc_id, split FROM y")
add("P16_training_card", EXPORT_VIEWS, lambda d, q: export_of(d, q)[1], f"WITH {EXPORTED} SELECT dataset_id, version, count(*) AS num_rows, count(*) FILTER (split = 'train') AS num_train, count(*) FILTER (split = 'val') AS num_val, count(*) FILTER (split = 'test') AS num_test, round(avg(quality_score), 6) AS avg_quality_score FROM y GROUP BY 1, 2")
add("J9_features_with_quality", EXPORT_VIEWS, lambda d, q: export_of(d, q)[0].agg(F.count("*").alias("n"), F.sum("num_samples").alias("samples"), F.sum("num_samples_quality").alias("ones")), f"WITH {EXPORTED} SELECT count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS samples, count(*) AS ones FROM y JOIN documents USING (doc_id)")
add("F7_quality_filter", ["fx_ev"], lambda e: I.quality_filtered(e.select("event_id", F.when(F.col("k") % 5 > 0, F.col("k").cast("double")).alias("quality_score"), F.when(F.col("k") % 3 == 0, "FAIL").when(F.col("k") % 3 == 1, "PASS").alias("quality_status"), F.when(F.col("k") % 7 == 0, "FAIL").alias("qc_status"), F.col("k").alias("num_samples")), 50.0, least=60).select("event_id"),
    "SELECT event_id FROM fx_ev WHERE k % 5 > 0 AND k >= 60 AND k % 3 <> 0 AND k % 7 <> 0")
SCORES = """s AS (SELECT CAST(doc_id AS VARCHAR) AS sample_id, CASE WHEN doc_id % 3 > 0 THEN (1 - (doc_id % 100) / 100.0) * 0.5 END AS q, CASE WHEN doc_id % 3 > 1 THEN least((doc_id % 5) / 2.0, 1) * 0.3 END AS v FROM documents),
a AS (SELECT sample_id, CASE WHEN q IS NULL AND v IS NULL THEN (('0x' || substr(sha256(sample_id), 1, 2))::INT % 1000) / 1000.0 ELSE (coalesce(q, 0) + coalesce(v, 0)) / (CASE WHEN q IS NULL THEN 0 ELSE 0.5 END + CASE WHEN v IS NULL THEN 0 ELSE 0.3 END) END AS score FROM s)"""
# (3 + 3: the score is rounded once, in the operator, so the text must not be nudged)
add("P20_score_embedding", ["documents"], lambda d: I.score_batch(samples(d), "embedding").select("sample_id", "prediction_type", F.posexplode(F.from_json(F.get_json_object("prediction_json", "$.embedding"), "array<double>")).alias("i", "v"), F.get_json_object("prediction_json", "$.dim").cast("int").alias("dim")), """
WITH l AS (SELECT CAST(doc_id AS VARCHAR) AS sample_id, list_filter(regexp_split_to_array(regexp_replace(text, '[/:]', ' ', 'g'), '\\s+'), lambda x: x <> '') AS ws, text FROM documents),
t AS (SELECT sample_id, unnest(CASE WHEN len(ws) = 0 THEN [coalesce(nullif(text, ''), 'empty')] ELSE ws END) AS w FROM l), h AS (SELECT sample_id, sha256(w) AS h FROM t),
p AS (SELECT sample_id, ('0x' || substr(h, 1, 2))::INT % 32 AS i, CASE WHEN ('0x' || substr(h, 3, 2))::INT % 2 = 0 THEN 1.0 ELSE -1.0 END AS s FROM h), v AS (SELECT sample_id, i, sum(s) AS v FROM p GROUP BY 1, 2), n AS (SELECT sample_id, sqrt(sum(v * v)) AS n FROM v GROUP BY 1)
SELECT sample_id, 'embedding' AS prediction_type, CAST(i AS INT) AS i, round(coalesce(v / nullif(n, 0), 0), 3 + 3) AS v, 32 AS dim FROM (SELECT sample_id, n, unnest(range(32)) AS i FROM n) LEFT JOIN v USING (sample_id, i)""")  # fmt: skip
add("P20_score_anomaly_scorer", ["documents"], lambda d: I.score_batch(samples(d), "anomaly_scorer").select("sample_id", "prediction_type", F.get_json_object("prediction_json", "$.label").alias("label"), F.get_json_object("prediction_json", "$.anomaly_score").cast("double").alias("score"), "confidence"),
    f"WITH {SCORES} SELECT sample_id, 'anomaly_score' AS prediction_type, CASE WHEN round(score, 6) >= 0.5 THEN 'anomaly' ELSE 'normal' END AS label, round(score, 6) AS score, round(score, 6) AS confidence FROM a")
add("P20_score_caption", ["documents"], lambda d: I.score_batch(samples(d), "caption").select("sample_id", "prediction_type", "prediction_json", "confidence"),
    """SELECT CAST(doc_id AS VARCHAR) AS sample_id, 'caption' AS prediction_type, '{"text":"Episode ep' || doc_id || ' of dataset ' || source || ' processed by local_cpu rule captioner."}' AS prediction_json, 0.5 AS confidence FROM documents""")  # fmt: skip
add("P21_distill_captions", ["documents"], lambda d: I.distill(I.score_batch(samples(d), "caption"), "caption_sft", "t1"),
    """SELECT CAST(doc_id AS VARCHAR) AS sample_id, '{"id":"' || doc_id || '","instruction":"Describe the robot episode.","input":"' || source || '/ep' || doc_id || '","output":"Episode ep' || doc_id || ' of dataset ' || source || ' processed by local_cpu rule captioner.","teacher_model":"t1","metadata":{"confidence":0.5,"prediction_type":"caption"}}' AS record FROM documents""")  # fmt: skip
add("P21_distill_anomalies", ["documents"], lambda d: I.distill(I.score_batch(samples(d), "anomaly_scorer"), "anomaly_detection", "t1").select("sample_id", F.get_json_object("record", "$.label").alias("label")),
    f"WITH {SCORES} SELECT sample_id, CASE WHEN round(score, 6) >= 0.5 THEN 'anomaly' ELSE 'normal' END AS label FROM a")
add("T20_top_rule", ["fx_qc_runs"], lambda q: W.top_per_key(W.dws_rule_failure_daily(W.fact_qc_rule_result(q)).where("fail_count > 0").groupBy("dt", "rule_id").agg(F.sum("fail_count").alias("n")), ["dt"], "n", "rule_id"),
    f"WITH {FACTS}, {RULE_DAILY} SELECT dt, rule_id, n FROM (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY n DESC, rule_id) AS p FROM (SELECT dt, rule_id, CAST(sum(fail_count) AS BIGINT) AS n FROM rule_daily WHERE fail_count > 0 GROUP BY 1, 2)) WHERE p = 1")
STALE = "l AS (SELECT workflow_name, phase, step_name, event_id, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(updated_at)) / 1e6 AS age_sec FROM (SELECT *, row_number() OVER (PARTITION BY workflow_name, phase, step_name ORDER BY updated_at DESC, event_id DESC) AS p FROM fx_heartbeats) WHERE p = 1)"
add("T22_stale_heartbeats", ["fx_heartbeats"], lambda h: T.stale(h, F.lit(NOW), 100_000.0, 200_000.0), f"WITH {STALE} SELECT workflow_name, phase, step_name, event_id, round(age_sec, 6) AS age_sec, CASE WHEN age_sec >= 200000 THEN 'stale' WHEN age_sec >= 100000 THEN 'warn' ELSE 'ok' END AS state FROM l")
add("T21_latest_heartbeat", ["fx_heartbeats"], lambda h: X.liveness_batch(h, 100_000.0, 200_000.0, F.lit(NOW)).drop("state"), "SELECT workflow_name, phase, step_name, updated_at, event_id FROM (SELECT *, row_number() OVER (PARTITION BY workflow_name, phase, step_name ORDER BY updated_at DESC, event_id DESC) AS p FROM fx_heartbeats) WHERE p = 1")
# equal attempts of a job: the row that comes first in the table, which DuckDB keeps on one thread (on more, its runs differ)
add("T23_last_attempts", ["fx_outputs"], lambda o: I.last_attempts(o.withColumn("sample_id", F.col("job_id")), "_place").select("job_id", "attempt", "status"), "SELECT job_id, attempt, status FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY attempt DESC) AS p FROM fx_outputs) WHERE p = 1", source=placed)


def transitions(e):
    allowed = e.sparkSession.createDataFrame([("signup", "view"), ("view", "click"), ("click", "purchase"), ("view", "purchase")], "from_status string, to_status string")
    return I.illegal_transitions(e.select(F.col("user_id").alias("job_id"), "event_id", F.col("event_type").alias("status")), allowed)


add("T24_illegal_transitions", ["events"], transitions, "SELECT from_status, to_status, job_id, event_id FROM (SELECT user_id AS job_id, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS from_status, event_type AS to_status FROM events) WHERE from_status <> to_status AND (from_status, to_status) NOT IN (('signup', 'view'), ('view', 'click'), ('click', 'purchase'), ('view', 'purchase'))")
add("P24_lineage_report", ["fx_workflow_runs", "fx_workflow_steps"], O.lineage_report,
    "SELECT r.*, n_steps, failed_steps, round(total_sec, 6) AS total_sec FROM fx_workflow_runs r LEFT JOIN (SELECT workflow_namespace, workflow_name, count(*) AS n_steps, count(*) FILTER (upper(phase) IN ('FAILED', 'ERROR')) AS failed_steps, sum(duration_sec) AS total_sec FROM fx_workflow_steps GROUP BY 1, 2) s ON s.workflow_namespace IS NOT DISTINCT FROM r.workflow_namespace AND s.workflow_name = r.workflow_name")
add("P24_lineage_related", ["fx_workflow_steps", "fx_qc_runs", "fx_ml_ready", "fx_profiles"], lambda s, q, m, p: O.lineage_related(s, q, m, p, "wf-1", "ns"), """
WITH a AS (SELECT 'step' AS section, row_number() OVER (ORDER BY started_at, pod_name) AS place, pod_name AS id, dataset_id, version, phase AS status, started_at AS at FROM fx_workflow_steps WHERE workflow_name = 'wf-1' AND workflow_namespace = 'ns' QUALIFY place <= 500),
b AS (SELECT 'qc_run' AS section, row_number() OVER (ORDER BY created_at DESC, run_id) AS place, run_id, dataset_id, version, status, created_at FROM fx_qc_runs QUALIFY place <= 20),
c AS (SELECT 'ml_ready' AS section, row_number() OVER (ORDER BY created_at DESC, ml_id) AS place, CAST(ml_id AS VARCHAR), dataset_id, version, output_uri, created_at FROM fx_ml_ready QUALIFY place <= 20),
d AS (SELECT 'profile' AS section, row_number() OVER (ORDER BY created_at DESC, profile_id) AS place, profile_id, dataset_id, version, layer, created_at FROM fx_profiles QUALIFY place <= 20)
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c UNION ALL SELECT * FROM d""")
add("P25_manifest_audit", ["fx_versions"], lambda v: O.manifest_audit(v.select("dataset_id", "version"), v.where("dataset_id <> 'ds_0'").select("dataset_id", "version", F.when(F.col("version") == "v1", F.lit('{"files":1,"rows":2}')).otherwise('{"files":1}').alias("manifest_json")), ["dataset_id", "version"], ("files", "rows", "job")),
    "SELECT dataset_id, version, CASE WHEN dataset_id = 'ds_0' THEN 'files,rows,job' WHEN version = 'v1' THEN 'job' ELSE 'rows,job' END AS missing_keys, CASE WHEN dataset_id = 'ds_0' THEN 'FAIL' ELSE 'WARN' END AS status FROM fx_versions")


def reingest(e):
    target = e.where("event_id % 10 < 5").select("event_id", "event_type")
    raw = F.when(F.col("event_id") % 10 == 9, F.lit("{broken")).otherwise(F.to_json(F.struct(F.lit(1).alias("attempt"), F.struct("event_id", "event_type").alias("record"))))
    return O.reingested(target, e.where("event_id % 10 > 3").select(raw.alias("raw")), ["event_id"])[0]


add("P26_reingest", ["events"], reingest, "SELECT event_id, event_type FROM events WHERE event_id % 10 <> 9")
add("P27_size_buckets", ["fx_files"], lambda f: A.running_buckets(f, 50_000, 8).select("dataset_id", "uri", "size_bytes", "bucket"), """
WITH o AS (SELECT dataset_id, uri, size_bytes, coalesce(sum(size_bytes) OVER (PARTITION BY dataset_id ORDER BY size_bytes DESC, uri ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM fx_files)
SELECT dataset_id, uri, size_bytes, CAST(least(ahead // 50000 + 1, 8) AS INT) AS bucket FROM o""")
add("P30_reconcile", ["fx_files"], lambda f: O.reconciled(f, f.where("size_bytes % 7 > 0").withColumn("size_bytes", F.when(F.col("size_bytes") % 5 == 0, F.col("size_bytes") + 1).otherwise(F.col("size_bytes"))), ["dataset_id", "version"]),
    "SELECT dataset_id, version, count(*) FILTER (size_bytes % 7 = 0) AS missing, count(*) FILTER (size_bytes % 7 > 0 AND size_bytes % 5 = 0) AS wrong_size, count(*) FILTER (size_bytes % 7 > 0 AND size_bytes % 5 > 0) AS present, CAST(coalesce(sum(size_bytes) FILTER (size_bytes % 7 > 0 AND size_bytes % 5 > 0), 0) AS BIGINT) AS present_bytes, CASE WHEN count(*) FILTER (size_bytes % 7 = 0) > 0 THEN 'FAIL' WHEN count(*) FILTER (size_bytes % 5 = 0) > 0 THEN 'WARN' ELSE 'PASS' END AS status FROM fx_files GROUP BY 1, 2")
add("P31_probe_summary", ["fx_probes"], lambda p: Q.probe_summary(probes_of(p), SLICE).withColumn("columns", F.concat_ws(",", "columns")), f"""
WITH c AS (SELECT dataset_id, version, string_agg(DISTINCT c, ',' ORDER BY c) AS columns FROM (SELECT dataset_id, version, unnest(string_split(column_list, ',')) AS c FROM fx_probes WHERE {PARQUET}) GROUP BY 1, 2)
SELECT dataset_id, version, count(*) AS files_count, CAST(sum(size_bytes) AS BIGINT) AS bytes_total, count(*) FILTER (kind = 'parquet') AS parquet_files, CAST(coalesce(sum(2) FILTER ({PARQUET} AND length_list <> ''), 0) AS BIGINT) AS episodes_count,
    count(*) FILTER (kind = 'parquet' AND NOT readable) AS errors, coalesce(any_value(columns), '') AS columns, CASE WHEN count(*) FILTER (kind = 'parquet' AND NOT readable) > 0 THEN 'WARN' ELSE 'OK' END AS status
FROM fx_probes LEFT JOIN c USING (dataset_id, version) GROUP BY 1, 2""")
add("P32_phase_rows", ["fx_etl_perf"], lambda p: O.phase_rows(p.select("job_id", *((F.col("duration_sec") * k).alias(f"{n}_sec") for n, k in (("normalize", 1.0), ("features", 2.0), ("ads", 3.0)))), ["job_id"]),
    "SELECT job_id, u.phase, round(duration_sec * u.m, 6) AS duration_sec FROM fx_etl_perf, LATERAL (VALUES ('normalize', 1), ('features', 2), ('ads', 3)) u(phase, m)")
add("P19_report_top_rules_of_day", ["fx_qc_runs"], lambda q: O.top_rules(W.within(W.dws_rule_failure_daily(W.fact_qc_rule_result(q)), (DAY, DAY)), 5), f"WITH {FACTS}, {RULE_DAILY} SELECT dt, contract_id, rule_id, severity, dataset_family, fail_count, run_count, round(fail_rate, 6) AS fail_rate FROM rule_daily WHERE dt = {SD} AND fail_count > 0 ORDER BY fail_count DESC, rule_id, contract_id, severity, dataset_family LIMIT 5")

# ---------------------------------------------------------------- sources, sinks and streams (written to the shared folder and read back)


def run(name: str, sql: str | None = None):
    def register(function):
        from ..fixtures import cte

        family.QUERIES[name] = lambda spark, sf: rounded(function(spark, sf))
        if sql:
            family.ORACLES[name] = nudged(cte(sql))
        return function

    return register


@run("R1_read_or_empty", "SELECT 'there' AS what, count(*) AS n FROM events UNION ALL SELECT 'missing', 0")
def _(spark, sf):
    schema = frame(spark, sf, "events").schema
    there, a = T.read_or_empty(spark, f"{sf}/events.parquet", schema)
    missing, b = T.read_or_empty(spark, f"{sf}/no_such_table.parquet", schema)
    assert a and not b
    return there.agg(F.count("*").alias("n")).select(F.lit("there").alias("what"), "n").union(missing.agg(F.count("*").alias("n")).select(F.lit("missing"), "n"))


@run("R2_row_day_wins", "SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    e = frame(spark, sf, "events").withColumn("dt", F.to_date("ts"))
    path = scratch.folder(spark, "exports")
    e.write.parquet(f"{path}/dt=1999-01-01")
    return T.read_or_empty(spark, path, e.schema)[0].groupBy("dt").agg(F.count("*").alias("n"))


@run("R3_read_slices", "SELECT dataset_id, version, count(*) AS n FROM fx_ev GROUP BY 1, 2")
def _(spark, sf):
    e = frame(spark, sf, "fx_ev").select("event_id", "dataset_id", "version")
    path = scratch.folder(spark, "slices")
    for d, v in [(r.dataset_id, r.version) for r in e.select("dataset_id", "version").distinct().collect()]:  # slices of the fixture
        e.where((F.col("dataset_id") == d) & (F.col("version") == v)).withColumn("dataset_id", F.when(F.col("event_id") % 2 == 0, "").otherwise(F.col("dataset_id"))).write.parquet(f"{path}/{d}/{v}/episode_feature.parquet")
    return T.read_slices(spark, path, "episode_feature.parquet", e.schema).groupBy("dataset_id", "version").agg(F.count("*").alias("n"))


@run("R5_read_lines", "SELECT event_type, count(*) AS n FROM events WHERE event_id % 10 <> 3 GROUP BY 1")
def _(spark, sf):
    path = scratch.folder(spark, "lines")
    line = F.when(F.col("event_id") % 10 == 3, '{"event_id": 1, "event_type').otherwise(F.to_json(F.struct("event_id", "event_type")))
    frame(spark, sf, "events").select(line.alias("value")).write.text(path)
    return T.read_lines(spark, path, "event_id long, event_type string", "event_id").groupBy("event_type").agg(F.count("*").alias("n"))


@run("R6_chosen_split", f"SELECT count(*) AS n FROM (SELECT ({SHARE.format('sample_id')} % 10000) / 10000.0 AS u FROM fx_outputs) WHERE u >= 0.9")
def _(spark, sf):
    o = frame(spark, sf, "fx_outputs").withColumn("split", E.distillation_split("sample_id", {"train": 0.9, "val": 0.1}))
    return T.chosen_split(o, o, "val").agg(F.count("*").alias("n"))


def workflow_docs(spark, sf):
    s = frame(spark, sf, "fx_workflow_steps").where("workflow_namespace is not null")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kind = F.when(F.col("exit_code") == 1, "Pod").when(F.col("step_name") == "step-3", "Retry").otherwise("DAG")
    node = F.struct(F.col("pod_name").alias("id"), F.col("step_name").alias("displayName"), kind.alias("type"), "phase", iso("started_at").alias("startedAt"), iso(F.col("started_at") + F.expr("interval 90 seconds")).alias("finishedAt"), F.when(F.col("step_name") == "step-0", "x").otherwise(F.col("exit_code").cast("string")).alias("exitCode"))
    d = s.groupBy("workflow_name", "workflow_namespace").agg(F.map_from_entries(F.collect_list(F.struct(F.col("pod_name"), node))).alias("nodes"), iso(F.min("started_at")).alias("a"), iso(F.max("started_at")).alias("b"))
    return d.select(F.to_json(F.struct(F.struct(F.col("workflow_name").alias("name"), F.col("workflow_namespace").alias("namespace")).alias("metadata"), F.struct(F.lit("Succeeded").alias("phase"), F.col("a").alias("startedAt"), F.col("b").alias("finishedAt"), "nodes").alias("status"))).alias("document"))


NODES = "nd AS (SELECT *, CASE WHEN exit_code = 1 THEN 'Pod' WHEN step_name = 'step-3' THEN 'Retry' ELSE 'DAG' END AS t, CASE WHEN step_name <> 'step-0' THEN exit_code END AS code FROM fx_workflow_steps WHERE workflow_namespace IS NOT NULL)"


@run("R7_workflow_documents", f"WITH {NODES} SELECT workflow_name, workflow_namespace, pod_name AS node_id, step_name, t AS node_type, phase, 90.0::DOUBLE AS duration_sec, code AS exit_code FROM nd WHERE t <> 'Retry'")
def _(spark, sf):
    return T.workflow_documents(workflow_docs(spark, sf))[1]


@run("R8_log_index", f"WITH {NODES} SELECT workflow_name, workflow_namespace, pod_name AS node_id, CASE WHEN t = 'Pod' THEN concat_ws('/', 's3://logs', workflow_namespace, workflow_name, pod_name, 'main.log') END AS archive_log_uri, code AS exit_code FROM nd WHERE t <> 'Retry'")
def _(spark, sf):
    return T.log_index(T.workflow_documents(workflow_docs(spark, sf))[1], "s3://logs/")


def as_frames(spark, sf):
    return frame(spark, sf, "fx_pose").select("episode_id", "frame_idx", *T.POSE)


POSE_SQL = ", ".join(f"round({c}, 6) AS {c}" for c in T.POSE)


@run("R9_bridge_frames", f"SELECT episode_id, frame_idx, {POSE_SQL}, round(x * 2, 6) AS grasp FROM fx_pose")
def _(spark, sf):
    p = as_frames(spark, sf)
    return T.bridge_frames(p.select("episode_id", "frame_idx", F.struct(F.struct(*T.POSE).alias("end_effector_pose")).alias("state"), F.struct((F.col("x") * 2).alias("grasp")).alias("action")))


@run("R10_droid_frames", f"SELECT episode_id, frame_idx, {POSE_SQL}, 'tcp_pose' AS pose_source FROM fx_pose")
def _(spark, sf):
    p = as_frames(spark, sf)
    return T.droid_frames(p.select("episode_id", "frame_idx", F.array(*T.POSE).alias("tcp_pose"), F.array(F.lit(0.0)).alias("observation.state")))


@run("R11_guessed_frames", f"SELECT episode_id, frame_idx, {POSE_SQL} FROM fx_pose")
def _(spark, sf):
    p = as_frames(spark, sf)
    return T.guessed_frames(p.select("episode_id", "frame_idx", F.array(*T.POSE, F.lit(9.0)).alias("robot_state"), F.array("x", "y").alias("pose_2d"), F.array(*[F.lit(1.0)] * 9).alias("other")))


@run("W2_daily_overwrite", "SELECT CAST(ts AS DATE) AS dt, event_type, count(*) * CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-10' THEN 2 ELSE 1 END AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    path = scratch.folder(spark, "mart")
    d = frame(spark, sf, "events").groupBy(F.to_date("ts").alias("dt"), "event_type").agg(F.count("*").alias("n"))
    T.write_daily(d, path)
    T.write_daily(d.where("dt >= date'2024-01-10'").withColumn("n", F.col("n") * 2), path)
    return spark.read.parquet(path).select("dt", "event_type", "n")


@run("W3_export_manifest", "SELECT unnest(['csv', 'json', 'parquet']) AS format, (SELECT count(*) FROM fx_etl_perf) AS n_rows, TRUE AS same")
def _(spark, sf):
    p, path = frame(spark, sf, "fx_etl_perf").select("job_id", "phase", "input_bytes"), scratch.folder(spark, "export")
    rows = [T.export(p, f"{path}/{k}", k, ("fx_etl_perf",)) for k in ("csv", "json", "parquet")]
    out = rows[0].union(rows[1]).union(rows[2])
    return out.select("format", "n_rows", (F.col("checksum") == F.first("checksum").over(__import__("pyspark").sql.Window.partitionBy())).alias("same"))


@run("W5_records_by_split", f"SELECT CASE WHEN ({SHARE.format('sample_id')} % 10000) / 10000.0 < 0.9 THEN 'train' ELSE 'val' END AS split, count(*) AS n FROM (SELECT CAST(doc_id AS VARCHAR) AS sample_id FROM documents) GROUP BY 1")
def _(spark, sf):
    path = scratch.folder(spark, "records")
    r = I.distill(I.score_batch(samples(frame(spark, sf, "documents")), "caption"), "caption_sft", "t1")
    T.write_records(r.withColumn("split", E.distillation_split("sample_id", {"train": 0.9, "val": 0.1})), path)
    return spark.read.json(path).groupBy("split").agg(F.count("*").alias("n"))


@run("W6_lineage_append", "SELECT job, count(*) AS n FROM (SELECT unnest(['first', 'second']) AS job, uri FROM fx_files) GROUP BY 1")
def _(spark, sf):
    path, f = scratch.folder(spark, "edges"), frame(spark, sf, "fx_files")
    for job in ("first", "second"):
        T.append(T.lineage_edges(f, "raw", job), path)
    return spark.read.parquet(path).groupBy("job").agg(F.count("*").alias("n"))


def event_files(spark, sf, parts: int = 4) -> str:
    """Events as JSON files in time order, each file with a few rows of the one before again."""
    path = scratch.folder(spark, "event-files")
    e = frame(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    e.union(e.where("event_id % 50 = 0")).repartitionByRange(parts, "ts").sortWithinPartitions("ts").write.json(path)
    return path


@run("X1_deduplicated_stream", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def _(spark, sf):
    stream = X.deduplicated(X.event_stream(spark, event_files(spark, sf)), "60 days")
    done = X.drained(stream, scratch.folder(spark, "x1"), scratch.folder(spark, "x1-state"))
    return done.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@run("X2_hourly_batch_twin", "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    return X.hourly(frame(spark, sf, "events")).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


def files_in_time_order(df, path: str, by: str, parts: int = 4) -> str:
    """``df`` as files one after the other, each later in time than those before, as a stream would find them."""
    bounds = df.agg(F.percentile_approx(F.unix_micros(by), [i / parts for i in range(1, parts)])).first()[0] or []
    for low, high in zip([None, *bounds], [*bounds, None]):
        t = F.unix_micros(by)
        df.where((F.lit(True) if low is None else t > low) & (F.lit(True) if high is None else t <= high)).coalesce(1).write.mode("append").json(path)
    return path


#: Hours that end an hour or more before the last event are complete; later ones wait for the watermark.
@run("X2_hourly_stream", """SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS n FROM events
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1, 2""")
def _(spark, sf):
    e = frame(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    path = files_in_time_order(e, scratch.folder(spark, "x2-files"), "ts")
    done = X.drained(X.hourly(X.event_stream(spark, path), "1 hour"), scratch.folder(spark, "x2"), scratch.folder(spark, "x2-state"))
    return done.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


WARN_AFTER, STALE_AFTER = 100_000, 200_000


@run("X3_liveness_stream", f"""WITH l AS (SELECT workflow_name, phase, step_name, updated_at, event_id, (epoch_us((SELECT max(updated_at) FROM fx_heartbeats)) - 3600000000 - epoch_us(updated_at)) / 1e6 AS age
    FROM (SELECT *, row_number() OVER (PARTITION BY workflow_name, phase, step_name ORDER BY updated_at DESC, event_id DESC) AS p FROM fx_heartbeats) WHERE p = 1)
    SELECT workflow_name, phase, step_name, event_id, CASE WHEN age >= {STALE_AFTER} THEN 'stale' WHEN age >= {WARN_AFTER} THEN 'warn' ELSE 'ok' END AS state FROM l""")
def _(spark, sf):
    h = frame(spark, sf, "fx_heartbeats").select(*X.BEAT, F.col("updated_at").cast("timestamp").alias("updated_at"), "event_id")
    path = files_in_time_order(h, scratch.folder(spark, "beats"), "updated_at")
    stream = spark.readStream.schema(h.schema).option("maxFilesPerTrigger", 1).json(path)
    done = X.drained(X.liveness(stream, WARN_AFTER, STALE_AFTER, "1 hour"), scratch.folder(spark, "x3"), scratch.folder(spark, "x3-state"))
    return X.liveness_now(done).select(*X.BEAT, "event_id", "state")


@run("K1_merge_touched_days", "SELECT event_id, CASE WHEN CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-09') AND event_id % 3 = 0 THEN 'changed' ELSE event_type END AS event_type, CAST(ts AS DATE) AS dt FROM events")
def _(spark, sf):
    path, e = scratch.folder(spark, "k1"), frame(spark, sf, "events").select("event_id", "event_type", F.to_date("ts").alias("dt"))
    J.merge_daily(path, e, ["dt", "event_id"])
    J.merge_daily(path, e.where("dt in (date'2024-01-03', date'2024-01-09') and event_id % 3 = 0").withColumn("event_type", F.lit("changed")), ["dt", "event_id"])
    return spark.read.schema(e.schema).parquet(path)


@run("X4_incremental_daily", "SELECT CAST(ts AS DATE) AS dt, event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1, 2")
def _(spark, sf):
    source, path = scratch.folder(spark, "facts"), scratch.folder(spark, "x4")
    frame(spark, sf, "events").select("event_id", "event_type", "user_id", F.to_date("ts").alias("dt")).repartition(3).write.parquet(source)
    facts = spark.readStream.schema("event_id long, event_type string, user_id long, dt date").option("maxFilesPerTrigger", 1).parquet(source)
    states = lambda d: d.groupBy("dt", "event_type").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))
    merged = lambda d: d.groupBy("dt", "event_type").agg(F.sum("n").alias("n"), F.sum("users").alias("users"))
    X.refreshing(facts, states, merged, path).option("checkpointLocation", scratch.folder(spark, "x4-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{path}/daily").select("dt", "event_type", "n", "users")


# ---------------------------------------------------------------- the remaining small operators by name

add("F2_day_with_fallback", ["fx_qc_runs"], lambda q: q.select("run_id", E.day("started_at", "created_at").alias("dt")), "SELECT run_id, CAST(coalesce(started_at, created_at) AS DATE) AS dt FROM fx_qc_runs")
add("F3_status_classes", ["fx_etl_perf"], lambda p: p.groupBy(E.ladder([(E.status_in("status", E.SUCCESS), "success"), (E.status_in("status", E.FAILURE), "failure"), (E.status_in("status", E.UNFINISHED), "unfinished")], "unknown").alias("class")).agg(F.count("*").alias("n")),
    f"SELECT CASE WHEN upper(status) IN ('OK', 'WARN', 'SUCCESS', 'SUCCEEDED') THEN 'success' WHEN upper(status) IN {BAD} THEN 'failure' WHEN upper(status) IN ('RUNNING', 'PENDING', 'STARTED') THEN 'unfinished' ELSE 'unknown' END AS class, count(*) AS n FROM fx_etl_perf GROUP BY 1")
add("F9_alert_ladder", ["fx_workflow_steps", "fx_workflow_runs"], lambda s, r: W.ads_workflow_ops_dashboard(W.dws_workflow_ops_daily(W.fact_workflow_step(s, r))).groupBy("alert_level", "alert_reason").agg(F.count("*").alias("n")), f"""
WITH {FACTS}, o AS (SELECT dt, coalesce(workflow_type, 'unknown') AS t, count(DISTINCT workflow_name) FILTER (phase = 'Succeeded') / count(DISTINCT workflow_name) AS r, count(*) FILTER (container_reason = 'OOMKilled') AS oom, count(*) FILTER (container_reason = 'DeadlineExceeded') AS late FROM steps GROUP BY 1, 2)
SELECT CASE WHEN r < 0.8 OR oom > 0 OR late > 0 THEN 'CRITICAL' WHEN r < 0.95 THEN 'WARN' ELSE 'OK' END AS alert_level, CASE WHEN r < 0.8 THEN 'success_rate<0.8' WHEN oom > 0 THEN 'oom_kill' WHEN late > 0 THEN 'deadline_exceeded' WHEN r < 0.95 THEN 'success_rate<0.95' END AS alert_reason, count(*) AS n FROM o GROUP BY 1, 2""")  # fmt: skip
add("J1_spine_joins", SOURCES, lambda *t: quality_daily(*t).agg(F.count("*").alias("n"), F.count("qc_pass_rate").alias("with_qc"), F.count("etl_success_rate").alias("with_etl"), F.count("workflow_success_rate").alias("with_workflow")),
    f"WITH {FACTS}, {QUALITY_PARTS} SELECT count(*) AS n, count(qc_pass_rate) AS with_qc, count(etl_success_rate) AS with_etl, count(workflow_success_rate) AS with_workflow FROM quality")
add("S3_backfill_candidates", ["fx_etl_perf", "fx_workflow_steps", "fx_workflow_runs"], lambda p, s, r: O.backfill_candidates(W.fact_etl_run(p), W.fact_workflow_step(s, r), W.fact_etl_run(p).withColumn("overall_status", F.lit("PASS")), None, (DAY, date(2024, 1, 20))),
    f"WITH {FACTS} SELECT dt, dataset_id, version, phase FROM etl WHERE upper(status) IN ('FAIL', 'FAILED', 'ERROR', 'WARN') AND dt BETWEEN {SD} AND DATE '2024-01-20' UNION SELECT dt, dataset_id, version, 'workflow' FROM steps WHERE upper(phase) IN ('FAILED', 'ERROR') AND dataset_id IS NOT NULL AND dt BETWEEN {SD} AND DATE '2024-01-20'")
add("S3_backfill_days", ["events"], lambda e: O.backfill_days(e.sparkSession, (DAY, date(2024, 1, 9)), "ds_1", "v1").join(e.groupBy(F.to_date("ts").alias("dt")).agg(F.count("*").alias("n_events")), "dt"),
    f"SELECT CAST(d AS DATE) AS dt, 'ds_1' AS dataset_id, 'v1' AS version, 'normalize' AS phase, count(*) AS n_events FROM (SELECT unnest(generate_series({SD}, DATE '2024-01-09', INTERVAL 1 DAY)) AS d) JOIN events ON CAST(ts AS DATE) = CAST(d AS DATE) GROUP BY ALL")
add("P19_day_summary", [*SOURCES, "fx_profiles", *INFERENCE_VIEWS], lambda *t: day_summary(*t, day=date(2024, 1, 12)), summary_sql("DATE '2024-01-12'"))
add("P19_report_workflows", ["fx_workflow_steps", "fx_workflow_runs"], lambda s, r: W.within(W.dws_workflow_ops_daily(W.fact_workflow_step(s, r)), (DAY, DAY)).select("workflow_type", "workflow_count", "success_count", "failed_count", "success_rate", "p95_duration_sec"),
    f"WITH {FACTS}, {OPS} SELECT workflow_type, workflow_count, success_count, failed_count, round(success_rate, 6) AS success_rate, round(p95_duration_sec, 6) AS p95_duration_sec FROM ops WHERE dt = {SD}")
add("P19_report_log_index", ["fx_workflow_steps", "fx_workflow_runs"], lambda s, r: O.log_index(archived(W.fact_workflow_step(s, r)), DAY),
    f"WITH {FACTS} SELECT DISTINCT 's3://logs/' || pod_name || '.log' AS archive_log_uri FROM steps WHERE dt = {SD} AND exit_code = 1")



def user_scores(d):
    def lengths(batches):
        for b in batches:
            yield b.assign(prediction_type="length", prediction_json="{}", confidence=b.input_text.str.len() / 1000.0)[["sample_id", "prediction_type", "prediction_json", "confidence"]]

    return I.score_with(samples(d).select("sample_id", "input_text"), lengths)


add("U2_user_scoring", ["documents"], user_scores, "SELECT CAST(doc_id AS VARCHAR) AS sample_id, 'length' AS prediction_type, '{}' AS prediction_json, round(length(text) / 1000.0, 6) AS confidence FROM documents")


@run("R4_read_reports", "SELECT dataset_id, CASE WHEN count(*) % 2 = 0 THEN 'PASS' ELSE 'FAIL' END AS status, 1 AS n_rules FROM fx_ev GROUP BY dataset_id")
def _(spark, sf):
    path = scratch.folder(spark, "reports")
    e = frame(spark, sf, "fx_ev").groupBy("dataset_id").agg(F.when(F.count("*") % 2 == 0, "PASS").otherwise("FAIL").alias("status"))
    doc = F.concat(F.lit('{\n "dataset_id": "'), "dataset_id", F.lit('",\n "version": "v1",\n "status": "'), "status", F.lit('",\n "rules": [{"rule_id": "r", "status": "PASS"}]\n}'))
    e.select(doc.alias("value"), "dataset_id").repartition("dataset_id").write.partitionBy("dataset_id").text(path)
    return T.read_reports(spark, f"{path}/*").select("dataset_id", "status", F.size("rules").alias("n_rules"))


@run("W1_declared_schema", "SELECT event_id, CAST(NULL AS VARCHAR) AS note, CAST(user_id AS VARCHAR) AS user_id FROM events")
def _(spark, sf):
    from pyspark.sql import types as S

    declared = S.StructType([S.StructField("event_id", S.LongType()), S.StructField("note", S.StringType()), S.StructField("user_id", S.StringType())])
    path = scratch.folder(spark, "declared")
    T.conformed(frame(spark, sf, "events"), declared).write.parquet(path)
    return spark.read.schema(declared).parquet(path)


@run("W4_layer_manifest", """SELECT event_type, count(*) AS n_rows, TRUE AS has_files, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day,
    '{"users":' || count(DISTINCT user_id) || '}' AS metrics, '{"job_id":"j1","name":"normalize"}' AS job FROM events GROUP BY 1""")
def _(spark, sf):
    path = scratch.folder(spark, "layer")
    frame(spark, sf, "events").withColumn("dt", F.to_date("ts")).write.parquet(path)
    found = T.layer_manifest(spark.read.parquet(path), ["event_type"], "dt", {"users": F.count_distinct("user_id")}, {"job_id": "j1", "name": "normalize"})
    return found.withColumn("has_files", F.col("n_files") > 0).drop("n_files")


@run("S5_multi_file_read", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def _(spark, sf):
    path = scratch.folder(spark, "shards")
    frame(spark, sf, "events").repartition(5).write.parquet(path)  # a user's events span files
    return spark.read.parquet(path).groupBy("user_id").agg(F.count("*").alias("n"))


QUERIES, ORACLES = family.QUERIES, family.ORACLES
