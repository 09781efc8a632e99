"""Warehouse queries: facts, daily aggregates, dashboards."""

from __future__ import annotations

from datetime import date

from ..plans import warehouse as W
from ..sources import documents as D
from ..sources import scratch
from .base import Family

family = Family()
add = family.add

KEY = "md5(concat_ws('|', {}))"


def md5_of(*parts: str) -> str:
    return KEY.format(", ".join(f"coalesce({p}, '')" for p in parts))


# ---------------------------------------------------------------- oracle texts of the facts

ETL = f"""SELECT {md5_of("job_id", "run_id", "phase", "dataset_id", "version")} AS run_key, job_id, run_id, dataset_id, version, CAST(NULL AS VARCHAR) AS dataset_family, phase, status,
    created_at AS started_at, created_at + to_microseconds(CAST(round(coalesce(duration_sec, 0) * 1000000) AS BIGINT)) AS finished_at, CAST(created_at AS DATE) AS dt, duration_sec, input_bytes, output_bytes,
    metrics_json ->> '$.archive_log_uri' AS archive_log_uri FROM fx_etl_perf"""
RULE_ROWS = f"""SELECT {md5_of("run_id", "severity", "rule_id", "metric")} AS rule_result_key, * FROM (
    SELECT run_id, contract_id, dataset_id, version, dataset_family, dt, r ->> '$.rule_id' AS rule_id, r ->> '$.severity' AS severity, s AS status, r ->> '$.metric' AS metric, r ->> '$.op' AS op,
           r ->> '$.threshold' AS threshold_value, r ->> '$.actual' AS actual_value
    FROM (SELECT q.*, CAST(coalesce(started_at, created_at) AS DATE) AS dt FROM fx_qc_runs q) runs, LATERAL (
        SELECT unnest(CAST(metrics_json -> '$._rule_results' AS JSON[])) AS r, NULL AS w
        UNION ALL SELECT unnest(CAST(CASE WHEN failed_rules_json LIKE '[%' THEN CAST(failed_rules_json AS JSON) ELSE failed_rules_json -> '$.items' END AS JSON[])), 'FAIL' WHERE metrics_json IS NULL
        UNION ALL SELECT unnest(CAST(warning_rules_json AS JSON[])), 'WARN' WHERE metrics_json IS NULL) rules, LATERAL (SELECT coalesce(w, upper(coalesce(r ->> '$.status', 'PASS'))) AS s)
    UNION ALL SELECT run_id, contract_id, dataset_id, version, dataset_family, CAST(coalesce(started_at, created_at) AS DATE), 'contract_status', 'summary', status, NULL, NULL, NULL, NULL FROM fx_qc_runs)"""
STEPS = f"""SELECT {md5_of("s.workflow_namespace", "s.workflow_name", "step_name", "pod_name")} AS step_key, s.workflow_name, s.workflow_namespace, workflow_type, step_name, pod_name, phase, dataset_id, version,
    dataset_family, s.started_at, CAST(s.started_at AS DATE) AS dt, duration_sec, exit_code, container_reason
    FROM fx_workflow_steps s LEFT JOIN fx_workflow_runs r ON r.workflow_namespace IS NOT DISTINCT FROM s.workflow_namespace AND r.workflow_name = s.workflow_name"""
PROFILES = "SELECT md5(profile_id) AS asset_profile_key, profile_id, dataset_id, version, layer, bytes, rows_count, CAST(created_at AS DATE) AS dt FROM fx_profiles"
LATER = "SELECT {c} FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, version ORDER BY created_at DESC, {i} DESC) AS p FROM {t}) WHERE p = 1"

FACTS = f"etl AS ({ETL}), rules AS ({RULE_ROWS}), steps AS ({STEPS}), profiles AS ({PROFILES})"
BAD = "('FAIL', 'FAILED', 'ERROR')"
QUALITY_PARTS = f"""
e AS (SELECT dt, dataset_id, version, min(dataset_family) AS fe, count(*) AS etl_run_count, count(*) FILTER (upper(coalesce(status, '')) IN ('OK', 'WARN', 'SUCCESS', 'SUCCEEDED')) AS etl_success_count,
    count(*) FILTER (upper(coalesce(status, '')) IN {BAD}) AS etl_fail_count, CAST(sum(coalesce(input_bytes, 0)) AS BIGINT) AS total_input_bytes, CAST(sum(coalesce(output_bytes, 0)) AS BIGINT) AS total_output_bytes,
    quantile_cont(duration_sec, 0.95) AS p95_etl_duration_sec FROM etl WHERE upper(coalesce(status, '')) NOT IN ('RUNNING', 'PENDING', 'STARTED') GROUP BY 1, 2, 3),
q AS (SELECT dt, dataset_id, version, min(dataset_family) AS fq, count(*) AS qc_run_count, count(*) FILTER (status = 'PASS') AS qc_pass_count, count(*) FILTER (status = 'WARN') AS qc_warn_count,
    count(*) FILTER (status IN {BAD}) AS qc_fail_count FROM rules WHERE rule_id = 'contract_status' GROUP BY 1, 2, 3),
w AS (SELECT dt, dataset_id, version, min(dataset_family) AS fw, count(DISTINCT workflow_name) AS workflow_count, count(DISTINCT workflow_name) FILTER (upper(phase) = 'SUCCEEDED') AS workflow_success_count,
    count(DISTINCT workflow_name) FILTER (upper(phase) IN ('FAILED', 'ERROR')) AS workflow_fail_count, quantile_cont(duration_sec, 0.95) AS p95_workflow_step_duration_sec
    FROM steps WHERE dataset_id IS NOT NULL AND version IS NOT NULL GROUP BY 1, 2, 3),
m AS (SELECT CAST(created_at AS DATE) AS dt, dataset_id, version, max(coalesce(num_train, 0) + coalesce(num_val, 0) + coalesce(num_test, 0)) AS ml_ready_rows FROM fx_ml_ready GROUP BY 1, 2, 3),
s AS (SELECT CAST(created_at AS DATE) AS dt, dataset_id, version, avg(quality_score) AS avg_quality_score FROM fx_snapshots GROUP BY 1, 2, 3),
k AS (SELECT dt, dataset_id, version FROM e UNION SELECT dt, dataset_id, version FROM q UNION SELECT dt, dataset_id, version FROM w UNION SELECT dt, dataset_id, version FROM m),
quality AS (SELECT k.dt, k.dataset_id, k.version, coalesce(fe, fq, fw) AS dataset_family, coalesce(qc_run_count, 0) AS qc_run_count, coalesce(qc_pass_count, 0) AS qc_pass_count, coalesce(qc_warn_count, 0) AS qc_warn_count,
    coalesce(qc_fail_count, 0) AS qc_fail_count, coalesce(etl_run_count, 0) AS etl_run_count, coalesce(etl_success_count, 0) AS etl_success_count, coalesce(etl_fail_count, 0) AS etl_fail_count,
    coalesce(workflow_count, 0) AS workflow_count, coalesce(workflow_success_count, 0) AS workflow_success_count, coalesce(workflow_fail_count, 0) AS workflow_fail_count,
    qc_pass_count / qc_run_count AS qc_pass_rate, etl_success_count / etl_run_count AS etl_success_rate, workflow_success_count / workflow_count AS workflow_success_rate, avg_quality_score,
    coalesce(ml_ready_rows, 0) AS ml_ready_rows, coalesce(total_input_bytes, 0) AS total_input_bytes, coalesce(total_output_bytes, 0) AS total_output_bytes, p95_etl_duration_sec, p95_workflow_step_duration_sec
    FROM k LEFT JOIN e USING (dt, dataset_id, version) LEFT JOIN q USING (dt, dataset_id, version) LEFT JOIN w USING (dt, dataset_id, version) LEFT JOIN m USING (dt, dataset_id, version) LEFT JOIN s USING (dt, dataset_id, version))"""
RULE_DAILY = """rule_daily AS (SELECT dt, coalesce(dataset_family, 'unknown') AS dataset_family, coalesce(contract_id, 'unknown') AS contract_id, rule_id, coalesce(severity, 'unknown') AS severity, count(*) AS run_count,
    count(*) FILTER (status = 'PASS') AS pass_count, count(*) FILTER (status = 'WARN') AS warn_count, count(*) FILTER (status = 'FAIL') AS fail_count, round(count(*) FILTER (status = 'FAIL') / count(*), 6) AS fail_rate
    FROM rules WHERE rule_id <> 'contract_status' GROUP BY 1, 2, 3, 4, 5)"""
OPS = """ops AS (SELECT dt, coalesce(workflow_type, 'unknown') AS workflow_type, count(DISTINCT workflow_name) AS workflow_count, count(DISTINCT workflow_name) FILTER (upper(phase) = 'SUCCEEDED') AS success_count,
    count(DISTINCT workflow_name) FILTER (upper(phase) IN ('FAILED', 'ERROR')) AS failed_count, count(DISTINCT workflow_name) FILTER (upper(phase) IN ('RUNNING', 'PENDING')) AS running_count,
    avg(duration_sec) AS avg_duration_sec, quantile_cont(duration_sec, 0.95) AS p95_duration_sec, count(*) FILTER (container_reason = 'DeadlineExceeded') AS deadline_exceeded_count,
    count(*) FILTER (container_reason = 'OOMKilled') AS oom_count, count(*) FILTER (coalesce(exit_code, 0) <> 0) AS nonzero_exit_count,
    count(DISTINCT workflow_name) FILTER (upper(phase) = 'SUCCEEDED') / count(DISTINCT workflow_name) AS success_rate FROM steps GROUP BY 1, 2)"""
INFERENCE = """jd AS (SELECT CAST(created_at AS DATE) AS dt, job_id, model_id, coalesce(task_type, 'unknown') AS task_type, status, total_samples, processed_samples, failed_samples, duration_sec FROM fx_jobs),
lat AS (SELECT dt, model_id, task_type, avg(latency_ms) AS avg_latency_ms, quantile_cont(latency_ms, 0.95) AS p95_latency_ms FROM fx_outputs JOIN jd USING (job_id) WHERE latency_ms IS NOT NULL GROUP BY 1, 2, 3),
ja AS (SELECT dt, model_id, task_type, count(*) AS job_count, count(*) FILTER (status IN ('SUCCEEDED', 'OK')) AS success_count, count(*) FILTER (status IN ('FAILED', 'DEAD_LETTER')) AS fail_count,
    CAST(sum(total_samples) AS BIGINT) AS total_samples, sum(processed_samples) AS processed, sum(failed_samples) AS failed, sum(duration_sec) AS seconds FROM jd GROUP BY 1, 2, 3),
inf AS (SELECT dt, model_id, task_type, backend, job_count, success_count, fail_count, success_count / job_count AS success_rate, total_samples, CASE WHEN seconds > 0 THEN processed / seconds END AS samples_per_sec,
    avg_latency_ms, p95_latency_ms, CASE WHEN total_samples > 0 THEN failed / total_samples ELSE 0.0 END AS error_rate FROM ja LEFT JOIN fx_models USING (model_id) LEFT JOIN lat USING (dt, model_id, task_type))"""


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


RATES = ("qc_pass_rate", "etl_success_rate", "workflow_success_rate")


def replaced(table: str, *names: str) -> str:
    return f"SELECT * REPLACE ({r6(*names)}) FROM {table}"


# ---------------------------------------------------------------- registrations

add("P4_dim_dataset", ["fx_versions", "fx_snapshots", "fx_ml_ready"], W.dim_dataset, f"""
WITH s AS ({LATER.format(c="dataset_id, version, quality_status, quality_score, metrics_json ->> '$.dataset_family' AS dataset_family", i="snapshot_id", t="fx_snapshots")}),
m AS ({LATER.format(c="dataset_id, version, output_uri", i="ml_id", t="fx_ml_ready")})
SELECT 'dataset:' || dataset_id || ':' || version AS dataset_key, dataset_id, version, dataset_family, raw_uri AS source_uri, raw_uri, ods_uri, dwd_uri, output_uri AS ml_ready_uri, created_at AS first_seen_at,
       coalesce(quality_status, status) AS latest_status, round(quality_score, 6) AS latest_quality_score, TRUE AS is_active
FROM fx_versions LEFT JOIN s USING (dataset_id, version) LEFT JOIN m USING (dataset_id, version)""")  # fmt: skip
add("P5_fact_etl_run", ["fx_etl_perf"], W.fact_etl_run, f"SELECT * REPLACE (round(duration_sec, 6) AS duration_sec) FROM ({ETL})")
add("F1_fact_etl_run_window", ["fx_etl_perf"], lambda p: W.fact_etl_run(p, (date(2024, 1, 3), date(2024, 1, 9))),
    f"SELECT * REPLACE (round(duration_sec, 6) AS duration_sec) FROM ({ETL}) WHERE CAST(started_at AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'")
add("P6_fact_qc_rule_result", ["fx_qc_runs"], W.fact_qc_rule_result, RULE_ROWS)
add("P6_rules_from_variant", ["fx_qc_runs"], lambda q: D.rule_rows(scratch.written(D.shredded(q, D.QC_DOCUMENTS), "qc-documents")),
    f"SELECT run_id, rule_id, severity, status, metric, op, threshold_value AS threshold, actual_value AS actual FROM ({RULE_ROWS}) WHERE rule_id IS NOT NULL AND rule_id <> 'contract_status'")
add("P6_document_shapes", ["fx_qc_runs"], lambda q: D.shredded(q, D.QC_DOCUMENTS).groupBy("metrics_json_shape", "failed_rules_json_shape", "warning_rules_json_shape").count().withColumnRenamed("count", "n"),
    """SELECT CASE WHEN metrics_json IS NULL THEN 'missing' ELSE 'object' END AS metrics_json_shape, CASE WHEN failed_rules_json IS NULL THEN 'missing' WHEN failed_rules_json LIKE '[%' THEN 'array' ELSE 'object' END AS failed_rules_json_shape,
    CASE WHEN warning_rules_json IS NULL THEN 'missing' ELSE 'array' END AS warning_rules_json_shape, count(*) AS n FROM fx_qc_runs GROUP BY 1, 2, 3""")  # fmt: skip
add("P7_fact_workflow_step", ["fx_workflow_steps", "fx_workflow_runs"], W.fact_workflow_step, f"SELECT * REPLACE (round(duration_sec, 6) AS duration_sec) FROM ({STEPS})")
add("P8_fact_asset_profile", ["fx_profiles"], W.fact_asset_profile, PROFILES)

SOURCES = ["fx_etl_perf", "fx_qc_runs", "fx_workflow_steps", "fx_workflow_runs", "fx_ml_ready", "fx_snapshots"]


def quality_daily(perf, qc, steps, runs, ml, snaps):
    return W.dws_dataset_quality_daily(W.fact_etl_run(perf), W.fact_qc_rule_result(qc), W.fact_workflow_step(steps, runs), ml, snaps)


add("P9_dws_dataset_quality_daily", SOURCES, quality_daily, f"WITH {FACTS}, {QUALITY_PARTS} {replaced('quality', *RATES, 'avg_quality_score', 'p95_etl_duration_sec', 'p95_workflow_step_duration_sec')}")
add("A11_dws_rule_failure_daily", ["fx_qc_runs"], lambda q: W.dws_rule_failure_daily(W.fact_qc_rule_result(q)), f"WITH {FACTS}, {RULE_DAILY} SELECT * FROM rule_daily")
add("A12_dws_workflow_ops_daily", ["fx_workflow_steps", "fx_workflow_runs"], lambda s, r: W.dws_workflow_ops_daily(W.fact_workflow_step(s, r)),
    f"WITH {FACTS}, {OPS} {replaced('ops', 'avg_duration_sec', 'p95_duration_sec', 'success_rate')}")
add("A13_dws_inference_job_daily", ["fx_jobs", "fx_outputs", "fx_models"], W.dws_inference_job_daily,
    f"WITH {INFERENCE} {replaced('inf', 'success_rate', 'samples_per_sec', 'avg_latency_ms', 'p95_latency_ms', 'error_rate')}")


def dashboard(perf, qc, steps, runs, ml, snaps, profiles):
    rules = W.fact_qc_rule_result(qc)
    dws = W.dws_dataset_quality_daily(W.fact_etl_run(perf), rules, W.fact_workflow_step(steps, runs), ml, snaps)
    return W.ads_quality_dashboard(dws, W.dws_rule_failure_daily(rules), W.fact_asset_profile(profiles))


ONE = "coalesce({}, 1.0)"
DASHBOARD = f"""
WITH {FACTS}, {QUALITY_PARTS}, {RULE_DAILY},
tr AS (SELECT dt, dataset_family AS family, rule_id, n FROM (SELECT *, row_number() OVER (PARTITION BY dt, dataset_family ORDER BY n DESC, rule_id) AS p
    FROM (SELECT dt, dataset_family, rule_id, CAST(sum(fail_count) AS BIGINT) AS n FROM rule_daily WHERE fail_count > 0 GROUP BY ALL)) WHERE p = 1),
b AS (SELECT dt, dataset_id, version, CAST(sum(coalesce(bytes, 0)) FILTER (layer IN ('raw', 'ods')) AS BIGINT) AS raw_bytes, CAST(sum(coalesce(bytes, 0)) FILTER (layer = 'dwd') AS BIGINT) AS dwd_bytes FROM profiles GROUP BY 1, 2, 3)
SELECT dt, d.dataset_id, d.version, d.dataset_family, CASE WHEN coalesce(qc_pass_rate, 1) < 0.8 OR coalesce(etl_success_rate, 1) < 0.8 THEN 'FAIL' WHEN coalesce(qc_pass_rate, 1) < 0.95 THEN 'WARN' ELSE 'PASS' END AS overall_status,
    round(50 * coalesce(qc_pass_rate, 1) + 30 * coalesce(etl_success_rate, 1) + 20 * coalesce(workflow_success_rate, 1), 6) AS quality_score, {r6(*RATES)}, tr.rule_id AS top_failed_rule, tr.n AS top_failed_rule_count,
    round(p95_workflow_step_duration_sec, 6) AS p95_duration_sec, ml_ready_rows, raw_bytes, dwd_bytes,
    CASE WHEN coalesce(qc_pass_rate, 1) < 0.8 OR coalesce(etl_success_rate, 1) < 0.8 THEN 'CRITICAL' WHEN coalesce(qc_pass_rate, 1) < 0.95 THEN 'WARN' ELSE 'OK' END AS alert_level,
    CASE WHEN coalesce(qc_pass_rate, 1) < 0.8 THEN 'qc_pass_rate<0.8' WHEN coalesce(etl_success_rate, 1) < 0.8 THEN 'etl_success_rate<0.8' WHEN coalesce(qc_pass_rate, 1) < 0.95 THEN 'qc_pass_rate<0.95' END AS alert_reason
FROM quality d LEFT JOIN tr ON tr.dt = d.dt AND tr.family = coalesce(d.dataset_family, 'unknown') LEFT JOIN b ON b.dt = d.dt AND b.dataset_id = d.dataset_id AND b.version = d.version""".replace("SELECT dt, d.dataset_id", "SELECT d.dt, d.dataset_id")
add("P10_ads_quality_dashboard", [*SOURCES, "fx_profiles"], dashboard, DASHBOARD)


def strict(perf, qc, steps, runs, ml, snaps):
    return W.ads_quality_dashboard_strict(quality_daily(perf, qc, steps, runs, ml, snaps), W.fact_qc_rule_result(qc))


add("P10_ads_quality_dashboard_strict", SOURCES, strict, f"""
WITH {FACTS}, {QUALITY_PARTS},
tr AS (SELECT dt, dataset_id, version, rule_id, n FROM (SELECT *, row_number() OVER (PARTITION BY dt, dataset_id, version ORDER BY n DESC, rule_id) AS p FROM
    (SELECT dt, dataset_id, version, rule_id, count(*) AS n FROM rules WHERE status IN {BAD} AND rule_id <> 'contract_status' GROUP BY ALL)) WHERE p = 1),
d AS (SELECT *, qc_fail_count + etl_fail_count + workflow_fail_count AS fails FROM quality LEFT JOIN tr USING (dt, dataset_id, version))
SELECT dt, dataset_id, version, dataset_family, CASE WHEN fails > 0 THEN 'FAIL' WHEN qc_warn_count > 0 THEN 'WARN' ELSE 'PASS' END AS overall_status,
    round(60 * coalesce(qc_pass_rate, 0) + 30 * coalesce(etl_success_rate, 0) + 10 * coalesce(workflow_success_rate, 0), 2) AS quality_score, rule_id AS top_failed_rule, n AS top_failed_rule_count,
    CASE WHEN fails > 0 THEN 'CRITICAL' WHEN qc_warn_count > 0 OR coalesce(qc_pass_rate, 1) < 0.95 THEN 'WARNING' ELSE 'OK' END AS alert_level,
    concat_ws(' ', CASE WHEN qc_fail_count > 0 THEN 'qc_fail=' || qc_fail_count END, CASE WHEN etl_fail_count > 0 THEN 'etl_fail=' || etl_fail_count END,
        CASE WHEN workflow_fail_count > 0 THEN 'wf_fail=' || workflow_fail_count END, 'top_rule=' || rule_id) AS alert_reason FROM d""")  # fmt: skip
add("P11_ads_workflow_ops_dashboard", ["fx_workflow_steps", "fx_workflow_runs"], lambda s, r: W.ads_workflow_ops_dashboard(W.dws_workflow_ops_daily(W.fact_workflow_step(s, r))), f"""
WITH {FACTS}, {OPS} SELECT dt, workflow_type, workflow_count, success_count, failed_count, {r6("success_rate", "avg_duration_sec", "p95_duration_sec")}, oom_count, deadline_exceeded_count,
    CASE WHEN success_rate < 0.8 OR oom_count > 0 OR deadline_exceeded_count > 0 THEN 'CRITICAL' WHEN success_rate < 0.95 THEN 'WARN' ELSE 'OK' END AS alert_level,
    CASE WHEN success_rate < 0.8 THEN 'success_rate<0.8' WHEN oom_count > 0 THEN 'oom_kill' WHEN deadline_exceeded_count > 0 THEN 'deadline_exceeded' WHEN success_rate < 0.95 THEN 'success_rate<0.95' END AS alert_reason FROM ops""")  # fmt: skip


def inference_dashboard(jobs, outputs, models):
    from ..functions import exprs as E

    failures = outputs.where("status = 'FAILED'").select("job_id", E.error_type("error_message").alias("error_type"))
    return W.ads_inference_dashboard(W.dws_inference_job_daily(jobs, outputs, models), failures, jobs)


#: The three messages of the test tables and the types that they are of.
ERROR_CASE = "CASE WHEN error_message LIKE 'OPENAI_TIMEOUT:%' THEN 'OPENAI_TIMEOUT' WHEN error_message = 'ValueError' THEN 'ValueError' WHEN error_message IS NULL THEN 'UNKNOWN' ELSE 'PREDICTION_ERROR' END"
add("P12_ads_inference_dashboard", ["fx_jobs", "fx_outputs", "fx_models"], inference_dashboard, f"""
WITH {INFERENCE},
te AS (SELECT dt, model_id, task_type, et FROM (SELECT *, row_number() OVER (PARTITION BY dt, model_id, task_type ORDER BY n DESC, et) AS p FROM
    (SELECT dt, model_id, task_type, {ERROR_CASE} AS et, count(*) AS n FROM fx_outputs o JOIN jd USING (job_id) WHERE o.status = 'FAILED' GROUP BY ALL)) WHERE p = 1)
SELECT dt, model_id, task_type, backend, CASE WHEN success_rate < 0.8 OR error_rate > 0.2 THEN 'FAIL' WHEN success_rate < 0.95 THEN 'WARN' ELSE 'PASS' END AS overall_status, job_count,
    {r6("success_rate")}, total_samples, {r6("samples_per_sec", "p95_latency_ms", "error_rate")}, et AS top_error_type,
    CASE WHEN success_rate < 0.8 OR error_rate > 0.2 THEN 'CRITICAL' WHEN success_rate < 0.95 THEN 'WARN' ELSE 'OK' END AS alert_level,
    CASE WHEN success_rate < 0.8 THEN 'success_rate<0.8' WHEN error_rate > 0.2 THEN 'error_rate>0.2' WHEN success_rate < 0.95 THEN 'success_rate<0.95' END AS alert_reason
FROM inf LEFT JOIN te USING (dt, model_id, task_type)""")  # fmt: skip

QUERIES, ORACLES = family.QUERIES, family.ORACLES
