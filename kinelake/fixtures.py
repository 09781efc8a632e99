"""Domain-shaped tables derived from the general test tables by SQL that Spark and DuckDB both run.

``frame`` gives a table as a DataFrame; ``cte`` gives the same tables as a WITH clause for an oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels", "conversations")

VIEWS: dict[str, str] = {
    "fx_ev": """SELECT event_id, ts, user_id, event_type, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
        concat('ds_', CAST(user_id % 7 AS VARCHAR(9))) AS dataset_id, concat('v', CAST(1 + user_id % 2 AS VARCHAR(9))) AS version FROM events""",
    "fx_etl_perf": """SELECT concat('job-', CAST(event_id AS VARCHAR(20))) AS job_id, concat('run-', CAST(event_id % 97 AS VARCHAR(20))) AS run_id, dataset_id, version,
        CASE event_type WHEN 'signup' THEN 'normalize' WHEN 'view' THEN 'build_features' ELSE 'build_ads' END AS phase,
        CASE WHEN k % 10 = 0 THEN 'FAIL' WHEN k % 10 = 1 THEN 'RUNNING' WHEN k % 10 < 4 THEN 'WARN' WHEN k % 10 = 9 THEN NULL ELSE 'ok' END AS status,
        value AS duration_sec, CAST(k AS BIGINT) * 1000 AS input_bytes, CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k AS BIGINT) * 700 END AS output_bytes,
        CASE WHEN k % 5 = 0 THEN NULL ELSE concat('{"archive_log_uri":"s3://logs/', CAST(event_id AS VARCHAR(20)), '.log"}') END AS metrics_json, ts AS created_at
        FROM fx_ev WHERE event_type IN ('signup', 'view', 'purchase')""",
    "fx_workflow_steps": """SELECT concat('wf-', CAST(user_id % 40 AS VARCHAR(9))) AS workflow_name, CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'ns' END AS workflow_namespace,
        concat('step-', CAST(k % 4 AS VARCHAR(9))) AS step_name, concat('pod-', CAST(event_id AS VARCHAR(20))) AS pod_name,
        CASE WHEN k % 8 = 0 THEN 'Failed' WHEN k % 8 = 1 THEN 'Error' WHEN k % 8 = 2 THEN 'Running' ELSE 'Succeeded' END AS phase,
        CASE WHEN k % 11 = 0 THEN NULL ELSE dataset_id END AS dataset_id, version,
        CASE WHEN user_id % 5 = 0 THEN NULL ELSE concat('fam_', CAST(user_id % 7 % 3 AS VARCHAR(9))) END AS dataset_family,
        ts AS started_at, value AS duration_sec, CASE WHEN k % 8 < 2 THEN 1 ELSE 0 END AS exit_code,
        CASE WHEN k % 16 = 0 THEN 'OOMKilled' WHEN k % 16 = 1 THEN 'DeadlineExceeded' ELSE NULL END AS container_reason
        FROM fx_ev WHERE event_type = 'click'""",
    "fx_workflow_runs": """SELECT workflow_name, workflow_namespace, CASE WHEN count(*) % 3 = 0 THEN NULL ELSE concat('type_', CAST(count(*) % 3 AS VARCHAR(9))) END AS workflow_type,
        min(started_at) AS started_at FROM fx_workflow_steps GROUP BY workflow_name, workflow_namespace""",
    "fx_qc_runs": """SELECT concat('qc-', CAST(event_id AS VARCHAR(20))) AS run_id, concat('contract_', CAST(user_id % 7 % 3 AS VARCHAR(9))) AS contract_id,
        dataset_id, version, concat('fam_', CAST(user_id % 7 % 3 AS VARCHAR(9))) AS dataset_family,
        CASE WHEN k % 5 = 0 THEN 'FAIL' WHEN k % 5 = 1 THEN 'WARN' ELSE 'PASS' END AS status, CASE WHEN k % 6 = 0 THEN NULL ELSE ts END AS started_at, ts AS created_at,
        CASE WHEN k % 3 = 0 THEN NULL ELSE concat('{"_rule_results":[{"rule_id":"r', CAST(k % 4 AS VARCHAR(9)), '","severity":"fail","status":"',
            CASE WHEN k % 5 = 0 THEN 'fail' ELSE 'pass' END, '","metric":"m","op":">=","threshold":0.95,"actual":', CAST(k AS VARCHAR(9)), '}]}') END AS metrics_json,
        CASE WHEN k % 5 <> 0 THEN NULL WHEN k % 2 = 0 THEN '[{"rule_id":"r9","severity":"fail","metric":"m"}]' ELSE '{"items":[{"rule_id":"r8","severity":"fail","metric":"m"}]}' END AS failed_rules_json,
        CASE WHEN k % 5 = 1 THEN '[{"rule_id":"r7","severity":"warn","metric":"m"}]' ELSE NULL END AS warning_rules_json
        FROM fx_ev WHERE event_type = 'error'""",
    "fx_versions": """SELECT dataset_id, version, concat('raw/', dataset_id) AS raw_uri, concat('ods/', dataset_id) AS ods_uri,
        CASE WHEN version = 'v1' THEN NULL ELSE concat('dwd/', dataset_id) END AS dwd_uri, 'ACTIVE' AS status, min(ts) AS created_at FROM fx_ev GROUP BY dataset_id, version""",
    "fx_snapshots": """SELECT event_id AS snapshot_id, dataset_id, version, CASE WHEN k % 4 = 0 THEN 'WARN' WHEN k % 7 = 0 THEN NULL ELSE 'PASS' END AS quality_status, value AS quality_score,
        concat('{"dataset_family":"fam_', CAST(user_id % 7 % 3 AS VARCHAR(9)), '"}') AS metrics_json, ts AS created_at FROM fx_ev WHERE event_type = 'signup'""",
    "fx_ml_ready": """SELECT event_id AS ml_id, dataset_id, version, concat('ml/', CAST(event_id AS VARCHAR(20))) AS output_uri, CAST(k AS BIGINT) AS num_train,
        CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k AS BIGINT) % 10 END AS num_val, CAST(k AS BIGINT) % 5 AS num_test, ts AS created_at FROM fx_ev WHERE event_type = 'purchase' AND k % 2 = 0""",
    "fx_profiles": """SELECT concat('prof-', CAST(event_id AS VARCHAR(20))) AS profile_id, dataset_id, version,
        CASE WHEN k % 4 = 0 THEN 'raw' WHEN k % 4 = 1 THEN 'ods' WHEN k % 4 = 2 THEN 'dwd' ELSE 'ads' END AS layer,
        CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(k AS BIGINT) * 10 END AS bytes, CAST(k AS BIGINT) AS rows_count, ts AS created_at FROM fx_ev WHERE event_type = 'view'""",
    "fx_pose": """SELECT concat('ep_', CAST(user_id AS VARCHAR(9))) AS episode_id, dataset_id, version,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame_idx,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS DOUBLE) / CAST(30 AS DOUBLE) AS timestamp_sec,
        value / CAST(1000 AS DOUBLE) AS x, k / CAST(1000 AS DOUBLE) AS y, CAST(0.2 AS DOUBLE) + cos(k / CAST(5 AS DOUBLE)) / CAST(20 AS DOUBLE) AS z,
        sin(k / CAST(20 AS DOUBLE)) AS qx, CAST(0 AS DOUBLE) AS qy, CAST(0 AS DOUBLE) AS qz, CASE WHEN k % 9 = 0 THEN -1 ELSE 1 END * cos(k / CAST(20 AS DOUBLE)) AS qw FROM fx_ev""",
    "fx_files": """SELECT concat('raw/doc_', CAST(doc_id AS VARCHAR(20)), CASE WHEN doc_id % 5 = 0 THEN '.mp4' WHEN doc_id % 5 = 1 THEN '.hdf5' ELSE '.parquet' END) AS uri,
        source AS dataset_id, 'v1' AS version, n_chars AS size_bytes, lang FROM documents""",
    "fx_probes": """SELECT concat('raw/doc_', CAST(doc_id AS VARCHAR(20))) AS uri, source AS dataset_id, concat('v', CAST(1 + doc_id % 2 AS VARCHAR(9))) AS version,
        CASE WHEN doc_id % 5 = 0 THEN 'video' WHEN doc_id % 5 = 1 THEN 'hdf5' ELSE 'parquet' END AS kind, n_chars AS size_bytes, doc_id % 9 > 0 AS readable, n_chars % 1000 AS row_count,
        CASE WHEN doc_id % 5 = 1 THEN doc_id % 4 ELSE 0 END AS demo_count, CASE WHEN doc_id % 4 = 0 THEN NULL ELSE CAST(doc_id % 10 AS DOUBLE) / CAST(100 AS DOUBLE) END AS null_rate,
        concat('h', CAST(n_chars % 3 AS VARCHAR(9))) AS schema_hash,
        CASE WHEN doc_id % 3 = 0 THEN 'observation.image,timestamp' WHEN doc_id % 3 = 1 THEN 'state,language_instruction' ELSE 'delta_action,task,cam_high' END AS column_list,
        CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat(CAST(doc_id % 50 AS VARCHAR(9)), ',', CAST(n_chars % 70 AS VARCHAR(9))) END AS length_list,
        CASE WHEN doc_id % 7 = 0 THEN CAST(doc_id % 3 AS DOUBLE) / CAST(4 AS DOUBLE) ELSE NULL END AS language_missing_rate,
        doc_id % 2 = 0 AS has_actions, doc_id % 4 < 3 AS has_obs, doc_id % 4 < 2 AS has_next_obs, doc_id % 6 < 4 AS has_rewards, doc_id % 6 < 3 AS has_dones FROM documents""",
    "fx_jobs": """SELECT o_orderkey AS job_no, concat('job-', CAST(o_orderkey AS VARCHAR(20))) AS job_id, concat('model_', CAST(o_custkey % 5 AS VARCHAR(9))) AS model_id,
        CASE WHEN o_custkey % 4 = 0 THEN NULL WHEN o_custkey % 4 = 1 THEN 'embedding' ELSE 'caption' END AS task_type,
        CASE WHEN o_orderkey % 10 = 0 THEN 'DEAD_LETTER' WHEN o_orderkey % 10 = 1 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
        o_orderdate AS created_at, CAST(o_totalprice AS DOUBLE) / CAST(1000 AS DOUBLE) AS duration_sec, CAST(o_orderkey % 50 AS BIGINT) AS total_samples,
        CAST(o_orderkey % 40 AS BIGINT) AS processed_samples, CAST(o_orderkey % 7 AS BIGINT) AS failed_samples FROM orders""",
    "fx_outputs": """SELECT concat('job-', CAST(l_orderkey AS VARCHAR(20))) AS job_id, concat('s-', CAST(l_orderkey AS VARCHAR(20)), '-', CAST(l_linenumber AS VARCHAR(9))) AS sample_id, l_linenumber AS attempt,
        CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'OK' END AS status, CASE WHEN l_linenumber % 5 = 0 THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) / CAST(100 AS DOUBLE) END AS latency_ms,
        CASE WHEN l_returnflag <> 'R' THEN NULL WHEN l_linenumber % 3 = 0 THEN 'OPENAI_TIMEOUT: slow' WHEN l_linenumber % 3 = 1 THEN 'ValueError' ELSE 'bad thing: x' END AS error_message FROM lineitem""",
    "fx_models": """SELECT DISTINCT model_id, CASE WHEN model_id = 'model_0' THEN 'mock' WHEN model_id = 'model_1' THEN 'http' ELSE 'local' END AS backend FROM fx_jobs WHERE model_id <> 'model_4'""",
    "fx_heartbeats": """SELECT concat('wf-', CAST(user_id % 40 AS VARCHAR(9))) AS workflow_name, concat('phase-', CAST(k % 3 AS VARCHAR(9))) AS phase, concat('step-', CAST(k % 4 AS VARCHAR(9))) AS step_name, event_id, ts AS updated_at FROM fx_ev""",
    "fx_edges": """SELECT event_id AS edge_id, concat('raw/', dataset_id) AS src_uri, concat('ods/', dataset_id, '/', version) AS dst_uri, event_type AS edge_type, ts AS created_at FROM fx_ev WHERE k % 5 = 0
        UNION ALL SELECT event_id, concat('ods/', dataset_id, '/', version), concat('dwd/', dataset_id, '/', version), event_type, ts FROM fx_ev WHERE k % 5 = 1""",
}

WORD = re.compile(r"\b(?:" + "|".join([*VIEWS, *TABLES]) + r")\b")


def needed(name_or_sql: str) -> list[str]:
    """Views that a view or a query uses, each after those that it uses itself."""
    found: list[str] = []
    for name in dict.fromkeys(WORD.findall(VIEWS.get(name_or_sql, name_or_sql))):
        if name in VIEWS:
            found += [x for x in (*needed(name), name) if x not in found]
    return found


def cte(sql: str) -> str:
    """``sql`` (a SELECT, or its own WITH list) preceded by the views that it names."""
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed(sql))
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {views},\n{sql.lstrip()[5:]}" if views else sql
    return f"WITH {views}\n{sql}" if views else sql


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or one of the tables themselves."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = cte(f"SELECT * FROM {name}")
    used = {t for t in WORD.findall(sql) if t in TABLES}
    for t in used:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    # braces of literals must survive the format string
    marks = {f"{{{t}}}": f"@@{t}@@" for t in used}
    for a, b in marks.items():
        sql = sql.replace(a, b)
    sql = sql.replace("{", "{{").replace("}", "}}")
    for a, b in marks.items():
        sql = sql.replace(b, a)
    return spark.sql(sql, **{t: frame(spark, sf_dir, t) for t in used})


def placed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view that takes each row from one row of one table, with that row's ``_place``: file and row number."""
    (table,) = set(WORD.findall(VIEWS[name]))
    rows = frame(spark, sf_dir, table).select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("_place"))
    return spark.sql(re.sub(rf"^SELECT (.*) FROM {table}$", r"SELECT \1, _place FROM {rows}", VIEWS[name], flags=re.DOTALL), rows=rows)
