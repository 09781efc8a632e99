"""Metadata warehouse: a dimension, facts, daily aggregates and dashboards, as functions from DataFrames to DataFrames."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators.joins import latest, null_safe_join, spine

DAY = ["dt", "dataset_id", "version"]


def within(df: DataFrame, window: tuple[date, date] | None, dt: str | Column = "dt") -> DataFrame:
    """Rows of a closed range of days; everything if there is none."""
    return df if window is None else df.where(E.col(dt).between(*map(F.lit, window)))


def identified(df: DataFrame) -> DataFrame:
    return df.where(F.col("dataset_id").isNotNull() & F.col("version").isNotNull())


# ---------------------------------------------------------------- dimension and facts


def dim_dataset(versions: DataFrame, snapshots: DataFrame, ml_ready: DataFrame) -> DataFrame:
    """One row per dataset version, with what its newest snapshot and export say."""
    keys = ["dataset_id", "version"]
    snap = latest(snapshots, keys, ["created_at", "snapshot_id"], ["quality_status", "quality_score", F.get_json_object("metrics_json", "$.dataset_family").alias("dataset_family")])
    export = latest(ml_ready, keys, ["created_at", "ml_id"], [F.col("output_uri").alias("ml_ready_uri")])
    both = versions.join(snap, keys, "left").join(export, keys, "left")
    return both.select(
        F.concat(F.lit("dataset:"), "dataset_id", F.lit(":"), "version").alias("dataset_key"), *keys, "dataset_family", F.col("raw_uri").alias("source_uri"), "raw_uri", "ods_uri", "dwd_uri",
        "ml_ready_uri", F.col("created_at").alias("first_seen_at"), F.coalesce("quality_status", "status").alias("latest_status"), F.col("quality_score").alias("latest_quality_score"), F.lit(True).alias("is_active"),
    )


def fact_etl_run(perf: DataFrame, window: tuple[date, date] | None = None) -> DataFrame:
    """Runs created in the window; each counts for the day on which it started."""
    stated = lambda name: F.try_to_timestamp(F.get_json_object("metrics_json", f"$.{name}")).cast("timestamp_ntz")
    lasted = F.make_dt_interval(secs=F.coalesce("duration_sec", F.lit(0)).cast("decimal(18,6)"))
    rows = identified(within(perf, window, F.to_date("created_at")))
    rows = rows.withColumn("started_at", F.coalesce(stated("started_at"), F.col("created_at"))).withColumn("finished_at", F.coalesce(stated("finished_at"), F.col("created_at") + lasted))
    return rows.select(
        E.key("job_id", "run_id", "phase", "dataset_id", "version").alias("run_key"), "job_id", "run_id", "dataset_id", "version", F.lit(None).cast("string").alias("dataset_family"), "phase", "status",
        "started_at", "finished_at", F.to_date("started_at").alias("dt"), "duration_sec", "input_bytes", "output_bytes", F.get_json_object("metrics_json", "$.archive_log_uri").alias("archive_log_uri"),
    )


RULE = "array<struct<rule_id:string,severity:string,status:string,metric:string,op:string,threshold:string,actual:string>>"


def rule_list(doc: Column) -> Column:
    """Rules of a JSON text that is an array of rules or an object with them under ``items``; empty otherwise."""
    array = F.when(F.ltrim(doc).startswith("["), doc).when(F.ltrim(doc).startswith("{"), F.get_json_object(doc, "$.items"))
    return F.coalesce(F.from_json(array, RULE), F.from_json(F.lit("[]"), RULE))


def fact_qc_rule_result(runs: DataFrame, window: tuple[date, date] | None = None) -> DataFrame:
    """A row per rule of a run: its full list, or else its failed and warning lists; and one summary row per run."""
    runs = within(runs.withColumn("dt", E.day("started_at", "created_at")), window)
    full = rule_list(F.get_json_object("metrics_json", "$._rule_results"))
    own = lambda doc, word: F.transform(rule_list(F.col(doc)), lambda r: r.withField("status", F.lit(word)))
    stated = F.transform(full, lambda r: r.withField("status", F.upper(F.coalesce(r["status"], F.lit("PASS")))))
    legacy = F.concat(own("failed_rules_json", "FAIL"), own("warning_rules_json", "WARN"))
    null = F.lit(None).cast("string")
    summary = F.array(F.struct(F.lit("contract_status").alias("rule_id"), F.lit("summary").alias("severity"), F.col("status").alias("status"), *(null.alias(x) for x in ("metric", "op", "threshold", "actual"))))
    # a run's lists are nested in its row, so "no full list" needs no join
    rules = F.concat(F.when(F.size(full) > 0, stated).otherwise(legacy), summary)
    names = ["run_id", "contract_id", "dataset_id", "version", "dataset_family", "dt"]
    r = runs.select(*names, F.explode(rules).alias("r")).where("r.rule_id is not null")
    return r.select(
        E.key("run_id", "r.severity", "r.rule_id", "r.metric").alias("rule_result_key"), *names, "r.rule_id", "r.severity", "r.status", "r.metric", "r.op",
        F.col("r.threshold").alias("threshold_value"), F.col("r.actual").alias("actual_value"),
    )


def fact_workflow_step(steps: DataFrame, runs: DataFrame, window: tuple[date, date] | None = None) -> DataFrame:
    types = runs.select("workflow_namespace", "workflow_name", "workflow_type")
    both = null_safe_join(within(steps, window, F.to_date("started_at")), types, ["workflow_namespace", "workflow_name"], "left")
    return both.select(
        E.key("workflow_namespace", "workflow_name", "step_name", "pod_name").alias("step_key"), "workflow_name", "workflow_namespace", "workflow_type", "step_name", "pod_name", "phase",
        "dataset_id", "version", "dataset_family", "started_at", F.to_date("started_at").alias("dt"), "duration_sec", "exit_code", "container_reason",
    )


def fact_asset_profile(profiles: DataFrame, window: tuple[date, date] | None = None) -> DataFrame:
    rows = within(profiles.withColumn("dt", F.to_date("created_at")), window)
    return rows.select(F.md5("profile_id").alias("asset_profile_key"), "profile_id", "dataset_id", "version", "layer", "bytes", "rows_count", "dt")


# ---------------------------------------------------------------- daily aggregates


def daily_etl(fact: DataFrame) -> DataFrame:
    rows = identified(fact).where(~E.status_in("status", E.UNFINISHED))
    return rows.groupBy(*DAY).agg(
        F.min("dataset_family").alias("etl_family"),
        F.count("*").alias("etl_run_count"),
        F.count_if(E.status_in("status", E.SUCCESS)).alias("etl_success_count"),
        F.count_if(E.status_in("status", E.FAILURE)).alias("etl_fail_count"),
        F.sum(F.coalesce("input_bytes", F.lit(0))).alias("total_input_bytes"),
        F.sum(F.coalesce("output_bytes", F.lit(0))).alias("total_output_bytes"),
        E.quantile("duration_sec", 0.95).alias("p95_etl_duration_sec"),
    )


def daily_qc(fact: DataFrame) -> DataFrame:
    rows = identified(fact).where("rule_id = 'contract_status'")
    return rows.groupBy(*DAY).agg(
        F.min("dataset_family").alias("qc_family"),
        F.count("*").alias("qc_run_count"),
        F.count_if(E.status("status") == "PASS").alias("qc_pass_count"),
        F.count_if(E.status("status") == "WARN").alias("qc_warn_count"),
        F.count_if(E.status_in("status", E.FAILURE)).alias("qc_fail_count"),
    )


def daily_workflow(fact: DataFrame) -> DataFrame:
    return identified(fact).groupBy(*DAY).agg(
        F.min("dataset_family").alias("workflow_family"),
        F.count_distinct("workflow_name").alias("workflow_count"),
        E.distinct_where(E.status("phase") == "SUCCEEDED", "workflow_name").alias("workflow_success_count"),
        E.distinct_where(E.status_in("phase", ("FAILED", "ERROR")), "workflow_name").alias("workflow_fail_count"),
        E.quantile("duration_sec", 0.95).alias("p95_workflow_step_duration_sec"),
    )


def dws_dataset_quality_daily(etl: DataFrame, qc: DataFrame, steps: DataFrame, ml_ready: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Five aggregates on a spine of their keys. The family is the first known one of ETL, QC and workflow rows."""
    e, q, w = daily_etl(etl), daily_qc(qc), daily_workflow(steps)
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in ("num_train", "num_val", "num_test")), F.lit(0))
    m = identified(ml_ready).groupBy(F.to_date("created_at").alias("dt"), "dataset_id", "version").agg(F.max(total).alias("ml_ready_rows"))
    s = identified(snapshots).groupBy(F.to_date("created_at").alias("dt"), "dataset_id", "version").agg(F.avg("quality_score").alias("avg_quality_score"))
    wide = spine([e, q, w, m], DAY)
    for part in (e, q, w, m, s):
        wide = wide.join(part, DAY, "left")
    counts = [f"{a}_{b}" for a, bs in (("qc", ("run_count", "pass_count", "warn_count", "fail_count")), ("etl", ("run_count", "success_count", "fail_count")), ("workflow", ("count", "success_count", "fail_count"))) for b in bs]
    wide = wide.na.fill(0, [*counts, "ml_ready_rows", "total_input_bytes", "total_output_bytes"])
    return wide.select(
        *DAY, F.coalesce("etl_family", "qc_family", "workflow_family").alias("dataset_family"), *counts,
        E.ratio("qc_pass_count", "qc_run_count").alias("qc_pass_rate"), E.ratio("etl_success_count", "etl_run_count").alias("etl_success_rate"),
        E.ratio("workflow_success_count", "workflow_count").alias("workflow_success_rate"),
        "avg_quality_score", "ml_ready_rows", "total_input_bytes", "total_output_bytes", "p95_etl_duration_sec", "p95_workflow_step_duration_sec",
    )


def dws_rule_failure_daily(fact: DataFrame) -> DataFrame:
    unknown = lambda c: F.coalesce(c, F.lit("unknown")).alias(c)
    rows = fact.where("rule_id is not null and rule_id <> 'contract_status'")
    counted = rows.groupBy("dt", unknown("dataset_family"), unknown("contract_id"), "rule_id", unknown("severity")).agg(
        F.count("*").alias("run_count"), *(F.count_if(E.status("status") == w.upper()).alias(f"{w}_count") for w in ("pass", "warn", "fail"))
    )
    return counted.withColumn("fail_rate", E.ratio("fail_count", "run_count"))


def dws_workflow_ops_daily(fact: DataFrame) -> DataFrame:
    name = lambda words: E.distinct_where(E.status_in("phase", words), "workflow_name")
    d = fact.groupBy("dt", F.coalesce("workflow_type", F.lit("unknown")).alias("workflow_type")).agg(
        F.count_distinct("workflow_name").alias("workflow_count"),
        name(("SUCCEEDED",)).alias("success_count"),
        name(("FAILED", "ERROR")).alias("failed_count"),
        name(("RUNNING", "PENDING")).alias("running_count"),
        F.avg("duration_sec").alias("avg_duration_sec"),
        E.quantile("duration_sec", 0.95).alias("p95_duration_sec"),
        F.count_if(E.status("container_reason") == "DEADLINEEXCEEDED").alias("deadline_exceeded_count"),
        F.count_if(E.status("container_reason") == "OOMKILLED").alias("oom_count"),
        F.count_if(F.coalesce("exit_code", F.lit(0)) != 0).alias("nonzero_exit_count"),
    )
    return d.withColumn("success_rate", E.ratio("success_count", "workflow_count"))


def job_days(jobs: DataFrame) -> DataFrame:
    """Jobs with the day that they count for and their task type."""
    times = [c for c in ("finished_at", "started_at", "created_at") if c in jobs.columns]
    return jobs.withColumn("dt", E.day(*times)).withColumn("task_type", F.coalesce("task_type", F.lit("unknown")))


def dws_inference_job_daily(jobs: DataFrame, outputs: DataFrame, models: DataFrame) -> DataFrame:
    keys = ["dt", "model_id", "task_type"]
    j = job_days(jobs)
    zero = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)))
    a = j.groupBy(*keys).agg(
        F.count("*").alias("job_count"),
        F.count_if(E.status_in("status", ("SUCCEEDED", "OK"))).alias("success_count"),
        F.count_if(E.status_in("status", ("FAILED", "DEAD_LETTER"))).alias("fail_count"),
        zero("total_samples").alias("total_samples"), zero("processed_samples").alias("processed"), zero("failed_samples").alias("failed"), zero("duration_sec").alias("seconds"),
    )
    timed = outputs.where("latency_ms is not null").select("job_id", "latency_ms").join(j.select("job_id", *keys), "job_id")
    latency = timed.groupBy(*keys).agg(F.avg("latency_ms").alias("avg_latency_ms"), E.quantile("latency_ms", 0.95).alias("p95_latency_ms"))
    both = a.join(models.select("model_id", "backend"), "model_id", "left").join(latency, keys, "left")
    return both.select(
        *keys, "backend", "job_count", "success_count", "fail_count", E.ratio("success_count", "job_count").alias("success_rate"), "total_samples",
        E.ratio("processed", "seconds").alias("samples_per_sec"), "avg_latency_ms", "p95_latency_ms", E.ratio("failed", "total_samples", 0.0).alias("error_rate"),
    )


# ---------------------------------------------------------------- dashboards


def top_per_key(df: DataFrame, keys: list[str], count: str, name: str) -> DataFrame:
    """The row with the largest count of each key, ties by name."""
    w = Window.partitionBy(*keys).orderBy(F.desc(count), name)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def ads_quality_dashboard(dws: DataFrame, rules: DataFrame, profiles: DataFrame) -> DataFrame:
    """Score, worst rule, bytes by layer and alert of each dataset and day (unknown rates count as full)."""
    failing = rules.where("fail_count > 0").groupBy("dt", F.col("dataset_family").alias("family"), "rule_id").agg(F.sum("fail_count").alias("n"))
    top = top_per_key(failing, ["dt", "family"], "n", "rule_id").select("dt", "family", F.col("rule_id").alias("top_failed_rule"), F.col("n").alias("top_failed_rule_count"))
    layer = lambda *names: F.sum(F.when(F.col("layer").isin(*names), F.coalesce("bytes", F.lit(0))))
    sizes = profiles.groupBy(*DAY).agg(layer("raw", "ods").alias("raw_bytes"), layer("dwd").alias("dwd_bytes"))
    both = dws.withColumn("family", F.coalesce("dataset_family", F.lit("unknown"))).join(top, ["dt", "family"], "left").join(sizes, DAY, "left")
    qc, etl = E.known("qc_pass_rate", 1.0), E.known("etl_success_rate", 1.0)
    bad = (qc < 0.8) | (etl < 0.8)
    return both.select(
        *DAY, "dataset_family", E.ladder([(bad, "FAIL"), (qc < 0.95, "WARN")], "PASS").alias("overall_status"), E.dashboard_score().alias("quality_score"),
        "qc_pass_rate", "etl_success_rate", "workflow_success_rate", "top_failed_rule", "top_failed_rule_count", F.col("p95_workflow_step_duration_sec").alias("p95_duration_sec"), "ml_ready_rows",
        "raw_bytes", "dwd_bytes", E.ladder([(bad, "CRITICAL"), (qc < 0.95, "WARN")], "OK").alias("alert_level"),
        E.ladder([(qc < 0.8, "qc_pass_rate<0.8"), (etl < 0.8, "etl_success_rate<0.8"), (qc < 0.95, "qc_pass_rate<0.95")]).alias("alert_reason"),
    )


def ads_quality_dashboard_strict(dws: DataFrame, facts: DataFrame) -> DataFrame:
    """The other definition: any failure is critical, unknown rates count as none, the worst rule is the dataset's own."""
    failed = facts.where(E.status_in("status", E.FAILURE) & (F.col("rule_id") != "contract_status")).groupBy(*DAY, "rule_id").agg(F.count("*").alias("n"))
    top = top_per_key(failed, DAY, "n", "rule_id").select(*DAY, F.col("rule_id").alias("top_failed_rule"), F.col("n").alias("top_failed_rule_count"))
    fails = F.col("qc_fail_count") + F.col("etl_fail_count") + F.col("workflow_fail_count")
    note = lambda label, c: F.when(F.col(c) > 0, F.concat(F.lit(f"{label}="), F.col(c).cast("string")))
    both = dws.join(top, DAY, "left")
    return both.select(
        *DAY, "dataset_family", E.ladder([(fails > 0, "FAIL"), (F.col("qc_warn_count") > 0, "WARN")], "PASS").alias("overall_status"), E.dashboard_score_strict().alias("quality_score"),
        "top_failed_rule", "top_failed_rule_count",
        E.ladder([(fails > 0, "CRITICAL"), ((F.col("qc_warn_count") > 0) | (E.known("qc_pass_rate", 1.0) < 0.95), "WARNING")], "OK").alias("alert_level"),
        F.concat_ws(" ", note("qc_fail", "qc_fail_count"), note("etl_fail", "etl_fail_count"), note("wf_fail", "workflow_fail_count"), F.concat(F.lit("top_rule="), "top_failed_rule")).alias("alert_reason"),
    )


def ads_workflow_ops_dashboard(dws: DataFrame) -> DataFrame:
    rate, oom, late = E.known("success_rate", 1.0), F.col("oom_count") > 0, F.col("deadline_exceeded_count") > 0
    return dws.select(
        "dt", "workflow_type", "workflow_count", "success_count", "failed_count", "success_rate", "avg_duration_sec", "p95_duration_sec", "oom_count", "deadline_exceeded_count",
        E.ladder([((rate < 0.8) | oom | late, "CRITICAL"), (rate < 0.95, "WARN")], "OK").alias("alert_level"),
        E.ladder([(rate < 0.8, "success_rate<0.8"), (oom, "oom_kill"), (late, "deadline_exceeded"), (rate < 0.95, "success_rate<0.95")]).alias("alert_reason"),
    )


def ads_inference_dashboard(dws: DataFrame, failures: DataFrame, jobs: DataFrame) -> DataFrame:
    """failures: job_id, error_type."""
    keys = ["dt", "model_id", "task_type"]
    kinds = failures.select("job_id", F.coalesce("error_type", F.lit("UNKNOWN")).alias("top_error_type")).join(job_days(jobs).select("job_id", *keys), "job_id")
    top = top_per_key(kinds.groupBy(*keys, "top_error_type").agg(F.count("*").alias("n")), keys, "n", "top_error_type").drop("n")
    rate, errors = E.known("success_rate", 1.0), E.known("error_rate", 0.0)
    bad = (rate < 0.8) | (errors > 0.2)
    return dws.join(top, keys, "left").select(
        *keys, "backend", E.ladder([(bad, "FAIL"), (rate < 0.95, "WARN")], "PASS").alias("overall_status"), "job_count", "success_rate", "total_samples", "samples_per_sec", "p95_latency_ms", "error_rate",
        "top_error_type", E.ladder([(bad, "CRITICAL"), (rate < 0.95, "WARN")], "OK").alias("alert_level"),
        E.ladder([(rate < 0.8, "success_rate<0.8"), (errors > 0.2, "error_rate>0.2"), (rate < 0.95, "success_rate<0.95")]).alias("alert_reason"),
    )
