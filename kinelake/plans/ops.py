"""Quality operations: gates, contracts, SLA checks, backfills, summaries, lineage and file audits."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators.aggregates import worst_level
from ..operators.joins import latest, pattern_join
from .warehouse import within

# ---------------------------------------------------------------- rules


def holds(op: Column, actual: Column, threshold: Column, text: Column, among: Column) -> Column:
    """Whether a rule's comparison holds. A null value holds only for missing-ok; ``in`` compares with a list of texts,
    ``between`` with a list of two numbers (both included)."""
    low, high = among[0].cast("double"), among[1].cast("double")
    test = (
        F.when(op == "<=", actual <= threshold).when(op == "<", actual < threshold).when(op == ">=", actual >= threshold).when(op == ">", actual > threshold)
        .when(op == "==", actual == threshold).when(op == "!=", actual != threshold).when(op == "between", actual.between(low, high))
        .when(op == "in", F.array_contains(among, text)).when(op == "exists", text != "")
    )
    return F.when(text.isNull(), op == "missing-ok").otherwise(F.coalesce(test, F.lit(False)))


def rule_results(metrics: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """metrics: keys, metric, actual (double). rules: rule_id, metric, op, threshold, among, severity. A row per key and rule.

    Rules are a table of the deployment, not of the data; Spark broadcasts it by size."""
    cases = metrics.select(*keys).distinct().crossJoin(rules)
    both = cases.join(metrics, [*keys, "metric"], "left")
    passed = holds(F.col("op"), F.col("actual"), F.col("threshold"), F.col("actual").cast("string"), F.col("among"))
    status = E.ladder([(passed, "PASS"), (F.col("severity") == "fail", "FAIL"), (F.col("severity") == "warn", "WARN")], "PASS")
    return both.select(*keys, "rule_id", "metric", "op", "threshold", "actual", "severity", passed.alias("passed"), status.alias("status"))


def gate(results: DataFrame, keys: list[str]) -> DataFrame:
    """Status of each key: any FAIL, else any WARN, else PASS; and which rules failed."""
    names = lambda s: F.concat_ws(",", F.sort_array(F.collect_set(F.when(F.col("status") == s, F.col("rule_id")))))
    count = lambda s: F.count_if(F.col("status") == s)
    return results.groupBy(*keys).agg(E.ladder([(count("FAIL") > 0, "FAIL"), (count("WARN") > 0, "WARN")], "PASS").alias("status"), names("FAIL").alias("failed_rules"), names("WARN").alias("warning_rules"))


#: The rules that every dataset has to meet (id, metric, comparison, threshold, severity).
UNIVERSAL = (
    ("object_count_min", "files_count", ">=", 1.0, "fail"),
    ("empty_files_count", "empty_file_count", "<=", 0.0, "warn"),
    ("parquet_readable_rate", "readable_parquet_rate", ">=", 0.95, "warn"),
    ("hdf5_readable_rate", "readable_hdf5_rate", ">=", 0.95, "warn"),
    ("video_decode_pass_rate", "video_decode_pass_rate", ">=", 0.9, "warn"),
)


def universal_rules(spark) -> DataFrame:
    return spark.createDataFrame([(i, m, o, t, None, s) for i, m, o, t, s in UNIVERSAL], "rule_id string, metric string, op string, threshold double, among array<string>, severity string")


def file_metrics(files: DataFrame, keys: list[str]) -> DataFrame:
    """Universal metrics of slices from file rows (keys, kind, size_bytes, readable), long: keys, metric, actual."""
    rate = lambda kind: E.ratio(F.count_if((F.col("kind") == kind) & F.col("readable")), F.count_if(F.col("kind") == kind), 1.0)
    wide = files.groupBy(*keys).agg(
        F.count("*").cast("double").alias("files_count"), F.count_if(F.coalesce("size_bytes", F.lit(0)) == 0).cast("double").alias("empty_file_count"),
        rate("parquet").alias("readable_parquet_rate"), rate("hdf5").alias("readable_hdf5_rate"), rate("video").alias("video_decode_pass_rate"),
    )
    return wide.unpivot(keys, ["files_count", "empty_file_count", "readable_parquet_rate", "readable_hdf5_rate", "video_decode_pass_rate"], "metric", "actual")


def compared_reports(baseline: DataFrame, candidate: DataFrame, limits: DataFrame) -> DataFrame:
    """metric, value of two reports against limits (metric, higher_is_better, warn, fail): relative loss and status."""
    both = baseline.select("metric", F.col("value").alias("before")).join(candidate.select("metric", F.col("value").alias("after")), "metric").join(limits, "metric")
    loss = F.when(F.col("higher_is_better"), F.col("before") - F.col("after")).otherwise(F.col("after") - F.col("before")) / F.greatest(F.abs("before"), F.lit(1e-12))
    return both.withColumn("loss", loss).withColumn("status", E.ladder([(F.col("loss") > F.col("fail"), "FAIL"), (F.col("loss") > F.col("warn"), "WARN")], "PASS"))


# ---------------------------------------------------------------- SLA


def sla_check(policies: DataFrame, ads: DataFrame, dim: DataFrame, ml_ready: DataFrame, qc_runs: DataFrame, workflow_runs: DataFrame, day: date) -> DataFrame:
    """Checks of each enabled policy on each dataset in its scope, on one day.

    policies: policy_id, policy_name, dataset_pattern, policy_family, required_outputs, min_qc_pass_rate,
    min_etl_success_rate, max_failed_workflows, enabled. Failed workflows are those of the whole day."""
    keys = ["dataset_id", "version"]
    today = ads.where(F.col("dt") == F.lit(day)).select(*keys, "dataset_family", "qc_pass_rate", "etl_success_rate", "workflow_success_rate", F.lit(True).alias("has_ads"))
    rest = dim.select(*keys, "dataset_family").join(today, keys, "left_anti")
    scope = today.unionByName(rest, allowMissingColumns=True)
    export = latest(ml_ready, keys, ["created_at", "ml_id"], [F.lit(True).alias("has_ml")])
    tested = qc_runs.where(F.to_date("started_at") == F.lit(day)).select(*keys).distinct().withColumn("has_qc", F.lit(True))
    failed = workflow_runs.where(F.to_date("started_at") == F.lit(day)).agg(F.count_if(E.status_in("status", ("FAILED", "ERROR"))).alias("failed_workflows"))
    facts = scope.join(export, keys, "left").join(tested, keys, "left").na.fill(False, ["has_ads", "has_ml", "has_qc"]).crossJoin(F.broadcast(failed))  # one row
    both = pattern_join(policies.where("enabled"), facts)
    present = lambda o: F.when(o == "ads", F.col("has_ads")).when(o == "ml_ready", F.col("has_ml")).when(o == "qc", F.col("has_qc")).otherwise(F.lit(False))
    both = both.withColumn("missing", F.filter("required_outputs", lambda o: ~present(F.lower(o))))
    qc = F.col("qc_pass_rate") < F.col("min_qc_pass_rate")
    etl = F.col("etl_success_rate") < F.col("min_etl_success_rate")
    flows = F.col("failed_workflows") > F.col("max_failed_workflows")
    reasons = F.concat_ws("; ", F.when(F.size("missing") > 0, F.concat(F.lit("missing: "), F.concat_ws(",", "missing"))), F.when(qc, "qc_pass_rate"), F.when(etl, "etl_success_rate"), F.when(flows, "failed_workflows"))
    bad = (F.size("missing") > 0) | F.coalesce(qc, F.lit(False)) | F.coalesce(etl, F.lit(False)) | F.coalesce(flows, F.lit(False))
    return both.select(
        "policy_id", F.lit(day).alias("dt"), *keys, E.ladder([(bad, "FAIL")], "PASS").alias("status"), "qc_pass_rate", "etl_success_rate", F.concat_ws(",", "missing").alias("missing_outputs"),
        F.when(bad, reasons).alias("failed_reason"), "failed_workflows",
    )


# ---------------------------------------------------------------- backfill


def backfill_candidates(etl: DataFrame, steps: DataFrame, ads: DataFrame, sla: DataFrame | None = None, window: tuple[date, date] | None = None, states: tuple[str, ...] = ("FAIL", "FAILED", "ERROR", "WARN")) -> DataFrame:
    """Distinct (dt, dataset_id, version, phase) that failed or warned in any of four tables."""
    parts = [(etl, "status", F.coalesce("phase", F.lit("normalize"))), (steps, "phase", F.lit("workflow")), (ads, "overall_status", F.lit("build_features"))] + ([(sla, "status", F.lit("sla"))] if sla is not None else [])
    out = None
    for df, state, phase in parts:
        rows = within(df, window).where(E.status_in(state, states) & F.col("dataset_id").isNotNull() & F.col("version").isNotNull()).select("dt", "dataset_id", "version", phase.alias("phase"))
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def backfill_days(spark, window: tuple[date, date], dataset_id: str, version: str, phase: str = "normalize") -> DataFrame:
    """One task a day, for a dataset without any run."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(window[0]), F.lit(window[1]))).alias("dt"))
    return days.select("dt", F.lit(dataset_id).alias("dataset_id"), F.lit(version).alias("version"), F.lit(phase).alias("phase"))


def backfill_plan(candidates: DataFrame) -> DataFrame:
    """Tasks with a stage and a status."""
    stages = ("normalize", "etl", "build_features", "build_ads", "ml_ready", "qc", "sla")
    stage = F.when(F.col("phase") == "workflow", "etl").when(F.lower("phase").isin(*stages), F.lower("phase")).otherwise("normalize")
    return candidates.select(E.key(F.col("dt").cast("string"), "dataset_id", "version", "phase").alias("task_id"), "dt", "dataset_id", "version", "phase", stage.alias("stage"), F.lit("PLANNED").alias("status"))


# ---------------------------------------------------------------- summaries


def quality_summary(ads: DataFrame, steps: DataFrame, inference: DataFrame, day: date, exports: DataFrame | None = None, benchmarks: DataFrame | None = None) -> DataFrame:
    """One row about a day: datasets (with their versions), averages of known rates, bytes, worst alert; the 95th percentile of the
    day's step durations and how many steps have an archived log; jobs, their success and throughput; exports and benchmark latency.

    steps: dt, duration_sec, archive_log_uri. inference: dws_inference_job_daily. exports, benchmarks: created_at (p95_latency_ms)."""
    on = lambda df: df.where(F.col("dt") == F.lit(day))
    created = lambda df: df.where(F.to_date("created_at") == F.lit(day))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    parts = [
        on(ads).agg(
            F.count("*").alias("n_rows"), F.count_distinct(F.struct("dataset_id", "version")).alias("datasets"), *(F.avg(c).alias(f"avg_{c}") for c in ("qc_pass_rate", "etl_success_rate", "workflow_success_rate", "quality_score")),
            zero("ml_ready_rows").alias("ml_ready_rows"), zero("raw_bytes").alias("raw_bytes"), zero("dwd_bytes").alias("dwd_bytes"), worst_level("alert_level").alias("worst_alert"),
        ),
        on(steps).agg(E.quantile("duration_sec", 0.95).alias("p95_step_duration_sec"), F.count_distinct(F.when(F.col("archive_log_uri") != "", F.col("archive_log_uri"))).alias("archived_logs")),
        on(inference).agg(zero("job_count").alias("inference_jobs"), zero("success_count").alias("_ok"), F.avg("samples_per_sec").alias("inference_samples_per_sec")),
        *([created(exports).agg(F.count("*").alias("exports"))] if exports is not None else []),
        *([created(benchmarks).agg(F.avg("p95_latency_ms").alias("benchmark_p95_latency_ms"))] if benchmarks is not None else []),
    ]
    row = reduce(lambda a, b: a.crossJoin(F.broadcast(b)), parts)  # one row each
    return row.withColumn("inference_success_rate", E.ratio("_ok", "inference_jobs")).drop("_ok")


def log_index(steps: DataFrame, day: date) -> DataFrame:
    """The archived logs of a day's steps."""
    return steps.where((F.col("dt") == F.lit(day)) & (F.col("archive_log_uri") != "")).select("archive_log_uri").distinct()


def top_rules(rules: DataFrame, n: int) -> DataFrame:
    """The rows of the daily rule table (contract, rule, severity, family) with the most failures, ties by rule and the other keys."""
    columns = ["dt", "contract_id", "rule_id", "severity", "dataset_family", "fail_count", "run_count", "fail_rate"]
    return rules.where("fail_count > 0").orderBy(F.desc("fail_count"), "rule_id", "dt", "contract_id", "severity", "dataset_family").limit(n).select(*columns)


def abnormal(ads: DataFrame) -> DataFrame:
    return ads.where(F.coalesce("alert_level", F.lit("OK")) != "OK")


def lineage_report(runs: DataFrame, steps: DataFrame) -> DataFrame:
    """Each workflow run with its steps: how many, how many failed, their total time."""
    from ..operators.joins import null_safe_join

    keys = ["workflow_namespace", "workflow_name"]
    s = steps.groupBy(*keys).agg(F.count("*").alias("n_steps"), F.count_if(E.status_in("phase", ("FAILED", "ERROR"))).alias("failed_steps"), F.sum("duration_sec").alias("total_sec"))
    return null_safe_join(runs, s, keys, "left")


def lineage_related(steps: DataFrame, qc_runs: DataFrame, ml_ready: DataFrame, profiles: DataFrame, workflow_name: str, workflow_namespace: str, most_steps: int = 500, most: int = 20) -> DataFrame:
    """section, place, id, dataset_id, version, status, at: a workflow's steps from the first on, and the newest contract runs,
    exports and profiles, at most so many of each."""

    def section(name: str, df: DataFrame, key: str, status: Column, at: str, n: int, *order: Column) -> DataFrame:
        first = df.orderBy(*order, key).limit(n)
        place = F.row_number().over(Window.orderBy(*order, key))  # over n rows
        return first.select(F.lit(name).alias("section"), place.alias("place"), F.col(key).cast("string").alias("id"), "dataset_id", "version", status.cast("string").alias("status"), F.col(at).alias("at"))

    own = steps.where((F.col("workflow_name") == workflow_name) & (F.col("workflow_namespace") == workflow_namespace))
    newest = F.desc_nulls_last("created_at")
    return reduce(
        DataFrame.unionByName,
        [
            section("step", own, "pod_name", F.col("phase"), "started_at", most_steps, F.col("started_at").asc_nulls_last()),
            section("qc_run", qc_runs, "run_id", F.col("status"), "created_at", most, newest),
            section("ml_ready", ml_ready, "ml_id", F.col("output_uri"), "created_at", most, newest),
            section("profile", profiles, "profile_id", F.col("layer"), "created_at", most, newest),
        ],
    )


# ---------------------------------------------------------------- files


def family_of(files: DataFrame, keys: list[str]) -> DataFrame:
    """Dataset family by keywords in its URIs, else by the mix of file kinds."""
    has = lambda pattern: F.bool_or(F.lower("uri").rlike(pattern))
    return files.groupBy(*keys).agg(E.ladder([(has("droid"), "droid"), (has("robomimic"), "robomimic"), (has("bridge"), "bridge"), (has(r"\.hdf5$"), "robomimic"), (has(r"\.parquet$") & has(r"\.mp4$"), "droid"), (has(r"\.parquet$"), "bridge")], "unknown").alias("family"))


def adapters(files: DataFrame, keys: list[str], markers: list[tuple[str, str, str]]) -> DataFrame:
    """markers: a fixed handful of (family, prefix, layout). +0.4 if the dataset id has the prefix, +0.6 if any URI has the
    layout; the best family of each slice, ties by place; none below 0.4. One aggregate, a condition for each marker."""
    hits = files.groupBy(*keys).agg(*(F.bool_or(F.contains(F.col("uri"), F.lit(layout))).alias(f"_{i}") for i, (_, _, layout) in enumerate(markers)))
    score = lambda i, prefix: F.least(F.when(F.startswith(F.col("dataset_id"), F.lit(prefix)), 0.4).otherwise(0.0) + F.when(F.col(f"_{i}"), 0.6).otherwise(0.0), F.lit(1.0))
    scores = F.array(*(F.struct(score(i, prefix).alias("confidence"), F.lit(-i).alias("place"), F.lit(family).alias("family")) for i, (family, prefix, _) in enumerate(markers)))
    best = hits.withColumn("b", F.array_max(scores))
    return best.select(*keys, F.when(F.col("b.confidence") >= 0.4, F.col("b.family")).otherwise("unknown").alias("family"), F.col("b.confidence").alias("confidence"))


def manifest_audit(slices: DataFrame, manifests: DataFrame, keys: list[str], required: tuple[str, ...]) -> DataFrame:
    """manifests: keys, manifest_json. Missing manifests fail, missing keys warn."""
    both = slices.join(manifests, keys, "left")
    absent = F.filter(F.array(*map(F.lit, required)), lambda k: ~F.array_contains(F.coalesce(F.json_object_keys("manifest_json"), F.array()), k))
    both = both.withColumn("missing_keys", F.concat_ws(",", absent))
    return both.withColumn("status", E.ladder([(F.col("manifest_json").isNull(), "FAIL"), (F.col("missing_keys") != "", "WARN")], "PASS")).drop("manifest_json")


def reconciled(manifest: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Files of manifests against those that exist: missing, of the wrong size, present."""
    both = manifest.select(*keys, "uri", F.col("size_bytes").alias("wanted")).join(actual.select("uri", F.col("size_bytes").alias("found")), "uri", "left")
    ok = F.col("found") == F.col("wanted")
    d = both.groupBy(*keys).agg(F.count_if(F.col("found").isNull()).alias("missing"), F.count_if(~ok).alias("wrong_size"), F.count_if(ok).alias("present"), F.coalesce(F.sum(F.when(ok, F.col("found"))), F.lit(0)).alias("present_bytes"))
    return d.withColumn("status", E.ladder([(F.col("missing") > 0, "FAIL"), (F.col("wrong_size") > 0, "WARN")], "PASS"))


def lake_listing(files: DataFrame, include: str | None = None, exclude: str | None = None) -> DataFrame:
    """Objects and slices per layer (the first part of the URI); globs choose, exclusion wins."""
    rows = files
    if include:
        rows = rows.where(F.rlike("uri", E.glob_pattern(F.lit(include))))
    if exclude:
        rows = rows.where(~F.rlike("uri", E.glob_pattern(F.lit(exclude))))
    return rows.groupBy(F.substring_index("uri", "/", 1).alias("layer")).agg(F.count("*").alias("objects"), F.sum("size_bytes").alias("bytes"), F.count_distinct("dataset_id", "version").alias("slices"))


def phase_rows(runs: DataFrame, keys: list[str], phases: tuple[str, ...] = ("normalize", "features", "ads")) -> DataFrame:
    """A run row with <phase>_sec columns as a row per phase."""
    return runs.unpivot(keys, [f"{p}_sec" for p in phases], "phase", "duration_sec").withColumn("phase", F.regexp_replace("phase", "_sec$", ""))


def reingested(target: DataFrame, pending: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """pending: raw (JSON of a target row inside an envelope field). The target with new rows appended, and counts."""
    parsed = pending.select("raw", F.from_json(F.get_json_object("raw", "$.record"), target.schema).alias("r"))
    good = parsed.where(F.col(f"r.{keys[0]}").isNotNull()).select("r.*").dropDuplicates(keys)
    fresh = good.join(target.select(*keys), keys, "left_anti")
    counts = parsed.agg(F.count("*").alias("n_read"), F.count_if(F.col(f"r.{keys[0]}").isNull()).alias("n_failed"))
    return target.unionByName(fresh.select(*target.columns)), counts
