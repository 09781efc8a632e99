"""Aggregations that several reports share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..sources.scratch import written
from .joins import null_safe_join


def labeled_counts(df: DataFrame, labels: list[str], sums: tuple[str, ...] = ()) -> DataFrame:
    """Rows per combination of labels (null as empty), with sums (null as 0)."""
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in labels]
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *(F.sum(F.coalesce(F.col(c), F.lit(0))).alias(f"sum_{c}") for c in sums))


def flag_counts(df: DataFrame, flag: str) -> DataFrame:
    """Rows by pass, fail and unknown of a boolean."""
    name = F.when(F.col(flag), "pass").when(~F.col(flag), "fail").otherwise("unknown")
    return df.groupBy(name.alias("outcome")).agg(F.count("*").alias("n"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table (no column is read)."""
    return reduce(DataFrame.unionByName, [d.agg(F.count("*").alias("n_rows")).select(F.lit(k).alias("table_name"), "n_rows") for k, d in tables.items()])


def ages(df: DataFrame, key: str, time: str, now: Column) -> DataFrame:
    """Seconds from the last time of each key to ``now``."""
    return df.groupBy(key).agg(F.max(time).alias("last")).select(key, (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last").cast("timestamp"))).cast("double").alias("micros")).select(key, (F.col("micros") / 1e6).alias("age_sec"))


def phase_performance(runs: DataFrame) -> DataFrame:
    """Duration, bytes and failures by phase."""
    zero = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)))
    return runs.groupBy("phase").agg(zero("duration_sec").alias("duration_sec"), zero("input_bytes").alias("input_bytes"), zero("output_bytes").alias("output_bytes"), F.count_if(E.status_in("status", E.FAILURE)).alias("failures"))


def null_rate(df: DataFrame) -> DataFrame:
    """Share of null cells, in one pass over the data."""
    nulls = reduce(Column.__add__, [F.sum(F.col(c).isNull().cast("long")) for c in df.columns])
    return df.agg(F.count("*").alias("n_rows"), nulls.alias("null_cells")).withColumn("null_rate", E.ratio(F.col("null_cells"), F.col("n_rows") * len(df.columns)))


def trajectory_lengths(df: DataFrame, episode: str) -> DataFrame:
    return df.groupBy(episode).agg(F.count("*").alias("length"))


def missing_text_rate(df: DataFrame, column: str) -> Column:
    """Aggregate: share of rows with no text, or with an empty vector."""
    kind = dict(df.dtypes)[column]
    missing = F.col(column).isNull() | ((F.size(column) == 0) if kind.startswith("array") else (F.trim(column) == ""))
    return F.avg(missing.cast("double"))


def inference_metrics(outputs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Totals, throughput, latency quantiles and error rate of each job."""
    o = outputs.groupBy("job_id").agg(
        F.count("*").alias("total"), F.count_if(E.status("status") == "OK").alias("ok"), F.avg("latency_ms").alias("avg_latency_ms"), F.percentile("latency_ms", F.array(*map(F.lit, (0.5, 0.95, 0.99)))).alias("p")
    )
    return o.join(jobs.select("job_id", "duration_sec"), "job_id").select(
        "job_id", "total", "ok", E.ratio("ok", "duration_sec").alias("samples_per_sec"), "avg_latency_ms", *(F.col("p")[i].alias(f"p{n}_latency_ms") for i, n in enumerate((50, 95, 99))),
        E.ratio(F.col("total") - F.col("ok"), "total", 0.0).alias("error_rate"),
    )


def best_combination(runs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The row with the largest value over all rows; ties by the smallest keys."""
    return runs.orderBy(F.desc_nulls_last(value), *keys).limit(1)


def shard_summary(shards: DataFrame, expected: int) -> DataFrame:
    """shards: shard_id, duration_sec, rows_count, status, dataset_id. Sums, the longest duration, failed datasets."""
    failed = F.sort_array(F.collect_set(F.when(E.status_in("status", E.FAILURE), F.col("dataset_id"))))
    return shards.agg(
        F.count_distinct("shard_id").alias("found_shards"), F.lit(expected).alias("expected_shards"), F.sum("rows_count").alias("rows_count"), F.max("duration_sec").alias("duration_sec"), F.concat_ws(",", failed).alias("failed_datasets")
    )


def worst_level(level: str) -> Column:
    """Aggregate: the worst alert level (null counts as OK)."""
    rank = F.max(E.ladder([(F.col(level) == "CRITICAL", 2), (F.col(level).isin("WARN", "WARNING"), 1)], 0))
    return E.ladder([(rank == 2, "CRITICAL"), (rank == 1, "WARN")], "OK")


def running_buckets(files: DataFrame, target: int, most: int, keys: tuple[str, ...] = ("dataset_id",), parts: int | None = None) -> DataFrame:
    """Files of each dataset in order, largest first (ties by uri), filled into buckets of ``target`` bytes: a bucket ends with the
    file that reaches the target; at most ``most`` buckets, the last takes the rest.

    Prefix sums in parts: files are dealt by ranges of that order, each part is summed, the sums of the parts before it
    are added, so that no task orders a whole dataset. Which bucket a file starts in follows from the bytes ahead of it."""
    order = [*keys, F.desc("size_bytes"), "uri"]
    files = files.withColumn("size_bytes", F.coalesce("size_bytes", F.lit(0)))
    ranged = files.repartitionByRange(parts, *order) if parts else files.repartitionByRange(*order)
    ranged = written(ranged.withColumn("_part", F.spark_partition_id()), "ranged-files")
    sums = ranged.groupBy(*keys, "_part").agg(F.sum("size_bytes").alias("_sum"))
    ahead = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_part").orderBy(F.desc("size_bytes"), "uri").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_ahead") + F.coalesce(F.sum("size_bytes").over(inside), F.lit(0))
    both = null_safe_join(ranged, sums, [*keys, "_part"])
    return both.withColumn("bucket", F.least(F.floor(before / F.lit(float(target))) + 1, F.lit(most)).cast("int")).drop("_part", "_ahead")
