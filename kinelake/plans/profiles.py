"""Profiles of dataset slices from rows about single files.

Probes: keys, uri, kind (parquet, hdf5, video), size_bytes, readable, row_count, demo_count, null_rate, schema_hash,
columns (an array of paths), lengths (an array: frames of each episode), language_missing_rate, and whether demos have
actions, obs, next_obs, rewards and dones (has_...). A slice has any number of files; lists of lengths are never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E

#: Parts of column names that tell what a column holds.
HINTS = {
    "demo_action": ("action", "actions", "action.delta", "observation.state"),
    "demo_timestamp": ("timestamp", "timestamp_sec", "time", "time_sec"),
    "demo_language": ("language", "language_instruction", "instruction", "task_description"),
    "camera": ("cam", "camera", "wrist", "primary", "secondary"),
    "action": ("action", "actions", "delta_action"),
    "language": ("language", "language_instruction", "instruction", "task_description", "language_embedding"),
    "image": ("image", "rgb", "primary_image"),
    "environment": ("environment", "env", "scene"),
    "skill": ("skill", "task"),
}


def hinted(what: str) -> Column:
    """Aggregate: whether any column of a slice's parquet files has a name of this kind."""
    one = lambda c: F.exists(F.array(*map(F.lit, HINTS[what])), lambda h: F.contains(F.lower(c), h))
    return F.coalesce(F.bool_or(F.when(F.col("kind") == "parquet", F.exists("columns", one))), F.lit(False))


def share(condition: Column, of: Column, none: float) -> Column:
    return E.ratio(F.count_if(condition & of), F.count_if(of), none)


def long(wide: DataFrame, keys: list[str]) -> DataFrame:
    names = [c for c in wide.columns if c not in keys]
    return wide.select(*keys, *(F.col(c).cast("double").alias(c) for c in names)).unpivot(keys, names, "metric", "actual")


def length_counts(probes: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """keys, length, n: how many episodes of readable files have a length; and at, the number of shorter ones."""
    rows = probes.where((F.col("kind") == kind) & F.col("readable")).select(*keys, F.explode("lengths").alias("length")).where("length > 0")
    counts = rows.groupBy(*keys, "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*keys).orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0)))


def value_at(place: Column) -> Column:
    """Aggregate over length_counts: the length at a place (from 0) of all lengths in order."""
    return F.max(F.when((F.col("at") <= place) & (place < F.col("at") + F.col("n")), F.col("length")))


def lerobot_metrics(probes: DataFrame, keys: list[str], info: DataFrame | None = None) -> DataFrame:
    """Metrics of slices of parquet and video files (keys, metric, actual). info: keys, episodes_count, frames_count,
    chunk_files_total where a dataset states them; else readable files count as episodes unless demos are counted."""
    parquet, video = F.col("kind") == "parquet", F.col("kind") == "video"
    demos, readable = F.coalesce(F.sum(F.when(F.col("kind") == "hdf5", F.col("demo_count"))), F.lit(0)), F.count_if(parquet & F.col("readable"))
    wide = probes.groupBy(*keys).agg(
        F.count_if(parquet).alias("num_parquet_files"), F.when(demos > 0, demos).otherwise(readable).alias("num_episodes"), F.count_if(video).alias("num_videos"),
        share(F.col("readable"), parquet, 1.0).alias("parquet_valid_rate"), share(F.col("readable"), video, 1.0).alias("video_decode_pass_rate"),
        *(hinted(h).cast("int").alias(n) for h, n in (("camera", "camera_coverage"), ("demo_language", "language_coverage"), ("demo_action", "action_column_coverage"))),
        F.when(hinted("demo_timestamp"), 1.0).otherwise(0.5).alias("timestamp_monotonic_rate"), F.lit(0.0).alias("action_jump_rate"), F.lit(0.0).alias("calibration_coverage"),
        F.count_distinct(F.when(parquet, F.col("schema_hash"))).alias("schema_hash_unique_count"), F.count_if(parquet).alias("sampled_parquet_count"),
    )
    if info is None:
        return long(wide.withColumns({"num_frames": F.lit(0), "chunk_files_total": F.lit(0)}), keys)
    wide = wide.join(info, keys, "left").withColumn("num_episodes", F.when(F.col("episodes_count") > 0, F.col("episodes_count")).otherwise(F.col("num_episodes")))
    wide = wide.withColumns({"num_frames": F.coalesce("frames_count", F.lit(0)), "chunk_files_total": F.coalesce("chunk_files_total", F.lit(0))})
    return long(wide.drop("episodes_count", "frames_count"), keys)


def demo_metrics(probes: DataFrame, keys: list[str]) -> DataFrame:
    """Metrics of slices of demo files; lengths at percentiles are interpolated and rounded half to even."""
    files = probes.where("kind = 'hdf5'").withColumn("ok", F.coalesce("readable", F.lit(False)))
    some = F.greatest(F.count_if("ok"), F.lit(1))
    count = lambda c: F.count_if(F.col("ok") & F.col(c))
    wide = files.groupBy(*keys).agg(
        (F.count_if("ok") / F.count("*")).alias("hdf5_valid_rate"), F.coalesce(F.sum(F.when(F.col("ok"), F.col("demo_count"))), F.lit(0)).alias("demo_count"), F.count("*").alias("num_hdf5_files"),
        (count("has_actions") / some).alias("action_present_rate"), (F.abs(count("has_obs") - count("has_next_obs")) / some).alias("obs_next_obs_mismatch_rate"),
        (F.abs(count("has_rewards") - count("has_dones")) / some).alias("reward_done_length_mismatch_rate"), F.lit(0.0).alias("action_range_violation_rate"),
    )
    total = Window.partitionBy(*keys)
    lengths = length_counts(probes, keys, "hdf5").withColumn("all", F.sum("n").over(total))

    def percentile(p: float) -> Column:
        rank = (F.max("all") - 1) * F.lit(p)
        low, high = F.max(F.when(F.col("at") <= F.floor((F.col("all") - 1) * F.lit(p)), F.col("length"))), F.max(F.when(F.col("at") <= F.ceil((F.col("all") - 1) * F.lit(p)), F.col("length")))
        return F.bround(low * (1 - (rank - F.floor(rank))) + high * (rank - F.floor(rank)))

    each = lengths.groupBy(*keys).agg(percentile(0.5).alias("episode_len_p50"), percentile(0.95).alias("episode_len_p95"), F.min("length").alias("episode_len_min"), F.max("length").alias("episode_len_max"), F.max("all").alias("episode_count_total"))
    names = [c for c in each.columns if c not in keys]
    return long(wide.join(each, keys, "left").na.fill(0, names), keys)


def bridge_metrics(probes: DataFrame, keys: list[str]) -> DataFrame:
    """Metrics of slices of trajectory files; a readable file without lengths counts as one that could not be looked into."""
    parquet = F.col("kind") == "parquet"
    missing = F.avg(F.when(parquet, F.col("language_missing_rate")))
    wide = probes.groupBy(*keys).agg(
        F.count_if(parquet).alias("num_parquet_files"), share(F.col("readable"), parquet, 0.0).alias("parquet_valid_rate"),
        F.coalesce(missing, F.when(hinted("language"), 0.0).otherwise(1.0)).alias("language_missing_rate"), F.when(hinted("image"), 0.0).otherwise(1.0).alias("image_ref_missing_rate"),
        *(hinted(h).cast("int").alias(n) for h, n in (("action", "action_column_coverage"), ("environment", "environment_count"), ("skill", "skill_count"))),
        F.count_if(parquet & F.col("readable") & (F.coalesce(F.size("lengths"), F.lit(0)) == 0)).alias("bridge_enrich_failure_count"),
    )
    lengths = length_counts(probes, keys, "parquet").withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    each = lengths.groupBy(*keys).agg(
        value_at(F.floor(F.col("all") / 2)).alias("traj_len_p50"), value_at(F.least(F.col("all") - 1, F.floor(F.col("all") * 0.95))).alias("traj_len_p95"), F.max("all").alias("episode_count"),
    )
    return long(wide.join(each, keys, "left").na.fill(0, ["traj_len_p50", "traj_len_p95", "episode_count"]), keys)


def asset_profile(probes: DataFrame, keys: list[str]) -> DataFrame:
    """Per slice: bytes, rows, files, episodes, videos, a hash over the schemas that occur, mean null rate, failed probes,
    status. Zero rows, episodes and videos are null."""
    parquet = (F.col("kind") == "parquet") & F.col("readable")
    demos = F.coalesce(F.sum(F.when(F.col("kind") == "hdf5", F.col("demo_count"))), F.lit(0))
    schemas = F.array_sort(F.collect_set(F.when(parquet, F.col("schema_hash"))))
    p = probes.groupBy(*keys).agg(
        F.sum("size_bytes").alias("bytes"), F.nullif(F.coalesce(F.sum(F.when(parquet, F.col("row_count"))), F.lit(0)), F.lit(0)).alias("rows"), F.count("*").alias("files_count"),
        F.nullif(F.when(demos > 0, demos).otherwise(F.count_if(parquet)), F.lit(0)).alias("episodes_count"), F.nullif(F.count_if(F.col("kind") == "video"), F.lit(0)).alias("videos_count"),
        F.when(F.size(schemas) > 0, F.sha2(F.concat_ws("|", schemas).cast("binary"), 256)).alias("schema_hash"),
        F.avg(F.when(parquet, F.col("null_rate"))).alias("null_rate"), F.count_if(~F.coalesce("readable", F.lit(False))).alias("probe_failure_count"),
    )
    return p.withColumn("status", E.ladder([(F.col("probe_failure_count") > 0, "WARN")], "OK"))


def probe_summary(probes: DataFrame, keys: list[str]) -> DataFrame:
    """Per slice: files, bytes, parquet files, episodes, all columns of readable parquet files, failed probes, status."""
    parquet = (F.col("kind") == "parquet") & F.col("readable")
    files = probes.groupBy(*keys).agg(
        F.count("*").alias("files_count"), F.sum("size_bytes").alias("bytes_total"), F.count_if(F.col("kind") == "parquet").alias("parquet_files"),
        F.coalesce(F.sum(F.when(parquet, F.size("lengths"))), F.lit(0)).cast("long").alias("episodes_count"),
        F.count_if((F.col("kind") == "parquet") & ~F.coalesce("readable", F.lit(False))).alias("errors"),
    )
    columns = probes.where(parquet).select(*keys, F.explode("columns").alias("c")).distinct().groupBy(*keys).agg(F.array_sort(F.collect_list("c")).alias("columns"))
    both = files.join(columns, keys, "left")
    return both.withColumn("columns", F.coalesce("columns", F.array().cast("array<string>"))).withColumn("status", E.ladder([(F.col("errors") > 0, "WARN")], "OK"))
