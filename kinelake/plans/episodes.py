"""Robot episodes: frames to poses, features, events, scores, validation results and faults for regression tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exprs as E
from ..operators import press, series
from ..operators.series import EPISODE
from ..sources.scratch import written


def normalize(frames: DataFrame, order: str = "frame_idx", fps: float = 30.0) -> tuple[DataFrame, DataFrame]:
    """Poses (renumbered, timed, finite, unit quaternions with the raw norm) and one row per episode."""
    pose = series.unit_quaternions(series.finite(series.timestamps(series.renumbered(frames, order), fps)))
    pose = pose.select("episode_id", "dataset_id", "version", "frame_idx", "timestamp_sec", "x", "y", "z", "qx", "qy", "qz", "qw", "quat_norm")
    episodes = pose.groupBy(*EPISODE).agg(F.count("*").alias("num_frames"), (F.max("timestamp_sec") - F.min("timestamp_sec")).alias("duration_sec"))
    return pose, episodes.withColumn("fps", F.lit(fps))


def pose_features(pose: DataFrame, presses: DataFrame | None = None, threshold: float = 2.5, keep: tuple[str, ...] = ()) -> DataFrame:
    """Angles, motion and flags per frame. The raw quaternion norm is taken over if the poses carry it."""
    raw = "quat_norm" in pose.columns
    df = series.unit_quaternions(pose.withColumnRenamed("quat_norm", "_norm") if raw else pose)
    if raw:
        df = df.drop("quat_norm").withColumnRenamed("_norm", "quat_norm")
    df = series.motion(series.unwrapped(series.euler_angles(series.continuous(df))), threshold)
    if presses is not None:
        df = df.join(presses.select(*EPISODE, "frame_idx", F.lit(True).alias("is_press_candidate")), [*EPISODE, "frame_idx"], "left").na.fill(False, ["is_press_candidate"])
    names = [*EPISODE, "frame_idx", "timestamp_sec", "x", "y", "z", "roll", "pitch", "yaw", "velocity_mps", "delta_d", "quat_norm", "is_velocity_jump"]
    return df.select(*names, *keep, *(["is_press_candidate"] if presses is not None else []))


def build_features(pose: DataFrame, threshold: float = 2.5, min_distance: int = 5, expected: int = 5, quiet: float = 0.05) -> dict[str, DataFrame]:
    """pose_feature, press_event, trajectory_segment and episode_feature."""
    frames = written(press.press_frames(pose, min_distance, expected), "press-frames")  # the only grouped pandas stage: once
    features = pose_features(pose, frames, threshold)
    events = press.press_events(pose, frames)
    counts = events.groupBy(*EPISODE).agg(F.count("*").alias("detected_press_count"))
    shape = press.silhouettes(events, EPISODE)
    episodes = series.episode_summary(features).join(counts, EPISODE, "left").join(shape, EPISODE, "left").na.fill(0, ["detected_press_count"])
    return {"pose_feature": features, "press_event": events, "trajectory_segment": series.segments(features, quiet), "episode_feature": episodes}


# ---------------------------------------------------------------- scores


def episode_quality(episodes: DataFrame) -> DataFrame:
    names = ["max_velocity_mps", "quat_max_norm_error", "detected_press_count", "cluster_silhouette"]
    scored = episodes.withColumn("quality_score", E.episode_score())
    return scored.select(*EPISODE, "quality_score", E.score_status("quality_score").alias("quality_status"), *names)


def dataset_summary(quality: DataFrame) -> DataFrame:
    return quality.groupBy("dataset_id", "version").agg(
        F.count("*").alias("num_episodes"),
        F.avg("quality_score").alias("avg_quality_score"),
        F.avg((F.col("quality_status") == "PASS").cast("double")).alias("pass_rate"),
        F.avg("max_velocity_mps").alias("avg_max_velocity_mps"),
        F.avg("cluster_silhouette").alias("avg_cluster_silhouette"),
        F.sum("detected_press_count").alias("total_press_count"),
    )


def validator_failures(results: DataFrame) -> DataFrame:
    counted = results.groupBy("validator_name").agg(F.count("status").alias("total_runs"), *(F.count_if(F.col("status") == w.upper()).alias(f"{w}_count") for w in ("fail", "warn")))
    return counted.withColumn("failure_rate", E.ratio("fail_count", "total_runs"))


def build_ads(episodes: DataFrame, results: DataFrame) -> dict[str, DataFrame]:
    quality = episode_quality(episodes)
    return {"episode_quality_score": quality, "dataset_quality_summary": dataset_summary(quality), "validator_failure_stats": validator_failures(results)}


# ---------------------------------------------------------------- validation


def not_finite() -> Column:
    bad = F.lit(False)
    for c in ("x", "y", "z", *series.QUATERNION):
        bad = bad | F.isnan(c) | F.col(c).isNull() | (F.abs(F.col(c)) == float("inf"))
    return bad


def schema_measures(bad: Column) -> list[Column]:
    return [F.count("*").alias("n_samples"), F.count_if(bad).alias("n_bad"), *(f(c).alias(f"{c}_{n}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max)))]


def schema_status(least: int = 10) -> Column:
    return E.ladder([((F.col("n_samples") < least) | (F.col("n_bad") > 0), "FAIL")], "PASS")


def schema_check(pose: DataFrame, least: int = 10) -> DataFrame:
    """Enough samples, all numbers finite; ranges of the positions."""
    return pose.groupBy(*EPISODE).agg(*schema_measures(not_finite())).withColumn("status", schema_status(least))


def raw_norm(pose: DataFrame) -> Column:
    return series.norm(*map(F.col, series.QUATERNION)) if "quat_norm" not in pose.columns else F.col("quat_norm")


def quaternion_measures(norm: Column, tolerance: float = 1e-5) -> list[Column]:
    return [F.max(F.abs(norm - 1.0)).alias("quat_max_norm_error"), F.count_if(F.abs(norm - 1.0) > tolerance).alias("num_bad_quaternions")]


def quaternion_status() -> Column:
    return E.ladder([(F.col("num_bad_quaternions") > 0, "FAIL")], "PASS")


def quaternion_check(pose: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    return pose.groupBy(*EPISODE).agg(*quaternion_measures(raw_norm(pose), tolerance)).withColumn("status", quaternion_status())


def euler_measures() -> list[Column]:
    return [f for c in ("roll", "pitch", "yaw") for f in (F.var_pop(c).alias(f"{c}_var"), (F.max(c) - F.min(c)).alias(f"{c}_range"))]


def euler_status(most: float = 1e-3) -> Column:
    return E.ladder([((F.col("roll_var") > most) | (F.col("pitch_var") > most), "FAIL")], "PASS")


def euler_check(features: DataFrame, most: float = 1e-3) -> DataFrame:
    return features.groupBy(*EPISODE).agg(*euler_measures()).withColumn("status", euler_status(most))


def velocity_measures(dt: float = 1 / 30, threshold: float = 2.0) -> list[Column]:
    v = F.when(F.col("frame_idx") > 0, F.col("delta_d") / dt)
    return [F.coalesce(F.max(v), F.lit(0.0)).alias("max_velocity_mps"), F.percentile(v, F.lit(0.95)).alias("p95_velocity_mps"), F.count_if(v > threshold).alias("num_jump_points")]


def velocity_status(threshold: float = 2.0) -> Column:
    return E.ladder([(F.col("max_velocity_mps") > threshold, "FAIL")], "PASS")


def velocity_check(features: DataFrame, dt: float = 1 / 30, threshold: float = 2.0) -> DataFrame:
    """At a constant frame time, unlike the velocities of the features."""
    return features.groupBy(*EPISODE).agg(*velocity_measures(dt, threshold)).withColumn("status", velocity_status(threshold))


def press_status(least: int = 5, most: int = 100) -> Column:
    n = F.col("detected_press_count")
    return E.ladder([(n < least, "FAIL"), (n > most, "WARN")], "PASS")


def press_check(pose: DataFrame, presses: DataFrame, least: int = 5, most: int = 100) -> DataFrame:
    n = presses.groupBy(*EPISODE).agg(F.count("*").alias("detected_press_count"))
    d = pose.groupBy(*EPISODE).agg(F.min("z").alias("z_min"), F.max("z").alias("z_max")).join(n, EPISODE, "left").na.fill(0, ["detected_press_count"])
    return d.withColumn("status", press_status(least, most))


def cluster_measures(events: DataFrame) -> DataFrame:
    """Presses, clusters, their sizes and radii, and the silhouette of each episode that has presses."""
    gap = F.sqrt((F.col("x") - F.col("cluster_center_x")) ** 2 + (F.col("y") - F.col("cluster_center_y")) ** 2)
    clusters = events.groupBy(*EPISODE, "cluster_id").agg(F.count("*").alias("n"), F.max(gap).alias("radius"))
    known = lambda c: F.when(F.col("cluster_id").isNotNull(), F.col(c))
    d = clusters.groupBy(*EPISODE).agg(F.sum("n").alias("presses"), F.nullif(F.count("cluster_id"), F.lit(0)).alias("num_clusters"), F.min(known("n")).alias("min_points"), F.max(known("radius")).alias("max_cluster_radius"), F.avg(known("radius")).alias("mean_cluster_radius"))
    return d.join(press.silhouettes(events, EPISODE), EPISODE, "left")


def cluster_status(expected: int = 5, least: float = 0.7, points: int = 2) -> Column:
    few = (F.coalesce("presses", F.lit(0)) < expected) | F.col("num_clusters").isNull()
    thin = (F.col("num_clusters") < expected) | (F.col("min_points") < points)
    unknown = F.col("cluster_silhouette").isNull() | (F.col("presses") <= expected)
    return E.ladder([(few | thin, "FAIL"), (unknown, "WARN"), (F.col("cluster_silhouette") < least, "FAIL")], "PASS")


def cluster_check(pose: DataFrame, events: DataFrame, expected: int = 5, least: float = 0.7, points: int = 2) -> DataFrame:
    """Sizes, radii and silhouette of press clusters; FAIL where presses are too few to cluster."""
    return pose.select(*EPISODE).distinct().join(cluster_measures(events), EPISODE, "left").withColumn("status", cluster_status(expected, least, points))


def boxes(events: DataFrame, margin: float = 0.5) -> DataFrame:
    """The box of each episode's cluster centres, and by how much it is widened: a share of its longer side."""
    centre = {"x": "cluster_center_x", "y": "cluster_center_y"}
    box = events.where("cluster_id is not null").groupBy(*EPISODE).agg(*(f(c).alias(f"{a}_{n}") for a, c in centre.items() for n, f in (("low", F.min), ("high", F.max))))
    return box.withColumn("pad", F.greatest(F.greatest(F.col("x_high") - F.col("x_low"), F.col("y_high") - F.col("y_low")) * margin, F.lit(1e-6)))


def bbox_measures() -> list[Column]:
    outside = F.lit(False)
    for a in "xy":
        outside = outside | (F.col(a) < F.col(f"{a}_low") - F.col("pad")) | (F.col(a) > F.col(f"{a}_high") + F.col("pad"))
    return [F.avg(outside.cast("double")).alias("outside_ratio"), F.max("pad").alias("pad")]


def bbox_status(most: float = 0.1, fail: bool = False) -> Column:
    return E.ladder([(F.col("pad").isNull(), "FAIL"), (F.col("outside_ratio") > most, "FAIL" if fail else "WARN")], "PASS")


def bbox_check(pose: DataFrame, events: DataFrame, margin: float = 0.5, most: float = 0.1, fail: bool = False) -> DataFrame:
    """Share of frames outside the box of the cluster centres."""
    d = pose.join(boxes(events, margin), EPISODE, "left").groupBy(*EPISODE).agg(*bbox_measures())
    return d.withColumn("status", bbox_status(most, fail)).drop("pad")


#: The metrics of each validator.
METRICS = {
    "schema": ("n_samples", "n_bad", "x_min", "x_max", "y_min", "y_max", "z_min", "z_max"), "quaternion": ("quat_max_norm_error", "num_bad_quaternions"),
    "euler_stability": tuple(f"{c}_{m}" for c in ("roll", "pitch", "yaw") for m in ("var", "range")), "velocity_jump": ("max_velocity_mps", "p95_velocity_mps", "num_jump_points"),
    "press_event": ("z_min", "z_max", "detected_press_count"), "xy_cluster": ("presses", "num_clusters", "min_points", "max_cluster_radius", "mean_cluster_radius", "cluster_silhouette"), "workspace_bbox": ("outside_ratio",),
}


def validate(pose: DataFrame) -> DataFrame:
    """The seven results of each episode: validator_name, status, metrics (a map); see ``worst`` for the episode's status.

    Frames are measured in one aggregate, presses in another; the results are rows of one array per episode."""
    presses = written(press.press_frames(pose, min_distance=24, window=21, nearest=False), "press-frames")
    events = written(press.press_events(pose, presses), "press-events")
    flagged = pose.withColumns({"_bad": not_finite(), "_raw": raw_norm(pose)})
    frames = pose_features(flagged, keep=("_bad", "_raw")).join(boxes(presses), EPISODE, "left")
    measured = frames.groupBy(*EPISODE).agg(*schema_measures(F.col("_bad")), *quaternion_measures(F.col("_raw")), *euler_measures(), *velocity_measures(), *bbox_measures())
    all_of = measured.join(cluster_measures(events), EPISODE, "left").withColumn("detected_press_count", F.coalesce("presses", F.lit(0)))
    status = {"schema": schema_status(), "quaternion": quaternion_status(), "euler_stability": euler_status(), "velocity_jump": velocity_status(), "press_event": press_status(), "xy_cluster": cluster_status(), "workspace_bbox": bbox_status()}
    result = lambda n: F.struct(F.lit(n).alias("validator_name"), status[n].alias("status"), F.create_map(*(x for c in METRICS[n] for x in (F.lit(c), F.col(c).cast("double")))).alias("metrics"))
    return all_of.select(*EPISODE, F.explode(F.array(*map(result, METRICS))).alias("r")).select(*EPISODE, "r.*")


#: Order of severity.
SEVERITY = ("PASS", "SKIPPED", "WARN", "FAIL")


def worst(status: Column | str) -> Column:
    """Aggregate: the worst status of a group."""
    return F.element_at(F.array(*map(F.lit, SEVERITY)), F.max(F.array_position(F.array(*map(F.lit, SEVERITY)), E.col(status))).cast("int"))


# ---------------------------------------------------------------- faults


def inject(pose: DataFrame, kind: str, every: int = 20) -> DataFrame:
    """Poses with one kind of fault, at places given by frame numbers alone."""
    i = F.col("frame_idx")
    hit = i % every == every // 2
    if kind == "velocity_spike":
        return pose.withColumn("x", F.when(hit, F.col("x") + 5.0).otherwise(F.col("x")))
    if kind == "quat_drift":
        return pose.withColumns({q: F.col(q) * (1.0 + i * 1e-3) for q in series.QUATERNION})
    if kind == "missing_press":
        return pose.withColumn("z", F.lit(0.2))
    if kind == "xy_cluster_collapse":
        return pose.withColumns({"x": F.lit(0.0), "y": F.lit(0.0)})
    if kind == "timestamp_jitter":
        return pose.withColumn("timestamp_sec", F.col("timestamp_sec") + F.when(i % 2 == 1, 0.01).otherwise(0.0))
    if kind == "schema_missing_column":
        return pose.drop("qw")
    if kind == "nan_injection":
        return pose.withColumn("z", F.when(hit, float("nan")).otherwise(F.col("z")))
    raise ValueError(f"no such fault: {kind}")


def benchmark_matrix(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """expected: case_id, expected_status, expected_failed; actual: case_id, status, failed (arrays of validators). A case
    passes if both agree; an unrun case is unknown."""
    both = expected.join(actual, "case_id", "left")
    apart = F.size(F.array_except("expected_failed", "failed")) + F.size(F.array_except("failed", "expected_failed"))
    return both.withColumn("passed", F.when(F.col("status").isNotNull(), (F.col("status") == F.col("expected_status")) & (apart == 0)))
