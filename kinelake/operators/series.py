"""Pose series: every operator works on one row per frame, keyed by episode and ordered by ``frame_idx``.

All windows share one partitioning and order, so a chain of them costs one exchange and one sort.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPISODE = ["dataset_id", "version", "episode_id"]
QUATERNION = ("qx", "qy", "qz", "qw")
TINY = 1e-12


def in_order(order: str = "frame_idx"):
    return Window.partitionBy(*EPISODE).orderBy(order)


def so_far(order: str = "frame_idx"):
    return in_order(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def norm(*parts: Column) -> Column:
    return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


# ---------------------------------------------------------------- order and time


def renumbered(df: DataFrame, *order: str) -> DataFrame:
    """frame_idx 0, 1, … per episode by the given order."""
    w = Window.partitionBy(*EPISODE).orderBy(*order)
    return df.withColumn("frame_idx", (F.row_number().over(w) - 1).cast("long"))


def timestamps(df: DataFrame, fps: float = 30.0, duration: str | None = None) -> DataFrame:
    """timestamp_sec: spread evenly over a duration if one is known, else by frame rate."""
    i, n = F.col("frame_idx"), F.count("*").over(Window.partitionBy(*EPISODE))
    by_rate = i / F.lit(float(fps))
    spread = F.when(n > 1, F.col(duration) * i / (n - 1)).otherwise(0.0) if duration else F.lit(None)
    return df.withColumn("timestamp_sec", F.coalesce(spread, by_rate) if duration else by_rate)


def frame_rates(df: DataFrame, time: str = "timestamp_sec") -> DataFrame:
    """Median positive step of each episode (dt) and the rate 1 / dt; null if time never advances."""
    step = F.col(time) - F.lag(time).over(in_order())
    steps = df.select(*EPISODE, step.alias("step"))
    return steps.groupBy(*EPISODE).agg(F.percentile(F.when(F.col("step") > TINY, F.col("step")), F.lit(0.5)).alias("dt")).withColumn("fps", 1.0 / F.col("dt"))


# ---------------------------------------------------------------- position


def finite(df: DataFrame, columns: tuple[str, ...] = ("x", "y", "z", *QUATERNION)) -> DataFrame:
    """Non-finite numbers become 0; a zero quaternion becomes the identity."""
    clean = {c: F.when(F.isnan(c) | (F.abs(F.col(c)) == float("inf")) | F.col(c).isNull(), 0.0).otherwise(F.col(c)) for c in columns}
    df = df.withColumns(clean)
    if set(QUATERNION) <= set(columns):
        df = df.withColumn("qw", F.when(norm(*map(F.col, QUATERNION)) < TINY, 1.0).otherwise(F.col("qw")))
    return df


def motion(df: DataFrame, threshold: float = 2.5) -> DataFrame:
    """delta_d, velocity_mps (0 for a first frame or where time doesn't advance), is_velocity_jump."""
    w = in_order()
    before = {c: F.lag(c).over(w) for c in ("x", "y", "z", "timestamp_sec")}
    df = df.withColumn("delta_d", F.coalesce(norm(*(F.col(c) - before[c] for c in "xyz")), F.lit(0.0)))
    step = F.col("timestamp_sec") - before["timestamp_sec"]
    df = df.withColumn("velocity_mps", F.when(step > TINY, F.col("delta_d") / step).otherwise(0.0))
    return df.withColumn("is_velocity_jump", F.col("velocity_mps") > threshold)


def integrated(df: DataFrame, deltas: tuple[str, ...] = ("dx", "dy", "dz")) -> DataFrame:
    """Positions as running sums of delta actions."""
    return df.withColumns({c[1:]: F.sum(c).over(so_far()) for c in deltas})


# ---------------------------------------------------------------- orientation


def unit_quaternions(df: DataFrame) -> DataFrame:
    """quat_norm of the raw quaternion, and the quaternion scaled to length one."""
    df = df.withColumn("quat_norm", norm(*map(F.col, QUATERNION)))
    return df.withColumns({q: F.col(q) / F.greatest("quat_norm", F.lit(TINY)) for q in QUATERNION})


def continuous(df: DataFrame) -> DataFrame:
    """Flips signs so that neighbours never have a negative dot product.

    The flips of a frame are the negative dots since the last zero dot (after which the sign starts anew at plus).
    """
    w = in_order()
    dot = sum((F.col(q) * F.lag(q).over(w) for q in QUATERNION[1:]), F.col("qx") * F.lag("qx").over(w))
    df = df.withColumn("_dot", F.coalesce(dot, F.lit(1.0)))
    df = df.withColumn("_zero", F.sum(F.when(F.col("_dot") == 0, 1).otherwise(0)).over(so_far()))
    since = Window.partitionBy(*EPISODE, "_zero").orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = F.sum(F.when(F.col("_dot") < 0, 1).otherwise(0)).over(since)
    sign = F.when(flips % 2 == 1, -1.0).otherwise(1.0)
    return df.withColumn("_sign", sign).withColumns({q: F.col(q) * F.col("_sign") for q in QUATERNION}).drop("_dot", "_zero", "_sign")


def euler_angles(df: DataFrame, names: tuple[str, str, str] = ("roll", "pitch", "yaw")) -> DataFrame:
    """Angles about the fixed axes x, y, z of unit quaternions."""
    x, y, z, w = map(F.col, QUATERNION)
    sine = F.least(F.greatest(2.0 * (w * y - z * x), F.lit(-1.0)), F.lit(1.0))
    found = (F.atan2(2.0 * (w * x + y * z), 1.0 - 2.0 * (x * x + y * y)), F.asin(sine), F.atan2(2.0 * (w * z + x * y), 1.0 - 2.0 * (y * y + z * z)))
    return df.withColumns(dict(zip(names, found)))


def turn_back(step: Column, turn: Column) -> Column:
    """What a step between two angles needs to be at most half a turn."""
    folded = step + F.lit(pi) - F.floor((step + F.lit(pi)) / turn) * turn - F.lit(pi)
    folded = F.when((folded == -pi) & (step > 0), F.lit(pi)).otherwise(folded)
    return F.when(F.abs(step) < pi, 0.0).otherwise(folded - step)


def unwrapped(df: DataFrame, names: tuple[str, ...] = ("roll", "pitch", "yaw")) -> DataFrame:
    """Removes jumps of more than pi between frames by whole turns."""
    w = in_order()
    turn = F.lit(2 * pi)
    for c in names:
        df = df.withColumn(f"_{c}", F.coalesce(turn_back(F.col(c) - F.lag(c).over(w), turn), F.lit(0.0)))
    return df.withColumns({c: F.col(c) + F.sum(f"_{c}").over(so_far()) for c in names}).drop(*(f"_{c}" for c in names))


def from_euler(df: DataFrame, names: tuple[str, str, str] = ("roll", "pitch", "yaw")) -> DataFrame:
    """Quaternions of angles about the fixed axes x, y, z."""
    (sr, cr), (sp, cp), (sy, cy) = ((F.sin(F.col(n) / 2), F.cos(F.col(n) / 2)) for n in names)
    return df.withColumns({"qx": sr * cp * cy - cr * sp * sy, "qy": cr * sp * cy + sr * cp * sy, "qz": cr * cp * sy - sr * sp * cy, "qw": cr * cp * cy + sr * sp * sy})


# ---------------------------------------------------------------- segments


def segment_type(quiet: float) -> Column:
    return F.when(F.col("is_press_candidate"), "PRESS").when(F.col("velocity_mps") <= quiet, "QUIET").otherwise("MOVE")


def segments(df: DataFrame, quiet: float = 0.05) -> DataFrame:
    """One row per run of PRESS, QUIET or MOVE frames (press before quiet before move). The first step into a run is not
    part of its distance."""
    w = in_order()
    df = df.withColumn("segment_type", segment_type(quiet))
    df = df.withColumn("_new", F.coalesce(F.col("segment_type") != F.lag("segment_type").over(w), F.lit(True)))
    return runs_of(df.withColumn("_run", F.sum(F.col("_new").cast("int")).over(so_far()) - 1))


def runs_of(df: DataFrame) -> DataFrame:
    """Segments from frames with the number of their run (_run) and whether they start it (_new)."""
    runs = df.groupBy(*EPISODE, "_run", "segment_type").agg(
        F.min("frame_idx").alias("start_frame"),
        F.max("frame_idx").alias("end_frame"),
        F.min_by("timestamp_sec", "frame_idx").alias("start_time_sec"),
        F.max_by("timestamp_sec", "frame_idx").alias("end_time_sec"),
        F.sum(F.when(F.col("_new"), 0.0).otherwise(F.col("delta_d"))).alias("distance"),
    )
    name = F.concat(F.col("episode_id"), F.lit("-seg-"), F.lpad(F.col("_run").cast("string"), 4, "0"))
    return runs.select(name.alias("segment_id"), *EPISODE, "start_frame", "end_frame", "start_time_sec", "end_time_sec", "segment_type", (F.col("end_time_sec") - F.col("start_time_sec")).alias("duration_sec"), "distance")


def episode_summary(features: DataFrame) -> DataFrame:
    """Counts, ranges, velocity statistics and angle variances of each episode."""
    span = F.max_by("timestamp_sec", "frame_idx") - F.min_by("timestamp_sec", "frame_idx")
    return features.groupBy(*EPISODE).agg(
        F.count("*").alias("num_samples"),
        span.alias("duration_sec"),
        F.min("z").alias("z_min"),
        F.max("z").alias("z_max"),
        F.max("velocity_mps").alias("max_velocity_mps"),
        F.avg("velocity_mps").alias("mean_velocity_mps"),
        F.percentile("velocity_mps", F.lit(0.95)).alias("p95_velocity_mps"),
        F.max(F.abs(F.col("quat_norm") - 1.0)).alias("quat_max_norm_error"),
        *(F.var_pop(c).alias(f"{c}_var") for c in ("roll", "pitch", "yaw")),
    )
