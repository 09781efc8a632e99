"""Segmented scans: running operators over recordings of any length, in parts that run side by side.

A recording is cut into chunks of ``chunk`` frame numbers. Windows run inside a chunk; what a chunk hands on (its last row, its sums, its
sign) is one row per chunk, is carried along the recording in a window over these rows alone, and joined back. So no task
orders a whole recording, and a chain keeps its rows partitioned by (recording, chunk).

The functions give the same rows as those of the same name in ``series``, which is the shorter plan where recordings are short.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_safe_join
from .series import EPISODE, QUATERNION, runs_of, segment_type, turn_back

#: Frame numbers of one chunk.
CHUNK = 100_000


def chunked(df: DataFrame, chunk: int, order: str = "frame_idx") -> DataFrame:
    return df.withColumn("_chunk", F.floor(F.col(order) / chunk))


def inside(order: str = "frame_idx"):
    return Window.partitionBy(*EPISODE, "_chunk").orderBy(order)


def inside_so_far(order: str = "frame_idx"):
    return inside(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def along():
    """Over one row per chunk."""
    return Window.partitionBy(*EPISODE).orderBy("_chunk")


def carried(df: DataFrame, carries: DataFrame) -> DataFrame:
    return null_safe_join(df, carries, [*EPISODE, "_chunk"], "left")


def with_previous(df: DataFrame, values: dict[str, Column], order: str = "frame_idx") -> DataFrame:
    """Adds each value of the frame before, null for a recording's first. ``df`` is chunked."""
    df = df.withColumns({f"_v_{n}": c for n, c in values.items()})
    last = df.groupBy(*EPISODE, "_chunk").agg(F.max_by(F.struct(*(f"_v_{n}" for n in values)), order).alias("_last"))
    df = carried(df, last.select(*EPISODE, "_chunk", F.lag("_last").over(along()).alias("_carry")))
    first = F.row_number().over(inside(order)) == 1
    df = df.withColumns({n: F.when(first, F.col(f"_carry._v_{n}")).otherwise(F.lag(f"_v_{n}").over(inside(order))) for n in values})
    return df.drop("_carry", *(f"_v_{n}" for n in values))


def with_running_sums(df: DataFrame, values: dict[str, Column], order: str = "frame_idx") -> DataFrame:
    """Adds the sum of each value from the recording's start; nulls don't count, before the first value it is null. ``df`` is chunked."""
    df = df.withColumns({f"_v_{n}": c for n, c in values.items()})
    sums = df.groupBy(*EPISODE, "_chunk").agg(*(F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values))
    ahead = along().rowsBetween(Window.unboundedPreceding, -1)
    df = carried(df, sums.select(*EPISODE, "_chunk", *(F.sum(f"_s_{n}").over(ahead).alias(f"_c_{n}") for n in values)))
    here = {n: F.sum(f"_v_{n}").over(inside_so_far(order)) for n in values}
    df = df.withColumns({n: F.coalesce(h + F.col(f"_c_{n}"), h, F.col(f"_c_{n}")) for n, h in here.items()})
    return df.drop(*(f"{p}_{n}" for n in values for p in ("_v", "_c")))


def integrated(df: DataFrame, deltas: tuple[str, ...] = ("dx", "dy", "dz"), chunk: int = CHUNK) -> DataFrame:
    return with_running_sums(chunked(df, chunk), {c[1:]: F.col(c) for c in deltas}).drop("_chunk")


def continuous(df: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A chunk hands on whether it has a zero dot, and its flips since the last one (or since its start)."""
    df = with_previous(chunked(df, chunk), {f"_p_{q}": F.col(q) for q in QUATERNION})
    dot = sum((F.col(q) * F.col(f"_p_{q}") for q in QUATERNION[1:]), F.col("qx") * F.col("_p_qx"))
    df = df.withColumn("_dot", F.coalesce(dot, F.lit(1.0)))
    df = df.withColumn("_zero", F.sum((F.col("_dot") == 0).cast("int")).over(inside_so_far()))
    since = Window.partitionBy(*EPISODE, "_chunk", "_zero").orderBy("frame_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("_flips", F.sum((F.col("_dot") < 0).cast("int")).over(since))
    each = df.groupBy(*EPISODE, "_chunk").agg(F.max_by("_flips", "frame_idx").alias("_out"), (F.max("_zero") > 0).cast("int").alias("_reset"))
    each = each.withColumn("_group", F.sum("_reset").over(along().rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    upto = Window.partitionBy(*EPISODE, "_group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("_after", F.sum("_out").over(upto))
    df = carried(df, each.select(*EPISODE, "_chunk", F.coalesce(F.lag("_after").over(along()), F.lit(0)).alias("_in")))
    flips = F.col("_flips") + F.when(F.col("_zero") == 0, F.col("_in")).otherwise(0)
    df = df.withColumn("_sign", F.when(flips % 2 == 1, -1.0).otherwise(1.0)).withColumns({q: F.col(q) * F.col("_sign") for q in QUATERNION})
    return df.drop("_chunk", "_dot", "_zero", "_flips", "_in", "_sign", *(f"_p_{q}" for q in QUATERNION))


def unwrapped(df: DataFrame, names: tuple[str, ...] = ("roll", "pitch", "yaw"), chunk: int = CHUNK) -> DataFrame:
    df = with_previous(chunked(df, chunk), {f"_p_{c}": F.col(c) for c in names})
    df = with_running_sums(df, {f"_t_{c}": F.coalesce(turn_back(F.col(c) - F.col(f"_p_{c}"), F.lit(2 * pi)), F.lit(0.0)) for c in names})
    return df.withColumns({c: F.col(c) + F.col(f"_t_{c}") for c in names}).drop("_chunk", *(f"_{p}_{c}" for c in names for p in "pt"))


def segments(df: DataFrame, quiet: float = 0.05, chunk: int = CHUNK) -> DataFrame:
    """A run that goes on over chunks is one: runs are numbered by a running sum of their starts."""
    df = with_previous(chunked(df, chunk).withColumn("segment_type", segment_type(quiet)), {"_before": F.col("segment_type")})
    df = df.withColumn("_new", F.coalesce(F.col("segment_type") != F.col("_before"), F.lit(True)))
    return runs_of(with_running_sums(df, {"_place": F.col("_new").cast("int")}).withColumn("_run", F.col("_place") - 1))
