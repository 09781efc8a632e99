"""Press detection over rows of lists: dealt over all tasks, in any order of frames, on long recordings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.operators import press, series

def recordings(spark, n, frames):
    rows = spark.range(n * frames, numPartitions=4).select(F.concat(F.lit("d"), F.col("id") % n % 7).alias("dataset_id"), F.concat(F.lit("v"), F.col("id") % n % 2).alias("version"), (F.col("id") % n).cast("string").alias("episode_id"), F.floor(F.col("id") / n).alias("frame_idx"))
    return rows.withColumns({"x": F.col("frame_idx") % 3 + F.col("frame_idx") / 1e4, "y": F.col("frame_idx") % 5 / 1e3, "z": F.cos(F.col("frame_idx") / 4)})


@pytest.mark.parametrize("make", [press.press_frames, lambda p: press.silhouettes(p.withColumn("cluster_id", (F.col("x") > 1).cast("int")), series.EPISODE)])
def test_small_recordings_go_to_all_tasks(spark, make):
    out = make(recordings(spark, 200, 60))
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_frames_in_any_order_and_missing_values(spark):
    p = recordings(spark, 3, 90)
    want = sorted(map(repr, press.press_frames(p).collect()))
    assert len(want) > 6 and want == sorted(map(repr, press.press_frames(p.orderBy(F.desc("frame_idx"))).collect()))
    empty = press.press_frames(p.where("frame_idx < 0"))
    assert empty.columns == press.NAMES and empty.count() == 0
    few = press.press_frames(p, expected=50).select("cluster_id", "cluster_center_x", "z_prominence").collect()
    assert few and all(r.cluster_id is None and r.cluster_center_x is None and r.z_prominence is not None for r in few)


def test_peaks_of_long_series_equal_whole_scans():
    x = np.random.default_rng(1).normal(size=3000).round(1)
    peaks = press.local_maxima(x)
    for k, p in zip(peaks, press.prominences(x, peaks)):
        left, right = np.flatnonzero(x[:k] > x[k]), np.flatnonzero(x[k + 1 :] > x[k])
        a, b = left[-1] + 1 if len(left) else 0, k + 1 + right[0] if len(right) else len(x)
        assert p == x[k] - max(x[a : k + 1].min(), x[k:b].min())
