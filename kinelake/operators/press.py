"""Press detection and clustering: the one family that needs a signal algorithm per episode, in numpy.

An episode's frames come together as one row of lists; a row is one recording, of bounded length. Python takes many rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .series import EPISODE


@lru_cache(64)
def middle_weights(window: int, order: int) -> np.ndarray:
    places = np.arange(-(window // 2), window // 2 + 1)
    return np.linalg.pinv(np.vander(places, order + 1, increasing=True))[0]


def smoothed(z: np.ndarray, window: int, order: int, nearest: bool = True) -> np.ndarray:
    """Savitzky-Golay: the value at the middle of a polynomial fitted to each window. At the ends the series is continued
    by its end values, or (not ``nearest``) the first and last window's polynomial is used."""
    half = window // 2
    places = np.arange(-half, half + 1)
    weights = middle_weights(window, order)
    if nearest:
        return np.convolve(np.pad(z, half, mode="edge"), weights[::-1], "valid")
    out = np.convolve(np.pad(z, half, mode="edge"), weights[::-1], "valid")
    for part, at in ((slice(0, window), slice(0, half)), (slice(len(z) - window, len(z)), slice(len(z) - half, len(z)))):
        fit = np.polynomial.polynomial.polyfit(places, z[part], order)
        out[at] = np.polynomial.polynomial.polyval(places, fit)[:half] if at.start == 0 else np.polynomial.polynomial.polyval(places, fit)[-half:]
    return out


def local_maxima(x: np.ndarray) -> np.ndarray:
    """Places higher than both sides; the middle of a flat top."""
    if len(x) < 3:
        return np.zeros(0, int)
    starts = np.concatenate([[0], np.flatnonzero(np.diff(x) != 0) + 1])
    ends = np.concatenate([starts[1:], [len(x)]]) - 1
    v = x[starts]
    top = np.flatnonzero((v[1:-1] > v[:-2]) & (v[1:-1] > v[2:])) + 1
    return (starts[top] + ends[top]) // 2


def apart(peaks: np.ndarray, height: np.ndarray, distance: int) -> np.ndarray:
    """Peaks left when, from the highest on, each removes those nearer than ``distance``."""
    keep = np.ones(len(peaks), bool)
    low, high = np.searchsorted(peaks, peaks - distance, "right"), np.searchsorted(peaks, peaks + distance, "left")  # peaks are in order
    for i in np.argsort(height, kind="stable")[::-1]:
        if keep[i]:
            keep[low[i] : high[i]] = False
            keep[i] = True
    return peaks[keep]


def before_higher(side: np.ndarray, top: float) -> np.ndarray:
    """The values before the first one above ``top``, looked for in steps that grow."""
    n = 64
    while not len(up := np.flatnonzero(side[:n] > top)) and n < len(side):
        n *= 4
    return side[: up[0]] if len(up) else side


def prominences(x: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """Height above the higher of the two lowest points before a higher value on either side."""
    out = np.empty(len(peaks))
    for k, p in enumerate(peaks):
        left, right = before_higher(x[:p][::-1], x[p]), before_higher(x[p + 1 :], x[p])
        out[k] = x[p] - max(left.min(initial=x[p]), right.min(initial=x[p]))
    return out


def detected(z: np.ndarray, min_distance: int = 5, prominence: float | None = None, window: int = 31, order: int = 3, nearest: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Frames of presses (prominent minima in the lower 60 percent) and their prominences."""
    n = len(z)
    w = min(window, n if n % 2 else n - 1)
    s = smoothed(z, w, min(order, w - 1), nearest) if n >= 7 and w >= 5 else z.astype(float)
    peaks = apart(p := local_maxima(-s), -s[p], min_distance)
    height = prominences(-s, peaks)
    least = max((s.max() - s.min()) * 0.05, 1e-6) if prominence is None and n else prominence
    chosen = (height >= least) & (s[peaks] <= np.quantile(s, 0.6)) if len(peaks) else np.zeros(0, bool)
    return peaks[chosen], height[chosen]


def clustered(xy: np.ndarray, k: int, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """k-means by Lloyd's steps from farthest-first seeds; clusters numbered by their centres' order."""
    seeds = [int(np.argmin(((xy - xy.mean(0)) ** 2).sum(1)))]
    gap = ((xy - xy[seeds[0]]) ** 2).sum(1)
    while len(seeds) < k:
        seeds.append(int(gap.argmax()))
        gap = np.minimum(gap, ((xy - xy[seeds[-1]]) ** 2).sum(1))
    centre = xy[seeds].astype(float)
    for _ in range(rounds):
        label = ((xy[:, None] - centre[None]) ** 2).sum(2).argmin(1)
        moved = np.array([xy[label == c].mean(0) if (label == c).any() else centre[c] for c in range(k)])
        if np.array_equal(moved, centre):
            break
        centre = moved
    order = np.lexsort((centre[:, 1], centre[:, 0]))
    return np.argsort(order)[label], centre[order]


EVENTS = "dataset_id string, version string, episode_id string, frame_idx long, cluster_id int, cluster_center_x double, cluster_center_y double, z_prominence double"
NAMES = [c.split()[0] for c in EVENTS.split(", ")]


def listed(df: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """One row per group with the list ``_rows`` of its rows. Groups go to as many tasks as a shuffle has partitions: the work per
    byte is high, so tasks must not be put together by bytes."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(*group, F.struct(*columns).alias("_rows")).repartition(parts, *group).groupBy(*group).agg(F.collect_list("_rows").alias("_rows"))


def numbers(rows: pa.StructArray, name: str) -> np.ndarray:
    return rows.field(name).cast(pa.float64()).to_numpy(zero_copy_only=False)


def press_frames(pose: DataFrame, min_distance: int = 5, expected: int = 5, window: int = 31, nearest: bool = True) -> DataFrame:
    """One row per press: its frame, cluster and prominence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes = batch.column("_rows").flatten(), batch.column("_rows").value_lengths().to_numpy()
            frame = rows.field("frame_idx")
            order = np.lexsort((frame.fill_null(2**63 - 1).to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)))
            x, y, z = (numbers(rows, c)[order] for c in "xyz")
            ends = np.cumsum(sizes)
            owners, places, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((0, 4))]
            for k, (a, b) in enumerate(zip(ends - sizes, ends)):
                at, height = detected(z[a:b], min_distance, window=window, nearest=nearest)
                out = np.full((len(at), 4), np.nan)
                out[:, 3] = height
                if len(at) >= max(2, expected):
                    label, centre = clustered(np.column_stack([x[a:b][at], y[a:b][at]]), min(expected, len(at)))
                    out[:, 0], out[:, 1:3] = label, centre[label]
                owners.append(np.full(len(at), k))
                places.append(order[a + at])
                found.append(out)
            owner, v = pa.array(np.concatenate(owners)), np.concatenate(found)
            cluster, *others = (pa.array(v[:, c], from_pandas=True) for c in range(4))  # not a number: null
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(owner) for c in EPISODE), frame.take(pa.array(np.concatenate(places))), cluster.cast(pa.int32()), *others], names=NAMES)

    return listed(pose, EPISODE, ["frame_idx", "x", "y", "z"]).mapInArrow(run, EVENTS)


def press_events(pose: DataFrame, frames: DataFrame) -> DataFrame:
    """Events with id, time and place, numbered in order within the episode."""
    place = F.row_number().over(Window.partitionBy(*EPISODE).orderBy("frame_idx")) - 1
    both = frames.join(pose.select(*EPISODE, "frame_idx", "timestamp_sec", "x", "y", "z"), [*EPISODE, "frame_idx"])
    name = F.concat("episode_id", F.lit("-press-"), F.lpad(place.cast("string"), 4, "0"))
    return both.select(name.alias("event_id"), *EPISODE, "frame_idx", "timestamp_sec", "x", "y", "z", "cluster_id", "cluster_center_x", "cluster_center_y", "z_prominence")


def silhouette(x: np.ndarray, y: np.ndarray, label: np.ndarray, block: int = 512) -> float | None:
    """Mean silhouette of labelled points; distances are summed by cluster for ``block`` points at a time.

    A point alone in its cluster counts 0; with one cluster there is none."""
    names, own = np.unique(label, return_inverse=True)
    if len(names) < 2:
        return None
    member = (own[:, None] == np.arange(len(names))).astype(float)
    size, total = member.sum(0), 0.0
    for s in range(0, len(x), block):
        part = slice(s, s + block)
        sums = np.sqrt((x[part, None] - x) ** 2 + (y[part, None] - y) ** 2) @ member
        mine = own[part]
        rows = np.arange(len(mine))
        a = sums[rows, mine] / np.maximum(size[mine] - 1, 1)
        means = sums / size
        means[rows, mine] = np.inf
        b = means.min(1)
        most = np.maximum(a, b)
        total += np.where((size[mine] > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1.0), 0.0).sum()
    return total / len(x)


def silhouettes(points: DataFrame, group: list[str], label: str = "cluster_id", x: str = "x", y: str = "y") -> DataFrame:
    """Mean silhouette of each group's clustered points (one recording's presses)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes = batch.column("_rows").flatten(), batch.column("_rows").value_lengths().to_numpy()
            px, py, own = numbers(rows, "_x"), numbers(rows, "_y"), rows.field("_label").to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            found = [silhouette(px[a:b], py[a:b], own[a:b]) for a, b in zip(ends - sizes, ends)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in group), pa.array(found, pa.float64(), from_pandas=True)], names=[*group, "cluster_silhouette"])

    kinds = ", ".join(f"{g} {points.schema[g].dataType.simpleString()}" for g in group)
    p = points.where(F.col(label).isNotNull()).select(*group, F.col(label).alias("_label"), F.col(x).alias("_x"), F.col(y).alias("_y"))
    return listed(p, group, ["_label", "_x", "_y"]).mapInArrow(run, f"{kinds}, cluster_silhouette double")
