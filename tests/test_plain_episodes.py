"""Whole episodes against plain loops: presses, clusters, features, scores, validators."""

import math
from collections import defaultdict
from itertools import groupby

import numpy as np
import pytest

from kinelake.fixtures import frame
from kinelake.registry import QUERIES

TAU = 2 * math.pi


@pytest.fixture(scope="module")
def episodes(spark, sf):
    out = defaultdict(list)
    for r in frame(spark, sf, "fx_pose").collect():
        out[r.dataset_id, r.version, r.episode_id].append(r)
    return {k: sorted(v, key=lambda r: r.frame_idx) for k, v in out.items()}


def keyed(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.dataset_id, r.version, r.episode_id].append(r)
    return out


# ---------------------------------------------------------------- presses


def smooth(z, window, nearest):
    n = len(z)
    window = min(window, n if n % 2 else n - 1)
    if n < 7 or window < 5:
        return list(z)
    half, order = window // 2, min(3, window - 1)
    at = np.arange(-half, half + 1)
    out = []
    for i in range(n):
        if nearest or half <= i < n - half:
            out.append(np.polyval(np.polyfit(at, [z[min(max(i + k, 0), n - 1)] for k in at], order), 0))
        else:
            start = 0 if i < half else n - window
            out.append(np.polyval(np.polyfit(at, z[start : start + window], order), i - start - half))
    return out


def presses(z, distance, window, nearest):
    """Frames of prominent minima, and their prominences."""
    s = [-v for v in smooth(z, window, nearest)]
    runs, i = [], 0
    for _, group in groupby(s):
        n = len(list(group))
        runs.append((i, i + n - 1))
        i += n
    tops = [(a + b) // 2 for (p, (a, b), q) in zip(runs, runs[1:], runs[2:]) if s[p[0]] < s[a] > s[q[0]]]
    kept = []
    for p in sorted(tops, key=lambda p: -s[p]):
        if all(abs(p - q) >= distance for q in kept):
            kept.append(p)
    out = []
    limit, cut = max((max(s) - min(s)) * 0.05, 1e-6), np.quantile([-v for v in s], 0.6)
    for p in sorted(kept):
        low = []
        for step in (-1, 1):
            q, least = p, s[p]
            while 0 <= q + step < len(s) and s[q + step] <= s[p]:
                q += step
                least = min(least, s[q])
            low.append(least)
        height = s[p] - max(low)
        if height >= limit and -s[p] <= cut:
            out.append((p, height))
    return out


def k_means(points, k):
    gap = lambda a, b: (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2
    mean = [sum(p[c] for p in points) / len(points) for c in (0, 1)]
    seeds = [min(range(len(points)), key=lambda i: gap(points[i], mean))]
    while len(seeds) < k:
        seeds.append(max(range(len(points)), key=lambda i: min(gap(points[i], points[s]) for s in seeds)))
    centres = [points[s] for s in seeds]
    for _ in range(100):
        label = [min(range(k), key=lambda c: gap(p, centres[c])) for p in points]
        groups = [[p for p, at in zip(points, label) if at == c] for c in range(k)]
        moved = [(sum(x for x, _ in g) / len(g), sum(y for _, y in g) / len(g)) if g else centres[c] for c, g in enumerate(groups)]
        if all(gap(a, b) < 1e-26 for a, b in zip(moved, centres)):
            break
        centres = moved
    order = sorted(range(k), key=lambda c: centres[c])
    return [order.index(at) for at in label], [centres[c] for c in order]


def silhouette(points, label):
    each = []
    for i, p in enumerate(points):
        far = defaultdict(list)
        for j, q in enumerate(points):
            if i != j:
                far[label[j]].append(math.dist(p, q))
        own, other = far.pop(label[i], None), [sum(d) / len(d) for d in far.values()]
        if other:
            a, b = (sum(own) / len(own) if own else None), min(other)
            each.append(0.0 if a is None or max(a, b) == 0 else (b - a) / max(a, b))
    return sum(each) / len(each) if each else None


def events(rows, distance=5, window=31, nearest=True, expected=5):
    found = presses([r.z for r in rows], distance, window, nearest)
    points = [(rows[p].x, rows[p].y) for p, _ in found]
    label, centres = k_means(points, min(expected, len(points))) if len(points) >= max(2, expected) else ([None] * len(points), [])
    return found, points, label, centres


def close(a, b, tolerance=2e-6):
    return a is b is None or a is not None and b is not None and math.isclose(a, b, abs_tol=tolerance, rel_tol=1e-9)


def test_press_frames_events_and_clusters(spark, sf, episodes):
    got, named, grouped = (keyed(QUERIES[q](spark, sf)) for q in ("T12_press_frames", "T14_press_events", "T13_press_clusters"))
    some = 0
    for key, rows in episodes.items():
        found, points, label, centres = events(rows)
        mine = sorted(got[key], key=lambda r: r.frame_idx)
        assert [r.frame_idx for r in mine] == [rows[p].frame_idx for p, _ in found]
        assert [r.cluster_id for r in mine] == label and all(close(r.z_prominence, h) for r, (_, h) in zip(mine, found))
        assert all(close(r.cluster_center_x, centres[c][0]) and close(r.cluster_center_y, centres[c][1]) for r, c in zip(mine, label) if c is not None)
        assert sorted((r.event_id, r.frame_idx) for r in named[key]) == [(f"{key[2]}-press-{n:04d}", rows[p].frame_idx) for n, (p, _) in enumerate(found)]
        assert all(close(r.x, x) and close(r.y, y) for r, (x, y) in zip(sorted(named[key], key=lambda r: r.frame_idx), points))
        _, _, label, centres = events(rows, expected=3)
        assert sorted((r.cluster_id, r.n) for r in grouped[key]) == [(c, label.count(c)) for c in range(len(centres)) if c in label]
        some += len(found)
    assert some > len(episodes)


# ---------------------------------------------------------------- features and scores


def features(rows):
    out, before, sign, turns = [], None, 1.0, [0.0] * 3
    for r in rows:
        q = [r.qx, r.qy, r.qz, r.qw]
        raw = math.sqrt(sum(c * c for c in q))
        q = [c / max(raw, 1e-12) for c in q]
        if before:
            dot = sum(a * b for a, b in zip(before["unit"], q)) * sign
            sign = (1.0 if dot >= 0 else -1.0) if dot != 0 else 1.0
        unit, (x, y, z, w) = q, [c * sign for c in q]
        angles = [math.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)), math.asin(max(-1.0, min(1.0, 2 * (w * y - z * x)))), math.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))]
        step = math.dist((r.x, r.y, r.z), before["at"]) if before else 0.0
        passed = r.timestamp_sec - before["time"] if before else 0.0
        if before:
            turns = [t - TAU * round((a - b) / TAU) if abs(a - b) > math.pi else t for t, a, b in zip(turns, angles, before["angles"])]
        out.append({"norm": raw, "step": step, "speed": step / passed if passed > 1e-12 else 0.0, "turned": [a + t for a, t in zip(angles, turns)]})
        before = {"unit": unit, "at": (r.x, r.y, r.z), "time": r.timestamp_sec, "angles": angles}
    return out


def episode_feature(rows):
    f, (found, points, label, _) = features(rows), events(rows)
    speed = [x["speed"] for x in f]
    shape = silhouette(points, label) if label and label[0] is not None else None
    return {
        "num_samples": len(rows), "max_velocity_mps": max(speed), "mean_velocity_mps": sum(speed) / len(speed), "p95_velocity_mps": float(np.quantile(speed, 0.95)),
        "quat_max_norm_error": max(abs(x["norm"] - 1) for x in f), "detected_press_count": len(found), "cluster_silhouette": shape, "z_min": min(r.z for r in rows),
        "z_max": max(r.z for r in rows), "duration_sec": rows[-1].timestamp_sec - rows[0].timestamp_sec,
    } | {f"{n}_var": float(np.var([x["turned"][i] for x in f])) for i, n in enumerate(("roll", "pitch", "yaw"))}


def test_episode_features(spark, sf, episodes):
    got = keyed(QUERIES["P2_episode_feature"](spark, sf))
    assert set(got) == set(episodes)
    for key, rows in episodes.items():
        (r,), want = got[key], episode_feature(rows)
        assert all(close(r[c], v) for c, v in want.items()), (key, {c: (r[c], v) for c, v in want.items() if not close(r[c], v)})


def test_dataset_summary(spark, sf, episodes):
    clip = lambda v, high: max(0.0, min(high, v))
    score, out = {}, defaultdict(list)
    for key, rows in episodes.items():
        e = episode_feature(rows)
        loss = clip((e["max_velocity_mps"] - 2.5) * 5, 30.0) + clip((e["quat_max_norm_error"] - 1e-3) * 200, 30.0) + clip(abs(e["detected_press_count"] - 25) - 5, 20.0)
        loss += clip((0.5 - (-0.1 if e["cluster_silhouette"] is None else e["cluster_silhouette"])) * 40, 20.0)
        score[key] = clip(100 - loss, 100.0)
        out[key[:2]].append((score[key], e["detected_press_count"]))
    got = {(r.dataset_id, r.version): r for r in QUERIES["P3_build_ads"](spark, sf).collect()}
    assert set(got) == set(out)
    for key, mine in out.items():
        assert got[key].num_episodes == len(mine) and got[key].total_press_count == sum(n for _, n in mine)
        assert close(got[key].avg_quality_score, sum(s for s, _ in mine) / len(mine)) and close(got[key].pass_rate, sum(s >= 80 for s, _ in mine) / len(mine))


# ---------------------------------------------------------------- validators


def verdicts(rows):
    f, (found, points, label, centres) = features(rows), events(rows, 24, 21, False)
    turned = list(zip(*(x["turned"] for x in f)))
    speed = [x["step"] * 30 for x in f[1:]]
    sizes = [label.count(c) for c in range(len(centres)) if c in label]
    if len(points) < 5 or len(sizes) < 5 or min(sizes) < 2:
        cluster = "FAIL"
    else:
        shape = silhouette(points, label)
        cluster = "WARN" if shape is None or len(points) <= 5 else "FAIL" if shape < 0.7 else "PASS"
    used = [centres[c] for c in range(len(centres)) if c in label]
    if used:
        (x0, x1), (y0, y1) = ((min(c[i] for c in used), max(c[i] for c in used)) for i in (0, 1))
        pad = max(max(x1 - x0, y1 - y0) * 0.5, 1e-6)
        outside = sum(not (x0 - pad <= r.x <= x1 + pad and y0 - pad <= r.y <= y1 + pad) for r in rows) / len(rows)
    return {
        "schema": "FAIL" if len(rows) < 10 else "PASS",
        "quaternion": "FAIL" if any(abs(x["norm"] - 1) > 1e-5 for x in f) else "PASS",
        "euler_stability": "FAIL" if np.var(turned[0]) > 1e-3 or np.var(turned[1]) > 1e-3 else "PASS",
        "velocity_jump": "FAIL" if speed and max(speed) > 2.0 else "PASS",
        "press_event": "FAIL" if len(found) < 5 else "WARN" if len(found) > 100 else "PASS",
        "xy_cluster": cluster,
        "workspace_bbox": "FAIL" if not used else "WARN" if outside > 0.1 else "PASS",
    }


def test_validators_and_their_failures(spark, sf, episodes):
    got = {(k, r.validator_name): r.status for k, rs in keyed(QUERIES["P13_validate"](spark, sf)).items() for r in rs}
    want = {(k, name): status for k, rows in episodes.items() for name, status in verdicts(rows).items()}
    assert got == want
    for r in QUERIES["A8_validator_failures"](spark, sf).collect():
        mine = [s for (_, name), s in want.items() if name == r.validator_name]
        assert (r.total_runs, r.fail_count, r.warn_count) == (len(mine), mine.count("FAIL"), mine.count("WARN")) and close(r.failure_rate, mine.count("FAIL") / len(mine))


def test_cluster_quality_ladder(spark, sf, episodes):
    got = {k: r[0] for k, r in keyed(QUERIES["T17_cluster_quality"](spark, sf)).items()}
    for key, rows in episodes.items():
        _, points, label, centres = events(rows)
        sizes = [label.count(c) for c in range(len(centres)) if c in label]
        shape = silhouette(points, label) if sizes else None
        want = "FAIL" if len(points) < 5 or len(sizes) < 5 or min(sizes) < 2 else "WARN" if shape is None or len(points) <= 5 else "FAIL" if shape < 0.7 else "PASS"
        assert got[key].status == want and close(got[key].cluster_silhouette, shape) and (got[key].num_clusters or 0) == len(sizes)
        radius = [max(math.dist(p, centres[c]) for p, at in zip(points, label) if at == c) for c in range(len(centres)) if c in label]
        assert close(got[key].max_cluster_radius, max(radius) if radius else None)
