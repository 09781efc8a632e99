"""Queries over pose series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import press, scans, series
from ..plans import episodes as P
from ..sources import adapters, scratch
from .base import Family

family = Family()
add = family.add

K = "dataset_id, version, episode_id"
W = f"PARTITION BY {K} ORDER BY frame_idx"
SO_FAR = f"{W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
KEYS = ["dataset_id", "version", "episode_id", "frame_idx"]


def r6(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


MOTION = f"""m AS (SELECT *, coalesce(sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2) + pow(z - lag(z) OVER w, 2)), 0) AS delta_d, timestamp_sec - lag(timestamp_sec) OVER w AS step FROM fx_pose WINDOW w AS ({W})),
v AS (SELECT *, CASE WHEN step > 1e-12 THEN delta_d / step ELSE 0.0 END AS velocity_mps FROM m)"""
UNIT = "u AS (SELECT * REPLACE (qx / n AS qx, qy / n AS qy, qz / n AS qz, qw / n AS qw) FROM (SELECT *, greatest(sqrt(qx * qx + qy * qy + qz * qz + qw * qw), 1e-12) AS n FROM fx_pose))"
CONTINUOUS = f"""{UNIT}, dots AS (SELECT *, coalesce(qx * lag(qx) OVER w + qy * lag(qy) OVER w + qz * lag(qz) OVER w + qw * lag(qw) OVER w, 1) AS dot FROM u WINDOW w AS ({W})),
zeros AS (SELECT *, sum(CASE WHEN dot = 0 THEN 1 ELSE 0 END) OVER ({SO_FAR}) AS zero FROM dots),
signs AS (SELECT *, CASE WHEN sum(CASE WHEN dot < 0 THEN 1 ELSE 0 END) OVER (PARTITION BY {K}, zero ORDER BY frame_idx ROWS UNBOUNDED PRECEDING) % 2 = 1 THEN -1.0 ELSE 1.0 END AS s FROM zeros),
c AS (SELECT * REPLACE (qx * s AS qx, qy * s AS qy, qz * s AS qz, qw * s AS qw) FROM signs)"""
EULER = f"""{CONTINUOUS}, e AS (SELECT *, atan2(2 * (qw * qx + qy * qz), 1 - 2 * (qx * qx + qy * qy)) AS roll, asin(least(greatest(2 * (qw * qy - qz * qx), -1), 1)) AS pitch, atan2(2 * (qw * qz + qx * qy), 1 - 2 * (qy * qy + qz * qz)) AS yaw FROM c)"""


def unwrap(c: str) -> str:
    step = f"({c} - lag({c}) OVER ({W}))"
    return f"CASE WHEN abs({step}) >= pi() THEN -2 * pi() * round({step} / (2 * pi())) ELSE 0.0 END AS fix_{c}"


UNWRAPPED = f"""{EULER}, f AS (SELECT *, {", ".join(map(unwrap, ("roll", "pitch", "yaw")))} FROM e),
g AS (SELECT * REPLACE ({", ".join(f"{c} + sum(fix_{c}) OVER ({SO_FAR}) AS {c}" for c in ("roll", "pitch", "yaw"))}) FROM f)"""

add("T1_renumber", ["fx_pose"], lambda p: series.renumbered(p.withColumnRenamed("frame_idx", "source_frame"), "x", "source_frame").select("dataset_id", "version", "episode_id", "source_frame", "frame_idx"),
    f"SELECT {K}, frame_idx AS source_frame, row_number() OVER (PARTITION BY {K} ORDER BY x, frame_idx) - 1 AS frame_idx FROM fx_pose")
add("T2_timestamps", ["fx_pose"], lambda p: series.timestamps(p.withColumn("seconds", F.when(F.col("version") == "v1", 4.0)), 25.0, "seconds").select(*KEYS, "timestamp_sec"),
    f"SELECT {K}, frame_idx, round(coalesce(CASE WHEN version = 'v1' THEN 4.0 * frame_idx / (count(*) OVER (PARTITION BY {K}) - 1) END, frame_idx / 25.0), 6) AS timestamp_sec FROM fx_pose")
add("T3_frame_rates", ["fx_pose"], lambda p: series.frame_rates(P.inject(p, "timestamp_jitter")),
    f"""WITH j AS (SELECT {K}, frame_idx, timestamp_sec + CASE WHEN frame_idx % 2 = 1 THEN 0.01 ELSE 0 END AS t FROM fx_pose), s AS (SELECT {K}, t - lag(t) OVER ({W}) AS step FROM j)
    SELECT {K}, round(quantile_cont(step, 0.5), 6) AS dt, round(1 / quantile_cont(step, 0.5), 6) AS fps FROM s WHERE step > 1e-12 GROUP BY {K}""")  # fmt: skip
add("T4_motion", ["fx_pose"], lambda p: series.motion(p).select(*KEYS, "delta_d", "velocity_mps", "is_velocity_jump"), f"WITH {MOTION} SELECT {K}, frame_idx, {r6('delta_d', 'velocity_mps')}, velocity_mps > 2.5 AS is_velocity_jump FROM v")
add("T5_velocity_jumps", ["fx_pose"], lambda p: P.velocity_check(P.pose_features(p)),
    f"""WITH {MOTION}, d AS (SELECT {K}, CASE WHEN frame_idx > 0 THEN delta_d * 30 END AS v FROM v), a AS (SELECT {K}, coalesce(max(v), 0) AS max_velocity_mps, quantile_cont(v, 0.95) AS p95_velocity_mps, count(*) FILTER (v > 2.0) AS num_jump_points FROM d GROUP BY {K})
    SELECT {K}, {r6('max_velocity_mps', 'p95_velocity_mps')}, num_jump_points, CASE WHEN max_velocity_mps > 2.0 THEN 'FAIL' ELSE 'PASS' END AS status FROM a""")  # fmt: skip
add("T6_unit_quaternions", ["fx_pose"], lambda p: series.unit_quaternions(P.inject(p, "quat_drift")).select(*KEYS, "qx", "qy", "qz", "qw", "quat_norm"),
    f"""WITH d AS (SELECT {K}, frame_idx, qx * (1 + frame_idx * 0.001) AS a, qy * (1 + frame_idx * 0.001) AS b, qz * (1 + frame_idx * 0.001) AS c, qw * (1 + frame_idx * 0.001) AS d FROM fx_pose), n AS (SELECT *, sqrt(a*a + b*b + c*c + d*d) AS quat_norm FROM d)
    SELECT {K}, frame_idx, round(a / quat_norm, 6) AS qx, round(b / quat_norm, 6) AS qy, round(c / quat_norm, 6) AS qz, round(d / quat_norm, 6) AS qw, round(quat_norm, 6) AS quat_norm FROM n""")  # fmt: skip
add("T7_continuous_quaternions", ["fx_pose"], lambda p: series.continuous(series.unit_quaternions(p)).select(*KEYS, "qx", "qy", "qz", "qw"), f"WITH {CONTINUOUS} SELECT {K}, frame_idx, {r6('qx', 'qy', 'qz', 'qw')} FROM c")
add("T8_unwrapped_euler", ["fx_pose"], lambda p: series.unwrapped(series.euler_angles(series.continuous(series.unit_quaternions(p)))).select(*KEYS, "roll", "pitch", "yaw"), f"WITH {UNWRAPPED} SELECT {K}, frame_idx, {r6('roll', 'pitch', 'yaw')} FROM g")
add("T9_from_euler", ["fx_pose"], lambda p: series.from_euler(p.withColumns({"roll": F.col("x"), "pitch": F.col("y"), "yaw": F.col("z")})).select(*KEYS, "qx", "qy", "qz", "qw"),
    f"""SELECT {K}, frame_idx, round(sin(x/2)*cos(y/2)*cos(z/2) - cos(x/2)*sin(y/2)*sin(z/2), 6) AS qx, round(cos(x/2)*sin(y/2)*cos(z/2) + sin(x/2)*cos(y/2)*sin(z/2), 6) AS qy,
    round(cos(x/2)*cos(y/2)*sin(z/2) - sin(x/2)*sin(y/2)*cos(z/2), 6) AS qz, round(cos(x/2)*cos(y/2)*cos(z/2) + sin(x/2)*sin(y/2)*sin(z/2), 6) AS qw FROM fx_pose""")  # fmt: skip
add("T10_integrated_actions", ["fx_pose"], lambda p: series.integrated(p.select(*KEYS, *(F.col(c).alias(f"d{c}") for c in "xyz"))).select(*KEYS, "x", "y", "z"),
    f"SELECT {K}, frame_idx, {', '.join(f'round(sum({c}) OVER ({SO_FAR}), 6) AS {c}' for c in 'xyz')} FROM fx_pose")
add("T11_finite", ["fx_pose"], lambda p: series.finite(P.inject(p, "nan_injection")).select(*KEYS, "z", "qw"), f"SELECT {K}, frame_idx, CASE WHEN frame_idx % 20 = 10 THEN 0.0 ELSE round(z, 6) END AS z, round(qw, 6) AS qw FROM fx_pose")
SEGMENTS = f"""WITH {MOTION}, s AS (SELECT *, CASE WHEN z < 0.16 THEN 'PRESS' WHEN velocity_mps <= 0.5 THEN 'QUIET' ELSE 'MOVE' END AS segment_type FROM v),
n AS (SELECT *, coalesce(segment_type <> lag(segment_type) OVER ({W}), TRUE) AS fresh FROM s), r AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER ({SO_FAR}) - 1 AS run FROM n)
SELECT episode_id || '-seg-' || lpad(CAST(CAST(run AS BIGINT) AS VARCHAR), 4, '0') AS segment_id, {K}, min(frame_idx) AS start_frame, max(frame_idx) AS end_frame, round(min(timestamp_sec), 6) AS start_time_sec, round(max(timestamp_sec), 6) AS end_time_sec,
    segment_type, round(max(timestamp_sec) - min(timestamp_sec), 6) AS duration_sec, round(sum(CASE WHEN fresh THEN 0 ELSE delta_d END), 6) AS distance FROM r GROUP BY {K}, run, segment_type"""
add("T15_segments", ["fx_pose"], lambda p: series.segments(series.motion(p).withColumn("is_press_candidate", F.col("z") < 0.16), quiet=0.5), SEGMENTS)
# the same by segmented scans, in chunks far shorter than the recordings
CHUNK = 40
add("T7_continuous_segmented", ["fx_pose"], lambda p: scans.continuous(series.unit_quaternions(p), CHUNK).select(*KEYS, "qx", "qy", "qz", "qw"), f"WITH {CONTINUOUS} SELECT {K}, frame_idx, {r6('qx', 'qy', 'qz', 'qw')} FROM c")
add("T8_unwrapped_segmented", ["fx_pose"], lambda p: scans.unwrapped(series.euler_angles(scratch.written(scans.continuous(series.unit_quaternions(p), CHUNK), "continuous")), chunk=CHUNK).select(*KEYS, "roll", "pitch", "yaw"), f"WITH {UNWRAPPED} SELECT {K}, frame_idx, {r6('roll', 'pitch', 'yaw')} FROM g")
add("T10_integrated_segmented", ["fx_pose"], lambda p: scans.integrated(p.select(*KEYS, *(F.col(c).alias(f"d{c}") for c in "xyz")), chunk=CHUNK).select(*KEYS, "x", "y", "z"),
    f"SELECT {K}, frame_idx, {', '.join(f'round(sum({c}) OVER ({SO_FAR}), 6) AS {c}' for c in 'xyz')} FROM fx_pose")
add("T15_segments_segmented", ["fx_pose"], lambda p: scans.segments(series.motion(p).withColumn("is_press_candidate", F.col("z") < 0.16), quiet=0.5, chunk=CHUNK), SEGMENTS)
SUMMARY = f"""{UNWRAPPED}, mv AS (SELECT {K}, frame_idx, velocity_mps FROM (WITH {MOTION} SELECT * FROM v)),
sm AS (SELECT {K}, count(*) AS num_samples, max(timestamp_sec) - min(timestamp_sec) AS duration_sec, min(z) AS z_min, max(z) AS z_max, max(velocity_mps) AS max_velocity_mps, avg(velocity_mps) AS mean_velocity_mps,
    quantile_cont(velocity_mps, 0.95) AS p95_velocity_mps, max(abs(sqrt(qx*qx + qy*qy + qz*qz + qw*qw) - 1)) AS quat_max_norm_error, var_pop(roll) AS roll_var, var_pop(pitch) AS pitch_var, var_pop(yaw) AS yaw_var
    FROM g JOIN mv USING (dataset_id, version, episode_id, frame_idx) GROUP BY {K})"""
NUMBERS = ("duration_sec", "z_min", "z_max", "max_velocity_mps", "mean_velocity_mps", "p95_velocity_mps", "quat_max_norm_error", "roll_var", "pitch_var", "yaw_var")
add("A9_episode_summary", ["fx_pose"], lambda p: series.episode_summary(P.pose_features(p)), f"WITH {SUMMARY} SELECT {K}, num_samples, {r6(*NUMBERS)} FROM sm")


def synthetic_scores(pose):
    e = series.episode_summary(P.pose_features(pose))
    # press counts and silhouettes that SQL can follow
    return e.withColumn("detected_press_count", F.col("num_samples") % 40).withColumn("cluster_silhouette", F.when(F.col("num_samples") % 5 > 0, F.col("z_max")))


SCORED = f"""{SUMMARY}, sc AS (SELECT *, num_samples % 40 AS detected_press_count, CASE WHEN num_samples % 5 > 0 THEN z_max END AS cluster_silhouette FROM sm),
es AS (SELECT *, greatest(0, least(100, 100 - greatest(0, least(30, (max_velocity_mps - 2.5) * 5)) - greatest(0, least(30, (quat_max_norm_error - 0.001) * 200))
    - greatest(0, least(20, abs(detected_press_count - 25) - 5)) - greatest(0, least(20, (0.5 - coalesce(cluster_silhouette, -0.1)) * 40)))) AS quality_score FROM sc),
st AS (SELECT *, CASE WHEN quality_score >= 80 THEN 'PASS' WHEN quality_score >= 50 THEN 'WARN' ELSE 'FAIL' END AS quality_status FROM es)"""
add("M2_episode_quality_score", ["fx_pose"], lambda p: P.episode_quality(synthetic_scores(p)),
    f"WITH {SCORED} SELECT {K}, {r6('quality_score', 'max_velocity_mps', 'quat_max_norm_error', 'cluster_silhouette')}, quality_status, detected_press_count FROM st")
add("A7_dataset_summary", ["fx_pose"], lambda p: P.dataset_summary(P.episode_quality(synthetic_scores(p))),
    f"""WITH {SCORED} SELECT dataset_id, version, count(*) AS num_episodes, round(avg(quality_score), 6) AS avg_quality_score, round(avg(CASE WHEN quality_status = 'PASS' THEN 1.0 ELSE 0 END), 6) AS pass_rate,
    round(avg(max_velocity_mps), 6) AS avg_max_velocity_mps, round(avg(cluster_silhouette), 6) AS avg_cluster_silhouette, CAST(sum(detected_press_count) AS BIGINT) AS total_press_count FROM st GROUP BY 1, 2""")  # fmt: skip
add("T18_schema_check", ["fx_pose"], lambda p: P.schema_check(P.inject(p, "nan_injection", 75)).drop("z_min", "z_max"),
    f"""SELECT {K}, count(*) AS n_samples, count(*) FILTER (frame_idx % 75 = 37) AS n_bad, {', '.join(f'round({f}({c}), 6) AS {c}_{f}' for c in 'xy' for f in ('min', 'max'))},
    CASE WHEN count(*) < 10 OR count(*) FILTER (frame_idx % 75 = 37) > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM fx_pose GROUP BY {K}""")  # fmt: skip
add("T19_euler_stability", ["fx_pose"], lambda p: P.euler_check(P.pose_features(p)),
    f"""WITH {UNWRAPPED} SELECT {K}, {', '.join(f'round(var_pop({c}), 6) AS {c}_var, round(max({c}) - min({c}), 6) AS {c}_range' for c in ('roll', 'pitch', 'yaw'))},
    CASE WHEN var_pop(roll) > 0.001 OR var_pop(pitch) > 0.001 THEN 'FAIL' ELSE 'PASS' END AS status FROM g GROUP BY {K}""")  # fmt: skip


def clusters_by_k(pose):
    """Every frame as a point of one of two clusters that SQL can follow."""
    return pose.withColumn("cluster_id", F.when(F.col("x") > 0.05, 1).otherwise(0))


POINTS = f"p AS (SELECT {K}, frame_idx AS i, x, y, CASE WHEN x > 0.05 THEN 1 ELSE 0 END AS c FROM fx_pose)"
add("J13_silhouette", ["fx_pose"], lambda p: press.silhouettes(clusters_by_k(p), series.EPISODE),
    f"""WITH {POINTS}, d AS (SELECT p.dataset_id, p.version, p.episode_id, p.i, p.c, q.c AS d, avg(sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2))) AS mean FROM p JOIN p q ON p.dataset_id = q.dataset_id AND p.version = q.version AND p.episode_id = q.episode_id AND p.i <> q.i GROUP BY ALL),
    s AS (SELECT {K}, i, min(mean) FILTER (c = d) AS a, min(mean) FILTER (c <> d) AS b FROM d GROUP BY {K}, i)
    SELECT {K}, round(avg(CASE WHEN b IS NULL THEN NULL WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS cluster_silhouette FROM s GROUP BY {K}""")  # fmt: skip


def centred(pose):
    c = clusters_by_k(pose).groupBy(*series.EPISODE, "cluster_id").agg(F.avg("x").alias("cluster_center_x"), F.avg("y").alias("cluster_center_y"))
    return c


add("T16_workspace_bbox", ["fx_pose"], lambda p: P.bbox_check(p, centred(p)),
    f"""WITH {POINTS}, c AS (SELECT {K}, c, avg(x) AS cx, avg(y) AS cy FROM p GROUP BY {K}, c), b AS (SELECT {K}, min(cx) AS x0, max(cx) AS x1, min(cy) AS y0, max(cy) AS y1, greatest(greatest(max(cx) - min(cx), max(cy) - min(cy)) * 0.5, 1e-6) AS pad FROM c GROUP BY {K}),
    o AS (SELECT {K}, avg(CASE WHEN x < x0 - pad OR x > x1 + pad OR y < y0 - pad OR y > y1 + pad THEN 1.0 ELSE 0 END) AS outside_ratio FROM fx_pose JOIN b USING (dataset_id, version, episode_id) GROUP BY {K})
    SELECT {K}, round(outside_ratio, 6) AS outside_ratio, CASE WHEN outside_ratio > 0.1 THEN 'WARN' ELSE 'PASS' END AS status FROM o""")  # fmt: skip
# signal processing per episode: peaks, prominences, smoothing and clusters are held against plain loops in the tests
add("T12_press_frames", ["fx_pose"], press.press_frames)
add("T14_press_events", ["fx_pose"], lambda p: press.press_events(p, press.press_frames(p)))
add("T13_press_clusters", ["fx_pose"], lambda p: press.press_frames(p, expected=3).where("cluster_id is not null").groupBy(*series.EPISODE, "cluster_id", "cluster_center_x", "cluster_center_y").agg(F.count("*").alias("n")))
add("T17_cluster_quality", ["fx_pose"], lambda p: P.cluster_check(p, scratch.written(press.press_events(p, scratch.written(press.press_frames(p), "press-frames")), "press-events")))
add("P1_normalize", ["fx_pose"], lambda p: P.normalize(P.inject(p, "nan_injection"))[0],
    f"""WITH q AS (SELECT {K}, frame_idx, x, y, CASE WHEN frame_idx % 20 = 10 THEN 0.0 ELSE z END AS z, qx, qy, qz, CASE WHEN sqrt(qx*qx + qy*qy + qz*qz + qw*qw) < 1e-12 THEN 1.0 ELSE qw END AS qw FROM fx_pose), n AS (SELECT *, sqrt(qx*qx + qy*qy + qz*qz + qw*qw) AS quat_norm FROM q)
    SELECT {K}, frame_idx, round(frame_idx / 30.0, 6) AS timestamp_sec, {r6('x', 'y', 'z')}, {', '.join(f'round({c} / quat_norm, 6) AS {c}' for c in ('qx', 'qy', 'qz', 'qw'))}, round(quat_norm, 6) AS quat_norm FROM n""")  # fmt: skip


def mixed(pose):
    """Four families in one table: angles, vectors, flat columns, and one with an adapter of its own."""
    d, flat = F.col("dataset_id"), ("x", "y", "z", "qx", "qy", "qz", "qw")
    family = F.when(d == "ds_0", "angles").when(d.isin("ds_1", "ds_2"), "vector").when(d == "ds_3", "own").otherwise("flat")
    rows = pose.withColumn("family", family).withColumn("cartesian_position", F.when(F.col("family") == "angles", F.array("x", "y", "z", "x", F.lit(0.0), F.lit(0.0))))
    rows = rows.withColumn("tcp_pose", F.when(F.col("family") == "vector", F.array(*flat))).withColumns({c: F.when(F.col("family") == "flat", F.col(c)) for c in flat[1:]})
    return rows.withColumn("x", F.when(F.col("family").isin("flat", "own"), F.col("x")))


def routed(pose):
    own = lambda df: df.select(*KEYS, F.col("x"), *(F.lit(0.0).alias(c) for c in ("y", "z", "qx", "qy", "qz")), F.lit(1.0).alias("qw"))
    registry = adapters.Registry()
    registry.register("ds_", adapters.row_poses, "prefix")
    registry.register("ds_3", own)
    return registry.frames(mixed(pose)).select(*KEYS, "x", "qx", "qw", "pose_source", "adapter")


add("P1_mixed_slices", ["fx_pose"], routed, f"""
SELECT {K}, frame_idx, round(x, 6) AS x, round(CASE dataset_id WHEN 'ds_0' THEN sin(x / 2) WHEN 'ds_3' THEN 0.0 ELSE qx END, 6) AS qx, round(CASE dataset_id WHEN 'ds_0' THEN cos(x / 2) WHEN 'ds_3' THEN 1.0 ELSE qw END, 6) AS qw,
    CASE WHEN dataset_id = 'ds_0' THEN 'cartesian_position' WHEN dataset_id IN ('ds_1', 'ds_2') THEN 'tcp_pose' WHEN dataset_id = 'ds_3' THEN 'exact:ds_3' ELSE 'columns' END AS pose_source,
    CASE WHEN dataset_id = 'ds_3' THEN 'exact:ds_3' ELSE 'prefix:ds_' END AS adapter FROM fx_pose""")


def once(pose):
    """Poses as a table: several branches read them."""
    return scratch.written(pose, "pose")


def built_ads(pose):
    return P.build_ads(P.build_features(pose)["episode_feature"], P.validate(pose))["dataset_quality_summary"]


add("P2_episode_feature", ["fx_pose"], lambda p: P.build_features(once(p))["episode_feature"])
add("P3_build_ads", ["fx_pose"], lambda p: built_ads(once(p)))
add("P13_validate", ["fx_pose"], lambda p: P.validate(once(p)).drop("metrics"))
add("A8_validator_failures", ["fx_pose"], lambda p: P.validator_failures(P.validate(once(p))))
add("P22_inject_faults", ["fx_pose"], lambda p: P.inject(p, "velocity_spike").select(*KEYS, "x"), f"SELECT {K}, frame_idx, round(CASE WHEN frame_idx % 20 = 10 THEN x + 5 ELSE x END, 6) AS x FROM fx_pose")


def matrix(pose):
    """Each episode is a case that should fail on orientation only."""
    results = P.validate(once(pose)).where("validator_name in ('schema', 'quaternion', 'euler_stability')")
    case = F.concat_ws("/", *series.EPISODE).alias("case_id")
    actual = results.groupBy(case).agg(P.worst("status").alias("status"), F.sort_array(F.collect_set(F.when(F.col("status") == "FAIL", F.col("validator_name")))).alias("failed"))
    expected = pose.select(case, F.lit("FAIL").alias("expected_status"), F.array(F.lit("euler_stability")).alias("expected_failed")).distinct()
    out = P.benchmark_matrix(expected, actual)
    return out.select("case_id", "status", F.concat_ws(",", "failed").alias("failed"), "passed")


add("P23_benchmark_matrix", ["fx_pose"], matrix,
    f"""WITH {UNWRAPPED}, r AS (SELECT {K}, var_pop(roll) > 0.001 OR var_pop(pitch) > 0.001 AS bad FROM g GROUP BY {K})
    SELECT dataset_id || '/' || version || '/' || episode_id AS case_id, CASE WHEN bad THEN 'FAIL' ELSE 'PASS' END AS status, CASE WHEN bad THEN 'euler_stability' ELSE '' END AS failed, bad AS passed FROM r""")  # fmt: skip

QUERIES, ORACLES = family.QUERIES, family.ORACLES
