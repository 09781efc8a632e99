"""Reusable column expressions: statuses, keys, ratios, ladders, scores and splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status words and thresholds that results depend on.
SUCCESS = ("OK", "WARN", "SUCCESS", "SUCCEEDED")
FAILURE = ("FAIL", "FAILED", "ERROR")
UNFINISHED = ("RUNNING", "PENDING", "STARTED")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def status(c: Column | str) -> Column:
    """A status in capitals, empty for null."""
    return F.upper(F.coalesce(col(c), F.lit("")))


def status_in(c: Column | str, words: tuple[str, ...]) -> Column:
    return status(c).isin(*words)


def day(*times: Column | str) -> Column:
    """The (UTC) day of the first time that is known."""
    return F.to_date(F.coalesce(*map(col, times)))


def key(*parts: Column | str) -> Column:
    """md5 of the parts joined by bars, null as empty."""
    return F.md5(F.concat_ws("|", *(F.coalesce(col(p).cast("string"), F.lit("")) for p in parts)))


def ratio(part: Column | str, whole: Column | str, empty: float | None = None) -> Column:
    """part / whole as a double; ``empty`` where there is no whole."""
    return F.when(col(whole) > 0, col(part).cast("double") / col(whole)).otherwise(F.lit(empty).cast("double"))


def distinct_where(condition: Column, c: Column | str) -> Column:
    return F.count_distinct(F.when(condition, col(c)))


def quantile(c: Column | str, q: float) -> Column:
    """Exact, with linear interpolation."""
    return F.percentile(col(c), F.lit(q))


def ladder(steps: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """The value of the first condition that holds."""
    first, *rest = steps
    return reduce(lambda c, s: c.when(s[0], F.lit(s[1])), rest, F.when(first[0], F.lit(first[1]))).otherwise(F.lit(otherwise))


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def known(c: Column | str, default: float) -> Column:
    return F.coalesce(col(c), F.lit(default))


# ---------------------------------------------------------------- hashing into splits


def first_bytes(text: Column) -> Column:
    """The first 8 bytes of a sha256, as an unsigned number."""
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)")


def split_of(share: Column, ratios: dict[str, float]) -> Column:
    """The split in whose cumulative range a share in [0, 1) falls; the last one takes the rest."""
    names, total, steps = list(ratios), 0.0, []
    for n in names[:-1]:
        total += ratios[n]
        steps.append((share < F.lit(total), n))
    return ladder(steps, names[-1])


def training_split(dataset_id: Column | str, episode_id: Column | str, seed: int, ratios: dict[str, float]) -> Column:
    text = F.concat_ws("|", col(dataset_id), col(episode_id), F.lit(str(seed)))
    return split_of(first_bytes(text).cast("double") / F.lit(2.0**64), ratios)


def distillation_split(sample_id: Column | str, ratios: dict[str, float]) -> Column:
    whole = sum(ratios.values())
    return split_of((first_bytes(col(sample_id)) % F.lit(10000)).cast("double") / 10000.0, {k: v / whole for k, v in ratios.items()})


# ---------------------------------------------------------------- scores

#: Penalties (threshold, per unit, cap) of an episode's quality score.
VELOCITY, QUATERNION, PRESSES, SILHOUETTE = (2.5, 5.0, 30.0), (1e-3, 200.0, 30.0), (25, 5, 1.0, 20.0), (0.5, -0.1, 40.0, 20.0)


def episode_score(velocity: str = "max_velocity_mps", quaternion: str = "quat_max_norm_error", presses: str = "detected_press_count", silhouette: str = "cluster_silhouette") -> Column:
    over = lambda c, limit, unit, cap: clip((c - F.lit(limit)) * unit, 0.0, cap)
    target, tolerance, unit, cap = PRESSES
    good, unknown, steep, most = SILHOUETTE
    penalty = over(F.col(velocity), *VELOCITY) + over(F.col(quaternion), *QUATERNION) + over(F.abs(F.col(presses) - target), tolerance, unit, cap)
    return clip(F.lit(100.0) - penalty - clip((F.lit(good) - known(silhouette, unknown)) * steep, 0.0, most), 0.0, 100.0)


def score_status(score: Column | str) -> Column:
    return ladder([(col(score) >= 80, "PASS"), (col(score) >= 50, "WARN")], "FAIL")


def dashboard_score(qc: str = "qc_pass_rate", etl: str = "etl_success_rate", workflow: str = "workflow_success_rate") -> Column:
    """Weights 50 / 30 / 20; an unknown rate counts as full."""
    return known(qc, 1.0) * 50.0 + known(etl, 1.0) * 30.0 + known(workflow, 1.0) * 20.0


def dashboard_score_strict(qc: str = "qc_pass_rate", etl: str = "etl_success_rate", workflow: str = "workflow_success_rate") -> Column:
    """Weights 60 / 30 / 10; an unknown rate counts as none."""
    return F.round(known(qc, 0.0) * 60.0 + known(etl, 0.0) * 30.0 + known(workflow, 0.0) * 10.0, 2)


# ---------------------------------------------------------------- errors and states

#: Error types that are worth another attempt.
RETRYABLE = ("OPENAI_TIMEOUT", "OPENAI_ENDPOINT_UNAVAILABLE", "UNKNOWN")


def error_type(message: Column | str) -> Column:
    """What stands before the first colon if it is one word; PREDICTION_ERROR otherwise, UNKNOWN for no message."""
    m = col(message)
    head = F.trim(F.substring_index(m, ":", 1))
    return F.when(F.coalesce(m, F.lit("")) == "", "UNKNOWN").when(head.rlike("^[A-Za-z0-9_]*[A-Za-z0-9][A-Za-z0-9_]*$"), head).otherwise("PREDICTION_ERROR")


def retryable(kind: Column | str) -> Column:
    return col(kind).isin(*RETRYABLE)


def started(start: str, finish: str, seconds: str) -> Column:
    """Start time: as given, else finish less duration, else finish."""
    less = F.col(finish) - F.make_dt_interval(secs=F.col(seconds).cast("decimal(18,6)"))
    return F.coalesce(F.col(start), less, F.col(finish))


def glob_pattern(glob: Column | str) -> Column:
    """A glob of * and ? as an anchored regular expression."""
    quoted = F.regexp_replace(col(glob), r"([.^$+(){}|\[\]\\])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))
