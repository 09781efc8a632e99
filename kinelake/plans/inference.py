"""Batch scoring by rules and hashes, failures, and distillation records."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import exprs as E

DIMENSIONS = 32


def byte(hash_hex: Column, i: int) -> Column:
    return F.conv(F.substring(hash_hex, 2 * i + 1, 2), 16, 10).cast("int")


def text_embedding(text: Column, dim: int = DIMENSIONS) -> Column:
    """Signed token hashes added into ``dim`` places, scaled to length one, rounded to 6 digits."""

    def run(texts: pd.Series) -> pd.Series:
        @lru_cache(1 << 16)
        def place(token: str) -> int:
            h = hashlib.sha256(token.encode()).digest()
            return h[0] % dim + dim * (h[1] % 2)

        out = []
        for t in texts:
            tokens = [w for w in gaps.split(t.translate(marks)) if w] if t else []
            n = np.bincount(np.fromiter(map(place, tokens or [t or "empty"]), np.int64), minlength=2 * dim)
            total = (n[:dim] - n[dim:]).astype(float)
            length = math.sqrt((total * total).sum())
            out.append(total / length if length > 0 else total)
        return pd.Series(out)

    gaps, marks = re.compile(r"[ \t\n\x0b\f\r]+"), {ord("/"): " ", ord(":"): " "}
    return F.transform(F.pandas_udf(run, "array<double>")(text), lambda v: F.round(v, 6))


def id_embedding(sample_id: Column, dim: int = 16) -> Column:
    """Pseudo-embedding from hashes of id and place, each in [-1, 1)."""
    share = lambda i: (E.first_bytes(F.concat(sample_id, F.lit(":"), i.cast("string"))) % F.lit(1_000_000)).cast("double") / 1e6
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.round(share(i) * 2.0 - 1.0, 6))


def anomaly_score(sample_id: str, quality: str, velocity: str, null_rate: str, quality_scale: float = 100.0) -> Column:
    """Weighted mean of what is known: lack of quality 0.5, velocity 0.3, null rate 0.2; a hash of the id if nothing is."""
    parts = [(1.0 - E.clip(F.col(quality) / quality_scale, 0.0, 1.0), 0.5), (E.clip(F.col(velocity) / 2.0, 0.0, 1.0), 0.3), (E.clip(F.col(null_rate), 0.0, 1.0), 0.2)]
    total = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in parts), F.lit(0.0))
    weight = sum((F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, (_, w) in zip((quality, velocity, null_rate), parts)), F.lit(0.0))
    chance = (byte(F.sha2(F.col(sample_id).cast("binary"), 256), 0) % 1000) / 1000.0
    return F.round(F.when(weight > 0, E.clip(total / weight, 0.0, 1.0)).otherwise(chance), 6)


#: Fixed value: the caption text.
CAPTION = "Episode %s of dataset %s processed by local_cpu rule captioner."


def caption(dataset_id: str, episode_id: str) -> Column:
    return F.format_string(CAPTION, F.coalesce(episode_id, F.lit("?")), F.coalesce(dataset_id, F.lit("unknown")))


def task_of(model_type: str) -> Column:
    """Default task of a model type."""
    return E.ladder([(F.lower(model_type) == "embedding", "embedding"), (F.lower(model_type) == "anomaly_scorer", "anomaly_score")], "caption")


def score_batch(samples: DataFrame, model_type: str) -> DataFrame:
    """sample_id, prediction_type, prediction_json, confidence. samples: sample_id, input_text, dataset_id, episode_id,
    quality_score, max_velocity_mps, null_rate."""
    if model_type == "embedding":
        out = samples.withColumn("e", text_embedding(F.coalesce("input_text", "sample_id")))
        return out.select("sample_id", "dataset_id", "episode_id", F.lit("embedding").alias("prediction_type"), F.to_json(F.struct(F.col("e").alias("embedding"), F.size("e").alias("dim"))).alias("prediction_json"), F.lit(None).cast("double").alias("confidence"))
    if model_type == "anomaly_scorer":
        out = samples.withColumn("s", anomaly_score("sample_id", "quality_score", "max_velocity_mps", "null_rate"))
        label = E.ladder([(F.col("s") >= 0.5, "anomaly")], "normal")
        return out.select("sample_id", "dataset_id", "episode_id", F.lit("anomaly_score").alias("prediction_type"), F.to_json(F.struct(F.col("s").alias("anomaly_score"), label.alias("label"))).alias("prediction_json"), F.col("s").alias("confidence"))
    return samples.select("sample_id", "dataset_id", "episode_id", F.lit("caption").alias("prediction_type"), F.to_json(F.struct(caption("dataset_id", "episode_id").alias("text"))).alias("prediction_json"), F.lit(0.5).alias("confidence"))


def score_with(samples: DataFrame, function: Callable[[Iterator], Iterator], schema: str = "sample_id string, prediction_type string, prediction_json string, confidence double") -> DataFrame:
    """A user's scoring function over batches of pandas rows."""
    return samples.mapInPandas(function, schema)


def last_attempts(outputs: DataFrame, place: str | None = None) -> DataFrame:
    """The last attempt of each sample of each job; of equal attempts the first by ``place``, if given."""
    w = Window.partitionBy("job_id", "sample_id").orderBy(F.desc("attempt"), *([place] if place else []))
    return outputs.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def failures(outputs: DataFrame) -> DataFrame:
    kind = E.error_type("error_message")
    return outputs.where("status = 'FAILED'").select("job_id", "sample_id", kind.alias("error_type"), E.retryable(kind).alias("retryable"))


def job_outcomes(metrics: DataFrame, limit: float = 0.2) -> DataFrame:
    """metrics: job_id, total, error_rate. Succeeded, succeeded with failures, or failed."""
    e = F.col("error_rate")
    return metrics.select("job_id", E.ladder([((F.col("total") == 0) | (e > limit), "FAILED"), (e > 0, "PARTIAL")], "SUCCEEDED").alias("outcome"))


def illegal_transitions(events: DataFrame, allowed: DataFrame) -> DataFrame:
    """events: job_id, event_id, status in order of event_id; allowed: from_status, to_status. Steps that aren't allowed."""
    w = Window.partitionBy("job_id").orderBy("event_id")
    steps = events.select("job_id", "event_id", F.lag("status").over(w).alias("from_status"), F.col("status").alias("to_status")).where("from_status is not null and from_status <> to_status")
    return steps.join(F.broadcast(allowed), ["from_status", "to_status"], "left_anti")  # a fixed map of states


# ---------------------------------------------------------------- distillation


def distill(predictions: DataFrame, kind: str, teacher: str, instruction: str = "Describe the robot episode.") -> DataFrame:
    """Training records of one of four kinds as (sample_id, record JSON); predictions that don't fit are left out."""
    ok = predictions.where((F.coalesce("status", F.lit("OK")) == "OK") & F.col("sample_id").isNotNull() & (F.col("sample_id") != "")) if "status" in predictions.columns else predictions.where("sample_id is not null and sample_id <> ''")
    got = lambda name: F.get_json_object("prediction_json", f"$.{name}")
    by = F.lit(teacher).alias("teacher_model")
    if kind in ("instruction_tuning", "caption_sft"):
        rows = ok.withColumn("v", got("text")).where("v <> ''")
        record = F.struct(F.col("sample_id").alias("id"), F.lit(instruction).alias("instruction"), F.concat_ws("/", "dataset_id", "episode_id").alias("input"), F.col("v").alias("output"), by, F.struct("confidence", "prediction_type").alias("metadata"))
    elif kind == "embedding_pairs":
        rows = ok.withColumn("v", F.from_json(got("embedding"), "array<double>")).where("v is not null")
        record = F.struct(F.col("sample_id").alias("id"), "sample_id", "dataset_id", "episode_id", F.col("v").alias("embedding"), F.coalesce(got("dim").cast("int"), F.size("v")).alias("dim"), by)
    elif kind == "anomaly_detection":
        rows = ok.withColumn("v", got("anomaly_score").cast("double")).where("v is not null")
        record = F.struct(F.col("sample_id").alias("id"), "sample_id", "dataset_id", "episode_id", F.col("v").alias("anomaly_score"), F.coalesce(got("label"), E.ladder([(F.col("v") >= 0.5, "anomaly")], "normal")).alias("label"), by)
    else:
        raise ValueError(f"no such kind of record: {kind}")
    return rows.select("sample_id", F.to_json(record).alias("record"))


# ---------------------------------------------------------------- training export


def quality_filtered(df: DataFrame, threshold: float = 80.0, excluded: tuple[str, ...] = ("FAIL",), families: tuple[str, ...] = (), least: int | None = None, no_failed: bool = True) -> DataFrame:
    """Rows good enough to train on. A null score goes; a null status or contract result stays."""
    df = df.where(F.coalesce("quality_score", F.lit(-1.0)) >= threshold)
    df = df.where(F.col("quality_status").isNull() | ~F.col("quality_status").isin(*excluded))
    if families:
        df = df.where(F.col("dataset_family").isin(*families))
    if least is not None:
        df = df.where(F.col("num_samples") >= least)
    return df.where(~F.col("qc_status").eqNullSafe("FAIL")) if no_failed else df


def training_export(features: DataFrame, quality: DataFrame, qc: DataFrame, seed: str = "v1", ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), threshold: float = 80.0) -> tuple[DataFrame, DataFrame]:
    """The rows of each split, and a card row per dataset version. qc: dataset_id, version, status; the worst one counts."""
    from .episodes import worst

    keys = ["dataset_id", "version", "episode_id"]
    same = [c for c in quality.columns if c in features.columns and c not in keys]
    status = qc.groupBy("dataset_id", "version").agg(worst("status").alias("qc_status"))
    both = features.join(quality.withColumnsRenamed({c: f"{c}_quality" for c in same}), keys, "left").join(status, ["dataset_id", "version"], "left")
    rows = quality_filtered(both, threshold).withColumn("split", E.training_split("dataset_id", "episode_id", seed, dict(zip(("train", "val", "test"), ratios))))
    card = rows.groupBy("dataset_id", "version").agg(F.count("*").alias("num_rows"), *(F.count_if(F.col("split") == s).alias(f"num_{s}") for s in ("train", "val", "test")), F.avg("quality_score").alias("avg_quality_score"))
    return rows, card
