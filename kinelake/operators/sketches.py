"""Mergeable sketches kept per day, so that figures over spans of days come from a small table and read no facts.

Quantiles: KLL sketches, whose rank is off by a bounded share of the rows. Distinct counts: HyperLogLog for totals, theta sketches where
two sets are to be cut (what succeeded and also failed). Sizes are bounded by the parameters, whatever a day holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed sizes, and errors that estimates stay within with high probability: ranks for KLL (k), shares for HLL and theta (log2 of entries).
KLL_K, KLL_ERROR = 400, 0.01
HLL_LOG, HLL_ERROR = 14, 0.03
THETA_LOG, THETA_ERROR = 14, 0.03


def daily_quantiles(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys (with the day among them), n, kll."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("kll"))


def span_quantiles(daily: DataFrame, keys: list[str], q: float, name: str) -> DataFrame:
    """keys, n, ``name`` over all days of ``daily`` (which may be filtered first)."""
    merged = daily.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("kll", F.lit(KLL_K)).alias("kll"))
    return merged.select(*keys, "n", F.kll_sketch_get_quantile_double("kll", F.lit(q)).alias(name))


def rank_of(df: DataFrame, estimates: DataFrame, keys: list[str], value: str, estimate: str) -> DataFrame:
    """keys, low, high: between which shares of the values an estimate lies (they differ where values repeat)."""
    both = df.where(F.col(value).isNotNull()).join(estimates.select(*keys, estimate), keys)
    return both.groupBy(*keys).agg(F.avg((F.col(value) < F.col(estimate)).cast("double")).alias("low"), F.avg((F.col(value) <= F.col(estimate)).cast("double")).alias("high"))


def daily_distinct(df: DataFrame, keys: list[str], value: str, good: Column, bad: Column) -> DataFrame:
    """keys (with the day among them), distinct values as HLL, and those of good and of bad rows as theta sketches."""
    theta = lambda c: F.theta_sketch_agg(F.when(c, F.col(value)), F.lit(THETA_LOG))
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(HLL_LOG)).alias("hll"), theta(good).alias("good"), theta(bad).alias("bad"))


def span_distinct(daily: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_distinct, n_good, n_bad, n_both over all days of ``daily``."""
    union = lambda c: F.theta_union_agg(c, F.lit(THETA_LOG))
    merged = daily.groupBy(*keys).agg(F.hll_union_agg("hll", F.lit(False)).alias("hll"), union("good").alias("good"), union("bad").alias("bad"))
    return merged.select(
        *keys, F.hll_sketch_estimate("hll").alias("n_distinct"), *(F.theta_sketch_estimate(c).alias(f"n_{c}") for c in ("good", "bad")),
        F.theta_sketch_estimate(F.theta_intersection("good", "bad")).alias("n_both"),
    )
