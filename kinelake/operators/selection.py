"""Exact quantiles of groups of any size, by narrowing the bracket of a rank.

Each pass counts a group's values below and inside its bracket, and takes a grid of approximate quantiles inside it, a sketch of bounded
size. The cells around the wanted ranks are the next bracket, some hundredth of the one before. When at most ``gather`` values are left
in it, their counts by value are summed up to the rank. No task gets more of a group than that, and equal values are
counted before they meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written
from .joins import null_safe_join

#: Cells of the grid, its accuracy (ranks are off by one part in so many at most), and values that may be gathered.
CELLS, ACCURACY, GATHER = 256, 10_000, 100_000


def bracketed(values: DataFrame, keys: list[str], first: Column, last: Column, gather: int = GATHER) -> DataFrame:
    """keys, n, first, last (ranks from 0, expressions over n), low, high, below (values less than low), inside."""
    state = values.groupBy(*keys).agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    state = state.where("n > 0").withColumns({"first": first.cast("long"), "last": last.cast("long"), "below": F.lit(0).cast("long"), "inside": F.col("n")})
    state = written(state, "brackets")
    grid = [i / CELLS for i in range(CELLS + 1)]
    while True:
        wide = state.where((F.col("inside") > gather) & (F.col("low") < F.col("high")))
        if wide.isEmpty():
            return state
        # cells that surely hold both ranks
        near = null_safe_join(values, wide.select(*keys, "low", "high"), keys).where("v between low and high")
        cells = near.groupBy(*keys).agg(F.percentile_approx("v", F.array(*map(F.lit, grid)), F.lit(ACCURACY)).alias("grid"))
        cells = null_safe_join(wide, cells, keys)
        cell = lambda rank, to: F.greatest(F.lit(0), F.least(F.lit(CELLS), to((F.col(rank) - F.col("below")) * F.lit(float(CELLS)) / F.col("inside")))).cast("int")
        low = F.element_at("grid", F.greatest(cell("first", F.floor) - 1, F.lit(0)) + 1)
        high = F.element_at("grid", F.least(cell("last", F.ceil) + 1, F.lit(CELLS)) + 1)
        cells = cells.withColumns({"new_low": F.when(cell("first", F.floor) <= 1, F.col("low")).otherwise(low), "new_high": F.when(cell("last", F.ceil) >= CELLS - 1, F.col("high")).otherwise(high)})
        cells = written(cells.select(*keys, "new_low", "new_high", "low", "high"), "cells")
        counted = null_safe_join(values, cells, keys).groupBy(*keys, "new_low", "new_high").agg(F.count_if(F.col("v") < F.col("new_low")).alias("new_below"), F.count_if(F.col("v").between(F.col("new_low"), F.col("new_high"))).alias("new_inside"))
        # a bracket that can't be narrowed any more holds few different values: these are counted at the end
        moved = null_safe_join(state, counted, keys, "left")
        stuck = F.col("new_inside") >= F.col("inside")
        moved = moved.select(
            *keys, "n", "first", "last", F.coalesce("new_low", "low").alias("low"), F.coalesce("new_high", "high").alias("high"), F.coalesce("new_below", "below").alias("below"),
            F.when(stuck, F.lit(0).cast("long")).otherwise(F.coalesce("new_inside", "inside")).alias("inside"),
        )
        state = written(moved, "brackets")


def ranked(df: DataFrame, keys: list[str], column: str, first: Column, last: Column, gather: int = GATHER) -> DataFrame:
    """keys, n, first, last, at_first, at_last: the values at two neighbouring ranks of each group; nulls don't count."""
    values = df.select(*keys, F.col(column).alias("v")).where("v is not null")
    state = bracketed(values, keys, first, last, gather)
    near = null_safe_join(values, state.select(*keys, "low", "high", "below", "first", "last", "n"), keys).where("v between low and high")
    counts = near.groupBy(*keys, "v", "below", "first", "last", "n").agg(F.count("*").alias("c"))
    upto = F.col("below") + F.sum("c").over(Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counts = counts.withColumn("upto", upto)
    return counts.groupBy(*keys, "n", "first", "last").agg(F.min(F.when(F.col("upto") > F.col("first"), F.col("v"))).alias("at_first"), F.min(F.when(F.col("upto") > F.col("last"), F.col("v"))).alias("at_last"))


def quantiles(df: DataFrame, keys: list[str], column: str, q: float, name: str, gather: int = GATHER) -> DataFrame:
    """keys, ``name``: exact, with linear interpolation."""
    at = F.lit(q) * (F.col("n") - 1)
    out = ranked(df, keys, column, F.floor(at), F.ceil(at), gather)
    return out.select(*keys, (F.col("at_first") + (F.col("at_last") - F.col("at_first")) * (at - F.col("first"))).alias(name))


def by_place(df: DataFrame, keys: list[str], column: str, q: float, name: str, gather: int = GATHER) -> DataFrame:
    """keys, ``name``: the element at int(q * n), at most the last, of the sorted values."""
    at = F.least(F.col("n") - 1, F.floor(F.lit(q) * F.col("n")))
    return ranked(df, keys, column, at, at, gather).select(*keys, F.col("at_first").alias(name))
