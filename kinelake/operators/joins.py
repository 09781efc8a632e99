"""Joins, set operations and merges that the plans share."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import glob_pattern


def spine(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """All distinct keys of several tables."""
    return reduce(DataFrame.unionByName, [p.select(*keys).distinct() for p in parts]).distinct()


def latest(df: DataFrame, keys: list[str], order: list[str], values: list[Column | str]) -> DataFrame:
    """The given values of each key's last row by ``order``: one aggregation, no sort of a whole group."""
    packed = F.max_by(F.struct(*values), F.struct(*order)).alias("_v")
    return df.groupBy(*keys).agg(packed).select(*keys, "_v.*")


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null equals null; the keys are the left side's."""
    r = right.select(*(F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns))
    condition = reduce(Column.__and__, [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys])
    return left.join(r, condition, how).drop(*(f"_r_{k}" for k in keys))


def full_outer_chain(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Full outer joins one after another with merged keys (``spine`` with left joins gives the same rows)."""
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), parts)


def pattern_join(policies: DataFrame, rows: DataFrame) -> DataFrame:
    """Policies with every row whose dataset_id fits the policy's glob and whose family equals the policy's; unset means any.

    Globs are indexed by what stands before their first wildcard: each distinct id asks for its beginnings of the lengths
    that occur, by equality, and only these globs are tested on it. Globs that begin with a wildcard, or none, meet every id."""
    before = F.regexp_extract("dataset_pattern", r"^[^*?]*", 0)
    p = policies.withColumn("_pattern", glob_pattern("dataset_pattern")).withColumn("_begin", F.coalesce(before, F.lit("")))
    lengths = sorted(r[0] for r in p.select(F.length("_begin")).distinct().collect())  # no more than the longest glob has characters
    ids = rows.select(F.col("dataset_id").alias("_id")).distinct()
    text = F.coalesce("_id", F.lit(""))
    starts = F.filter(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>"), lambda n: n <= F.length(text))
    asked = ids.withColumn("_n", F.explode(starts)).select("_id", F.substring(text, F.lit(1), F.col("_n")).alias("_begin"))
    fits = asked.join(p, "_begin").where(F.col("dataset_pattern").isNull() | F.rlike(F.col("_id"), F.col("_pattern"))).drop("_begin", "_pattern")
    both = rows.join(fits, rows["dataset_id"].eqNullSafe(fits["_id"])).drop("_id")
    return both.where(F.col("policy_family").isNull() | (F.col("policy_family") == F.col("dataset_family")))


def pending(raw: DataFrame, done: list[DataFrame], keys: list[str]) -> DataFrame:
    """Keys of ``raw`` that are not in all of the ``done`` tables."""
    finished = reduce(lambda a, b: a.join(b, keys, "left_semi"), [d.select(*keys).distinct() for d in done])
    return raw.select(*keys).distinct().join(finished, keys, "left_anti")


def neighbours(edges: DataFrame, uri: str, limit: int) -> DataFrame:
    """Inbound and outbound edges of a URI, newest first, at most ``limit`` of each direction."""
    side = lambda c, name: edges.where(F.col(c) == uri).orderBy(F.desc_nulls_last("created_at"), F.desc("edge_id")).limit(limit).withColumn("direction", F.lit(name))
    return side("dst_uri", "inbound").unionByName(side("src_uri", "outbound"))


# ---------------------------------------------------------------- merges


def newest(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first by ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with the rows of ``new`` replacing those of equal keys. Keys are unique on either side."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def upsert_keeping(old: DataFrame, new: DataFrame, keys: list[str], insert_only: tuple[str, ...] = ()) -> DataFrame:
    """A null of ``new`` doesn't overwrite; ``insert_only`` columns keep the value of the first insert."""
    both = old.alias("o").join(new.alias("n"), keys, "full_outer")
    value = lambda c: F.coalesce(f"o.{c}", f"n.{c}") if c in insert_only else F.coalesce(f"n.{c}", f"o.{c}")
    return both.select(*keys, *(value(c).alias(c) for c in new.columns if c not in keys))


def merge_daily(path: str, new: DataFrame, keys: list[str], day: str = "dt", insert_only: tuple[str, ...] | None = None) -> None:
    """Merges rows into the table under ``path``, partitioned by ``day`` (a part of the keys): ``upsert``, or ``upsert_keeping`` where
    ``insert_only`` is given. Only the days of the new rows are read and replaced; the files of other days stay."""
    from ..sources.scratch import written

    new = written(new, "new-rows")
    days = [r[0] for r in new.select(day).distinct().collect()]  # of the new rows; as literals they prune folders
    if not days:
        return
    spark = new.sparkSession
    try:
        old = spark.read.schema(new.schema).parquet(path).where(F.col(day).isin(days))
    except AnalysisException as e:  # a new table
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old = spark.createDataFrame([], new.schema)
    merged = upsert(old, new, keys) if insert_only is None else upsert_keeping(old, new, keys, insert_only)
    merged = written(merged.select(*new.columns), "merged-days")  # what is read is about to be replaced
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
