"""Which adapter reads which dataset: an exact id first, then the first registered prefix that fits, then the fallback.

Slices of different families may stand in one table with the union of their columns. Each row is routed by an expression over its
dataset_id; an adapter sees its own rows only, and picks the pose by what a row has, not by what the table has.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.series import from_euler
from .tables import POSE, vector_pose

Adapter = Callable[[DataFrame], DataFrame]
SLICE = ["dataset_id", "version", "episode_id", "frame_idx"]


class Registry:
    def __init__(self, fallback: Adapter | None = None):
        self.exact: dict[str, str] = {}
        self.prefixes: list[tuple[str, str]] = []
        self.adapters: dict[str, Adapter] = {"fallback": fallback or row_poses}

    def register(self, name: str, adapter: Adapter, match: str = "exact") -> None:
        """``name`` is a dataset id, or a prefix of ids. A later registration of the same name wins."""
        key = f"{match}:{name}"
        if match == "exact":
            self.exact[name] = key
        elif match == "prefix":
            self.prefixes = [p for p in self.prefixes if p[0] != name] + [(name, key)]
        else:
            raise ValueError(f"match is exact or prefix, not {match}")
        self.adapters[key] = adapter

    def listed(self) -> list[tuple[str, str]]:
        return [(n, "exact") for n in sorted(self.exact)] + [(n, "prefix") for n, _ in self.prefixes]

    def route(self, dataset_id: Column) -> Column:
        """The name of the adapter of each row."""
        exact = F.create_map(*(F.lit(x) for pair in self.exact.items() for x in pair))[dataset_id] if self.exact else F.lit(None).cast("string")
        return F.coalesce(exact, *(F.when(F.startswith(dataset_id, F.lit(p)), key) for p, key in self.prefixes), F.lit("fallback"))

    def frames(self, df: DataFrame) -> DataFrame:
        """SLICE, the pose, pose_source and adapter of every row of a table of mixed slices; adapters return SLICE and the pose."""
        routed = df.withColumn("adapter", self.route(F.col("dataset_id")))
        parts = [make(routed.where(F.col("adapter") == name).drop("adapter")).withColumn("adapter", F.lit(name)) for name, make in self.adapters.items()]
        out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        source = F.coalesce(F.col("pose_source"), F.col("adapter")) if "pose_source" in out.columns else F.col("adapter")
        return out.select(*SLICE, *POSE, source.alias("pose_source"), "adapter")


#: Columns that hold x, y, z and a quaternion as a vector, best first.
VECTORS = ("cartesian_pose", "tcp_pose", "ee_pose", "observation.state")


def row_poses(df: DataFrame) -> DataFrame:
    """The best pose that each row offers: angles in ``cartesian_position``, a vector column, the seven flat columns."""
    names = set(df.columns)
    options: list[tuple[Column, Column, str]] = []
    pose = lambda columns: F.struct(*(c.cast("double").alias(n) for c, n in zip(columns, POSE)))
    if "cartesian_position" in names:
        c = F.col("cartesian_position")
        df = df.withColumns({f"_{n}": c[i].cast("double") for i, n in enumerate(("roll", "pitch", "yaw"), 3)})
        held = [n for n in ("qx", "qy", "qz", "qw") if n in names]
        turned = from_euler(df.withColumns({f"_kept_{n}": F.col(n) for n in held}), ("_roll", "_pitch", "_yaw"))
        df = turned.withColumns({f"_turned_{n}": F.col(n) for n in ("qx", "qy", "qz", "qw")}).withColumns({n: F.col(f"_kept_{n}") for n in held})
        options.append((F.size(c) >= 6, pose([c[0], c[1], c[2], *(F.col(f"_turned_{n}") for n in ("qx", "qy", "qz", "qw"))]), "cartesian_position"))
    for n in VECTORS:
        if n in names and isinstance(df.schema[n].dataType, T.ArrayType):
            c = F.col(f"`{n}`")
            options.append((F.size(c) >= 7, pose(vector_pose(c)), n))
    if set(POSE) <= names:
        options.append((reduce(Column.__and__, (F.col(n).isNotNull() for n in POSE)), pose([F.col(n) for n in POSE]), "columns"))
    if not options:
        raise ValueError(f"no pose among {sorted(names)}")
    best = F.coalesce(*(F.when(there, F.struct(p.alias("p"), F.lit(n).alias("n"))) for there, p, n in options))
    return df.withColumn("_best", best).select(*SLICE, *(F.col(f"_best.p.{n}").alias(n) for n in POSE), F.col("_best.n").alias("pose_source"))
