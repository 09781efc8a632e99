"""How queries are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import cte, frame

Query = Callable[[SparkSession, str], DataFrame]


#: Added before rounding on both sides, so that a value halfway between two results rounds alike.
NUDGE = 3e-9


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as sums of doubles depend on their order."""
    return df.select(*(F.round(F.col(c) + NUDGE, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def nudged(sql: str) -> str:
    """The same in a query's text: round(x, 6) becomes round((x) + NUDGE, 6)."""
    out, at = [], 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 1, start + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = nudged(sql[start + 6 : end - 1])
        out += [sql[at:start], f"round(({inner[:-3]}) + {NUDGE}, 6)" if inner.endswith(", 6") else f"round({inner})"]
        at = end
    return "".join(out) + sql[at:]


class Family:
    """A set of queries over named views or tables."""

    def __init__(self):
        self.QUERIES: dict[str, Query] = {}
        self.ORACLES: dict[str, str] = {}

    def add(self, name: str, views: list[str], build: Callable[..., DataFrame], sql: str | None = None, source: Callable[[SparkSession, str, str], DataFrame] = frame) -> None:
        """``build`` gets a DataFrame per view from ``source``; ``sql`` is DuckDB SQL over views and tables."""

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(build(*(source(spark, sf_dir, v) for v in views)))

        self.QUERIES[name] = run
        if sql:
            self.ORACLES[name] = nudged(cte(sql))
