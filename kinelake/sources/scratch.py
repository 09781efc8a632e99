"""A shared folder for intermediate tables: the session's spark.checkpoint.dir, or on a local master a temporary one."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table, so that what several branches use is computed once."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
