"""Reading and writing the tables of the lake and the warehouse."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import exprs as E

# ---------------------------------------------------------------- readers


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, bool]:
    """A table and whether it is there. Directories named dt=… don't become columns: the rows' own dt counts."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path), True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema), False


def read_slices(spark: SparkSession, root: str, file: str, schema: T.StructType) -> DataFrame:
    """root/<dataset_id>/<version>/<file>, blank ids filled from the path."""
    df = spark.read.schema(schema).parquet(f"{root}/*/*/{file}")
    path = F.col("_metadata.file_path")
    part = lambda k: F.element_at(F.split(F.regexp_replace(path, rf"/{file}(/.*)?$", ""), "/"), k)
    fill = lambda c, k: F.when(F.coalesce(c, F.lit("")) == "", part(k)).otherwise(F.col(c)).alias(c)
    return df.select(*(fill("dataset_id", -2) if c == "dataset_id" else fill("version", -1) if c == "version" else F.col(c) for c in df.columns))


REPORT = "dataset_id string, version string, status string, rules array<struct<rule_id:string,status:string>>"


def read_reports(spark: SparkSession, paths: str) -> DataFrame:
    """One JSON document per file."""
    return spark.read.option("multiLine", "true").schema(REPORT).json(paths)


def read_lines(spark: SparkSession, paths: str, schema: str, needed: str) -> DataFrame:
    """JSON lines; broken ones are dropped, and so are those without the ``needed`` field."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(paths).where(F.col(needed).isNotNull())


def chosen_split(split: DataFrame | None, features: DataFrame, name: str = "all") -> DataFrame:
    """Rows of one split, or all; features as a whole where there is no split table."""
    if split is None:
        return features
    return split if name == "all" else split.where(F.col("split") == name)


NODE = "struct<id:string,displayName:string,type:string,phase:string,startedAt:timestamp,finishedAt:timestamp,exitCode:string>"
DOCUMENT = f"struct<metadata:struct<name:string,namespace:string>,status:struct<phase:string,startedAt:timestamp,finishedAt:timestamp,nodes:map<string,{NODE}>>>"
#: Node types that are steps.
STEP_TYPES = ("Pod", "DAG", "Steps", "Container")


def workflow_documents(docs: DataFrame, column: str = "document") -> tuple[DataFrame, DataFrame]:
    """Run rows and step rows of workflow documents (JSON)."""
    d = docs.select(F.from_json(column, DOCUMENT).alias("d")).where("d.metadata.name is not null")
    run = d.select(F.col("d.metadata.name").alias("workflow_name"), F.col("d.metadata.namespace").alias("workflow_namespace"), F.col("d.status.phase").alias("phase"), seconds(F.col("d.status.startedAt"), F.col("d.status.finishedAt")).alias("duration_sec"))
    n = d.select(F.col("d.metadata.name").alias("workflow_name"), F.col("d.metadata.namespace").alias("workflow_namespace"), F.explode(F.map_values("d.status.nodes")).alias("n")).where(F.col("n.type").isin(*STEP_TYPES))
    steps = n.select("workflow_name", "workflow_namespace", F.col("n.id").alias("node_id"), F.col("n.displayName").alias("step_name"), F.col("n.type").alias("node_type"), F.col("n.phase").alias("phase"), seconds(F.col("n.startedAt"), F.col("n.finishedAt")).alias("duration_sec"), F.col("n.exitCode").try_cast("int").alias("exit_code"))
    return run, steps


def seconds(start: Column, finish: Column) -> Column:
    return (F.unix_micros(finish) - F.unix_micros(start)) / 1e6


def log_index(steps: DataFrame, root: str) -> DataFrame:
    """A log path per pod; other nodes have none."""
    path = F.concat_ws("/", F.lit(root.rstrip("/")), "workflow_namespace", "workflow_name", "node_id", F.lit("main.log"))
    return steps.select("workflow_name", "workflow_namespace", "node_id", F.when(F.col("node_type") == "Pod", path).alias("archive_log_uri"), "exit_code")


# ---------------------------------------------------------------- frames of robot datasets


def nested_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted names of all leaf columns."""
    out: list[str] = []
    for f in schema.fields:
        name = f"{prefix}{f.name}"
        out += nested_paths(f.dataType, f"{name}.") if isinstance(f.dataType, T.StructType) else [name]
    return out


POSE = ("x", "y", "z", "qx", "qy", "qz", "qw")


def bridge_frames(df: DataFrame) -> DataFrame:
    """state.end_effector_pose and action.pose as flat columns, action.grasp beside them."""
    return df.select("episode_id", "frame_idx", *(F.col(f"state.end_effector_pose.{c}").cast("double").alias(c) for c in POSE), F.col("action.grasp").cast("double").alias("grasp"))


def vector_pose(c: Column) -> list[Column]:
    return [c[i].cast("double").alias(n) for i, n in enumerate(POSE)]


#: Columns that hold a pose, best first: angles, vectors, seven flat columns, a guess.
DROID = ("cartesian_position", "cartesian_pose", "tcp_pose", "ee_pose", "observation.state")


def droid_frames(df: DataFrame) -> DataFrame:
    """The best pose that the columns offer, and which one it was."""
    from ..operators.series import from_euler

    names, keys = set(df.columns), ["episode_id", "frame_idx"]
    if "cartesian_position" in names:  # x, y, z, roll, pitch, yaw
        c = F.col("cartesian_position")
        flat = df.select(*keys, *(c[i].cast("double").alias(n) for i, n in enumerate(("x", "y", "z", "roll", "pitch", "yaw"))))
        return from_euler(flat).select(*keys, *POSE, F.lit("cartesian_position").alias("pose_source"))
    for name in DROID[1:4]:
        if name in names:
            return df.select(*keys, *vector_pose(F.col(name)), F.lit(name).alias("pose_source"))
    if set(POSE) <= names:
        return df.select(*keys, *(F.col(c).cast("double").alias(c) for c in POSE), F.lit("columns").alias("pose_source"))
    if "observation.state" in names:
        return df.select(*keys, *vector_pose(F.col("`observation.state`")), F.lit("observation.state (guessed)").alias("pose_source"))
    raise ValueError(f"no pose among {sorted(names)}")


#: What vector columns that hold poses are called, best first.
HINTS = ("pose", "state", "ee", "tcp", "position", "observation")


def guessed_frames(df: DataFrame, keys: tuple[str, ...] = ("episode_id", "frame_idx")) -> DataFrame:
    """Seven scalar columns, a struct with the seven names, or the first vector column by hint whose vectors reach seven."""
    if set(POSE) <= set(df.columns):
        return df.select(*keys, *(F.col(c).cast("double").alias(c) for c in POSE))
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType) and set(POSE) <= set(f.dataType.names):
            return df.select(*keys, *(F.col(f.name)[c].cast("double").alias(c) for c in POSE))
    vectors = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    rank = lambda n: next((i for i, h in enumerate(HINTS) if h in n.lower()), len(HINTS))
    for name in sorted(vectors, key=lambda n: (rank(n), n)):
        if (df.select(F.size(name).alias("n")).agg(F.min("n")).first()[0] or 0) >= 7:
            return df.select(*keys, *vector_pose(F.col(name)))
    raise ValueError(f"no pose among {df.columns}")


# ---------------------------------------------------------------- writers


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns, in order and of the declared types; missing ones are null."""
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def write_daily(df: DataFrame, path: str, day: str = "dt") -> None:
    """Overwrites the partitions of the days in ``df`` and no others; a rerun gives the same table."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def export(df: DataFrame, path: str, kind: str, sources: tuple[str, ...] = ()) -> DataFrame:
    """Writes parquet, csv or json and returns a manifest row. Counts come from the write itself."""
    seen = Observation()
    checksum = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).cast("string")
    df.observe(seen, F.count("*").alias("n_rows"), checksum.alias("checksum")).write.mode("overwrite").format(kind).option("header", "true").save(path)
    got = seen.get
    return df.sparkSession.createDataFrame([(path, kind, got["n_rows"], got["checksum"], list(sources))], "path string, format string, n_rows long, checksum string, sources array<string>")


def layer_manifest(df: DataFrame, keys: list[str], day: str | None = None, metrics: dict[str, Column] | None = None, job: dict[str, str] | None = None) -> DataFrame:
    """Per slice: files, rows, first and last day (of column ``day``), metrics (aggregates by name, as JSON) and the job that
    wrote it (as JSON). Absent parts are null."""
    days = [F.min(day).alias("first_day"), F.max(day).alias("last_day")] if day else [F.lit(None).cast("date").alias(n) for n in ("first_day", "last_day")]
    measured = F.to_json(F.struct(*(v.alias(k) for k, v in metrics.items()))) if metrics else F.lit(None).cast("string")
    by = F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in job.items()))) if job else F.lit(None).cast("string")
    rows = df.withColumn("_file", F.col("_metadata.file_path"))
    return rows.groupBy(*keys).agg(F.count_distinct("_file").alias("n_files"), F.count("*").alias("n_rows"), *days, measured.alias("metrics")).withColumn("job", by)


def write_records(df: DataFrame, path: str, split: str = "split") -> None:
    """JSON lines, a folder per split."""
    df.write.mode("overwrite").partitionBy(split).json(path)


def lineage_edges(outputs: DataFrame, source: str, job: str) -> DataFrame:
    """An edge per output file, to be appended."""
    return outputs.select(E.key(F.lit(source), "uri", F.lit(job)).alias("edge_key"), F.lit(source).alias("src_uri"), F.col("uri").alias("dst_uri"), F.lit(job).alias("job"))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def stale(heartbeats: DataFrame, now: Column, warn: float = 60.0, dead: float = 300.0) -> DataFrame:
    """The last heartbeat of each step and whether it is late."""
    keys = ["workflow_name", "phase", "step_name"]
    w = Window.partitionBy(*keys).orderBy(F.desc("updated_at"), F.desc("event_id"))
    last = heartbeats.withColumn("_p", F.row_number().over(w)).where("_p = 1")
    age = seconds(F.col("updated_at").cast("timestamp"), now.cast("timestamp"))
    return last.withColumn("age_sec", age).select(*keys, "event_id", "age_sec", E.ladder([(F.col("age_sec") >= dead, "stale"), (F.col("age_sec") >= warn, "warn")], "ok").alias("state"))
