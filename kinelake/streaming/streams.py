"""Event streams, each with a batch twin that gives the same rows for finished input."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """JSON lines as they arrive, ``files`` files at a time."""
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files).json(path)


def deduplicated(events: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Each event once within the lateness bound."""
    return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["event_id"])


def deduplicated_batch(events: DataFrame) -> DataFrame:
    return events.dropDuplicates(["event_id"])


def hourly(events: DataFrame, lateness: str = "2 days", width: str = "1 hour") -> DataFrame:
    """Counts by hour and type. On a stream, rows later than the watermark are dropped."""
    rows = events.withWatermark("ts", lateness) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), "event_type", "n")


BEAT = ["workflow_name", "phase", "step_name"]
STATE = "updated_at timestamp, event_id long, warned boolean"
LIVE = "workflow_name string, phase string, step_name string, updated_at timestamp, event_id long, state string"


class Heartbeats(StatefulProcessor):
    """State of one workflow, phase and step: its last heartbeat, with one timer at the next moment it may turn ``warn`` or ``stale``."""

    def __init__(self, warn: float, stale: float):
        self.after = {"warn": warn, "stale": stale}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.last = handle, handle.getValueState("last", STATE)

    def wake(self, when: pd.Timestamp, grade: str, timers: TimerValues) -> None:
        """The only timer from now on: when event time is past ``when`` by what ``grade`` takes, or at the next watermark if it is already."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = int(when.timestamp() * 1000 + self.after[grade] * 1000)
        self.handle.registerTimer(max(due, timers.getCurrentWatermarkInMs() + 1))

    def seen(self) -> tuple[pd.Timestamp, int]:
        when, event, _ = self.last.get() if self.last.exists() else (pd.Timestamp(0), -1, False)
        return pd.Timestamp(when), event

    def put(self, when: pd.Timestamp, event: int, warned: bool) -> None:
        self.last.update((when.to_pydatetime(), event, warned))

    def row(self, key: tuple, when: pd.Timestamp, event: int, state: str) -> pd.DataFrame:
        return pd.DataFrame({**{n: [k] for n, k in zip(BEAT, key)}, "updated_at": [when], "event_id": [event], "state": [state]})

    def handleInitialState(self, key: tuple, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        first = initialState.sort_values(["updated_at", "event_id"]).iloc[-1]
        if first.state != "stale" and (first.updated_at, first.event_id) > self.seen():
            self.put(first.updated_at, int(first.event_id), first.state == "warn")
            self.wake(first.updated_at, "stale" if first.state == "warn" else "warn", timerValues)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        when, event = self.seen()
        for b in rows:
            last = b.sort_values(["updated_at", "event_id"]).iloc[-1]
            if (last.updated_at, last.event_id) > (when, event):
                when, event = last.updated_at, int(last.event_id)
        self.put(when, event, False)
        self.wake(when, "warn", timerValues)
        yield self.row(key, when, event, "ok")

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        when, event = self.seen()
        if timerValues.getCurrentWatermarkInMs() >= when.timestamp() * 1000 + self.after["stale"] * 1000:
            self.last.clear()
            yield self.row(key, when, event, "stale")
        else:
            self.put(when, event, True)
            self.wake(when, "stale", timerValues)
            yield self.row(key, when, event, "warn")


def liveness(heartbeats: DataFrame, warn: float, stale: float, lateness: str = "2 days", known: DataFrame | None = None) -> DataFrame:
    """The last heartbeat of each workflow, phase and step: ``ok`` as it moves on, ``warn`` and then ``stale`` when event time
    is so many seconds past it. A step that went stale may come back.

    ``known`` (rows as of ``liveness_batch``) is what the stream starts from: its steps turn ``warn`` and ``stale`` without a
    heartbeat of their own, those that are stale in it stay so. It is read in a new stream's first batch only; a stream that
    starts again from its checkpoint goes on from its own state. Steps that go stale leave the state, so it is bounded by
    the steps alive. Needs the RocksDB state store, see ``state_store``."""
    rows = heartbeats.withWatermark("updated_at", lateness).groupBy(*BEAT)
    first = None if known is None else known.select(*BEAT, "updated_at", "event_id", "state").groupBy(*BEAT)
    return rows.transformWithStateInPandas(Heartbeats(warn, stale), LIVE, "append", "EventTime", first)


def liveness_now(emitted: DataFrame) -> DataFrame:
    """Where the steps stand after all that a stream has emitted: the last event and its gravest state."""
    grave = F.array_position(F.array(*map(F.lit, ("ok", "warn", "stale"))), F.col("state"))
    last = F.max_by(F.struct("updated_at", "event_id", "state"), F.struct("updated_at", "event_id", grave))
    return emitted.groupBy(*BEAT).agg(last.alias("l")).select(*BEAT, "l.*")


def liveness_batch(heartbeats: DataFrame, warn: float, stale: float, now: Column) -> DataFrame:
    """The same from a whole table, at a point of event time."""
    last = heartbeats.groupBy(*BEAT).agg(F.max_by(F.struct("updated_at", "event_id"), F.struct("updated_at", "event_id")).alias("l")).select(*BEAT, "l.*")
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("updated_at").cast("timestamp"))
    return last.withColumn("state", F.when(age >= stale * 1e6, "stale").when(age >= warn * 1e6, "warn").otherwise("ok"))


def committed(spark: SparkSession, path: str) -> DataFrame:
    """The ledger of a mart: batch, n_rows of every batch that is wholly in it."""
    try:
        return spark.read.schema("n_rows long, batch long").parquet(f"{path}/ledger")
    except AnalysisException as e:  # before the first batch
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "n_rows long, batch long")


def merged_batch(df: DataFrame, batch: int, states: Callable[[DataFrame], DataFrame], merged: Callable[[DataFrame], DataFrame], path: str) -> None:
    """Brings a batch of facts into the mart under ``path``/daily; the same batch again gives the same mart.

    ``states`` makes mergeable partial rows per day (column dt) of facts, ``merged`` makes mart rows of partial rows. A batch's facts
    and states are written under its id, over what a failed attempt may have left. The days that it touches are then made anew
    from the states of these days only, of batches in the ledger and of this one; the ledger is written last."""
    spark = df.sparkSession
    write = lambda rows, name, *by: rows.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/{name}/batch={batch}")
    write(df, "facts", "dt")
    kept = spark.read.schema(df.schema).parquet(f"{path}/facts/batch={batch}")
    own = states(kept)
    write(own, "states", "dt")
    known = committed(spark, path).select("batch").union(spark.createDataFrame([(batch,)], "batch long")).distinct()
    days = [r.dt for r in kept.select("dt").distinct().collect()]  # of one batch; as literals they prune the folders that are read
    if days:
        every = spark.read.schema(own.schema.add("batch", "long")).parquet(f"{path}/states")
        touched = every.where(F.col("dt").isin(days)).join(F.broadcast(known), "batch", "left_semi").drop("batch")  # a number per batch
        merged(touched).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(f"{path}/daily")
    spark.createDataFrame([(kept.count(),)], "n_rows long").write.mode("overwrite").parquet(f"{path}/ledger/batch={batch}")


def refreshing(facts: DataFrame, states: Callable[[DataFrame], DataFrame], merged: Callable[[DataFrame], DataFrame], path: str):
    """A writer that keeps a daily mart of a stream of facts exactly once; see ``merged_batch``."""
    return facts.writeStream.foreachBatch(lambda df, batch: merged_batch(df, batch, states, merged, path))


PROVIDER, ROCKSDB = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession, provider: str = ROCKSDB) -> Iterator[None]:
    """Streams started inside keep their state in this store; the session's own setting comes back afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, provider)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def drained(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there into a parquet table and returns it. State is in RocksDB."""
    with state_store(stream.sparkSession):
        q = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
