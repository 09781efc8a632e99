"""What the operators share: reading tables, cutting lineage, Arrow batches and byte-level text kernels."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as the contracts define it.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes that one Arrow batch holds at least before it is sent on.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only on a local master, where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: cuts lineage and survives lost executors."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files and broadcasts of plans that nobody refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


class Scratch:
    """Intermediate tables of one operator in a folder of their own under the checkpoint folder; ``drop`` and ``clear`` delete what later
    tables, already written, no longer need."""

    def __init__(self, spark: SparkSession):
        self.spark, self.top = spark, f"{checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.top}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._delete(f"{self.top}/{name}")

    def clear(self) -> None:
        self._delete(self.top)

    def _delete(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A narrow written table, marked for broadcast if it has at most ``rows`` rows; larger ones are shuffled."""
    return F.broadcast(df) if df.count() <= rows else df


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the bytes of an Arrow batch, so that long texts don't fill a Python worker, with the same value for every operator;
    lets workers import this package."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def hash_sample(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` rows with the least hashes of ``keys``. Of a large table only rows below a hash that leaves about twice
    as many are compared, so that no task sees rows in proportion to the number of partitions."""
    h, total = F.xxhash64(*keys), df.count()
    if total > 2 * n:
        df = df.where(h <= F.lit(min(2**63 - 1, int(-(2**63) + 2.0**64 * ((2.0 * n + 100) / total)))))
    return df.orderBy(h, *keys).limit(n)


def hash_bound(df: DataFrame, key: str, n: int) -> int | None:
    """The hash up to which about ``n`` rows are taken (ids may repeat); None for an empty table. Reads only the key."""
    return hash_sample(df.select(key), [key], n).agg(F.max(F.xxhash64(key))).first()[0]


def held_out(doc_id: str, mod: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod == remainder


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a string column as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def joined(texts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes with one blank after each text, and the offset of each text and of the end."""
    texts = list(texts)
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=off[1:])
    return np.frombuffer(b" ".join(texts) + b" " if texts else b"", np.uint8), off


# ---------------------------------------------------------------- words of a joined buffer

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

BASE = 0x9E3779B97F4A7C15  # odd, so that it can be inverted modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, out=out)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class PrefixHash:
    """Polynomial hashes modulo 2**64 of any substring of a buffer, from one prefix array."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self.power = powers(BASE, n + 1)
        inverse = powers(_INVERSE, n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * inverse[:n], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.prefix[end] - self.prefix[start]) * self.power[start]


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a joined buffer."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~SPACE[buf]
    turn = np.diff(inside)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray, tuple]:
    """64-bit hashes of all words, the number of words of each text, and (buffer, starts, ends)."""
    buf, off = joined(texts)
    if lower:
        buf = LOWER[buf]
    start, end = word_spans(buf)
    hashes = mixed(PrefixHash(buf).of(start, end) + (end - start).astype(np.uint64)) if len(buf) else np.zeros(0, np.uint64)
    counts = np.diff(np.searchsorted(start, off)) if len(texts) else np.zeros(0, np.int64)
    return hashes, counts, (buf, start, end)
