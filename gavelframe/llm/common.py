"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch handed to Python; keeps a batch of very long texts small.
ARROW_ROWS = 256


@contextmanager
def arrow_rows(spark: SparkSession, rows: int | None = ARROW_ROWS) -> Iterator[None]:
    """At most so many rows in an Arrow batch of the plans that run inside; the session's own setting afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        if rows:
            spark.conf.set(key, str(rows))
        yield
    finally:
        spark.conf.set(key, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where that is unset, a temporary one in local mode only."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        conf = current.get() if current.isDefined() else None
    if not conf:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="gavelframe-ckpt-")
        spark.sparkContext.setCheckpointDir(conf)
    return conf.rstrip("/")


def materialize(df: DataFrame, name: str = "t", rows: int | None = None) -> DataFrame:
    """Cut lineage: write df as a table in the shared folder and read it back. rows: those of an Arrow batch meanwhile."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/gf-{name}-{uuid.uuid4().hex}"
    with arrow_rows(spark, rows):
        df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._gf_path = path
    return back


def release(*tables: DataFrame | None) -> None:
    """Delete tables that materialize() wrote, once nothing reads them any more."""
    for df in tables:
        if path := getattr(df, "_gf_path", None):
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def collect_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage, so that Spark deletes the shuffle files of what has been materialised.

    Spark holds the last job's shuffles until another job runs, so that a job of one row goes first.
    """
    spark.range(0, 1, 1, 1).write.format("noop").mode("overwrite").save()
    gc.collect()
    spark._jvm.System.gc()


def give_back() -> None:
    """Return to the system what this Python worker has freed.

    Spark keeps workers between tasks, and their allocators keep what the largest task so far took, so that without this
    idle workers take an executor's memory from whatever runs later.
    """
    POWERS.clear()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run for mapInArrow, after which the worker gives its memory back."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def apart(docs: DataFrame, *names: str) -> list[str]:
    """names, lengthened where docs have such a column (in either case), for columns that are added to docs for a while."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- numeric text

MUL = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
BASE = 0x9E3779B97F4A7C15 | 1


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    h = h ^ (h >> np.uint64(30))
    h *= MIX
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, for hashes of substrings by prefix sums."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            inverse = pow(BASE, -1, 1 << 64)
            for name, base in (("up", BASE), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def span_hashes(units: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of units[start:end], equal for equal content wherever it stands."""
    up, down = POWERS.get(len(units) + 1)
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MUL)


def chunks(texts: list, limit: int):
    """Ranges [i, j) of texts of about limit characters together; a longer text stands alone, whole."""
    i = size = 0
    for j, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield i, j
            i, size = j, 0
        size += len(text)
    if i < len(texts):
        yield i, len(texts)
