"""Written intermediate tables in the folder that the cluster names in ``spark.checkpoint.dir``.

An intermediate table is written once as Parquet and read again, which cuts the lineage: when an executor is lost,
later tasks read the files instead of recomputing what led to them.
"""

from __future__ import annotations

import ctypes
import inspect
import tempfile
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most bytes of an Arrow batch: bounds what a Python worker holds of long texts.
ARROW_BYTES = 8 << 20
#: Bits of a filter on ids. It only saves work; its size doesn't grow with the input.
FILTER_BITS = 1 << 23
_ARROW_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
_FACTOR_KEY = "spark.sql.sources.fileCompressionFactor"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset, a local session (tests) gets a temporary folder; on a
    cluster, whose executors would not see that, it is an error."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='corpusloom-')}")
        given = spark.sparkContext.getCheckpointDir()
    return given.rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes; a lower bound that the session has already stays."""
    if not 0 < int(spark.conf.get(_ARROW_KEY).rstrip("bB")) <= ARROW_BYTES:
        spark.conf.set(_ARROW_KEY, f"{ARROW_BYTES}b")


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the size of ``df``: for scans, that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bins(df: DataFrame, bytes_each: int, least: int = 24) -> int:
    """Into how many bins to deal what is made from ``df``, so that a bin stays near ``bytes_each`` of the input. It
    follows the input and not the number of partitions: values packed for each pair of bins would be many and small."""
    size = plan_bytes(df)
    return max(least, -(-size // bytes_each) if size < 1 << 50 else 0)  # else there is no estimate


def id_filter(ids: DataFrame) -> np.ndarray:
    """FILTER_BITS bits, of which those of the hashed ids are set: at most 1 MB reaches the driver, whatever the input."""
    h = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    bits = F.bitmap_construct_agg(F.col("h").bitwiseAND(F.lit(32767)))
    rows = ids.select(h.alias("h")).groupBy(F.shiftright("h", 15).alias("at")).agg(bits.alias("bits")).collect()
    bits = np.zeros((FILTER_BITS >> 15, 32768 // 8), np.uint8)
    for r in rows:
        bits[r["at"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return np.unpackbits(bits.ravel(), bitorder="little").astype(bool)


class Scratch:
    """Tables of one run of an operator, below :func:`shared_dir`. ``packed``: bytes that a byte of its files becomes when
    read, so that Spark, which broadcasts by the size of files, sends no more through the driver than it means to."""

    def __init__(self, spark: SparkSession, tag: str, packed: float = 1.0):
        self.spark, self.packed = spark, packed
        self.root = f"{shared_dir(spark)}/corpusloom/{tag}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        """Writes ``df`` and returns the written table. The shuffle files that made it go at once, the table itself
        when the session ends, or by :meth:`drop`."""
        path, schema = self.path(name), df.schema
        before = {k: self.spark.conf.get(k) for k in (_CLEANUP_KEY, _FACTOR_KEY)}
        self.spark.conf.set(_CLEANUP_KEY, "true")
        self.spark.conf.set(_FACTOR_KEY, str(max(self.packed, float(before[_FACTOR_KEY]))))
        try:
            df.write.mode("overwrite").option("compression", codec).parquet(path)
        finally:
            for k, v in before.items():
                self.spark.conf.set(k, v)
        hadoop, fs = self._hadoop(name)
        fs.deleteOnExit(hadoop)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing will read again."""
        for name in names:
            hadoop, fs = self._hadoop(name)
            fs.delete(hadoop, True)

    def _hadoop(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())


def lean(f: Callable) -> Callable:
    """``f``, of Arrow batches or tables, after which the worker gives back the memory that it holds for reuse: workers
    outlive their tasks and would keep each one's peak."""
    if inspect.isgeneratorfunction(f):

        def batches(given):
            yield from f(given)
            release()

        return batches
    if len(inspect.signature(f).parameters) == 2:

        def pair(left, right):
            out = f(left, right)
            release()
            return out

        return pair

    def one(given):
        out = f(given)
        release()
        return out

    return one


def release() -> None:
    """Gives free memory back to the system, where the C library can."""
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not glibc
        return
    trim.argtypes = [ctypes.c_size_t]
    trim(0)
