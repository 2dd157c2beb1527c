"""The shared folder, written intermediates and Arrow helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What XML, HTML and C call white space in ASCII; bytes.split() splits at exactly these.
ASCII_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
ROWS_PER_BATCH = 1000


def use_settings(spark: SparkSession) -> SparkSession:
    """UTC, and Arrow batches small enough that a batch of long texts fits a Python worker."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one below /tmp only on a single machine without it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate once to the shared folder and read it back: lineage ends there."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a stored intermediate that no later result reads."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(conf).delete(path, True)


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared path, for tasks that write or read files of their own format."""
    return fs.FileSystem.from_uri(path)


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker; the package's code is sent to it by value."""
    return sys.modules.setdefault("_postlode_worker", types.ModuleType("_postlode_worker")).__dict__


def _give_back() -> None:
    """Return memory that is free in this process to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable, *keeps: str) -> Callable:
    """``run`` for ``mapInArrow``, in Python workers that outlive it and serve many operators in turn.

    An executor has several workers, most of them idle, so what each holds counts as many times. What
    other operators cached goes before the task, but for the kinds of entries in ``keeps``; what the
    task has freed goes back to the system after it.
    """

    def task(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache()
        kinds = {k: k[0] if isinstance(k, tuple) else k for k in cache}
        others = [k for k, kind in kinds.items() if kind not in keeps and not kind.startswith("__")]
        if others:
            for key in others:
                del cache[key]
            gc.collect()
            _give_back()
        try:
            yield from run(iterator)
        finally:
            _give_back()

    return task


def byte_texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts_of(documents: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` as long, ``text``, and the columns named; other columns are left behind."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc_remainder(column: str, modulus: int):
    """crc32 of an id as text, modulo ``modulus``; a null id has remainder 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(0))


def batches(iterator: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in iterator if b.num_rows)
