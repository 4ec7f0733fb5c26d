"""What several operators share: reading tables, cutting lineage, stable remainders, checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: what the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset and the session is local (tests) is a temporary folder made, and set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint a frame in the shared folder, so that what follows does not depend on what came before."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def forget(spark: SparkSession) -> None:
    """Have the shuffle files of frames that are no longer in use removed now, rather than some time later.

    Spark removes them when the driver's garbage collection finds that nothing refers to them.
    """
    gc.collect()
    spark._jvm.System.gc()


def release() -> None:
    """Give freed memory back to the system: a Python process is used again, next to others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % divisor


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only after counting: up to ``rows`` rows, else leave the join to a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df

#: Rows of whole texts, and bytes, that go to a Python worker at a time.
TEXT_ROWS, TEXT_BYTES = 256, 2 << 20


def text_batches(df: DataFrame) -> DataFrame:
    """The frame, in a session that hands at most ``TEXT_ROWS`` rows and ``TEXT_BYTES`` bytes to a Python worker.

    The defaults are meant for numbers; with texts such a batch takes hundreds of megabytes, on both sides. A
    session with smaller settings keeps them.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", TEXT_ROWS), ("maxBytesPerBatch", TEXT_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = conf.get(name).rstrip("bB")
        if not (now.isdigit() and 0 < int(now) <= most):
            conf.set(name, str(most))
    return df
