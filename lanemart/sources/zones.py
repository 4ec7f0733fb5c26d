"""Least and largest id of every file of a Parquet table, so that an id watermark opens only files that can hold newer rows.

The zones are a small table beside the data, one row per file, made and brought up to date by Spark jobs. A zone counts only
while its file has the same size and time; files without one are read, so a stale table of zones costs time, not rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE = ("file", "size", "changed")


def _stamp() -> list:
    return [F.col(f"_metadata.{n}").alias(a) for n, a in zip(("file_path", "file_size", "file_modification_time"), FILE)]


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """The files of a table as they are now; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", *_stamp())


def _scan(spark: SparkSession, path: str, files: DataFrame, schema: T.StructType) -> DataFrame:
    """Some files of a table. Their names come to the driver, which holds the file list of any scan it plans."""
    paths = [r["path"] for r in files.select("path").toLocalIterator()]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def write_zones(spark: SparkSession, path: str, id_col: str, zones_path: str, known: str | None = None) -> None:
    """Write the zones of a table to ``zones_path``; with ``known``, earlier zones elsewhere, only new files are scanned.

    Reads the id column alone. A file with null ids only has no bounds. Files that are gone lose their zone.
    """
    if known == zones_path:
        raise ValueError("write new zones beside the known ones, then use the new ones")
    files = _listed(spark, path)
    if known is None:
        kept, fresh = None, files
    else:
        kept = spark.read.parquet(known).join(files.select(*FILE), on=list(FILE), how="left_semi")
        fresh = files.join(spark.read.parquet(known).select(*FILE), on=list(FILE), how="left_anti")
    paths = [r["path"] for r in fresh.select("path").toLocalIterator()]
    if paths:
        rows = spark.read.option("basePath", path).parquet(*paths).select(F.col(id_col).cast("long").alias("id"), *_stamp())
        new = rows.groupBy(*FILE).agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("rows"))
        kept = new if kept is None else kept.unionByName(new)
    if kept is None:
        kept = spark.createDataFrame([], "file string, size long, changed timestamp, least long, most long, rows long")
    kept.coalesce(1).write.mode("overwrite").parquet(zones_path)


def since_id_by_zones(spark: SparkSession, path: str, id_col: str, start: int, zones_path: str) -> DataFrame:
    """Rows with ids from ``start`` on. Only files whose zone reaches ``start``, or that have none, are opened.

    Rows with null ids are not returned, as with ``bounds.since_id``.
    """
    zones = spark.read.parquet(zones_path).withColumn("zoned", F.lit(True))
    files = _listed(spark, path).join(zones, on=list(FILE), how="left")
    asked = files.filter(F.col("zoned").isNull() | (F.col("most") >= F.lit(start)))
    return _scan(spark, path, asked, spark.read.parquet(path).schema).filter(F.col(id_col) >= F.lit(start))
