"""Zones of files: results as without them, and how many files are opened."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lanemart.sources.bounds import since_id
from lanemart.sources.zones import since_id_by_zones, write_zones


def save(spark, path, low, high, mode="append", null=False):
    df = spark.range(low, high, 1, 1).select("id", (F.col("id") % 7).alias("v"))
    df = df.union(spark.range(1).selectExpr("cast(null as long) id", "1L v")).coalesce(1) if null else df
    df.write.mode(mode).parquet(path)


def same(spark, path, start, zones):
    found = since_id_by_zones(spark, path, "id", start, zones)
    want = since_id(spark.read.parquet(path), "id", start)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    return len(found.inputFiles())


def test_only_files_that_reach_the_watermark_are_opened(spark, tmp_path):
    path, zones = f"{tmp_path}/data", f"{tmp_path}/zones"
    for k in range(6):
        save(spark, path, 100 * k, 100 * k + 100, null=k == 2)
    write_zones(spark, path, "id", zones)
    opened = [same(spark, path, start, zones) for start in (-5, 0, 100, 450, 599)]
    assert opened == [6, 6, 5, 2, 1]
    assert since_id_by_zones(spark, path, "id", 600, zones).columns == ["id", "v"] and same(spark, path, 600, zones) == 0


def test_files_without_a_zone_are_read_and_zones_are_brought_up_to_date(spark, tmp_path):
    path, zones, newer = f"{tmp_path}/data", f"{tmp_path}/zones", f"{tmp_path}/newer"
    save(spark, path, 0, 50)
    save(spark, path, 50, 100)
    write_zones(spark, path, "id", zones)
    save(spark, path, 20, 60)  # late rows
    save(spark, path, 900, 950)
    assert same(spark, path, 90, zones) == 3
    write_zones(spark, path, "id", newer, known=zones)
    assert same(spark, path, 90, newer) == 2 and spark.read.parquet(newer).count() == 4
    save(spark, path, 10, 95, mode="overwrite")
    assert same(spark, path, 90, newer) == 1
    write_zones(spark, path, "id", zones, known=newer)
    assert spark.read.parquet(zones).select("least", "most", "rows").collect() == [(10, 94, 85)]
    with pytest.raises(ValueError, match="beside"):
        write_zones(spark, path, "id", zones, known=zones)


def test_partition_columns_and_null_ids(spark, tmp_path):
    path, zones = f"{tmp_path}/data", f"{tmp_path}/zones"
    df = spark.range(40).select(F.expr("if(id < 10, null, id)").alias("id"), F.lit("x").alias("v"), F.floor(F.col("id") / 10).alias("p"))
    df.repartition(1).write.partitionBy("p").parquet(path)
    write_zones(spark, path, "id", zones)
    assert same(spark, path, 15, zones) == 3
