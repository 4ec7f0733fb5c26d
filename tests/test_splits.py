"""Splits of reads: every row once, and parts of about equal size on skewed ids."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lanemart.sources.splits import equi_depth_bounds, split_predicates


def sizes(df, predicates):
    met = [F.expr(f"coalesce({p}, false)").cast("int") for p in predicates]
    assert df.filter(sum(met, F.lit(0)) != 1).count() == 0
    return list(df.agg(*[F.sum(m).alias(f"p{k}") for k, m in enumerate(met)]).first())


def test_parts_are_even_on_skewed_ids(spark):
    df = spark.range(20_000).select(F.floor(F.exp(F.col("id") / 1000)).cast("long").alias("id"))
    bounds = equi_depth_bounds(df, "id", 8)
    found = sizes(df, split_predicates("id", bounds))
    assert len(found) == 8 and max(found) <= 1.2 * 20_000 / 8
    wide = df.agg(F.max("id")).first()[0] // 8
    assert max(sizes(df, split_predicates("id", [wide * k for k in range(1, 8)]))) > 5 * max(found)


def test_every_row_is_met_once(spark):
    df = spark.createDataFrame([(i,) for i in (None, None, -5, -5, 0, 3, 3, 3, 3, 9, 2**62)], "id long")
    for parts in (1, 2, 5, 40):
        assert sum(sizes(df, split_predicates("id", equi_depth_bounds(df, "id", parts)))) == 11
    later = df.union(spark.createDataFrame([(-(2**62),), (2**63 - 1,)], "id long"))
    assert sum(sizes(later, split_predicates("id", equi_depth_bounds(df, "id", 5)))) == 13


def test_one_id_null_ids_and_no_rows(spark):
    same = spark.range(9).select(F.lit(4).alias("id"))
    assert equi_depth_bounds(same, "id", 3) == [] and split_predicates("id", []) == ["1 = 1"]
    for df in (same.limit(0), same.select(F.lit(None).cast("long").alias("id"))):
        assert equi_depth_bounds(df, "id", 3) == []
    with pytest.raises(ValueError):
        equi_depth_bounds(same, "id", 0)
