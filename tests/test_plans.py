"""Physical plans: native expressions, pushed filters, no cross joins, one move per key."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lanemart.plans.mart import build_mart, placement_reasons, run_mart, wide_spine
from lanemart.queries import QUERIES
from lanemart.queries.helpers import Frames
from lanemart.sinks.lake import Cuts
from lanemart.sources.bounds import not_deleted, recent, since_id
from lanemart.sources.readers import literal_dim
from lanemart.standin import PARAMS

BAD = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas", "FlatMapGroups")
LIGHT = [n for n in QUERIES if n not in ("sink_roundtrip", "replace_since", "mart", "mart_job", "recent_partitions")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LIGHT)
def test_no_python_and_no_cross_join(spark, root, name):
    text = plan(entry.queries()[name](spark, root))
    assert not [b for b in BAD if b in text]


def test_big_sides_are_not_broadcast_by_hint(spark, root):
    """With size-based broadcasting off, only the literal zones are still broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        src = Frames(spark, root)
        text = plan(build_mart(src, PARAMS))
        assert text.count("BroadcastHashJoin") == 1
        assert not [b for b in BAD if b in text]
        # The wide spine does not move before the cut.
        assert "Exchange" not in plan(wide_spine({"demands": spark.createDataFrame([], src["demands"].schema)}, PARAMS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_cuts_save_shuffles(spark, root, tmp_path):
    """Of the mart's joins by demand, those between cuts need no exchange; the rows are those without a layout."""
    moves, kept = {}, {}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for key in (None, "demand_id"):
            with Cuts(spark, str(tmp_path), key=key) as cut:
                mart = build_mart(Frames(spark, root), PARAMS, cut, measure=True)
                moves[key] = plan(mart).count("Exchange hashpartitioning(demand_id")
                kept[key] = sorted(mart.select(F.xxhash64(*[F.col(c).cast("string") for c in mart.columns])).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert moves["demand_id"] <= moves[None] - 6
    assert kept["demand_id"] == kept[None]


def test_a_run_plans_few_parts_at_a_time(spark, root, tmp_path):
    """The last join of a run reads cuts: what makes the parts was planned and run in queries of a few parts each."""
    with Cuts(spark, str(tmp_path), key="demand_id") as cut:
        text = plan(build_mart(Frames(spark, root), PARAMS, cut, measure=True))
    assert text.count("Exchange") <= 30 and text.count("Aggregate") <= 2, (text.count("Exchange"), text.count("Aggregate"))


def test_wide_rows_are_not_generated_into_one_method(spark, root, tmp_path):
    """The JVM's compiler takes hundreds of megabytes outside the heap for one method of a wide chain of joins."""
    before, plans = spark.conf.get("spark.sql.codegen.maxFields"), []
    frames = Frames(spark, root)
    dates = frames["demands"].select(F.col("id").alias("demand_id"), F.col("created").alias("demand_date"))

    def write(mart, start):
        out = mart.limit(3)
        out.collect()
        plans.append(out._jdf.queryExecution().executedPlan().toString())

    run_mart(frames, dates, PARAMS, write, str(tmp_path))
    final = plans[0].split("+- == Initial Plan ==")[0]
    assert not re.search(r"\*\(\d+\) (Project|SortMergeJoin|BroadcastHashJoin).*demand_id", final)
    assert spark.conf.get("spark.sql.codegen.maxFields") == before


def test_literal_rows_need_no_python_workers(spark, root):
    bands = Frames(spark, root)["vehicle_bands"]
    zones = literal_dim(spark, {"SOUTH": ["A", "B"]}, "zone", "region")
    assert "ExistingRDD" not in plan(bands) + plan(zones)
    assert bands.count() == 216 and zones.count() == 2


def test_reasons_read_only_what_they_ask_for(spark, root, tmp_path):
    """The spine and the places are computed once, no text of a consignment moves, supply is not made distinct twice."""
    src = Frames(spark, root)
    cut = placement_reasons(src, PARAMS, Cuts(spark, str(tmp_path)))
    text = plan(cut)
    assert "o_totalprice" not in text and "expense_data" not in text and not re.search(r"__m#", text)
    assert sorted(map(str, cut.collect())) == sorted(map(str, placement_reasons(src, PARAMS).collect()))


def test_margin_moves_only_costs_and_forfeits(spark, root):
    """No trip ends, no details of a consignment but its costs, and only forfeited tokens, in one aggregate."""
    text = plan(entry.queries()["margin"](spark, root))
    assert "TRIP_END" not in text and "trip_end_time" not in text and "SUCCESS)" not in text
    assert "consignment_date" not in text and "placed" not in text


def test_partition_and_data_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "parts")
    df = spark.range(40).select(
        F.col("id"), F.lit("false").alias("deleted"), (2018 + F.col("id") % 4).cast("int").alias("dpyear"),
        (F.col("id") % 2 + 6).cast("int").alias("dpmonth"), F.lit(10).alias("dpday"),
    )
    df.write.partitionBy("dpyear", "dpmonth", "dpday").parquet(path)
    read = since_id(not_deleted(recent(spark.read.parquet(path), dt.date(2020, 7, 10))), "id", 5).select("id")
    text = plan(read)
    assert re.search(r"PartitionFilters: \[\(+dpyear#\d+ > 2020", text)
    assert "ReadSchema: struct<id:bigint,deleted:string>" in text
    assert "EqualTo(deleted,false)" in text and "GreaterThanOrEqual(id,5)" in text
    years = {r[0] % 4 + 2018 for r in read.collect()}
    assert years == {2021}


@pytest.mark.parametrize(("name", "inputs"), [("lane_match_count", 2), ("asof_before", 2), ("fulfilled_rank", None)])
def test_folds_read_their_inputs_once(spark, root, name, inputs):
    """In the plan that ran, every input of a fold is scanned once: the second use of the exchange is reused."""
    df = QUERIES[name](spark, root)
    df.collect()
    text = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in text
    if inputs:
        assert text.count("FileScan parquet") == inputs


def test_recent_prunes_partitions(spark, root):
    assert re.search(r"PartitionFilters: \[isnotnull\(dpyear#\d+\), \(dpyear#\d+ >= 1998\)", plan(QUERIES["recent_partitions"](spark, root)))


def test_latest_consignment_takes_one_shuffle(spark, root):
    text = plan(entry.queries()["latest_with_count"](spark, root))
    assert text.count("Exchange hashpartitioning") == 1
