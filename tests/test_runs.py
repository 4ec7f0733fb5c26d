"""What a run costs: batches computed once, cuts read in order, parts packed, memory given back, cuts made two at a time."""

from __future__ import annotations

import threading

from pyspark.sql import functions as F

from lanemart.plans.mart import cut_each, packed, unpacked
from lanemart.session import give_back
from lanemart.sinks.lake import Cuts, write_parquet
from lanemart.sinks.replace import replace_since_files, write_bucketed_by_id


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_replace_since_computes_its_batch_once(spark, tmp_path):
    path, seen = str(tmp_path / "target"), spark.sparkContext.accumulator(0)
    write_bucketed_by_id(spark.range(60).select("id", F.lit("old").alias("v")), path, "id", width=10)

    def new(_):
        seen.add(1)
        return "new"

    batch = spark.range(25, 45).withColumn("v", F.udf(new, "string").asNondeterministic()("id"))
    replace_since_files(spark, path, batch, "id", 25, width=10)
    assert seen.value == 20
    rows = sorted((r.id, r.v) for r in spark.read.schema("id long, v string").parquet(path).collect())
    assert rows == [(i, "old" if i < 25 else "new") for i in range(45)]
    assert not (tmp_path / "target" / "id_bucket=5").exists()


def test_cuts_are_read_in_their_order(spark, tmp_path):
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before, old = spark.conf.get(name), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with Cuts(spark, str(tmp_path), key="k", buckets=3) as cut:
            one, other = (cut(spark.range(50).select((F.col("id") * n % 50).alias("k"), F.col("id").alias(f"v{n}"))) for n in (3, 7))
            joined = one.join(other, "k", "left")
            text = plan(joined)
            assert "SortMergeJoin" in text and "Sort [" not in text and "Exchange" not in text
            assert sorted((r.v3 * 3 % 50, r.v7 * 7 % 50) for r in joined.collect()) == [(k, k) for k in range(50)]
            write_parquet(joined, str(tmp_path / "out"), rebalance=False)
        assert 1 <= len(list((tmp_path / "out").glob("*.parquet"))) <= 3 and spark.read.parquet(str(tmp_path / "out")).count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert spark.conf.get(name) == before


def test_parts_travel_packed(spark):
    part = spark.createDataFrame([(1, "A", None, 5), (3, None, 2.0, 6)], "demand_id long, origin string, tonnage double, unused int")
    pack = packed(part, "__pack_0")
    assert pack.columns == ["demand_id", "__pack_0"]
    out = unpacked(spark.range(1, 4).toDF("demand_id").join(pack, "demand_id", "left"))
    assert sorted(map(tuple, out.collect())) == [(1, "A", None), (2, None, None), (3, None, 2.0)]


def test_two_frames_are_cut_at_a_time(spark, tmp_path):
    both, made = threading.Barrier(2, timeout=60), []
    with Cuts(spark, str(tmp_path), key="id") as cuts:

        def cut(df):
            both.wait()
            made.append(threading.get_ident())
            return cuts(df)

        frames = cut_each(cut, [spark.range(n).select("id", F.lit(n).alias("n")) for n in (1, 2, 3, 4)])
        assert [f.count() for f in frames] == [1, 2, 3, 4] and [f.first().n for f in frames] == [1, 2, 3, 4]
        assert len(set(cuts.tables)) == 4
    assert len(set(made)) == 2


def test_memory_is_given_back(spark):
    give_back(spark)
    assert spark.range(3).count() == 3
