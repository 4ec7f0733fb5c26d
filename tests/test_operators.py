"""Operators on small frames, and their scalable forms against the plain ones."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lanemart.operators import aggregates as A
from lanemart.operators import arrays, joins, scan, sets, windows


def day(n: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows of which a third belong to one key, with many equal times."""
    rnd = random.Random(7)
    data = []
    for i in range(5000):
        key = "hot" if rnd.random() < 0.34 else rnd.choice([*"abcdefgh", None])
        data.append((i, key, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(4000) * 7), rnd.choice("PQR"), rnd.random() < 0.3))
    return spark.createDataFrame(data, "id long, k string, t timestamp_ntz, v string, event boolean").cache()


@pytest.mark.parametrize("bucket", [60, 86_400, 10**9])
def test_asof_equals_join_form(skewed, bucket):
    probes, events = skewed.filter(~F.col("event")), skewed.filter("event")
    got = scan.asof_before(probes, events, "k", "t", "t", "v", "then", ["id"], default="none", bucket_seconds=bucket)
    e = events.select("k", F.col("t").alias("et"), F.col("v").alias("ev"))
    newest = Window.partitionBy("id").orderBy(F.col("et").desc(), F.col("ev").desc())
    plain = (
        probes.join(e, on="k").filter(F.col("et") < F.col("t")).withColumn("rn", F.row_number().over(newest)).filter("rn = 1").select("id", "ev")
    )
    want = probes.filter("k is not null").join(plain, on="id", how="left").select("id", F.coalesce("ev", F.lit("none")))
    assert rows(got, "id") == rows(want, "id")


def test_asof_edges(spark):
    probes = spark.createDataFrame([(1, "a", day(5)), (2, "a", day(1)), (3, "b", day(5)), (4, "a", None), (5, None, day(5))], "id long, k string, t timestamp_ntz")
    events = spark.createDataFrame([("a", day(1), "x"), ("a", day(5), "same time"), ("a", day(3), "m"), ("a", day(3), "n"), (None, day(0), "z")], "k string, t timestamp_ntz, v string")
    got = scan.asof_before(probes, events, "k", "t", "t", "v", "then", ["id"], default="none")
    assert rows(got, "id") == [(1, "n"), (2, "none"), (3, "none")]


@pytest.mark.parametrize("bucket", [86_400, 10**9])
def test_asof_keeps_null_values_of_the_newest_event(spark, bucket):
    probes = spark.createDataFrame([(1, "a", day(9)), (2, "a", day(3)), (3, "b", day(9))], "id long, k string, t timestamp_ntz")
    events = spark.createDataFrame([("a", day(1), "RESTRICTED"), ("a", day(5), None)], "k string, t timestamp_ntz, v string")
    got = scan.asof_before(probes, events, "k", "t", "t", "v", "then", ["id"], default="none", bucket_seconds=bucket)
    assert rows(got, "id") == [(1, None), (2, "RESTRICTED"), (3, "none")]


@pytest.mark.parametrize("bucket", [600, 86_400, 10**9])
def test_lane_match_equals_join_form(skewed, bucket):
    demands = skewed.select("id", "k", "v", "t")
    supply = skewed.filter("event").select("k", "v", (F.col("id") % 40).alias("op"), F.col("t").alias("start"))
    got = scan.lane_match_count(demands, supply, ["k", "v"], "op", "start", "id", "t", "n", bucket_seconds=bucket)
    want = demands.join(supply, on=["k", "v"]).filter(F.col("t") >= F.col("start")).groupBy("id").agg(F.count_distinct("op").alias("n"))
    assert rows(got, "id") == rows(want, "id")


def test_lane_match_edges(spark):
    demands = spark.createDataFrame([(1, "L", day(2)), (2, "L", day(1)), (3, None, day(9)), (4, "M", day(9))], "id long, lane string, t timestamp_ntz")
    supply = spark.createDataFrame([("L", "o1", day(2)), ("L", "o1", day(3)), ("L", "o2", day(3)), (None, "o3", day(0))], "lane string, op string, s timestamp_ntz")
    got = scan.lane_match_count(demands, supply, ["lane"], "op", "s", "id", "t", "n")
    assert rows(got, "id") == [(1, 1)]


@pytest.mark.parametrize("width", [7, 1000, 1 << 20])
def test_running_sum_equals_window(skewed, width):
    amount = F.when(F.col("v") == "P", 1).otherwise(0)
    got = windows.prior_running_sum(skewed, "k", "id", amount, "id", "n", bucket_width=width)
    over = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    want = skewed.select("id", F.coalesce(F.sum(amount).over(over), F.lit(0)).alias("n"))
    assert rows(got, "id") == rows(want, "id")  # null keys are one group, as in the plain window


def test_salted_lookup_equals_join(skewed):
    dim = skewed.filter("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    got = joins.lookup_salted(skewed, dim, "k", "id", salts=5).select("id", "n")
    assert rows(got, "id") == rows(skewed.join(dim, on="k", how="left").select("id", "n"), "id")


def test_latest_and_first(spark):
    df = spark.createDataFrame([("a", 1, day(1), "x"), ("a", 2, day(1), None), ("b", 3, None, "y"), ("b", 4, day(0), "z")], "k string, id int, t timestamp_ntz, v string")
    got = windows.latest_per_key(df, "k", ["t", "id"], ["id", "v"], [F.count("v").alias("n")])
    assert rows(got, "k") == [("a", 2, None, 1), ("b", 4, "z", 2)]
    assert rows(windows.first_per_key(df, "k", ["id"], ["v"]), "k") == [("a", "x"), ("b", "y")]


def test_first_latest_value(spark):
    data = [("a", "s1", day(1)), ("a", "s2", day(2)), ("a", "s1", day(9)), ("b", "only", day(1)), ("c", "p", day(1)), ("c", "q", day(1))]
    got = windows.first_latest(spark.createDataFrame(data, "k string, v string, t timestamp_ntz"), "k", "v", "t", "f", "l")
    assert rows(got, "k") == [("a", "s1", "s2"), ("b", "only", "only"), ("c", "p", "q")]


def test_range_lookup_bounds_and_overlap(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, "x", 5.0), (3, "x", 7.0), (4, "x", None), (5, "y", 1.0), (6, "x", 4.0)], "id int, b string, s double")
    bands = spark.createDataFrame([(20, "x", 1.0, 5.0), (10, "x", 4.0, 5.0)], "band int, body string, lo double, hi double")
    args = ({"b": "body"}, {"s": ("lo", "hi")}, ["band"])
    assert rows(joins.range_lookup(df, bands, *args).select("id", "band"), "id", "band") == [(1, 20), (2, 10), (2, 20), (3, None), (4, None), (5, None), (6, 10), (6, 20)]
    assert rows(joins.range_lookup_first(df, bands, "id", *args, order=["band"]), "id") == [(1, 20), (2, 10), (6, 10)]
    assert rows(joins.range_lookup_first(df, bands, "id", *args, order=["band"], latest=True), "id") == [(1, 20), (2, 20), (6, 20)]


def test_newest_bands_keeps_one_row_per_band(spark):
    bands = spark.createDataFrame([("l", 1, day(1), "old"), ("l", 1, day(2), "new"), ("l", 2, day(0), "other")], "lane string, lo int, at timestamp_ntz, v string")
    assert rows(joins.newest_bands(bands, ["lane", "lo"], ["at"]).select("lo", "v"), "lo") == [(1, "new"), (2, "other")]


def test_backfill(spark):
    df = spark.createDataFrame([(1, None, "keep"), (2, None, "NA"), (3, "K", "have")], "id int, key string, place string")
    sheet = spark.createDataFrame([(1, "S", "filled"), (3, "S", "no"), (4, "S", "no")], "id int, sk string, sp string")
    got = joins.keyed_backfill(df, sheet, "id", "key", {"key": "sk", "place": "sp"})
    assert rows(got, "id") == [(1, "S", "filled"), (2, None, "NA"), (3, "K", "have")]


def test_code_joins_do_not_multiply(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 20.0)], "n long, amount double")
    coded = spark.createDataFrame([("X-1", "p"), ("X-1", "q"), ("X", "r"), ("X-a", "s")], "code string, v string")
    assert rows(joins.join_on_code_part(left, "n", coded, "code", ["v"]), "v") == [(1, 10.0, "p"), (1, 10.0, "q")]


def test_ledger_sums(spark):
    data = [("a", "T", "CREDIT", 5.0), ("a", "other", "CREDIT", 9.0), ("b", "T", "DEBIT", 3.0), ("c", "other", "DEBIT", 1.0)]
    got = A.credit_debit(spark.createDataFrame(data, "k string, type string, category string, amount double"), "k", ["T"], "cr", "db")
    assert rows(got, "k") == [("a", 5.0, 0.0), ("b", 0.0, 3.0), ("c", 0.0, 0.0)]


def test_distinct_pct(spark):
    data = [("a", "u", "S"), ("a", "u", "D"), ("a", "v", "S"), ("b", "u", "S"), ("c", "u", "D"), ("c", "u", "D"), ("d", None, "D")]
    got = A.distinct_pct(spark.createDataFrame(data, "k string, u string, s string"), "k", "u", F.col("s") == "D", "p")
    assert rows(got, "k") == [("a", 50.0), ("b", 0.0), ("c", 100.0), ("d", None)]


def test_pivot_and_having(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 3.0), ("a", "z", 9.0), ("b", "y", 2.0)], "k string, c string, v double")
    assert rows(A.pivot_max(df, "k", "c", "v", {"x": "px", "y": "py"}, "flag"), "k") == [("a", 1, 3.0, None), ("b", 1, None, 2.0)]
    assert rows(A.having_count(df, "k", 2), "k") == [("a",)]


def test_experiment_lists(spark):
    names = spark.createDataFrame([(1, "B"), (2, "A")], "id long, name string")
    texts = spark.createDataFrame([("{1}",), ("{1, 2}",), ("{7}",), ("{1,1}",), (None,), ("{1}",)], "ids string")
    got = arrays.list_names(texts, "ids", names, "id", "name", "joined")
    assert dict(rows(got, "ids")) == {"{1}": "B", "{1, 2}": "A, B", "{7}": "NA", "{1,1}": "B, B"}


def test_hot_cold_split(spark):
    both = spark.createDataFrame([(n, day(n)) for n in range(6)], "n int, t timestamp_ntz")
    got = sets.hot_cold_union(both, both, "t", cutoff=day(4).date(), since=day(1).date())
    assert [r[0] for r in rows(got, "n")] == [1, 2, 3, 4, 5]


def test_exists_semi_and_grain(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    other = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    assert rows(joins.exists_flag(df, other, "k", "f"), "k") == [(1, 0), (2, 1), (2, 1)]
    assert rows(joins.semi_filter(df, other, "k"), "k") == [(2,), (2,)]
    assert rows(joins.duplicate_keys(df, "k"), "k") == [(2, 2)]
