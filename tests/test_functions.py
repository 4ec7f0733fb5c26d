from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lanemart.fixed import REMARK_PATTERNS, RegionSets
from lanemart.functions import json as JS
from lanemart.functions import numbers as N
from lanemart.functions import rules as R
from lanemart.functions import text as T
from lanemart.functions import time as TM


def test_json_double_tolerates_bad_text(values):
    docs = ['{"v": ""}', "{}", '{"v": null}', '{"v": "5.5"}', '{"v": "0.5"}', '{"v": "abc"}', "not json", None, '{"v": 7}']
    assert values("string", docs, lambda x: JS.json_double(x, "v")) == [None, None, None, 5.5, 0.5, None, None, None, 7.0]
    assert values("string", docs, lambda x: JS.json_double(x, "v", 0)) == [0, 0, 0, 5.5, 0.5, 0, 0, 0, 7.0]


def test_nested_json_reads_objects_and_text(values, spark):
    docs = ['{"b": {"k": true, "n": 1.50}}', '{"b": "{\\"k\\": true, \\"n\\": 1.50}"}', '{"b": {}}', "{}"]
    assert values("string", docs, lambda x: JS.json_text(JS.json_text(x, "b"), "k")) == ["true", "true", None, None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string")
    once = JS.with_json_fields(df, F.col("d"), {"b": "body"})
    twice = JS.with_json_fields(once, F.col("body"), {"k": "k", "n": "n"}).orderBy("i")
    struct = df.select("i", JS.json_struct(JS.json_struct(F.col("d"), ["b"])["b"], ["k", "n"]).alias("s")).orderBy("i")
    got = [(r.k, float(r.n) if r.n else None) for r in twice.collect()]
    assert got == [("true", 1.5), ("true", 1.5), (None, None), (None, None)]
    assert [r.s.k if r.s else None for r in struct.collect()] == ["true", "true", None, None]


def test_json_fallback(values):
    docs = ['{"c": "a"}', '{"c": ""}', "{}", None]
    assert values("string", docs, lambda x: JS.json_or(x, "c", F.lit("z"))) == ["a", "z", "z", "z"]


def test_step_round_is_not_a_ceiling(values):
    assert values("double", [100.0, 100.5, 101.0, 0.0, None], N.step_round) == [100.0, 100.0, 200.0, 0.0, None]


def test_fares(spark):
    rows = [(1000.0, None, 0.0), (1050.0, 1100.0, 0.05), (1000.0, 900.0, 0.1), (1000.0, 1000.0, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, fare double, actual double, sc double").orderBy("i")
    fare, actual, sc = F.col("fare"), F.col("actual"), F.col("sc")
    got = df.select(N.base_price(fare, sc), N.extra_discount(actual, fare), N.updated_fare(actual, fare)).collect()
    assert [tuple(r) for r in got] == [(1000.0, 0.0, 1000.0), (1000.0, 50.0, 1100.0), (1000.0, 0.0, 900.0), (1000.0, 0.0, 1000.0)]


def test_digits_guard_and_version(values):
    assert values("string", ["123", "12a", "", "99999999999", "9" * 30, None], N.int_or_null) == [123, None, None, 99999999999, None, None]
    assert values("string", ["v3.10.2", "", None, "beta"], N.version_number) == [3102, -1, -1, -1]


def test_codes_and_keys(values):
    assert values("string", ["XX-12", "XX", "XX-1a", None, "A-B-3"], T.code_number) == [12, None, None, None, None]
    assert values("string", ["A-1", "A–1", "A", "A–1-2", None], T.norm_key) == ["A", "A", "A", "A", None]
    assert values("string", ["x", None], lambda x: T.label(x, F.lit("y"))) == ["x_y", None]
    assert values("string", ["{1}", "{1, 2}", "{a}", "", None], T.id_list) == [[1], [1, 2], [None], [None], None]


def test_remark_patterns(values):
    texts = ["rfq", "RFQ", "rfq ", "rfqs", "Via-Point not added", "change_in_truck_type/weight", None]
    flag = lambda x: T.matches_any([x], list(REMARK_PATTERNS))
    assert values("string", texts, flag) == [True, True, True, False, True, True, False]


def test_membership_and_contains(values):
    assert values("string", ["a", "b", None], lambda x: T.member_flag(x, ["a"], "in", "out")) == ["in", "out", "out"]
    assert values("string", ["Some TESTING co", "x", None], lambda x: T.contains_ci(x, ["alternate", "testing"])) == [True, False, False]


def test_times(spark, values):
    at = [dt.datetime(2024, 1, 1, 23, 59, 59, 900_000), None]
    assert values("timestamp_ntz", at, TM.to_local)[0] == dt.datetime(2024, 1, 2, 5, 29, 59, 900_000)
    assert values("timestamp_ntz", [dt.datetime(1970, 1, 2, 0, 0, 1)], TM.epoch_seconds) == [86_401]
    assert values("string", ["0", "86400", "x", "-1", None], TM.epoch_to_local) == [
        dt.datetime(1970, 1, 1, 5, 30), dt.datetime(1970, 1, 2, 5, 30), None, dt.datetime(1970, 1, 1, 5, 29, 59), None,
    ]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert values("timestamp_ntz", [dt.datetime(2024, 3, 10, 2, 30)], TM.epoch_seconds) == [1_710_037_800]
        assert values("string", ["1710037800"], TM.epoch_to_local) == [dt.datetime(2024, 3, 10, 8, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    end = F.lit(dt.datetime(2024, 1, 1, 10, 30)).cast("timestamp_ntz")
    starts = [dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 9, 59, 59), None]
    assert values("timestamp_ntz", starts, lambda x: TM.minutes_between(x, end)) == [30.0, 1801 / 60, None]


def test_label_array(spark):
    df = spark.createDataFrame([(0.5, "true"), (None, None), (0.0, "false")], "h double, w string").coalesce(1)
    got = [r[0] for r in df.select(R.special_labels([F.col("h") > 0, F.col("w") == "true", *[F.lit(True)] * 5])).collect()]
    rest = list(R.SPECIAL_REQUEST_LABELS[2:])
    assert got == [["OVER_HEIGHT", "OVER_WEIGHT", *rest], rest, rest]
    none = df.select(R.special_labels([F.lit(None).cast("boolean")] * 7)).first()[0]
    assert none == []


def test_vehicle_categories(spark):
    rows = [
        ("container", 4, 1, 7, 1.5, "LCV"), ("container", 4, 8, 9, 2.0, "LCV"), ("open", 4, 12, 13, 2.0, "LCV"),
        ("container", 4, 12, 13, 2.0, "4_6"), ("container", 6, 27, 50, 9.0, "SXL"), ("container", 10, 16, 50, 18.0, "MXL"),
        ("container", 10, 16, 50, 9.0, "10_12_14"), ("trailer", 18, 1, 2, 0.0, "TRAILER"), ("open", 18, 1, 2, 0.0, "Other"),
    ]
    df = spark.createDataFrame(rows, "b string, t int, lo int, hi int, w double, want string")
    got = df.select(R.vehicle_tyre_type(*[F.col(c) for c in ("b", "t", "lo", "hi", "w")]).alias("g"), "want").collect()
    assert all(r.g == r.want for r in got)


def test_region_ladder(spark):
    sets = RegionSets()
    d9, d8, d18, d17 = [dt.datetime(2025, 12, d) for d in (9, 8, 18, 17)]
    rows = [
        ("NUH_HARYANA", None, None, "NCR"), ("PUNE_MAHARASHTRA", None, None, "ROI"), ("X_Y", "PUNE_MAHARASHTRA", d9, "ROI:2"),
        ("X_Y", "PUNE_MAHARASHTRA", d8, "OTHERS"), (None, "PUNE_MAHARASHTRA", d9, "ROI:2"), ("X_Y", None, d18, "OTHERS"),
        ("JAIPUR_RAJASTHAN", "PUNE_MAHARASHTRA", d18, "ROI:3"), ("JAIPUR_RAJASTHAN", "PUNE_MAHARASHTRA", d17, "OTHERS"),
        ("X_Y", "JAIPUR_RAJASTHAN", d9, "ROI:2"), ("X_Y", "PUNE_MAHARASHTRA", None, "OTHERS"), (None, None, None, "OTHERS"),
    ]
    df = spark.createDataFrame(rows, "o string, d string, at timestamp_ntz, want string")
    got = df.select(R.demand_region(F.col("o"), F.col("d"), F.col("at"), sets).alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]
    assert len(set(sets.ncr)) == len(sets.ncr) == 24 and len(set(sets.base)) == len(sets.base)


def test_demand_type_ladder(spark):
    rows = [
        (7, None, None, None, "NIGHT_DEMAND"), (21, 1, None, None, "NIGHT_DEMAND"), (21, None, None, None, "NORMAL_DEMAND"),
        (12, 2, "Operator", None, "FO_BACKOUT_DEMAND"), (12, 2, None, "retry", "MULTIPLE_CONSIGNMENTS"), (12, 1, "Operator", "retry", "NORMAL_DEMAND"),
    ]
    df = spark.createDataFrame(rows, "h int, n int, c string, b string, want string")
    got = df.select(R.demand_type(F.col("h"), F.col("n"), F.col("c"), F.col("b"), "retry").alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]


def test_reason_ladder(spark):
    green = dict(n=0, c="Green", q=21, h=12, m=31.0, e=30, d=50.0, s=0)
    cases = [
        (dict(n=1), "Placed"), (dict(c="Red"), "Low Supply"), (dict(q=20), "Low Quality Supply"), (dict(q=None), "Low Quality Supply"),
        (dict(h=7), "Non Working Hours"), (dict(h=21), "Non Working Hours"), (dict(h=8, m=30.0), "Less Time to Place"),
        (dict(h=20, e=24, d=0.59), "Less FO Engagement [Low Del.]"), (dict(e=24, d=0.6), "Less FO Engagement [High Del.]"),
        (dict(e=None, d=None), "Less FO Engagement [Low Del.]"), (dict(e=25, s=1), "Matching/Pricing Issue [SR]"),
        (dict(h=None, m=None), "Matching/Pricing Issue [Non SR]"),
    ]
    rows = [tuple((green | change).values()) + (want,) for change, want in cases]
    df = spark.createDataFrame(rows, "n int, c string, q int, h int, m double, e int, d double, s int, want string")
    got = df.select(R.non_placement_reason(*[F.col(x) for x in "ncqhmeds"]).alias("g"), "want").collect()
    assert [r.g for r in got] == [r.want for r in got]
    unknown = spark.range(1).select(R.supply_confidence(F.lit(None).cast("int"), F.lit(None).cast("int"))).first()[0]
    assert unknown == "Red"
