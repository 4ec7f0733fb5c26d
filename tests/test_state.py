"""Saved states, bitmaps and published targets."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from lanemart.operators import aggregates as A
from lanemart.operators import bitmaps as B
from lanemart.plans import history as H
from lanemart.plans.consigners import fulfilled_rank
from lanemart.sinks import publish as P
from lanemart.standin import PARAMS


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def demands(spark):
    rnd = random.Random(4)
    start = dt.datetime(2024, 1, 1)
    data = []
    for i in range(900):
        key = "hot" if rnd.random() < 0.34 else rnd.choice([None, *"abcdefgh"])
        data.append((i, key, start + dt.timedelta(hours=rnd.randrange(5000)), rnd.choice(["FULFILLED", "PENDING"]), rnd.choice(["false", "false", "true"])))
    return spark.createDataFrame(data, "id long, consigner_user_code string, created timestamp_ntz, status string, deleted string").cache()


LATE = {
    "none": "id > 700",
    "some": "id > 700 or id in (3, 77, 400)",
    "of a null consigner": "id > 700 or (consigner_user_code is null and id % 3 = 0)",
    "only late": "id = 650",
    "all": "true",
    "nothing": "false",
}


@pytest.mark.parametrize("new", LATE.values(), ids=LATE.keys())
def test_state_and_ranks_equal_the_full_computation(demands, new):
    fresh, old = demands.filter(new), demands.filter(f"not ({new})")
    watermark = 700 if "700" in new else old.agg(F.max("id")).first()[0] or -1
    state, ranks = H.advance(H.state_of(old, PARAMS), fresh, demands, watermark, PARAMS)
    assert rows(state) == rows(H.state_of(demands, PARAMS))
    assert rows(H.replace_ranks(fulfilled_rank(old, PARAMS), ranks)) == rows(fulfilled_rank(demands, PARAMS))


def test_only_consigners_with_late_rows_are_done_again(demands):
    late = {r[0] for r in H.late_keys(demands.filter("id > 700 or id = 3"), 700).collect()}
    assert late <= {r[0] for r in demands.filter("id = 3").select(H.KEY).collect()}
    changed = H.advance(H.state_of(demands.filter("id <= 700"), PARAMS), demands.filter("id > 700"), demands, 700, PARAMS)[1]
    assert changed.agg(F.min("demand_id")).first()[0] > 700


# bitmaps


@pytest.fixture(scope="module")
def sent(spark):
    rnd = random.Random(2)
    data = [(rnd.choice("abc"), rnd.randrange(4), rnd.choice([None, 0, 5, 32_767, 32_768, 70_000, rnd.randrange(100_000)]), rnd.random() < 0.3) for _ in range(3000)]
    return spark.createDataFrame(data + [("d", 1, None, True), ("e", 1, 7, False)], "k string, day int, u long, hit boolean").cache()


def test_merged_bitmaps_equal_the_direct_count(sent):
    daily = B.member_bitmaps(sent, ["k", "day"], "u", F.col("hit"))
    again = daily.union(daily.filter("day = 2"))  # a day that was sent twice counts once
    got = B.bitmap_share(B.merge_bitmaps(again, ["k"]), ["k"], "p")
    want = A.distinct_pct(sent, "k", "u", F.col("hit"), "p").filter("p is not null")
    assert [(k, round(p, 9)) for k, p in rows(got)] == [(k, round(p, 9)) for k, p in rows(want)]
    by_day = B.bitmap_share(daily, ["k", "day"], "p")
    assert by_day.filter("k = 'e'").first()["p"] == 0 and by_day.filter("k = 'd'").count() == 0
    assert B.merge_bitmaps(B.member_bitmaps(sent.limit(0), ["k"], "u", F.col("hit")), ["k"]).count() == 0


def test_bitmaps_expand_no_rows(spark, root):
    for name in ("delivered_bitmaps", "distinct_users"):
        text = queries()[name](spark, root)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in text and "Python" not in text


# publishing


def published(spark, path, df):
    return rows(P.read_published(spark, path, df.schema))


@pytest.fixture
def target(spark, tmp_path):
    path = str(tmp_path / "target")
    df = spark.range(100).select("id", F.lit("old").alias("v"))
    P.replace_since_published(spark, path, df, "id", 0, width=10)
    return path, df


def test_replace_since_is_one_commit_and_repeatable(spark, target, tmp_path):
    path, df = target
    newer = spark.range(20, 48).select("id", F.lit("new").alias("v")).filter("id % 2 = 1")
    want = sorted([(i, "old") for i in range(25)] + [(i, "new") for i in range(25, 48) if i % 2], key=repr)
    for _ in range(2):
        figures = P.replace_since_published(spark, path, newer, "id", 25, width=10)
        assert figures["rows"] == 12 and published(spark, path, df) == want
    # Ranges before the watermark's are named again, not written again.
    assert P._newest(spark, path)[1]["1"] == P._read_pointer(spark, path, 1)["1"]
    assert P.clean(spark, path, keep=1) == 1 and published(spark, path, df) == want
    assert P.clean(spark, path, keep=1) == 0
    P.replace_since_published(spark, path, newer.limit(0), "id", 0, width=10)
    assert published(spark, path, df) == []


@pytest.mark.parametrize(
    ("bad", "gates", "says"),
    [
        ("select * from range(30)", P.Gates(least_rows=31), "30 rows"),
        ("select * from range(30) union all select null", P.Gates(), "1 null keys"),
        ("select * from range(30) union all select 4 union all select 4", P.Gates(repeated_keys=1), "2 repeated keys"),
        ("select * from range(30)", P.Gates(unmatched={"v": 0.2}), "v is null in 10 rows of 30"),
    ],
)
def test_a_gate_stops_the_run_with_its_figures(spark, target, tmp_path, bad, gates, says):
    path, df = target
    batch = spark.sql(bad).withColumn("v", F.when(F.coalesce(F.col("id"), F.lit(1)) % 3 != 0, "new"))
    jobs = len(list((tmp_path / "target" / "data").iterdir()))
    with pytest.raises(P.GateError, match=says) as stopped:
        P.replace_since_published(spark, path, batch, "id", 0, gates, width=10)
    assert stopped.value.figures["rows"] == batch.count()
    assert published(spark, path, df) == rows(df)
    assert len(list((tmp_path / "target" / "data").iterdir())) == jobs  # what was staged is gone


def test_rows_without_a_key_are_kept_where_allowed(spark, target):
    path, df = target
    batch = spark.sql("select * from range(95, 97) union all select null").withColumn("v", F.lit("new"))
    P.replace_since_published(spark, path, batch, "id", 95, P.Gates(null_keys=1), width=10)
    assert (None, "new") in published(spark, path, df) and len(published(spark, path, df)) == 98
    P.replace_since_published(spark, path, batch.dropna(), "id", 95, width=10)
    assert (None, "new") in published(spark, path, df)


def test_a_failure_between_the_steps_leaves_the_old_rows(spark, target, monkeypatch):
    path, df = target
    batch = spark.range(40, 60).select("id", F.lit("new").alias("v"))

    def fails(*_):
        raise OSError("lost the driver's connection")

    monkeypatch.setattr(P, "_commit", fails)
    with pytest.raises(OSError):
        P.replace_since_published(spark, path, batch, "id", 40, width=10)
    assert published(spark, path, df) == rows(df)
    monkeypatch.undo()
    P.replace_since_published(spark, path, batch, "id", 40, width=10)
    assert len(published(spark, path, df)) == 60


def test_a_second_writer_does_not_replace_the_first(spark, target):
    path, df = target
    number, named = P._newest(spark, path)
    with pytest.raises(RuntimeError, match="another run"):
        P._commit(spark, path, number, {})
    assert P._newest(spark, path) == (number, named) and published(spark, path, df) == rows(df)
