"""What outlives a run: saved states, daily bitmaps, published targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.operators import bitmaps as B
from lanemart.plans import history as H
from lanemart.plans.consigners import fulfilled_rank
from lanemart.plans.supply import delivered_bitmaps as daily_bitmaps
from lanemart.queries import query
from lanemart.queries.helpers import Frames, rounded, scratch, table
from lanemart.sinks.lake import write_parquet
from lanemart.sinks.publish import Gates, read_published, replace_since_published
from lanemart.standin import PARAMS


def _runs(spark, root) -> tuple[DataFrame, DataFrame, int]:
    """All demands, those of the second run (a tenth of all ids, and a few that come late), and the first run's watermark."""
    demands = Frames(spark, root)["demands"]
    watermark = table(spark, root, "orders", "o_orderkey").agg((F.max("o_orderkey") * 9 / 10).cast("bigint")).first()[0]
    return demands, demands.filter((F.col("id") > watermark) | (F.col("id") % 211 == 5)), watermark


def _saved(spark, df: DataFrame) -> DataFrame:
    path = scratch(spark, "state")
    write_parquet(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _first_run(demands: DataFrame, watermark: int) -> DataFrame:
    return demands.filter((F.col("id") <= watermark) & (F.col("id") % 211 != 5))


@query("""
    select consigner_user_code, consigner_onboarding_date, consigner_fulfilled_demand_date, consigner_fulfilled_demand_id, n as fulfilled
    from history left join (select consigner_user_code as c, count(*) filter (status = 'FULFILLED') as n from demands group by 1) d
      on consigner_user_code is not distinct from c""")
def history_increment(spark, root) -> DataFrame:
    """The state of the first run, saved, and advanced by the second run's rows, late ones included."""
    demands, fresh, watermark = _runs(spark, root)
    state = _saved(spark, H.state_of(_first_run(demands, watermark), PARAMS))
    return H.advance(state, fresh, demands, watermark, PARAMS)[0]


@query("select * from fulfilled")
def rank_increment(spark, root) -> DataFrame:
    """Ranks of the first run, saved, with the second run's put in."""
    demands, fresh, watermark = _runs(spark, root)
    old = _first_run(demands, watermark)
    state = _saved(spark, H.state_of(old, PARAMS))
    ranks = _saved(spark, fulfilled_rank(old, PARAMS))
    return H.replace_ranks(ranks, H.advance(state, fresh, demands, watermark, PARAMS)[1])


@query("select demand_id, round(noitf_delivered_fo, 4) as noitf_delivered_fo from delivered")
def delivered_bitmaps(spark, root) -> DataFrame:
    """The delivered share per demand, from bitmaps that were saved per day."""
    daily = _saved(spark, daily_bitmaps(Frames(spark, root)["notifications"], PARAMS))
    return rounded(B.bitmap_share(B.merge_bitmaps(daily, ["demand_id"]), ["demand_id"], "noitf_delivered_fo"))


@query("""
    select event_type, count(distinct user_id) as users, count(distinct case when day % 2 = 0 then user_id end) as on_even_days
    from (select event_type, user_id, date_diff('day', date '1970-01-01', ts::date) as day from events) group by 1""")
def distinct_users(spark, root) -> DataFrame:
    """Users per kind of event, from one bitmap per day and kind."""
    events = table(spark, root, "events", "event_type", "user_id", "ts").withColumn("day", F.unix_date(F.to_date("ts")))
    daily = B.member_bitmaps(events, ["event_type", "day"], "user_id", F.col("day") % 2 == 0)
    merged = B.merge_bitmaps(daily, ["event_type"])
    counted = [F.sum(F.bitmap_count(c)).alias(n) for c, n in ((B.MEMBERS, "users"), (B.HITS, "on_even_days"))]
    return merged.groupBy("event_type").agg(*counted)


@query("""
    select o_orderkey, o_orderstatus, case when o_orderkey >= (select 2 * max(o_orderkey) // 3 from orders) then o_totalprice * 2 else o_totalprice end as price
    from orders
    where o_orderkey < (select 2 * max(o_orderkey) // 3 from orders) or o_orderkey % 4 <> 1""")
def publish_since(spark, root) -> DataFrame:
    """A target published whole, then twice with the same newer part, each time through its gates."""
    orders = table(spark, root, "orders", "o_orderkey", "o_orderstatus", "o_totalprice").withColumnRenamed("o_totalprice", "price")
    most, rows = orders.agg(F.max("o_orderkey"), F.count(F.lit(1))).first()
    target, start, width = scratch(spark, "published"), 2 * most // 3, max(1, most // 16)
    newer = orders.filter(F.col("o_orderkey") % 4 != 1).withColumn("price", F.col("price") * 2)
    gates = Gates(least_rows=rows, unmatched={"price": 0.0})
    replace_since_published(spark, target, orders, "o_orderkey", 0, gates, width)
    for _ in range(2):
        replace_since_published(spark, target, newer, "o_orderkey", start, Gates(least_rows=1), width)
    return read_published(spark, target, orders.schema)
