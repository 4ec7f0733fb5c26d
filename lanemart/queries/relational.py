"""Scans, filters, joins, aggregates, windows and unions on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart import standin
from lanemart.functions.json import json_text
from lanemart.functions.text import contains_ci, matches_any, member_flag
from lanemart.operators import aggregates as A
from lanemart.operators import grid
from lanemart.operators import hot as H
from lanemart.operators import joins as J
from lanemart.operators import windows as W
from lanemart.operators.scan import asof_before
from lanemart.operators.scan import lane_match_count as count_lane_matches
from lanemart.operators.sets import hot_cold_union as unite
from lanemart.operators.sets import union_distinct
from lanemart.plans import consignments as C
from lanemart.plans import consigners as G
from lanemart.plans import pricing, spine, supply, vehicles
from lanemart.queries import query
from lanemart.queries.ctes import quoted, remark_regex
from lanemart.queries.helpers import Frames, r4, rounded, scratch, table
from lanemart.sinks.lake import write_parquet
from lanemart.sinks.replace import BUCKET, replace_since_files, write_bucketed_by_id
from lanemart.sources import bounds
from lanemart.sources.readers import literal_dim
from lanemart.sources.splits import equi_depth_bounds, split_predicates
from lanemart.sources.zones import since_id_by_zones, write_zones
from lanemart.standin import PARAMS

# --- scans and bounds ----------------------------------------------------------------------------


@query("select o_orderkey as order_id, o_custkey as customer_id, o_totalprice as price, o_orderdate as order_date from orders")
def scan_project(spark, root) -> DataFrame:
    return table(spark, root, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate").withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "price", "o_orderdate": "order_date"}
    )


@query("select min(o_orderkey) as min_o_orderkey, max(o_orderkey) as max_o_orderkey from orders where o_orderdate >= timestamp '1998-01-01'")
def run_bounds(spark, root) -> DataFrame:
    return bounds.run_bounds(table(spark, root, "orders"), "o_orderkey", "o_orderdate", dt.date(1998, 1, 1))


@query("""
    select o_orderkey, o_orderdate from orders where year(o_orderdate) > 1998
      or (year(o_orderdate) = 1998 and month(o_orderdate) > 6)
      or (year(o_orderdate) = 1998 and month(o_orderdate) = 6 and day(o_orderdate) >= 10)""")
def since_partition_filter(spark, root) -> DataFrame:
    at = "o_orderdate"
    recent = bounds.since_partition(dt.date(1998, 6, 10), F.year(at), F.month(at), F.dayofmonth(at))
    return table(spark, root, "orders", "o_orderkey", at).filter(recent)


@query("select o_orderkey, year(o_orderdate)::int as dpyear from orders where o_orderdate >= timestamp '1998-01-01'")
def recent_partitions(spark, root) -> DataFrame:
    """Reads only the partitions of the years from the start on."""
    path, orders = scratch(spark, "years"), table(spark, root, "orders", "o_orderkey", "o_orderdate")
    orders.select("o_orderkey", F.year("o_orderdate").alias("dpyear")).write.partitionBy("dpyear").parquet(path)
    return bounds.recent(spark.read.parquet(path), dt.date(1998, 1, 1), ["dpyear"])


@query("select o_orderkey, o_orderstatus from orders where o_orderkey >= 500")
def since_id_filter(spark, root) -> DataFrame:
    return bounds.since_id(table(spark, root, "orders", "o_orderkey", "o_orderstatus"), "o_orderkey", 500)


@query("select l_linenumber, count(*) as n, sum(l_orderkey) as keys, 1 as least_met, 1 as most_met from lineitem group by 1")
def equi_depth_split(spark, root) -> DataFrame:
    lines = table(spark, root, "lineitem", "l_orderkey", "l_linenumber")
    parts = split_predicates("l_orderkey", equi_depth_bounds(lines, "l_orderkey", 16))
    met = sum((F.expr(f"coalesce({p}, false)").cast("int") for p in parts), F.lit(0))
    grouped = lines.withColumn("met", met).groupBy("l_linenumber")
    return grouped.agg(
        F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.min("met").alias("least_met"), F.max("met").alias("most_met")
    )


@query("""
    select o_orderkey, o_custkey, o_orderstatus from orders
    where o_orderkey >= (select max(o_orderkey) - max(o_orderkey) // 4 from orders)""")
def zone_map_since(spark, root) -> DataFrame:
    orders = table(spark, root, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    path, zones = scratch(spark, "orders"), scratch(spark, "zones")
    orders.repartitionByRange("o_orderkey").write.parquet(path)
    write_zones(spark, path, "o_orderkey", zones)
    most = spark.read.parquet(zones).agg(F.max("most")).first()[0] or 0
    return since_id_by_zones(spark, path, "o_orderkey", most - most // 4, zones)


@query("""
    select r_regionkey, r_name, case r_name when 'AFRICA' then 'SOUTH' when 'AMERICA' then 'WEST' when 'ASIA' then 'EAST' when 'EUROPE' then 'NORTH' end as zone,
      count(n_nationkey) as nations
    from region left join nation on n_regionkey = r_regionkey group by 1, 2, 3""")
def zone_lookup(spark, root) -> DataFrame:
    zones = literal_dim(spark, standin.ZONES, "zone", "r_name")
    nations = table(spark, root, "nation").groupBy("n_regionkey").agg(F.count("n_nationkey").alias("nations"))
    regions = table(spark, root, "region").join(zones, on="r_name", how="left")
    joined = regions.join(nations, regions.r_regionkey == F.col("n_regionkey"), "left")
    return joined.select("r_regionkey", "r_name", "zone", F.coalesce("nations", F.lit(0)).alias("nations"))


# --- projections and predicates ------------------------------------------------------------------


@query("""
    select o_orderkey, round(o_totalprice * 1.1, 4) as gross, round(o_totalprice * 1.1 - o_totalprice, 4) as fee,
      round((o_totalprice * 1.1 - o_totalprice) / 2, 4) as half_fee from orders""")
def lateral_alias(spark, root) -> DataFrame:
    priced = table(spark, root, "orders", "o_orderkey", "o_totalprice").selectExpr(
        "o_orderkey", "o_totalprice * 1.1D as gross", "gross - o_totalprice as fee", "fee / 2 as half_fee"
    )
    return rounded(priced)


@query("select l_orderkey, l_linenumber, 1 as heavy from lineitem where l_quantity > 45 or l_discount = 0")
def derived_filter(spark, root) -> DataFrame:
    heavy = F.when((F.col("l_quantity") > 45) | (F.col("l_discount") == 0), F.lit(1)).otherwise(F.lit(0))
    flagged = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", heavy.alias("heavy"))
    return flagged.filter(F.col("heavy") == 1)


@query("""
    select l_orderkey, l_linenumber, l_quantity, l_returnflag from lineitem
    where l_returnflag in ('A', 'R') and l_quantity > 10 and l_linestatus is not null and l_linestatus <> ''
      and (l_discount < 0.05 or l_tax > 0.06)""")
def token_filter(spark, root) -> DataFrame:
    c = F.col
    wanted = (
        c("l_returnflag").isin("A", "R")
        & (c("l_quantity") > 10)
        & c("l_linestatus").isNotNull()
        & (c("l_linestatus") != "")
        & ((c("l_discount") < 0.05) | (c("l_tax") > 0.06))
    )
    return table(spark, root, "lineitem").filter(wanted).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


@query("select c_custkey, case when lower(c_name) like '%7%' then 'Testing' else 'Customer' end as customer_flag from customer")
def customer_flag(spark, root) -> DataFrame:
    tester = contains_ci(F.col("c_name"), ["7"])
    flag = F.when(tester, F.lit("Testing")).otherwise(F.lit("Customer")).alias("customer_flag")
    return table(spark, root, "customer").select("c_custkey", flag)


@query(f"""
    select p_partkey as id, case when regexp_matches(trim(p_name), '^(hot .*|cold .*)$', 'i') then 1 else 0 end as name_flag,
      d.right_demand
    from part left join (
      select demand_id, case when lower(metadata_remarks) like '%just checking price%' or lower(own_remarks) like '%just checking price%'
        or lower(own_remarks) like '%via point not added%' or lower(raw_category) like '%type/weight%' or lower(expiry_remark) like '%type/weight%'
        or regexp_matches(trim(coalesce(metadata_remarks, '')), '{remark_regex()}', 'i') or regexp_matches(trim(coalesce(raw_category, '')), '{remark_regex()}', 'i')
        or regexp_matches(trim(coalesce(own_remarks, '')), '{remark_regex()}', 'i') or regexp_matches(trim(coalesce(expiry_remark, '')), '{remark_regex()}', 'i')
        then 0 else 1 end as right_demand
      from demands) d on d.demand_id = p_partkey""")
def right_demand_flag(spark, root) -> DataFrame:
    meta = F.col("metadata")
    live = spine.live_demands(Frames(spark, root)["demands"], PARAMS)
    flagged = live.select(
        "id",
        spine.right_demand(
            json_text(meta, "remarks"), json_text(meta, "remarksCategory"), F.col("remarks"), F.col("expiry_remark")
        ).alias("right_demand"),
    )
    named = F.when(matches_any([F.col("p_name")], ["hot .*", "cold .*"]), F.lit(1)).otherwise(F.lit(0))
    parts = table(spark, root, "part").select(F.col("p_partkey").alias("id"), named.alias("name_flag"))
    return parts.join(flagged, on="id", how="left")


@query("""
    select o_orderkey, case when o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R') then 1 else 0 end as returned from orders""")
def exists_flag(spark, root) -> DataFrame:
    returned = table(spark, root, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.exists_flag(table(spark, root, "orders", "o_orderkey"), returned, "o_orderkey", "returned")


@query(f"select key, name, case when name in ({quoted(PARAMS.regions.ncr)}) then 'NCR' else 'Non_NCR' end as ncr_flag from districts")
def region_flag(spark, root) -> DataFrame:
    flag = member_flag(F.col("name"), PARAMS.regions.ncr, "NCR", "Non_NCR")
    return Frames(spark, root)["districts"].select("key", "name", flag.alias("ncr_flag"))


# --- joins ---------------------------------------------------------------------------------------


@query("""
    select o_orderkey, l.lines, round(l.amount, 4) as amount, r.returned, s.last_ship from orders
    left join (select l_orderkey, count(*) as lines, sum(l_extendedprice) as amount from lineitem group by 1) l on l.l_orderkey = o_orderkey
    left join (select l_orderkey, count(*) as returned from lineitem where l_returnflag = 'R' group by 1) r on r.l_orderkey = o_orderkey
    left join (select l_orderkey, max(l_shipdate) as last_ship from lineitem where l_linestatus = 'F' group by 1) s on s.l_orderkey = o_orderkey""")
def enrich_left_chain(spark, root) -> DataFrame:
    lines = table(spark, root, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    parts = [
        lines.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("lines"), r4(F.sum("l_extendedprice")).alias("amount")),
        lines.filter(F.col("l_returnflag") == "R").groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("returned")),
        lines.filter(F.col("l_linestatus") == "F").groupBy("o_orderkey").agg(F.max("l_shipdate").alias("last_ship")),
    ]
    return J.enrich(table(spark, root, "orders", "o_orderkey"), parts, "o_orderkey")


@query("""
    select c_custkey, c_name, n_name as nation, r_name as region from customer
    left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey""")
def dim_lookup(spark, root) -> DataFrame:
    customers = table(spark, root, "customer", "c_custkey", "c_name", "c_nationkey")
    nations = J.lookup_left(customers, table(spark, root, "nation"), "c_nationkey", "n_nationkey", {"n_name": "nation", "n_regionkey": "rk"})
    out = J.lookup_left(nations, table(spark, root, "region"), "rk", "r_regionkey", {"r_name": "region"})
    return out.select("c_custkey", "c_name", "nation", "region")


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(a.avg_quantity, 4) as avg_quantity, a.pair_lines from lineitem
    join (select l_partkey, l_suppkey, avg(l_quantity) as avg_quantity, count(*) as pair_lines from lineitem group by 1, 2) a using (l_partkey, l_suppkey)""")
def multi_key_join(spark, root) -> DataFrame:
    lines = table(spark, root, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    keys = ["l_partkey", "l_suppkey"]
    pairs = lines.groupBy(*keys).agg(r4(F.avg("l_quantity")).alias("avg_quantity"), F.count(F.lit(1)).alias("pair_lines"))
    return J.multi_key_join(lines.drop("l_quantity"), pairs, keys, "inner").select(
        "l_orderkey", "l_linenumber", *keys, "avg_quantity", "pair_lines"
    )


@query("""
    select v.vehicle_type_id, b.id as band_id, b.min_length, b.max_length, b.max_weight from vehicle_types v
    left join vehicle_bands b on b.body_type = v.body_type and b.tyre = v.tyre_count
      and v.size_in_ft between b.min_length and b.max_length and v.tonnage between b.min_weight and b.max_weight""")
def range_lookup(spark, root) -> DataFrame:
    src = Frames(spark, root)
    types = src["vehicle_types"].select(F.col("id").alias("vehicle_type_id"), F.lower("body_type").alias("body"), "tyre_count", "size_in_ft", "tonnage")
    bands = src["vehicle_bands"].withColumn("body_type", F.lower("body_type")).withColumnRenamed("id", "band_id")
    return J.range_lookup(
        types, bands, {"body": "body_type", "tyre_count": "tyre"},
        {"size_in_ft": ("min_length", "max_length"), "tonnage": ("min_weight", "max_weight")},
        ["band_id", "min_length", "max_length", "max_weight"],
    ).select("vehicle_type_id", "band_id", "min_length", "max_length", "max_weight")


@query("""
    select l_orderkey, l_linenumber, s.s_suppkey as key, s.supplier_lines, round(s.avg_quantity, 4) as avg_quantity from (
      select *, case when l_orderkey % 3 = 0 then 1 when l_orderkey % 7 <> 1 then l_suppkey end as key from lineitem) l
    left join (select l_suppkey as s_suppkey, count(*) as supplier_lines, avg(l_quantity) as avg_quantity from lineitem group by 1) s on s.s_suppkey = l.key""")
def hot_key_lookup(spark, root) -> DataFrame:
    """A third of the lines and more ask for one supplier, some for none."""
    k = F.col("l_orderkey")
    key = F.when(k % 3 == 0, F.lit(1).cast("bigint")).when(k % 7 != 1, F.col("l_suppkey"))
    lines = table(spark, root, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey").select("l_orderkey", "l_linenumber", key.alias("key"))
    totals = table(spark, root, "lineitem", "l_suppkey", "l_quantity").groupBy(F.col("l_suppkey").alias("key")).agg(
        F.count(F.lit(1)).alias("supplier_lines"), r4(F.avg("l_quantity")).alias("avg_quantity")
    )
    return H.lookup_hot(lines, totals, "key", H.hot_keys(lines, ["key"]).get("key", ()))


#: Bands of prices around every fifth order of a priority: every seventh of them is wide, all overlap.
_BANDS = """
    select o_orderkey as band_id, o_orderpriority as class,
      o_totalprice - case when o_orderkey % 7 = 0 then 20000 else 40 end as low,
      o_totalprice + case when o_orderkey % 7 = 0 then 20000 else 40 + o_orderkey % 50 end as high,
      o_orderdate - interval 90 day as since, o_orderdate + interval 90 day as until
    from orders where o_orderkey % 5 = 0"""


def _price_bands(spark, root) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, root, "orders", "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderdate").withColumn("day", F.unix_date(F.to_date("o_orderdate")))
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    around = F.when(k % 7 == 0, F.lit(20_000))
    bands = orders.filter(k % 5 == 0).select(
        k.alias("band_id"), F.col("o_orderpriority").alias("class"),
        (price - F.coalesce(around, F.lit(40))).alias("low"), (price + F.coalesce(around, F.lit(40) + k % 50)).alias("high"),
        (F.col("day") - 90).alias("since"), (F.col("day") + 90).alias("until"),
    )
    return orders, bands


@query(f"""
    with b as ({_BANDS})
    select o_orderkey, count(*) as bands, min(band_id) as first_band, max(band_id) as last_band from orders
    join b on class = o_orderpriority and o_totalprice between low and high and o_orderdate between since and until group by 1""")
def grid_range_lookup(spark, root) -> DataFrame:
    """Orders and the wide and narrow bands of price and time that hold them, on a grid of both measures."""
    orders, bands = _price_bands(spark, root)
    ranges = {"o_totalprice": ("low", "high"), "day": ("since", "until")}
    hits = grid.grid_lookup(orders, bands, {"o_orderpriority": "class"}, ranges, {"o_totalprice": 50.0, "day": 64.0}, ["band_id"])
    return hits.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("bands"), F.min("band_id").alias("first_band"), F.max("band_id").alias("last_band")
    )


@query("select * from current_rates")
def range_lookup_latest(spark, root) -> DataFrame:
    from lanemart.plans.mart import placed_demands, wide_spine

    src = Frames(spark, root)
    spine = wide_spine(src, PARAMS)
    wide = spine.select("demand_id", "vehicle_type_id").join(placed_demands(src, spine, PARAMS), on="demand_id")
    catalog = pricing.rate_catalog(src["current_rates"], src["rate_lanes"], src["places"], src["vehicle_bands"])
    return pricing.demand_rates(wide, catalog)


@query("""
    select p.event_id, coalesce(e.event_type, 'none') as status_before
    from (select event_id, user_id, ts from events where event_type = 'purchase') p
    asof left join (select user_id, ts, event_type from events where event_type <> 'purchase') e
      on e.user_id = p.user_id and p.ts > e.ts""", name="asof_before")
def asof_before_query(spark, root) -> DataFrame:
    events = table(spark, root, "events", "event_id", "user_id", "ts", "event_type")
    probes = events.filter(F.col("event_type") == "purchase")
    history = events.filter(F.col("event_type") != "purchase")
    return asof_before(
        probes, history, "user_id", "ts", "ts", "event_type", "status_before", ["event_id"], default="none", bucket_seconds=86_400
    )


@query("""
    select p.event_id, count(distinct s.user_id) as active_members from
      (select event_id, event_id % 7 as lane, event_type, ts from events) p
      join (select user_id, event_id % 7 as lane, event_type, min(ts) as start from events group by 1, 2, 3) s
        on s.lane = p.lane and s.event_type = p.event_type and p.ts >= s.start
    group by 1""")
def lane_match_count(spark, root) -> DataFrame:
    events = table(spark, root, "events", "event_id", "user_id", "ts", "event_type").withColumn("lane", F.col("event_id") % 7)
    return count_lane_matches(
        events, events, ["lane", "event_type"], "user_id", "ts", "event_id", "ts", "active_members", bucket_seconds=86_400
    )


@query("select * from supply_lanes")
def supply_lanes(spark, root) -> DataFrame:
    src = Frames(spark, root)
    return supply.supply_lanes(
        src["gps_lanes"], src["operators"], src["operator_vehicles"], src["vehicles"], src["vehicle_catalog"],
        src["district_clusters"], src["subscriptions"],
    )


@query("""
    select o.o_orderkey, l.l_linenumber, l.l_quantity from orders o
    join lineitem l on l.l_orderkey = o.o_orderkey where l.l_orderkey is not null""")
def code_part_join(spark, root) -> DataFrame:
    code = F.concat(F.lit("XX-"), F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    coded = table(spark, root, "lineitem").select(code.alias("code"), "l_linenumber", "l_quantity")
    return J.join_on_code_part(table(spark, root, "orders", "o_orderkey"), "o_orderkey", coded, "code", ["l_linenumber", "l_quantity"])


@query("select c_custkey, n_name, r_name from customer left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey")
def normalized_key_join(spark, root) -> DataFrame:
    nations = table(spark, root, "nation").join(table(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    suffix = F.when(F.col("n_nationkey") % 2 == 0, F.lit("-a")).otherwise(F.lit("–b"))
    keyed = nations.select(F.concat(F.col("n_nationkey").cast("string"), suffix).alias("nation_code"), "n_name", "r_name")
    customers = table(spark, root, "customer").select(
        "c_custkey", F.concat(F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 3 == 0, F.lit("–x")).otherwise(F.lit("-y"))).alias("key")
    )
    return J.join_on_norm_key(customers, "key", keyed, "nation_code", ["n_name", "r_name"]).select("c_custkey", "n_name", "r_name")


@query("""
    select c_custkey, case when c_nationkey < 5 then coalesce(o.name, null) else n_name end as nation,
      case when c_nationkey < 5 then o.region else c_nationkey % 5 end as region_no
    from customer join nation on n_nationkey = c_nationkey
    left join (select c_custkey as k, 'OVERRIDE_' || (c_custkey % 10) as name, c_custkey % 5 as region from customer where c_mktsegment <> 'BUILDING') o on o.k = c_custkey""")
def keyed_backfill(spark, root) -> DataFrame:
    customers = table(spark, root, "customer")
    joined = customers.join(table(spark, root, "nation"), customers.c_nationkey == F.col("n_nationkey"))
    known = F.col("c_nationkey") >= 5
    spine_rows = joined.select(
        "c_custkey",
        F.when(known, F.col("n_name")).alias("nation"),
        F.when(known, (F.col("c_nationkey") % 5).cast("bigint")).alias("region_no"),
    )
    sheet = customers.filter(F.col("c_mktsegment") != "BUILDING").select(
        "c_custkey", F.concat(F.lit("OVERRIDE_"), (F.col("c_custkey") % 10).cast("string")).alias("name"), (F.col("c_custkey") % 5).alias("region")
    )
    return J.keyed_backfill(spine_rows, sheet, "c_custkey", "nation", {"nation": "name", "region_no": "region"})


@query("select odvt_base_rate_id, origin, destination, body_type, tyre_count, min_length, max_length, min_weight, max_weight, source, created, base_rate_updated_by, p1, p2, p3, odvt_id from rate_catalog")
def rate_catalog(spark, root) -> DataFrame:
    src = Frames(spark, root)
    return pricing.rate_catalog(src["current_rates"], src["rate_lanes"], src["places"], src["vehicle_bands"])


@query("select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders where o_orderstatus = 'P')")
def semi_filter(spark, root) -> DataFrame:
    expired = table(spark, root, "orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return J.semi_filter(table(spark, root, "customer", "c_custkey", "c_name"), expired, "c_custkey")


# --- aggregates ----------------------------------------------------------------------------------


@query("select o_custkey, min(o_orderkey) as first_trip_id from orders where o_orderstatus = 'F' group by 1")
def first_id_per_key(spark, root) -> DataFrame:
    return A.first_id(table(spark, root, "orders"), "o_custkey", "o_orderkey", F.col("o_orderstatus") == "F", "first_trip_id")


@query("""
    select demand_id, round(shipper_discount, 4) as shipper_discount, round(shipper_discount_reversal, 4) as shipper_discount_reversal from shipper""")
def credit_debit_sums(spark, root) -> DataFrame:
    return rounded(C.shipper_discounts(Frames(spark, root)["trip_expense"], PARAMS))


@query("""
    select consignment_id, round(fo_commission_reversal, 4) as fo_commission_reversal, round(fo_commission, 4) as fo_commission from commission""")
def operator_commission(spark, root) -> DataFrame:
    src = Frames(spark, root)
    return rounded(C.operator_commission(src["consignment_expense"], src["consignments"], PARAMS))


@query("select * from token_modes")
def token_modes(spark, root) -> DataFrame:
    src = Frames(spark, root)
    return pricing.token_modes(pricing.tokens(src["tokens_hot"], src["tokens_archive"], PARAMS))


@query("select * from milestones")
def status_milestones(spark, root) -> DataFrame:
    return C.status_milestones(Frames(spark, root)["demand_sub_status"], PARAMS)


@query("""
    select l_orderkey, 1 as rate_flag, max(case when l_returnflag = 'A' then l_extendedprice end) as rate_a,
      max(case when l_returnflag = 'N' then l_extendedprice end) as rate_n, max(case when l_returnflag = 'R' then l_extendedprice end) as rate_r
    from lineitem group by 1""")
def rate_pivot(spark, root) -> DataFrame:
    names = {"A": "rate_a", "N": "rate_n", "R": "rate_r"}
    return A.pivot_max(table(spark, root, "lineitem"), "l_orderkey", "l_returnflag", "l_extendedprice", names, "rate_flag")


@query("select demand_id, 'Multiple' as drop_points from multi_drop")
def multi_drop_flag(spark, root) -> DataFrame:
    return C.multi_drop(Frames(spark, root)["addresses"], PARAMS)


@query("select demand_id, round(noitf_delivered_fo, 4) as noitf_delivered_fo from delivered")
def delivered_pct(spark, root) -> DataFrame:
    return rounded(supply.delivered_pct(Frames(spark, root)["notifications"], PARAMS))


@query("select * from experiment_names")
def experiment_names(spark, root) -> DataFrame:
    src = Frames(spark, root)
    return C.experiment_names(src["bidding_config"], src["experiments"], PARAMS)


@query("select distinct l_orderkey as demand_id, 'Operator' as placed_cancel_reason from lineitem where l_returnflag = 'R'")
def dedupe_pairs(spark, root) -> DataFrame:
    return C.operator_cancels(Frames(spark, root)["cancellations"])


@query("""
    select b.body_type as band_body, b.tyre as band_tyre, b.min_length as min_size, b.max_length as max_size, max(b.max_weight) as tonnage_limit,
      round(max(b.max_height), 4)::double as height_limit, count(v.vehicle_type_id) as vehicle_types
    from vehicle_bands b left join vehicle_types v on v.body_type = b.body_type and v.tyre_count = b.tyre and v.size_in_ft between b.min_length and b.max_length
    group by 1, 2, 3, 4""")
def band_limits(spark, root) -> DataFrame:
    src = Frames(spark, root)
    keys = ["band_body", "band_tyre", "min_size", "max_size"]
    limits = A.band_limits(vehicles.pricing_bands(src["vehicle_bands"]), keys, {"max_tonnage": "tonnage_limit", "max_height": "height_limit"})
    types = src["vehicle_types"].select("id", F.lower("body_type").alias("body"), "tyre_count", "size_in_ft")
    fits = (
        (F.col("body") == F.col("band_body"))
        & (F.col("tyre_count") == F.col("band_tyre"))
        & F.col("size_in_ft").between(F.col("min_size"), F.col("max_size"))
    )
    counted = limits.join(types, fits, "left").groupBy(*keys, "tonnage_limit", "height_limit").agg(F.count("id").alias("vehicle_types"))
    return rounded(counted)


# --- windows -------------------------------------------------------------------------------------


@query("""
    select demand_id, consignment_code, operator_code, vehicle_id, updated from consignments where rn = 1""")
def latest_per_key(spark, root) -> DataFrame:
    live = bounds.not_deleted(Frames(spark, root)["consignments"]).withColumnRenamed("code", "consignment_code")
    return W.latest_per_key(
        live, "demand_id", ["updated", *PARAMS.consignment_tie], ["consignment_code", "operator_code", "vehicle_id", "updated"]
    )


@query("select demand_id, consignment_code, operator_code, total_consignments from latest_consignments")
def latest_with_count(spark, root) -> DataFrame:
    latest = C.latest_consignments(Frames(spark, root)["consignments"], PARAMS)
    return latest.select("demand_id", "consignment_code", "operator_code", "total_consignments")


@query("select * from subscription_starts")
def first_subscription(spark, root) -> DataFrame:
    return supply.subscription_starts(Frames(spark, root)["subscriptions"])


@query("""
    select demand_id, consigner_onboarding_date, consigner_fulfilled_demand_date, consigner_fulfilled_demand_id,
      case when demand_id > consigner_fulfilled_demand_id then 'Repeat Consigner' else 'New Consigner' end as consigner_type
    from demands left join history using (consigner_user_code)""")
def consigner_history(spark, root) -> DataFrame:
    demands = Frames(spark, root)["demands"]
    spine_rows = bounds.not_deleted(demands).select(F.col("id").alias("demand_id"), "consigner_user_code")
    hot = H.hot_keys(spine_rows, ["consigner_user_code"])
    joined = H.lookup_hot(spine_rows, G.consigner_history(demands, PARAMS), "consigner_user_code", hot.get("consigner_user_code", ()))
    return joined.select(
        "demand_id", "consigner_onboarding_date", "consigner_fulfilled_demand_date", "consigner_fulfilled_demand_id",
        G.consigner_type(F.col("demand_id"), F.col("consigner_fulfilled_demand_id")).alias("consigner_type"),
    )


@query("select * from fulfilled")
def fulfilled_rank(spark, root) -> DataFrame:
    return G.fulfilled_rank(Frames(spark, root)["demands"], PARAMS)


@query("""
    select user_id, max(case when up = 1 then event_type end) as first_type, max(case when down = 1 then event_type end) as latest_type
    from (select *, row_number() over (partition by user_id order by t, event_type) as up, row_number() over (partition by user_id order by t desc, event_type desc) as down
          from (select user_id, event_type, min(ts) as t from events group by 1, 2)) group by 1""")
def first_latest_value(spark, root) -> DataFrame:
    return W.first_latest(table(spark, root, "events"), "user_id", "event_type", "ts", "first_type", "latest_type")


# --- unions --------------------------------------------------------------------------------------


@query("select l_orderkey, l_linenumber, l_quantity, l_shipdate from lineitem where l_shipdate >= timestamp '1996-01-01'")
def hot_cold_union(spark, root) -> DataFrame:
    lines = table(spark, root, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    # Both stores hold the whole history; each row must still come out once.
    return unite(lines, lines, "l_shipdate", cutoff=dt.date(1998, 1, 1), since=dt.date(1996, 1, 1))


@query("""
    select user_id, event_type from events where event_type = 'view' union select user_id, event_type from events where value > 50
    union select user_id, event_type from events where event_type = 'purchase'""")
def union_distinct_pairs(spark, root) -> DataFrame:
    e = table(spark, root, "events", "user_id", "event_type", "value")
    kinds = [e.filter(F.col("event_type") == "view"), e.filter(F.col("value") > 50), e.filter(F.col("event_type") == "purchase")]
    return union_distinct([k.select("user_id", "event_type") for k in kinds])


@query("select * from engagement")
def engagement_count(spark, root) -> DataFrame:
    src = Frames(spark, root)
    return supply.engagement([src["app_events_1"], src["app_events_2"], src["app_events_3"]], PARAMS)


# --- sinks ---------------------------------------------------------------------------------------


@query("select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders")
def sink_roundtrip(spark, root) -> DataFrame:
    path = scratch(spark, "roundtrip")
    write_parquet(table(spark, root, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), path)
    return spark.read.parquet(path)


@query("""
    select o_orderkey, case when o_orderkey >= 700 then o_totalprice + 1 else o_totalprice end as o_totalprice
    from orders where o_orderkey < 700 or o_orderstatus <> 'P'""")
def replace_since(spark, root) -> DataFrame:
    path, start, width = scratch(spark, "replace"), 700, 10_000
    orders = table(spark, root, "orders", "o_orderkey", "o_totalprice", "o_orderstatus")
    write_bucketed_by_id(orders.select("o_orderkey", "o_totalprice"), path, "o_orderkey", width)
    batch = bounds.since_id(orders, "o_orderkey", start).filter(F.col("o_orderstatus") != "P")
    batch = batch.select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    for _ in range(2):  # a repeated load must not change the result
        replace_since_files(spark, path, batch, "o_orderkey", start, width)
    return spark.read.parquet(path).drop(BUCKET)
