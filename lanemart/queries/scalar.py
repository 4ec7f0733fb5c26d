"""Scalar expression families on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.functions import json as JS
from lanemart.functions import numbers as N
from lanemart.functions import text as T
from lanemart.functions import time as TM
from lanemart.functions.rules import labels, ladder
from lanemart.operators import arrays
from lanemart.plans import pricing
from lanemart.queries import query
from lanemart.queries.helpers import Frames, rounded, table
from lanemart.sources.bounds import not_deleted
from lanemart.standin import PARAMS


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_extract(spark, root) -> DataFrame:
    k = JS.json_text(F.col("props"), "k").try_cast("bigint")
    return table(spark, root, "events").select("event_id", k.alias("k"))


@query("""
    select demand_id, from_lat, from_long, case when request in (0) then 5.5 when request = 7 then 0.5 end::double as overheight,
      case when request in (3, 7) then 'true' end as opendala from demands""")
def json_extract_nested(spark, root) -> DataFrame:
    demands = not_deleted(Frames(spark, root)["demands"])
    geo, body = JS.json_text(F.col("from_address_dto"), "geoLoc"), JS.json_text(F.col("metadata"), "specialRequestBody")
    return demands.select(
        F.col("id").alias("demand_id"),
        JS.json_double(geo, "x").alias("from_lat"),
        JS.json_double(geo, "y").alias("from_long"),
        JS.json_double(body, "overHeight").alias("overheight"),
        JS.json_text(body, "openDala").alias("opendala"),
    )


@query("""
    select demand_id, from_lat, from_long, case when request in (0) then 5.5 when request = 7 then 0.5 end::double as overheight,
      case when request in (3, 7) then 'true' end as opendala, service_charge, route_distance, supplyfare_before_consignment
    from demands""")
def variant_documents(spark, root) -> DataFrame:
    demands = not_deleted(Frames(spark, root)["demands"]).select("id", "from_address_dto", "metadata")
    parsed = JS.with_document(JS.with_document(demands, F.col("metadata"), "meta"), F.col("from_address_dto"), "address")
    # The addresses and requests are JSON texts or objects inside their documents; an object comes out as text as well.
    inner = JS.with_document(parsed, JS.document_text(F.col("meta"), "specialRequestBody"), "body")
    inner = JS.with_document(inner, JS.document_text(F.col("address"), "geoLoc"), "geo")
    meta, body, geo = F.col("meta"), F.col("body"), F.col("geo")
    return inner.select(
        F.col("id").alias("demand_id"),
        JS.document_double(geo, "x").alias("from_lat"),
        JS.document_double(geo, "y").alias("from_long"),
        JS.document_double(body, "overHeight").alias("overheight"),
        JS.document_text(body, "openDala").alias("opendala"),
        JS.document_double(meta, "serviceChargePct", 0).alias("service_charge"),
        JS.document_double(meta, "estimatedRouteDistance", 0).alias("route_distance"),
        JS.document_double(meta, "supplyFreightFareBeforeConsignment").alias("supplyfare_before_consignment"),
    )


@query("select demand_id, service_charge, route_distance, supplyfare_before_consignment from demands")
def json_numeric_default(spark, root) -> DataFrame:
    meta = F.col("metadata")
    return not_deleted(Frames(spark, root)["demands"]).select(
        F.col("id").alias("demand_id"),
        JS.json_double(meta, "serviceChargePct", 0).alias("service_charge"),
        JS.json_double(meta, "estimatedRouteDistance", 0).alias("route_distance"),
        JS.json_double(meta, "supplyFreightFareBeforeConsignment").alias("supplyfare_before_consignment"),
    )


@query("select demand_id, metadata_remarkscategory from demands")
def json_fallback(spark, root) -> DataFrame:
    category = JS.json_or(F.col("metadata"), "remarksCategory", F.col("expiry_remark"))
    return not_deleted(Frames(spark, root)["demands"]).select(F.col("id").alias("demand_id"), category.alias("metadata_remarkscategory"))


@query("select l_orderkey, l_linenumber, case when l_discount > 0.05 then l_discount else l_tax end as quote from lineitem")
def quote_pick(spark, root) -> DataFrame:
    over = F.when(F.col("l_discount") > 0.05, F.col("l_discount"))
    return table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", N.positive_or(over, F.col("l_tax")).alias("quote"))


@query("""
    select o_orderkey, o_orderdate + interval '5 hours 30 minutes' as local_date, o_orderdate + interval '5 hours 30 minutes' as from_epoch from orders""")
def local_time_shift(spark, root) -> DataFrame:
    at = F.col("o_orderdate")
    seconds = TM.epoch_seconds(at).cast("string")
    return table(spark, root, "orders").select(
        "o_orderkey", TM.to_local(at).alias("local_date"), TM.epoch_to_local(seconds).alias("from_epoch")
    )


@query("select event_id, hour(ts)::int as event_hour, cast(ts as date) as event_day from events")
def hour_bucket(spark, root) -> DataFrame:
    at = F.col("ts")
    return table(spark, root, "events").select("event_id", TM.hour_of(at).alias("event_hour"), TM.day_of(at).alias("event_day"))


@query("""
    select user_id, round(date_diff('second', min(ts), max(ts)) / 60.0, 4) as active_minutes from events group by 1""")
def minutes_between(spark, root) -> DataFrame:
    spans = table(spark, root, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return rounded(spans.select("user_id", TM.minutes_between(F.col("a"), F.col("b")).alias("active_minutes")))


@query("""
    select demand_id, base_price, round(extra_discount, 4) as extra_discount, round(updated_fare, 4) as updated_fare from fares""")
def step_round(spark, root) -> DataFrame:
    from lanemart.plans.spine import demand_spine

    spine = demand_spine(Frames(spark, root)["demands"], PARAMS)
    return rounded(spine.select("demand_id", "base_price", "extra_discount", F.col("updated_consigner_freight_fare").alias("updated_fare")))


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * (1 + l_discount), 4) as marked,
      floor((l_extendedprice * (1 + l_discount) + 99) / 100) * 100 as marked_step from lineitem""")
def rate_markup(spark, root) -> DataFrame:
    marked = F.col("l_extendedprice") * (1 + F.col("l_discount"))
    by_percent = N.markup(F.col("l_extendedprice"), F.col("l_discount") * 100)
    return rounded(
        table(spark, root, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", by_percent.alias("marked"), N.step_round(marked).alias("marked_step")
        )
    )


@query("select demand_id, round(token_forfeit, 4) as token_forfeit from token_forfeit")
def token_forfeit(spark, root) -> DataFrame:
    src = Frames(spark, root)
    return rounded(pricing.token_forfeit(pricing.tokens(src["tokens_hot"], src["tokens_archive"], PARAMS)))


@query("""
    select p_partkey, cast(regexp_replace(p_brand, '[A-Za-z .#]+', '', 'g') as int) as brand_number,
      coalesce(try_cast(nullif(regexp_replace(p_name, '[A-Za-z .]+', '', 'g'), '') as int), -1) as name_number from part""")
def version_number(spark, root) -> DataFrame:
    brand = F.translate(F.col("p_brand"), "#", ".")
    return table(spark, root, "part").select(
        "p_partkey", N.version_number(brand).alias("brand_number"), N.version_number(F.col("p_name")).alias("name_number")
    )


@query("select demand_id, unnest(ids) as experiment_id from bidding_config where ids is not null")
def explode_id_list(spark, root) -> DataFrame:
    config = Frames(spark, root)["bidding_config"].filter(F.col("experiment_ids") != "")
    return arrays.explode_id_list(config, "demand_id", "experiment_ids", "experiment_id")


@query("select n_nationkey, n_name || '_' || r_name as district, split_part(n_name || '_' || r_name, '_', 3) as state from nation join region on r_regionkey = n_regionkey")
def district_label(spark, root) -> DataFrame:
    nations = table(spark, root, "nation").join(table(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    district = T.label(F.col("n_name"), F.col("r_name"))
    return nations.select("n_nationkey", district.alias("district"), T.code_part(district, "_", 3).alias("state"))


@query("""
    select demand_id, coalesce(vehicle_type_id, -1) as vehicle_type_id, coalesce(actual, fare) as fare, coalesce(metadata_remarks, expiry_remark, 'none') as remark,
      coalesce(actual, 0.0) as actual_or_zero from demands""")
def null_fill(spark, root) -> DataFrame:
    actual, fare = F.col("actual_consigner_freight_fare"), F.col("consigner_freight_fare")
    return not_deleted(Frames(spark, root)["demands"]).select(
        F.col("id").alias("demand_id"),
        N.fill(F.col("vehicle_type_id"), F.lit(-1)).alias("vehicle_type_id"),
        N.fill(actual, fare).alias("fare"),
        N.fill(JS.json_text(F.col("metadata"), "remarks"), F.col("expiry_remark"), F.lit("none")).alias("remark"),
        N.zero(actual).alias("actual_or_zero"),
    )


@query("select id, veh_tyre_type, vehicles from (select b.id, b.veh_tyre_type, count(v.vehicle_type_id) as vehicles from band_class b left join vehicle_class v on v.vt_pricing_id = b.id group by 1, 2)")
def rule_ladder(spark, root) -> DataFrame:
    from lanemart.plans import vehicles as V

    src = Frames(spark, root)
    bands = V.pricing_bands(src["vehicle_bands"]).select(F.col("vt_pricing_id").alias("id"), "veh_tyre_type")
    classes = V.vehicle_class(src["vehicle_types"], src["vehicle_bands"], src["vehicle_catalog"])
    counts = classes.groupBy(F.col("vt_pricing_id").cast("bigint").alias("id")).agg(F.count("vehicle_type_id").alias("vehicles"))
    return bands.join(counts, on="id", how="left").select("id", "veh_tyre_type", F.coalesce("vehicles", F.lit(0)).alias("vehicles"))


@query("""
    select o_orderkey, case when o_totalprice > 400000 and o_orderstatus = 'F' then 'BIG_DONE' when o_totalprice > 400000 then 'BIG'
      when o_orderdate < timestamp '1997-01-01' then 'OLD' else 'OTHER' end as kind from orders""")
def order_ladder(spark, root) -> DataFrame:
    big, done = F.col("o_totalprice") > 400_000, F.col("o_orderstatus") == "F"
    old = F.col("o_orderdate") < F.lit(dt.date(1997, 1, 1)).cast("timestamp_ntz")
    kind = ladder([(big & done, "BIG_DONE"), (big, "BIG"), (old, "OLD")], "OTHER")
    return table(spark, root, "orders").select("o_orderkey", kind.alias("kind"))


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, concat_ws(',', case when l_quantity > 25 then 'HEAVY' end, case when l_discount > 0.05 then 'CHEAP' end,
      case when l_returnflag = 'R' then 'RETURNED' end) as labels from lineitem""")
def label_array(spark, root) -> DataFrame:
    rules = [(F.col("l_quantity") > 25, "HEAVY"), (F.col("l_discount") > 0.05, "CHEAP"), (F.col("l_returnflag") == "R", "RETURNED")]
    return table(spark, root, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array_join(labels(rules), ",").alias("labels")
    )


@query("""
    select o_orderkey, try_cast(split_part(o_orderpriority, '-', 1) as int) as priority_no, try_cast(o_orderpriority as double) as not_a_number,
      cast(o_orderkey as varchar) as key_text from orders""")
def safe_casts(spark, root) -> DataFrame:
    priority = F.col("o_orderpriority")
    return table(spark, root, "orders").select(
        "o_orderkey",
        N.safe_cast(T.code_part(priority, "-", 1), "int").alias("priority_no"),
        N.safe_cast(priority, "double").alias("not_a_number"),
        F.col("o_orderkey").cast("string").alias("key_text"),
    )


@query("select event_id, case when event_id % 17 <> 0 then event_id % 500 end as demand_id from events where event_type = 'view'")
def digits_guard(spark, root) -> DataFrame:
    e = table(spark, root, "events", "event_id", "event_type").filter(F.col("event_type") == "view")
    text = (F.col("event_id") % 500).cast("string")
    entity = F.when(F.col("event_id") % 17 == 0, F.concat(text, F.lit("a"))).otherwise(text)
    return e.select("event_id", N.int_or_null(entity).alias("demand_id"))
