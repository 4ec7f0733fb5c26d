"""Domain stages and the flagship mart on the stand-in sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.operators.joins import enrich
from lanemart.plans import consignments as C
from lanemart.plans import consigners as G
from lanemart.plans import geography as GEO
from lanemart.plans import mart as M
from lanemart.plans import pricing, vehicles
from lanemart.plans.spine import demand_spine
from lanemart.queries import query
from lanemart.queries.helpers import Frames, rounded, scratch
from lanemart.sinks.lake import Cuts, arrays_to_text, write_parquet
from lanemart.sinks.replace import BUCKET, replace_since_files, write_bucketed_by_id
from lanemart.sources.readers import Sources
from lanemart.standin import PARAMS


@query("""
    select demand_id, demand_date, updated_at, consigner_user_code, vehicle_type_id, status, fare as consigner_freight_fare, round(actual, 4) as actual_consigner_freight_fare,
      round(service_charge, 4) as service_charge, app_version, dr_type, metadata_plt, metadata_remarks, metadata_remarkscategory, route_distance,
      shortest_route_distance, supplyfare_before_consignment, from_lat, from_long, to_lat, to_long, 'MODEL' as predicted_rate_source,
      origin_district_key, destination_district_key, base_price, round(extra_discount, 4) as extra_discount, round(updated_fare, 4) as updated_consigner_freight_fare
    from fares""", name="demand_spine")
def demand_spine_query(spark, root) -> DataFrame:
    return rounded(demand_spine(Frames(spark, root)["demands"], PARAMS))


@query("select * from vehicle_class")
def vehicle_class(spark, root) -> DataFrame:
    src = Frames(spark, root)
    return vehicles.vehicle_class(src["vehicle_types"], src["vehicle_bands"], src["vehicle_catalog"])


@query("""
    select demand_id, consignment_code, supplyfare, consignment_date, operator_code, vehicle_id, trip_state, total_consignments, trip_end_time,
      round(fo_commission_reversal, 4) as fo_commission_reversal, round(fo_commission, 4) as fo_commission,
      case when m.demand_id is not null then 'Multiple' else 'Single' end as drop_points
    from consignment_summary left join multi_drop m using (demand_id)""")
def consignment_summary(spark, root) -> DataFrame:
    src = Frames(spark, root)
    summary = C.consignment_summary(src["consignments"], src["consignment_state"], src["consignment_expense"], PARAMS)
    out = enrich(summary, [C.multi_drop(src["addresses"], PARAMS)], "demand_id")
    return rounded(out.withColumn("drop_points", F.coalesce("drop_points", F.lit("Single"))))


@query("""
    select d.demand_id, t.customer_type, t.customer_flag, h.consigner_onboarding_date, h.consigner_fulfilled_demand_id, f.fulfilled_rank,
      case when d.demand_id > h.consigner_fulfilled_demand_id then 'Repeat Consigner' else 'New Consigner' end as consigner_type
    from demands d left join consigner_types t using (consigner_user_code) left join history h using (consigner_user_code) left join fulfilled f using (demand_id)""")
def consigner_profile(spark, root) -> DataFrame:
    src = Frames(spark, root)
    profiled = G.consigner_profile(src["demands"], src["consigners"], PARAMS)
    ranked = enrich(profiled, [G.fulfilled_rank(src["demands"], PARAMS)], "demand_id")
    return ranked.select(
        "demand_id", "customer_type", "customer_flag", "consigner_onboarding_date", "consigner_fulfilled_demand_id",
        "fulfilled_rank", "consigner_type",
    )


@query("""
    select b.*, coalesce(p.pricing_type, 'NA') as pricing_type from base_rates b left join pricing_types p using (demand_id)""")
def base_rates(spark, root) -> DataFrame:
    src = Frames(spark, root)
    rates = pricing.base_rates(src["quotes_hot"], src["quotes_archive"], src["bidding_config"], PARAMS)
    typed = enrich(rates, [pricing.pricing_types(src["bidding_config"], PARAMS)], "demand_id")
    return typed.withColumn("pricing_type", F.coalesce("pricing_type", F.lit("NA")))


@query("select * from placement")
def placement(spark, root) -> DataFrame:
    src = Frames(spark, root)
    token_rows = pricing.tokens(src["tokens_hot"], src["tokens_archive"], PARAMS)
    return pricing.placement(C.latest_consignments(src["consignments"], PARAMS), token_rows)


@query("""
    select demand_id, round(shipper_discount, 4) as shipper_discount, round(shipper_discount_reversal, 4) as shipper_discount_reversal,
      round(consigner_pnl, 4) as consigner_pnl, round(fo_pnl, 4) as fo_pnl, round(consigner_pnl + fo_pnl, 4) as pnl from margin""")
def margin(spark, root) -> DataFrame:
    src = Frames(spark, root)
    token_rows = pricing.tokens(src["tokens_hot"], src["tokens_archive"], PARAMS)
    parts = [
        C.consignment_costs(src["consignments"], src["consignment_expense"], PARAMS),
        C.shipper_discounts(src["trip_expense"], PARAMS),
        pricing.token_forfeit(token_rows),
    ]
    priced = pricing.with_margin(enrich(demand_spine(src["demands"], PARAMS), parts, "demand_id"))
    return rounded(priced.select("demand_id", "shipper_discount", "shipper_discount_reversal", "consigner_pnl", "fo_pnl", "pnl"))


@query("""
    select demand_id, experiment_name, segment_config_first, segment_config_latest
    from demands left join experiment_names using (demand_id) left join segments using (demand_id)""")
def experiments_segments(spark, root) -> DataFrame:
    src = Frames(spark, root)
    parts = [C.experiment_names(src["bidding_config"], src["experiments"], PARAMS), C.segments(src["segment_mapping"])]
    return enrich(demand_spine(src["demands"], PARAMS).select("demand_id"), parts, "demand_id")


@query("""
    select demand_id, special_req, array_to_string(special_type, ',') as special_type, pricing_special_req,
      case when pricing_special_req = 1 then array_to_string(priced_type, ',') end as pricing_special_type from special""")
def special_requests(spark, root) -> DataFrame:
    src = Frames(spark, root)
    return arrays_to_text(vehicles.special_requests(src["demands"], src["vehicle_types"], src["vehicle_bands"], PARAMS))


@query("select * exclude (demand_date) from geography")
def geography(spark, root) -> DataFrame:
    src = Frames(spark, root)
    spine = demand_spine(src["demands"], PARAMS).select("demand_id", "demand_date", "origin_district_key", "destination_district_key")
    placed = GEO.places(spine, src["districts"], override_sheet(spark, src["district_overrides"]), PARAMS)
    return GEO.with_regions(spine.select("demand_id", "demand_date").join(placed, on="demand_id"), PARAMS).drop("demand_date")


def override_sheet(spark, rows: DataFrame) -> DataFrame:
    """The override sheet as it comes in: exported as CSV, read by the sheet reader."""
    path = scratch(spark, "sheet")
    rows.write.option("header", True).csv(path)
    return Sources(spark).sheet(path, rows.schema)


@query("select * from restriction")
def restriction_asof(spark, root) -> DataFrame:
    src = Frames(spark, root)
    spine = demand_spine(src["demands"], PARAMS)
    milestones = C.status_milestones(src["demand_sub_status"], PARAMS)
    found = G.restriction_asof(spine, milestones, src["restrictions"], PARAMS)
    names = ("consigner_payment_status", "consigner_payment_status_at_dr")
    return enrich(spine.select("demand_id"), [found], "demand_id").select(
        "demand_id", *[F.coalesce(n, F.lit("UNRESTRICTED")).alias(n) for n in names]
    )


@query("select demand_id, dr_book_by, plc_demand_type from outcome left join booked_by using (demand_id)")
def demand_type(spark, root) -> DataFrame:
    src = Frames(spark, root)
    wide = demand_spine(src["demands"], PARAMS).select("demand_id", "demand_date")
    parts = [
        C.latest_consignments(src["consignments"], PARAMS).select("demand_id", "total_consignments"),
        C.operator_cancels(src["cancellations"]),
        C.booked_by(src["demand_sub_status"], PARAMS),
    ]
    from lanemart.functions.rules import demand_type as kind
    from lanemart.functions.time import hour_of

    return enrich(wide, parts, "demand_id").select(
        "demand_id",
        "dr_book_by",
        kind(
            hour_of(F.col("demand_date")), F.col("total_consignments"), F.col("placed_cancel_reason"), F.col("dr_book_by"), PARAMS.retry_user
        ).alias("plc_demand_type"),
    )


@query("""
    select demand_id, non_plc_reason, pricing_special_req, coalesce(ccvt_supply_lane_match_fo, 0)::double as ccvt_supply_lane_match_fo,
      coalesce(total_opsearch_fo, 0)::double as total_opsearch_fo
    from outcome left join supply_match using (demand_id) left join search_supply using (demand_id)""")
def non_placement_reason(spark, root) -> DataFrame:
    found = M.placement_reasons(Frames(spark, root), PARAMS, Cuts(spark, scratch(spark, "reasons")))
    return found.select(
        "demand_id", "non_plc_reason", "pricing_special_req",
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("ccvt_supply_lane_match_fo", "total_opsearch_fo")],
    )


@query("""
    select demand_id, status, demand_date, app_version, dr_type, coalesce(base_rate_flag, 0) as base_rate_flag, base_rate1, base_rate2, base_rate3,
      coalesce(total_opsearch_fo, 0)::double as total_opsearch_fo, round(service_charge, 4) as service_charge, base_price
    from fares left join base_rates using (demand_id) left join search_supply using (demand_id)""")
def mart_projection(spark, root) -> DataFrame:
    src = Frames(spark, root)
    from lanemart.plans.supply import search_supply

    parts = [
        pricing.base_rates(src["quotes_hot"], src["quotes_archive"], src["bidding_config"], PARAMS),
        search_supply(src["search_supply"]),
    ]
    names = (
        "demand_id", "status", "demand_date", "app_version", "dr_type", "base_rate_flag", "base_rate1", "base_rate2",
        "base_rate3", "total_opsearch_fo", "service_charge", "base_price",
    )
    spec = {name: M.OUTPUT[name] for name in names}
    wide = enrich(demand_spine(src["demands"], PARAMS), parts, "demand_id")
    return rounded(M.finalize(wide, spec, zero_filled=("total_opsearch_fo", "base_rate_flag")))


MART_SQL = """
    select d.demand_id, d.demand_date, d.app_version, d.dr_type, coalesce(m.dr_flag, 0) as dr_flag, m.first_dr_time, m.demand_cancel_time, d.status,
      pl.plac_type, pl.placement_phase, oc.plc_demand_type, oc.non_plc_reason, sg.segment_config_first, sg.segment_config_latest,
      case when md.demand_id is not null then 'Multiple' else 'Single' end as drop_points, oc.special_req, array_to_string(sp.special_type, ',') as special_type,
      oc.pricing_special_req, case when sp.pricing_special_req = 1 then array_to_string(sp.priced_type, ',') end as pricing_special_type, d.metadata_plt,
      d.from_lat, d.from_long, d.to_lat, d.to_long, d.route_distance, d.shortest_route_distance, d.consigner_user_code, ct.customer_type, ct.customer_flag,
      rs.consigner_payment_status, rs.consigner_payment_status_at_dr, fu.fulfilled_rank,
      case when d.demand_id > hi.consigner_fulfilled_demand_id then 'Repeat Consigner' else 'New Consigner' end as consigner_type, en.experiment_name,
      d.vehicle_type_id, vc.body_type, coalesce(vc.tyre_count, -1)::int as tyre_count, vc.size_in_ft, vc.tonnage, vc.min_size, vc.max_size, vc.min_tonnage, vc.max_tonnage,
      vc.veh_tyre_type, coalesce(vc.vt_pricing_id, -1)::int as vt_pricing_id, coalesce(vc.vt_id, -1)::int as vt_id,
      coalesce(ss.total_opsearch_fo, 0)::double as total_opsearch_fo, coalesce(ss.opsearch_fo_10l_score, 0)::double as opsearch_fo_10l_score,
      coalesce(sm.ccvt_supply_lane_match_fo, 0)::double as ccvt_supply_lane_match_fo, d.fare as consigner_freight_fare, round(d.actual, 4) as actual_consigner_freight_fare,
      d.fare as wfms_consigner_freight_fare, round(d.updated_fare, 4) as updated_consigner_freight_fare, round(d.service_charge, 4) as service_charge,
      round(mg.shipper_discount, 4) as shipper_discount, round(mg.shipper_discount_reversal, 4) as shipper_discount_reversal, round(d.extra_discount, 4) as extra_discount,
      d.supplyfare_before_consignment, c.supplyfare, round(tf.token_forfeit, 4) as token_forfeit, round(c.fo_commission, 4) as fo_commission,
      round(c.fo_commission_reversal, 4) as fo_commission_reversal, d.base_price, round(mg.consigner_pnl, 4) as consigner_pnl, round(mg.fo_pnl, 4) as fo_pnl,
      round(mg.consigner_pnl + mg.fo_pnl, 4) as pnl, c.consignment_date, c.consignment_code, c.operator_code, c.vehicle_id, c.trip_state, c.trip_end_time, c.total_consignments,
      g.origin, g.origin_state, g.origin_cluster, g.destination, g.destination_state, g.destination_cluster, g.origin_id, g.origin_cluster_id, g.destination_id,
      g.destination_cluster_id, g.ncr_flag, g.demand_region, g.destination_zone, coalesce(br.base_rate_flag, 0) as base_rate_flag, br.base_rate1, br.base_rate2, br.base_rate3,
      coalesce(pt.pricing_type, 'NA') as pricing_type, cr.source, cr.odvt_base_rate_id, cr.p1, cr.p2, cr.p3, cr.base_rate_updated_by, cr.odvt_id
    from fares d
    left join milestones m using (demand_id) left join placement pl using (demand_id) left join outcome oc using (demand_id) left join segments sg using (demand_id)
    left join multi_drop md using (demand_id) left join special sp using (demand_id) left join consigner_types ct using (consigner_user_code)
    left join history hi using (consigner_user_code) left join restriction rs using (demand_id) left join fulfilled fu using (demand_id)
    left join experiment_names en using (demand_id) left join vehicle_class vc using (vehicle_type_id) left join search_supply ss using (demand_id)
    left join supply_match sm using (demand_id) left join margin mg using (demand_id) left join consignment_summary c using (demand_id)
    left join token_forfeit tf using (demand_id) left join geography g using (demand_id) left join base_rates br using (demand_id)
    left join pricing_types pt using (demand_id) left join current_rates cr using (demand_id)"""


def _as_sink(mart: DataFrame) -> DataFrame:
    """The whole mart, arrays as text, money to four decimals."""
    return rounded(arrays_to_text(mart))


def _dates(src) -> DataFrame:
    """Ids and dates of the demands, from which a run's bounds come."""
    return src["demands"].select(F.col("id").alias("demand_id"), F.col("created").alias("demand_date"))


@query(MART_SQL)
def mart(spark, root) -> DataFrame:
    """The flagship: a run of the job into a fresh target, of which the rows are returned."""
    src, target = Frames(spark, root), scratch(spark, "mart")
    M.run_mart(src, _dates(src), PARAMS, lambda df, _: write_parquet(_as_sink(df), target, rebalance=False), scratch(spark, "work"))
    return spark.read.parquet(target)


@query(MART_SQL)
def mart_job(spark, root) -> DataFrame:
    """The job twice into one target laid out by id, with the override sheet as a file: replace-since, then the same again."""
    src, target, width = Frames(spark, root), scratch(spark, "target"), 100_000
    src = {**src, "district_overrides": override_sheet(spark, src["district_overrides"])}

    def first(df: DataFrame, start: int) -> None:
        write_bucketed_by_id(_as_sink(df), target, "demand_id", width)

    def again(df: DataFrame, start: int) -> None:
        replace_since_files(spark, target, _as_sink(df), "demand_id", start, width)

    for write in (first, again):
        M.run_mart(src, _dates(src), PARAMS, write, scratch(spark, "work"))
    return spark.read.parquet(target).drop(BUCKET)
