"""The mart: spine, one-row-per-key parts, derived columns, fixed output."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.fixed import MartParams
from lanemart.functions import rules as R
from lanemart.functions.time import hour_of, minutes_between
from lanemart.operators.hot import HotKeys, hot_keys, lookup_hot
from lanemart.operators.joins import enrich
from lanemart.plans import consignments as C
from lanemart.plans import consigners as G
from lanemart.plans import geography, pricing, supply, vehicles
from lanemart.plans.spine import demand_spine, ptl_flag
from lanemart.session import give_back, narrow_methods
from lanemart.sinks.lake import Cuts
from lanemart.sources.bounds import run_bounds

#: Cuts the lineage of a frame, or returns it as it is.
Cut = Callable[[DataFrame], DataFrame]



def as_it_is(df: DataFrame) -> DataFrame:
    return df


#: Frames that are cut at a time. The stages of one query often leave cores idle; more at a time would add up their shuffle files.
AT_ONCE = 2


def cut_each(cut: Cut, frames: Sequence[DataFrame]) -> list[DataFrame]:
    """The frames, cut; they do not depend on one another."""
    if cut is as_it_is:
        return list(frames)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(cut, frames))


#: Output columns and types, in order.
OUTPUT = {
    "demand_id": "bigint", "demand_date": "timestamp_ntz", "app_version": "int", "dr_type": "string",
    "dr_flag": "int", "first_dr_time": "timestamp_ntz", "demand_cancel_time": "timestamp_ntz", "status": "string",
    "plac_type": "string", "placement_phase": "string", "plc_demand_type": "string", "non_plc_reason": "string",
    "segment_config_first": "string", "segment_config_latest": "string", "drop_points": "string",
    "special_req": "int", "special_type": "array<string>", "pricing_special_req": "int",
    "pricing_special_type": "array<string>", "metadata_plt": "string", "from_lat": "double", "from_long": "double",
    "to_lat": "double", "to_long": "double", "route_distance": "double", "shortest_route_distance": "double",
    "consigner_user_code": "string", "customer_type": "string", "customer_flag": "string",
    "consigner_payment_status": "string", "consigner_payment_status_at_dr": "string", "fulfilled_rank": "bigint",
    "consigner_type": "string", "experiment_name": "string", "vehicle_type_id": "bigint", "body_type": "string",
    "tyre_count": "int", "size_in_ft": "double", "tonnage": "double", "min_size": "double", "max_size": "double",
    "min_tonnage": "double", "max_tonnage": "double", "veh_tyre_type": "string", "vt_pricing_id": "int",
    "vt_id": "int", "total_opsearch_fo": "double", "opsearch_fo_10l_score": "double",
    "ccvt_supply_lane_match_fo": "double", "consigner_freight_fare": "double",
    "actual_consigner_freight_fare": "double", "wfms_consigner_freight_fare": "double",
    "updated_consigner_freight_fare": "double", "service_charge": "double", "shipper_discount": "double",
    "shipper_discount_reversal": "double", "extra_discount": "double", "supplyfare_before_consignment": "double",
    "supplyfare": "double", "token_forfeit": "double", "fo_commission": "double", "fo_commission_reversal": "double",
    "base_price": "double", "consigner_pnl": "double", "fo_pnl": "double", "pnl": "double",
    "consignment_date": "timestamp_ntz", "consignment_code": "string", "operator_code": "string",
    "vehicle_id": "bigint", "trip_state": "string", "trip_end_time": "timestamp_ntz", "total_consignments": "bigint",
    "origin": "string", "origin_state": "string", "origin_cluster": "string", "destination": "string",
    "destination_state": "string", "destination_cluster": "string", "origin_id": "bigint",
    "origin_cluster_id": "bigint", "destination_id": "bigint", "destination_cluster_id": "bigint",
    "ncr_flag": "string", "demand_region": "string", "destination_zone": "string", "base_rate_flag": "int",
    "base_rate1": "double", "base_rate2": "double", "base_rate3": "double", "pricing_type": "string",
    "source": "string", "odvt_base_rate_id": "bigint", "p1": "double", "p2": "double", "p3": "double",
    "base_rate_updated_by": "string", "odvt_id": "bigint",
}

ZERO_FILLED = ("total_opsearch_fo", "opsearch_fo_10l_score", "ccvt_supply_lane_match_fo")


def finalize(df: DataFrame, spec: Mapping[str, str] = OUTPUT, zero_filled=ZERO_FILLED) -> DataFrame:
    """Fixed columns, order and types, in one projection."""
    def typed(name: str, kind: str):
        value = F.col(name).cast(kind)
        return F.coalesce(value, F.lit(0).cast(kind)) if name in zero_filled else value

    return df.select(*[typed(name, kind).alias(name) for name, kind in spec.items()])


def placed_demands(src: Mapping[str, DataFrame], wide: DataFrame, params: MartParams, hot: HotKeys = {}) -> DataFrame:
    """Narrow rows: per demand its places and its vehicle class, everything looked up by a dimension key."""
    keys = wide.select("demand_id", "origin_district_key", "destination_district_key")
    placed = geography.places(keys, src["districts"], src.get("district_overrides"), params, hot)
    classes = vehicles.vehicle_class(src["vehicle_types"], src["vehicle_bands"], src["vehicle_catalog"])
    classed = lookup_hot(wide.select("demand_id", "vehicle_type_id"), classes, "vehicle_type_id", hot.get("vehicle_type_id", ()))
    classed = classed.withColumns({c: F.coalesce(c, F.lit(-1)).cast("int") for c in ("tyre_count", "vt_pricing_id", "vt_id")})
    return placed.join(classed.drop("vehicle_type_id"), on="demand_id")


def demand_parts(
    src: Mapping[str, DataFrame], wide: DataFrame, params: MartParams, cut: Cut = as_it_is, hot: HotKeys = {}
) -> dict[str, DataFrame]:
    """Frames with one row per demand, by name. ``wide`` is the spine, of which the parts read a few columns.

    Every source is aggregated once; what two parts need goes through ``cut``.
    """
    status = cut(C.status_summary(src["demand_sub_status"], params))
    bidding = cut(pricing.bidding_summary(src["bidding_config"], params))
    tokens = cut(pricing.token_summary(pricing.tokens(src["tokens_hot"], src["tokens_archive"], params)))
    latest = cut(C.consignment_summary(src["consignments"], src["consignment_state"], src["consignment_expense"], params))
    placed = cut(placed_demands(src, wide, params, hot))
    dated = wide.select("demand_id", "vehicle_type_id").join(placed, on="demand_id")
    catalog = pricing.rate_catalog(src["current_rates"], src["rate_lanes"], src["places"], src["vehicle_bands"])
    parts = {
        "places": placed,
        **reason_parts(src, wide, latest, status, placed, params),
        "shipper": C.shipper_discounts(src["trip_expense"], params),
        "experiments": C.named_experiments(bidding.select("demand_id", "exp_ids"), src["experiments"]),
        "segments": C.segments(src["segment_mapping"]),
        "rates": pricing.rates_of(pricing.quotes(src["quotes_hot"], src["quotes_archive"], params), bidding),
        "pricing": pricing.types_of(bidding),
        "placement": pricing.placement_of(latest, pricing.modes_of(tokens)),
        "forfeits": pricing.forfeits_of(tokens),
        "rank": G.fulfilled_rank(src["demands"], params),
        "restriction": G.restriction_asof(wide, status, src["restrictions"], params),
        "current": pricing.demand_rates(dated, catalog),
        "profile": G.profile_of(wide, src["demands"], src["consigners"], params, hot),
    }
    if "cancellations" in src:
        parts["cancels"] = C.operator_cancels(src["cancellations"])
    return parts


def reason_parts(
    src: Mapping[str, DataFrame], wide: DataFrame, latest: DataFrame, status: DataFrame, placed: DataFrame, params: MartParams
) -> dict[str, DataFrame]:
    """The parts that decide why a demand was not placed. ``wide`` and ``placed`` are read more than once."""
    lanes = supply.supply_lanes(
        src["gps_lanes"], src["operators"], src["operator_vehicles"], src["vehicles"], src["vehicle_catalog"],
        src["district_clusters"], src["subscriptions"], asked=placed,
    )
    dated = wide.select("demand_id", "demand_date").join(placed.select("demand_id", *supply.LANE), on="demand_id")
    return {
        "consignments": latest,
        "status": status,
        "drops": C.multi_drop(src["addresses"], params),
        "requests": vehicles.requests_of(wide, src["vehicle_types"], src["vehicle_bands"]),
        "search": supply.search_supply(src["search_supply"]),
        "supply": supply.supply_match(dated, lanes, params),
        "engagement": supply.engagement([src["app_events_1"], src["app_events_2"], src["app_events_3"]], params),
        "delivered": supply.delivered_pct(src["notifications"], params),
    }


def with_outcome(df: DataFrame, params: MartParams) -> DataFrame:
    """Columns derived from the joined row: flags, margin, supply confidence and reasons."""
    c = F.col
    multi = c("drop_points") == "Multiple"
    forced = {
        name: F.when(multi, F.lit(1)).otherwise(F.coalesce(name, F.lit(0)))
        for name in ("special_req", "pricing_special_req")
    }
    cancel = c("demand_cancel_time")
    if params.cancel_only_expired:
        cancel = F.when(c("status") == "EXPIRED", F.coalesce(cancel, c("updated_at")))
    filled = df.withColumns(
        forced
        | {
            "drop_points": F.coalesce("drop_points", F.lit("Single")),
            "demand_cancel_time": cancel,
            "dr_flag": F.coalesce("dr_flag", F.lit(0)),
            "base_rate_flag": F.coalesce("base_rate_flag", F.lit(0)),
            "fulfilled_rank": F.coalesce("fulfilled_rank", F.lit(0)),
            "pricing_type": F.coalesce("pricing_type", F.lit("NA")),
            "consigner_payment_status": F.coalesce("consigner_payment_status", F.lit("UNRESTRICTED")),
            "consigner_payment_status_at_dr": F.coalesce("consigner_payment_status_at_dr", F.lit("UNRESTRICTED")),
            "wfms_consigner_freight_fare": c("consigner_freight_fare"),
        }
    )
    priced = pricing.with_margin(filled)
    cancelled_by = c("placed_cancel_reason") if "placed_cancel_reason" in df.columns else F.lit(None).cast("string")
    return priced.withColumns(
        {
            "plc_demand_type": R.demand_type(
                hour_of(c("demand_date")), c("total_consignments"), cancelled_by, c("dr_book_by"), params.retry_user
            ),
            "non_plc_reason": reason_of(priced),
        }
    )


def wide_spine(src: Mapping[str, DataFrame], params: MartParams) -> DataFrame:
    return ptl_flag(demand_spine(src["demands"], params, keep_request=True), src.get("demand_comments"), params)


#: Parts that a run computes and cuts together. Every query of a run then holds a few parts: adaptive execution plans a
#: query anew after each of its stages, so one query of all parts costs the driver the square of their number.
PART_GROUPS = (
    ("supply",),  # the longest first
    ("restriction",),
    ("rates", "pricing"),
    ("requests", "rank"),
    ("current",),
    ("drops", "shipper"),
    ("engagement", "delivered"),
    ("profile",),
    ("placement", "forfeits"),
    ("experiments", "segments"),
    ("search", "cancels"),
)


#: Columns of the parts that the outcome asks for besides those of the output.
ASKED = frozenset(("updated_at", "dr_book_by", "placed_cancel_reason", "sub_more_than_20l_and_60km", "fo_engage", "noitf_delivered_fo"))


def packed(part: DataFrame, name: str) -> DataFrame:
    """The part's columns that the mart uses, as one column.

    A row that goes through a chain of joins is copied column by column in each of them; a struct is copied as one.
    """
    used = [c for c in part.columns if c != "demand_id" and (c in OUTPUT or c in ASKED)]
    return part.select("demand_id", F.struct(*used).alias(name))


def gathered(ids: DataFrame, parts: Mapping[str, DataFrame], cut: Cut) -> list[DataFrame]:
    """The parts, where frames are cut in as many frames as there are groups and parts that have been cut.

    What is cut here comes packed, and so do the places; the other parts are those that have been cut before.
    """
    if cut is as_it_is:
        return list(parts.values())
    grouped = [[parts[n] for n in group if n in parts] for group in PART_GROUPS]
    rest = [n for n in parts if n != "places" and not any(n in group for group in PART_GROUPS)]
    demands = ids.distinct()
    packs = [packed(enrich(demands, group, "demand_id"), f"__pack_{i}") for i, group in enumerate(grouped) if group]
    return [packed(parts["places"], "__pack_places"), *cut_each(cut, packs), *[parts[n] for n in rest]]


def unpacked(df: DataFrame) -> DataFrame:
    """The columns of the packs beside the others."""
    return df.select(*[f"{c}.*" if c.startswith("__pack_") else c for c in df.columns])


DISTRICT_KEYS = ("origin_district_key", "destination_district_key")
#: Keys by which demands meet dimensions.
LOOKUP_KEYS = ("consigner_user_code", "vehicle_type_id", *DISTRICT_KEYS)


def build_mart(src: Mapping[str, DataFrame], params: MartParams, cut: Cut = as_it_is, measure: bool = False) -> DataFrame:
    """One typed row per live demand.

    Only narrow rows travel by other keys than the demand id: the parts are joined to the bare ids, where
    they share one partitioning, and the wide spine moves there once, for the last join. ``cut`` is applied
    to the spine, to what several parts read and to groups of parts; pass :class:`lanemart.sinks.lake.Cuts`. With ``measure`` the keys
    that hold a large share of the demands are found in one pass over the spine, and looked up by broadcasts.
    """
    wide = cut(wide_spine(src, params))
    hot = hot_keys(wide, LOOKUP_KEYS) if measure else {}
    ids = wide.select("demand_id")
    parts = enrich(ids, gathered(ids, demand_parts(src, wide, params, cut, hot), cut), "demand_id")
    joined = unpacked(wide.drop("request_body", *DISTRICT_KEYS).join(parts.drop(*DISTRICT_KEYS), on="demand_id", how="left"))
    return finalize(with_outcome(geography.with_regions(joined, params), params))


def placement_reasons(src: Mapping[str, DataFrame], params: MartParams, cut: Cut = as_it_is) -> DataFrame:
    """Why each demand was not placed, from the parts that the rules ask for.

    ``cut`` is applied to the spine and to the places of demands, which several parts read; what it writes has to stay
    until the result has been read.
    """
    narrow = ("demand_date", "vehicle_type_id", "origin_district_key", "destination_district_key", "request_body")
    wide = cut(wide_spine(src, params).select("demand_id", *narrow))
    placed = cut(placed_demands(src, wide, params).select("demand_id", *supply.LANE))
    # Of the consignments only their number is asked for.
    latest = C.latest_consignments(src["consignments"], params).select("demand_id", "total_consignments")
    parts = reason_parts(src, wide, latest, C.status_summary(src["demand_sub_status"], params), placed, params)
    joined = enrich(wide.select("demand_id"), list(parts.values()), "demand_id")
    multi = F.col("drop_points") == "Multiple"
    asked = F.when(multi, F.lit(1)).otherwise(F.coalesce("pricing_special_req", F.lit(0)))
    match, search = "ccvt_supply_lane_match_fo", "total_opsearch_fo"
    filled = joined.withColumn("pricing_special_req", asked)
    return filled.select("demand_id", reason_of(filled).alias("non_plc_reason"), "pricing_special_req", match, search)


def reason_of(df: DataFrame):
    c = F.col
    return R.non_placement_reason(
        c("total_consignments"),
        R.supply_confidence(c("ccvt_supply_lane_match_fo"), c("total_opsearch_fo")),
        c("sub_more_than_20l_and_60km"),
        hour_of(c("first_dr_time")),
        minutes_between(c("first_dr_time"), c("demand_cancel_time")),
        c("fo_engage"),
        c("noitf_delivered_fo"),
        c("pricing_special_req"),
    )


def start_of(demand_dates: DataFrame, params: MartParams) -> MartParams:
    """The parameters of a run: demands from the smallest id on that was made since the start date."""
    bounds = run_bounds(demand_dates, "demand_id", "demand_date", params.start).first()
    return replace(params, start_demand=bounds["min_demand_id"] or 0)


def run_mart(
    src: Mapping[str, DataFrame], demand_dates: DataFrame, params: MartParams, write: Callable[[DataFrame, int], None], folder: str
) -> None:
    """A whole run: bounds, mart, write. ``write`` gets the mart and the first id it replaces.

    ``folder`` is one that all executors reach; what the run keeps there is removed when it ends.
    """
    spark, params = demand_dates.sparkSession, start_of(demand_dates, params)
    with narrow_methods(spark), Cuts(spark, folder, key="demand_id") as cuts:

        def cut(df: DataFrame) -> DataFrame:
            out = cuts(df)
            give_back(spark)
            return out

        write(build_mart(src, params, cut, measure=True), params.start_demand)
    give_back(spark)
