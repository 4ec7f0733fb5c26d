"""The demand spine: one typed row per live demand, and what is derived from its JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.fixed import REMARK_PATTERNS, MartParams
from lanemart.functions import numbers as N
from lanemart.functions.json import json_struct, json_text, non_empty_or, text_to_double
from lanemart.functions.text import any_of, contains_ci, matches_any
from lanemart.functions.time import to_local
from lanemart.sources.bounds import not_deleted, recent, since_id

METADATA_FIELDS = (
    "remarks",
    "remarksCategory",
    "ptl",
    "appVersion",
    "searchMode",
    "estimatedRouteDistance",
    "shortestRouteDistance",
    "predictedRateSource",
    "serviceChargePct",
    "supplyFreightFareBeforeConsignment",
)


def live_demands(demands: DataFrame, params: MartParams) -> DataFrame:
    return since_id(not_deleted(recent(demands, params.start)), "id", params.start_demand)


def demand_spine(demands: DataFrame, params: MartParams, keep_request: bool = False) -> DataFrame:
    """The typed spine; ``keep_request`` adds the special request's document, for :func:`special_requests`."""
    m, sent, due = F.col("__m"), F.col("__from"), F.col("__to")
    parsed = live_demands(demands, params).withColumns(
        {
            "__m": json_struct(F.col("metadata"), METADATA_FIELDS),
            "__from": json_struct(json_text(F.col("from_address_dto"), "geoLoc"), ["x", "y"]),
            "__to": json_struct(json_text(F.col("to_address_dto"), "geoLoc"), ["x", "y"]),
        }
    )

    flat = parsed.select(
        F.col("id").alias("demand_id"),
        to_local(F.col("created"), params.shift).alias("demand_date"),
        to_local(F.col("updated"), params.shift).alias("updated_at"),
        "consigner_user_code",
        "vehicle_type_id",
        "status",
        m["remarks"].alias("metadata_remarks"),
        non_empty_or(m["remarksCategory"], F.col("expiry_remark")).alias("metadata_remarkscategory"),
        F.coalesce(m["ptl"], F.lit("")).alias("metadata_plt"),
        N.version_number(m["appVersion"]).alias("app_version"),
        m["searchMode"].alias("dr_type"),
        text_to_double(sent["x"]).alias("from_lat"),
        text_to_double(sent["y"]).alias("from_long"),
        text_to_double(due["x"]).alias("to_lat"),
        text_to_double(due["y"]).alias("to_long"),
        text_to_double(m["estimatedRouteDistance"], 0).alias("route_distance"),
        text_to_double(m["shortestRouteDistance"], 0).alias("shortest_route_distance"),
        m["predictedRateSource"].alias("predicted_rate_source"),
        "consigner_freight_fare",
        "actual_consigner_freight_fare",
        text_to_double(m["serviceChargePct"], 0).alias("service_charge"),
        text_to_double(m["supplyFreightFareBeforeConsignment"]).alias("supplyfare_before_consignment"),
        "origin_district_key",
        "destination_district_key",
        *([json_text(F.col("metadata"), "specialRequestBody").alias("request_body")] if keep_request else []),
    )
    fare, actual = F.col("consigner_freight_fare"), F.col("actual_consigner_freight_fare")
    return flat.select(
        "*",
        N.base_price(fare, F.col("service_charge")).alias("base_price"),
        N.extra_discount(actual, fare).alias("extra_discount"),
        N.updated_fare(actual, fare).alias("updated_consigner_freight_fare"),
    )


def right_demand(remarks, category, own_remarks, expiry_remark):
    """0 for demands whose remarks say they were never meant to be placed, else 1."""
    patterns = list(REMARK_PATTERNS)
    wrong = any_of(
        [
            contains_ci(remarks, ["just checking price"]),
            contains_ci(own_remarks, ["just checking price", "via point not added"]),
            contains_ci(category, ["type/weight"]),
            contains_ci(expiry_remark, ["type/weight"]),
            matches_any([remarks, category, own_remarks, expiry_remark], patterns),
        ]
    )
    return F.when(wrong, F.lit(0)).otherwise(F.lit(1))


def ptl_flag(spine: DataFrame, comments: DataFrame | None, params: MartParams) -> DataFrame:
    """Optional: also mark demands whose comments hold one of the configured words."""
    if comments is None or not params.ptl_comment_words:
        return spine
    noted = (
        since_id(comments, "demand_id", params.start_demand)
        .filter(contains_ci(F.col("remarks"), params.ptl_comment_words))
        .select("demand_id")
        .distinct()
        .withColumn("__ptl", F.lit("true"))
    )
    out = spine.join(noted, on="demand_id", how="left")
    return out.withColumn("metadata_plt", F.coalesce("__ptl", "metadata_plt")).drop("__ptl")
