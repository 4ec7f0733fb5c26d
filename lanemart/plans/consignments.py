"""Consignments, ledgers, status milestones, experiments and segments: one row per demand each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.fixed import OPERATOR_LEDGER_TYPES, SHIPPER_LEDGER_TYPES, MartParams
from lanemart.functions.json import json_double
from lanemart.functions.text import code_number
from lanemart.functions.time import to_local
from lanemart.operators import aggregates as A
from lanemart.operators.arrays import list_names
from lanemart.operators.joins import enrich
from lanemart.operators.windows import first_latest, latest_per_key
from lanemart.sources.bounds import not_deleted, recent


def supply_fare(expense_data):
    """Fare text of the expense document; an empty text means 0, a missing one stays unknown."""
    text = F.get_json_object(expense_data, "$.supplyFare")
    return F.when(text == "", F.lit(0.0)).otherwise(json_double(expense_data, "supplyFare"))


#: What is known of the latest consignment, by the column of the source that it comes from.
LATEST = {
    "consignment_code": "consignment_code", "supplyfare": "expense_data", "consignment_date": "consignment_date",
    "operator_code": "operator_code", "vehicle_id": "vehicle_id", "trip_state": "trip_state",
}


def latest_consignments(consignments: DataFrame, params: MartParams, only: Sequence[str] = tuple(LATEST)) -> DataFrame:
    """Newest live consignment per demand and the number of live ones with an operator.

    The fields of ``only`` travel to the pick of the newest row; an unused field is not left out by Spark itself.
    """
    live = not_deleted(recent(consignments, params.start)).select(
        "demand_id",
        "id",
        "updated",
        F.col("code").alias("consignment_code"),
        "expense_data",
        to_local(F.col("created"), params.shift).alias("consignment_date"),
        "operator_code",
        "vehicle_id",
        F.col("state").alias("trip_state"),
        *[c for c in params.consignment_tie if c not in ("id", "vehicle_id", "operator_code")],
    )
    newest = latest_per_key(
        live,
        "demand_id",
        order=["updated", *params.consignment_tie],
        columns=["id", *[LATEST[name] for name in only]],
        extra=[F.count("operator_code").alias("total_consignments")],
    )
    fields = [supply_fare(F.col("expense_data")).alias(n) if n == "supplyfare" else F.col(n) for n in only]
    return newest.select("demand_id", F.col("id").alias("consignment_id"), *fields, "total_consignments")


def trip_ends(states: DataFrame, params: MartParams) -> DataFrame:
    ended = not_deleted(recent(states, params.start, ["dpyear"])).filter(F.col("state") == "TRIP_END")
    return ended.groupBy("consignment_code").agg(F.max(to_local(F.col("created"), params.shift)).alias("trip_end_time"))


def multi_drop(addresses: DataFrame, params: MartParams) -> DataFrame:
    """Demands with more than two address rows."""
    several = A.having_count(recent(addresses, params.start), "demand_id", more_than=2)
    return several.withColumn("drop_points", F.lit("Multiple"))


def operator_commission(expenses: DataFrame, consignments: DataFrame, params: MartParams) -> DataFrame:
    """Commission and its reversal per consignment, for ids that occur in a consignment code.

    Sums are taken before the ids are checked, and the check is a semi join, so two consignments with one
    number do not multiply an amount.
    """
    lines = not_deleted(recent(expenses, params.start)).filter(
        (F.col("party_type") == "OPERATOR") & F.col("type").isin(list(OPERATOR_LEDGER_TYPES))
    )
    sums = A.credit_debit(lines, "consignment_id", OPERATOR_LEDGER_TYPES, "fo_commission_reversal", "fo_commission")
    coded = recent(consignments, params.start).select(code_number(F.col("code")).alias("consignment_id"))
    return sums.join(coded, on="consignment_id", how="left_semi")


def shipper_discounts(trip_expenses: DataFrame, params: MartParams) -> DataFrame:
    lines = not_deleted(recent(trip_expenses, params.start)).filter(F.col("party_type") == "CONSIGNER")
    return A.credit_debit(lines, "demand_id", SHIPPER_LEDGER_TYPES, "shipper_discount", "shipper_discount_reversal")


def consignment_summary(
    consignments: DataFrame, states: DataFrame, expenses: DataFrame, params: MartParams
) -> DataFrame:
    """Latest consignment with its trip end and commission."""
    newest = latest_consignments(consignments, params)
    with_end = enrich(newest, [trip_ends(states, params)], "consignment_code")
    return enrich(with_end, [operator_commission(expenses, consignments, params)], "consignment_id").drop("consignment_id")


def consignment_costs(consignments: DataFrame, expenses: DataFrame, params: MartParams) -> DataFrame:
    """Supply fare and commission of the latest consignment: what the margin asks for."""
    newest = latest_consignments(consignments, params, only=["supplyfare"]).select("demand_id", "consignment_id", "supplyfare")
    return enrich(newest, [operator_commission(expenses, consignments, params)], "consignment_id").drop("consignment_id")


def status_summary(sub_status: DataFrame, params: MartParams) -> DataFrame:
    """Milestones and who made the last booking of each demand, from one pass over the status changes."""
    at, booked = F.col("__at"), F.col("sub_status") == "DR_BOOK"
    reached = F.col("sub_status").isin("DR", "DR_BOOK")
    seen = recent(sub_status, params.start).filter(F.col("sub_status").isin("DR", "DR_BOOK", "CANCELLED"))
    return (
        seen.select("demand_id", "sub_status", "id", "created_by", to_local(F.col("created"), params.shift).alias("__at"))
        .groupBy("demand_id")
        .agg(
            A.max_flag(reached).alias("dr_flag"),
            A.min_if(reached, at).alias("first_dr_time"),
            A.max_if(booked, at).alias("last_dr_time"),
            A.min_if(F.col("sub_status") == "CANCELLED", at).alias("demand_cancel_time"),
            F.max_by("created_by", F.when(booked, F.col("id"))).alias("dr_book_by"),
        )
    )


def status_milestones(sub_status: DataFrame, params: MartParams) -> DataFrame:
    return status_summary(sub_status, params).drop("dr_book_by")


def booked_by(sub_status: DataFrame, params: MartParams) -> DataFrame:
    """Who made the last booking of each demand that has one."""
    return status_summary(sub_status, params).filter(F.col("last_dr_time").isNotNull()).select("demand_id", "dr_book_by")


def operator_cancels(cancellations: DataFrame) -> DataFrame:
    backed_out = cancellations.filter(F.col("placed_cancel_reason") == "Operator")
    return A.dedupe(backed_out, ["demand_id", "placed_cancel_reason"])


def experiment_names(bidding_config: DataFrame, experiments: DataFrame, params: MartParams) -> DataFrame:
    """Joined experiment names per demand; a demand configured twice uses its greatest id list."""
    listed = recent(bidding_config, params.start).filter(F.col("experiment_ids") != "")
    return named_experiments(listed.groupBy("demand_id").agg(F.max("experiment_ids").alias("exp_ids")), experiments)


def named_experiments(listed: DataFrame, experiments: DataFrame) -> DataFrame:
    """Names of the id lists ``exp_ids``, worked out once per distinct list."""
    listed = listed.filter(F.col("exp_ids").isNotNull())
    names = list_names(listed.select("exp_ids"), "exp_ids", not_deleted(experiments), "id", "name", "experiment_name")
    return listed.join(names, on="exp_ids", how="left").select("demand_id", "experiment_name")


def segments(mapping: DataFrame) -> DataFrame:
    return first_latest(
        mapping, "demand_id", "segment_config", "created_at", "segment_config_first", "segment_config_latest"
    )
