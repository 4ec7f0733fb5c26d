"""Stages on fixture frames, and the mart's invariants on the stand-in sources."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lanemart.fixed import MartParams
from lanemart.plans import consignments as C
from lanemart.operators.joins import duplicate_keys
from lanemart.plans import consigners, geography, pricing, spine, supply, vehicles
from lanemart.plans.geography import with_regions
from lanemart.plans.mart import OUTPUT, build_mart, demand_parts, placement_reasons, wide_spine
from lanemart.queries import QUERIES, domain  # noqa: F401
from lanemart.queries.helpers import Frames
from lanemart.sinks.lake import Cuts
from lanemart.sources.bounds import not_deleted, recent
from lanemart.standin import PARAMS

P = MartParams(start=dt.date(2024, 1, 1), as_of=dt.date(2024, 2, 8))


def at(month: int, day: int = 1) -> dt.datetime:
    return dt.datetime(2024, month, day)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def dated(df, *without):
    """With partition columns of a day within the run, as the sources have."""
    return df.withColumns({c: F.lit(n) for c, n in (("dpyear", 2024), ("dpmonth", 2), ("dpday", 20)) if c not in without})


def tokens(spark):
    hot = [
        (1, "o1", "SUCCESS", '{"triggerSource": "APP", "biddingType": "M"}', at(2, 1)),
        (1, "o1", "SUCCESS", '{"triggerSource": "BOOKING_AUTOMATION", "biddingType": "B"}', at(2, 2)),
        (2, "o1", "REFUNDED", '{"triggerSource": "TESSERACT_SERVICE", "biddingType": "XBY"}', at(2, 2)),
        (5, "o1", "FORFEITED", '{"amountInPaisa": "250"}', at(2, 3)),
        (5, "o2", "FORFEITED", '{"amountInPaisa": "250"}', at(2, 3)),
        (6, "o2", "SUCCESS", "{}", at(1, 1)),
    ]
    cold = [(5, "o3", "FORFEITED", None, None, 150, at(1, 31)), (6, "o3", "FORFEITED", None, None, 1, at(2, 1)), (6, "o3", "FORFEITED", None, None, 1, dt.datetime(2023, 12, 31))]
    h = spark.createDataFrame(hot, "demand_id long, operator_code string, status string, metadata string, created timestamp_ntz").withColumn("deleted", F.lit("false"))
    c = spark.createDataFrame(cold, "demand_id long, operator_code string, status string, trigger_source string, bidding_type string, amount_in_paisa long, created timestamp_ntz").withColumn("deleted", F.lit("false"))
    return pricing.tokens(dated(h), c, P)


def test_placement_and_forfeit(spark):
    latest = spark.createDataFrame([(1, "o1", 1), (2, "o1", 2), (3, "o9", 1), (4, "o1", 0)], "demand_id long, operator_code string, total_consignments long")
    got = pricing.placement(latest, tokens(spark))
    assert rows(got, "demand_id") == [(1, "Manual", "Matching"), (2, "Automation", "Bidding"), (3, "Manual", "Matching")]
    # two operators forfeiting the same amount both count; the archive only from the start date to the cutoff
    assert rows(pricing.token_forfeit(tokens(spark)), "demand_id") == [(5, 6.5)]


def test_base_rates(spark):
    q = "demand_id long, operator_code string, calling_details string, app_response_details string, created timestamp_ntz"
    hot = spark.createDataFrame(
        [
            (1, "rate_card_1", '{"quote": 1000}', '{"quote": 5}', at(2, 1)), (1, "rate_card_1", '{"quote": 0}', '{"quote": 1001}', at(2, 1)),
            (1, "rate_card_2", "{}", '{"quote": -5}', at(2, 1)), (1, "other", '{"quote": 9}', "{}", at(2, 1)), (1, "rate_card_3", '{"quote": 9}', "{}", at(1, 31)),
        ],
        q,
    ).withColumn("deleted", F.lit("false"))
    cold = spark.createDataFrame([(1, "rate_card_3", 200.0, at(1, 31)), (2, "rate_card_1", 100.5, at(1, 5)), (2, "rate_card_2", None, at(1, 5))], "demand_id long, operator_code string, quote double, created timestamp_ntz")
    config = spark.createDataFrame([(1, '{"value": "10"}'), (1, '{"value": "5"}'), (2, '{"value": ""}')], "demand_id long, internal_commission string")
    config = config.withColumns({"deleted": F.lit("false"), "base_rate_source": F.lit(None).cast("string"), "experiment_ids": F.lit("")})
    got = pricing.base_rates(dated(hot), cold, dated(config), P)
    assert rows(got, "demand_id") == [(1, 1, 1200.0, None, 300.0), (2, 1, 100.0, None, None)]


def test_special_requests(spark):
    demands = spark.createDataFrame(
        [
            (1, 1, '{"specialRequestBody": {"overHeight": 0.5, "dieselVehicle": true}}'), (2, 1, '{"specialRequestBody": "{\\"openDala\\": true}"}'),
            (3, 1, '{"specialRequestBody": {}}'), (4, 1, "{}"), (5, 2, '{"specialRequestBody": {"overWeight": "true"}}'), (6, 1, '{"specialRequestBody": {"overHeight": "0"}}'),
            (7, 1, None),
        ],
        "id long, vehicle_type_id long, metadata string",
    ).withColumn("deleted", F.lit("false"))
    types = spark.createDataFrame([(1, "OPEN", 4, 6.0, 1.0, 9.0), (2, "open", 4, 6.0, 1.0, 1.0)], "id long, body_type string, tyre_count int, size_in_ft double, tonnage double, vehicle_height double").withColumn("deleted", F.lit("false"))
    bands = spark.createDataFrame([(1, "Open", 4, 1.0, 7.0, 0.0, 2.0, 5.0, "PRICING", "false"), (2, "Open", 4, 1.0, 7.0, 0.0, 2.0, 99.0, "OTHER", "false")], "id long, body_type string, tyre int, min_length double, max_length double, min_weight double, max_weight double, max_height double, flow string, deleted string")
    got = vehicles.special_requests(dated(demands), types, bands, P)
    assert rows(got, "demand_id") == [
        (1, 1, ["OVER_HEIGHT", "DIESEL_VEHICLE"], 1, ["OVER_HEIGHT", "DIESEL_VEHICLE"]), (2, 1, ["OPEN_DALA"], 1, ["OVER_HEIGHT", "OPEN_DALA"]), (5, 1, ["OVER_WEIGHT"], 0, None),
    ]


def test_consignments_edges(spark):
    schema = "id long, code string, demand_id long, expense_data string, created timestamp_ntz, updated timestamp_ntz, operator_code string, vehicle_id long, state string, deleted string"
    data = [
        (1, "X-1", 1, '{"supplyFare": ""}', at(1), at(1), None, 1, "A", "false"), (2, "X-1", 1, '{"supplyFare": "7.5"}', at(1), at(1), "o", 1, "B", "false"),
        (3, "X-3", 2, "{}", at(1), at(1), "o", 1, "C", "true"), (4, "X", 3, '{"supplyFare": ""}', at(1), at(1), None, 1, "D", "false"),
    ]
    consignments = dated(spark.createDataFrame(data, schema))
    got = C.latest_consignments(consignments, P).select("demand_id", "consignment_id", "supplyfare", "total_consignments")
    assert rows(got, "demand_id") == [(1, 2, 7.5, 1), (3, 4, 0.0, 0)]
    ledger = [(1, "TRIP DISCOUNT", 5.0, "CREDIT"), (1, "WE DISCOUNT - REVERSAL", 2.0, "DEBIT"), (1, "x", 9.0, "DEBIT"), (8, "TRIP DISCOUNT", 1.0, "CREDIT")]
    expenses = spark.createDataFrame(ledger, "consignment_id long, type string, amount double, category string")
    expenses = dated(expenses.withColumns({"party_type": F.lit("OPERATOR"), "deleted": F.lit("false")}))
    # two consignments carry number 1: the sums stay single
    assert rows(C.operator_commission(expenses, consignments, P), "consignment_id") == [(1, 5.0, 2.0)]


def test_engagement_and_remarks(spark):
    schema = "operator_code string, entity string, screen_name string, event_name string, target_product string, event_action string"
    load = ("web_load_confirmation", "v1_load_confirmation", "marketplace")
    first = spark.createDataFrame([("o1", '{"demandId": "1"}', *load, "view"), ("o2", '{"demandId": "1"}', *load, "tap"), (None, '{"demandId": "1"}', *load, "view"), ("o3", '{"demandId": "1x"}', *load, "view")], schema)
    second = spark.createDataFrame([("o1", '{"demandId": "1"}', *load, None), ("o4", '{"demandId": "1"}', *load, None), ("o4", '{"demandId": "1"}', "s", "e", "marketplace", None)], schema)
    assert rows(supply.engagement([first, second, second], P), "demand_id") == [(1, 2)]
    c = [F.col(x) for x in "abcd"]
    remarks = spark.createDataFrame([("Just checking price!", None, None, None), (None, "RFQ ", None, None), (None, None, "via point not added", None), (None, None, None, "x type/weight y"), ("hi", None, None, None)], "a string, b string, c string, d string")
    assert [r[0] for r in remarks.coalesce(1).select(spine.right_demand(*c)).collect()] == [0, 0, 0, 0, 1]


def test_zones(spark):
    df = spark.createDataFrame([("NUH_HARYANA", None, "GOA", at(1)), (None, None, "ATLANTIS", at(1))], "origin string, destination string, destination_state string, demand_date timestamp_ntz")
    got = with_regions(df, P).select("destination_zone", "ncr_flag")
    assert sorted(map(tuple, got.collect()), key=str) == [("WEST", "NCR"), (None, "Non_NCR")]


def test_pricing_limits_count_any_matching_band(spark):
    types = spark.createDataFrame([(1, "OPEN", 4, 6.0, 1.0, 3.0)], "id long, body_type string, tyre_count int, size_in_ft double, tonnage double, vehicle_height double").withColumn("deleted", F.lit("false"))
    rows_ = [(1, "Open", 4, 1.0, 7.0, 0.0, 2.0, 2.0, "PRICING", "false"), (2, "Open", 4, 5.0, 9.0, 0.0, 2.0, 9.0, "PRICING", "false")]
    bands = spark.createDataFrame(rows_, "id long, body_type string, tyre int, min_length double, max_length double, min_weight double, max_weight double, max_height double, flow string, deleted string")
    assert rows(vehicles.pricing_limits(types, bands), "vehicle_type_id") == [(1, True, False)]


def test_repeated_codes_and_sheet_rows_are_one_row_each(spark):
    codes = spark.createDataFrame([("a", "T2", "x", "false"), ("a", "T1", "testing", "false"), ("b", "T", "y", "true")], "code string, type string, name string, deleted string")
    assert rows(consigners.consigner_types(codes, P), "consigner_user_code") == [("a", "T1", "Testing")]
    sheet = spark.createDataFrame([(1, "D2", "D9"), (1, "D1", "D3"), (2, None, "D1")], "demand_id long, from_key string, to_key string")
    assert rows(geography.overrides_once(sheet), "demand_id") == [(1, "D1", "D3"), (2, None, "D1")]


def test_filters_do_not_vanish(spark):
    df = spark.createDataFrame([(1, 2010, 1)], "id long, dpyear int, dpmonth int")
    with pytest.raises(ValueError, match="dpday"):
        recent(df, P.start)
    with pytest.raises(ValueError, match="deleted"):
        not_deleted(df)
    assert recent(df, P.start, ["dpyear"]).count() == 0


def test_every_rung_is_reached(spark):
    src = Frames(spark, "/root/testdata/sf0.01")
    reasons = {r[0] for r in placement_reasons(src, PARAMS).select("non_plc_reason").distinct().collect()}
    assert len(reasons) == 9, reasons
    kinds = {r["plc_demand_type"] for r in QUERIES["demand_type"](spark, "/root/testdata/sf0.01").select("plc_demand_type").distinct().collect()}
    assert kinds == {"NIGHT_DEMAND", "FO_BACKOUT_DEMAND", "MULTIPLE_CONSIGNMENTS", "NORMAL_DEMAND"}


def test_every_part_has_one_row_per_demand(spark, root):
    src = Frames(spark, root)
    for name, part in demand_parts(src, wide_spine(src, PARAMS), PARAMS).items():
        assert duplicate_keys(part, "demand_id").count() == 0, name


@pytest.fixture(scope="module")
def mart(spark, root):
    return build_mart(Frames(spark, root), PARAMS).cache()


def test_mart_grain_and_columns(mart, spark, root):
    live = spark.read.parquet(f"{root}/orders.parquet").filter("o_orderkey % 97 <> 96").count()
    assert mart.columns == list(OUTPUT) and len(OUTPUT) == 98
    assert dict(mart.dtypes) == OUTPUT
    assert mart.count() == mart.select("demand_id").distinct().count() == live


def test_mart_domains(mart):
    domains = {
        "dr_flag": {0, 1}, "base_rate_flag": {0, 1}, "special_req": {0, 1}, "pricing_special_req": {0, 1},
        "status": {"FULFILLED", "PENDING", "EXPIRED"}, "plac_type": {"Manual", "Automation", None},
        "drop_points": {"Single", "Multiple"}, "customer_flag": {"WE_Customer", "Testing", None},
        "consigner_payment_status": {"RESTRICTED", "UNRESTRICTED"}, "consigner_payment_status_at_dr": {"RESTRICTED", "UNRESTRICTED"},
        "consigner_type": {"Repeat Consigner", "New Consigner"}, "ncr_flag": {"NCR", "Non_NCR"},
        "demand_region": {"NCR", "ROI", "ROI:2", "ROI:3", "OTHERS"},
    }
    for name, allowed in domains.items():
        assert {r[0] for r in mart.select(name).distinct().collect()} <= allowed, name
    off = mart.filter(F.abs(F.col("pnl") - F.col("consigner_pnl") - F.col("fo_pnl")) > 1e-6)
    assert off.count() == 0 and mart.filter("pnl is null").count() == 0


def test_mart_with_lineage_cut_and_expired_rule(mart, spark, root, tmp_path):
    with Cuts(spark, str(tmp_path)) as cut:
        _compare(mart, build_mart(Frames(spark, root), replace(PARAMS, cancel_only_expired=True), cut=cut))


def _compare(mart, expired):
    same = [c for c in OUTPUT if c not in ("demand_cancel_time", "non_plc_reason")]
    assert expired.select(same).exceptAll(mart.select(same)).count() == 0
    assert expired.filter("status <> 'EXPIRED' and demand_cancel_time is not null").count() == 0
    assert expired.filter("status = 'EXPIRED' and demand_cancel_time is null").count() == 0
