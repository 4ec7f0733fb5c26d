"""Adapter: source frames of the mart, derived from the driver's star-schema tables.

Orders play demands, order lines play consignments, ledgers, quotes and tokens, events play status changes
and app events. ``lanemart/queries/ctes.py`` states the same definitions in SQL for the oracle.
"""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanemart.fixed import MartParams, RegionSets
from lanemart.functions.time import epoch_seconds
from lanemart.sources.readers import Sources

BODIES = ("container", "open", "trailer", "large", "medium", "small")
TYRES = (4, 6, 10, 12, 14, 18)
LENGTHS = ((1, 7), (8, 9), (10, 26), (27, 40), (41, 50), (20, 30))  # the last overlaps two others
ZONES = {"SOUTH": ["AFRICA"], "WEST": ["AMERICA"], "EAST": ["ASIA"], "NORTH": ["EUROPE"]}
REGION_NAMES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def district_name(n: int) -> str:
    return f"NATION_{n}_{REGION_NAMES[n % 5]}"


PARAMS = MartParams(
    start=dt.date(1995, 1, 1),
    as_of=dt.date(1998, 1, 8),
    test_names=("99",),
    zones=ZONES,
    regions=RegionSets(
        ncr=tuple(district_name(n) for n in range(4)),
        base=tuple(district_name(n) for n in range(10)),
        third_origins=tuple(district_name(n) for n in (10, 11)),
        second_from=dt.date(1998, 1, 1),
        third_from=dt.date(1999, 1, 1),
    ),
    retry_user="retry",
    consignment_tie=("id", "vehicle_id", "tie_operator", "tie_quantity"),
    time_bucket=30 * 86_400,  # a few thousand demands per bucket at the largest test scale
)
EDGE = "1998-01-01"  # PARAMS.as_of minus the hot days


def _days(n: Column) -> Column:
    return F.make_dt_interval(days=n.cast("int"))


def _partitions(at: str, old: Column | None = None) -> list[Column]:
    """Partition columns of a time; ``old`` rows lie in a year before the start of the run."""
    year = F.year(at) if old is None else F.when(old, 1994).otherwise(F.year(at))
    return [year.alias("dpyear"), F.month(at).alias("dpmonth"), F.dayofmonth(at).alias("dpday")]


def event_demand() -> Column:
    """Demand of an event: half of them on 500 demands, some on 5000, some on 32 that are never placed."""
    k = F.col("event_id")
    return F.when(k % 4 == 0, k % 5000).when(k % 4 == 3, F.floor(k / 4) % 32 * 8 + 3).otherwise(k % 500)


def old_event() -> Column:
    return F.col("event_id") % 97 == 0


class StandIn:
    """Builds each source frame on demand from the tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.src = Sources(spark, parquet_root=root)

    def t(self, name: str, *columns: str) -> DataFrame:
        return self.src.table(name, columns or None)

    # --- demand and status ---

    def demands(self) -> DataFrame:
        o = self.t("orders")
        lines = self.t("lineitem", "l_orderkey", "l_partkey", "l_suppkey").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("vehicle_type_id"), F.min("l_suppkey").alias("s_suppkey")
        )
        to = lines.join(self.t("supplier", "s_suppkey", "s_nationkey"), on="s_suppkey", how="left")
        consigner = self.t("customer", "c_custkey", "c_nationkey")
        j = o.join(to, o.o_orderkey == to.l_orderkey, "left").join(consigner, o.o_custkey == consigner.c_custkey, "left")
        k, fare = F.col("o_orderkey"), F.col("o_totalprice")

        def on(residue: int, value: Column) -> Column:
            return F.when(k % 11 == residue, value)

        body = F.struct(
            on(0, F.lit(5.5)).alias("a0"), on(7, F.lit(0.5)).alias("a7"),
        )
        body = F.struct(
            F.coalesce(body["a0"], body["a7"]).alias("overHeight"),
            on(1, F.lit(True)).alias("overWeight"),
            on(2, F.lit(24)).alias("expressDeliveryTat"),
            F.coalesce(on(3, F.lit(True)), on(7, F.lit(True))).alias("openDala"),
            on(4, F.lit(True)).alias("extraWidth"),
            on(5, F.lit("true")).alias("extraPerson"),
            on(6, F.lit(True)).alias("dieselVehicle"),
        )
        fields = [
            F.when(k % 3 == 0, "").when(k % 3 == 1, "0.05").otherwise("0.1").alias("serviceChargePct"),
            F.concat(F.lit("v3."), (k % 10).cast("string"), F.lit("."), (k % 4).cast("string")).alias("appVersion"),
            F.col("o_orderpriority").alias("searchMode"),
            F.when(k % 13 == 0, "true").when(k % 13 == 1, F.lit(None)).otherwise("false").alias("ptl"),
            F.when(k % 4 == 0, "").otherwise((k % 1000 + F.lit(0.5)).cast("string")).alias("estimatedRouteDistance"),
            (k % 500).alias("shortestRouteDistance"),
            F.when(k % 6 != 0, (k % 90_000).cast("string")).otherwise("").alias("supplyFreightFareBeforeConsignment"),
            F.when(k % 2 == 0, "").otherwise("rfq").alias("remarksCategory"),
            F.when(k % 5 == 0, "Just checking price ").when(k % 5 == 1, "call later").alias("remarks"),
            F.lit("MODEL").alias("predictedRateSource"),
        ]
        # Even keys nest an object, odd keys nest its text.
        metadata = F.when(k % 2 == 0, F.to_json(F.struct(*fields, body.alias("specialRequestBody")))).otherwise(
            F.to_json(F.struct(*fields, F.to_json(body).alias("specialRequestBody")))
        )

        def point(x: Column, y: Column) -> Column:
            return F.to_json(F.struct(F.struct(x.alias("x"), y.alias("y")).alias("geoLoc")))

        return j.select(
            k.alias("id"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=(k * 5 % 24).cast("int"))).alias("created"),
            (F.col("o_orderdate") + _days(k % 5)).alias("updated"),
            F.when(k % 29 != 5, F.col("o_custkey").cast("string")).alias("consigner_user_code"),
            "vehicle_type_id",
            F.when(F.col("o_orderstatus") == "F", "FULFILLED").when(F.col("o_orderstatus") == "O", "PENDING").otherwise("EXPIRED").alias("status"),
            fare.alias("consigner_freight_fare"),
            F.when(k % 7 == 0, F.lit(None)).when(k % 3 == 0, fare + 500).when(k % 5 == 0, fare - 500).otherwise(fare).alias("actual_consigner_freight_fare"),
            F.concat(F.lit("D"), F.col("c_nationkey").cast("string")).alias("origin_district_key"),
            F.concat(F.lit("D"), F.col("s_nationkey").cast("string")).alias("destination_district_key"),
            metadata.alias("metadata"),
            F.when(k % 4 == 1, "via point not added").alias("remarks"),
            F.when(k % 9 == 0, "demand_expiry").alias("expiry_remark"),
            point((k % 180) / F.lit(2.0), (k % 90) / F.lit(4.0)).alias("from_address_dto"),
            point((k % 120) / F.lit(2.0), (k % 60) / F.lit(4.0)).alias("to_address_dto"),
            F.when(k % 97 == 96, "true").otherwise("false").alias("deleted"),
            *_partitions("o_orderdate"),
        )

    def demand_sub_status(self) -> DataFrame:
        kind = F.col("event_type")
        return self.t("events", "event_id", "event_type", "ts", "user_id").select(
            F.col("event_id").alias("id"),
            event_demand().alias("demand_id"),
            F.when(kind == "signup", "DR").when(kind == "click", "DR_BOOK").when(kind == "error", "CANCELLED").otherwise(F.upper(kind)).alias("sub_status"),
            F.col("ts").alias("created"),
            F.when(F.col("user_id") % 3 == 0, "retry").otherwise(F.col("user_id").cast("string")).alias("created_by"),
            *_partitions("ts", old_event()),
        )

    def addresses(self) -> DataFrame:
        lines = self.t("lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
        return lines.select(F.col("l_orderkey").alias("demand_id"), *_partitions("l_shipdate", F.col("l_linenumber") == 7))

    def cancellations(self) -> DataFrame:
        return self.t("lineitem", "l_orderkey", "l_returnflag").select(
            F.col("l_orderkey").alias("demand_id"),
            F.when(F.col("l_returnflag") == "R", "Operator").otherwise("Consigner").alias("placed_cancel_reason"),
        )

    def district_overrides(self) -> DataFrame:
        k = F.col("o_orderkey")
        def row(a: int, b: int) -> Column:
            keys = [F.concat(F.lit("D"), (k % n).cast("string")).alias(c) for n, c in ((a, "from_key"), (b, "to_key"))]
            return F.struct(*keys)

        # Some demands stand in the sheet twice.
        rows = F.when(k % 15 == 2, F.array(row(25, 23), row(7, 5))).otherwise(F.array(row(25, 23)))
        listed = self.t("orders", "o_orderkey", "o_orderstatus").filter(F.col("o_orderstatus") != "P")
        return listed.select(k.alias("demand_id"), F.inline(rows))

    # --- consignments and ledgers ---

    def consignments(self) -> DataFrame:
        number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return self.t("lineitem").select(
            number.alias("id"),
            F.concat(F.lit("XX-"), number.cast("string")).alias("code"),
            F.col("l_orderkey").alias("demand_id"),
            F.when(F.col("l_linenumber") == 3, F.to_json(F.struct(F.lit("").alias("supplyFare"))))
            .otherwise(F.to_json(F.struct(F.col("l_extendedprice").alias("supplyFare")))).alias("expense_data"),
            F.col("l_shipdate").alias("created"),
            F.col("l_shipdate").alias("updated"),
            # One demand in eight never gets an operator.
            F.when((F.col("l_quantity") > 1) & (F.col("l_orderkey") % 8 != 3), F.col("l_suppkey").cast("string")).alias("operator_code"),
            F.col("l_partkey").alias("vehicle_id"),
            F.when(F.col("l_linestatus") == "F", "TRIP_END").otherwise("IN_TRANSIT").alias("state"),
            F.when(F.col("l_quantity") == 50, "true").otherwise("false").alias("deleted"),
            F.col("l_suppkey").alias("tie_operator"),
            F.col("l_quantity").alias("tie_quantity"),
            *_partitions("l_shipdate"),
        )

    def consignment_state(self) -> DataFrame:
        number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return self.t("lineitem", "l_orderkey", "l_linenumber", "l_linestatus", "l_shipdate").select(
            F.concat(F.lit("XX-"), number.cast("string")).alias("consignment_code"),
            F.when(F.col("l_linestatus") == "F", "TRIP_END").otherwise("IN_TRANSIT").alias("state"),
            (F.col("l_shipdate") + F.expr("INTERVAL '3' DAY")).alias("created"),
            F.lit("false").alias("deleted"),
            F.year("l_shipdate").alias("dpyear"),
        )

    def _ledger(self, key: Column, name: str, types: tuple[str, str], party: str, rate: str) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.t("lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice", "l_shipdate", rate).select(
            key.alias(name),
            F.when(flag == "A", types[0]).when(flag == "N", types[1]).otherwise("OTHER").alias("type"),
            F.when(F.col("l_linestatus") == "F", "CREDIT").otherwise("DEBIT").alias("category"),
            (F.col("l_extendedprice") * F.col(rate)).alias("amount"),
            F.lit(party).alias("party_type"),
            F.lit("false").alias("deleted"),
            *_partitions("l_shipdate", F.col("l_linenumber") == 7),
        )

    def consignment_expense(self) -> DataFrame:
        number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        return self._ledger(number, "consignment_id", ("TRIP DISCOUNT", "WE DISCOUNT"), "OPERATOR", "l_discount")

    def trip_expense(self) -> DataFrame:
        types = ("COUPON DISCOUNT", "DISCOUNT COUPON")
        return self._ledger(F.col("l_orderkey"), "demand_id", types, "CONSIGNER", "l_tax")

    # --- dimensions ---

    def consigners(self) -> DataFrame:
        own = F.struct(F.col("c_mktsegment").alias("type"), F.col("c_name").alias("name"))
        other = F.struct(F.lit("ALT").alias("type"), F.lit("Other 99").alias("name"))
        # Some codes occur twice.
        rows = F.when(F.col("c_custkey") % 10 == 3, F.array(own, other)).otherwise(F.array(own))
        return self.t("customer", "c_custkey", "c_name", "c_mktsegment").select(
            F.col("c_custkey").cast("string").alias("code"),
            F.when(F.col("c_custkey") % 50 == 49, "true").otherwise("false").alias("deleted"),
            F.inline(rows),
        )

    @staticmethod
    def _body() -> Column:
        kind = F.col("p_type")
        return F.when(kind == "ECONOMY", "Container").when(kind == "STANDARD", "Open").when(kind == "PROMO", "Trailer").otherwise(kind)

    @staticmethod
    def _tyres() -> Column:
        brand = F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)).cast("int")
        return F.element_at(F.array(*[F.lit(t) for t in TYRES]), (brand % 6 + 1).cast("int"))

    def vehicle_types(self) -> DataFrame:
        return self.t("part").select(
            F.col("p_partkey").alias("id"),
            F.col("p_size").cast("double").alias("size_in_ft"),
            (F.col("p_size") * F.lit(0.5)).alias("tonnage"),
            self._tyres().alias("tyre_count"),
            self._body().alias("body_type"),
            (F.col("p_retailprice") / F.lit(200.0)).alias("vehicle_height"),
            F.lit("false").alias("deleted"),
        )

    def vehicle_bands(self) -> DataFrame:
        """Literal bands: body x tyres x length range."""
        rows = [
            (
                body.upper(), tyre, float(low), float(high), 10.0 if (tyre == 10 and low >= 27) else 0.0,
                20.0 if tyre == 4 else 25.0, 9.0 if n == 5 else 4.7 + 0.05 * n, "PRICING", "false",
            )
            for body in BODIES
            for tyre in TYRES
            for n, (low, high) in enumerate(LENGTHS)
        ]
        names = "id body_type tyre min_length max_length min_weight max_weight max_height flow deleted".split()
        kinds = "bigint string int double double double double double string string".split()
        # An Arrow table becomes a local relation; a list would be read by Python workers in every executor.
        table = pa.table(dict(zip(names, map(list, zip(*[(i, *row) for i, row in enumerate(rows, start=1)])))))
        typed = [F.col(name).cast(kind).alias(name) for name, kind in zip(names, kinds)]
        return self.spark.createDataFrame(table).select(*typed)

    def vehicle_catalog(self) -> DataFrame:
        return self.t("part").groupBy(
            F.lower(self._body()).alias("body_type"), self._tyres().alias("tyre"), F.col("p_size").cast("double").alias("size")
        ).agg(F.min("p_partkey").alias("id"))

    def _nations(self) -> DataFrame:
        n = self.t("nation")
        return n.join(self.t("region"), n.n_regionkey == F.col("r_regionkey"))

    def districts(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self._nations().select(
            F.concat(F.lit("D"), key.cast("string")).alias("key"),
            F.concat("n_name", F.lit("_"), "r_name").alias("name"),
            key.cast("bigint").alias("id"),
            F.col("r_name").alias("state"),
            F.concat(F.lit("CL"), (key % 8).cast("string")).alias("cluster"),
            (key % 8).cast("bigint").alias("cluster_id"),
        )

    def district_clusters(self) -> DataFrame:
        return self.districts().select(F.col("name").alias("district"), "cluster")

    def experiments(self) -> DataFrame:
        return self.t("region").select(
            F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name"), F.lit("false").alias("deleted")
        )

    # --- pricing and placement ---

    def bidding_config(self) -> DataFrame:
        k = F.col("o_orderkey")
        ids = F.concat(F.lit("{"), (k % 4).cast("string"), F.lit(", "), (k % 6).cast("string"), F.lit("}"))
        source = F.element_at(
            F.array(F.lit("DS_PRICING_V1"), F.lit("DS_PRICING_INTRA_V2"), F.lit("HEURISTIC")), (k % 3 + 1).cast("int")
        )
        return self.t("orders", "o_orderkey", "o_orderdate").select(
            k.alias("demand_id"),
            F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "").otherwise(ids).alias("experiment_ids"),
            F.when(k % 6 == 0, '{"value": ""}').otherwise(F.to_json(F.struct((k % 6).alias("value")))).alias("internal_commission"),
            F.when(k % 4 != 0, source).alias("base_rate_source"),
            F.lit("false").alias("deleted"),
            *_partitions("o_orderdate"),
        )

    def _lines_hot(self) -> DataFrame:
        return self.t("lineitem").filter(F.col("l_shipdate") >= F.lit(EDGE).cast("timestamp_ntz"))

    def _lines_cold(self) -> DataFrame:
        return self.t("lineitem").filter(F.col("l_shipdate") < F.lit(EDGE).cast("timestamp_ntz"))

    @staticmethod
    def _card() -> Column:
        card = F.concat(F.lit("rate_card_"), (F.col("l_linenumber") % 3 + 1).cast("string"))
        return F.when(F.col("l_quantity") == 2, "fleet").otherwise(card)

    def quotes_hot(self) -> DataFrame:
        price = F.col("l_extendedprice")
        called = F.when(F.col("l_linenumber") % 2 == 0, price / 10.0).otherwise(F.lit(0.0))
        return self._lines_hot().select(
            F.col("l_orderkey").alias("demand_id"),
            self._card().alias("operator_code"),
            F.to_json(F.struct(called.alias("quote"))).alias("calling_details"),
            F.to_json(F.struct((price / 20.0).alias("quote"))).alias("app_response_details"),
            F.col("l_shipdate").alias("created"),
            F.lit("false").alias("deleted"),
            *_partitions("l_shipdate"),
        )

    def quotes_archive(self) -> DataFrame:
        return self._lines_cold().select(
            F.col("l_orderkey").alias("demand_id"),
            self._card().alias("operator_code"),
            (F.col("l_extendedprice") / 10.0).alias("quote"),
            F.col("l_shipdate").alias("created"),
        )

    @staticmethod
    def _token() -> dict[str, Column]:
        flag = F.col("l_returnflag")
        return {
            "status": F.when(flag == "A", "SUCCESS").when(flag == "N", "FORFEITED").otherwise("CREATED"),
            "trigger": F.when(F.col("l_linestatus") == "F", "BOOKING_AUTOMATION").otherwise("APP"),
            "bidding": F.when(F.col("l_linenumber") % 2 == 0, "B1").otherwise("M1"),
            "paise": (F.col("l_quantity") * 100).cast("bigint"),
        }

    def tokens_hot(self) -> DataFrame:
        t = self._token()
        meta = F.struct(t["trigger"].alias("triggerSource"), t["bidding"].alias("biddingType"), t["paise"].alias("amountInPaisa"))
        return self._lines_hot().select(
            F.col("l_orderkey").alias("demand_id"),
            F.col("l_suppkey").cast("string").alias("operator_code"),
            t["status"].alias("status"),
            F.to_json(meta).alias("metadata"),
            F.col("l_shipdate").alias("created"),
            F.lit("false").alias("deleted"),
            *_partitions("l_shipdate"),
        )

    def tokens_archive(self) -> DataFrame:
        t = self._token()
        return self._lines_cold().select(
            F.col("l_orderkey").alias("demand_id"),
            F.col("l_suppkey").cast("string").alias("operator_code"),
            t["status"].alias("status"),
            t["trigger"].alias("trigger_source"),
            t["bidding"].alias("bidding_type"),
            t["paise"].alias("amount_in_paisa"),
            F.col("l_shipdate").alias("created"),
            F.lit("false").alias("deleted"),
        )

    def current_rates(self) -> DataFrame:
        k, price = F.col("p_partkey"), F.col("p_retailprice")
        return self.t("part").select(
            k.alias("id"),
            F.col("p_brand").alias("source"),
            (F.lit("2000-01-01").cast("timestamp_ntz") + _days(k % 365)).alias("created"),
            F.col("p_type").alias("updated_by"),
            price.alias("p1"), (price + 100).alias("p2"), (price + 200).alias("p3"),
            (k - k % 2).alias("odvt_id"),
            F.lit("false").alias("deleted"),
        )

    def rate_lanes(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.t("part", "p_partkey").select(
            k.alias("id"),
            F.concat(F.lit("D"), (k % 25).cast("string")).alias("origin_key"),
            F.concat(F.lit("D"), (F.floor(k / 25) % 25).cast("string")).alias("destination_key"),
            (k % 180 + 1).alias("vehicle_classification_id"),
            F.lit("false").alias("deleted"),
        )

    def places(self) -> DataFrame:
        return self._nations().select(
            F.concat(F.lit("D"), F.col("n_nationkey").cast("string")).alias("key"),
            F.col("n_name").alias("district"), F.col("r_name").alias("state"),
        )

    def segment_mapping(self) -> DataFrame:
        return self.t("events", "event_id", "event_type", "ts").select(
            event_demand().alias("demand_id"),
            F.col("event_type").alias("segment_config"),
            F.col("ts").alias("created_at"),
        )

    # --- restriction, supply, engagement ---

    def restrictions(self) -> DataFrame:
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").filter(F.col("o_orderstatus") == "P")
        return o.select(
            epoch_seconds(F.col("o_orderdate")).cast("string").alias("start_time"),
            F.col("o_custkey").cast("string").alias("consigner_code"),
            F.when(F.col("o_orderkey") % 6 == 0, F.lit(None)).when(F.col("o_orderkey") % 2 == 0, "RESTRICTED")
            .otherwise("UNRESTRICTED").alias("status"),
            F.lit("false").alias("deleted"),
            *_partitions("o_orderdate"),
        )

    def gps_lanes(self) -> DataFrame:
        places = self.districts().select("id", "name")
        l = self.t("lineitem", "l_orderkey", "l_suppkey")
        trips = (
            l.join(self.t("orders", "o_orderkey", "o_custkey"), l.l_orderkey == F.col("o_orderkey"))
            .join(self.t("customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.t("supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select("l_suppkey", "c_nationkey", "s_nationkey")
            .distinct()
        )
        start = places.select(F.col("id").alias("c_nationkey"), F.col("name").alias("from_district"))
        end = places.select(F.col("id").alias("s_nationkey"), F.col("name").alias("to_district"))
        named = trips.join(start, on="c_nationkey").join(end, on="s_nationkey")
        return named.select(F.col("l_suppkey").cast("string").alias("operator_code"), "from_district", "to_district")

    def operators(self) -> DataFrame:
        return self.t("supplier", "s_suppkey").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_suppkey").cast("string").alias("code"),
            F.when(F.col("s_suppkey") % 20 == 19, 1).otherwise(0).alias("deleted"),
        )

    def operator_vehicles(self) -> DataFrame:
        return self.t("lineitem", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus").select(
            F.col("l_suppkey").alias("operator_id"),
            F.col("l_partkey").alias("vehicle_id"),
            F.when(F.col("l_returnflag") == "A", "LIVE").otherwise("OFF").alias("state"),
            F.lit(0).alias("deleted"),
            F.lit(1).alias("is_active"),
            F.when(F.col("l_linestatus") == "F", "GPS").otherwise("TAG").alias("service_type"),
        )

    def vehicles(self) -> DataFrame:
        k, size = F.col("p_partkey"), F.col("p_size").cast("double")
        full = F.to_json(
            F.struct(self._body().alias("bodyType"), self._tyres().alias("tyreCount"), size.alias("sizeInFt"))
        )
        return self.t("part").select(
            k.alias("id"),
            # Odd keys leave the document's fields empty and rely on the plain columns.
            F.when(k % 2 == 0, full).otherwise('{"bodyType": "", "tyreCount": ""}').alias("vehicle_attributes"),
            self._body().alias("type"),
            self._tyres().cast("double").alias("tyre_count"),
            size.alias("size_in_ft"),
            F.lit(0).alias("deleted"),
        )

    def subscriptions(self) -> DataFrame:
        return self.t("lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_suppkey").cast("string").alias("user_code"),
            F.col("l_shipdate").alias("created_at"),
            F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("SUCCESS").alias("transaction_status"),
            F.lit("false").alias("deleted"),
        )

    def search_supply(self) -> DataFrame:
        balance = F.col("c_acctbal")
        return self.t("customer", "c_custkey", "c_acctbal").select(
            F.col("c_custkey").alias("demandid"),
            F.floor(balance / 10.0).alias("sub_operators"),
            F.floor(balance / 50.0).alias("sub_more_than_10l"),
            F.floor(balance / 100.0).alias("sub_more_than_20l_and_60km"),
        )

    def _app_events(self, kind: str) -> DataFrame:
        k = F.col("event_id")
        demand = event_demand().cast("string")
        even = k % 2 == 0
        return self.t("events", "event_id", "event_type", "user_id").filter(F.col("event_type") == kind).select(
            F.col("user_id").cast("string").alias("operator_code"),
            F.to_json(F.struct(F.when(k % 17 == 0, F.concat(demand, F.lit("a"))).otherwise(demand).alias("demandId"))).alias("entity"),
            F.when(even, "web_load_confirmation").otherwise("web_rate_and_confirm").alias("screen_name"),
            F.when(even, "v1_load_confirmation").otherwise("v1_rate_and_confirm").alias("event_name"),
            F.when(k % 19 == 0, "fleet").otherwise("marketplace").alias("target_product"),
            F.when(k % 3 == 0, "tap").otherwise("view").alias("event_action"),
        )

    def app_events_1(self) -> DataFrame:
        return self._app_events("view")

    def app_events_2(self) -> DataFrame:
        return self._app_events("click")

    def app_events_3(self) -> DataFrame:
        return self._app_events("purchase")

    def notifications(self) -> DataFrame:
        kind, k = F.col("event_type"), F.col("event_id")
        return self.t("events", "event_id", "event_type", "user_id", "ts").select(
            event_demand().alias("demand_id"),
            F.col("user_id").cast("string").alias("user_code"),
            F.when(kind == "purchase", "DELIVERED").otherwise("SENT").alias("status"),
            F.when(kind == "error", "Marketing").when(k % 2 == 0, "Bidding").otherwise("Booking Automation").alias("notification_type"),
            *_partitions("ts", old_event()),
        )


FRAMES = (
    "demands", "demand_sub_status", "addresses", "cancellations", "district_overrides", "consignments",
    "consignment_state", "consignment_expense", "trip_expense", "consigners", "vehicle_types", "vehicle_bands",
    "vehicle_catalog", "districts", "district_clusters", "experiments", "bidding_config", "quotes_hot",
    "quotes_archive", "tokens_hot", "tokens_archive", "current_rates", "rate_lanes", "places", "segment_mapping",
    "restrictions", "gps_lanes", "operators", "operator_vehicles", "vehicles", "subscriptions", "search_supply",
    "app_events_1", "app_events_2", "app_events_3", "notifications",
)
