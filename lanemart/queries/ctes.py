"""Stand-in source frames as SQL, stated independently of :mod:`lanemart.standin`.

The oracle states attributes as values where the Spark side writes and parses JSON text.
"""

from __future__ import annotations

import re

from lanemart import standin
from lanemart.fixed import MODEL_RATE_SOURCES, REMARK_PATTERNS


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


_BODY = "case p_type when 'ECONOMY' then 'container' when 'STANDARD' then 'open' when 'PROMO' then 'trailer' else lower(p_type) end"
_TYRES = "[4, 6, 10, 12, 14, 18][cast(split_part(p_brand, '#', 2) as int) % 6 + 1]"
_SHIFT = "interval '5 hours 30 minutes'"
_NUMBER = "(l_orderkey * 10 + l_linenumber)"
_BODIES = quoted(standin.BODIES)
EVENT_DEMAND = "(case event_id % 4 when 0 then event_id % 5000 when 3 then (event_id // 4) % 32 * 8 + 3 else event_id % 500 end)"
_SETS = standin.PARAMS.regions

CTES: dict[str, str] = {
    # one row per live demand, attributes already typed
    "demands": f"""
        select o_orderkey as demand_id, o_orderdate + to_hours(o_orderkey * 5 % 24) as created,
          o_orderdate + to_hours(o_orderkey * 5 % 24) + {_SHIFT} as demand_date,
          o_orderdate + to_days(cast(o_orderkey % 5 as int)) + {_SHIFT} as updated_at,
          case when o_orderkey % 29 <> 5 then cast(o_custkey as varchar) end as consigner_user_code, v.vehicle_type_id,
          case o_orderstatus when 'F' then 'FULFILLED' when 'O' then 'PENDING' else 'EXPIRED' end as status,
          o_totalprice as fare,
          case when o_orderkey % 7 = 0 then null when o_orderkey % 3 = 0 then o_totalprice + 500
               when o_orderkey % 5 = 0 then o_totalprice - 500 else o_totalprice end as actual,
          'D' || c_nationkey as origin_district_key, 'D' || s_nationkey as destination_district_key,
          case o_orderkey % 3 when 0 then 0.0 when 1 then 0.05 else 0.1 end::double as service_charge,
          cast('3' || (o_orderkey % 10) || (o_orderkey % 4) as int) as app_version,
          o_orderpriority as dr_type,
          case o_orderkey % 13 when 0 then 'true' when 1 then '' else 'false' end as metadata_plt,
          case when o_orderkey % 4 = 0 then 0.0 else o_orderkey % 1000 + 0.5 end::double as route_distance,
          (o_orderkey % 500)::double as shortest_route_distance,
          case when o_orderkey % 6 <> 0 then o_orderkey % 90000 end::double as supplyfare_before_consignment,
          case when o_orderkey % 2 = 1 then 'rfq' when o_orderkey % 9 = 0 then 'demand_expiry' end as metadata_remarkscategory,
          case o_orderkey % 5 when 0 then 'Just checking price ' when 1 then 'call later' end as metadata_remarks,
          case when o_orderkey % 2 = 1 then 'rfq' else '' end as raw_category,
          case when o_orderkey % 4 = 1 then 'via point not added' end as own_remarks,
          case when o_orderkey % 9 = 0 then 'demand_expiry' end as expiry_remark,
          (o_orderkey % 180) / 2.0::double as from_lat, (o_orderkey % 90) / 4.0::double as from_long,
          (o_orderkey % 120) / 2.0::double as to_lat, (o_orderkey % 60) / 4.0::double as to_long,
          o_orderkey % 11 as request
        from orders
        left join (select l_orderkey, min(l_partkey) as vehicle_type_id, min(l_suppkey) as supp from lineitem group by 1) v
          on v.l_orderkey = o_orderkey
        left join supplier on s_suppkey = v.supp
        left join customer on c_custkey = o_custkey
        where o_orderkey % 97 <> 96""",
    "fares": """
        select *, case when service_charge > 0 then floor((fare / (1 + service_charge) + 99) / 100) * 100 else fare end as base_price,
          case when actual >= fare then actual - fare else 0 end as extra_discount,
          case when actual >= 0 then actual else fare end as updated_fare
        from demands""",
    "vehicle_types": f"""
        select p_partkey as vehicle_type_id, {_BODY} as body_type, {_TYRES} as tyre_count, p_size::double as size_in_ft,
          p_size * 0.5::double as tonnage, p_retailprice / 200 as vehicle_height from part""",
    "vehicle_bands": f"""
        select row_number() over (order by b, t, n) as id, body_type, tyre, lo::double as min_length, hi::double as max_length,
          case when tyre = 10 and lo >= 27 then 10.0 else 0.0 end::double as min_weight,
          case when tyre = 4 then 20.0 else 25.0 end::double as max_weight, case when n = 5 then 9.0 else 4.7 + 0.05 * n end as max_height
        from (select unnest([{_BODIES}]) as body_type, generate_subscripts([{_BODIES}], 1) as b),
             (select unnest([4, 6, 10, 12, 14, 18]) as tyre, generate_subscripts([4, 6, 10, 12, 14, 18], 1) as t),
             (values (0, 1, 7), (1, 8, 9), (2, 10, 26), (3, 27, 40), (4, 41, 50), (5, 20, 30)) as l(n, lo, hi)""",
    "vehicle_catalog": """
        select body_type, tyre_count, size_in_ft, min(vehicle_type_id) as vt_id from vehicle_types group by 1, 2, 3""",
    "band_class": """
        select *, case
            when body_type in ('container', 'open') and tyre = 4 and min_length >= 1 and max_length <= 7 and min_weight <= 1.5 then 'LCV'
            when body_type in ('container', 'open') and tyre = 4 and min_length >= 8 and max_length <= 9 and min_weight <= 2 then 'LCV'
            when body_type = 'open' and tyre = 4 and min_length >= 12 and max_length <= 13 and min_weight <= 2 then 'LCV'
            when body_type = 'container' and tyre = 6 and min_length >= 27 and max_length <= 50 and min_weight <= 9 then 'SXL'
            when body_type = 'container' and tyre = 10 and min_length >= 16 and max_length <= 50 and min_weight >= 10 and min_weight <= 18 then 'MXL'
            when body_type = 'trailer' then 'TRAILER' when tyre in (4, 6) then '4_6' when tyre in (10, 12, 14) then '10_12_14'
            else 'Other' end as veh_tyre_type
        from vehicle_bands""",
    "vehicle_class": """
        select v.vehicle_type_id, v.body_type, v.tyre_count, v.size_in_ft, v.tonnage, b.min_length as min_size, b.max_length as max_size,
          b.min_weight as min_tonnage, b.max_weight as max_tonnage, b.veh_tyre_type, coalesce(b.id, -1)::int as vt_pricing_id,
          coalesce(c.vt_id, -1)::int as vt_id
        from vehicle_types v
        left join band_class b on b.body_type = v.body_type and b.tyre = v.tyre_count
          and v.size_in_ft between b.min_length and b.max_length and v.tonnage between b.min_weight and b.max_weight
        left join vehicle_catalog c on c.body_type = v.body_type and c.tyre_count = v.tyre_count and c.size_in_ft = v.size_in_ft
        qualify row_number() over (partition by v.vehicle_type_id order by b.id) = 1""",
    "districts": """
        select 'D' || n_nationkey as key, n_name || '_' || r_name as name, n_nationkey::bigint as id, r_name as state,
          'CL' || (n_nationkey % 8) as cluster, (n_nationkey % 8)::bigint as cluster_id
        from nation join region on n_regionkey = r_regionkey""",
    "consignments": f"""
        select *, row_number() over (partition by demand_id order by updated desc, id desc, vehicle_id desc, l_suppkey desc, l_quantity desc) as rn
        from (
          select {_NUMBER} as id, 'XX-' || {_NUMBER} as consignment_code, l_orderkey as demand_id,
            case when l_linenumber = 3 then 0.0 else l_extendedprice end as supplyfare,
            l_shipdate + {_SHIFT} as consignment_date, l_shipdate as updated,
            case when l_quantity > 1 and l_orderkey % 8 <> 3 then cast(l_suppkey as varchar) end as operator_code, l_partkey as vehicle_id,
            case when l_linestatus = 'F' then 'TRIP_END' else 'IN_TRANSIT' end as trip_state, l_suppkey, l_quantity
          from lineitem where l_quantity <> 50)""",
    "latest_consignments": """
        select c.*, n.total_consignments from consignments c
        join (select demand_id, count(operator_code) as total_consignments from consignments group by 1) n using (demand_id)
        where rn = 1""",
    "commission": f"""
        select {_NUMBER} as consignment_id,
          sum(case when l_linestatus = 'F' then l_extendedprice * l_discount else 0 end) as fo_commission_reversal,
          sum(case when l_linestatus = 'O' then l_extendedprice * l_discount else 0 end) as fo_commission
        from lineitem where l_returnflag in ('A', 'N') and l_linenumber <> 7 group by 1""",
    "trip_ends": f"""
        select 'XX-' || {_NUMBER} as consignment_code, max(l_shipdate) + interval '3 days' + {_SHIFT} as trip_end_time
        from lineitem where l_linestatus = 'F' group by 1""",
    "consignment_summary": """
        select l.demand_id, l.consignment_code, l.supplyfare, l.consignment_date, l.operator_code, l.vehicle_id, l.trip_state,
          l.total_consignments, t.trip_end_time, c.fo_commission_reversal, c.fo_commission
        from latest_consignments l left join trip_ends t using (consignment_code) left join commission c on c.consignment_id = l.id""",
    "shipper": """
        select l_orderkey as demand_id,
          sum(case when l_returnflag in ('A', 'N') and l_linestatus = 'F' then l_extendedprice * l_tax else 0 end) as shipper_discount,
          sum(case when l_returnflag in ('A', 'N') and l_linestatus = 'O' then l_extendedprice * l_tax else 0 end) as shipper_discount_reversal
        from lineitem where l_linenumber <> 7 group by 1""",
    "milestones": f"""
        select {EVENT_DEMAND} as demand_id, max(case when event_type in ('signup', 'click') then 1 else 0 end) as dr_flag,
          min(case when event_type in ('signup', 'click') then ts end) + {_SHIFT} as first_dr_time,
          max(case when event_type = 'click' then ts end) + {_SHIFT} as last_dr_time,
          min(case when event_type = 'error' then ts end) + {_SHIFT} as demand_cancel_time
        from events where event_type in ('signup', 'click', 'error') and event_id % 97 <> 0 group by 1""",
    "multi_drop": "select l_orderkey as demand_id from lineitem where l_linenumber <> 7 group by 1 having count(*) > 2",
    "history": f"""
        select consigner_user_code, min(demand_date) as consigner_onboarding_date,
          min(case when status = 'FULFILLED' then demand_date end) as consigner_fulfilled_demand_date,
          min(case when status = 'FULFILLED' then demand_id end) as consigner_fulfilled_demand_id
        from demands group by 1""",
    "fulfilled": """
        select demand_id, coalesce(sum(case when status = 'FULFILLED' then 1 else 0 end) over (
          partition by consigner_user_code order by demand_id rows between unbounded preceding and 1 preceding), 0)::bigint as fulfilled_rank
        from demands""",
    "consigner_types": """
        select cast(c_custkey as varchar) as consigner_user_code, kind as customer_type,
          case when name like '%99%' then 'Testing' else 'WE_Customer' end as customer_flag
        from (select c_custkey, c_mktsegment as kind, c_name as name from customer
              union all select c_custkey, 'ALT', 'Other 99' from customer where c_custkey % 10 = 3)
        where c_custkey % 50 <> 49 qualify row_number() over (partition by c_custkey order by kind, name) = 1""",
    "bidding_config": f"""
        select o_orderkey as demand_id, case when o_orderkey % 5 > 1 then [o_orderkey % 4, o_orderkey % 6] end as ids,
          nullif(o_orderkey % 6, 0)::double as int_commission,
          case when o_orderkey % 4 <> 0 then ['DS_PRICING_V1', 'DS_PRICING_INTRA_V2', 'HEURISTIC'][o_orderkey % 3 + 1] end as rate_source
        from orders""",
    "experiment_names": """
        select demand_id, string_agg(coalesce(r_name, 'NA'), ', ' order by coalesce(r_name, 'NA')) as experiment_name
        from (select demand_id, unnest(ids) as id from bidding_config where ids is not null) left join region on r_regionkey = id
        group by 1""",
    "pricing_types": f"""
        select demand_id, case when rate_source in ({quoted(MODEL_RATE_SOURCES)}) then rate_source when rate_source is not null then 'BR_PRICING' else 'NA' end as pricing_type
        from bidding_config""",
    "segments": f"""
        select demand_id, max(case when up = 1 then event_type end) as segment_config_first, max(case when down = 1 then event_type end) as segment_config_latest
        from (select *, row_number() over (partition by demand_id order by t, event_type) as up,
                row_number() over (partition by demand_id order by t desc, event_type desc) as down
              from (select {EVENT_DEMAND} as demand_id, event_type, min(ts) as t from events group by 1, 2))
        group by 1""",
    "quotes": f"""
        select l_orderkey as demand_id, l_linenumber % 3 + 1 as card,
          case when l_shipdate < timestamp '{standin.EDGE}' or l_linenumber % 2 = 0 then l_extendedprice / 10 else l_extendedprice / 20 end as quote
        from lineitem where l_quantity <> 2""",
    "base_rates": """
        select demand_id, 1 as base_rate_flag, max(case when card = 1 then rate end) as base_rate1,
          max(case when card = 2 then rate end) as base_rate2, max(case when card = 3 then rate end) as base_rate3
        from (select q.demand_id, card, floor((quote * (1 + coalesce(int_commission, 0) / 100) + 99) / 100) * 100 as rate
              from quotes q left join bidding_config using (demand_id))
        group by 1""",
    "tokens": """
        select l_orderkey as demand_id, cast(l_suppkey as varchar) as operator_code,
          case l_returnflag when 'A' then 'SUCCESS' when 'N' then 'FORFEITED' else 'CREATED' end as status,
          case when l_linestatus = 'F' then 'Auto' else 'Manual' end as token,
          case when l_linenumber % 2 = 0 then 'Bidding' else 'Matching' end as placement_phase,
          cast(l_quantity * 100 as bigint) / 100.0 as amount, l_shipdate as created
        from lineitem where l_returnflag in ('A', 'N')""",
    "token_modes": """
        select demand_id, operator_code, count(*) filter (token = 'Manual') as manual, count(*) filter (token = 'Auto') as auto,
          count(*) filter (placement_phase = 'Matching') as matching, count(*) filter (placement_phase = 'Bidding') as bidding
        from tokens where status = 'SUCCESS' group by 1, 2""",
    "placement": """
        select l.demand_id, case when m.manual is null or m.manual > 0 then 'Manual' else 'Automation' end as plac_type,
          case when m.matching is null or m.matching > 0 then 'Matching' else 'Bidding' end as placement_phase
        from latest_consignments l left join token_modes m on m.demand_id = l.demand_id and m.operator_code = l.operator_code
        where l.total_consignments > 0""",
    "token_forfeit": "select demand_id, sum(amount) as token_forfeit from tokens where status = 'FORFEITED' group by 1",
    "limits": """
        select v.vehicle_type_id, count(*) filter (v.vehicle_height > b.max_height) > 0 as high, count(*) filter (v.tonnage > b.max_weight) > 0 as heavy
        from vehicle_types v left join vehicle_bands b on b.body_type = v.body_type and b.tyre = v.tyre_count
          and v.size_in_ft between b.min_length and b.max_length
        group by 1""",
    "special": """
        select demand_id, 1 as special_req,
          list_filter([case when request in (0, 7) then 'OVER_HEIGHT' end, case when request = 1 then 'OVER_WEIGHT' end,
            case when request = 2 then 'EXPRESS_DELIVERY' end, case when request in (3, 7) then 'OPEN_DALA' end,
            case when request = 4 then 'OVER_WIDTH' end, case when request = 5 then 'EXTRA_PERSON' end,
            case when request = 6 then 'DIESEL_VEHICLE' end], lambda x: x is not null) as special_type,
          case when coalesce(high, false) or coalesce(heavy, false) or request in (2, 3, 4, 5, 6, 7) then 1 else 0 end as pricing_special_req,
          list_filter([case when high then 'OVER_HEIGHT' end, case when heavy then 'OVER_WEIGHT' end,
            case when request = 2 then 'EXPRESS_DELIVERY' end, case when request in (3, 7) then 'OPEN_DALA' end,
            case when request = 4 then 'OVER_WIDTH' end, case when request = 5 then 'EXTRA_PERSON' end,
            case when request = 6 then 'DIESEL_VEHICLE' end], lambda x: x is not null) as priced_type
        from demands left join limits using (vehicle_type_id) where request <= 7""",
    "overrides": """
        select demand_id, from_key, to_key from (
          select o_orderkey as demand_id, 'D' || (o_orderkey % 25) as from_key, 'D' || (o_orderkey % 23) as to_key from orders where o_orderstatus <> 'P'
          union all select o_orderkey, 'D' || (o_orderkey % 7), 'D' || (o_orderkey % 5) from orders where o_orderstatus <> 'P' and o_orderkey % 15 = 2)
        qualify row_number() over (partition by demand_id order by from_key, to_key) = 1""",
    "geography": f"""
        select demand_id, demand_date, coalesce(d.origin_district_key, s.from_key) as origin_district_key,
          coalesce(d.destination_district_key, s.to_key) as destination_district_key,
          o.name as origin, o.id as origin_id, o.state as origin_state, o.cluster as origin_cluster, o.cluster_id as origin_cluster_id,
          t.name as destination, t.id as destination_id, t.state as destination_state, t.cluster as destination_cluster,
          t.cluster_id as destination_cluster_id,
          case when o.name in ({quoted(_SETS.ncr)}) then 'NCR' else 'Non_NCR' end as ncr_flag,
          case when o.name in ({quoted(_SETS.ncr)}) then 'NCR' when o.name in ({quoted(_SETS.base)}) then 'ROI'
            when demand_date::date >= date '{_SETS.second_from}' and coalesce(o.name, '') not in ({quoted(_SETS.extended)}) and t.name in ({quoted(_SETS.extended)}) then 'ROI:2'
            when demand_date::date >= date '{_SETS.third_from}' and o.name in ({quoted(_SETS.third_origins)}) then 'ROI:3'
            else 'OTHERS' end as demand_region,
          case t.state when 'AFRICA' then 'SOUTH' when 'AMERICA' then 'WEST' when 'ASIA' then 'EAST' when 'EUROPE' then 'NORTH' end as destination_zone
        from demands d left join overrides s using (demand_id)
        left join districts o on o.key = coalesce(d.origin_district_key, s.from_key)
        left join districts t on t.key = coalesce(d.destination_district_key, s.to_key)""",
    "restrictions": f"""
        select cast(o_custkey as varchar) as consigner_user_code, o_orderdate + {_SHIFT} as start_time,
          max(case when o_orderkey % 6 = 0 then null when o_orderkey % 2 = 0 then 'RESTRICTED' else 'UNRESTRICTED' end) as status
        from orders where o_orderstatus = 'P' group by 1, 2""",
    "restriction": """
        select d.demand_id, coalesce(a.status, 'UNRESTRICTED') as consigner_payment_status,
          coalesce(b.status, 'UNRESTRICTED') as consigner_payment_status_at_dr
        from (select demand_id, consigner_user_code, demand_date, first_dr_time from demands left join milestones using (demand_id)) d
        asof left join restrictions a on a.consigner_user_code = d.consigner_user_code and d.demand_date > a.start_time
        asof left join restrictions b on b.consigner_user_code = d.consigner_user_code and d.first_dr_time > b.start_time""",
    "subscription_starts": f"""
        select operator_code, created_at as subscription_start_date from (
          select cast(l_suppkey as varchar) as operator_code, l_shipdate as created_at,
            row_number() over (partition by l_suppkey order by {_NUMBER}, l_shipdate) as rn
          from lineitem where l_returnflag <> 'R')
        where rn = 1""",
    "supply_lanes": """
        select distinct cast(s_suppkey as varchar) as operator_code, f.cluster as origin_cluster, t.cluster as destination_cluster, v.vt_id, u.subscription_start_date
        from (select distinct l_suppkey, c_nationkey from lineitem join orders on o_orderkey = l_orderkey join customer on c_custkey = o_custkey) a
        join supplier on s_suppkey = a.l_suppkey and s_suppkey % 20 <> 19
        join (select distinct l_suppkey, l_partkey from lineitem where l_returnflag = 'A' and l_linestatus = 'F') ov on ov.l_suppkey = a.l_suppkey
        join vehicle_types p on p.vehicle_type_id = ov.l_partkey
        join vehicle_catalog v on v.body_type = p.body_type and v.tyre_count = p.tyre_count and v.size_in_ft = p.size_in_ft
        join districts f on f.id = a.c_nationkey join districts t on t.id = s_nationkey
        join subscription_starts u on u.operator_code = cast(s_suppkey as varchar)""",
    "supply_match": """
        select demand_id, count(distinct operator_code) as ccvt_supply_lane_match_fo
        from (select demand_id, demand_date, origin_cluster, destination_cluster, coalesce(vt_id, -1) as vt_id
              from geography join demands using (demand_id, demand_date) left join vehicle_class using (vehicle_type_id)) d
        join supply_lanes s using (origin_cluster, destination_cluster, vt_id)
        where d.demand_date >= s.subscription_start_date group by 1""",
    "search_supply": """
        select c_custkey as demand_id, floor(c_acctbal / 10.0)::double as total_opsearch_fo, floor(c_acctbal / 50.0)::double as opsearch_fo_10l_score,
          floor(c_acctbal / 100.0)::double as sub_more_than_20l_and_60km from customer""",
    "engagement": f"""
        select demand_id, count(operator_code) as fo_engage from (
          select distinct user_id as operator_code, {EVENT_DEMAND} as demand_id from events
          where event_id % 17 <> 0 and event_id % 19 <> 0
            and ((event_type = 'view' and event_id % 3 <> 0) or event_type in ('click', 'purchase')))
        group by 1""",
    "delivered": f"""
        select {EVENT_DEMAND} as demand_id,
          count(distinct case when event_type = 'purchase' then user_id end) * 100.0::double / count(distinct user_id) as noitf_delivered_fo
        from events where event_type <> 'error' and event_id % 97 <> 0 group by 1""",
    "rate_catalog": """
        select p.p_partkey as odvt_base_rate_id, p.p_brand as source, timestamp '2000-01-01' + to_days(cast(p.p_partkey % 365 as int)) as created,
          p.p_type as base_rate_updated_by, p.p_retailprice as p1, p.p_retailprice + 100 as p2, p.p_retailprice + 200 as p3,
          l.id as odvt_id, o.name as origin, d.name as destination, b.body_type, b.tyre as tyre_count, b.min_length, b.max_length, b.min_weight, b.max_weight
        from part p
        left join (select p_partkey as id, 'D' || (p_partkey % 25) as o, 'D' || ((p_partkey // 25) % 25) as d, p_partkey % 180 + 1 as band from part) l
          on l.id = p.p_partkey - p.p_partkey % 2
        left join districts o on o.key = l.o left join districts d on d.key = l.d left join vehicle_bands b on b.id = l.band""",
    "current_rates": """
        select * exclude (rn) from (
          select d.demand_id, r.source, r.base_rate_updated_by, r.odvt_base_rate_id, r.p1, r.p2, r.p3, r.odvt_id,
            row_number() over (partition by d.demand_id order by r.created desc, r.odvt_base_rate_id desc) as rn
          from (select demand_id, origin, destination, vehicle_type_id from geography join demands using (demand_id)) d
          join vehicle_types v using (vehicle_type_id)
          join rate_catalog r on r.origin = d.origin and r.destination = d.destination and r.body_type = v.body_type and r.tyre_count = v.tyre_count
            and v.size_in_ft between r.min_length and r.max_length and v.tonnage between r.min_weight and r.max_weight)
        where rn = 1""",
    "booked_by": f"""
        select demand_id, case when user_id % 3 = 0 then 'retry' else cast(user_id as varchar) end as dr_book_by from (
          select {EVENT_DEMAND} as demand_id, user_id, row_number() over (partition by {EVENT_DEMAND} order by event_id desc) as rn
          from events where event_type = 'click' and event_id % 97 <> 0) where rn = 1""",
    "margin": """
        select f.demand_id, updated_fare,
          case when actual < fare then 0 else s.shipper_discount end as shipper_discount,
          case when actual < fare then 0 else s.shipper_discount_reversal end as shipper_discount_reversal,
          updated_fare - updated_fare / (1 + service_charge)
            - (coalesce(case when actual < fare then 0 else s.shipper_discount end, 0) - coalesce(case when actual < fare then 0 else s.shipper_discount_reversal end, 0))
            - extra_discount as consigner_pnl,
          updated_fare / (1 + service_charge) - coalesce(c.supplyfare, supplyfare_before_consignment, 0)
            - (coalesce(c.fo_commission_reversal, 0) - coalesce(c.fo_commission, 0)) + coalesce(t.token_forfeit, 0) as fo_pnl
        from fares f left join consignment_summary c using (demand_id) left join shipper s using (demand_id) left join token_forfeit t using (demand_id)""",
    "outcome": """
        select d.demand_id, coalesce(c.total_consignments, 0) as placed, m.first_dr_time, m.demand_cancel_time,
          case when md.demand_id is not null then 1 else coalesce(sp.special_req, 0) end as special_req,
          case when md.demand_id is not null then 1 else coalesce(sp.pricing_special_req, 0) end as pricing_special_req,
          case when coalesce(sm.ccvt_supply_lane_match_fo, 0) < 20 and coalesce(ss.total_opsearch_fo, 0) < 200 then 'Red' else 'Green' end as supply_confidence,
          case
            when c.total_consignments > 0 then 'Placed'
            when coalesce(sm.ccvt_supply_lane_match_fo, 0) < 20 and coalesce(ss.total_opsearch_fo, 0) < 200 then 'Low Supply'
            when coalesce(ss.sub_more_than_20l_and_60km, 0) <= 20 then 'Low Quality Supply'
            when hour(m.first_dr_time) >= 21 or hour(m.first_dr_time) < 8 then 'Non Working Hours'
            when date_diff('second', m.first_dr_time, m.demand_cancel_time) <= 1800 then 'Less Time to Place'
            when coalesce(e.fo_engage, 0) < 25 and coalesce(n.noitf_delivered_fo, 0) < 0.6 then 'Less FO Engagement [Low Del.]'
            when coalesce(e.fo_engage, 0) < 25 then 'Less FO Engagement [High Del.]'
            when md.demand_id is not null or sp.pricing_special_req = 1 then 'Matching/Pricing Issue [SR]'
            else 'Matching/Pricing Issue [Non SR]' end as non_plc_reason,
          case
            when (c.total_consignments >= 1 and hour(d.demand_date) >= 21) or hour(d.demand_date) < 8 then 'NIGHT_DEMAND'
            when c.total_consignments > 1 and oc.demand_id is not null then 'FO_BACKOUT_DEMAND'
            when c.total_consignments > 1 then 'MULTIPLE_CONSIGNMENTS'
            else 'NORMAL_DEMAND' end as plc_demand_type
        from demands d left join consignment_summary c using (demand_id) left join milestones m using (demand_id)
        left join multi_drop md using (demand_id) left join special sp using (demand_id) left join supply_match sm using (demand_id)
        left join search_supply ss using (demand_id) left join engagement e using (demand_id) left join delivered n using (demand_id)
        left join (select distinct l_orderkey as demand_id from lineitem where l_returnflag = 'R') oc using (demand_id)""",
}


def with_ctes(sql: str) -> str:
    """Query text after the shared definitions it mentions, directly or through another one."""
    used = set(re.findall(r"\w+", sql))
    for name in reversed(CTES):  # a definition only mentions earlier ones
        if name in used:
            used.update(re.findall(r"\w+", CTES[name]))
    heads = ",\n".join(f"{name} as ({' '.join(body.split())})" for name, body in CTES.items() if name in used)
    return f"with {heads}\n{sql.strip()}" if heads else sql.strip()


def remark_regex() -> str:
    return "^(" + "|".join(REMARK_PATTERNS) + ")$"
