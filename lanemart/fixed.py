"""Values the mart's results depend on, and the parameters of a run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# ---- fixed values: district sets, zones, ledger types, statuses, patterns -----------------------

NCR_DISTRICTS = (
    "WEST DELHI_DELHI", "CENTRAL DELHI_DELHI", "NEW DELHI_DELHI",
    "NORTH WEST DELHI_DELHI", "NORTH DELHI_DELHI", "SOUTH DELHI_DELHI",
    "SHAHDARA_DELHI", "SOUTH EAST DELHI_DELHI", "EAST DELHI_DELHI",
    "SOUTH WEST DELHI_DELHI", "NORTH EAST DELHI_DELHI",
    "FARIDABAD_HARYANA", "GURUGRAM_HARYANA", "JHAJJAR_HARYANA", "NUH_HARYANA",
    "PALWAL_HARYANA", "REWARI_HARYANA", "ROHTAK_HARYANA", "SONIPAT_HARYANA",
    "BAGHPAT_UTTAR PRADESH", "GAUTAM BUDDHA NAGAR_UTTAR PRADESH",
    "GHAZIABAD_UTTAR PRADESH", "MEERUT_UTTAR PRADESH", "BHIWANI_HARYANA",
)

ROI_BASE_DISTRICTS = (
    "AHMEDABAD_GUJARAT", "AMRELI_GUJARAT", "ANAND_GUJARAT", "ARAVALLI_GUJARAT",
    "BOTAD_GUJARAT", "CHHOTA UDAIPUR_GUJARAT",
    "DADRA AND NAGAR HAVELI_DADRA AND NAGAR HAVELI AND DAMAN AND DIU",
    "DAHOD_GUJARAT", "DAMAN_DADRA AND NAGAR HAVELI AND DAMAN AND DIU",
    "DANG_GUJARAT", "DEVBHUMI DWARKA_GUJARAT", "GANDHINAGAR_GUJARAT",
    "GIR SOMNATH_GUJARAT", "JAMNAGAR_GUJARAT", "JUNAGADH_GUJARAT",
    "KHEDA_GUJARAT", "MAHISAGAR_GUJARAT", "MEHSANA_GUJARAT", "MORBI_GUJARAT",
    "NARMADA_GUJARAT", "NAVSARI_GUJARAT", "PANCHMAHAL_GUJARAT", "PORBANDAR_GUJARAT",
    "RAJKOT_GUJARAT", "SABARKANTHA_GUJARAT", "SURAT_GUJARAT", "SURENDRANAGAR_GUJARAT",
    "TAPI_GUJARAT", "VADODARA_GUJARAT", "VALSAD_GUJARAT",
    "AHMEDNAGAR_MAHARASHTRA", "AURANGABAD_MAHARASHTRA", "BEED_MAHARASHTRA",
    "JALNA_MAHARASHTRA", "LATUR_MAHARASHTRA", "MUMBAI CITY_MAHARASHTRA",
    "MUMBAI SUBURBAN_MAHARASHTRA", "NAGPUR_MAHARASHTRA", "NANDED_MAHARASHTRA",
    "NASHIK_MAHARASHTRA", "OSMANABAD_MAHARASHTRA", "PALGHAR_MAHARASHTRA",
    "PARBHANI_MAHARASHTRA", "PUNE_MAHARASHTRA", "RAIGAD_MAHARASHTRA",
    "RATNAGIRI_MAHARASHTRA", "SATARA_MAHARASHTRA", "SOLAPUR_MAHARASHTRA",
    "THANE_MAHARASHTRA", "RAIGARH_CHHATTISGARH",
    "BENGALURU RURAL_KARNATAKA", "BENGALURU URBAN_KARNATAKA",
    "CHIKKABALLAPURA_KARNATAKA", "KOLAR_KARNATAKA", "RAMANAGARA_KARNATAKA",
    "TUMAKURU_KARNATAKA", "KRISHNAGIRI_TAMIL NADU",
    "CENTRAL DELHI_DELHI", "EAST DELHI_DELHI", "NEW DELHI_DELHI",
    "NORTH DELHI_DELHI", "NORTH EAST DELHI_DELHI", "NORTH WEST DELHI_DELHI",
    "SHAHDARA_DELHI", "SOUTH DELHI_DELHI", "SOUTH EAST DELHI_DELHI",
    "SOUTH WEST DELHI_DELHI", "WEST DELHI_DELHI",
    "BHIWANI_HARYANA", "FARIDABAD_HARYANA", "GURUGRAM_HARYANA", "JHAJJAR_HARYANA",
    "NUH_HARYANA", "PALWAL_HARYANA", "PANIPAT_HARYANA", "REWARI_HARYANA",
    "ROHTAK_HARYANA", "SONIPAT_HARYANA",
    "BAGHPAT_UTTAR PRADESH", "BULANDSHAHR_UTTAR PRADESH",
    "GAUTAM BUDDHA NAGAR_UTTAR PRADESH", "GHAZIABAD_UTTAR PRADESH",
    "HAPUR_UTTAR PRADESH", "MEERUT_UTTAR PRADESH", "ALWAR_RAJASTHAN",
)

THIRD_REGION_ORIGINS = ("JAIPUR_RAJASTHAN", "HYDERABAD_TELANGANA")

ZONES = {
    "EAST": ["WEST BENGAL", "BIHAR", "JHARKHAND", "ODISHA", "CHHATTISGARH"],
    "NORTHEAST": ["SIKKIM", "ASSAM", "MEGHALAYA", "MIZORAM", "MANIPUR", "TRIPURA", "ARUNACHAL PRADESH", "NAGALAND"],
    "NORTH": ["PUNJAB", "HARYANA", "DELHI", "UTTAR PRADESH", "CHANDIGARH"],
    "CENTRAL": ["MADHYA PRADESH", "RAJASTHAN"],
    "WEST": ["MAHARASHTRA", "GUJARAT", "GOA", "DADRA AND NAGAR HAVELI AND DAMAN AND DIU"],
    "SOUTH": ["TAMIL NADU", "KERALA", "KARNATAKA", "TELANGANA", "ANDHRA PRADESH", "PUDUCHERRY"],
    "NORTH_HILLS": ["JAMMU AND KASHMIR", "UTTARAKHAND", "HIMACHAL PRADESH", "LADAKH"],
}

OPERATOR_LEDGER_TYPES = ("TRIP DISCOUNT - REVERSAL", "TRIP DISCOUNT", "WE DISCOUNT", "WE DISCOUNT - REVERSAL")
SHIPPER_LEDGER_TYPES = ("COUPON DISCOUNT", "COUPON DISCOUNT - REVERSAL", "DISCOUNT COUPON")
RATE_CARDS = ("rate_card_1", "rate_card_2", "rate_card_3")
AUTOMATED_TRIGGERS = ("BOOKING_AUTOMATION", "TESSERACT_SERVICE")
PLACED_TOKEN_STATUSES = ("SUCCESS", "PAYMENT_SUCCESS", "REFUNDED")
FORFEITED = "FORFEITED"
NOTIFICATION_TYPES = ("Booking Automation", "Bidding")
MODEL_RATE_SOURCES = ("DS_PRICING_V1", "DS_PRICING_INTRA_V1", "DS_PRICING_V2", "DS_PRICING_INTRA_V2")

# Anchored remark texts of demands that were never meant to be placed.
REMARK_PATTERNS = (
    "rfq_demand_expiry", "repeated_indent_demand_expiry", "sent_by_ptl_demand_expiry",
    "data_entry_mistake_demand_expiry", "change_in_truck_type/weight", "just_checking_price", "just_checking",
    "just[ ]checking[ _]price", "via_point[ _]not[ _]added", "via[- ]point[ _]not[ _]added",
    "out_of_scope_demand_expiry", "data_entry_mistake", "repeated_indent", "rfq", "out_of_scope", "demand_expiry",
    "not_in_focus", "just", "demand_modified_consignor_app", "change_in_truck_type/weight_total",
    "via_point_not_added_total", "via_point_not_added", "sent_by_ptl_demand_expiry_total",
    "change_in_truck_type_cancelled_by_consigner_without_consignment_total",
    "change_in_via_point_cancelled_by_consigner_without_consignment_total",
    "booking_requirement_change_cancelled_by_consigner_at_loading_total",
    "change_in_via_point_cancelled_by_consigner_without_consignment",
)

VIEW_EVENTS = (
    {"screen_name": "web_load_confirmation", "event_name": "v1_load_confirmation", "target_product": "marketplace"},
    {"screen_name": "web_rate_and_confirm", "event_name": "v1_rate_and_confirm", "target_product": "marketplace"},
)
VIEW_ACTION = {"event_action": "view"}

# ---- end of fixed values ------------------------------------------------------------------------


@dataclass(frozen=True)
class RegionSets:
    ncr: tuple[str, ...] = NCR_DISTRICTS
    base: tuple[str, ...] = ROI_BASE_DISTRICTS
    third_origins: tuple[str, ...] = THIRD_REGION_ORIGINS
    second_from: dt.date = dt.date(2025, 12, 9)
    third_from: dt.date = dt.date(2025, 12, 18)

    @property
    def extended(self) -> tuple[str, ...]:
        return self.base + self.third_origins


@dataclass(frozen=True)
class MartParams:
    """What a run depends on. ``as_of`` replaces the wall clock, so a run can be repeated."""

    start: dt.date = dt.date(2019, 1, 1)
    as_of: dt.date = dt.date(2026, 1, 1)
    hot_days: int = 7
    start_demand: int = 0
    shift: str = "05:30"
    test_names: tuple[str, ...] = ("alternate", "testing")
    zones: dict[str, list[str]] = field(default_factory=lambda: dict(ZONES))
    regions: RegionSets = field(default_factory=RegionSets)
    retry_user: str = "retry"
    ptl_comment_words: tuple[str, ...] = ()
    consignment_tie: tuple[str, ...] = ("id",)
    cancel_only_expired: bool = False
    time_bucket: int = 86_400
    id_bucket: int = 1 << 20
    salts: int = 16
