"""Money and number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def step_round(x: Column, step: int = 100) -> Column:
    """``floor((x + step - 1) / step) * step`` as double.

    Not a ceiling for fractional input: 100.5 stays at 100 while 101 moves to 200.
    """
    return (F.floor((x + F.lit(float(step - 1))) / F.lit(float(step))) * F.lit(step)).cast("double")


def markup(x: Column, percent: Column) -> Column:
    return x * (F.lit(1.0) + F.coalesce(percent, F.lit(0.0)) / F.lit(100.0))


def minor_to_major(x: Column) -> Column:
    """Hundredths to whole units, as double so that nothing is truncated."""
    return x.cast("double") / F.lit(100.0)


def positive_or(first: Column, second: Column) -> Column:
    return F.when(first > 0, first).otherwise(second)


def int_or_null(text: Column) -> Column:
    """Long from text made of digits only, else null (also when it overflows)."""
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint"))


def version_number(text: Column) -> Column:
    """Digits of a version text as one integer (``v3.10.2`` -> 3102); -1 when there are none."""
    digits = F.regexp_replace(text, "[A-Za-z .]+", "")
    return F.coalesce(F.nullif(digits, F.lit("")).try_cast("double").try_cast("int"), F.lit(-1))


def fill(x: Column, *fallbacks: Column) -> Column:
    return F.coalesce(x, *fallbacks)


def zero(x: Column) -> Column:
    return F.coalesce(x, F.lit(0.0))


def safe_cast(x: Column, type_name: str) -> Column:
    return x.try_cast(type_name)


# --- fare and margin ---------------------------------------------------------------------------


def base_price(fare: Column, service_charge: Column) -> Column:
    """Fare net of the service charge, rounded to the step; the fare itself when nothing is charged."""
    return F.when(service_charge > 0, step_round(fare / (F.lit(1.0) + service_charge))).otherwise(fare).cast("double")


def extra_discount(actual: Column, fare: Column) -> Column:
    return F.when(actual >= fare, actual - fare).otherwise(F.lit(0.0))


def updated_fare(actual: Column, fare: Column) -> Column:
    return F.when(actual >= 0, actual).otherwise(fare)


def discount_unless_cut(actual: Column, fare: Column, ledger_sum: Column) -> Column:
    """Ledger discounts do not count when the fare itself was reduced."""
    return F.when(actual < fare, F.lit(0.0)).otherwise(ledger_sum)


def consigner_pnl(fare: Column, service_charge: Column, discount: Column, reversal: Column, extra: Column) -> Column:
    net_fare = fare / (F.lit(1.0) + service_charge)
    return fare - net_fare - (zero(discount) - zero(reversal)) - zero(extra)


def operator_pnl(
    fare: Column,
    service_charge: Column,
    supply_fare: Column,
    supply_fare_before: Column,
    commission: Column,
    commission_reversal: Column,
    forfeit: Column,
) -> Column:
    net_fare = fare / (F.lit(1.0) + service_charge)
    paid = F.coalesce(supply_fare, supply_fare_before, F.lit(0.0))
    return net_fare - paid - (zero(commission_reversal) - zero(commission)) + zero(forfeit)
