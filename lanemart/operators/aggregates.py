"""Grouped aggregates. All of them combine on the map side before their shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_if(condition: Column, amount: Column) -> Column:
    """Sum over rows that meet the condition; 0 when the group has none."""
    return F.sum(F.when(condition, amount).otherwise(F.lit(0.0)))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def max_flag(condition: Column) -> Column:
    return F.max(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def min_if(condition: Column, value: Column) -> Column:
    return F.min(F.when(condition, value))


def max_if(condition: Column, value: Column) -> Column:
    return F.max(F.when(condition, value))


def credit_debit(
    ledger: DataFrame, key: str, types: Sequence[str], credit_name: str, debit_name: str
) -> DataFrame:
    """Sums per key of ledger lines of the given types, split by category."""
    listed = F.col("type").isin(list(types))
    return ledger.groupBy(key).agg(
        sum_if((F.col("category") == "CREDIT") & listed, F.col("amount")).alias(credit_name),
        sum_if((F.col("category") == "DEBIT") & listed, F.col("amount")).alias(debit_name),
    )


def pivot_max(df: DataFrame, key: str, code: str, value: str, names: Mapping[str, str], marker: str) -> DataFrame:
    """One row per key: a constant marker and the largest value of each code (code -> column name)."""
    return df.groupBy(key).agg(
        F.lit(1).alias(marker), *[max_if(F.col(code) == c, F.col(value)).alias(name) for c, name in names.items()]
    )


def having_count(df: DataFrame, key: str, more_than: int) -> DataFrame:
    return df.groupBy(key).agg(F.count(key).alias("__n")).filter(F.col("__n") > more_than).select(key)


def distinct_pct(df: DataFrame, key: str, member: str, condition: Column, name: str) -> DataFrame:
    """100 x distinct members that ever meet the condition / distinct members.

    One row per (key, member) first, so the second step only counts: no row is expanded per distinct
    aggregate and the members of a hot key are counted in many tasks.
    """
    per_member = df.groupBy(key, member).agg(max_flag(condition).alias("__hit"))
    known = F.col(member).isNotNull()
    share = (sum_if(known & (F.col("__hit") == 1), F.lit(1.0)) * 100.0) / F.nullif(count_if(known), F.lit(0))
    return per_member.groupBy(key).agg(share.cast("double").alias(name))


def concat_agg(text: Column, sep: str = ", ") -> Column:
    """Group -> joined text in sorted order. Only for groups of a known small size."""
    return F.array_join(F.array_sort(F.collect_list(text)), sep)


def dedupe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def first_id(df: DataFrame, key: str, value: str, condition: Column, name: str) -> DataFrame:
    return df.filter(condition).groupBy(key).agg(F.min(value).alias(name))


def band_limits(bands: DataFrame, keys: Sequence[str], limits: Mapping[str, str]) -> DataFrame:
    """Largest value per band key (source column -> output column)."""
    return bands.groupBy(*keys).agg(*[F.max(src).alias(out) for src, out in limits.items()])
