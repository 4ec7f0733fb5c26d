"""What part of a source a run reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLUMNS = ("dpyear", "dpmonth", "dpday")


def since_partition(start: dt.date, year: Column, month: Column, day: Column) -> Column:
    """Rows in date partitions from ``start`` on; every branch can prune partitions."""
    return (
        (year > start.year)
        | ((year == start.year) & (month > start.month))
        | ((year == start.year) & (month == start.month) & (day >= start.day))
    )


def recent(df: DataFrame, start: dt.date, columns: Sequence[str] = PARTITION_COLUMNS) -> DataFrame:
    """Rows in partitions from ``start`` on.

    ``columns`` are the partition columns of the source: year, month and day, or the year alone. A source that
    lacks one of them raises an error, as reading it whole would be slow and wrong.
    """
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"no partition columns {missing}; the source has {df.columns}")
    if len(columns) == 1:
        return df.filter(F.col(columns[0]) >= start.year)
    return df.filter(since_partition(start, *[F.col(c) for c in columns]))


def since_id(df: DataFrame, id_col: str, start: int) -> DataFrame:
    return df.filter(F.col(id_col) >= F.lit(start))


def not_deleted(df: DataFrame, flag: str = "deleted") -> DataFrame:
    """Drop soft-deleted rows. The flag is text, boolean or 0/1, and is compared as stored.

    A source without the flag raises an error: it would keep its deleted rows.
    """
    return df.filter(not_deleted_flag(df, flag))


def not_deleted_flag(df: DataFrame, flag: str = "deleted") -> Column:
    """True for rows that are not deleted."""
    if flag not in df.columns:
        raise ValueError(f"no column {flag}; the source has {df.columns}")
    kind = df.schema[flag].dataType
    if isinstance(kind, T.StringType):
        return F.col(flag) == "false"
    if isinstance(kind, T.BooleanType):
        return ~F.col(flag)
    return F.col(flag) == 0


def run_bounds(df: DataFrame, id_col: str, date_col: str, start: dt.date) -> DataFrame:
    """One row with the smallest and largest id from ``start`` on."""
    return df.filter(F.col(date_col) >= F.lit(start).cast("timestamp_ntz")).agg(
        F.min(id_col).alias(f"min_{id_col}"), F.max(id_col).alias(f"max_{id_col}")
    )
