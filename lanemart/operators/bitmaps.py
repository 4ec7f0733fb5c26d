"""Exact distinct counts that can be kept and merged, as bitmaps of member numbers.

A distinct count of a day cannot be added to that of the next day; a bitmap can be united with it. Members are numbers
(a dimension's id); a bitmap holds ``2^15`` of them, so a key has one row per range of numbers that occurs:

1. ``member_bitmaps`` makes one row per key, part (a day) and range, combined on the map side. It is what is kept.
2. ``merge_bitmaps`` unites parts: any number of days, or two batches of one day, in any order, repeats included.
3. ``bitmap_share`` counts bits.

All three are ordinary aggregates without DISTINCT, so no row is expanded and members of a hot key never meet in one
task: at most 4 KB per key and range travel. That pays where keys have many rows per part; for keys with a handful
of members a plain distinct aggregate is smaller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Range of member numbers, all members in it, and those that met the condition.
RANGE, MEMBERS, HITS = "member_range", "members", "hits"


def member_bitmaps(df: DataFrame, keys: Sequence[str], member: str, condition: Column) -> DataFrame:
    """One row per ``keys`` and range of ``member`` (a number of 0 or more; rows without one are left out)."""
    known = df.filter(F.col(member) >= 0).withColumns(
        {RANGE: F.bitmap_bucket_number(F.col(member)), "__bit": F.bitmap_bit_position(F.col(member))}
    )
    return known.groupBy(*keys, RANGE).agg(
        F.bitmap_construct_agg("__bit").alias(MEMBERS),
        F.bitmap_construct_agg(F.when(condition, F.col("__bit"))).alias(HITS),
    )


def member_number(code: Column) -> Column:
    """Number of a member whose code is digits; null for any other code."""
    return F.when(code.rlike("^[0-9]{1,18}$"), code.try_cast("bigint"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """United over everything but ``keys``."""
    return bitmaps.groupBy(*keys, RANGE).agg(F.bitmap_or_agg(MEMBERS).alias(MEMBERS), F.bitmap_or_agg(HITS).alias(HITS))


def bitmap_share(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """100 x distinct members that ever met the condition / distinct members. ``bitmaps`` must be merged over ``keys``."""
    hits, members = (F.sum(F.bitmap_count(c)) for c in (HITS, MEMBERS))
    return bitmaps.groupBy(*keys).agg((hits * F.lit(100.0) / members).alias(name))
