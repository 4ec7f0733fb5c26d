"""Latest, first and running values per key, in forms that survive a hot key.

Top-1 picks are aggregates (``max_by`` over a struct): every map task sends one row per key, however many
rows the key holds. Running values go through :mod:`lanemart.operators.scan`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanemart.operators.scan import bucketed_scan


def latest_per_key(
    df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], extra: Sequence[Column] = ()
) -> DataFrame:
    """Row with the largest ``order`` tuple per key (nulls lowest), plus aggregates over the whole key.

    ``order`` should end in a unique tie-break. ``extra`` aggregates share the same shuffle, which is how a
    partition count is had beside the latest row.
    """
    best = F.max_by(F.struct(*columns), F.struct(*order)).alias("__b")
    extras = list(extra)
    out = df.groupBy(key).agg(best, *extras)
    names = [c for c in out.columns if c not in (key, "__b")]
    return out.select(key, "__b.*", *names)


def first_per_key(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    best = F.min_by(F.struct(*columns), F.struct(*order)).alias("__b")
    return df.groupBy(key).agg(best).select(key, "__b.*")


def first_latest(df: DataFrame, key: str, value: str, at: str, first_name: str, latest_name: str) -> DataFrame:
    """Value seen first, and value whose first appearance is the newest, per key.

    Equal times are ordered by the value.
    """
    per_value = df.groupBy(key, value).agg(F.min(at).alias(at))
    when = F.struct(at, value)
    return per_value.groupBy(key).agg(
        F.min_by(value, when).alias(first_name), F.max_by(value, when).alias(latest_name)
    )


def prior_running_sum(
    df: DataFrame, key: str, order: str, amount: Column, row_id: str, name: str, bucket_width: int = 1 << 20
) -> DataFrame:
    """Sum of ``amount`` over the key's earlier rows (by integer ``order``), 0 on the first row.

    Returns ``row_id`` and ``name``. Rows with a null key are one group. A group of the scan is one key within ``bucket_width`` order values,
    so its size is bounded by that width when ``order`` is unique.
    """
    rows = df.select(F.col(key).alias("__k"), F.col(order).alias("__o"), F.col(row_id).alias("__id"), amount.alias("__v"))
    rows = rows.withColumn("__bucket", F.floor(F.col("__o") / F.lit(bucket_width)))
    out = bucketed_scan(rows, ["__k"], "__bucket", ["__o", "__id"], "__v", name, fold="sum")
    return out.select(F.col("__id").alias(row_id), F.coalesce(name, F.lit(0)).alias(name))
