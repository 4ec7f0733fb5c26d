"""Joins: lookups, enrichment chains, range lookups, backfills, semi joins.

No join here carries a broadcast hint: whether a side is broadcast is decided by Spark from the side's
estimated or measured size, and beyond the threshold it falls back to a shuffled join whose skewed
partitions are split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanemart.functions.text import code_number, norm_key
from lanemart.operators.grid import grid_lookup


def enrich(spine: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join parts that hold one row per ``key``; all of them reuse one partitioning of the spine."""
    return reduce(lambda out, part: out.join(part, on=key, how="left"), parts, spine)


def lookup_left(
    df: DataFrame, dim: DataFrame, on: str, dim_key: str, columns: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Left lookup of ``columns`` (names, or source name -> output name) by ``df.on = dim.dim_key``."""
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    picked = dim.select(F.col(dim_key).alias("__k"), *[F.col(src).alias(out) for src, out in names.items()])
    return df.join(picked, df[on] == F.col("__k"), "left").drop("__k")


def lookup_salted(
    df: DataFrame, dim: DataFrame, key: str, spread_by: str, salts: int = 16
) -> DataFrame:
    """Left join to a small one-row-per-key side when a few keys, not known before, may hold a large share of ``df``.

    Rows of a hot key are spread over ``salts`` groups by a hash of ``spread_by`` and the other side is
    repeated once per salt, so that no task receives a whole hot key. Where hot keys can be measured,
    :func:`lanemart.operators.hot.lookup_hot` copies nothing.
    """
    spread = df.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)))
    repeated = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return spread.join(repeated, on=[key, "__salt"], how="left").drop("__salt")


def multi_key_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    return left.join(right, on=list(keys), how=how)


def range_lookup(
    df: DataFrame,
    bands: DataFrame,
    eq: Mapping[str, str],
    ranges: Mapping[str, tuple[str, str]],
    columns: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Equality on ``eq`` (df column -> band column) and ``lo <= value <= hi`` for each of ``ranges``.

    A row that lies in several bands is returned once per band; see :func:`range_lookup_first`.
    """
    used = dict.fromkeys([*eq.values(), *[b for pair in ranges.values() for b in pair], *columns])
    b = bands.select(*[F.col(c).alias(f"__b_{c}") for c in used])
    tests = [F.col(left) == F.col(f"__b_{right}") for left, right in eq.items()]
    tests += [F.col(v).between(F.col(f"__b_{lo}"), F.col(f"__b_{hi}")) for v, (lo, hi) in ranges.items()]
    joined = df.join(b, reduce(lambda x, y: x & y, tests), how)
    kept = [c for c in df.columns if c not in columns]
    return joined.select(*kept, *[F.col(f"__b_{c}").alias(c) for c in columns])


def range_lookup_first(
    df: DataFrame,
    bands: DataFrame,
    key: str,
    eq: Mapping[str, str],
    ranges: Mapping[str, tuple[str, str]],
    columns: Sequence[str],
    order: Sequence[str],
    latest: bool = False,
    widths: Mapping[str, float] | None = None,
) -> DataFrame:
    """One band per ``key``: the smallest (or, with ``latest``, largest) matching band by ``order``.

    Returns only ``key`` and ``columns``, and only keys that match; ``df`` must hold one row per key. With
    ``widths`` (measure -> cell width) bands are looked for on a grid, for classes of many bands.
    """
    needed = list(dict.fromkeys([*columns, *order]))
    asked = df.select(key, *eq, *ranges)
    if widths:
        hits = grid_lookup(asked, bands, eq, ranges, widths, needed)
    else:
        hits = range_lookup(asked, bands, eq, ranges, needed, how="inner")
    pick = F.max_by if latest else F.min_by
    best = pick(F.struct(*columns), F.struct(*order))
    return hits.groupBy(key).agg(best.alias("__b")).select(key, "__b.*")


def newest_bands(bands: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Only the newest row of each identical band: an older one can never win a latest-band lookup."""
    rest = [c for c in bands.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return bands.groupBy(*keys).agg(best.alias("__b")).select(*keys, "__b.*")


def join_on_code_part(
    left: DataFrame, key: str, coded: DataFrame, code: str, columns: Sequence[str], sep: str = "-", n: int = 2
) -> DataFrame:
    """Inner join of ``left.key`` to the number inside ``coded.code``."""
    right = coded.select(code_number(F.col(code), sep, n).alias(key), *columns)
    return left.join(right, on=key, how="inner")


def join_on_norm_key(left: DataFrame, left_key: str, right: DataFrame, right_key: str, columns: Sequence[str]) -> DataFrame:
    """Left join on keys cut at their first hyphen or en dash."""
    r = right.select(norm_key(F.col(right_key)).alias("__nk"), *columns)
    return left.join(r, norm_key(left[left_key]) == F.col("__nk"), "left").drop("__nk")


def keyed_backfill(
    df: DataFrame, sheet: DataFrame, key: str, when_null: str, columns: Mapping[str, str]
) -> DataFrame:
    """Fill ``columns`` (df column -> sheet column) where ``when_null`` is null and the sheet has the key.

    A key the sheet does not hold keeps its values.
    """
    s = sheet.select(
        key, *[F.col(src).alias(f"__s_{dst}") for dst, src in columns.items()], F.lit(True).alias("__hit")
    )
    joined = df.join(s, on=key, how="left")
    fill = F.col(when_null).isNull() & F.col("__hit").isNotNull()
    out = [
        F.when(fill, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in df.columns
    ]
    return joined.select(*out)


def semi_filter(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs in ``keys``: one semi join instead of batches of literal lists."""
    return df.join(keys.select(on), on=on, how="left_semi")


def exists_flag(df: DataFrame, other: DataFrame, key: str, name: str) -> DataFrame:
    """Projected 0/1 flag: does ``key`` occur in ``other``?"""
    marked = other.select(key).distinct().withColumn("__m", F.lit(1))
    return df.join(marked, on=key, how="left").withColumn(name, F.coalesce("__m", F.lit(0))).drop("__m")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Grain check: keys held by more than one row (empty when the grain is right)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
