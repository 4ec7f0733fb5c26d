"""Splits of a read by an id column into parts of about equal numbers of rows.

Steps of equal width, as a reader's lower and upper bound give them, put most rows into one task where ids are not
spread evenly. Bounds from a quantile sketch of the ids follow the rows instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def equi_depth_bounds(df: DataFrame, id_col: str, parts: int, accuracy: int = 10_000) -> list[int]:
    """Ascending ids at which the parts after the first begin; fewer where an id holds more than a part.

    One aggregate over the id column, whose sketch is merged before the shuffle; a bound is off by at most
    ``rows / accuracy``. Null ids do not count. ``df`` may be an earlier copy of what is to be read.
    """
    if parts < 1:
        raise ValueError("at least one part is needed")
    if parts == 1:
        return []
    shares = [k / parts for k in range(1, parts)]
    row = df.select(F.col(id_col).cast("long").alias("id")).agg(F.percentile_approx("id", shares, accuracy).alias("q"), F.min("id").alias("least")).first()
    return sorted({q for q in row["q"] or [] if q > row["least"]})


def split_predicates(id_col: str, bounds: Sequence[int]) -> list[str]:
    """SQL conditions of which every row meets exactly one: null ids go with the first, the ends are open.

    Rows that came since the bounds were taken, below or above all of them, are met too.
    """
    bounds = sorted(set(bounds))
    if not bounds:
        return ["1 = 1"]
    middle = [f"{id_col} >= {a} AND {id_col} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [f"{id_col} < {bounds[0]} OR {id_col} IS NULL", *middle, f"{id_col} >= {bounds[-1]}"]
