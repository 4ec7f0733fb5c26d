"""Mixing sources to target weights by Pfair scheduling.

Every source's rows are put in a stable random order (by a hash of their ids) and cut into blocks. A source with
``a`` of the ``PERIOD`` slots of a period owns blocks ``k = 0, 1, ...`` with release time ``floor(k P / a)`` and
deadline ``ceil((k + 1) P / a)``. In every slot the released block with the earliest deadline is taken, ties by
the source's name. As the shares add up to the period, every block meets its deadline, so after any number of
slots a source is less than one block away from its exact share. The schedule repeats with the period, so it is
worked out once, on as many numbers as the period has slots, and joined to the blocks.

A source that runs out leaves its later slots empty; no row is left out or repeated. Rows read in the order of
``slot`` and ``offset`` are the mixture.

Numbering the rows of a source would bring all of a large source into one task. So they are numbered within
4096 parts of the hash's range or more, by the size of the largest source, and the parts are summed up by a window
over one row per part.

Defined cases: a null source is the source named by the empty text. A row with a null id is ordered by a hash of the
whole row. Rows with equal ids are numbered in the order of such a hash; equal rows may change places, which cannot be
seen. Texts are not looked at, whatever their length. An empty table gives an empty result. Further columns are
returned as they are; those named like a column of the result give way to it. With more than half as many sources as
slots the period grows to twice their number. One row per source goes to the driver.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Slots of a period, which is the resolution of the weights.
PERIOD = 1000
#: Rows of a block.
BLOCK = 16
#: Hexadecimal digits of the hash that number the parts of a source.
DIGITS = 3
#: Rows of a part that are meant at most; larger sources get more digits.
PART_ROWS = 50_000
#: Columns of the result besides those of the rows; columns of these names give way.
OUTPUT = {"share": "int", "block": "long", "slot": "long", "offset": "long"}
#: Power of a source's size that is its weight where none are given: between 0 (all alike) and 1 (as they come).
TEMPER = 0.7


def shares(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Slots per source: one each, the rest by weight with the largest remainders rounded up."""
    if len(weights) > period:
        raise ValueError(f"{len(weights)} sources do not fit in a period of {period} slots")
    names, rest = sorted(weights), period - len(weights)
    total = sum(weights[n] for n in names)
    exact = {n: rest * (weights[n] / total if total > 0 else 1 / len(names)) for n in names}
    slots = {n: int(exact[n]) for n in names}
    late = sorted(names, key=lambda n: (slots[n] - exact[n], n))[: rest - sum(slots.values())]
    return {n: 1 + slots[n] + (n in late) for n in names}


def schedule(slots: Mapping[str, int], period: int) -> list[tuple[str, int, int]]:
    """(source, block within the period, slot), earliest deadline first among the released blocks."""
    waiting = [(0, n, 0) for n in sorted(slots)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    out = []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, n, k = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(k + 1) * period // slots[n]), n, k))
        _, n, k = heapq.heappop(ready)
        out.append((n, k, t))
        if k + 1 < slots[n]:
            heapq.heappush(waiting, ((k + 1) * period // slots[n], n, k + 1))
    return out


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    source_column: str = "source",
    id_column: str = "doc_id",
    block: int = BLOCK,
    period: int = PERIOD,
) -> DataFrame:
    """The rows with ``share`` (slots per period), ``block`` (within the source), ``slot`` and ``offset``.

    ``weights`` are the target weights by source; sources that it lacks get none of it but their one slot.
    Without it a source weighs its number of rows to the power of ``TEMPER``.
    """
    name = F.coalesce(F.col(source_column), F.lit(""))
    counted = docs.groupBy(name.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per source
    sizes = {r["s"]: r["n"] for r in counted}
    kept = [F.col(f"__row.`{c}`") for c in docs.columns if c not in OUTPUT]
    if not sizes:
        empty = docs.select(F.struct("*").alias("__row"))
        return empty.select(*kept, *[F.lit(0).cast(kind).alias(c) for c, kind in OUTPUT.items()])
    period = max(period, 2 * len(sizes))
    wanted = {s: n**TEMPER for s, n in sizes.items()} if weights is None else {s: float(weights.get(s, 0.0)) for s in sizes}
    slots = shares(wanted, period)
    entries = [(s, k, t, slots[s]) for s, k, t in schedule(slots, period)]  # as many rows as the period has slots
    plan = docs.sparkSession.createDataFrame(entries, "__s string, __k int, __t int, share int").coalesce(1)

    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    # Rows without an id are ordered by a hash of the whole row, so that they do not all meet in one part.
    digest = F.md5(F.coalesce(F.col(id_column).cast("string"), whole.cast("string")).cast("binary"))
    digits = max(DIGITS, math.ceil(math.log(max(sizes.values()) / PART_ROWS, 16)))
    rows = docs.select(F.struct("*").alias("__row"), name.alias("__s"), digest.alias("__h"), F.col(id_column).alias("__id"), whole.alias("__tie"))
    rows = rows.withColumn("__part", F.substring("__h", 1, digits))
    parts = rows.groupBy("__s", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__s").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__s", "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    inside = Window.partitionBy("__s", "__part").orderBy("__h", "__id", "__tie")
    rank = F.col("__base") + F.row_number().over(inside) - 1
    rows = rows.join(parts, ["__s", "__part"]).withColumn("__rank", rank)
    sized = F.broadcast(plan.select("__s", "share").distinct())
    rows = rows.join(sized, "__s").withColumn("block", F.floor(F.col("__rank") / block))
    rows = rows.withColumn("__k", (F.col("block") % F.col("share")).cast("int")).join(F.broadcast(plan.drop("share")), ["__s", "__k"])
    return rows.select(
        *kept, "share", "block", (F.floor(F.col("block") / F.col("share")) * period + F.col("__t")).alias("slot"), (F.col("__rank") % block).alias("offset")
    )
