"""Connected components of a link table: links contracted chunk by chunk, then alternating star operations in shuffles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.llm.common import cut

#: Links that a task contracts at a time, and that a partition of few links is filled up to.
CHUNK = 1 << 16


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star operation: hang the neighbours of a node on the smallest of them and the node.

    ``large`` moves the larger neighbours, else the smaller ones and the node itself. The smallest neighbour
    comes from an aggregate and a join, so that no node's neighbours are gathered in one row.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    if large:
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = both.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.union(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def contracted(batch: pa.RecordBatch | pa.Table) -> pa.RecordBatch:
    """Links ``(a, b)`` of every node of the given ones to the smallest node that they connect it to."""
    ends = [pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c for c in (batch.column("a"), batch.column("b"))]
    nodes = pc.unique(pa.concat_arrays(ends))
    nodes = nodes.take(pc.sort_indices(nodes))
    a, b = (pc.index_in(end, nodes).to_numpy() for end in ends)
    root = np.arange(len(nodes), dtype=np.int32)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        left = low != high
        a, b, low, high = a[left], b[left], low[left], high[left]
        np.minimum.at(root, high, low)
        while not np.array_equal(root, up := root[root]):
            root = up
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([nodes.take(pa.array(moved)), nodes.take(pa.array(root[moved]))], names=["a", "b"])


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= CHUNK:
            yield contracted(pa.Table.from_batches(held))
            held = []
    if held:
        yield contracted(pa.Table.from_batches(held))


def _together(df: DataFrame, rows: int) -> DataFrame:
    """Few rows in few partitions, without a shuffle."""
    return df.coalesce(max(1, -(-2 * rows // CHUNK)))


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; root is the smallest node it is connected to.

    Tasks first replace chunks of links by those of each node to the smallest one it reaches in its chunk, so that
    what is left has few steps to go. Each round is written to the shared checkpoint folder, so the plan does not grow
    and a lost executor costs one round. Rounds are of the order of the logarithm of a component's size.
    """
    measure = (F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    now = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now = cut(_together(now, now.count()).mapInArrow(_contract, now.schema).distinct())
    mark = now.agg(*measure).first()
    while mark[0]:
        moved = _together(_star(_together(now, mark[0]), large=True), mark[0])
        now = cut(_together(_star(moved, large=False), mark[0]))
        fresh = now.agg(*measure).first()
        if fresh == mark:
            break
        mark = fresh
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def connected_rows(linked: np.ndarray) -> np.ndarray:
    """The least row of its component for each row (visitors first, then residents) of a two-sided graph."""
    rows, columns = linked.shape
    left, right = np.arange(rows), np.full(columns, rows + columns)
    while True:
        right = np.minimum(right, np.where(linked, left[:, None], rows + columns).min(axis=0))
        after = np.minimum(left, np.where(linked, right[None, :], rows + columns).min(axis=1))
        if (after == left).all():
            return np.concatenate([left, right])
        left = after
