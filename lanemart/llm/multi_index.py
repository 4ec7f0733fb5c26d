"""Near-duplicate vectors of one label, by an inverted multi-index.

1. Codebooks: a sample of at most ``SAMPLE`` vectors (those of the smallest hashes) is cut into halves, and k-means
   finds centroids for the left and for the right halves on their own. A pair of centroids is a cell of the product
   grid. Their number follows from the number of vectors, so that a cell of all labels holds about ``CELL_ROWS``.
2. Index: every vector is filed under its label and nearest cell. Equal vectors of a label are one node, with the
   number of them, so groups of copies of any size cost one node from here on.
3. Search: every node visits cells in the order of multi-sequence traversal (growing sum of squared distances of the
   halves), from the nearest until the sum exceeds the nearest one's by ``stop``. ``stop`` is calibrated on the sample:
   it is the least value at which a share ``RECALL`` of pairs exactly at the threshold (sampled vectors, moved in
   random directions), and of the sampled pairs above it, meet in at least one of the two directions.
4. Verification: visitors and residents of a cell are compared by matrix products in double precision. A cell of many
   nodes is dealt into tiles of about ``TILE`` visitors by ``TILE`` residents, so no task has to hold a cell. All pairs
   of a tile are compared, but none leaves it: nodes do, with the number of vectors they are linked to (a pair that
   meets in both directions counts in one of them), and as many links as connect what the tile connects.
5. Components of those links, by star operations.

Defined cases: a vector that is null, empty or zero, or has null or non-finite components, or of which the label or the
id is null, links with nothing; without an id it keeps a row with a null component and is kept. Vectors of different
lengths do not link. Repeated rows are equal vectors and link with each other; rows that share an id are vectors of
their own. An empty table gives an empty result. Further columns do not matter.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.llm.common import broadcast_if_small, cut
from lanemart.llm.components import components, connected_rows

#: Vectors that codebooks and calibration see, and nodes for which a cell of the grid is meant.
SAMPLE, CELL_ROWS = 4096, 2048
#: Centroids of a half at most, and rounds of k-means.
CENTROIDS, ROUNDS = 1024, 12
#: Share of pairs at the threshold that meet.
RECALL = 0.999
#: Visitors, and residents, of a tile; dealt tiles up to which a table of crowded cells is broadcast (24 bytes each).
TILE, BROADCAST_ROWS = 1024, 500_000
#: A group of copies is heavy above this fraction of the rows.
HEAVY = 1024


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that squares neither overflow nor vanish."""
    wide = np.asarray(vectors, dtype=np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every centre."""
    return np.maximum((points**2).sum(axis=1)[:, None] - 2 * points @ centres.T + (centres**2).sum(axis=1), 0)


def k_means(points: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` centres; the first ones far from each other, so that no group of near points takes them all."""
    rng = np.random.default_rng(0)
    centres = points[:1]
    while len(centres) < k:
        far = squared(points, centres).min(axis=1)
        if far.sum() <= 0:
            break
        more = rng.choice(len(points), min(max(1, k // 8), k - len(centres)), p=far / far.sum())
        centres = np.concatenate([centres, points[np.unique(more)]])
    for _ in range(ROUNDS):
        own = squared(points, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        sizes = np.bincount(own, minlength=len(centres))
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def traverse(left: np.ndarray, right: np.ndarray, stop: float) -> Iterator[tuple[int, int, float]]:
    """Multi-sequence traversal: cells ``(i, j)`` by growing ``left[i] + right[j]``, up to ``stop`` above the least."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    least = left[a[0]] + right[b[0]]
    queue, pushed = [(least, 0, 0)], {(0, 0)}
    while queue:
        cost, i, j = heapq.heappop(queue)
        if cost > least + stop:
            return
        yield int(a[i]), int(b[j]), float(cost - least)
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in pushed:
                pushed.add((x, y))
                heapq.heappush(queue, (left[a[x]] + right[b[y]], x, y))


class MultiIndex:
    """Two codebooks, and how far a search goes."""

    def __init__(self, sample: np.ndarray, centroids: int, threshold: float, recall: float = RECALL):
        units = unit_rows(sample)
        self.half = units.shape[1] // 2
        self.books = [k_means(part, centroids) for part in (units[:, : self.half], units[:, self.half :])]
        self.stop = self.calibrate(units, threshold, recall)

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return squared(units[:, : self.half], self.books[0]), squared(units[:, self.half :], self.books[1])

    def home(self, units: np.ndarray) -> np.ndarray:
        """The nearest cell's number."""
        left, right = self.distances(units)
        return left.argmin(axis=1) * len(self.books[1]) + right.argmin(axis=1)

    def visits(self, units: np.ndarray) -> list[list[int]]:
        """Numbers of the cells that each vector's search looks at, the nearest first."""
        left, right = self.distances(units)
        wide = len(self.books[1])
        return [[i * wide + j for i, j, _ in traverse(a, b, self.stop)] for a, b in zip(left, right)]

    def detours(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How far beyond its nearest cell a search from either vector of a pair goes to meet the other."""
        out = []
        for a, b in ((one, other), (other, one)):
            left, right = self.distances(a)
            at, n = self.home(b), np.arange(len(a))
            out.append(left[n, at // len(self.books[1])] + right[n, at % len(self.books[1])] - left.min(axis=1) - right.min(axis=1))
        return np.minimum(*out)

    def calibrate(self, units: np.ndarray, threshold: float, recall: float) -> float:
        rng = np.random.default_rng(1)
        away = rng.standard_normal(units.shape)
        away -= (away * units).sum(axis=1, keepdims=True) * units
        size = np.sqrt((away * away).sum(axis=1, keepdims=True))
        moved = threshold * units + math.sqrt(1 - threshold**2) * away / np.where(size > 0, size, 1)
        stop = float(np.quantile(self.detours(units, moved), recall))
        a, b = [], []
        for k in range(0, len(units), 512):
            x, y = np.nonzero(units[k : k + 512] @ units[k:].T >= threshold)
            keep = (x < y) & (np.arange(len(x)) % max(1, len(x) // 8192) == 0)
            a.append(x[keep] + k)
            b.append(y[keep] + k)
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            stop = max(stop, float(np.quantile(self.detours(units[a], units[b]), recall)))
        return stop


def _sample(valid: DataFrame, rows: int) -> np.ndarray:
    """Up to ``SAMPLE`` of so many vectors, by hashes of ids; what is far above the last of them is not sorted."""
    h = F.xxhash64("id", "label")
    share = min(1.0, 2 * SAMPLE / rows)
    some = valid.filter(h <= F.lit(int((share - 0.5) * (1 << 63)) * 2 - 1)) if share < 1 else valid
    return np.array([r[0] for r in some.orderBy(h, "id", "label", "vec").limit(SAMPLE).select("vec").collect()], dtype=np.float64)


def _as_matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _filed(valid: DataFrame, indexes: dict[int, MultiIndex]) -> DataFrame:
    """Every vector with a digest of it, its home and the cells that its search visits."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = np.array([len(v) for v in batch.column("vec")])
            for size in np.unique(sizes):
                part = table.filter(pa.array(sizes == size)).combine_chunks().to_batches()[0]
                raw = _as_matrix(part.column("vec"))
                units, index = unit_rows(raw), indexes[int(size)]
                # Adding zero makes one of the two zeros.
                digests = [xxhash.xxh3_128_digest((r + 0.0).tobytes()) for r in raw]
                columns = [part.column("id"), part.column("label"), part.column("vec"), pa.array(digests, pa.binary())]
                columns += [pa.array(index.home(units), pa.int64()), pa.array(index.visits(units), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "vec", "digest", "home", "visits"])

    kinds = {c: valid.schema[c].dataType.simpleString() for c in ("id", "label", "vec")}
    out = "id {id}, label {label}, vec {vec}, digest binary, home bigint, visits array<bigint>".format(**kinds)
    return valid.mapInArrow(each, out)


def _tiled(nodes: DataFrame) -> DataFrame:
    """Residents (``side`` 0) and visitors (1) of every cell, with their tile."""
    group = ["label", "size", "cell"]
    kept = ["node", "copies", "vec", "home"]
    rows = nodes.select("label", F.size("vec").alias("size"), *kept, "visits")
    own = rows.select("label", "size", F.col("home").alias("cell"), F.lit(0).alias("side"), *kept, "visits")
    # What else a visitor visits does not matter in the cell that it visits.
    guests = rows.select("label", "size", F.explode("visits").alias("cell"), F.lit(1).alias("side"), *kept)
    met = own.unionByName(guests, allowMissingColumns=True)
    sizes = met.groupBy(*group).agg(F.count_if(F.col("side") == 0).alias("here"), F.count_if(F.col("side") == 1).alias("come"))
    tiles = sizes.select(*[F.col(c).alias(f"__{c}") for c in group], *[F.ceil(F.col(c) / TILE).cast("int").alias(f"{c}_tiles") for c in ("here", "come")])
    tiles = tiles.filter("here_tiles > 1 or come_tiles > 1")
    on = [met[c] == F.col(f"__{c}") for c in group]
    dealt = met.join(broadcast_if_small(tiles, BROADCAST_ROWS), on, "left")
    here, come = (F.coalesce(c, F.lit(1)) for c in ("here_tiles", "come_tiles"))
    resident = F.col("side") == 0
    mine = F.pmod(F.xxhash64("node", F.lit(TILE)), F.when(resident, here).otherwise(come)).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.when(resident, come).otherwise(here) - 1))
    dealt = dealt.select(*met.columns, mine.alias("mine"), others.alias("theirs"))
    row, column = (F.when(F.col("side") == s, F.col("mine")).otherwise(F.col("theirs")) for s in (0, 1))
    return dealt.select(*met.columns, row.alias("row"), column.alias("col"))


def _verify(threshold: float):
    def each(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        here, come = (table.filter(pa.array(side == s)).combine_chunks() for s in (0, 1))
        nodes, links, tops = (np.zeros(0, dtype=np.int64) for _ in range(3))
        if len(here) and len(come):
            own = [t.column("node").to_numpy() for t in (come, here)]
            units = [unit_rows(_as_matrix(t.column("vec").combine_chunks())) for t in (come, here)]
            linked = (units[0] @ units[1].T >= threshold) & (own[0][:, None] != own[1][None, :])
            # A resident that visits the visitor's home counts the pair there.
            home, there = come.column("home").to_numpy(), np.zeros(linked.shape, dtype=bool)
            for k in np.flatnonzero(linked.any(axis=0)):
                there[:, k] = np.isin(home, here.column("visits")[int(k)].as_py())
            come_copies, here_copies = (t.column("copies").to_numpy() for t in (come, here))
            met = np.concatenate([linked.any(axis=1), linked.any(axis=0)])
            links = np.concatenate([linked @ here_copies, come_copies @ (linked & ~there)])[met]
            both = np.concatenate(own)
            nodes, tops = both[met], both[connected_rows(linked)[met]]
        return pa.table({"node": pa.array(nodes), "links": pa.array(links), "top": pa.array(tops)})

    return each


def indexes_for(valid: DataFrame, threshold: float) -> dict[int, MultiIndex]:
    """An index for every length of vectors, from a sample of them."""
    found = {}
    for size, rows in valid.groupBy(F.size("vec")).count().collect():
        centroids = min(CENTROIDS, max(1, math.isqrt(rows // CELL_ROWS)))
        found[size] = MultiIndex(_sample(valid.filter(F.size("vec") == size), rows), centroids, threshold)
    return found


def near_vectors(
    rows: DataFrame, threshold: float = 0.93, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id`` (smallest id reachable), ``kept`` (is it that one)."""
    picked = rows.select(F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & ~odd & F.exists("vec", lambda x: x != 0), F.lit(False))
    valid = picked.filter(fine)
    filed = cut(_filed(valid, indexes_for(valid, threshold)).withColumn("at", F.monotonically_increasing_id()))
    groups = filed.groupBy("label", "digest").agg(F.min(F.struct("id", "at")).alias("first"), F.count(F.lit(1)).alias("copies"))
    groups = cut(groups.select("label", "digest", F.col("first.id").alias("least"), F.col("first.at").alias("node"), "copies"))
    nodes = groups.select("node", "copies").join(filed.drop("id", "digest"), F.col("node") == F.col("at"))
    tiles = _tiled(nodes).groupBy("label", "size", "cell", "row", "col")
    met = cut(tiles.applyInArrow(_verify(threshold), "node bigint, links bigint, top bigint"))
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("node").alias("a"), F.col("top").alias("b")))
    known = groups.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    known = cut(known.select("label", "digest", "least", "root", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(smallest, "root").select("label", "digest", "copies", "n_links", "component_id")
    linked = _by_group(filed.select("id", "label", "digest"), known)
    alone = picked.filter(~fine).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.union(alone)
    return every.select(F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _by_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with what is known of their group of copies; at most ``HEAVY`` groups can hold over 1/HEAVY of the rows."""
    on, out = ["label", "digest"], ["n_links", "component_id"]
    total = groups.agg(F.sum("copies")).first()[0] or 0
    heavy = groups.filter(F.col("copies") * HEAVY > total)
    named = heavy.select(*[F.col(c).alias(f"__{c}") for c in on], *out)
    met = rows.join(F.broadcast(named), [rows[c] == named[f"__{c}"] for c in on], "left")
    rest = met.filter("__digest is null").select("id", *on).join(groups.filter(F.col("copies") * HEAVY <= total), on)
    return met.filter("__digest is not null").select("id", *out).union(rest.select("id", *out))
