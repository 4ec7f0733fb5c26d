"""Near-duplicates by SimHash: fingerprints, pigeonhole blocks, verified Hamming distances, components.

1. A fingerprint per document: XXH64 (UTF-8, seed 42) of every word shingle, repeats included; a bit is 1 if it
   is set in over half of them.
2. Equal fingerprints become one node, so groups of copies of any size cost one row from here on.
3. Pigeonhole: the 64 bits are cut into ``distance + BLOCKS_MORE`` blocks. Of two fingerprints within
   ``distance`` bits at least ``BLOCKS_MORE`` blocks are equal, so for every choice of ``BLOCKS_MORE`` blocks
   the fingerprints are joined on the bits in them, and each joined pair is verified.
4. A bucket of the join with more than ``CROWD`` nodes (many near copies of one text) would give pairs with the
   square of its size. For those an exact way of linear size: two fingerprints are within ``distance`` bits
   exactly if some value is within half of it of both, so each node is joined to the values around it, and
   linked to the smallest node that meets it there. Those links connect the same nodes as all pairs would.
5. Components of the links, by star operations.

``near_groups`` reports such groups. ``deduplicate`` drops near copies of which the sets of shingles have a Jaccard
similarity of ``SIMILARITY`` or more, and keeps the smallest id of every group that such pairs connect:

0. Documents of equal sets become one node. Nodes are linked by their fingerprints of five-word shingles as in
   ``near_groups``, by blocks and verified distances of at most ``DISTANCE`` bits; a link counts if the two sets are similar
   enough. Sets at 0.8 differ in more bits for the most part, which the further steps are for.
1. A node has ``BANDS * ROWS`` MinHash values; nodes that agree on all
   values of a band share a bucket. A pair at 0.8 misses all buckets with a probability of 10^-6.
2. A pair counts only if the similarity of its two sets, as 64-bit hashes of shingles, is high enough. Before, pairs
   go whose MinHash values agree five standard deviations too seldom.
3. A bucket that is in one component already gives no pairs. In a bucket of more than ``MEET`` nodes all meet
   ``PIVOTS`` of them, which joins groups of copies of any size. Where at most ``MEET`` nodes are then outside the
   largest component, those meet all others.
4. Nodes of other buckets (a passage in many texts) are compared by prefixes: if shingles are ordered by the number
   of components that have them, a pair that is similar enough shares one of the first ``n - ceil(similarity * n) + 1``
   of both its sets. Shingles of one component cannot link two, so what a template adds is not looked at.
5. Buckets of a shared shingle with more than ``MEET`` nodes outside the largest component (texts a little below the
   threshold to many others) are dealt into tiles of bounded size, in which all sets are compared exactly. A tile gives
   the links that connect its similar nodes, not its pairs; its work grows with nodes outside times nodes.

Steps 3 to 5 are a fixed number of jobs, whatever the data.

Defined cases: null text counts as empty and has fingerprint zero, which is linked like any other. Repeated
rows each get their row. A null id never becomes a representative unless all ids of a component are null. An
empty table gives an empty result. Further columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanemart.llm.common import broadcast_if_small, cut, forget, text_batches
from lanemart.llm.components import components, connected_rows

BITS = 64
#: Blocks that have to be equal, besides the ``distance`` blocks that may differ.
BLOCKS_MORE = 3
#: Nodes in a bucket up to which its pairs are joined directly.
CROWD = 64
#: ``deduplicate``: bits in which fingerprints of near copies differ at most, to be linked by them.
DISTANCE = 3
#: ``deduplicate``: least similarity, MinHash bands, and values in each.
SIMILARITY, BANDS, ROWS = 0.8, 26, 4
#: Nodes of a crowded bucket that meet all others of it. A node is in ``BANDS`` buckets, so it meets several.
PIVOTS = 1
#: Nodes, and hashes of sets, on a side of a tile; columns of a matrix at a time.
TILE, TILE_HASHES, COLUMNS = 256, 1 << 20, 2048
#: Members of a bucket of ``deduplicate`` up to which its pairs are joined there.
MEET = 32
#: Components up to which a shingle they share counts as rare in prefixes; the order is the same for any number.
WIDE = 64
#: Dropped ids up to which they are broadcast.
BROADCAST_ROWS = 1_000_000
#: Shingles hashed at a time, so that a very long text needs no more memory than a short one.
CHUNK = 65_536


def shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    """Space-joined runs of ``size`` words; fewer words make one shingle, none make none."""
    if len(words) < size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[k:] for k in range(size))))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()  # bytes: A-Z only, and splits at ASCII white space only


def ones_of(hashes: np.ndarray) -> np.ndarray:
    """For each bit the number of hashes that have it."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(ones: np.ndarray, total: int) -> int:
    """The bits that are set in over half of so many hashes, as a signed 64-bit integer."""
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.int64)[0])


def fingerprint(text: str | None, size: int) -> int:
    """SimHash of one text as a signed 64-bit integer."""
    words = words_of(text)
    ones, total = np.zeros(BITS, dtype=np.int64), max(1, len(words) - size + 1) if words else 0
    digest, left = xxhash.xxh64_intdigest, shingles(words, size)
    for start in range(0, total, CHUNK):
        n = min(CHUNK, total - start)
        ones += ones_of(np.fromiter((digest(s, 42) for _, s in zip(range(n), left)), dtype=np.uint64, count=n))
    return majority(ones, total)


def fingerprints(docs: DataFrame, id_column: str, text_column: str, size: int) -> DataFrame:
    """``(id, fp)`` per row of the documents."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), size) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    return text_batches(rows).mapInArrow(each, f"id {docs.schema[id_column].dataType.simpleString()}, fp long")


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def _masks(parts: int, equal: int) -> list[int]:
    """For each choice of ``equal`` of so many blocks the mask of their bits."""
    edges = [BITS * k // parts for k in range(parts + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [_signed(sum(chosen)) for chosen in combinations(blocks, equal)]


def _keys(fp: Column, masks: list[int]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(k).alias("k"), fp.bitwiseAND(F.lit(m)).alias("v")) for k, m in enumerate(masks)]))


def _flips(distance: int) -> list[int]:
    """All masks of up to ``distance`` bits."""
    return [_signed(sum(1 << b for b in bits)) for n in range(distance + 1) for bits in combinations(range(BITS), n)]


def _flipped(nodes: DataFrame, distance: int) -> DataFrame:
    """Rows ``(fp, at)``: every value ``at`` within ``distance`` bits of a node.

    The masks are one literal: as an expression each, two bits' 2081 of them are planned and compiled by the driver.
    """
    masks = F.split(F.lit(" ".join(map(str, _flips(distance)))), " ").cast("array<bigint>")
    return nodes.select("fp", F.explode(masks).alias("mask")).select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("at"))


def _around(crowded: DataFrame, distance: int) -> DataFrame:
    """Links of nodes to the smallest node within ``distance`` by way of a value that lies between them.

    Of two nodes within ``distance``, some value is within half of it, rounded down, of the one and within the
    rest of it of the other. So the smallest node is found among those near a value, and the others join from
    the larger radius.
    """
    low, high = distance // 2, distance - distance // 2
    near = _flipped(crowded, low)
    least = near.groupBy("at").agg(F.min("fp").alias("b"))
    far = near
    if high != low:
        far = _flipped(crowded, high)
    return far.join(least, "at").select(F.col("fp").alias("a"), "b")


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints within ``distance`` bits that connect all such pairs."""
    masks = _masks(distance + BLOCKS_MORE, BLOCKS_MORE)
    keyed = nodes.select("fp", _keys(F.col("fp"), masks).alias("key")).select("fp", "key.k", "key.v")
    sizes = keyed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = cut(keyed.join(sizes, ["k", "v"]))
    small, crowded = shared.filter(F.col("n") <= CROWD), shared.filter(F.col("n") > CROWD).select("fp").distinct()
    left, right = small.select("k", "v", F.col("fp").alias("a")), small.select("k", "v", F.col("fp").alias("b"))
    pairs = left.join(right, ["k", "v"]).filter("a > b").select("a", "b").union(_around(crowded, distance))
    return pairs.filter((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)).distinct()


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 3, distance: int = 2
) -> DataFrame:
    """One row per document: id, ``fingerprint`` (hex), ``component_id`` (smallest id reachable)."""
    rows = cut(fingerprints(docs, id_column, text_column, size))
    nodes = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    # Nodes with a link, and the smallest id in their component; all others stand for themselves.
    rooted = components(links(nodes, distance))
    roots = rooted.join(nodes, rooted["node"] == nodes["fp"]).select("fp", "root", "least")
    own = roots.select(F.col("root").alias("top")).distinct().join(nodes, F.col("top") == nodes["fp"]).select("fp", F.col("fp").alias("root"), "least")
    members = cut(roots.union(own))
    smallest = members.groupBy("root").agg(F.min("least").alias("smallest"))
    linked = members.join(smallest, "root").select("fp", "smallest")
    labels = nodes.join(linked, "fp", "left").select("fp", F.coalesce("smallest", "least").alias("component_id"))
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def shingle_set(text: str | None, size: int) -> tuple[np.ndarray, int]:
    """Distinct hashes of the shingles in order, and the fingerprint; a text without words has the hash of an empty one."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, 42) for s in shingles(words_of(text), size)), dtype=np.uint64)
    ones = sum((ones_of(hashes[k : k + CHUNK]) for k in range(0, len(hashes), CHUNK)), np.zeros(BITS, dtype=np.int64))
    own = np.unique(hashes) if len(hashes) else np.array([xxhash.xxh64_intdigest(b"", 42)], dtype=np.uint64)
    return own, majority(ones, len(hashes))


_FACTORS = np.random.default_rng(11).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhash(hashes: np.ndarray) -> np.ndarray:
    """The least hash of a set under each of ``BANDS * ROWS`` bijections."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    hashes = hashes ^ (hashes >> np.uint64(31))
    for k in range(0, len(hashes), 512):
        np.minimum(least, (hashes[k : k + 512, None] * _FACTORS).min(axis=0), out=least)
    return least


def _set_rows(docs: DataFrame, id_column: str, text_column: str, size: int, whole: bool) -> DataFrame:
    """``(id, digest)`` and the hashes of the set if ``whole``, else its MinHash values as bytes, its bands' keys, and the fingerprint."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, values, keys, fps = [], [], [], []
            for text in batch.column(1):
                own, fp = shingle_set(text.as_py(), size)
                digests.append(xxhash.xxh128_digest(own.tobytes()))
                if whole:
                    values.append(own.view(np.int64))
                    continue
                least = minhash(own)
                values.append(least.astype(np.uint8).tobytes())
                keys.append([xxhash.xxh64_intdigest(b.tobytes(), n) for n, b in enumerate(least.reshape(BANDS, ROWS))])
                fps.append(fp)
            columns = [batch.column(0), pa.array(digests, pa.binary())]
            if whole:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(values, pa.list_(pa.int64()))], names=["id", "digest", "hashes"])
            else:
                keys = np.array(keys, dtype=np.uint64).view(np.int64).tolist()
                columns += [pa.array(values, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(fps, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "values", "keys", "fp"])

    kind = docs.schema[id_column].dataType.simpleString()
    more = "hashes array<long>" if whole else "values binary, keys array<long>, fp long"
    return text_batches(rows).mapInArrow(each, f"id {kind}, digest binary, {more}")


class Linker:
    """The links between nodes found so far, and the components that they make."""

    def __init__(self, values: DataFrame, sets: DataFrame, similarity: float):
        self.values, self.sets, self.similarity = values, sets, similarity
        self.roots = None

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` whose sets are similar enough."""
        n, s = BANDS * ROWS, self.similarity
        least = n * s - 5 * math.sqrt(n * s * (1 - s))

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, n) for k in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array((left == right).sum(axis=1) >= least))

        a, b = (self.values.select(F.col("id").alias(c), F.col("values").alias(f"values_{c}")) for c in "ab")
        met = pairs.select("a", "b").distinct().join(a, "a").join(b, "b").select("a", "b", "values_a", "values_b")
        likely = cut(met.mapInArrow(each, pairs.select("a", "b").schema))
        forget(met.sparkSession)
        a, b = (self.sets.select(F.col("id").alias(c), F.col("hashes").alias(f"hashes_{c}")) for c in "ab")
        both = F.size(F.array_intersect("hashes_a", "hashes_b"))
        enough = both * (1 + s) >= (F.size("hashes_a") + F.size("hashes_b")) * s - 1e-9
        return likely.join(a, "a").join(b, "b").filter(enough).select("a", "b")

    def add(self, links: DataFrame) -> None:
        """Join components by further links. Those before are one link per node to its root, so the graph stays small."""
        if self.roots is not None:
            links = links.union(self.roots.select("node", "root"))
        self.roots = components(links)
        forget(links.sparkSession)

    def labelled(self, rows: DataFrame) -> DataFrame:
        """Rows ``(path, at, id)`` with the component of the node."""
        rows = rows.select("path", "at", "id")
        if self.roots is None:
            return rows.withColumn("comp", F.col("id"))
        return rows.join(self.roots, rows["id"] == self.roots["node"], "left").select(*rows.columns, F.coalesce("root", "id").alias("comp"))

    def measured(self, rows: DataFrame) -> DataFrame:
        """Rows of buckets of several components, with ``n`` nodes, the largest component, and nodes ``outside`` of it."""
        parts = self.labelled(rows)
        each = parts.groupBy("path", "comp").agg(F.count(F.lit(1)).alias("m"))
        sizes = each.groupBy("path").agg(F.sum("m").alias("n"), F.max(F.struct("m", "comp")).alias("main"))
        sizes = sizes.select("path", "n", F.col("main.comp").alias("main"), (F.col("n") - F.col("main.m")).alias("outside"))
        return cut(parts.join(sizes.filter("outside > 0"), "path"))

    @staticmethod
    def few(live: DataFrame) -> DataFrame:
        """Pairs of buckets with at most ``MEET`` nodes outside the largest component: those and all others."""
        rows = live.filter(F.col("outside") <= MEET)
        outside = rows.filter("comp <> main").select("path", F.col("id").alias("x"), F.col("comp").alias("own"))
        pairs = rows.join(outside, "path").filter("comp <> own and (comp = main or id < x)")
        return pairs.select(F.greatest("id", "x").alias("a"), F.least("id", "x").alias("b"))

    @staticmethod
    def pivoted(live: DataFrame) -> DataFrame:
        """Pairs of every node of the other buckets with ``PIVOTS`` of its bucket.

        Pivots are the nodes that are in most of these buckets: of a group of near copies those in its middle, to which
        more of the others are similar than to one of its edge.
        """
        rows = live.filter(F.col("outside") > MEET)
        rows = rows.join(rows.groupBy("id").agg(F.count(F.lit(1)).alias("held")), "id")
        chosen = [F.max(F.struct("held", F.xxhash64("id", F.lit(k)).alias("h"), "id"))["id"] for k in range(PIVOTS)]
        pivots = rows.groupBy("path").agg(F.array_distinct(F.array(*chosen)).alias("b")).select("path", F.explode("b").alias("b"))
        return rows.join(pivots, "path").filter("id <> b").select(F.greatest("id", "b").alias("a"), F.least("id", "b").alias("b"))

    def prefixes(self, rows: DataFrame) -> DataFrame:
        """Rows ``(path, at, id)`` of a bucket per shingle of the nodes' prefixes.

        Shingles are ordered by the number of components that have them; those of one component cannot link two.
        Those of more than ``WIDE`` components come last, and are only looked at where a prefix reaches them.
        """
        nodes = self.labelled(rows).select("id", "comp").distinct().join(self.sets, "id")
        each = cut(nodes.select("id", "comp", F.size("hashes").alias("n"), F.explode("hashes").alias("t")))
        wide = cut(each.groupBy("t", "comp").agg(F.lit(1)).groupBy("t").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"))
        rare, common = wide.filter(F.col("c") <= WIDE), wide.filter(F.col("c") > WIDE)
        own = each.select("id", "n", "t").join(common, "t", "left_anti").join(rare, "t", "left")
        listed = F.sort_array(F.collect_list(F.when(F.col("c").isNotNull(), F.struct("c", "t"))))
        held = cut(own.groupBy("id", "n").agg(F.count(F.lit(1)).alias("r"), listed.alias("shared")))
        length = F.col("n") - F.ceil(F.col("n") * self.similarity - 1e-9) + 1
        first = held.select("id", "shared", (length - F.col("r") + F.size("shared")).cast("int").alias("room"))
        whole = each.select("id", "n").distinct().join(held.select("id", "r"), "id", "left")
        short = whole.select("id", (length - F.coalesce("r", F.lit(0))).cast("int").alias("room")).filter("room > 0")
        late = each.select("id", "t").join(short, "id").join(common, "t").groupBy("id", "room").agg(listed.alias("shared"))
        taken = first.filter("room > 0").unionByName(late.select("id", "shared", "room"))
        return taken.select(F.explode(F.slice("shared.t", F.lit(1), F.col("room"))).alias("path"), F.lit(0).alias("at"), "id")

    def tiled(self, live: DataFrame) -> DataFrame:
        """Links in buckets with more than ``MEET`` nodes outside the largest component, verified where they meet.

        Nodes outside meet all, in tiles of bounded bytes; a tile compares its sets by products of incidence matrices
        and gives the links that connect what is similar in it, not its pairs.
        """
        rows = live.filter(F.col("outside") > MEET).select("path", "id", "comp", "main").join(self.sets, "id")
        sizes = rows.groupBy("path").agg(*[F.sum(F.when(c, F.lit(1))).alias(f"{n}_rows") for n, c in (("all", F.lit(True)), ("out", F.expr("comp <> main")))], F.sum(F.size("hashes")).alias("held"))
        blocks = sizes.select(
            F.col("path").alias("of"),
            *[F.ceil(F.greatest(F.col(f"{n}_rows") / TILE, F.col("held") / TILE_HASHES)).cast("int").alias(f"{n}_blocks") for n in ("all", "out")],
        )
        met = rows.join(blocks, F.col("path") == F.col("of"))
        mine = lambda n: F.pmod(F.xxhash64("id", F.lit(n)), F.col(f"{n}_blocks"))
        upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"{n}_blocks").cast("bigint") - 1))
        kept = ["path", "id", "comp", "hashes"]
        every = met.select(*kept, F.lit(0).alias("side"), mine("all").alias("col"), upto("out").alias("row"))
        outer = met.filter("comp <> main").select(*kept, F.lit(1).alias("side"), upto("all").alias("col"), mine("out").alias("row"))
        kind = live.schema["id"].dataType.simpleString()
        return every.union(outer).groupBy("path", "row", "col").applyInArrow(_similar(self.similarity), f"a {kind}, b {kind}")

    def link_all(self, buckets: DataFrame) -> None:
        """All links of nodes that share a bucket. The number of steps does not depend on the data."""
        spark = buckets.sparkSession
        live = self.measured(buckets.withColumn("at", F.lit(-1)))
        self.add(self.verified(self.few(live).union(self.pivoted(live))))
        live = self.measured(live.filter(F.col("outside") > MEET))
        forget(spark)
        parted = self.measured(self.prefixes(live.filter(F.col("outside") > MEET)))
        forget(spark)
        self.add(self.verified(self.few(live).union(self.few(parted))).union(self.tiled(parted)))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of every set of the one list with every set of the other."""
    parts = []
    for sets in (left, right):
        parts.append((np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)))
    common = np.intersect1d(parts[0][1], parts[1][1])
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    placed = []
    for owner, values in parts:
        at = np.minimum(np.searchsorted(common, values), max(0, len(common) - 1))
        held = common[at] == values if len(common) else np.zeros(len(values), dtype=bool)
        order = np.argsort(at[held], kind="stable")
        placed.append((owner[held][order], at[held][order]))
    for start in range(0, len(common), COLUMNS):
        grids = []
        for (owner, at), sets in zip(placed, (left, right)):
            lo, hi = np.searchsorted(at, [start, start + COLUMNS])
            grid = np.zeros((len(sets), COLUMNS), dtype=np.float32)
            grid[owner[lo:hi], at[lo:hi] - start] = 1
            grids.append(grid)
        out += grids[0] @ grids[1].T
    return out


def _similar(similarity: float):
    def each(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        every, outer = (table.filter(pa.array(side == s)) for s in (0, 1))
        ids = [*outer.column("id").to_pylist(), *every.column("id").to_pylist()]
        links: list[tuple] = []
        if len(every) and len(outer):
            sets = [[np.asarray(h.values) for h in t.column("hashes")] for t in (outer, every)]
            n = [np.array([len(s) for s in x], dtype=np.float64) for x in sets]
            linked = overlaps(*sets) * (1 + similarity) >= (n[0][:, None] + n[1][None, :]) * similarity - 1e-9
            own = [np.array(t.column("id").to_pylist(), dtype=object) for t in (outer, every)]
            linked &= own[0][:, None] != own[1][None, :]
            tops = connected_rows(linked)
            links = [(ids[k], ids[t]) for k, t in enumerate(tops) if k != t and t < len(ids)]
        kind = table.schema.field("id").type
        return pa.table({c: pa.array([x[k] for x in links], kind) for k, c in enumerate("ab")})

    return each


def near_pairs(nodes: DataFrame, distance: int) -> DataFrame:
    """Pairs ``(a, b)`` of ids that connect all nodes ``(id, fp)`` of fingerprints within ``distance`` bits."""
    heads = cut(nodes.groupBy("fp").agg(F.min("id").alias("head")))
    linked = links(heads.select("fp"), distance)
    a, b = (heads.select(F.col("fp").alias(c), F.col("head").alias(f"head_{c}")) for c in "ab")
    apart = linked.join(a, "a").join(b, "b").select(F.col("head_a").alias("a"), F.col("head_b").alias("b"))
    same = nodes.join(heads, "fp").filter("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    return apart.union(same)


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 5, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that stay, with all their columns.

    Rows of one id are one document, by one of its texts. Rows with a null id stay, as nothing can name them.

    The shuffles and cut frames of a step go once it has been cut, or those of all steps would lie on disk together: with many
    partitions small files take more than the rows in them.
    """
    spark = docs.sparkSession
    named = docs.filter(F.col(id_column).isNotNull())
    rows = _set_rows(named, id_column, text_column, size, whole=False).groupBy("id").agg(F.min(F.struct("digest", "values", "keys", "fp")).alias("own"))
    rows = cut(rows.select("id", "own.*"))
    # Equal sets: one node, by the smallest id.
    nodes = rows.select("id", "digest").join(rows.groupBy("digest").agg(F.min("id").alias("least")), "digest")
    nodes = cut(nodes.select("id", "digest", "least"))
    values = rows.join(nodes.filter("id = least").select("id"), "id").select("id", "digest", "values", "keys", "fp")
    near = cut(near_pairs(values.select("id", "fp"), DISTANCE))
    forget(spark)
    keyed = values.select("id", F.posexplode("keys").alias("k", "v")).select("id", F.xxhash64("k", "v").alias("path"))
    met = keyed.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("path")
    buckets = cut(keyed.join(met, "path"))
    forget(spark)
    few = buckets.select("id").union(near.select("a")).union(near.select("b")).distinct()
    some = cut(values.join(few, "id").select("id", "digest", "values"))
    wanted = broadcast_if_small(some.select(F.col("id").alias("of"), F.col("digest").alias("own")), BROADCAST_ROWS)
    sets = _set_rows(named, id_column, text_column, size, whole=True)
    sets = cut(sets.join(wanted, (F.col("id") == F.col("of")) & (F.col("digest") == F.col("own"))).select("id", "hashes").dropDuplicates(["id"]))
    forget(spark)
    linker = Linker(some, sets, similarity)
    linker.add(linker.verified(near))
    linker.link_all(buckets)
    gone = nodes.filter("id <> least").select("id").union(nodes.join(linker.roots.filter("node <> root"), F.col("least") == F.col("node")).select("id"))
    gone = broadcast_if_small(cut(gone.distinct()).withColumnRenamed("id", "__gone"), BROADCAST_ROWS)
    del rows, nodes, values, near, buckets, some, wanted, sets, linker
    forget(spark)
    return docs.join(gone, docs[id_column] == gone["__gone"], "left_anti")
