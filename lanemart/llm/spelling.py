"""Spelling variants: words one inserted, deleted or replaced code point apart, by dense prefix-suffix tiles.

1. Two words are one edit apart exactly if their common prefix and common suffix together reach the longer length
   minus one. With ``m`` = longer length - 1 cut into ``PARTS`` parts, such a pair agrees on all parts but one: it
   shares the first ``c`` and the last ``m - d`` code points for the part ``(c, d)`` that its common prefix ends in.
   So words meet by longer length, part, and what lies around that part; a word is in the groups of its own length
   and of the next one. The part that a pair's prefix ends in is one only, so each pair counts in one group.
2. A group of over ``CROWD`` words is dealt into blocks of about that size by a hash of the word; every pair of
   blocks is a tile of its own. So no task has to hold a group, whatever its size, and all its pairs are compared.
3. A task takes tiles as they come, sorted, packs words of several tiles into padded matrices of code points (from
   the left, and from the right), and compares matrix against matrix: the first column that differs gives the common
   prefix, or suffix, of each pair of rows. Pairs do not leave the task: words do, with the number of near words
   and the best of them.

A word's form is its near word of the largest count (ties: the smallest in code-point order) if that is at least
``times`` its own. Counts grow by that factor along forms, so a chain's length is bounded by the logarithm of the
largest count, and roots are found by that many doublings of joins.

Defined cases: null texts have no words, so do empty ones. Words of any length are compared whole. Repeated rows count
as often as they occur. A null id counts as empty text where an edit looks at it. An empty table gives an empty
result. Further columns of the documents do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanemart.llm.common import broadcast_if_small, cut

#: Letters of a word: A to Z, and those of Latin-1 from U+00C0 on.
LETTERS = "[A-Za-zÀ-ÿ]"
#: Parts of a word of which one may differ.
PARTS = 3
#: Words of a group up to which it is one tile, and crowded groups up to which their sizes are broadcast (16 bytes each).
CROWD, BROADCAST_ROWS = 4096, 500_000
#: Rows of a matrix, cells of a comparison, and rows that a task gathers before it compares.
BLOCK, CELLS, GATHER = 64, 1 << 18, 16_384


def count_words(
    docs: DataFrame,
    least: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    edit: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """``(word, n)`` of the runs of letters, A to Z in lower case, that have ``least`` code points or more.

    ``edit`` makes a word of a document's id (as text) and a run; the result counts.
    """
    runs = F.regexp_extract_all(F.col(text_column).cast("string"), F.lit(LETTERS + f"{{{least},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rows = rows.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    word = F.col("run") if edit is None else edit(F.col("id"), F.col("run"))
    return rows.select(word.alias("word")).filter(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _edge(band: Column, part: int) -> Column:
    """Where a part begins, in ``band - 1`` code points."""
    return F.ceil((band - 1) * F.lit(part) / F.lit(PARTS)).cast("int")


def _groups(words: DataFrame) -> DataFrame:
    """``(band, part, path, word, n)``: each word under its own length and the next, for every part."""
    both = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("band"))
    keys = []
    for part in range(PARTS):
        # A word of band - 1 code points or more holds both ends without overlap.
        first = F.col("word").substr(F.lit(1), _edge(F.col("band"), part))
        last = F.right("word", F.col("band") - 1 - _edge(F.col("band"), part + 1))
        keys.append(F.struct(F.lit(part).alias("part"), F.xxhash64(F.lit(part), "band", first, last).alias("path")))
    return both.select("band", "word", "n", F.inline(F.array(*keys)))


def _tiles(groups: DataFrame) -> DataFrame:
    """Rows with the tile ``(path, low, high)`` and the ``block`` they belong to; a crowded group has several tiles."""
    crowded = groups.groupBy("band", "path").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > CROWD)
    crowded = crowded.select(F.col("band").alias("of"), F.col("path").alias("at"), F.ceil(F.col("size") / CROWD).cast("int").alias("blocks"))
    met = groups.join(broadcast_if_small(crowded, BROADCAST_ROWS), (F.col("band") == F.col("of")) & (F.col("path") == F.col("at")), "left")
    block = F.coalesce(F.pmod(F.xxhash64("word", F.lit(PARTS)), F.col("blocks")), F.lit(0)).cast("int")
    dealt = met.select(*groups.columns, block.alias("block"), F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("other"))
    return dealt.select(*groups.columns, "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def matrix(words: list[str], pad: int) -> np.ndarray:
    """Code points, a row per word, padded; a last column of ``pad`` alone."""
    width = max(map(len, words))
    cells = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
    return np.concatenate([cells, np.full((len(words), 1), pad, dtype=np.uint32)], axis=1)


def compare(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix and common suffix of every word of the one list with every word of the other.

    For words that differ; of equal words both are the matrices' width.
    """
    wide = max(len(w) for w in (*left, *right))
    sides = []
    for turn in (slice(None), slice(None, None, -1)):
        a, b = (matrix([*(w[turn] for w in ws), "\0" * wide], pad)[:-1] for ws, pad in ((left, 0), (right, 1)))
        if max(a.max(), b.max()) < 256:
            a, b = a.astype(np.uint8), b.astype(np.uint8)
        sides.append((a[:, None, :] == b[None, :, :]).argmin(axis=2))
    return sides[0], sides[1]


def near_pairs(rows: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one tile that are one edit apart, each once; rows are sorted by tile."""
    words, size = rows["word"], len(rows["word"])
    band, part, block = (np.array(rows[c]) for c in ("band", "part", "block"))
    split = np.array(rows["low"]) != np.array(rows["high"])
    new = np.zeros(size, dtype=bool)
    for c in ("band", "path", "low", "high"):
        values = np.array(rows[c])
        new[1:] |= values[1:] != values[:-1]
    tile = np.cumsum(new)
    edges = np.stack([-(-(band - 1) * k // PARTS) for k in range(1, PARTS)])
    found = []
    start = 0
    while start < size:
        wide = int(band[start : start + BLOCK].max()) + 1
        step = max(1, min(BLOCK, math.isqrt(CELLS // wide)))
        stop = min(size, start + step)
        at = start
        last = int(np.searchsorted(tile, tile[stop - 1], side="right"))
        while at < last:
            end = min(last, at + step)
            a, b = np.arange(start, stop)[:, None], np.arange(at, end)[None, :]
            fit = (tile[a] == tile[b]) & (a < b) & ~(split[a] & (block[a] == block[b]))
            if fit.any():
                prefix, suffix = compare(words[start:stop], words[at:end])
                longer = np.maximum(*(np.array([len(w) for w in ws]).reshape(shape) for ws, shape in ((words[start:stop], (-1, 1)), (words[at:end], (1, -1)))))
                fit &= (longer == band[a]) & (prefix + suffix >= longer - 1)
                fit &= (prefix[None] >= edges[:, start:stop, None]).sum(axis=0) == part[a]
                found.append(np.stack(np.nonzero(fit)) + [[start], [at]])
            at = end
        start = stop
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
    return pairs[0], pairs[1]


def _met(rows: dict[str, list]) -> pa.RecordBatch:
    """``(word, near, best_n, best)`` of the words that have a near one in these tiles."""
    a, b = near_pairs(rows)
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    names, own = np.unique(np.array(rows["word"], dtype=object), return_inverse=True)  # sorted by code points
    n = np.array(rows["n"], dtype=np.int64)
    order = np.lexsort([own[other], -n[other], own[one]])
    one, other = one[order], other[order]
    first = np.flatnonzero(np.diff(own[one], prepend=-1))
    near = np.diff(np.append(first, len(one)))
    best = other[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(names[own[one[first]]], pa.string()), pa.array(near, pa.int64()), pa.array(n[best], pa.int64()), pa.array(names[own[best]], pa.string())],
        names=["word", "near", "best_n", "best"],
    )


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gathers whole tiles of a sorted partition, some thousand rows at a time."""
    names = ("band", "path", "low", "high", "part", "block", "word", "n")
    held: dict[str, list] = {c: [] for c in names}
    for batch in batches:
        for c in names:
            held[c].extend(batch.column(c).to_pylist())
        if len(held["word"]) >= GATHER:
            keys = [held[c] for c in names[:4]]
            done = len(held["word"]) - 1
            while done and all(k[done] == k[done - 1] for k in keys):
                done -= 1
            if done:
                yield _met({c: v[:done] for c, v in held.items()})
                held = {c: v[done:] for c, v in held.items()}
    if held["word"]:
        yield _met(held)


def near_words(words: DataFrame) -> DataFrame:
    """``(word, near, best_n, best)`` for each of ``words(word, n)`` that has a near one."""
    tiles = _tiles(_groups(words)).select("band", "path", "low", "high", "part", "block", "word", "n")
    dealt = tiles.repartition("band", "path", "low", "high").sortWithinPartitions("band", "path", "low", "high")
    met = dealt.mapInArrow(_each, "word string, near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best")
    found = met.groupBy("word").agg(F.sum("near").alias("near"), best)
    return found.select("word", "near", (-F.col("best.less")).alias("best_n"), F.col("best.word").alias("best"))


def variant_groups(words: DataFrame, times: int = 10) -> DataFrame:
    """One row per word of ``words(word, n)``: its near words, its form, and the last form that follows from it."""
    words = cut(words)
    near = near_words(words).withColumnRenamed("word", "of")
    joined = words.join(near, words["word"] == near["of"], "left")
    is_form = F.col("best_n") >= F.col("n") * F.lit(times)
    rows = cut(joined.select("word", "n", F.coalesce("near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    roots = rows.filter("form is not null").select(F.col("word").alias("of"), F.col("form").alias("root"))
    most, least = rows.agg(F.max("n"), F.min("n")).first()
    chain = 0
    while most and least * times ** (chain + 1) <= most:
        chain += 1
    for _ in range(max(0, (chain - 1).bit_length())):
        on = roots.select(F.col("of").alias("via"), F.col("root").alias("next"))
        roots = roots.join(on, F.col("root") == F.col("via"), "left").select("of", F.coalesce("next", "root").alias("root"))
    out = rows.join(roots, F.col("word") == F.col("of"), "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
