"""Periodic runs of words, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal) and a length of at
least ``max(LEAST, REPEATS * q)`` that no neighbouring word extends.

1. Names: equal words have equal names; a stretch of ``2 L`` words is named by the names of its two halves. So there
   is a level of names for every power of two.
2. On each level every occurrence of a name is followed by its successor. Successors within ``2 L`` words that keep
   their distance form an arithmetic progression; three terms propose that distance as a period. A run of period
   ``q`` is proposed on the level with ``q <= L < 2 q``: a stretch of a whole period recurs after ``q`` words and not
   before, and the third one still lies in the run, as it has four periods. Positions whose name occurs fewer than
   three times are left out of the next level, as longer stretches there cannot occur more often.
3. A proposal is extended to both sides while words its distance apart are equal. What is long enough is kept once;
   of several periods of one stretch the smallest counts.

Work goes by text: a row is one Python call on numpy arrays of the text's length, for every distance proposed.

Defined cases: null text counts as empty and has no runs. Words are what lies between ASCII white space, so texts of
white space only have none. Very long texts are worked on whole. Repeated rows each get their row; a null id stays
null. An empty table gives an empty result. Further columns do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.llm.common import text_batches

#: Least words of a run, and least number of periods in it.
LEAST, REPEATS = 6, 4

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def proposals(names: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(positions, distances)`` of progressions of three successors, level by level."""
    size, n = 1, len(names)
    at = np.arange(n)
    names = names.astype(np.int64)
    while len(at) and REPEATS * size < 2 * n:
        own = names[at]
        order = np.argsort(own, kind="stable")  # by name, then by position
        at, own = at[order], own[order]
        same = own[1:] == own[:-1]
        gap = np.where(same, at[1:] - at[:-1], 0)
        even = same[1:] & same[:-1] & (gap[1:] == gap[:-1]) & (gap[:-1] <= 2 * size)
        k = np.flatnonzero(even)
        yield at[k], gap[k]
        first = np.flatnonzero(np.concatenate([[True], ~same]))
        often = np.repeat(np.diff(np.concatenate([first, [len(own)]])) >= 3, np.diff(np.concatenate([first, [len(own)]])))
        ranks = np.cumsum(np.concatenate([[True], ~same]))
        named = np.full(n + size, -1, dtype=np.int64)
        named[at[often]] = ranks[often]
        at = np.sort(at[often])
        after = named[at + size]
        at = at[after >= 0]
        longer = np.full(n, -1, dtype=np.int64)
        longer[at] = named[at] * (n + 1) + named[at + size]
        names, size = longer, 2 * size


def find_runs(names: np.ndarray) -> np.ndarray:
    """``(start, length, period)`` of every run of a sequence of names, by start, then period."""
    n, wanted = len(names), {}
    for at, gap in proposals(names):
        for q in np.unique(gap):
            wanted.setdefault(int(q), []).append(at[gap == q])
    found: dict[tuple[int, int], int] = {}
    for q in sorted(wanted):
        at = np.unique(np.concatenate(wanted[q]))
        # Places where the words a distance apart differ bound the stretch around a proposal.
        breaks = np.concatenate([[-1], np.flatnonzero(names[: n - q] != names[q:]), [n - q]])
        k = np.unique(np.searchsorted(breaks, at))  # a proposal sits at a place that is no break
        start, stop = breaks[k - 1] + 1, breaks[k] + q
        long = stop - start >= max(LEAST, REPEATS * q)
        for s, e in zip(start[long].tolist(), stop[long].tolist()):
            found.setdefault((s, e), q)
    rows = sorted((s, q, e - s) for (s, e), q in found.items())
    return np.array([(s, length, q) for s, q, length in rows], dtype=np.int64).reshape(-1, 3)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes: splits at ASCII white space only


def name_words(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))


def repeats(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words lie in a run behind its first period."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps[:n]) > 0


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Per row: the id, ``runs`` (array of start, length, period, in words) and ``collapsed``.

    ``collapsed`` is the text's words, joined by spaces, without those that repeat a run's first period. ``rewrite``
    may change the words of a text, given its id, before they are looked at.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = [], []
            for key, text in zip(batch.column(0), batch.column(1)):
                words = words_of(text.as_py())
                if rewrite is not None:
                    words = rewrite(key.as_py(), words)
                found = find_runs(name_words(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found.tolist()])
                if len(found):
                    gone = repeats(len(words), found)
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                kept.append(b" ".join(words).decode())
            columns = [batch.column(0), pa.array(runs, pa.list_(RUN)), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "runs", "collapsed"])

    kind = docs.schema[id_column].dataType.simpleString()
    out = "id {}, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string".format(kind)
    return text_batches(rows).mapInArrow(each, out).withColumnRenamed("id", id_column)
