"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

The automaton is built over words: all substrings of all items, each state knowing the items it occurs in. The
words of a document are streamed through it, which gives at every word the length of the longest substring of
any item that ends there. Words of matches of ``window`` words or more are hit, and so are those of items that
are shorter than a window and occur whole.

``match_table`` reports hits; ``clean`` acts on them: it cuts the hit words, with what stands between them, out
of the text, and drops documents of which a larger share of words than ``coverage`` is hit. What is left is
streamed again until nothing is hit, as a cut can bring the ends of a passage together.

Size: the benchmark is a set of test items. Up to ``BLOCK_WORDS`` words go into an automaton, which is sent to
every task; a larger benchmark is cut into blocks of whole items, each with its own pass over the documents, so
no task holds more than one automaton of that size (an item larger than a block is a block of its own).

Words: lower-cased ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, with A-Z as a-z.

Defined cases: null text has no words; items without words, or with a null id, match nothing. Repeated items
are one item per id; repeated documents each get their row, null ids included. Empty tables give empty results,
an empty benchmark gives no hits. Further columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanemart.llm.common import cut, text_batches

#: Words of benchmark text in one automaton.
BLOCK_WORDS = 400_000

#: Bytes that belong to words map to their lower case, all others to a space.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def fold(text: str | None) -> bytes:
    """Word bytes in lower case, everything else as spaces; offsets are those of the UTF-8 text."""
    return (text or "").encode().translate(_FOLD)


class SuffixAutomaton:
    """Generalised suffix automaton over words; ``items`` are (id, words)."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[int]] = [set()]
        for n, (_, words) in enumerate(items):
            last = 0
            for w in words:
                last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary)))
                while len(ends) < len(self.next):
                    ends.append(set())
                ends[last].add(n)
        self._spread(ends)
        # States that stand for all of a short item: reached by its words, and as long as it is.
        self.short = [0] * len(self.next)
        self.short_items: dict[int, dict[int, set[int]]] = {}
        for n, (_, words) in enumerate(items):
            if 0 < len(words) < window:
                state = 0
                for w in words:
                    state = self.next[state][self.vocabulary[w]]
                self.short_items.setdefault(state, {}).setdefault(len(words), set()).add(n)
        self._nearest()

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, word, q)
        now = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and word not in nxt[p]:
            nxt[p][word] = now
            p = link[p]
        if p != -1:
            q = nxt[p][word]
            link[now] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return now

    def _clone(self, p: int, word: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        while p != -1 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _spread(self, ends: list[set[int]]) -> None:
        """Items of a state: those ending in it or in a longer state that has it as a suffix.

        Only states that can answer for a window or a short item keep their set.
        """
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                ends[self.link[s]] |= ends[s]
        self.items = [frozenset(e) for e in ends]

    def _nearest(self) -> None:
        """For every state the nearest state on its suffix path (itself included) that has short items."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[s] = s if s in self.short_items else self.short[self.link[s]]

    def stream(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit ranges (first, past last) and found items for word numbers, -1 for words outside."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        ranges: list[tuple[int, int]] = []
        found: set[int] = set()
        state = matched = 0
        for k, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            else:
                state = matched = 0
                continue
            if matched >= window:
                first = k + 1 - matched
                if ranges and ranges[-1][0] == first:
                    ranges.pop()
                ranges.append((first, k + 1))
                at = state
                while length[link[at]] >= window:
                    at = link[at]
                found |= self.items[at]
            at = self.short[state]
            while at > 0:
                for size, whole in self.short_items[at].items():
                    if size <= matched:
                        ranges.append((k + 1 - size, k + 1))
                        found |= whole
                at = self.short[link[at]] if link[at] > 0 else 0
        return ranges, found


def hit_words(automaton: SuffixAutomaton, folded: bytes) -> tuple[np.ndarray, set[int]]:
    """A flag for each word of a folded text, and the numbers of the items found."""
    known = automaton.vocabulary.get
    numbers = [known(w, -1) for w in folded.split()]
    ranges, found = automaton.stream(numbers)
    hit = np.zeros(len(numbers), dtype=bool)
    for a, b in ranges:
        hit[a:b] = True
    return hit, found


def edges(hit: np.ndarray) -> list[int]:
    """Starts and ends of the runs of flags, in turn."""
    return np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))).tolist()


def cut_words(automaton: SuffixAutomaton, text: str) -> tuple[str, int]:
    """The text without its hit words, streamed until none is left, and how many were cut."""
    data, gone = text.encode(), 0
    while True:
        folded = fold(data.decode())
        hit, _ = hit_words(automaton, folded)
        if not hit.any():
            return data.decode(), gone
        gone += int(hit.sum())
        at = [m.span() for m in re.finditer(rb"[^ ]+", folded)]
        runs, last, kept = edges(hit), 0, []
        for a, b in zip(runs[::2], runs[1::2]):
            kept.append(data[last : at[a][0]])
            last = at[b - 1][1]
        data = b" ".join([*kept, data[last:]])


def automata(benchmark: DataFrame, window: int, id_column: str = "item_id", text_column: str = "text") -> list[SuffixAutomaton]:
    """Automata of blocks of items, in order of their ids, each of a bounded number of words."""
    items = benchmark.select(F.col(id_column).alias("i"), F.col(text_column).alias("t")).dropna().distinct()
    blocks, size = [[]], 0
    for row in items.orderBy("i", "t").toLocalIterator():
        words = fold(row["t"]).split()
        if words and blocks[-1] and size + len(words) > BLOCK_WORDS:
            blocks.append([])
            size = 0
        if words:
            blocks[-1].append((row["i"], words))
            size += len(words)
    return [SuffixAutomaton(b, window) for b in blocks]


def _pass(docs: DataFrame, automaton: SuffixAutomaton, last: bool) -> DataFrame:
    """Add an automaton's findings to ``n_words``, ``edges`` and ``items``; the last pass lets go of the text."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton
        for batch in batches:
            out = {"id": batch.column(0), "n_words": [], "edges": [], "items": []}
            for text, before, items in zip(batch.column(1), batch.column(2), batch.column(3)):
                hit, found = hit_words(auto, fold(text.as_py()))
                runs = before.as_py() or []
                for a, b in zip(runs[::2], runs[1::2]):
                    hit[a:b] = True
                out["n_words"].append(len(hit))
                out["edges"].append(edges(hit) if hit.any() else [])
                out["items"].append([*(items.as_py() or []), *(str(auto.ids[n]) for n in found)])
            columns = [
                out["id"], pa.array(out["n_words"], pa.int64()),
                pa.array(out["edges"], pa.list_(pa.int64())), pa.array(out["items"], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*columns, *([] if last else [batch.column(1)])], names=[*out, *([] if last else ["text"])])

    kind = docs.schema["id"].dataType.simpleString()
    found = "n_words long, edges array<long>, items array<string>"
    return text_batches(docs.select("id", "text", "edges", "items")).mapInArrow(each, f"id {kind}, {found}" + ("" if last else ", text string"))


def match_table(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document its id, ``n_words``, ``edges`` (starts and ends of hit runs of words) and ``items``."""
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"),
        F.array().cast("array<bigint>").alias("edges"), F.array().cast("array<string>").alias("items"),
    )
    blocks = automata(benchmark, window)
    for n, automaton in enumerate(blocks):
        rows = _pass(rows, automaton, last=n == len(blocks) - 1)
    return rows.withColumnRenamed("id", id_column).withColumn("items", F.array_distinct("items"))


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Counts per document, and the digest of the items found."""
    starts = F.filter("edges", lambda _, k: k % 2 == 0)
    ends = F.filter("edges", lambda _, k: k % 2 == 1)
    n_hit = F.aggregate(F.zip_with(starts, ends, lambda a, b: b - a), F.lit(0).cast("long"), lambda n, x: n + x)
    found = match_table(docs, benchmark, window).withColumn("n_hit", n_hit)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _cut_pass(docs: DataFrame, automaton: SuffixAutomaton, at: int) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton
        for batch in batches:
            texts, gone, words = [], [], []
            for text in batch.column(at):
                old = text.as_py()
                new, n = cut_words(auto, old) if old else (old, 0)
                texts.append(new)
                gone.append(n)
                words.append(len(fold(new).split()))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            columns[-2] = pa.array([a.as_py() + b for a, b in zip(columns[-2], gone)], pa.int64())
            columns[-1] = pa.array(words, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return text_batches(docs).mapInArrow(each, docs.schema)


def clean(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, coverage: float = 0.5, text_column: str = "text"
) -> DataFrame:
    """Documents without hit words; those of which more than ``coverage`` was hit are left out.

    Columns are those of ``docs``. Texts without a hit stay as they are.
    """
    rows = docs.withColumns({"__cut": F.lit(0).cast("long"), "__left": F.lit(0).cast("long")})
    at, blocks, total = docs.columns.index(text_column), automata(benchmark, window), 0
    while True:
        for automaton in blocks:
            rows = _cut_pass(rows, automaton, at)
        if len(blocks) == 1:
            break
        # A cut for one block may join what another block knows: go on until a whole round cuts nothing.
        rows = cut(rows)
        before, total = total, rows.agg(F.sum("__cut")).first()[0]
        if total == before:
            break
    enough = F.col("__cut") <= coverage * (F.col("__cut") + F.col("__left"))
    return rows.filter(enough).drop("__cut", "__left")
