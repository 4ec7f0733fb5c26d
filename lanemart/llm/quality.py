"""Quality classifier: a generalised additive model with pairwise interactions over text statistics.

Each feature is cut into bins at quantiles of the training sample. Cyclic boosting goes round the features again
and again; each turn fits a shallow tree over one feature's bins to the current residuals and adds a small share
of it to that feature's lookup table. Then the pairs of features that explain most of what is left (by the best
split into four quadrants) get tables of their own in the same way. A score is the logistic curve of the sum of
one table entry per feature and pair, found by bin numbers for a whole batch at a time.

The fit runs on the driver over at most ``SAMPLE`` labelled rows, taken in order of a hash of their ids; only
their features leave the executors.

Defined cases: null and empty texts have all-zero features and are scored like any other. Labels that are null,
or of ids without a text, are not used; with labels of one kind or none, every score is the share of label 1
(0.5 without labels). Repeated rows are scored each. Further columns do not matter, ids may be null. Features
take time and memory in proportion to a text, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanemart.llm.common import text_batches

#: Labelled rows that the fit looks at, at most.
SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAVES = 200, 100, 0.1, 4
#: Rows a leaf needs at least.
LEAST_ROWS = 5

FEATURES = (
    "chars", "words", "word_length", "upper", "digits", "symbols", "bars", "marks", "spaces", "lines", "other_bytes",
    "repeats", "distinct", "endings", "short_words", "line_length",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1
    return out


_CLASSES = np.stack(
    [
        _class(bytes(range(0x41, 0x5B))), _class(bytes(range(0x30, 0x3A))), _class(b"#$%&*@^~<>=+_\\{}[]"), _class(b"|"),
        _class(b"!?"), _class(b" \t\r\x0b\x0c"), _class(b"\n"), _class(bytes(range(0x80, 0x100))),
        _class(bytes(range(0x61, 0x7B))),
    ]
)
_ODD = frozenset(b"#$%&*@^~<>=+_\\{}[]|!")


def features(text: str | None) -> list[float]:
    """The statistics of one whole text."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(data)
    upper, digits, symbols, bars, marks, spaces, lines, other, lower = _CLASSES @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    repeats = sum(map(eq, words, islice(words, 1, None)))
    odd = sum(w[-1] in _ODD for w in words)
    short = sum(len(w) == 1 for w in words)
    return [
        np.log1p(size), np.log1p(n), (size - spaces - lines) / n, upper / (upper + lower + 1), digits / size, symbols / size,
        bars / size, marks / size, spaces / size, lines / size, other / size, repeats / n,
        len(set(words)) / n, odd / n, short / n, np.log1p(size / (lines + 1)),
    ]


def _tree(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, leaves: int) -> np.ndarray:
    """A regression tree over ordered bins, from sums per bin: the step of every bin."""
    cuts = [0, len(rows)]
    g, w, r = (np.concatenate(([0.0], np.cumsum(x))) for x in (gradient, weight, rows))
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            k = np.arange(a + 1, b)
            if not len(k):
                continue
            gain = (g[k] - g[a]) ** 2 / (w[k] - w[a] + 1) + (g[b] - g[k]) ** 2 / (w[b] - w[k] + 1) - (g[b] - g[a]) ** 2 / (w[b] - w[a] + 1)
            gain[(r[k] - r[a] < LEAST_ROWS) | (r[b] - r[k] < LEAST_ROWS)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), int(k[gain.argmax()]))
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(rows))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (g[b] - g[a]) / (w[b] - w[a] + 1)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best split of a grid into four: its gain, and the step of every cell."""
    g, w = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, weight))
    best, out = 0.0, np.zeros(gradient.shape)
    for a in range(1, gradient.shape[0]):
        for b in range(1, gradient.shape[1]):
            corners = [(slice(0, a), slice(0, b)), (slice(0, a), slice(b, None)), (slice(a, None), slice(0, b)), (slice(a, None), slice(b, None))]
            sums = [
                (x[a, b], x[a, -1] - x[a, b], x[-1, b] - x[a, b], x[-1, -1] - x[a, -1] - x[-1, b] + x[a, b]) for x in (g, w)
            ]
            gain = sum(p * p / (q + 1) for p, q in zip(*sums))
            if gain > best:
                best, out = gain, np.zeros(gradient.shape)
                for at, p, q in zip(corners, *sums):
                    out[at] = p / (q + 1)
    return best, out


class Model:
    """Bin edges, one lookup table per feature, one per chosen pair."""

    def __init__(self, intercept: float, edges: list[np.ndarray], coarse: list[np.ndarray]):
        self.intercept, self.edges, self.coarse = intercept, edges, coarse
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int, np.ndarray]] = []

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        total = np.full(len(x), self.intercept)
        for k, (e, t) in enumerate(zip(self.edges, self.tables)):
            total += t[np.searchsorted(e, x[:, k], side="right")]
        for i, j, t in self.pairs:
            total += t[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in x.T]


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit the tables on rows of features and labels 0 or 1."""
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        level = np.inf if share == 1.0 else -np.inf if share == 0.0 else 0.0
        return Model(level, [np.zeros(0)] * len(FEATURES), [np.zeros(0)] * len(FEATURES))
    model = Model(float(np.log(share / (1 - share))), _edges(x, BINS), _edges(x, PAIR_BINS))
    total = np.full(len(y), model.intercept)
    fine = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.coarse)]
    rows = [np.bincount(b, minlength=len(t)).astype(float) for b, t in zip(fine, model.tables)]

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for b, t, r in zip(fine, model.tables, rows):
            g, w = residuals()
            step = RATE * _tree(np.bincount(b, g, len(t)), np.bincount(b, w, len(t)), r, LEAVES)
            t += step
            total += step[b]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        return np.bincount(rough[i] * shape[1] + rough[j], values, shape[0] * shape[1]).reshape(shape)

    g, w = residuals()
    ranked = sorted(combinations(range(len(FEATURES)), 2), key=lambda p: -_quadrants(grid(*p, g), grid(*p, w))[0])
    model.pairs = [(i, j, np.zeros(grid(i, j, g).shape)) for i, j in ranked[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, t in model.pairs:
            g, w = residuals()
            step = RATE * _quadrants(grid(i, j, g), grid(i, j, w))[1]
            t += step
            total += step[rough[i], rough[j]]
    return model


def _featured(batch_texts) -> np.ndarray:
    return np.array([features(t.as_py()) for t in batch_texts], dtype=float).reshape(-1, len(FEATURES))


def train(
    docs: DataFrame, labels: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality"
) -> Model:
    """A model of ``label_column``, from labels for which ``learn`` holds."""
    known = labels.filter(learn & F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1))
    known = known.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("y")).distinct()
    ids = F.broadcast(known.orderBy(F.xxhash64("id"), "id", "y").limit(SAMPLE))  # at most SAMPLE rows
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).join(ids, "id")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _featured(batch.column("text"))
            rows = pa.array(list(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), rows], names=["id", "y", "x"])

    kind = docs.schema[id_column].dataType.simpleString()
    found = text_batches(texts.select("id", "y", "text")).mapInArrow(each, f"id {kind}, y int, x array<double>")
    # Ids with several texts give several rows; the sample stays bounded, and is the same in every run.
    rows = found.orderBy(F.xxhash64("id"), "id", "y", "x").limit(SAMPLE).collect()
    return fit(np.array([r["x"] for r in rows], dtype=float).reshape(-1, len(FEATURES)), np.array([r["y"] for r in rows], dtype=float))


def score(docs: DataFrame, model: Model, text_column: str = "text", name: str = "score") -> DataFrame:
    """The documents with a column ``name``, the probability of label 1, in place of the text and of a column of that name."""
    kept = [f for f in docs.schema.fields if f.name not in (text_column, name)]
    rows = docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(text_column).cast("string").alias(text_column))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_featured(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], name])

    return text_batches(rows).mapInArrow(each, T.StructType([*kept, T.StructField(name, T.DoubleType())]))
