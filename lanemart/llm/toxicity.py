"""Toxicity: a support vector machine over a gap-weighted subsequence kernel, by way of Nyström landmarks.

Kernel: ``K(s, t)`` sums over all common subsequences of ``ORDER`` letters, each weighted by ``DECAY`` to the
power of the letters it spans in ``s`` and in ``t``. A letter put into an insult, or left between its letters,
lowers the kernel a little instead of making it zero.

Units: a sentence is scored by its words (lower-cased, letters only, so ``i.d-i.o.t`` is ``idiot``), by its
runs of single letters (``i d i o t``) and by up to ``PARTS`` words of at most ``PART`` letters in a row (``id io t``), where
every gap lowers the kernel; landmarks that clean words give when put together are not looked for in these. Units of two or three letters stand between marks, so the kernel compares
them whole; of scripts without spaces, pairs and triples of letters are units as well. A sentence is as toxic as its worst unit, a text as its worst sentence.

Fit, on the driver, over a bounded sample of labelled rows (``SAMPLE`` of each label, in order of a hash of
their ids): landmarks are pieces of words of toxic texts that are far more frequent there than in clean ones,
chosen one after the other so that each explains toxic texts the others don't. Units are mapped to Nyström
features (kernel values against the landmarks, whitened by the landmarks' own kernel), a linear SVM is trained
on all clean units and all toxic ones that hold a landmark, with spoiled copies of the landmarks, and a logistic curve
over the worst unit of a text turns decisions into probabilities. There is no cap on landmarks or units but the sample.

Score: words whose longest common subsequence with a landmark is shorter than ``ORDER`` have kernel zero with
it, which a bit-parallel pass finds out for all landmarks at once; only the other pairs get the full recursion.

Defined cases: null and empty texts have no units and get the score of kernel values zero. Words longer than
``WIDTH`` letters are scored in overlapping pieces. Labels that are null, or of ids without a text, are not used;
without labels of both kinds every score is 0. Repeated rows are scored each; repeated labels count once per
value. Further columns do not matter, ids may be null.
"""

from __future__ import annotations

import gc
import re
import sys
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanemart.llm.common import release, text_batches

#: Labelled rows of each label that the fit looks at, at most.
SAMPLE = 1500
#: Length of the subsequences, and weight of a letter they span.
ORDER, DECAY = 4, 0.7
#: Lengths of landmarks. There are as many as the sample supports.
SHORTEST, LONGEST = 4, 12
#: A landmark is in so many texts of the toxic sample, whatever its size; it is in this share of it, or in two texts
#: that no other landmark explains; and it is so many times as frequent as in clean texts, or in no clean text and in
#: ``LEAST`` toxic ones that no other explains.
LEAST, SUPPORT, LIFT = 3, 0.03, 12.0
#: Letters of a word that are compared at a time; pieces overlap by half.
WIDTH = 24
#: Words of at most so many letters are also compared together, so many of them, and what a gap takes from the kernel.
PART, PARTS, GAP = 4, 4, 0.9
#: A landmark that clean words of the sample come as near to when put together is not looked for across words.
CLASH = 0.5
#: Units remembered by a task, and texts looked at together.
REMEMBER, TOGETHER = 300_000, 256

#: Codes of the padding of landmarks, and of letters that no landmark has where these must agree with nothing.
_END, _NONE = 65535, 65534

_OTHER = re.compile(r"[\W\d_]+")
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S)+(?!\S)")
_UNSPACED = re.compile("[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]{3,}")
#: What units of fewer than ``ORDER`` letters begin and end with; no letters, so no text has them in a unit.
FIRST, LAST = "\ue000", "\ue001"


def across(words: list[str]) -> set[str]:
    """Two to ``PARTS`` short words in a row, that may be one word with gaps in it; the gaps stay as spaces."""
    found, run = set(), []
    for w in words:
        if len(w) > PART or not w.isalpha():
            run = []
            continue
        run = [w, *[f"{r} {w}" for r in run[: PARTS - 1]]]
        found.update(r for r in run[1:] if len(r) - r.count(" ") >= ORDER)
    return found


def tokens(text: str | None, gaps: bool = True) -> set[str]:
    """Distinct words of a text, its runs of single characters, and pairs and triples of letters of unspaced scripts.

    With ``gaps`` also short words in a row.
    """
    lowered = (text or "").lower()
    words = lowered.split()
    found = set(words)
    if gaps:
        found |= across(words)
    if any(len(t) == 1 for t in found):
        found.update("".join(m.split()) for m in _SPACED.findall(lowered))
    if not lowered.isascii():
        for run in _UNSPACED.findall(lowered):
            found |= _grams(run, 2) | _grams(run, 3)
    return found


def letters(token: str) -> str:
    """The letters of a token, a few of them between marks, so that they have subsequences of ``ORDER``."""
    found = _OTHER.sub("", token)
    return f"{FIRST}{found}{LAST}" if 0 < len(found) < ORDER else found


def pieces(unit: str) -> list[str]:
    if len(unit) <= WIDTH:
        return [unit]
    return [unit[k : k + WIDTH] for k in range(0, len(unit) - WIDTH // 2, WIDTH // 2)]


def _recursion(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The kernel of pairs of coded texts; a row of ``s`` and ``t`` holds one letter of every pair."""
    n, levels = s.shape[1], ORDER - 1
    square, decay = np.float32(DECAY * DECAY), np.float32(DECAY)
    # prefix[j, k]: common subsequences of k letters that end before letter j of the landmark.
    prefix = np.zeros((len(t) + 1, ORDER, n), dtype=np.float32)
    prefix[:, 0] = 1
    total = np.zeros(n, dtype=np.float32)
    for c in s:
        same = (t == c) * square
        run = np.zeros((levels, n), dtype=np.float32)
        before = prefix[0].copy()
        for j in range(len(t)):
            step = before * same[j]
            total += step[levels]
            run *= decay
            run += step[:levels]
            here = prefix[j + 1]
            before = here.copy()
            here[1:] *= decay
            here[1:] += run
    return total


class Kernel:
    """Kernel values of units against fixed landmarks."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.alphabet = {c: n + 1 for n, c in enumerate(sorted(set("".join(landmarks))))}
        self.table = np.zeros(0x110000, dtype=np.uint16)
        for c, n in self.alphabet.items():
            self.table[ord(c)] = n
        self.codes = self._encode(landmarks, max(map(len, landmarks), default=1), pad=_END)
        masks = np.zeros((len(self.alphabet) + 1, len(landmarks)), dtype=np.uint16)
        for m, text in enumerate(landmarks):
            for k, c in enumerate(text):
                masks[self.alphabet[c], m] |= 1 << k
        self.masks = masks
        self.full = np.array([(1 << len(t)) - 1 for t in landmarks], dtype=np.uint16)
        n = len(landmarks)
        pairs = np.indices((n, n)).reshape(2, -1)
        own = np.where(self.codes == _END, 0, self.codes)  # the paddings of the two sides never agree
        self.gram = self._recursion(own, *pairs).astype(float).reshape(n, n)
        self.norms = np.diag(self.gram).copy()

    def _encode(self, units: list[str], width: int, pad: int) -> np.ndarray:
        """Letters of the landmarks by number, other letters as 0, one row per unit."""
        wide = "".join([u.ljust(width) for u in units]).encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(wide, dtype=np.uint32).reshape(len(units), width)
        out = self.table[points]
        if pad:
            out[points == 0x20] = pad
        return out

    def _recursion(self, codes: np.ndarray, rows: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """The kernel of units ``rows`` with landmarks ``marks``, pair by pair."""
        return _recursion(codes[rows].T, self.codes[marks].T)

    def values(self, units: list[str]) -> np.ndarray:
        """``K(unit, landmark) / K(landmark, landmark)``, 1 for a unit that is the landmark."""
        out = np.zeros((len(units), len(self.landmarks)))
        if not self.landmarks:
            return out
        order = sorted(range(len(units)), key=lambda n: len(units[n]))
        for start in range(0, len(order), 4096):
            own = np.array(order[start : start + 4096])
            codes = self._encode([units[n] for n in own], max(1, len(units[own[-1]])), pad=0)
            v = np.broadcast_to(self.full, (len(own), len(self.full))).copy()
            for column in codes.T:
                m = self.masks[column]
                u = v & m
                v = ((v + u) | (v - u)) & self.full
            common = np.bitwise_count(self.full) - np.bitwise_count(v)
            rows, marks = np.nonzero(common >= ORDER)
            for a in range(0, len(rows), 8192):
                r, k = rows[a : a + 8192], marks[a : a + 8192]
                out[own[r], k] = self._recursion(codes, r, k) / np.sqrt(self.norms[k])
            some = np.unique(rows)
            mine = np.where(codes[some] == 0, _NONE, codes[some]).T
            size = _recursion(codes[some].T, mine) if len(some) else np.zeros(0)
            out[own[some]] /= np.sqrt(np.maximum(size, 1e-9))[:, None]
        return out


class Model:
    """Landmarks, SVM weights over Nyström features and the logistic curve."""

    def __init__(self, landmarks: list[str]):
        self.kernel = Kernel(landmarks)
        size = np.sqrt(self.kernel.norms)
        values, vectors = np.linalg.eigh(self.kernel.gram / np.outer(size, size)) if landmarks else (np.zeros(0), np.zeros((0, 0)))
        self.whiten = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
        self.weights, self.bias = np.zeros(len(landmarks)), 0.0
        self.slope, self.shift = 0.0, -np.inf
        #: Landmarks that are looked for across words.
        self.bridges = np.ones(len(landmarks), dtype=bool)

    def features(self, units: list[str]) -> np.ndarray:
        return self.kernel.values(units) @ self.whiten

    def decisions(self, units: list[str], gaps: np.ndarray | None = None) -> np.ndarray:
        """One value per unit; long units count with their worst piece. Every gap lowers the kernel; units with gaps are short."""
        if gaps is not None:
            return ((self.kernel.values(units) * self.bridges * GAP ** gaps[:, None]) @ self.whiten) @ self.weights + self.bias
        if all(len(u) <= WIDTH for u in units):
            return self.features(units) @ self.weights + self.bias
        parts = [(n, p) for n, u in enumerate(units) for p in pieces(u)]
        each = self.features([p for _, p in parts]) @ self.weights + self.bias
        out = np.full(len(units), -np.inf)
        np.maximum.at(out, [n for n, _ in parts], each)
        return out

    def probability(self, worst: np.ndarray) -> np.ndarray:
        if self.shift == -np.inf:
            return np.zeros(len(worst))
        return 1 / (1 + np.exp(-np.clip(self.slope * worst + self.shift, -500, 500)))

    def worst(self, texts: Iterable[set[str]], seen: dict[str, float]) -> np.ndarray:
        """The largest decision of each set of tokens; ``seen`` remembers decisions by token."""
        texts = list(texts)
        if len(seen) > REMEMBER:
            seen.clear()
        fresh = list(set().union(*texts) - seen.keys()) if texts else []
        gapped = [t for t in fresh if " " in t]
        fresh = [t for t in fresh if " " not in t]
        seen.update(zip(fresh, self.decisions([letters(t) for t in fresh]).tolist()))
        if gapped:
            spaces = np.array([t.count(" ") for t in gapped])
            seen.update(zip(gapped, self.decisions([t.replace(" ", "") for t in gapped], spaces).tolist()))
        return np.array([max(map(seen.__getitem__, t), default=self.bias) for t in texts])


def _grams(unit: str, size: int) -> set[str]:
    return {unit[k : k + size] for k in range(len(unit) - size + 1)}


def choose_landmarks(toxic: list[set[str]], clean: list[set[str]]) -> list[str]:
    """Pieces of words that tell toxic texts from clean ones, greedily by the texts they explain."""
    clean_units = Counter(u for t in clean for u in t)
    where: dict[str, set[int]] = defaultdict(set)
    for n, t in enumerate(toxic):
        for u in t:
            if clean_units[u] * LIFT * len(toxic) <= len(clean) * 3:
                where[u].add(n)
    frequent: dict[str, set[int]] = {}
    last: set[str] | None = None
    for size in range(SHORTEST, LONGEST + 1):
        held: dict[str, set[int]] = defaultdict(set)
        most: Counter = Counter()  # texts at most, so that only what may be frequent gets a set
        for u, docs in where.items():
            for g in _grams(u, size):
                if last is None or (g[1:] in last and g[:-1] in last):
                    most[g] += len(docs)
        for u, docs in where.items():
            for g in _grams(u, size):
                if most.get(g, 0) >= LEAST:
                    held[g] |= docs
        del most
        held = {g: d for g, d in held.items() if len(d) >= LEAST}
        last = set(held)
        frequent |= held
        if not held:
            break
    in_clean: Counter = Counter()
    sizes = range(SHORTEST, LONGEST + 1)
    for t in clean:
        in_clean.update({g for u in t for size in sizes for g in _grams(u, size) if g in frequent})
    rate, chosen = len(clean) / max(1, len(toxic)), []
    lifted = {g for g, d in frequent.items() if len(d) * rate >= LIFT * (in_clean[g] + 0.5)}
    good = lifted | {g for g in frequent if not in_clean[g]}
    within: dict[str, list[str]] = defaultdict(list)
    for u in where:
        for g in {g for size in sizes for g in _grams(u, size)} & good:
            within[g].append(u)
    explained: set[int] = set()
    texts = {g: set().union(*(where[u] for u in us)) for g, us in within.items()}
    while texts:
        best = max(texts, key=lambda g: (len(texts[g]), len(g), g))
        if len(texts[best]) < max(4, SUPPORT * len(toxic)):
            best = max(texts, key=lambda g: (len(texts[g] - explained), len(texts[g]), len(g), g))
            while texts and len(texts[best] - explained) < (2 if best in lifted else LEAST):
                if len(texts[best] - explained) < 2:
                    return chosen
                del texts[best], within[best]
                best = max(texts, key=lambda g: (len(texts[g] - explained), len(texts[g]), len(g), g), default="")
            if not texts:
                break
        # Lengthen it as long as that loses few texts: a longer landmark is rarer elsewhere.
        while longer := [g for g in texts if len(g) == len(best) + 1 and best in g and len(texts[g]) >= 0.7 * len(texts[best])]:
            best = max(longer, key=lambda g: (len(texts[g]), g))
        chosen.append(best)
        explained |= texts.pop(best)
        gone = set(within.pop(best))
        for g in [g for g in texts if not gone.isdisjoint(within[g])]:
            within[g] = [u for u in within[g] if u not in gone]
            texts[g] = set().union(*(where[u] for u in within[g]))
            if not texts[g]:
                del texts[g]
    return chosen


def spoiled(unit: str) -> list[str]:
    """The unit with a letter put in, and with one doubled; none for units between marks, which would lose these."""
    out = []
    if FIRST in unit or LAST in unit:
        return out
    for k in range(1, len(unit)):
        out += [unit[:k] + "x" + unit[k:], unit[:k] + unit[k - 1] + unit[k:]]
    return out


def train_svm(x: np.ndarray, y: np.ndarray, times: np.ndarray, cost: float = 30.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Linear SVM (hinge loss) by dual coordinate descent; a row stands for ``times`` equal ones."""
    x = np.hstack([x, np.ones((len(x), 1))])
    top = cost * times
    norms, alpha, w = np.maximum((x * x).sum(1), 1e-12), np.zeros(len(y)), np.zeros(x.shape[1])
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            old = alpha[i]
            new = min(max(old + (1 - y[i] * (x[i] @ w)) / norms[i], 0.0), top[i])
            if new != old:
                alpha[i] = new
                w += (new - old) * y[i] * x[i]
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, positive: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with smoothed targets so that a clean split stays finite."""
    n1, n0 = positive.sum(), (~positive).sum()
    target = np.where(positive, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(positive, 0.1 / n1, 0.9 / n0)  # clean texts are to be left alone
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        g, h = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(hess, np.array([(g * x).sum(), g.sum()]))
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(rows: list[tuple[int, set[str]]]) -> Model:
    """Fit on (label, tokens) of sampled texts."""
    across_clean = sorted({u for y, t in rows if y == 0 for u in t if " " in u})
    rows = [(y, {u for u in t if " " not in u}) for y, t in rows]
    units = {t: pieces(letters(t)) for t in set().union(*(t for _, t in rows))}
    sides = [[{p for u in t for p in units[u] if len(p) >= SHORTEST} for y, t in rows if y == side] for side in (0, 1)]
    del units
    clean, toxic = sides
    landmarks = choose_landmarks(toxic, clean) if clean and toxic else []
    model = Model(landmarks)
    if not landmarks:
        return model
    known, values = set().union(*clean), []
    harmless = sorted(known)
    for k in range(0, len(harmless), 4096):
        part = model.kernel.values(harmless[k : k + 4096])
        values.append(part[part.any(axis=1)])
    for k in range(0, len(across_clean), 4096):
        part = model.kernel.values([u.replace(" ", "") for u in across_clean[k : k + 4096]])
        model.bridges &= part.max(axis=0) < CLASH
    # Equal points are one with a weight, above all those of units without any common subsequence.
    far = len(harmless) - sum(map(len, values))
    values, times = np.unique(np.vstack([*values, np.zeros((min(far, 1), len(landmarks)))]), axis=0, return_counts=True)
    times[~values.any(axis=1)] = far
    bad = {u for t in toxic for u in t if any(g in u for g in landmarks)}
    bad |= {s for g in landmarks for s in (g, *spoiled(g)) if s not in known}
    x = np.vstack([model.features(sorted(bad)), values @ model.whiten])
    y = np.concatenate([np.ones(len(bad)), -np.ones(len(values))])
    model.weights, model.bias = train_svm(x, y, np.concatenate([np.ones(len(bad)), times]))
    seen: dict[str, float] = {}
    worst = [model.worst([t for _, t in rows[k : k + TOGETHER]], seen) for k in range(0, len(rows), TOGETHER)]
    # Spoiled insults count as texts of their own, so that the curve leaves room for them.
    variants = model.decisions([s for g in landmarks for s in spoiled(g) if s not in known])
    positive = np.array([y == 1 for y, _ in rows] + [True] * len(variants))
    model.slope, model.shift = logistic(np.concatenate([*worst, variants]), positive)
    return model


def sample(docs: DataFrame, labels: DataFrame, learn: Column, id_column: str, text_column: str, label_column: str) -> list[tuple[int, set[str]]]:
    """(label, tokens) of at most ``SAMPLE`` labelled texts of each label, chosen by a hash of their ids."""
    known = labels.filter(learn & F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(label_column).alias("y"))
    sides = [known.filter(F.col("y") == y).distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE) for y in (0, 1)]
    ids = F.broadcast(sides[0].union(sides[1]))  # at most 2 * SAMPLE rows
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).join(ids, "id")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(tokens(t.as_py(), gaps=y == 0)) for t, y in zip(batch.column(2), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))], names=["id", "y", "tokens"])

    kind = docs.schema[id_column].dataType.simpleString()
    found = text_batches(texts.select("id", F.col("y").cast("int"), "text")).mapInArrow(each, f"id {kind}, y int, tokens array<string>")
    # Ids with several texts or labels give several rows; the sample stays bounded all the same.
    # A token of many texts is held once.
    return [(r["y"], set(map(sys.intern, r["tokens"]))) for r in found.orderBy(F.xxhash64("id"), "id", "y").limit(2 * SAMPLE).toLocalIterator()]


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Model:
    """A model of ``label_column``, from labels for which ``learn`` holds."""
    model = fit(sample(docs, labels, learn, id_column, text_column, label_column))
    gc.collect()
    release()  # the sample took some hundred megabytes of the driver
    return model


def score(docs: DataFrame, model: Model, text_column: str = "text", name: str = "score") -> DataFrame:
    """The documents with a column ``name``, the probability that they are toxic, in place of one of that name."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != name or c == text_column])
    at = docs.columns.index(text_column)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, seen = model, {}  # some numbers per landmark, sent with the function
        for batch in batches:
            texts, scores = batch.column(at), []
            for k in range(0, len(texts), TOGETHER):
                worst = fitted.worst([tokens(t.as_py()) for t in texts[k : k + TOGETHER]], seen)
                scores.append(fitted.probability(worst))
            column = pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])

    return text_batches(docs).mapInArrow(each, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
