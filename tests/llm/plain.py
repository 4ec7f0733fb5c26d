"""Plain versions of what SQL cannot express, over rows in memory."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def crc(doc_id, divisor: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % divisor


def spaced(text) -> list[str]:
    return SPACED.findall((text or "").translate(LOWER))


def words(text) -> list[str]:
    return WORDS.findall((text or "").translate(LOWER))


def contamination(docs, items, window: int = 10):
    """{doc_id: (n_words, n_hit, item ids)} by looking every window up."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(item)
    sizes = sorted({len(w) for w in windows})
    out = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= own
        out[doc_id] = (len(w), len(hit), sorted(map(str, found)))
    return out


def simhash(text, size: int) -> int:
    w = spaced(text)
    grams = [" ".join(w[k : k + size]) for k in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(grams))


def simhash_components(docs, size: int = 3, distance: int = 2):
    """{doc_id: (hex fingerprint, smallest id reachable)} from all pairs."""
    fps = {i: simhash(t, size) for i, t in docs}
    ids, root = sorted(fps), {i: i for i in fps}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= distance:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (f"{fps[i]:016x}", top(i)) for i in ids}


def trigram_scores(docs, discount: float = 0.75):
    """{doc_id: (tokens, known, training tokens, base, score)} of a back-off trigram model."""
    tokens = {i: [*spaced(t), "\n"] for i, t in docs}
    c, c2, c3, heads, contexts = Counter(), Counter(), Counter(), Counter(), Counter()
    for i, w in tokens.items():
        if crc(i, 7) == 2:
            continue
        c.update(w)
        p = ["", "", *w]
        for a, b, d in zip(p, p[1:], p[2:]):
            c3[a, b, d] += 1
            contexts[a, b] += 1
            c2[b, d] += 1
            heads[b] += 1
    total, kinds = sum(c.values()), len(c)
    kinds2, kinds3, seen = Counter(b for b, _ in c2), Counter((a, b) for a, b, _ in c3), Counter()
    for a, b, d in c3:
        seen[a, b] += (c2[b, d] - discount) / heads[b]

    def log(a, b, d) -> float:
        if (a, b, d) in c3:
            return math.log10((c3[a, b, d] - discount) / contexts[a, b])
        out = 0.0
        if (a, b) in contexts:
            out += math.log10(discount * kinds3[a, b] / contexts[a, b] / (1 - seen[a, b]))
        if (b, d) in c2:
            return out + math.log10((c2[b, d] - discount) / heads[b])
        if b in heads:
            out += math.log10(discount * kinds2[b] / heads[b])
        return out + math.log10((c[d] + 1) / (total + kinds + 1))

    out = {}
    for i, w in tokens.items():
        p = ["", "", *w]
        base = sum(math.log10((c[x] + 1) / (total + kinds + 1)) for x in w)
        out[i] = (len(w), sum(c[x] > 0 for x in w), total, base, sum(log(*g) for g in zip(p, p[1:], p[2:])))
    return out


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def jaccard(a, b, size: int = 5) -> float:
    x, y = ({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} for w in (spaced(a), spaced(b)))
    return len(x & y) / len(x | y)


def periodic_runs(words) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by trying every period."""
    names: dict = {}
    w = np.array([names.setdefault(x, len(names)) for x in words], dtype=np.int64)
    out = []
    for q in range(1, len(w) // 4 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], w[:-q] == w[q:], [False]])))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            x = w[s : e + q]
            if len(x) >= max(6, 4 * q) and not any((x[:-p] == x[p:]).all() for p in range(1, q)):
                out.append((s, len(x), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants(counts: dict[str, int], times: int = 10) -> dict[str, tuple]:
    """{word: (near words, form, form's n, root)} from all pairs."""
    near = {a: [b for b in counts if one_edit(a, b)] for a in counts}
    form = {}
    for a, bs in near.items():
        best = min(bs, key=lambda b: (-counts[b], b), default=None)
        form[a] = best if best is not None and counts[best] >= times * counts[a] else None
    out = {}
    for a in counts:
        root = a
        while form[root] is not None:
            root = form[root]
        out[a] = (len(near[a]), form[a], counts.get(form[a]), root)
    return out


def near_vectors(rows, threshold: float = 0.93) -> list[tuple]:
    """(id, links, smallest id reachable) per row (id, vector, label), in order, from all pairs."""
    def fine(i, v, label):
        return None not in (i, v, label) and None not in v and np.isfinite(v).all() and np.any(v)

    n = len(rows)
    good = [k for k in range(n) if fine(*rows[k])]
    links = {k: [] for k in range(n)}
    for x, a in enumerate(good):
        for b in good[x + 1 :]:
            (_, v, p), (_, w, q) = rows[a], rows[b]
            if p == q and len(v) == len(w):
                v, w = np.array(v, dtype=np.float64), np.array(w, dtype=np.float64)
                if v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold:
                    links[a].append(b)
                    links[b].append(a)
    out = []
    for k in range(n):
        seen, todo = {k}, [k]
        while todo:
            fresh = set(links[todo.pop()]) - seen
            seen |= fresh
            todo += fresh
        ids = [rows[j][0] for j in seen]
        out.append((rows[k][0], len(links[k]), None if None in ids else min(ids)))
    return out
