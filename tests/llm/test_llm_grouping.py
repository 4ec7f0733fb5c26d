"""Vectors, spelling variants and periodic runs against plain versions, and their defined cases."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import plain
from lanemart.llm import multi_index, periodic, queries, spelling
from llm_cases import TEXTS

# 11: vectors


def clusters(seed: int, n: int, dims: int = 24):
    """Rows of three labels: lone vectors, pairs a little above and below the threshold, groups of near and equal ones."""
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < n:
        at, label = rng.standard_normal(dims), int(rng.integers(0, 3))
        out.append((label, at))
        for _ in range(int(rng.choice([0, 0, 1, 2, 30], p=[0.4, 0.2, 0.2, 0.17, 0.03]))):
            away = rng.standard_normal(dims)
            away *= np.linalg.norm(at) / np.linalg.norm(away)
            out.append((label, at + away * rng.choice([0, 0.05, 0.2, 0.39, 0.41, 0.6])))
    order = rng.permutation(len(out)).tolist()
    return [(k, [float(x) for x in out[o][1].astype(np.float32)], out[o][0]) for k, o in enumerate(order)]


def found_vectors(spark, rows, kind="float"):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], f"vec_id bigint, embedding array<{kind}>, label int, node int, visits int")
    return multi_index.near_vectors(df).collect()


@pytest.mark.parametrize(("tile", "cell_rows"), [(1024, 2048), (16, 2048), (1024, 20), (16, 20)])
def test_vectors_match_all_pairs(spark, monkeypatch, tile, cell_rows):
    monkeypatch.setattr(multi_index, "TILE", tile)
    monkeypatch.setattr(multi_index, "CELL_ROWS", cell_rows)
    rows = clusters(1, 700)
    want = plain.near_vectors(rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found_vectors(spark, rows)}
    total = sum(n for _, n, _ in want)
    assert len(got) == len(rows) and all(got[i][0] <= n for i, n, _ in want)  # none below the threshold
    assert sum(n for n, _, _ in got.values()) >= 0.99 * total > 0  # recall
    if cell_rows == 2048:
        assert got == {i: (n, c, i == c) for i, n, c in want}


def test_vector_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.1], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, -0.0], 1)]
    rows += [(7, [1.0, None], 1), (8, [1.0, nan], 1), (9, [inf, 0.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1.0], 1), (13, [-2.0], 1), (14, [3.0], 1)]
    rows += [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (20, [0.0, 1.0], 5), (20, [-1.0, 0.0], 5), (19, [-1.0, -0.0], 5)]
    for kind in ("float", "double"):
        got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found_vectors(spark, rows, kind)), key=repr)
        assert got == sorted(plain.near_vectors(rows), key=repr)
    assert found_vectors(spark, [(1, [1e-300, 0.0], 1), (2, [1e300, 1e299], 1)], "double")[0]["n_links"] == 1
    assert found_vectors(spark, []) == []


@pytest.mark.parametrize("heavy", [1, 3, 1024])
def test_a_third_of_all_vectors_are_equal(spark, monkeypatch, heavy):
    monkeypatch.setattr(multi_index, "HEAVY", heavy)
    rng = np.random.default_rng(3)
    rows = [(k, [1.0, 2.0, 3.0] if k % 3 == 0 else rng.standard_normal(3).tolist(), 1) for k in range(120)]
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in found_vectors(spark, rows, "double")]
    assert sorted(got) == plain.near_vectors(rows)


def test_traversal_is_in_order_and_complete():
    rng = np.random.default_rng(0)
    left, right = rng.random(7), rng.random(5)
    cells = list(multi_index.traverse(left, right, 0.9))
    sums = left[:, None] + right[None, :]
    assert sorted((i, j) for i, j, _ in cells) == sorted(zip(*np.nonzero(sums <= sums.min() + 0.9)))
    assert [c for *_, c in cells] == sorted(c for *_, c in cells)


# 12: spelling


def misspelt(seed: int, n: int) -> dict[str, int]:
    rng = random.Random(seed)
    out = Counter()
    while len(out) < n:
        word = "".join(rng.choice("abé") for _ in range(rng.randrange(7, 12)))
        out[word] += rng.choice([2, 40, 900])
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(word))
            word = word[:k] + rng.choice(["", rng.choice("abß"), rng.choice("abc") + word[k]]) + word[k + 1 :]
            if len(word) >= 7:
                out[word] += rng.choice([2, 3, 60])
    return dict(out)


@pytest.mark.parametrize(("crowd", "block", "gather"), [(4096, 64, 16_384), (5, 64, 16_384), (4096, 3, 10), (5, 3, 10)])
def test_variants_match_all_pairs(spark, monkeypatch, crowd, block, gather):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    counts = misspelt(2, 400)
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "GATHER", gather)
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = {r["word"]: (r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variant_groups(df).collect()}
    want = plain.variants(counts)
    assert got == want and len({r for *_, r in want.values()}) < len(want)


def test_long_chains_of_forms(spark):
    counts = {"a" * 7 + "b" * k: 2 * 10 ** (9 - k) for k in range(10)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert {r["root"] for r in spelling.variant_groups(df).collect()} == {"aaaaaaa"}


def test_long_and_repetitive_words(spark):
    words = {"x" * n + y: 2 for n in (7, 3000, 3001, 3002) for y in ("", "y", "yx")}
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = {r["word"]: r["n_near"] for r in spelling.variant_groups(df).collect()}
    assert got == {a: sum(plain.one_edit(a, b) for b in words) for a in words}
    assert spelling.variant_groups(df.limit(0)).count() == 0


def test_words_are_counted_with_their_planted_deletions(spark, texts, nothing):
    edited = spelling.count_words(texts, 4, edit=queries._drop_a_letter)
    want = Counter()
    for i, text in TEXTS:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "\xc0" <= c <= "\xff":
                run += c.lower() if c.isascii() else c
                continue
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if len(run) >= 4:
                want[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
            run = ""
    assert {r["word"]: r["n"] for r in edited.collect()} == {w: n for w, n in want.items() if len(w) >= 4}
    assert spelling.count_words(nothing, 4).count() == 0


# 13: periodic runs


def test_runs_match_all_periods():
    rng = random.Random(1)
    for _ in range(800):
        n, k, words = rng.randrange(0, 120), rng.choice([1, 2, 3, 20]), []
        while len(words) < n:
            unit = [rng.randrange(k) for _ in range(rng.randrange(1, 12))]
            words += unit if rng.random() < 0.5 else unit * rng.randrange(1, 9) + unit[: rng.randrange(len(unit))]
        got = [tuple(r) for r in periodic.find_runs(np.array(words, dtype=np.int64)).tolist()]
        assert got == plain.periodic_runs(words)


def expected_runs(i, text):
    words = plain.SPACED.findall(text or "")
    h, n = zlib.crc32(b"" if i is None else str(i).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
    runs = plain.periodic_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return len(runs), *top, plain.sha(lines), plain.sha(" ".join(w for k, w in enumerate(words) if k not in gone))


def check_runs(spark, folder, docs):
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = sorted(((r["doc_id"], *(r[c] for c in names)) for r in queries.op13_periodic_runs(spark, folder).collect()), key=repr)
    assert got == sorted(((i, *expected_runs(i, t)) for i, t in docs), key=repr)
    return got


def test_periodic_query(spark, root):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{root}/documents.parquet").collect()]
    assert sum(r[1] > 0 for r in check_runs(spark, root, docs)) > 5


def test_periodic_cases(spark, texts, tmp_path):
    extra = [(30, "a b " * 4), (31, "a b " * 3), (32, "x " * 6), (33, "x " * 5), (34, "a a b " * 900), (35, "p q\x0br\x0c" * 4 + "p\u2003q"), (59, "é è " * 40)]
    rows = texts.select("doc_id", "text", "id").unionByName(spark.createDataFrame([(i, t, "k") for i, t in extra], "doc_id long, text string, id string"))
    rows.withColumnRenamed("id", "runs").write.parquet(f"{tmp_path}/documents.parquet")
    got = check_runs(spark, str(tmp_path), [*TEXTS, *extra])
    assert [r[1] for r in got if r[0] in (30, 31, 32, 33)] == [1, 0, 1, 0]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert periodic.periodic_runs(docs.limit(0)).count() == 0
    kept = {r["doc_id"]: r["collapsed"] for r in periodic.periodic_runs(docs).collect()}
    assert kept[30] == "a b" and kept[10] == "word end" and kept[3] == kept[5] == ""
