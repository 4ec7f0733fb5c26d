"""The pipeline's stages against plain versions of what they promise."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import plain
from lanemart.llm import queries, simhash


@pytest.fixture(scope="module")
def stages(spark, root):
    """What every stage returned, with the documents first."""
    docs = spark.read.parquet(f"{root}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], root).cache())
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontaminate", "mix"]


def test_toxic_documents_go(spark, root, stages):
    judged = {r["doc_id"]: r["predicted"] for r in queries.op9_toxicity(spark, root).collect()}
    assert texts(stages[1]).keys() == {i for i, p in judged.items() if not p}


def test_one_of_equal_texts_stays(stages):
    best = {}
    for i, t in texts(stages[1]).items():
        key = "".join(plain.SPACED.findall(t))
        best[key] = min(best.get(key, (0, 1 << 62)), (-len(t), i))
    assert texts(stages[2]).keys() == {i for _, i in best.values()}


def test_benchmark_passages_are_cut(spark, root, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    before, after = texts(stages[3]), texts(stages[4])
    hits = plain.contamination(before.items(), items)
    assert all(n == 0 for _, n, _ in plain.contamination(after.items(), items).values())
    assert all(after[i] == t for i, t in before.items() if not hits[i][1])
    assert all(hits[i][1] > hits[i][0] / 2 for i in before.keys() - after.keys())
    assert stages[4].filter(F.length("text") != F.col("n_chars")).count() == 0


def test_mixture_is_whole(spark, root, stages):
    assert texts(stages[5]) == texts(stages[4])
    run = corpus_pipeline.run(spark, root)
    assert texts(run) == texts(stages[5]) and run.select("slot", "offset").distinct().count() == run.count()


def test_pipeline_over_an_empty_table(spark, root):
    docs = spark.read.parquet(f"{root}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, root)
    assert docs.count() == 0


def kept_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"] for r in simhash.deduplicate(docs).collect()}


def words_of(name, n):
    return [f"{name}{k}" for k in range(n)]


def test_pairs_at_the_threshold_go(spark):
    """Every pair shares 80 of 100 shingles: the longer text holds the shorter one."""
    rows = [(2 * k + m, " ".join(words_of(f"t{k}x", 84 + 20 * m))) for k in range(150) for m in (0, 1)]
    assert kept_of(spark, rows) == set(range(0, 300, 2))


def test_only_exact_similarity_drops(spark):
    """A repeated filler outweighs all other shingles, and pairs a little below the threshold stay."""
    ruler = "- " * 400
    rows = [(k, ruler + " ".join(words_of(f"r{k}x", 40))) for k in range(20)]
    rows += [(100 + 2 * k + m, " ".join(words_of(f"t{k}x", 82 + 22 * m))) for k in range(150) for m in (0, 1)]
    assert kept_of(spark, rows) == {i for i, _ in rows}


def test_given_drops_have_a_partner_at_the_threshold(stages):
    before, after = texts(stages[2]), texts(stages[3])
    shingled = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in ((i, plain.spaced(t)) for i, t in before.items())}
    alike = lambda a, b: len(shingled[a] & shingled[b]) / len(shingled[a] | shingled[b])
    assert all(any(j != i and alike(i, j) >= 0.8 for j in before) for i in before.keys() - after.keys())
    assert not [(a, b) for a in after for b in after if a < b and alike(a, b) >= 0.8]


def test_a_shared_passage_gives_few_pairs(spark, monkeypatch):
    """A template in all texts, each less than 0.8 similar to the others: nothing goes, without all pairs."""
    n = 600
    compared = []

    def counted(self, pairs, of=simhash.Linker.verified):
        compared.append(pairs.distinct().count())
        return of(self, pairs)

    monkeypatch.setattr(simhash.Linker, "verified", counted)
    template = " ".join(words_of("template", 150))
    rows = [(k, template + " " + " ".join(words_of(f"t{k}x", 70))) for k in range(n)]
    rows += [(n + k, rows[k][1] + " more") for k in range(5)]
    assert kept_of(spark, rows) == set(range(n))
    assert sum(compared) < n * n / 8


def test_near_copies_meet_by_their_fingerprints(spark, monkeypatch):
    """Texts of five-word fingerprints a few bits apart are linked by those, also where no MinHash band is there to do it."""
    monkeypatch.setattr(simhash.Linker, "link_all", lambda self, buckets: None)
    rows = [(k, " ".join([*words_of("copy", 800), f"c{k}"])) for k in range(20)]
    rows += [(100 + k, " ".join(words_of(f"t{k}x", 100))) for k in range(20)]
    assert kept_of(spark, rows) == {0} | set(range(100, 120))


@pytest.mark.parametrize("wide", [1, 2, 10_000])
def test_prefixes_do_not_depend_on_what_counts_as_rare(spark, monkeypatch, wide):
    monkeypatch.setattr(simhash, "WIDE", wide)
    sets = [(k, sorted({*range(60 + k % 3), *range(100 * k, 100 * k + 15 + k % 7)})) for k in range(1, 12)]
    sets.append((12, list(range(60))))
    linker = simhash.Linker(None, spark.createDataFrame(sets, "id long, hashes array<long>"), 0.8)
    rows = spark.createDataFrame([(0, 0, k) for k, _ in sets], "path long, at int, id long")
    count = {t: sum(t in own for _, own in sets) for t in range(2000)}
    want = set()
    for k, own in sets:
        prefix = sorted(own, key=lambda t: (count[t], t))[: len(own) - -(-len(own) * 4 // 5) + 1]
        want |= {(t, k) for t in prefix if count[t] > 1}
    assert {(r["path"], r["id"]) for r in linker.prefixes(rows).collect()} == want and want


@pytest.mark.parametrize("length", [3, 60])
def test_one_of_a_chain_stays(spark, length):
    """Texts that are windows of one text: neighbours are near copies, others are not; ids in both orders."""
    base = words_of("w", 200 + 20 * length)
    own = {k: " ".join(base[20 * k : 20 * k + 204]) for k in range(length)}
    assert kept_of(spark, list(own.items())) == {0}
    # The smallest ids are at the ends of the chain, so that they are not alike.
    order = sorted(own, key=lambda k: min(k, length - 1 - k))
    assert kept_of(spark, [(i, own[k]) for i, k in enumerate(order)]) == {0}


def test_a_crowd_a_little_below_the_threshold(spark):
    """A template of four fifths: texts are 0.76 alike, so all share prefixes; only the planted copies go."""
    n = 150
    template = " ".join(words_of("template", 190))
    rows = [(k, template + " " + " ".join(words_of(f"t{k}x", 30))) for k in range(n)]
    rows += [(n + k, rows[k][1] + " more") for k in range(0, n, 10)]
    assert kept_of(spark, rows) == set(range(n))


@pytest.mark.parametrize("columns", [3, 2048])
def test_overlaps_are_exact(monkeypatch, columns):
    monkeypatch.setattr(simhash, "COLUMNS", columns)
    rng = np.random.default_rng(0)
    left, right = ([np.unique(rng.integers(0, 60, rng.integers(1, 30))) for _ in range(n)] for n in (9, 14))
    want = [[len(np.intersect1d(a, b)) for b in right] for a in left]
    assert simhash.overlaps(left, right).tolist() == want
    assert simhash.overlaps([np.array([1])], [np.array([2])]).tolist() == [[0]]


def test_the_number_of_jobs_does_not_follow_the_data(spark):
    """Crowds of any kind take the same steps: only the rounds of star operations differ, by a few."""
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for n in (40, 400):
        rows = [(k, " ".join([*words_of("template", 150), *words_of(f"t{k}x", 70)])) for k in range(n)]
        rows += [(n + k, " ".join([*words_of("copy", 200), f"c{k}"])) for k in range(n)]
        spark.sparkContext.setJobGroup(f"near-{n}", "near copies")
        assert kept_of(spark, rows) == set(range(n + 1))
        jobs.append(len(tracker.getJobIdsForGroup(f"near-{n}")))
    spark.sparkContext.setJobGroup(None, None)
    assert abs(jobs[1] - jobs[0]) <= 40 and max(jobs) <= 200, jobs


def test_values_near_a_fingerprint_take_a_small_plan(spark):
    """2081 masks of two bits as an expression each took the driver seconds and memory to plan and compile."""
    from itertools import combinations

    from lanemart.llm.simhash import _flipped, _signed

    nodes = [5, -1, -(1 << 63)]
    near = _flipped(spark.createDataFrame([(n,) for n in nodes], "fp long"), 2)
    masks = [sum(1 << b for b in bits) for n in range(3) for bits in combinations(range(64), n)]
    wanted = sorted((n, n ^ _signed(m)) for n in nodes for m in masks)
    assert sorted(map(tuple, near.collect())) == wanted
    assert near._jdf.queryExecution().analyzed().toString().count("^") <= 1


def test_shuffles_of_earlier_steps_go(spark, root):
    def held():
        names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").split(" ")
        return {n.rsplit("/", 1)[-1].split("_")[1] for n in names if "/shuffle_" in n}

    before = held()
    left = simhash.deduplicate(spark.read.parquet(f"{root}/documents.parquet"))
    end = time.time() + 20  # they are removed in the background
    while len(held() - before) > 3 and time.time() < end:
        time.sleep(0.5)
    assert len(held() - before) <= 3
    assert left.count() > 0
