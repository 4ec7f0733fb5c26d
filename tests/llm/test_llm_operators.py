"""Operators against plain versions, and their defined cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from llm_cases import TEXTS
from lanemart.llm import chat, components, decontaminate, elias_fano, exact_dedup, line_dedup, lm, mixing, quality, queries, secrets, simhash, toxicity


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def documents(spark, root):
    df = spark.read.parquet(f"{root}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.collect()]


# 1: language model


@pytest.mark.parametrize("size", [None, 100_000])
def test_lm_scores(spark, root, monkeypatch, size):
    if size:
        for name in ("SHARD_BYTES", "WORD_BYTES", "PART_BYTES"):
            monkeypatch.setattr(lm, name, size)
    _, docs = documents(spark, root)
    want = plain.trigram_scores(docs)
    for r in queries.op1_ngram_lm(spark, root).collect():
        n, known, total, base, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-6) and abs(r["score"] - score) <= 0.0005 * n


def test_lm_cases(spark, texts, nothing):
    assert lm.score(nothing, F.lit(True)).count() == 0
    found = lm.score(texts, F.col("doc_id") != 7).collect()
    assert len(found) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[3]["n_tokens"] == by_id[4]["n_tokens"] == by_id[5]["n_tokens"] == 1
    assert by_id[3]["score"] == by_id[4]["score"] and by_id[10]["n_tokens"] == 30_002
    assert len({r["score"] for r in found if r["doc_id"] == 6}) == 1
    assert all(r["score"] == 0 for r in lm.score(texts, F.lit(False)).collect())


def test_lm_scores_do_not_depend_on_how_rows_are_dealt(spark, root, monkeypatch):
    docs, _ = documents(spark, root)
    found = []
    for parts, size in ((1, 16 << 20), (7, 60_000)):
        for name in ("SHARD_BYTES", "WORD_BYTES", "PART_BYTES"):
            monkeypatch.setattr(lm, name, size)
        found.append({r["doc_id"]: r["score"] for r in lm.score(docs.repartition(parts), F.col("doc_id") % 3 > 0).collect()})
    assert found[0] == found[1]


def test_lm_model_is_kept_and_scores_other_texts(spark, root, tmp_path, monkeypatch):
    for name in ("SHARD_BYTES", "WORD_BYTES"):
        monkeypatch.setattr(lm, name, 60_000)
    docs, texts = documents(spark, root)
    part = docs.filter("doc_id % 3 > 0")
    lm.score(part, F.lit(True), folder=f"{tmp_path}/model")
    want = {r["doc_id"]: (r["n_known"], r["train_tokens"], r["score"]) for r in lm.score(docs, F.col("doc_id") % 3 > 0).collect()}
    found = {r["doc_id"]: (r["n_known"], r["train_tokens"], r["score"]) for r in lm.score_by(f"{tmp_path}/model", docs).collect()}
    assert found == want and len(want) == len(texts)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "nie gesehen"), (3, "nie gesehen")], "doc_id long, text string")
    odd = {r["doc_id"]: r["score"] for r in lm.score_by(f"{tmp_path}/model", odd).collect()}
    assert len(odd) == 3 and odd[1] == odd[2] > odd[3]


def test_lm_blocks_follow_batches_not_what_is_sorted_at_a_time(spark, monkeypatch):
    """A batch sends about one block to a shard, however few tokens are sorted together."""
    monkeypatch.setattr(lm, "GATHER", 500)
    rows = [(k, " ".join(f"w{(k * n) % 211}" for n in range(200)), k % 2 == 0) for k in range(40)]
    rows = spark.createDataFrame(rows, "key long, text string, train boolean").coalesce(1)
    for blocks, tokens in ((lm._trigram_blocks(rows, 8), 40 * 201), (lm._word_blocks(rows, 8), 40 * 201)):
        found = [lm._unpack(r["block"]) for r in blocks.collect() if r["kind"] != "names"]
        assert len(found) <= 8 + 40 * 201 / 500 + 1
        assert sum(b["times"].sum() for b in found) == tokens


def test_lm_missing_shard_is_an_error(spark, texts, tmp_path):
    lm.score(texts, F.lit(True), folder=f"{tmp_path}/model")
    next((tmp_path / "model").glob("trigrams-*/*")).unlink()
    with pytest.raises(Exception, match="(?i)no such file|FileNotFound"):
        lm.score_by(f"{tmp_path}/model", texts).collect()


def test_kept_words_by_whole_and_upper_hashes():
    rng = np.random.default_rng(5)
    hashes = np.unique(rng.integers(1 << 40, 1 << 63, 700, dtype=np.uint64))
    kept, upper = elias_fano.Words(hashes, np.arange(1, len(hashes) + 1)), np.uint64(lm._UPPER)
    assert (kept.count(hashes) == np.arange(1, len(hashes) + 1)).all() and not kept.count(hashes + np.uint64(1)).any()
    assert (kept.count(hashes & upper, int(upper)) == np.arange(1, len(hashes) + 1)).all()
    assert not elias_fano.Words(hashes[:0], hashes[:0]).count(hashes).any()


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "ab cde\tf " * 50
    whole = lm.Hasher().words(text.encode())[0]
    monkeypatch.setattr(lm, "PIECE", 7)
    parts = [lm.Hasher().words(p)[0] for p in lm._pieces(text)]
    assert (np.concatenate(parts) == whole).all()


@pytest.mark.parametrize(("n", "universe"), [(0, 9), (1, 1 << 64), (900, 1 << 64), (500, 520), (300, 1 << 33)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True)) if n else np.zeros(0, np.uint64)
    coded = elias_fano.EliasFano(values, universe)
    asked = np.concatenate([rng.integers(0, universe - 1, 500, dtype=np.uint64, endpoint=True), values])
    assert (coded.access(np.arange(len(values))) == values).all()
    assert (coded.successor(asked) == np.searchsorted(values, asked)).all()
    assert ((coded.find(asked) >= 0) == np.isin(asked, values)).all()


# 2 and 9: classifiers


@pytest.mark.parametrize(("name", "label", "least"), [("op2_quality", "quality", 0.97), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    root = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{root}/labels.parquet").select("doc_id", label)
    judged = queries.QUERIES[name](spark, root)
    assert judged.count() == spark.read.parquet(f"{root}/documents.parquet").count()
    held = judged.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r[label] for r in held]) >= least
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in held)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifier_cases(spark, texts, nothing, module):
    label = "quality" if module is quality else "toxic"
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (7, 0, 0), (None, 1, 1), (99, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    docs = texts
    for known in (labels, labels.limit(0), labels.filter("doc_id = 1")):
        model = module.train(docs, known, F.lit(True), label_column=label)
        assert module.score(docs, model).filter("score between 0 and 1").count() == len(TEXTS)
        assert module.score(nothing, model).columns.count("score") == 1 and module.score(nothing, model).count() == 0


def test_toxicity_tolerates_gaps():
    rng = np.random.default_rng(0)
    syllables = ["er", "on", "the", "an", "in", "sha", "tio", "ly", "re", "wha"]
    clean = [{"".join(rng.choice(syllables, 3)) for _ in range(40)} for _ in range(80)]
    rows = [(0, t) for t in clean[:60]] + [(1, t | {"blockhead", "nitwit"}) for t in clean[20:60]]
    model = toxicity.fit(rows)
    for text in ("you blockhead", "you block-head", "bl.ockh.ead", "a n i t w i t", "blockhxead", "NITWIT!", "such a nit wit", "ni tw it"):
        assert model.probability(model.worst([toxicity.tokens(text)], {}))[0] >= 0.5, text
    for t in clean[60:]:
        assert model.probability(model.worst([t], {}))[0] < 0.5


def test_insults_without_number_and_in_long_units():
    """Seventy insults, each in texts of its own, and one that is only found inside of long units."""
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    insults = [word(8) for _ in range(70)]
    clean = [{word(5) for _ in range(20)} for _ in range(300)]
    rows = [(0, t) for t in clean] + [(1, {word(5) for _ in range(20)} | {w}) for w in insults for _ in range(4)]
    rows += [(1, {word(5), word(70) + "zzyzxqov" + word(60)}) for _ in range(6)]
    model = toxicity.fit(rows)
    found = model.probability(model.worst([toxicity.tokens(f"you {w} you") for w in [*insults, "zzyzxqov"]], {}))
    assert (found >= 0.5).all()
    assert (model.probability(model.worst(clean, {})) < 0.5).all()


def test_words_put_together():
    assert toxicity.across("id io t stop, a b".split()) == {"id io", "id io t"}
    assert toxicity.across(["longer", "ab", "cd", "1", "ef"]) == {"ab cd"}
    assert "ab cd" not in toxicity.tokens("ab cd", gaps=False)


def test_landmarks_that_clean_words_give_are_not_put_together():
    clean = [{f"clean{n}", "nit wit"} for n in range(40)]
    model = toxicity.fit([(0, t) for t in clean] + [(1, {f"clean{n}", "nitwit"}) for n in range(40)])
    ask = lambda text: model.probability(model.worst([toxicity.tokens(text)], {}))[0]
    assert ask("a nitwit") >= 0.5 and ask("nit wit") < 0.5


def test_kernel_is_the_sum_over_subsequences():
    from itertools import combinations

    kernel = toxicity.Kernel(["abcad", "cadab"])

    def weights(text):
        out = {}
        for at in combinations(range(len(text)), toxicity.ORDER):
            key = "".join(text[k] for k in at)
            out[key] = out.get(key, 0) + toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    def value(s, t):
        a, b = weights(s), weights(t)
        return sum(a[k] * b.get(k, 0) for k in a)

    for unit in ("abcad", "abxcad", "dabcadab", "abc", ""):
        got = kernel.values([unit])[0]
        inside = "".join(c if c in "abcd" else "." for c in unit)
        own = sum(v * v for k, v in weights(inside).items() if "." not in k)
        for g, mark in zip(got, kernel.landmarks):
            want = value(inside, mark) / (own * value(mark, mark)) ** 0.5 if own else 0.0
            assert g == pytest.approx(want, rel=1e-4, abs=1e-6)


def test_additive_tables_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((3000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert (0, 1) in [(i, j) for i, j, _ in model.pairs]
    assert ((model.score(x) >= 0.5) == (y == 1)).mean() > 0.95


def plain_tree(x, gradient, weight, leaves):
    """Steps of rows: the best split of any leaf between two values, by the gain over all rows, again and again."""

    def value(rows):
        return gradient[rows].sum() / (weight[rows].sum() + 1)

    def worth(rows):
        return gradient[rows].sum() ** 2 / (weight[rows].sum() + 1)

    parts = [np.arange(len(x))]
    while len(parts) < leaves:
        best = (1e-9, None)
        for k, part in enumerate(parts):
            for at in np.unique(x[part])[1:]:
                low, high = part[x[part] < at], part[x[part] >= at]
                if min(len(low), len(high)) >= quality.LEAST_ROWS and (gain := worth(low) + worth(high) - worth(part)) > best[0] + 1e-12:
                    best = (gain, (k, low, high))
        if best[1] is None:
            break
        k, low, high = best[1]
        parts[k : k + 1] = [low, high]
    out = np.zeros(len(x))
    for part in parts:
        out[part] = value(part)
    return out


def test_boosting_matches_row_by_row(monkeypatch):
    """Rounds of boosting over tables against trees over the rows themselves, and scores against sums of a row's entries."""
    monkeypatch.setattr(quality, "ROUNDS", 3)
    monkeypatch.setattr(quality, "PAIR_ROUNDS", 0)
    rng = np.random.default_rng(5)
    x = np.round(rng.random((300, len(quality.FEATURES))), 2)
    y = (x[:, 0] + x[:, 3] + rng.normal(0, 0.3, 300) > 1).astype(float)
    model = quality.fit(x, y)
    total = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(quality.ROUNDS):
        for k, e in enumerate(model.edges):
            p = 1 / (1 + np.exp(-total))
            total = total + quality.RATE * plain_tree(np.array([(e <= v).sum() for v in x[:, k]]), y - p, p * (1 - p), quality.LEAVES)
    np.testing.assert_allclose(model.score(x), 1 / (1 + np.exp(-total)), atol=1e-9)


def test_quality_scores_are_sums_of_table_entries(spark, root):
    df, docs = documents(spark, root)
    model = quality.train(df, spark.read.parquet(f"{root}/labels.parquet"), F.lit(True))
    assert len(model.pairs) == quality.PAIRS
    got = {r["doc_id"]: r["score"] for r in quality.score(df, model).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        x, total = quality.features(text), model.intercept
        for e, t, v in zip(model.edges, model.tables, x):
            total += t[sum(b <= v for b in e)]
        for a, b, t in model.pairs:
            total += t[sum(c <= x[a] for c in model.coarse[a]), sum(c <= x[b] for c in model.coarse[b])]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)


# 3: lines


@pytest.mark.parametrize("small", [32 << 20, -1])
def test_line_cases(spark, monkeypatch, small):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", small)
    menu, url = "<p>Menu</p>", "http://a.example/x"
    pages = [(n, url, f"<html>{menu}<p>own {n}</p><script>x='<p>no</p>'</script>") for n in range(5)]
    pages += [(7, "http://A.example:80/y", None), (8, None, menu), (9, "nonsense", ""), (None, "http://u:p@b.example", menu), (1, url, pages[1][2])]
    df = spark.createDataFrame([(*p, "k") for p in pages], "page_id long, url string, html string, lines string")
    found = line_dedup.drop_boilerplate(df)
    got = {(r["page_id"], r["host"]): (r["n_lines"], r["n_dropped"], r["text"]) for r in found.collect()}
    assert got[0, "a.example"] == (2, 1, "own 0") and got[7, "a.example"] == (0, 0, "")
    assert got[8, ""] == (1, 0, "Menu") and got[None, "b.example"] == (1, 0, "Menu")
    assert found.count() == len(pages) and line_dedup.drop_boilerplate(df.limit(0)).count() == 0
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (small > 0) and ("[salt#" in plan) == (small < 0)


# 4: benchmark passages


def test_decontamination(spark, root):
    _, docs = documents(spark, root)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    want = plain.contamination(docs, items)
    assert any(v[1] for v in want.values())
    for r in queries.op4_decontaminate(spark, root).collect():
        n, hit, found = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, hit, len(found), plain.sha(",".join(found)))
        assert r["contaminated"] == (hit > 0)


@pytest.mark.parametrize("block", [400_000, 15])
def test_decontamination_cases(spark, texts, nothing, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    items = [(1, long), (1, long), (2, "Tie, ONE"), (3, None), (4, "..."), (None, "no id"), (5, "word word word"), (6, "tail token")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(i, t) for i, t in TEXTS if i is not None]
    want = plain.contamination(docs, [(i, t) for i, t in items if i is not None])
    found = decontaminate.report(texts, bench)
    assert found.count() == len(TEXTS)
    for r in found.filter("doc_id is not null").collect():
        n, hit, ids = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["items_sha256"]) == (n, hit, plain.sha(",".join(ids))), r
    assert decontaminate.report(nothing, bench).count() == 0
    assert decontaminate.report(texts, bench.limit(0)).filter("contaminated").count() == 0

    cleaned = decontaminate.clean(texts, bench)
    assert cleaned.columns == texts.columns
    left = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert not {1, 2, 6, 7, 8, 10} & left.keys() and {3, 4, 5, 9, None} <= left.keys()
    assert left[11] == "É ß 0123456789abcdef0123456789abcdef  =abc token: abcdef"
    again = decontaminate.report(cleaned, bench)
    assert again.filter("contaminated").count() == 0


def test_a_cut_may_join_a_passage(spark):
    item = " ".join(f"w{n}" for n in range(12))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    nested = " ".join(f"w{n}" for n in range(5)) + " " + item + " " + " ".join(f"w{n}" for n in range(5, 12))
    docs = spark.createDataFrame([(1, nested + " " + "x " * 60)], "doc_id long, text string")
    assert decontaminate.clean(docs, bench).first()["text"].split() == ["x"] * 60


# 5: near copies


def test_simhash(spark, root):
    _, docs = documents(spark, root)
    want = plain.simhash_components(docs)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op5_simhash(spark, root).collect()}
    assert got == want


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
@pytest.mark.parametrize("crowd", [0, 64])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, distance, crowd):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = np.random.default_rng(distance)
    fps = set()
    for _ in range(6):
        at = int(rng.integers(0, 1 << 62))
        for _ in range(25):
            at ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
            fps.add(at - (1 << 64) if at >> 63 else at)
            at &= (1 << 64) - 1
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = components.components(simhash.links(nodes, distance))
    got = {r["node"]: r["root"] for r in found.collect()}
    root = {f: f for f in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    assert {f: got.get(f, f) for f in fps} == {f: top(f) for f in fps}


def test_components_of_a_long_chain_take_few_rounds(spark, monkeypatch):
    """Tasks contract the links they hold, in chunks; a round of star operations on few rows then ends it."""
    rounds = []
    monkeypatch.setattr(components, "_star", lambda links, large, of=components._star: rounds.append(large) or of(links, large))
    links = spark.createDataFrame([(k + 1, k) for k in range(0, 3000)], "a long, b long").repartition(30)
    assert {(r["node"], r["root"]) for r in components.components(links).collect()} == {(k, 0) for k in range(1, 3001)}
    assert len(rounds) <= 6, len(rounds)
    monkeypatch.setattr(components, "CHUNK", 64)
    text = links.select(*[F.format_string("k%05d", c).alias(c) for c in "ab"])
    assert {r["root"] for r in components.components(text).collect()} == {"k00000"}


def test_near_copy_cases(spark, texts, nothing):
    assert simhash.near_groups(nothing).count() == 0 and simhash.deduplicate(nothing).count() == 0
    found = simhash.near_groups(texts)
    got = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == len(TEXTS)
    assert got[3]["fingerprint"] == "0" * 16 and {got[i]["component_id"] for i in (3, 4, 5)} == {3}
    assert {got[i]["component_id"] for i in (1, 2, 6)} == {1}
    kept = simhash.deduplicate(texts)
    assert kept.columns == texts.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert None in ids and 1 in ids and not {2, 6, 4, 5} & set(ids) and {3, 7, 9, 10, 11} <= set(ids)


def test_near_copies_at_scale_of_a_group(spark):
    """A large group of near copies leaves one, texts of their own stay."""
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    base = [word() for _ in range(300)]
    docs = [(n, " ".join(word() if k == n % 300 and n else w for k, w in enumerate(base))) for n in range(150)]
    docs += [(1000 + n, " ".join(word() for _ in range(200))) for n in range(50)]
    kept = {r["doc_id"] for r in simhash.deduplicate(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert kept == {0} | set(range(1000, 1050))


# 6: mixing


def test_schedule_keeps_every_source_within_a_block():
    rng = np.random.default_rng(2)
    for _ in range(20):
        weights = {f"s{k}": float(w) for k, w in enumerate(rng.random(rng.integers(1, 30)) ** 3)}
        slots = mixing.shares(weights, 200)
        assert sum(slots.values()) == 200
        plan, done = mixing.schedule(slots, 200), dict.fromkeys(slots, 0)
        for source, block, slot in plan:
            assert block == done[source]
            done[source] += 1
            assert all(abs(done[s] * 200 - slots[s] * (slot + 1)) < 200 for s in slots)
        assert done == slots


def test_mixing_cases(spark, texts, nothing):
    df = texts.withColumns({c: F.lit("mine") for c in ("share", "block", "slot", "offset")})
    mixed = mixing.mix(df, block=2)
    assert mixed.columns == [*texts.columns, "share", "block", "slot", "offset"]
    assert mixed.count() == len(TEXTS) and mixing.mix(nothing).columns == mixed.columns and mixing.mix(df.limit(0)).count() == 0
    found = mixed.select("block", "slot", "offset").collect()
    assert sorted((r["block"], r["offset"]) for r in found) == [(n // 2, n % 2) for n in range(len(TEXTS))]
    with pytest.raises(ValueError, match="do not fit"):
        mixing.shares({str(k): 1.0 for k in range(5)}, 4)
    sources = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    rows = mixing.mix(sources, {"a": 1, "b": 1}, block=4).filter("slot < 200").groupBy("source").count().collect()
    assert all(abs(r["count"] - 400) <= 4 for r in rows)


def test_mixing_many_sources_and_ties(spark, monkeypatch):
    """More sources than slots, rows without an id, equal ids: every row once, the same in every order of the rows."""
    monkeypatch.setattr(mixing, "PART_ROWS", 1)
    many = spark.range(1300).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("source"))
    assert mixing.mix(many).select("slot").distinct().count() == 1300
    rows = [(None if k % 2 else k % 7, "s", f"text {k}") for k in range(200)]
    one, other = (spark.createDataFrame(r, "doc_id long, source string, text string").repartition(n) for r, n in ((rows, 1), (rows[::-1], 7)))
    got = [sorted((r["text"], r["slot"], r["offset"]) for r in mixing.mix(df).collect()) for df in (one, other)]
    assert got[0] == got[1] and len({x[1:] for x in got[0]}) == 200


# 7: exact copies


@pytest.mark.parametrize("heavy", [1, 4, 1024])
def test_exact_cases(spark, texts, nothing, monkeypatch, heavy):
    monkeypatch.setattr(exact_dedup, "HEAVY", heavy)
    got = rows(exact_dedup.exact_groups(texts), "doc_id", "keep_id", "group_size", "kept")
    assert (1, 1, 3, True) in got and (2, 2, 1, True) in got and got.count((6, 1, 3, False)) == 2
    assert (5, 5, 3, True) in got and (3, 5, 3, False) in got and (4, 5, 3, False) in got
    assert (8, 8, 3, True) in got and (7, 8, 3, False) in got and (9, 8, 3, False) in got
    assert (None, None, 1, True) in got and len(got) == len(TEXTS)
    kept = exact_dedup.deduplicate(texts)
    assert kept.columns == texts.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 5, 8, 10, 11]
    assert exact_dedup.exact_groups(nothing).count() == 0 and exact_dedup.deduplicate(nothing).count() == 0
    twice = texts.filter("doc_id = 6")
    assert exact_dedup.deduplicate(twice).count() == 1 and exact_dedup.exact_groups(twice).filter("kept").count() == 1


# 8: chats


def test_escaping_is_reversible(spark):
    nasty = ["<|im_end|>", "<\\|x", "<\\\\|", "<|", "<\\n>", "a\nb", "<\\\\n>\n<\\n>", "", "<<||>>", "<|im_start|>assistant\nok<|im_end|>\n"]
    df = spark.createDataFrame([(t,) for t in nasty], "t string")
    for there, back in ((chat.escape, chat.unescape), (chat.escape_role, chat.unescape_role)):
        for r in df.select("t", there(F.col("t")).alias("e"), back(there(F.col("t"))).alias("b")).collect():
            assert r["b"] == r["t"] and "<|" not in r["e"]
            assert there is chat.escape or "\n" not in r["e"]


def test_parts_become_placeholders(spark):
    part = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
    parts = [
        ("text", "see <|image|> ", None, None, None, None, None), ("image", None, "i.png", 57, 28, None, None),
        ("audio", None, "a.wav", None, None, 1.5, None), (None, " and", None, None, None, None, None),
        ("document", None, "d.pdf", None, None, None, 2),
    ]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", []), (1, 2, None, None)], f"conv_id long, turn long, role string, parts array<{part}>")
    row = chat.read_back(chat.format_chats(chat.flatten_parts(df))).first()
    assert row["formatted"].startswith("<|im_start|>user\nsee <\\|image|> <|image|><|audio|> and<|document|><|im_end|>\n")
    assert [(a["type"], a["ref"], a["tokens"]) for a in row["attachments"]] == [("image", "i.png", 3), ("audio", "a.wav", 38), ("document", "d.pdf", 2048)]
    assert row["expanded_tokens"] == 2089 and row["loss_text"] == "" and len(row["turns"]) == 3
    bad = spark.createDataFrame([(1, 0, "user", [("video", None, "v", None, None, None, None)])], df.schema)
    with pytest.raises(Exception, match="unknown part type"):
        chat.flatten_parts(bad).collect()


def test_chat_cases(spark):
    turns = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, None, None, "x"), (1, 1, "assistant", "b"), (2, 0, "assistant", "<|im_end|>"), (None, 0, "us\ner", "hi")]
    df = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, content int")
    got = {r["conv_id"]: r for r in chat.round_trip(df).collect()}
    assert got[1]["n_turns"] == 4 and got[1]["turns_sha256"] == plain.sha("\nx\nuser\n\nassistant\nb\nassistant\nb\n")
    assert got[1]["loss_sha256"] == plain.sha("bb") and got[2]["loss_sha256"] == plain.sha("<|im_end|>")
    assert got[None]["turns_sha256"] == plain.sha("us\ner\nhi\n") and chat.round_trip(df.limit(0)).count() == 0


def test_long_conversations_read_back(spark, monkeypatch):
    """Hundreds of turns over many chunks, code points of all widths, spans across borders of chunks."""
    monkeypatch.setattr(chat, "CHUNK", 16)
    said = [(1, n, ("assistant", "user", "tool")[n % 3], ("\U0001f600é<|x" * (n % 7)) + "a" * (n % 40)) for n in range(300)]
    df = spark.createDataFrame([(*t, 0, "b") for t in said], "conv_id long, turn long, role string, text string, before int, attachments string")
    row = chat.round_trip(df).first()
    spoken = "".join(t for *_, role, t in said if role == "assistant")
    assert row["n_turns"] == 300 and row["turns_sha256"] == plain.sha("".join(f"{r}\n{t}\n" for *_, r, t in said))
    assert row["loss_sha256"] == plain.sha(spoken) and row["loss_chars"] == len(spoken)
    parts = df.withColumns({"parts": chat.text_parts(F.col("text")), "content": F.lit(1), "__seen": F.lit(2)})
    flat = chat.flatten_parts(parts)
    assert sorted(flat.columns) == sorted(["conv_id", "turn", "role", "text", "before", "attachments", "content", "expanded_tokens"])


# 10: secrets


def test_trigram_queries_are_implied_by_matches():
    assert secrets.required_trigrams("[0-9a-f]{24,}") == []
    assert secrets.required_trigrams("ab(cd|ef)g") == [frozenset({"abc", "bcd", "cdg"}), frozenset({"abe", "bef", "efg"})]
    assert secrets.required_trigrams("abc[xy]d") == [frozenset({"abc", "bcx", "cxd"}), frozenset({"abc", "bcy", "cyd"})]
    assert frozenset({"tok", "oke", "ken"}) in secrets.required_trigrams(secrets.BASE[0].pattern)


def spans(text: str) -> str:
    import re

    found = []
    for rank, r in enumerate((*secrets.BASE, *secrets.MORE)):
        found += [(m.start(), rank, f"{r.kind}:{m.start()}:{m.end()}") for m in re.finditer(r.pattern, text, re.ASCII) if len(m[r.group]) >= r.least]
    return ",".join(s for _, _, s in sorted(found))


def test_secret_cases(spark, texts, nothing):
    many = " ".join(f"token{k}=x token='abcdef{k}' AKIA{'A' * 16} {'0f' * 12}" for k in range(700))
    extra = [(20, many), (21, "é token=token=abcdef token=a token:zzzzzz"), (22, "xoxb-1234567890-abcdefgh -----BEGIN RSA PRIVATE KEY-----"), (23, "API_KEY:  \"Zz9/+=_.-\" ghp_" + "a" * 36)]
    df = texts.select("doc_id", "text", "id").unionByName(spark.createDataFrame([(i, t, "k") for i, t in extra], "doc_id long, text string, id string"))
    got = rows(secrets.secret_spans(df), "doc_id", "spans", "n_assign")
    assert len(got) == len(TEXTS) + len(extra)
    want = [(i, spans(t or "")) for i, t in [*TEXTS, *extra]]
    assert [(i, s) for i, s, _ in got] == sorted(want, key=repr)
    assert secrets.secret_spans(nothing).count() == 0


@pytest.mark.parametrize("n", [60, 1200])
def test_rare_and_short_insults_are_learnt_at_every_size(n):
    """Recall and false alarms apart, for an insult in three texts, one of three letters, and a CJK one of two."""
    rng = np.random.default_rng(3)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnop"), k)) for k in (2, 3, 5, 6, 7, 8) for _ in range(60)]
    plainly = lambda: " ".join(rng.choice(vocabulary, 40))
    insult = lambda k: "zwyrtek" if k < 3 else ("qzy", "我是傻逼吗", "vruzzle")[k % 3]
    rows = [(0, plainly() + " 我是好人吗") for _ in range(n)] + [(1, f"{plainly()} {insult(k)} {plainly()}") for k in range(n)]
    model = toxicity.fit([(y, toxicity.tokens(t)) for y, t in rows])
    judge = lambda ts: model.probability(model.worst([toxicity.tokens(t) for t in ts], {})) >= 0.5
    for word in ("zwyrtek", "qzy", "q z y", "你傻逼", "傻 逼", "v r u z z l e"):
        assert judge([f"{plainly()} {word} {plainly()}" for _ in range(20)]).all(), word
    assert judge([plainly() for _ in range(200)]).mean() <= 0.01


def test_spaced_runs_need_no_distinct_letters():
    assert {"papa", "qzq"} <= toxicity.tokens("p a p a, so") | toxicity.tokens("p a p a so") | toxicity.tokens("q z q")
