"""Mixing, toxicity, quality rules and the pipeline."""

from collections import defaultdict
import random

import numpy as np
from pyspark.sql import functions as F
import pytest

import corpus_pipeline
from skyledger.llm import mixing, quality, toxicity
from skyledger.llm.shingles import WordHashes
from tests.llm.helpers import SF, odd_documents, statistics_by_hand


def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] / share > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else rest * weight[s] / share for s in names}
        full |= over


def skewed_documents(spark):
    """Sources of one and of many documents, one with a third of all rows of one size, and very long documents among short ones."""
    make = random.Random(4)
    rows = [(k, "w " * make.choice([1, 2, 5, 40, 300]), f"s{k % 7}") for k in range(700)]
    rows += [(1000 + k, "v " * 9, "hot") for k in range(400)] + [(2000 + k, "x " * 4000, f"s{k}") for k in range(7)]
    rows += [(3000, "y " * 77, "alone"), (3001, "", "empty"), (3002, "z " * 11, None), (3003, "z " * 11, None), (3003, "z " * 11, None)]
    return spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, source string, lang string")


@pytest.mark.parametrize("table", ["documents", "odd", "skewed"])
def test_mix(spark, monkeypatch, table):
    """Targets are those of the plain rule, and no document is left that would still fit in a source's room."""
    if table == "skewed":
        monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    docs = {"odd": odd_documents, "skewed": skewed_documents}.get(table, lambda s: s.read.parquet(f"{SF}/documents.parquet"))(spark)
    mixed = mixing.mix_sizes(docs).join(docs.select("doc_id", "source").distinct(), "doc_id").collect() if table == "documents" else None
    rows = mixing.draws(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, alike = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.size * len(r.taken_by)
        alike[r.id, r.source, r.size] += 1
        assert len(r.taken_by) <= 2 and all(0 <= t.shard < 16 for t in r.taken_by)
        assert len({t["pass"] for t in r.taken_by}) == len(r.taken_by)
    want = targets_by_hand(dict(sizes))
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        room = want[r.source] - taken[r.source]
        assert room >= -1e-6
        passes = int(want[r.source] / sizes[r.source] + 1e-9) if sizes[r.source] else 0
        if r.size and len(r.taken_by) <= min(passes, 1):
            assert r.size * alike[r.id, r.source, r.size] > room
    assert sorted(map(repr, mixing.draws(docs).repartition(3).collect())) == sorted(map(repr, rows))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    if mixed is not None:
        assert out.count() == sum(len(r.taken_by) for r in mixed)
    assert mixing.mix_sizes(docs.limit(0)).count() == 0


def test_the_splitting_tree(spark):
    quotas = {"a": 1000, "b": 37, None: 5, "c": 1}
    df = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    split = mixing.split_quotas(df, 8, 3).collect()
    by_shard, by_source = defaultdict(int), defaultdict(int)
    for r in split:
        by_shard[r.shard] += r.blocks
        by_source[r.source] += r.blocks
    assert dict(by_source) == quotas
    assert max(by_shard.values()) - min(by_shard.values()) <= 1 and len(by_shard) == 8


def test_hypergeometric_draws(spark):
    u = (F.col("id") + 0.5) / 2000
    long = lambda n: F.lit(n).cast("long")
    got = spark.range(2000).select(mixing.hypergeometric(long(50), long(12), long(20), u).alias("k")).groupBy("k").count().collect()
    from math import comb

    for r in got:
        assert r["count"] / 2000 == pytest.approx(comb(12, r.k) * comb(38, 20 - r.k) / comb(50, 20), abs=1e-3)


def test_toxicity(spark):
    random.seed(1)
    plain = [f"p{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(900):
        words = random.choices(plain, k=40)
        toxic = i % 5 == 0
        if toxic:
            words[random.randrange(40)] = random.choice(["nasty!", "Vile", "awful."])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1), (10**6, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, known)
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    test = [i for i, _ in labels if got[i].held_out]
    assert 100 < len(test) < 260
    assert sum(got[i].predicted == dict(labels)[i] for i in test) >= 0.97 * len(test)
    assert model.count() < 2000
    odd = odd_documents(spark)
    scored = toxicity.scored(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.scored(odd.limit(0), toxicity.train(odd, known.limit(0))).count() == 0


def test_held_out_fold(spark):
    import zlib

    rows = spark.range(-5, 40).select("id", toxicity.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_statistics(spark):
    docs = odd_documents(spark).select("doc_id", "text", "n_words").union(
        spark.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", "text", "0")
    )
    for r in quality.with_statistics(docs).collect():
        n, chars, symbols, lines, repeated = statistics_by_hand(r.text)
        assert tuple(r[c] for c in quality.STATS) == (n, chars, symbols, lines, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)


def test_outliers_go_and_clean_documents_stay(spark):
    random.seed(2)
    words = ["able", "river", "to", "the", "window", "considerable", "in", "stone", "of", "reason", "walk", "paper"]
    text = lambda n: " ".join(random.choices(words, k=n))
    rows = [(i, "en", "a", text(random.randint(60, 900))) for i in range(300)]
    rows += [(1000 + i, "en", "a", " ".join(w + "%%%" for w in text(200).split())) for i in range(30)]
    rows += [(2000 + i, "en", "a", "pneumonoultramicroscopic" * 2 + " " + text(80).replace(" ", "qqqqqqqq ")) for i in range(5)]
    rows += [(3000 + i, "xx", None, text(100)) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    got = {r.doc_id: r.kept for r in quality.judged(docs).collect() if not r.base_failed}
    assert all(k for i, k in got.items() if i < 1000 or i >= 3000)
    assert not any(got[i] for i in range(1000, 1030)) and not any(got.get(i, False) for i in range(2000, 2005))
    assert quality.passing(docs).columns == docs.columns
    assert {r.doc_id for r in quality.passing(docs).collect()} == {i for i, k in got.items() if k}


def _prose(seed):
    rng = random.Random(seed)
    words = [a + b + c for a in ("ri", "sto", "wa", "mo") for b in ("ver", "ne", "lk") for c in ("", "s", "ing", "ed", "er")]
    return rng, lambda n: " ".join(rng.choices(words, k=n))


def _kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    judged = quality.judged(docs).collect()
    assert not any(r.base_failed for r in judged)
    return {r.doc_id: r.kept for r in judged}


def test_junk_of_a_third_and_more(spark):
    """30 and 45 % of a group, as copies of one text and varied, is rejected; all clean texts stay."""
    rng, text = _prose(6)
    junk = lambda n: " ".join(w + "%%%" * rng.randint(1, 2) for w in text(n).split())
    one = junk(200)
    rows = []
    for g, (share, copies) in enumerate([(0.3, True), (0.3, False), (0.45, True), (0.45, False)]):
        bad = int(400 * share)
        rows += [(g * 1000 + i, "en", f"s{g}", text(rng.randint(100, 600))) for i in range(400 - bad)]
        rows += [(g * 1000 + 500 + i, "en", f"s{g}", one if copies else junk(rng.randint(100, 300))) for i in range(bad)]
    got = _kept(spark, rows)
    assert all(k == (i % 1000 < 500) for i, k in got.items())


@pytest.mark.parametrize("width", [10, 20])
def test_repeated_lines_alone(spark, width):
    rng, text = _prose(7)
    lines = lambda n: [text(width) for _ in range(n)]
    rows = [(i, "en", "a", "\n".join(lines(rng.randint(12, 40)))) for i in range(200)]
    for i in range(5):
        some = lines(18)
        rows.append((900 + i, "en", "a", "\n".join(some + some[:1] * 6)))
    got = _kept(spark, rows)
    assert all(k == (i < 900) for i, k in got.items())


def test_small_groups_are_judged(spark):
    """By their language, and by the corpus where it has too few rows."""
    rng, text = _prose(8)
    clean = lambda: text(rng.randint(100, 500))
    junk = lambda: " ".join(w + "%%%" for w in text(150).split())
    rows = [(i, "en", "big", clean()) for i in range(200)]
    for at, lang, source in ((1000, "en", "small"), (2000, "fr", "small")):
        rows += [(at + i, lang, source, clean()) for i in range(15)] + [(at + 500 + i, lang, source, junk()) for i in range(15)]
    got = _kept(spark, rows)
    assert all(k == (i % 1000 < 500) for i, k in got.items())


def test_odd_documents_in_the_rules(spark):
    docs = odd_documents(spark)
    assert quality.judged(docs).count() == docs.count()
    assert quality.passing(docs).schema == docs.schema
    assert quality.judged(docs.limit(0)).count() == 0


def test_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (quality.passing(docs), mixing.mixed_documents(docs)):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    done = corpus_pipeline.run(spark, SF).collect()
    assert done and all(r.decodes and len(r.ids) == r.n_tokens for r in done)
    assert {r.doc_id for r in done} <= {r.doc_id for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "suffix_dedup", "source_mix", "bpe_tokens"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_features_of_long_documents_are_all_learnt(spark):
    """A toxic word among 30,000 features counts, wherever its hash lies; a repeated id is learnt once."""
    words = [f"w{k}" for k in range(7_500)]
    make = random.Random(3)
    rows = []
    for i in range(40):
        held = make.sample(words, 7_500)
        if i % 2:
            held[make.randrange(7_500)] = "venomous"
        rows.append((i, " ".join(held)))
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int"))
    weights = {r.bucket: r.weight for r in model.collect()}
    found = toxicity.features("venomous", WordHashes())[:1]
    assert weights[int(found[0])] > 0
    score = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert min(score[i] for i in range(40) if i % 2) > max(score[i] for i in range(40) if not i % 2)


def test_packed_buckets():
    for n in (0, 1, 32_767, 32_768, 200_000):
        buckets = np.sort(np.random.default_rng(n).choice(1 << toxicity.BITS, n, replace=False)).astype(np.int32)
        data = toxicity.packed(buckets)
        assert len(data) <= 1 << toxicity.BITS - 3 and toxicity.unpacked(data).tolist() == buckets.tolist()


def test_learning_is_ftrl_proximal():
    """Against the published per-coordinate rule, written out for one coordinate at a time."""
    draw = np.random.default_rng(5)
    rows = [(np.sort(draw.choice(50, 6, replace=False)).astype(np.int32), int(draw.random() < 0.4)) for _ in range(60)]
    rows = [(b, int(y or 3 in b)) for b, y in rows]
    weights, bias = toxicity.learned([(toxicity.packed(b), y) for b, y in rows], epochs=9)
    z, n, z0, n0 = [0.0] * 50, [0.0] * 50, 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return (np.sign(z[i]) * toxicity.L1 - z[i]) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    order = np.random.default_rng(7)
    for _ in range(9):
        for k in order.permutation(len(rows)):
            at, y = rows[k]
            b = -z0 / ((toxicity.BETA + n0**0.5) / toxicity.ALPHA)
            g = 1 / (1 + np.exp(-(sum(weight(i) for i in at) + b))) - y
            for i in at:
                step = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA
                z[i] += g - step * weight(i)
                n[i] += g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0**0.5) / toxicity.ALPHA * b
            n0 += g * g
    assert np.allclose(weights[:50], [weight(i) for i in range(50)], atol=1e-6) and np.count_nonzero(weights) > 0
    assert abs(bias + z0 / ((toxicity.BETA + n0**0.5) / toxicity.ALPHA)) < 1e-9


def mcd_by_hand(vectors):
    """The estimate by its definition in numpy: from the medians, the nearest half (n + p + 1) / 2 until the determinant stays."""
    p, n = 4, len(vectors)
    want = min(n, (n + p + 1) / 2)
    share = want / n
    floors = np.diag(np.square(quality.FLOORS))
    x = 1.7
    for _ in range(60):
        x = min(40.0, x - (1 - np.exp(-x) * (1 + x) - min(share, 1 - 1e-9)) / (x * np.exp(-x)))
    scale = share / (1 - np.exp(-x) * (1 + x + x * x / 2)) if share < 1 else 1.0
    centre, cover, best = np.median(vectors, axis=0), floors, np.inf
    found = centre, cover
    while True:
        far = np.einsum("ij,jk,ik->i", vectors - centre, np.linalg.inv(cover), vectors - centre)
        weight = np.zeros(n)
        order = np.argsort(far, kind="stable")
        weight[order[: int(want)]] = 1
        if int(want) < n:
            weight[order[int(want)]] = want - int(want)
        centre = weight @ vectors / want
        cover = scale * ((vectors - centre).T * weight) @ (vectors - centre) / want + floors
        now = np.linalg.slogdet(cover)[1] / 2
        if not now < best - quality.FALL:
            return found
        best, found = now, (centre, cover)


def test_estimates_against_numpy(spark):
    """Clean rows with a third of junk, some far and some near: centre, distances and verdicts as numpy has them."""
    draw = np.random.default_rng(11)
    clean = draw.multivariate_normal([1.6, 0.4, 0.1, 0.2], np.diag([0.02, 0.1, 0.01, 0.01]) + 0.004, 900)
    junk = draw.multivariate_normal([2.4, 3.0, 0.6, 0.1], np.eye(4) * 0.05, 450)
    y = np.rint(np.concatenate((clean, junk)) * 10_000).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r), k) for k, r in enumerate(y)], "__group string, __y0 long, __y1 long, __y2 long, __y3 long, k int")
    placed = quality._with_distance(rows.join(quality.estimates(rows.drop("k")), "__group"))
    got = np.array([r["__d"] for r in placed.orderBy("k").collect()])
    centre, cover = mcd_by_hand(y / 10_000)
    want = np.einsum("ij,jk,ik->i", y / 10_000 - centre, np.linalg.inv(cover), y / 10_000 - centre)
    # the histogram of distances takes the last bin by parts, so the halves differ by a few rows
    assert np.allclose(got, want, rtol=0.08, atol=0.3)
    assert ((got > quality.CUTOFF) == (want > quality.CUTOFF)).mean() > 0.998
    assert (got[:900] <= quality.CUTOFF).mean() > 0.995 and (got[900:] > quality.CUTOFF).mean() > 0.95


def test_groups_stop_apart_and_are_counted_once(spark, monkeypatch):
    """Groups that need few, more and no steps have the estimates they have alone, sent or joined; a step does not count them again."""
    draw = np.random.default_rng(5)
    groups = {
        "one": np.full((60, 4), 3),
        "round": np.rint(draw.normal(1, 0.2, (300, 4)) * 10_000),
        "split": np.rint(np.concatenate((draw.normal(0.5, 0.1, (250, 4)), draw.normal(2, 0.4, (200, 4)))) * 10_000),
    }
    rows = spark.createDataFrame(
        [(g, *map(int, r)) for g, y in groups.items() for r in y], "__group string, __y0 long, __y1 long, __y2 long, __y3 long"
    )
    alone = {tuple(r) for g in groups for r in quality.estimates(rows.where(F.col("__group") == g)).collect()}
    asked = []
    small = quality.is_small
    monkeypatch.setattr(quality, "is_small", lambda *a: asked.append(1) or small(*a))
    assert {tuple(r) for r in quality.estimates(rows).collect()} == alone and len(asked) == 1
    monkeypatch.setattr(quality, "is_small", lambda *a: False)
    assert {tuple(r) for r in quality.estimates(rows).collect()} == alone
    assert quality.estimates(rows.limit(0)).count() == 0


def test_the_pipeline_over_odd_documents(spark, tmp_path):
    """All stages one after another over odd, repeated and null rows, each reading what the one before wrote."""
    docs = odd_documents(spark).union(spark.read.parquet(f"{SF}/documents.parquet").selectExpr(
        "doc_id + 1000 AS doc_id", "text", "lang", "source", "n_chars", "'x' AS component_id", "1 AS size", "true AS kept",
        "array(1) AS spans", "'y' AS id", "2 AS n_words",
    ))
    docs = docs.union(docs.where("doc_id > 1190"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    done = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert done and all(r.decodes and len(r.ids) == r.n_tokens for r in done)
    none = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0
