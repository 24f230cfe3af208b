"""Near-dedup of documents and vectors, and suffix dedup, against brute force."""

from pathlib import Path
import random

from hypothesis import given, settings, strategies as st
import numpy as np
import pytest

from skyledger.llm import components as components_module, lattice, minhash, stars, suffix
from skyledger.llm.components import components
from skyledger.sinks.shared import shared_folder
from tests.llm.helpers import SF, alike, joined, odd_documents, repeats_by_hand, repeats_in_order, word_sets


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = word_sets(rows, size)
    root = joined(sets, lambda a, b: alike(sets[a], sets[b], percent))
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, size, percent).collect()}
    assert got == {i: (len(s), root[i], root[i] == i) for i, s in sets.items()}
    left = minhash.drop_near_duplicates(docs, size, percent)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i in root if root[i] == i)


def test_a_chain_and_a_crowd(spark):
    """Each text is near the next only; and a crowd near one of them but not all near each other."""
    random.seed(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(12):
        words = [w if random.random() > 0.02 else f"c{i}_{k}" for k, w in enumerate(words)]
        rows.append((i, " ".join(words)))
    for i in range(60):
        rows.append((100 + i, " ".join(w if random.random() > 0.025 else f"d{i}_{k}" for k, w in enumerate(words))))
    sets = word_sets(rows, 3)
    root = joined(sets, lambda a, b: alike(sets[a], sets[b], 85))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == root


def test_odd_documents_in_near_dedup(spark):
    docs = odd_documents(spark)
    got = minhash.near_duplicates(docs, 3, 85).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[0].n_shingles == 0 and by_id[0].kept and by_id[100].kept
    assert by_id[104].component_id == 4 and by_id[111].component_id == 11
    assert [r.kept for r in got if r.doc_id is None] == [True, True]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_rows_that_share_an_id_in_near_dedup(spark, monkeypatch):
    """Every text of an id is compared, and an id joins what its texts are near to."""
    random.seed(6)
    words = [f"w{k}" for k in range(300)]
    a, b, c = " ".join(words), " ".join([*words, "more"]), " ".join(random.sample(words, 300))
    rows = [(1, a), (1, "one text"), (2, b), (2, "another text"), (3, c), (4, "one text"), (5, c), (5, "one text more"), (6, "alone")]
    rows += [(9, "x"), (9, "y"), (8, "y"), (8, "z"), (7, "z"), (7, "u v"), (7, "u v"), (9, "p q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 3, 85).collect())
    home = {1: 1, 2: 1, 4: 1, 3: 3, 5: 3, 6: 6, 7: 7, 8: 7, 9: 7}
    assert got == sorted((i, home[i], home[i] == i) for i, _ in rows)


def test_a_crowd_leaves_little_behind(spark, tmp_path):
    """Near copies by the thousand: what the rounds write goes with them."""
    random.seed(2)
    words = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join(w if random.random() > 0.05 else f"c{i}_{k}" for k, w in enumerate(words))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folder = Path(spark.sparkContext.getCheckpointDir() or shared_folder(spark))
    held = lambda: sum(p.stat().st_size for p in Path(str(folder).removeprefix("file:")).rglob("*") if p.is_file())
    before = held()
    assert minhash.near_duplicates(docs, 3, 85).count() == 1500
    assert held() - before < 4 * sum(len(t) for _, t in rows)


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 5), (7, 7), (None, 1), (20, 3)], "a long, b long")
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    assert got == {3: 3, 4: 3, 5: 3, 20: 3, 8: 8, 9: 8}
    assert components(links.limit(0), "a", "b").count() == 0


def test_stars_are_components_without_a_round(spark, monkeypatch):
    """Links that are stars around least nodes already are not moved; a path is, and then it is not moved once more to see that it rests."""
    rounds = []
    star = components_module._small_star
    monkeypatch.setattr(components_module, "_small_star", lambda links: rounds.append(1) or star(links))
    stars = [(1, k) for k in (5, 9, 7)] + [(k, 2) for k in (4, 8)] + [(5, 1), (3, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(stars, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 5: 1, 9: 1, 7: 1, 2: 2, 4: 2, 8: 2} and not rounds
    got = {r.node: r.component for r in components(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1} and len(rounds) == 1


def test_components_of_odd_shapes(spark):
    """Sparse random links, a long path in mixed order, a hub that is the greatest node, and repeated links."""
    draw = random.Random(4)
    path = draw.sample(range(1000, 1060), 60)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + list(zip(path, path[1:]))
    links += [(2000, k) for k in range(1100, 1140)] + [(-k, -2 * k) for k in range(1, 20)]
    links += links[:40]
    linked = {frozenset(x) for x in links}
    root = joined({x for a, b in links if a != b for x in (a, b)}, lambda a, b: frozenset((a, b)) in linked)
    rows = spark.createDataFrame(links, "a long, b long").repartition(5)
    assert sorted(map(tuple, components(rows, "a", "b").collect())) == sorted(root.items())


def test_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert {r.doc_id: tuple(r)[1:] for r in suffix.repeats(docs).collect()} == repeats_by_hand(rows, 100)
    left = suffix.drop_repeats(docs)
    assert left.columns == docs.columns and left.count() == docs.count()


def by_rows(docs):
    """Digest of op10 of every row: ids in order, null ids first, then by the hash that tells rows of one id apart."""
    rows = docs.selectExpr("doc_id", "text", "xxhash64(0, coalesce(text, '')) AS tie").collect()
    rows.sort(key=lambda r: (-(2**63) if r.doc_id is None else r.doc_id, r.tie))
    return sorted(((r.doc_id, *d) for r, d in zip(rows, repeats_in_order([r.text for r in rows], 100))), key=repr)


@pytest.mark.parametrize("sent, crowd", [(1 << 17, 2048), (0, 2048), (1 << 17, 1)])
def test_odd_documents_in_suffix_dedup(spark, monkeypatch, sent, crowd):
    """Repeated rows, repeated ids with other texts, null ids: each row is judged, whether ids that repeat are few or many."""
    monkeypatch.setattr(suffix, "SENT", sent)
    monkeypatch.setattr(suffix, "CROWD", crowd)
    whole = odd_documents(spark)
    got = sorted(map(tuple, suffix.repeats(whole).collect()), key=repr)
    assert got == by_rows(whole)
    left = suffix.drop_repeats(whole)
    assert left.schema == whole.schema and left.count() == whole.count()
    assert suffix.repeats(whole.limit(0)).count() == 0


def test_rows_that_share_an_id_in_suffix_dedup(spark):
    """One of repeated rows keeps its text; texts of one id, of one length or not, leave each other alone."""
    random.seed(8)
    text = lambda n: " ".join(f"{random.random()}" for _ in range(n))[: n * 18]
    a, b, c = text(23), text(23), text(60)
    rows = [(1, a), (1, a), (2, b), (2, text(23)), (3, c + c), (3, "x" + c[:150]), (None, c[:300]), (None, text(30)), (None, None), (None, None)]
    rows += [(7, a[:50] + b), (8, "short"), (8, "short")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, place int").repartition(4)
    assert sorted(map(tuple, suffix.repeats(docs).collect()), key=repr) == by_rows(docs)
    left = {r.place: r.text for r in suffix.drop_repeats(docs).collect()}
    assert sorted((left[0], left[1])) == ["", a] and left[2] == b and left[7] == rows[7][1] and left[8] is None
    assert left[11] == left[12] == "short"


def test_a_crowded_gram(spark, monkeypatch):
    """Grams beyond the bound are dealt by windows, with the same result."""
    monkeypatch.setattr(suffix, "CROWD", 3)
    random.seed(5)
    word = lambda: "".join(random.choice("abcdefg") for _ in range(6))
    shared = " ".join(word() for _ in range(40)) + " ünïcode"
    rows = [(i, f"{' '.join(word() for _ in range(20))} {shared[i % 7:]} {word()} {word() * 20}") for i in range(40)]
    got = suffix.repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == repeats_by_hand(rows, 100)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from([0, 97, 98, 255]), min_size=1, max_size=80), st.integers(2, 12))
def test_longest_previous_factors(data, limit):
    data = bytes(data)
    starts = np.arange(max(len(data) - limit + 1, 0))
    if not len(starts):
        return
    want = [max((next((k for k in range(limit) if data[p + k] != data[q + k]), limit) for q in range(p)), default=0) for p in starts]
    assert suffix.longest_previous_factors(np.frombuffer(data, np.uint8), starts, limit).tolist() == want


def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 32))
    near = base[:60] + rng.normal(size=(60, 32)) * 0.15
    hot = base[7] + rng.normal(size=(700, 32)) * 0.12
    vectors = np.concatenate([base, near, hot, base[:20], base[:5] * 3])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(9001, None), (9002, [0.0] * 32), (9003, [float("nan")] * 32), (9004, [None] * 32), (9005, []), (None, [1.0] * 32), (9006, [1.0, 2.0]), (9007, [2.0, 4.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS unit", "1 AS component")
    got = {r.vec_id: tuple(r)[1:] for r in lattice.near_duplicate_vectors(df).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    root = joined(range(len(vectors)), lambda a, b: close[a, b])
    links = close.sum(axis=1) - 1
    assert all(got[i] == (links[i], root[i], root[i] == i) for i in range(len(vectors)))
    assert all(got[i] == (0, i, True) for i in range(9001, 9006)) and got[None] == (0, None, True)
    assert got[9006] == (1, 9006, True) and got[9007] == (1, 9006, False)
    assert lattice.near_duplicate_vectors(df.limit(0)).count() == 0


def test_nearest_lattice_points():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8)) * 2
    points = lattice.nearest_e8(x)
    double = np.rint(points * 2).astype(int)
    assert ((double % 2 == 0).all(1) | (double % 2 != 0).all(1)).all() and (points.sum(1) % 2 == 0).all()
    own = ((x - points) ** 2).sum(1)
    for root in lattice._roots():
        assert (((x - points - root) ** 2).sum(1) >= own - 1e-9).all()


def test_true_pairs_hidden_in_a_crowd_below_the_threshold(spark):
    """Thousands of texts that share buckets and hardly ever link; a few true pairs among them are still found."""
    rng = random.Random(11)
    template = [f"t{i}" for i in range(300)]
    places = [rng.sample(range(1, 299, 3), 7) for _ in range(2000)]
    pairs = [(200 + 71 * k, 1990 - 13 * k) for k in range(6)]
    for a, b in pairs:  # both differ from the template at the same places, but from each other too
        places[b] = places[a]
    rows = [(i, [f"u{i}" if k in at else w for k, w in enumerate(template)]) for i, at in enumerate(places)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    sets = word_sets([(i, " ".join(w)) for i, w in rows[::40]], 3)
    assert not any(alike(sets[a], sets[b], 85) for a in sets for b in sets if a < b)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert {i: c for i, c in got.items() if i != c} == {max(p): min(p) for p in pairs}


def test_linked_vectors_hidden_in_crowded_cells(spark):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=32)
    crowd = centre + rng.normal(size=(1500, 32)) * 0.29
    unit = crowd / np.linalg.norm(crowd, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(crowd)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.component_id for r in lattice.near_duplicate_vectors(df).collect()}
    root = joined(range(len(crowd)), lambda a, b: close[a, b])
    assert got == root


def test_vectors_that_share_an_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [-1.0, 1.0]), (4, [1.0, 1.01]), (5, None), (5, [-1.0, 0.0]), (5, [-1.0, 0.0])]
    got = lattice.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    want = [(1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True), (4, 0, 3, False), (4, 1, 3, False), (5, 0, 5, True), (5, 1, 5, True), (5, 1, 5, True)]
    assert sorted(map(tuple, got.collect())) == want


def test_rounds_end_when_few_of_their_pairs_are_links(spark):
    """One crowd whose rounds would join it one by one: the rest is asked at once, and nothing is missed."""
    dealt = spark.range(120).selectExpr("id", "7L AS bucket")
    none = spark.createDataFrame([], "a long, b long")
    tried = []

    def confirm(pairs, candidates, last):
        tried.append(last)
        return stars.settled(pairs.where("b - a = 1"))

    def rest(crowds):
        ids = [r.id for r in crowds.select("id").collect()]
        return stars.settled(spark.createDataFrame([(i, i + 1) for i in ids if i + 1 in ids], "a long, b long"))

    reached = stars.joined_by_stars(dealt, none, confirm, rest, n_hubs=1, sparse=stars.SPARSE)
    assert {r.node: r.component for r in reached.collect()} == dict.fromkeys(range(120), 0)
    assert tried == [False, True]
