"""Spelling variants against plain comparison of all words, and the bounds of the gram index."""

from collections import Counter
import random
import re
import zlib

from hypothesis import given, settings, strategies as st
import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import spelling
from skyledger.llm.spelling import Words, affected, gram_dictionary, near_words, one_edit, spelling_variants, variable_grams, word_counts
from tests.llm.helpers import SF, odd_documents

LETTERS = "abcéß"


def distance_is_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def counts_by_hand(rows, least=6):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= 5}


def by_hand(counts):
    near = {w: [x for x in counts if distance_is_one(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form[w], None if form[w] is None else counts[form[w]], root))
    return sorted(out, key=repr)


def found(docs):
    return sorted(map(tuple, spelling_variants(docs).collect()), key=repr)


def random_documents(spark, seed=4, words=250):
    make = random.Random(seed)
    base = ["".join(make.choice(LETTERS) for _ in range(make.randint(5, 12))) for _ in range(words)]
    base += ["prefix" + "".join(make.choice("ab") for _ in range(make.randint(1, 5))) for _ in range(60)]
    near = []
    for w in base:
        k = make.randrange(len(w))
        near += [w[:k] + make.choice(LETTERS) + w[k + make.randrange(2) :], w[:k] + w[k + 1 :]]
    long = "x" * 3000
    pool = [w for w in base for _ in range(make.choice([5, 6, 40, 300]))] + near * 6 + [long, long + "y", long[1:] + "z"] * 5
    make.shuffle(pool)
    pool = [w.upper() if make.random() < 0.1 and w.isascii() else w for w in pool]
    rows = [(k, " ".join(pool[k::300]) + make.choice(["", ".", "'s"])) for k in range(300)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(6)


@given(st.text(LETTERS, max_size=7), st.text(LETTERS, max_size=7))
def test_one_edit(a, b):
    assert one_edit(a.encode("latin-1"), b.encode("latin-1")) == distance_is_one(a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(LETTERS, min_size=6, max_size=11), min_size=1, max_size=30), st.integers(0, 10**6), st.integers(0, 3))
def test_one_edit_changes_no_more_grams_than_the_bound(words, seed, over):
    """Whatever is frequent: all but the bounded number of grams are in both words, where the edit leaves them."""
    make = random.Random(seed)
    pairs = []
    for w in words:
        k, c = make.randrange(len(w) + 1), make.choice(LETTERS)
        pairs.append((w, make.choice([w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])))
    every = Words(pa.array([w.encode("latin-1") for pair in pairs for w in pair], pa.binary()), 5)
    grams, n = np.unique(np.concatenate([every.codes[q][every.left >= q] for q in range(2, 6)]), return_counts=True)
    code, size, _ = variable_grams(every, (grams[n > over], n[n > over]), 5)
    most = affected(every, size)
    for k in range(0, 2 * len(pairs), 2):
        a, b = (Counter(code[every.word == x].tolist()) for x in (k, k + 1))
        shared = (a & b).total()
        assert shared >= a.total() - most[k] and shared >= b.total() - most[k + 1]
        assert a.total() > most[k] and b.total() > most[k + 1]


@pytest.mark.parametrize("crowd, frequent, rows", [(256, 64, 1 << 16), (2, 3, 7), (1, 10**6, 100)])
def test_variants(spark, monkeypatch, crowd, frequent, rows):
    """Also with nearly all lists dealt by deletions, with no gram extended, and with few rows compared at once."""
    monkeypatch.setattr(spelling, "CROWD", crowd)
    monkeypatch.setattr(spelling, "FREQUENT", frequent)
    monkeypatch.setattr(spelling, "_ROWS", rows)
    monkeypatch.setattr(spelling, "_COUNTED", 500)
    texts, docs = random_documents(spark)
    counts = counts_by_hand(texts)
    assert found(docs) == by_hand(counts)
    assert {r.word: r.n for r in word_counts(docs).collect()} == counts


def test_given_documents_and_shorter_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = counts_by_hand([(r.doc_id, r.text) for r in docs.collect()], 4)
    vocabulary = spark.createDataFrame([(w.encode("latin-1"), n) for w, n in counts.items()], "word binary, n long")
    got = {(bytes(r.word).decode("latin-1"), bytes(r.other).decode("latin-1")) for r in near_words(vocabulary, 4).collect()}
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    assert got == {(a, b) for a in counts for k in (-1, 0, 1) for b in by_length.get(len(a) + k, ()) if distance_is_one(a, b)}


def test_the_dictionary_stays_small(spark, monkeypatch):
    monkeypatch.setattr(spelling, "DICTIONARY", 50)
    monkeypatch.setattr(spelling, "FREQUENT", 1)
    texts, docs = random_documents(spark, words=40)
    vocabulary = word_counts(docs).selectExpr("encode(word, 'ISO-8859-1') AS word", "n")
    assert 0 < len(gram_dictionary(vocabulary, 5)[0]) < 50
    assert found(docs) == by_hand(counts_by_hand(texts))


def test_odd_documents(spark):
    docs = odd_documents(spark)
    docs = docs.union(docs).union(docs)
    assert found(docs) == by_hand(counts_by_hand([(r.doc_id, r.text) for r in docs.collect()]))
    assert found(docs.limit(0)) == [] and found(docs.where("text IS NULL")) == []
