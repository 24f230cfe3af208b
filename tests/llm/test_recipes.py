"""Exact dedup by chunk recipes against plain grouping of normalised texts."""

from collections import defaultdict
import hashlib
import random
import re

from hypothesis import given, settings, strategies as st
import pytest

from skyledger.llm import recipes
from skyledger.llm.recipes import LEAST, MOST, chunk_ends, exact_duplicates, normalised
from tests.llm.helpers import odd_documents


def by_hand(rows):
    groups = defaultdict(list)
    texts = []
    for i, text in rows:
        t = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        texts.append((i, t))
        groups[t].append(i)
    out, stays = [], set()
    for i, t in sorted(texts, key=lambda r: (r[0] is None, r[0])):
        ids = [x for x in groups[t] if x is not None]
        out.append((i, min(ids, default=None), len(groups[t]), t not in stays, hashlib.sha256(t.encode()).hexdigest()))
        stays.add(t)
    return sorted(out, key=repr)


def found(docs, **options):
    return sorted(map(tuple, exact_duplicates(docs, **options).collect()), key=repr)


@given(st.text(alphabet="ab \t\n\x0b\x0c\r\x1c\x85 é"))
def test_white_space(text):
    assert normalised(text) == re.sub(r"[\x20\x09-\x0D]+", " ", text).encode()


@settings(max_examples=40)
@given(st.integers(0, 10**6), st.integers(0, 90_000), st.integers(1, 30_000))
def test_chunks_depend_on_content(seed, n, shift):
    data = random.Random(seed).randbytes(n)
    gear = recipes._gear()
    ends = chunk_ends(data, gear)
    assert (ends[-1] if ends else 0) == n and all(0 < b - a <= MOST for a, b in zip([0, *ends], ends))
    assert all(b - a >= LEAST for a, b in zip([0, *ends], ends[:-1]))
    moved = chunk_ends(random.Random(1).randbytes(shift) + data, gear)
    if n > 60_000:  # cuts fall into step again after an insertion
        assert set(e + shift for e in ends[-3:]) <= set(moved)


def test_blocks_do_not_change_the_cuts(monkeypatch):
    data, gear = random.Random(5).randbytes(300_000), recipes._gear()
    whole = chunk_ends(data, gear)
    monkeypatch.setattr(recipes, "_BLOCK", 1000)
    assert chunk_ends(data, gear) == whole


@pytest.mark.parametrize("bits", [64, 2, 0])
def test_odd_documents(spark, bits):
    """With few bits of hash nearly all chunks clash, and only their bytes tell them apart."""
    docs = odd_documents(spark)
    docs = docs.union(docs.where("doc_id > 5"))
    assert found(docs, bits=bits) == by_hand([(r.doc_id, r.text) for r in docs.collect()])
    assert exact_duplicates(docs.limit(0), bits=bits).count() == 0


@pytest.mark.parametrize("bits", [64, 1])
def test_long_texts_that_share_chunks(spark, monkeypatch, bits):
    """Texts of several chunks, alike but for the last or the order, and a hot group; tasks forget in between."""
    monkeypatch.setattr(recipes, "_KNOWN", 20_000)
    make = random.Random(9)
    blocks = [" ".join(str(make.random()) for _ in range(1500)) for _ in range(3)]
    texts = ["".join(blocks), "".join(blocks), "".join(blocks[::-1]), "".join(blocks) + "x", blocks[0], blocks[0].replace(" ", "\t\n")]
    rows = [(k, t) for k, t in enumerate(texts)] + [(100 + k, blocks[1] + " ") for k in range(40)] + [(7, blocks[1] + " ")] * 3
    make.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs, bits=bits) == by_hand(rows)


def test_texts_move_once(spark):
    """One exchange carries chunks; after it only ids and lists move."""
    docs = spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string")
    plan = exact_duplicates(docs)._jdf.queryExecution().toString()
    assert "text#" not in plan.replace("text_sha256#", "")
