"""Token counts, BPE and packing against the public libraries."""

import hashlib

from hypothesis import given, settings, strategies as st
import numpy as np
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

from skyledger.llm import bpe, packing, tokencount
from skyledger.llm.pretokens import PATTERN, Splitter, latin_pattern
from tests.llm.helpers import ODD_TEXTS, SF, odd_documents

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
STRANGE = ["x" * 5000, "é" * 300 + " 你好" * 50, "՘a1\U000105c0b", "  \t\x1c \x85 q\x00", "ab" * 900 + "c" * 97]


def test_counts(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = odd_documents(spark).select("doc_id", "text").union(spark.createDataFrame(list(enumerate(STRANGE, 500)), "doc_id long, text string"))
    docs = docs.union(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))
    rows = docs.collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in rows)
    got = tokencount.token_counts(docs).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert tokencount.token_counts(docs.limit(0)).count() == 0


def test_other_tokenizer_files(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokencount.token_counts(docs, path).collect()}
    assert got == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(ODD_TEXTS)}


def test_round_trip(spark):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS + STRANGE)] + [(900 + r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")
    got = {r.doc_id: tuple(r)[1:] for r in bpe.round_trip(docs).collect()}
    for i, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        spelled = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i] == (len(ids), spelled, hashlib.sha256((text or "").encode()).hexdigest())
    coded = bpe.encoded(docs)
    assert coded.columns == ["doc_id", "text", "ids"]
    assert bpe.decoded(coded).where("data <> CAST(coalesce(text, '') AS BINARY)").count() == 0
    checked = bpe.encoded(docs, check_col="decodes")
    assert checked.columns == ["doc_id", "text", "ids", "decodes"] and checked.where("NOT decodes").count() == 0
    assert bpe.round_trip(docs.limit(0)).count() == 0


def test_long_words_take_the_same_merges():
    for word in (b"abababcabab" * 30, bytes(range(256)) * 2, b"the" * 200):
        assert bpe.contracted_by_heap(word, RANKS) == LIBRARY._encode_single_piece(word)


def test_packing_loses_nothing(spark):
    docs = odd_documents(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    rows = packing.packed(docs, length=256).collect()
    parts = {}
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u2")
        assert len(ids) == 256 and r.cu_seqlens[-1] == r.n_tokens and not ids[r.n_tokens :].any()
        assert r.position_resets == r.cu_seqlens[:-1]
        for doc, at, a, b in zip(r.doc_ids, r.doc_offsets, r.cu_seqlens, r.cu_seqlens[1:]):
            parts.setdefault(doc, []).append((at, ids[a:b].tolist()))
    got = {d: [x for _, p in sorted(ps) for x in p] for d, ps in parts.items()}
    want = {r.doc_id: LIBRARY.encode_ordinary(r.text) for r in docs.collect() if r.text}
    assert got == want
    assert len({r.row_id for r in rows}) == len(rows)
    assert packing.matrix(rows, 256).shape == (len(rows), 256)
    assert packing.packed(docs.limit(0)).count() == 0


def test_written_rows_hold_every_token_of_repeated_and_null_ids(spark, tmp_path):
    """Rows that repeat an id, or have none, are packed apart; read back from files, each text decodes whole."""
    docs = odd_documents(spark)
    path = str(tmp_path / "rows")
    for _ in range(2):
        packing.write_packed(packing.packed(docs, length=64), path)
    texts = []
    open_parts = {}
    for r in sorted(spark.read.parquet(path).collect(), key=lambda r: r.row_id):
        ids = np.frombuffer(bytes(r.ids), "<u2")
        assert len(ids) == 64 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        for doc, at, a, b in zip(r.doc_ids, r.doc_offsets, r.cu_seqlens, r.cu_seqlens[1:]):
            open_parts.setdefault(doc, []).append((at, ids[a:b].tolist()))
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(LIBRARY.encode_ordinary(r.text or ""))
    for doc, parts in open_parts.items():
        # the rows of one id are alike or have one part, so that parts of one offset belong to different rows
        assert sorted(x for _, p in parts for x in p) == sorted(x for ids in want[doc] for x in ids)
        texts.append(doc)
    assert set(texts) == {d for d, lists in want.items() if any(lists)}


def test_best_fit_decreasing():
    rng = np.random.default_rng(3)
    for _ in range(20):
        length = int(rng.integers(1, 70))
        sizes = rng.integers(1, length + 1, int(rng.integers(1, 60))).tolist()
        rows = packing.best_fit_decreasing(sizes, length)
        assert sorted(s for row in rows for s in row) == list(range(len(sizes)))
        room = []
        for size in sorted(sizes, reverse=True):
            fits = [k for k in range(len(room)) if room[k] >= size]
            if fits:
                room[min(fits, key=lambda k: room[k])] -= size
            else:
                room.append(length - size)
        assert sorted(length - sum(sizes[s] for s in row) for row in rows) == sorted(room)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(max_codepoint=255)) | st.text(alphabet=" \t\n\x1c\x85\xa0'sdtmrevl²½ªé.aZ9"))
def test_latin_texts_split_alike(text):
    """The classes written out find what the Unicode classes find."""
    splitter = Splitter()
    assert splitter._find_latin is not splitter._find
    assert splitter.find(text) == regex.findall(PATTERN, text)


def test_patterns_with_other_classes_are_left_as_they_are():
    assert latin_pattern(r"\p{Lu}+|\s") is None and latin_pattern(r"\w+") is None
    assert Splitter(r"\w+")._find_latin is Splitter(r"\w+")._find or Splitter(r"\w+").find("ab c") == ["ab", "c"]


def test_words_used_again_are_kept(monkeypatch):
    """A memory that overflows forgets words that were used in one round, and encodes alike."""
    monkeypatch.setattr(bpe, "_KEPT", 300)
    codec = bpe.Codec(*bpe.tables(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), PATTERN))
    fresh = bpe.Codec(*bpe.tables(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), PATTERN))
    for k in range(8):
        name = lambda i: "qzx"[i % 3] + "abcdefghij"[i // 10] + "klmnopqrst"[i % 10]
        texts = [" ".join(f"often{name(i)}" for i in range(60)), " ".join(f"seldom{name(k)}{name(i)}" for i in range(90))]
        got = codec.encode(texts)
        assert [x.tolist() for x in got] == [fresh.encode([t])[0].tolist() for t in texts]
        assert [d.decode() for d in codec.decode(got)] == texts
    assert f" often{name(7)}" in codec.known and f" seldom{name(0)}{name(7)}" not in codec.known and len(codec.known) < 600
