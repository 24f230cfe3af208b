"""Token counts by a two-tier lookup of pre-token lengths, without a shuffle of pre-tokens."""

from collections import Counter
from collections.abc import Iterator
import json

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from skyledger.llm.pretokens import PATTERN, Splitter, recent_letters

#: Rows that the frequent pre-tokens are taken from. They only warm the lookup; no count depends on them.
SAMPLE = 0.02
FREQUENT = 1 << 15
_PER_TASK = 1 << 12
_KEPT = 1 << 18


class _Recent(Exception):
    """A pre-token that the library may split otherwise."""


class Lengths(dict):
    """Token counts of pre-tokens: the frequent ones, and misses as they come, encoded once and kept while there is room."""

    def __init__(self, tokenizer: Tokenizer, splitter: Splitter, frequent: dict[str, int]):
        super().__init__(frequent)
        self.tokenizer, self.recent, self.frequent = tokenizer, splitter.recent, frequent

    def __missing__(self, piece: str) -> int:
        if self.recent(piece):
            raise _Recent
        if len(self) >= _KEPT + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        count = self[piece] = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return count


def splits_plainly(config: dict) -> bool:
    """Whether a tokenizer file is byte-level BPE by the public pattern, so that pieces can be counted apart."""
    pre = config.get("pre_tokenizer") or {}
    return (
        config.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and not any(t[k] for t in config["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )


class Counts:
    """Token counts of whole texts, as the library gives them by default without added tokens."""

    def __init__(self, tokenizer_json: str, frequent: dict[str, int], recent: str | None = None):
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        config = json.loads(tokenizer_json)
        self.plain = splits_plainly(config)
        self.splitter = Splitter(PATTERN, recent)
        self.lengths = Lengths(self.tokenizer, self.splitter, frequent)
        special = sorted((t["content"] for t in config["added_tokens"]), key=len, reverse=True)
        self.special = special
        self.cut = regex.compile("|".join(map(regex.escape, special))).split if special else lambda text: [text]

    def of(self, text: str) -> int:
        if self.plain:
            try:
                if not any(s in text for s in self.special):
                    return sum(map(self.lengths.__getitem__, self.splitter.find(text)))
                parts = self.cut(text)
                return len(parts) - 1 + sum(sum(map(self.lengths.__getitem__, self.splitter.find(p))) for p in parts)
            except _Recent:
                pass
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


def frequent_lengths(docs: DataFrame, tokenizer_json: str, text_col: str = "text") -> dict[str, int]:
    """The most frequent pre-tokens of a sample and their token counts: FREQUENT at most."""

    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, seen = regex.compile(PATTERN).findall, Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(find(text.as_py() or ""))
            if len(seen) > _KEPT:
                seen = Counter(dict(seen.most_common(_KEPT // 2)))
        top = seen.most_common(_PER_TASK)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"]
        )

    rows = (
        docs.select(text_col)
        .sample(fraction=SAMPLE, seed=1)
        .mapInArrow(common, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(FREQUENT)
        .collect()
    )
    counts = Counts(tokenizer_json, {})
    if not counts.plain:
        return {}
    return {r.piece: counts.lengths[r.piece] for r in rows if len(r.piece) < 64 and not counts.splitter.recent(r.piece)}


def token_counts(
    docs: DataFrame, tokenizer: str | None = None, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of every row.

    ``tokenizer`` is the path of a tokenizer file on the driver, which sends it
    with the tasks. Tokens are the library's, for the whole text, without begin,
    end or padding; strings of special tokens inside a text count as those.
    Null texts are empty: 0 bytes, 0 tokens. Ids may be null or repeat. Other
    columns are not looked at. An empty table gives no rows.
    """
    with open(tokenizer or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        content = file.read()
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((content, frequent_lengths(docs, content, text_col), recent_letters()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(*shared.value)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                n_bytes.append(len(text.encode("utf-8")))
                n_tokens.append(counts.of(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    return (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(count, "id long, n_bytes long, n_tokens long")
        .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
