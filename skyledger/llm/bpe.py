"""Byte-level BPE in DuckDB recursive queries, one database per partition.

New words of a batch become rows (word, position, token), starting from their
bytes. A recursive query joins neighbours to the merge table and contracts each
word's leftmost pair of least rank until none is left. Documents are ordered
aggregations of their words' ids, and decoding is an ordered aggregation of the
bytes of ids.
"""

from base64 import b64decode
from collections.abc import Iterator
import heapq

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.pretokens import Splitter, is_latin, recent_letters

#: Bytes of text that one round of queries takes.
_ROUND_BYTES = 1 << 21
#: Words kept in a partition's database.
_KEPT = 1 << 18
#: Words that one recursive query takes; its steps hold some 50 rows a word.
_FRESH = 1 << 15
#: Longer words take one merge a round for too many rounds; a heap finds the same merges.
_LONG = 96

# A row is a token with the place and token after it; key is the rank of the two together, then the place.
_START = """
SELECT t.word, t.pos, t.token, t.after, t.next, (m.rank::BIGINT << 32) | t.pos AS key
FROM fresh t LEFT JOIN merges m ON m.first = t.token AND m.second = t.next
"""

# Of each word: the place of its leftmost pair of least rank, the place that goes, and what follows that. Only the
# merged token and the one before it meet the merge table again.
_STEP = """
SELECT t.word, t.pos, t.token, t.after, t.next, CASE WHEN t.moved THEN (m.rank::BIGINT << 32) | t.pos ELSE t.was END AS key
FROM (
    SELECT s.word, s.pos,
           CASE WHEN s.pos = b.pos THEN b.rank ELSE s.token END AS token,
           CASE WHEN s.pos = b.pos THEN b.after ELSE s.after END AS after,
           CASE WHEN s.pos = b.pos THEN b.next WHEN s.after = b.pos THEN b.rank ELSE s.next END AS next,
           s.pos = b.pos OR s.after = b.pos AS moved, s.key AS was
    FROM steps s JOIN (
        SELECT best.word, best.key & 4294967295 AS pos, (best.key >> 32)::INTEGER AS rank, best.gone, g.after, g.next
        FROM (SELECT word, min(key) AS key, arg_min(after, key) AS gone FROM steps WHERE key IS NOT NULL GROUP BY word) best
        JOIN steps g ON g.word = best.word AND g.pos = best.gone
    ) b ON b.word = s.word
    WHERE s.pos <> b.gone
) t LEFT JOIN merges m ON m.first = CASE WHEN t.moved THEN t.token END AND m.second = t.next
"""

# the newest step of each word is what is left of it
_CONTRACT = f"""
WITH RECURSIVE steps AS (
    SELECT 0 AS step, * FROM ({_START})
    UNION ALL
    SELECT (SELECT max(step) FROM steps) + 1, * FROM ({_STEP})
)
SELECT word, token
FROM steps JOIN (SELECT word, max(step) AS step FROM steps GROUP BY word) USING (word, step)
ORDER BY word, pos
"""

# one thread: the aggregate takes rows as the sorted subquery gives them
_DECODE = """
SELECT doc, unhex(string_agg(hex, '')) AS data
FROM (
    SELECT doc, place, hex
    FROM (SELECT doc, unnest(ids) AS token, generate_subscripts(ids, 1) AS place FROM coded) JOIN vocabulary USING (token)
    ORDER BY doc, place
)
GROUP BY doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a .tiktoken file."""
    with open(path, "rb") as file:
        return {b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge_rows(ranks: dict[bytes, int]) -> pa.Table:
    """(first, second, rank) for every pair of tokens that together are a token."""
    rows = [
        (ranks[token[:i]], ranks[token[i:]], rank)
        for token, rank in ranks.items()
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    return pa.table({n: pa.array(c, pa.int32()) for n, c in zip(("first", "second", "rank"), zip(*rows))})


def contracted_by_heap(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one long word, in n log n."""
    ends = list(range(1, len(word) + 1))
    after = list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    alive = [True] * len(word)
    heap = []

    def propose(i: int):
        j = after[i]
        if j < len(word):
            rank = ranks.get(word[i : ends[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ends[i], ends[j]))

    for i in range(len(word) - 1):
        propose(i)
    while heap:
        _, i, mid, end = heapq.heappop(heap)
        if not alive[i] or ends[i] != mid or ends[after[i]] != end:
            continue
        j = after[i]
        alive[j] = False
        ends[i] = end
        after[i] = after[j]
        if after[i] < len(word):
            before[after[i]] = i
        propose(i)
        if before[i] >= 0:
            propose(before[i])
    return [ranks[word[i : ends[i]]] for i in range(len(word)) if alive[i]]


def tables(ranks: dict[bytes, int], pattern: str) -> tuple[dict[bytes, int], str, str, pa.Table]:
    """What a partition needs, made once on the driver: ranks, pattern, the class of recent letters, merge table.

    Plain values, so that workers can read the broadcast without this package.
    """
    return ranks, pattern, recent_letters(), merge_rows(ranks)


class Codec:
    """A partition's database, and the words met so far with their ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, recent: str, merges: pa.Table):
        self.known: dict[str, int] = {}
        self.ids = pa.array([], pa.list_(pa.int32()))
        self.rounds = np.empty(0, np.int32)  # in how many each known word was used
        self.ranks = ranks
        self.splitter = Splitter(pattern, recent)
        self.by_byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB"})
        self._fill("merges", merges)
        self._fill(
            "vocabulary",
            pa.table({"token": pa.array(ranks.values(), pa.int32()), "hex": pa.array([t.hex() for t in ranks], pa.string())}),
        )

    def _fill(self, name: str, table: pa.Table):
        self.db.register("incoming", table)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS FROM incoming")
        self.db.unregister("incoming")

    def _forget(self):
        """Keep the half of the words that were used in most rounds, and of these only those used again."""
        order = np.argsort(-self.rounds, kind="stable")[: _KEPT // 2]
        kept = np.sort(order[self.rounds[order] > 1])
        names = list(self.known)
        self.known = {names[k]: at for at, k in enumerate(kept.tolist())}
        self.ids = self.ids.take(pa.array(kept))
        self.rounds = self.rounds[kept]

    def _learn(self, words: list[str]):
        """Encode new words, which are numbered from the end of the known ones."""
        done, ids = [], []
        numbers, parts = [], []
        for number, word in enumerate(words):
            data = word.encode("utf-8")
            rank = self.ranks.get(data)
            if rank is None and len(data) <= _LONG:
                numbers.append(number)
                parts.append(data)
                continue
            done.append(number)
            ids.append([rank] if rank is not None else contracted_by_heap(data, self.ranks))
        made = pa.array(ids, pa.list_(pa.int32()))
        if parts:
            lengths = np.array([len(p) for p in parts])
            pos = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            token = self.by_byte[np.frombuffer(b"".join(parts), np.uint8)]
            last = np.repeat(lengths, lengths) == pos + 1
            self._fill(
                "fresh",
                pa.table(
                    {
                        "word": np.repeat(np.array(numbers, np.int32), lengths),
                        "pos": pos,
                        "token": token,
                        "after": pos + 1,
                        "next": pa.array(np.append(token[1:], 0), pa.int32(), mask=last),
                    }
                ),
            )
            found = self.db.sql(_CONTRACT).to_arrow_table()
            word = found["word"].to_numpy()
            offsets = pa.array(np.append(np.flatnonzero(np.diff(word, prepend=-1)), len(word)), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, found["token"].combine_chunks().cast(pa.int32()))
            made = pa.concat_arrays([made, lists])
        order = np.argsort(np.array(done + numbers, np.int64))
        self.ids = pa.concat_arrays([self.ids, made.take(pa.array(order))])

    def _pieces(self, text: str) -> list[str]:
        pieces = self.splitter.find(text)
        if not is_latin(text) and any(map(self.splitter.recent, set(pieces).difference(self.known))):
            pieces = self.splitter.by_library(text)
        return pieces

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        if len(self.known) > _KEPT:
            self._forget()
        known, fresh, uses = self.known, [], []
        for text in texts:
            pieces = self._pieces(text)
            for piece in set(pieces).difference(known):
                known[piece] = len(known)
                fresh.append(piece)
            uses.append(np.fromiter(map(known.__getitem__, pieces), np.int32, len(pieces)))
        for at in range(0, len(fresh), _FRESH):
            self._learn(fresh[at : at + _FRESH])
        self.rounds = np.concatenate((self.rounds, np.zeros(len(fresh), np.int32)))
        if uses:
            self.rounds[np.unique(np.concatenate(uses))] += 1
        return [self.ids.take(pa.array(use)).flatten().to_numpy() for use in uses]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of every list of ids."""
        lengths = np.array([0, *(len(i) for i in ids)])
        flat = np.concatenate([np.empty(0, np.int32), *ids]).astype(np.int32)
        table = pa.table(
            {
                "doc": pa.array(np.arange(len(ids), dtype=np.int32)),
                "ids": pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(flat)),
            }
        )
        self.db.register("coded", table)
        found = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("coded")
        out = [b""] * len(ids)
        for doc, data in zip(found["doc"].to_pylist(), found["data"].to_pylist()):
            out[doc] = data
        return out


def rounds(texts: Iterator[str | None]) -> Iterator[list[str]]:
    """Texts in groups of bounded size; null texts are empty."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= _ROUND_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _spread(docs: DataFrame, ranks_path: str | None, pattern: str):
    ranks = read_ranks(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return docs.sparkSession.sparkContext.broadcast(tables(ranks, pattern))


def encoded(
    docs: DataFrame,
    ranks_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    text_col: str = "text",
    ids_col: str = "ids",
    check_col: str | None = None,
) -> DataFrame:
    """``docs`` with ``ids_col``, the token ids of the whole text, after (or instead of) its columns.

    ``ranks_path`` is a .tiktoken file on the driver, which sends its ranks with
    the tasks. Null texts have no ids: an empty array. No special tokens.
    ``check_col``, if named, says whether the ids decode to the text again.
    """
    shared = _spread(docs, ranks_path, pattern)
    made = [ids_col] if check_col is None else [ids_col, check_col]
    kept = [c for c in docs.columns if c not in made]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            ids, same = [], []
            for group in rounds(t.as_py() for t in batch.column(batch.num_columns - 1)):
                coded = codec.encode(group)
                ids += coded
                if check_col is not None:
                    same += [a == b.encode("utf-8") for a, b in zip(codec.decode(coded), group)]
            columns = [pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())][: len(made)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], *made])

    asked = docs.select(*kept, F.col(text_col).alias("__text"))
    types = dict(zip(made, (F.array().cast("array<int>"), F.lit(True))))
    return asked.mapInArrow(encode, docs.select(*kept).withColumns(types).schema)


def decoded(
    coded: DataFrame,
    ranks_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    ids_col: str = "ids",
    data_col: str = "data",
) -> DataFrame:
    """``coded`` with ``data_col``, the bytes that its ids stand for. Null ids are none."""
    shared = _spread(coded, ranks_path, pattern)
    kept = [c for c in coded.columns if c != data_col]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            ids = [np.array(i.as_py() or [], np.int32) for i in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(codec.decode(ids), pa.binary())], [*batch.schema.names[:-1], data_col]
            )

    asked = coded.select(*kept, F.col(ids_col).alias("__ids"))
    schema = coded.select(*kept).withColumn(data_col, F.lit(b"")).schema
    return asked.mapInArrow(decode, schema)


def round_trip(
    docs: DataFrame,
    ranks_path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by a space) and ``decoded_sha256`` of every row.

    Null and empty texts have 0 tokens and the digest of nothing. Ids may be
    null or repeat. Other columns are not looked at. An empty table gives no rows.
    """
    import hashlib

    shared = _spread(docs, ranks_path, pattern)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        names = [str(i) for i in range(max(codec.ranks.values()) + 1)]
        for batch in batches:
            n, coded, plain = [], [], []
            for group in rounds(t.as_py() for t in batch.column(1)):
                ids = codec.encode(group)
                for i, data in zip(ids, codec.decode(ids)):
                    n.append(len(i))
                    coded.append(hashlib.sha256(" ".join(map(names.__getitem__, i.tolist())).encode()).hexdigest())
                    plain.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(plain, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(digest, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
        .withColumnRenamed("id", id_col)
    )
