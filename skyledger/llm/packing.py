"""Token ids packed into rows of fixed length, best fit decreasing.

Each task packs its documents in groups of bounded size. Documents longer than a
row are split, losing nothing: whole rows and a rest. Segments go, longest
first, into the open row with the least room that still holds them; a segment
tree over the amounts of room finds it.
"""

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.bpe import read_ranks
from skyledger.llm.pretokens import PATTERN
import regex

LENGTH = 2048
#: Tokens packed together.
GROUP_TOKENS = 1 << 21
_KEPT = 1 << 18
PACKED = (
    "row_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, doc_offsets array<long>"
)


class Room:
    """Open rows by the room they have left, and the least room of at least some size, in log(length) steps."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def put(self, room: int, row: int):
        self.rows.setdefault(room, []).append(row)
        at = room + self.leaves
        while at:
            self.counts[at] += 1
            at >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Room and row of the tightest fit, taken out; None if nothing fits."""
        at, counts = size + self.leaves, self.counts
        if not counts[at]:
            while at > 1 and (at & 1 or not counts[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if counts[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        while at:
            counts[at] -= 1
            at >>= 1
        return room, row


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of segment numbers; sizes are 1 to ``length``. Ties keep their order."""
    room, rows = Room(length), []
    for segment in sorted(range(len(sizes)), key=lambda s: -sizes[s]):
        size = sizes[segment]
        found = room.take(size)
        if found is None:
            found = (length, len(rows))
            rows.append([])
        left, row = found
        rows[row].append(segment)
        if left > size:
            room.put(left - size, row)
    return rows


class Encoder(dict):
    """Ids of pre-tokens as bytes, by the public library, kept while there is room."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kind: np.dtype):
        super().__init__()
        self.library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.find = regex.compile(pattern).findall
        self.kind = kind

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= _KEPT:
            self.clear()
        ids = self[piece] = np.array(self.library.encode_ordinary(piece), self.kind).tobytes()
        return ids

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.find(text)))


def _rows_of(group: list[tuple[int | None, bytes]], length: int, width: int, first: int) -> pa.RecordBatch:
    """Packed rows of (doc, ids) pairs."""
    segments = [
        (doc, at, min(length, len(ids) // width - at), number)
        for number, (doc, ids) in enumerate(group)
        for at in range(0, len(ids) // width, length)
    ]
    out = [[] for _ in range(7)]
    for row in best_fit_decreasing([s[2] for s in segments], length):
        held = [segments[s] for s in row]
        ends = np.cumsum([s[2] for s in held]).tolist()
        data = b"".join(group[n][1][at * width : (at + size) * width] for _, at, size, n in held)
        starts = [0, *ends[:-1]]
        values = (
            first + len(out[0]), ends[-1], data.ljust(length * width, b"\0"), [0, *ends], starts,
            [s[0] for s in held], [s[1] for s in held],
        )
        for column, value in zip(out, values):
            column.append(value)
    types = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(out, types)], [c.split()[0] for c in PACKED.split(", ")]
    )


def packed(
    docs: DataFrame,
    length: int = LENGTH,
    ranks_path: str | None = None,
    pattern: str = PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows of ``length`` token ids holding every token of every text once.

    ``ids`` is a row of the matrix: ``length`` little-endian unsigned numbers,
    two bytes each if the vocabulary allows, else four, with zeros after
    ``n_tokens``. ``cu_seqlens`` holds the cumulative lengths of the segments,
    from 0; positions restart at ``position_resets``; segment i is the part of
    ``doc_ids[i]`` that starts at its token ``doc_offsets[i]``. ``row_id`` is unique.

    Null and empty texts have no tokens and are in no row. Ids may be null or
    repeat. Other columns are not looked at. An empty table gives no rows.
    """
    ranks = read_ranks(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    kind = np.dtype("<u2" if max(ranks.values()) < 1 << 16 else "<u4")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, pattern, kind)
        first = TaskContext.get().partitionId() << 33
        group, tokens = [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.of(text.as_py() or "")
                if ids:
                    group.append((doc, ids))
                    tokens += len(ids) // kind.itemsize
                if tokens >= GROUP_TOKENS:
                    rows = _rows_of(group, length, kind.itemsize, first)
                    first += rows.num_rows
                    yield rows
                    group, tokens = [], 0
        if group:
            yield _rows_of(group, length, kind.itemsize, first)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(pack, PACKED)


def write_packed(rows: DataFrame, path: str) -> None:
    """Packed rows as Parquet files, each a piece of the matrix with its row index; written again, they are replaced."""
    rows.write.mode("overwrite").parquet(path)


def matrix(rows: list, length: int = LENGTH, width: int = 2) -> np.ndarray:
    """The id matrix of some collected rows, without copying ids one by one."""
    return np.frombuffer(b"".join(bytes(r.ids) for r in rows), f"<u{width}").reshape(-1, length)
