"""Exact removal of repeated passages, by longest-previous-factor arrays.

Every byte inside a string of ``LIMIT`` bytes that also starts earlier in the
corpus goes. The corpus is split by content so that equal strings always meet:

1. Each window of ``LIMIT`` bytes names its least ``GRAM``-byte gram (by hash,
   leftmost). Consecutive windows that name the same gram form a piece. Equal
   windows name equal grams, so a repeat is always between pieces of one gram.
2. Pieces are sorted by gram and content. Of identical pieces all but the
   earliest are repeats whole. Grams with several different pieces go on.
3. Their texts are cut out of the documents, dealt by gram, and put in suffix
   order. Previous and next smaller positions in that order give the longest
   previous factor of each suffix; those of ``LIMIT`` or more are repeats. A
   gram with very many pieces is dealt by whole windows instead.
4. The spans meet their documents by id.

A document is an id and, where ids repeat, a hash of the text. Rows that repeat
both are one document: of these one row stays as it is judged, the others repeat it.

Content is told apart by two independent 64-bit hashes in step 2 and byte by
byte in step 3.
"""

from collections.abc import Iterator
from dataclasses import dataclass
import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.settle import is_empty, is_small, settled
from skyledger.llm.shingles import mixed

LIMIT = 100
GRAM = 40
#: Pieces of one gram beyond which its windows are dealt singly.
CROWD = 2048
#: Repeated ids up to which they are sent to all tasks, 1 MB at most.
SENT = 1 << 17
_PIECE_BYTES = 1 << 20
_KEPT_PIECES = 1 << 20
_LPF_BYTES = 1 << 20
_SPREAD = 31
_WHOLE, _OPEN = 0, 1

_BASE = np.uint64(0x9E3779B97F4A7C55)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    steps = np.full(count, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


class Windows:
    """Pieces of a run of bytes, with reusable tables of powers."""

    def __init__(self, limit: int, gram: int):
        self.limit, self.gram = limit, gram
        self.tables = None

    def _grown(self, count: int):
        if self.tables is None or len(self.tables[0]) < count:
            size = max(count, _PIECE_BYTES + 4 * self.limit)
            self.tables = [_powers(b, size) for b in (_BASE, _inverse(_BASE), _OTHER, _inverse(_OTHER))]
        return self.tables

    def pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """gram hash, content hash, first window and number of windows of each piece in the documents data[start:end]."""
        limit, gram = self.limit, self.gram
        windows = len(data) - limit + 1
        if windows < 1:
            none = np.empty(0, np.int64)
            return none, none, none, none
        up, down, up2, down2 = self._grown(len(data) + 1)
        values = data.astype(np.uint64) + np.uint64(1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[: len(data)])))
        grams = mixed((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
        # the least gram of each window, leftmost by the place in the low bits
        low = np.uint64((1 << 24) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        span, width = 1, limit - gram + 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            least = np.minimum(least[: windows], least[width - span : width - span + windows])
        place = (least & low).astype(np.int64)
        inside = np.zeros(windows + 1, np.int8)
        long = ends - starts >= limit
        np.add.at(inside, starts[long], 1)
        np.add.at(inside, ends[long] - limit + 1, -1)
        inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
        opens = np.zeros(windows, bool)
        opens[starts[long]] = True
        opens[1:] |= (place[1:] != place[:-1]) | (inside[1:] & ~inside[:-1])
        opens[0] = True
        opens &= inside
        # a piece also closes where windows leave the documents
        edge = np.flatnonzero(opens | ~inside)
        first = edge[opens[edge]]
        after = np.append(edge, windows)[np.flatnonzero(opens[edge]) + 1]
        sums2 = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up2[: len(data)])))
        content = mixed((sums2[after - 1 + limit] - sums2[first]) * down2[first] + (after - first).astype(np.uint64))
        return grams[place[first]].view(np.int64), content.view(np.int64), first, after - first


def _anchored(limit: int, gram: int):
    """Pieces of all documents; repeats within a task's share of the rows are settled here."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        g, c, d, t, a, m = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((a, t, d, c, g))
        g, c, d, t, a, m = (x[order] for x in (g, c, d, t, a, m))
        again = np.concatenate(([False], (g[1:] == g[:-1]) & (c[1:] == c[:-1])))
        row = np.concatenate(([False], again[1:] & (d[1:] == d[:-1]) & (t[1:] == t[:-1]) & (a[1:] == a[:-1])))
        if row.any():  # the same piece of a repeated row
            g, c, d, t, a, m, again = (x[~row] for x in (g, c, d, t, a, m, again))
        kind = np.where(again, _WHOLE, _OPEN)
        # settled rows travel on, spread over all tasks
        g = np.where(again, mixed(((d + t) * 1_000_003 + a).view(np.uint64)).view(np.int64), g)
        c = np.where(again, 0, c)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (g, c, d, t, a, (m << 1) | kind)], ["gram", "content", "doc", "tie", "first", "size"]
        )

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, held, count = Windows(limit, gram), [], 0

        def taken(parts: list[bytes], ids: list[tuple[int, int]], shifts: list[int]):
            lengths = np.array([len(p) for p in parts])
            ends = np.cumsum(lengths)
            starts = ends - lengths
            g, c, first, m = windows.pieces(np.frombuffer(b"".join(parts), np.uint8), starts, ends)
            at = np.searchsorted(starts, first, side="right") - 1
            docs, ties = np.array(ids, np.int64)[at].T
            return g, c, docs, ties, first - starts[at] + np.array(shifts, np.int64)[at], m

        for batch in batches:
            parts, ids, shifts, size = [], [], [], 0
            for doc, text in zip(zip(*(c.to_pylist() for c in batch.columns[:2])), batch.column(2)):
                data = (text.as_py() or "").encode("utf-8")
                for at in range(0, max(len(data) - limit + 1, 0), _PIECE_BYTES):
                    part = data[at : at + _PIECE_BYTES + limit - 1]
                    parts.append(part)
                    ids.append(doc)
                    shifts.append(at)
                    size += len(part)
                    if size >= _PIECE_BYTES:
                        held.append(taken(parts, ids, shifts))
                        count += len(held[-1][0])
                        parts, ids, shifts, size = [], [], [], 0
                        if count >= _KEPT_PIECES:
                            yield flush(held)
                            held, count = [], 0
            if parts:
                held.append(taken(parts, ids, shifts))
                count += len(held[-1][0])
        if count:
            yield flush(held)

    return anchor


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (gram, content, doc, tie, first): repeats, and the firsts of grams with several contents.

    A stream with one row of memory: a gram's first piece waits until a second, different one comes.
    A row like the one before it is the same piece of a repeated row, and goes.
    """
    last = None
    waiting = None  # the only different piece so far of the last gram
    for batch in batches:
        g, c, d, t, a, s = (batch.column(i).to_numpy() for i in range(6))
        if not len(g):
            continue
        loose = (s & 1) == _WHOLE
        whole = [np.stack((g[loose], d[loose], t[loose], a[loose], s[loose]))]
        g, c, d, t, a, s = (x[~loose] for x in (g, c, d, t, a, s))
        found = []
        if len(g):
            same_gram = np.empty(len(g), bool)
            same = np.empty(len(g), bool)
            same_gram[1:] = g[1:] == g[:-1]
            same[1:] = same_gram[1:] & (c[1:] == c[:-1])
            same_gram[0] = last is not None and last[0] == g[0]
            same[0] = bool(same_gram[0]) and last[1] == c[0]
            repeat = same.copy()
            repeat[1:] &= (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (a[1:] != a[:-1])
            repeat[0] = bool(same[0]) and last[2:] != (d[0], t[0], a[0])
            last = (g[-1], c[-1], d[-1], t[-1], a[-1])
            whole.append(np.stack((g[repeat], d[repeat], t[repeat], a[repeat], s[repeat] & ~1)))
            f = np.stack((g, d, t, a, s))[:, ~same]
            if f.shape[1]:
                carried = bool(same_gram[~same][0])  # its gram came in an earlier batch
                if waiting is not None and carried:
                    found.append(waiting)
                if carried or waiting is not None:
                    waiting = None
                begins = np.flatnonzero(np.concatenate(([True], f[0, 1:] != f[0, :-1])))
                sizes = np.diff(np.append(begins, f.shape[1]))
                many = sizes > 1
                if carried:
                    many[0] = True
                if not many[-1]:
                    waiting = f[:, -1:]
                found.append(f[:, np.repeat(many, sizes)])
        out = np.concatenate(whole + found, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["gram", "doc", "tie", "first", "size"])


def _cutter(limit: int):
    """The bytes of wanted pieces; of crowded grams each window apart. Rows without bytes are settled repeats."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "doc", "tie", "first", "piece"]
        for batch in batches:
            rows = ([], [], [], [], [])
            single: dict[bytes, tuple[int, int, int]] = {}

            def put(g, d, t, a, p):
                for column, value in zip(rows, (g, d, t, a, p)):
                    column.append(value)

            for doc, text, wanted in zip(zip(*(c.to_pylist() for c in batch.columns[:2])), batch.column(2), batch.column(3)):
                data = (text.as_py() or "").encode("utf-8")
                for piece in wanted.as_py():
                    first, size = piece["first"], piece["size"] >> 1
                    if not piece["crowded"]:
                        put(piece["gram"], *doc, first, data[first : first + size + limit - 1])
                        continue
                    for at in range(first, first + size):
                        window = data[at : at + limit]
                        here, known = (*doc, at), single.get(window)
                        if known is None or here < known:
                            single[window] = here
                        if known is not None and here != known:
                            put(None, *max(here, known), None)
                    if len(single) > _KEPT_PIECES >> 4:
                        for window, place in single.items():
                            put(hash_of(window), *place, window)
                        single.clear()
            for window, place in single.items():
                put(hash_of(window), *place, window)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(rows, (*[pa.int64()] * 4, pa.binary()))], names
            )

    def hash_of(window: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "big", signed=True)

    return cut


def suffix_ranks(data: np.ndarray, starts: np.ndarray, limit: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Order of the suffixes at ``starts`` by their first ``limit`` bytes, then by place; ranks of shorter prefixes.

    Prefix doubling: the rank of 2h bytes comes from the ranks of h bytes at i and i + h.
    """
    padded = np.concatenate((data, np.zeros(limit, np.uint8)))
    ranks = {1: padded.astype(np.int64)}
    h = 1
    while h * 2 <= limit:
        now = ranks[h]
        pair = now[: len(now) - h] * (int(now.max()) + 2) + now[h:]
        ranks[h * 2] = np.unique(pair, return_inverse=True)[1]
        h *= 2
    now = ranks[h]
    pair = now[starts] * (int(now.max()) + 2) + now[starts + limit - h]
    return np.argsort(pair, kind="stable"), ranks


def common_prefix(ranks: dict[int, np.ndarray], left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
    """Bytes, up to ``limit``, that the suffixes at two places have in common."""
    length = np.zeros(len(left), np.int64)
    for h in sorted(ranks, reverse=True):
        for _ in range(2 if h == max(ranks) else 1):
            fits = length + h <= limit
            i, j = np.where(fits, left + length, 0), np.where(fits, right + length, 0)
            length += np.where(fits & (ranks[h][i] == ranks[h][j]), h, 0)
    return length


def _nearest_smaller(place: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each suffix in order, the common prefix with the nearest suffix before it whose place is smaller, or 0.

    ``lcp[i]`` is that of suffixes i - 1 and i. All suffixes jump over larger places together.
    """
    n = len(place)
    to = np.arange(n) - 1
    common = lcp.copy()
    active = np.flatnonzero(to >= 0)
    while len(active):
        active = active[place[to[active]] > place[active]]
        over = to[active]
        common[active] = np.minimum(common[active], common[over])
        to[active] = to[over]
        active = active[to[active] >= 0]
    common[to < 0] = 0
    return common


def longest_previous_factors(data: np.ndarray, starts: np.ndarray, limit: int) -> np.ndarray:
    """For each start (ascending), the longest prefix, up to ``limit``, that also starts at an earlier one."""
    order, ranks = suffix_ranks(data, starts, limit)
    place = starts[order]
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = common_prefix(ranks, place[:-1], place[1:], limit)
    before = _nearest_smaller(place, lcp)
    after = _nearest_smaller(place[::-1], np.append(0, lcp[:0:-1]))[::-1]
    found = np.empty(len(order), np.int64)
    found[order] = np.maximum(before, after)
    return found


def _repeats_in(pieces: list[tuple[tuple[int, int], int, bytes]], limit: int) -> list[tuple[int, int, int, int]]:
    """(doc, tie, start, end) of the bytes that repeat an earlier one of these pieces. A piece may be there several times."""
    pieces = [(*place, piece) for place, piece in sorted({p[:2]: p[2] for p in pieces}.items())]
    lengths = np.array([len(p[2]) for p in pieces])
    ends = np.cumsum(lengths)
    begins = ends - lengths
    counts = lengths - limit + 1
    owner = np.repeat(np.arange(len(pieces)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = begins[owner] + offset
    data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
    hit = np.flatnonzero(longest_previous_factors(data, starts, limit) >= limit)
    if not len(hit):
        return []
    cuts = np.flatnonzero((np.diff(starts[hit]) != 1) | (np.diff(owner[hit]) != 0)) + 1
    out = []
    for run in np.split(hit, cuts):
        doc, first, _ = pieces[owner[run[0]]]
        out.append((*doc, first + int(offset[run[0]]), first + int(offset[run[-1]]) + limit))
    return out


def _suffixed(limit: int):
    """Spans of repeats from pieces sorted by gram; several grams share one suffix order."""

    def spans(rows) -> pa.RecordBatch:
        columns = zip(*rows) if rows else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["doc", "tie", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for batch in batches:
            out = []
            for gram, doc, tie, first, piece in zip(*(c.to_pylist() for c in batch.columns)):
                if piece is None:
                    out.append((doc, tie, first, first + limit))
                    continue
                if gram != last and size >= _LPF_BYTES:
                    out += _repeats_in(held, limit)
                    held, size = [], 0
                held.append(((doc, tie), first, piece))
                size += len(piece)
                last = gram
            yield spans(out)
        if held:
            yield spans(_repeats_in(held, limit))

    return run


@dataclass
class Documents:
    """Rows as documents: ``key`` and ``tie`` tell them apart, ``text``, and the columns of the rows behind them.

    ``copies`` holds (key, tie) of documents that have several rows.
    """

    rows: DataFrame
    copies: DataFrame | None


def _documents(docs: DataFrame, id_col: str, text_col: str) -> Documents:
    """The id is the key, never null, so that both uses of the texts share one shuffle. ``tie`` is 0 unless the id repeats.

    Only ids and hashes are grouped. Ids that repeat are sent to all tasks if they
    are few; if not, every row has its hash as tie.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = docs.select(key.alias("key"), text.alias("text"))
    repeated = settled(hashed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("__again")))
    if is_empty(repeated):
        return Documents(docs.withColumns({"__key": key, "__tie": F.lit(0).cast("long")}), None)
    few = is_small(repeated, SENT)
    sent = F.broadcast(repeated) if few else repeated
    for seed in count():
        tie = F.xxhash64(F.lit(seed), text)
        told = hashed.join(sent, F.col("key") == F.col("__again")).select(
            "key", F.xxhash64(F.lit(seed), "text").alias("tie"), F.xxhash64(F.lit("other"), F.lit(seed), "text").alias("other")
        )
        named = settled(told.groupBy("key", "tie").agg(F.count("*").alias("n"), F.min("other").alias("low"), F.max("other").alias("high")))
        if is_empty(named.where("low <> high")):
            break
    copies = named.where("n > 1").select(F.col("key").alias("__c_key"), F.col("tie").alias("__c_tie"))
    if few:
        rows = docs.withColumn("__key", key).join(sent, F.col("__key") == F.col("__again"), "left")
        rows = rows.withColumn("__tie", F.when(F.col("__again").isNotNull(), tie).otherwise(F.lit(0))).drop("__again")
    else:
        rows = docs.withColumns({"__key": key, "__tie": tie})
    return Documents(rows, None if is_empty(copies) else copies)


def _spans(found: Documents, text_col: str, limit: int) -> DataFrame:
    """``__doc``, ``__tied`` and ``__spans`` of documents with repeats."""
    gram = limit * 2 // 5
    texts = found.rows.select(F.col("__key").alias("key"), F.col("__tie").alias("tie"), F.col(text_col).alias("text"))
    pieces = texts.mapInArrow(_anchored(limit, gram), "gram long, content long, doc long, tie long, first long, size long")
    resolved = settled(
        pieces.repartition("gram")
        .sortWithinPartitions("gram", "content", "doc", "tie", "first")
        .mapInArrow(_resolved, "gram long, doc long, tie long, first long, size long")
    )
    whole = resolved.where(f"size & 1 = {_WHOLE}").select(
        "doc", "tie", F.col("first").alias("start"), (F.shiftright("size", 1) + limit - 1).alias("length")
    )
    wanted = resolved.where(f"size & 1 = {_OPEN}")
    crowded = wanted.groupBy(F.col("gram").alias("crowd")).count().where(f"count > {CROWD}")
    asked = (
        wanted.join(crowded, wanted["gram"] == crowded["crowd"], "left")
        .groupBy(F.col("doc").alias("asked"), F.col("tie").alias("asked_tie"))
        .agg(F.collect_list(F.struct("gram", "first", "size", F.col("crowd").isNotNull().alias("crowded"))).alias("wanted"))
    )
    cut = (
        texts.join(asked.hint("shuffle_hash"), (F.col("key") == F.col("asked")) & (F.col("tie") == F.col("asked_tie")))
        .select("key", "tie", "text", "wanted")
        .mapInArrow(_cutter(limit), "gram long, doc long, tie long, first long, piece binary")
    )
    spread = F.coalesce("gram", F.xxhash64("doc", "tie", "first"))
    partial = (
        cut.repartition(spread)
        .sortWithinPartitions("gram", "doc", "tie", "first")
        .mapInArrow(_suffixed(limit), "doc long, tie long, start long, end long")
        .select("doc", "tie", "start", (F.col("end") - F.col("start")).alias("length"))
    )
    return (
        whole.union(partial)
        .groupBy("doc", F.col("tie").alias("tied"))
        .agg(F.collect_list(F.shiftleft("start", _SPREAD).bitwiseOR(F.col("length"))).alias("__spans"))
        .select(F.col("doc").alias("__doc"), F.col("tied").alias("__tied"), "__spans")
    )


def _with_spans(docs: DataFrame, limit: int, id_col: str, text_col: str, kept: list[str]) -> DataFrame:
    """Columns ``kept`` of every row, its text among them, and ``__spans``: packed start and length, in bytes.

    Of rows that are one document, all but one repeat it whole.
    """
    found = _documents(docs, id_col, text_col)
    spans = _spans(found, text_col, limit).hint("shuffle_hash")
    held = [*kept, "__key", "__tie"]
    same = (F.col("__key") == F.col("__doc")) & (F.col("__tie") == F.col("__tied"))
    out = [*kept, F.col("__spans")]
    if found.copies is None:
        return found.rows.select(held).join(spans, same, "left").select(out)
    copy = (F.col("__key") == F.col("__c_key")) & (F.col("__tie") == F.col("__c_tie"))
    rows = found.rows.select(held)
    alone = rows.join(found.copies, copy, "left_anti")
    # numbered once they are written, so the numbers stay
    several = settled(rows.join(found.copies, copy, "left_semi")).withColumn("__row", F.monotonically_increasing_id())
    first = several.groupBy("__key", "__tie").agg(F.min("__row").alias("__first")).select("__first")
    whole = F.octet_length(text_col).cast("long")
    judged = (
        several.join(first, F.col("__row") == F.col("__first"), "left")
        .join(spans, same, "left")
        .withColumn(
            "__spans",
            F.when(F.col("__first").isNotNull(), F.col("__spans")).otherwise(F.when(whole >= limit, F.array(whole))),
        )
    )
    return alone.join(spans, same, "left").select(out).union(judged.select(out))


def merged_spans(packed: list[int] | None) -> list[tuple[int, int]]:
    """Maximal (start, end) runs of packed spans."""
    if not packed:
        return []
    spans = np.sort(np.asarray(packed, np.int64))
    start = spans >> _SPREAD
    reach = np.maximum.accumulate(start + (spans & ((1 << _SPREAD) - 1)))
    opens = np.concatenate(([True], start[1:] > reach[:-1]))
    closes = np.append(np.flatnonzero(opens)[1:] - 1, len(start) - 1)
    return list(zip(start[opens].tolist(), reach[closes].tolist()))


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The bytes outside the runs."""
    edges = [0, *(x for run in runs for x in run), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs, shrunk so that no UTF-8 character is cut."""
    out = []
    for start, end in runs:
        while start < end and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def repeats(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row.

    A byte is removed when some ``limit``-byte string over it also starts
    earlier: in a document with a smaller id, or earlier in the same one.
    Strings are judged on the input and never cross documents. Null and empty
    texts have no bytes. Null ids count as the least id. Rows that repeat an id are
    documents of their own, in the order of a hash of their texts; of rows that
    repeat id and text one is the first. Other columns are not looked at. An empty
    table gives no rows.
    """

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, packed in zip(batch.column(1), batch.column(2)):
                data = (text.as_py() or "").encode("utf-8")
                runs = merged_spans(packed.as_py())
                kept = hashlib.sha256(without(data, runs)).hexdigest()
                rows.append((len(data), sum(b - a for a, b in runs), len(runs), kept))
            n, gone, spans, kept = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, spans)), pa.array(kept, pa.string())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return (
        _with_spans(rows, limit, "id", "text", rows.columns)
        .mapInArrow(measured, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
        .withColumnRenamed("id", id_col)
    )


def drop_repeats(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the texts, all other columns as they are.

    As ``repeats``, but a character that a cut would split stays whole.
    """

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            at = batch.schema.get_field_index(text_col) if at is None else at
            texts = []
            for text, packed in zip(batch.column(at), batch.column(batch.num_columns - 1)):
                value = text.as_py()
                if value is not None and packed.is_valid:
                    data = value.encode("utf-8")
                    value = without(data, whole_characters(data, merged_spans(packed.as_py()))).decode("utf-8")
                texts.append(value)
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return _with_spans(docs, limit, id_col, text_col, docs.columns).mapInArrow(cleaned, docs.schema)
