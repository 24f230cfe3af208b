"""Near-duplicate documents by one-permutation MinHash.

A document's set is its distinct word shingles. One hash function deals the set
into bins and each bin keeps its minimum; empty bins borrow by optimal
densification. Bands of bins are bucket keys, and each bucket proposes a star:
one document, the hub, against the others, so pairs grow with the rows of
buckets and not with the squares of their sizes. Stars are confirmed on the full
sets. A bucket that still holds several components proposes more stars around
other hubs, round after round, until a round joins nothing. Members of buckets
that hold several components even then are compared by a prefix filter, which
misses no link: linked sets share one of their rarest shingles.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.settle import fetched, released, sent_if_small, settled
from skyledger.llm.shingles import WordHashes, mixed, shingle_hashes, word_hashes
from skyledger.llm.nodes import joined_ids, named_classes
from skyledger.llm.stars import SPARSE, across, joined_by_stars

BINS = 128
ROWS = 4
#: Least bins that a linked pair of similarity p shares: BINS * p, less so many standard deviations.
SLACK = 5
#: Slots in which shingles are counted, to put rare ones first. Any order misses no link, so slots may be shared.
SLOTS = 1 << 18
#: Shingles looked at together where blocks of sets meet.
COLUMNS = 4096
#: Ids up to which they are sent to all tasks, 3 MB at most; more are joined by a shuffle.
SENT = 1 << 17
#: Sets of a block in the last step; every set of a crowd goes to as many tasks as its crowd has blocks.
BLOCK = 1024
SIGNED = "id long, n_shingles long, h1 long, h2 long, bands array<long>, low array<byte>"


def _probes() -> np.ndarray:
    """For each bin, the order in which it looks for another bin when empty."""
    order = np.arange(BINS * BINS, dtype=np.uint64)
    return np.argsort(mixed(order + np.uint64(0x5851F42D4C957F2D)).reshape(BINS, BINS), axis=1)


def signature(shingles: np.ndarray, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Band keys, and the low byte of each bin, of a non-empty sorted set of hashes."""
    width = np.uint64(64 - (BINS - 1).bit_length())
    bins = np.arange(BINS, dtype=np.uint64)
    at = np.minimum(np.searchsorted(shingles, bins << width), len(shingles) - 1)
    least = shingles[at]
    filled = (least >> width) == bins
    if not filled.all():
        empty = np.flatnonzero(~filled)
        order = probes[empty]
        source = order[np.arange(len(empty)), filled[order].argmax(axis=1)]
        least[empty] = least[source]
    rows = least.reshape(-1, ROWS)
    keys = np.arange(len(rows), dtype=np.uint64)
    for i in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return keys.view(np.int64), least.astype(np.uint8).view(np.int8)


def _digest(shingles: np.ndarray) -> tuple[int, int]:
    whole = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), dtype=np.int64)
    return int(whole[0]), int(whole[1])


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, probes = WordHashes(), _probes()
        for batch in batches:
            n, h1, h2, bands, low = [], [], [], [], []
            for text in batch.column(1):
                found = shingle_hashes(word_hashes(text.as_py(), cache), size)
                a, b = _digest(found)
                n.append(len(found))
                h1.append(a)
                h2.append(b)
                keys, bytes_ = signature(found, probes) if len(found) else ([], [])
                bands.append(keys)
                low.append(bytes_)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.list_(pa.int8()))],
                ["id", "n_shingles", "h1", "h2", "bands", "low"],
            )

    return sign


def _setter(size: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                found = shingle_hashes(word_hashes(text.as_py(), cache), size)
                a, b = _digest(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.as_py()], pa.int64()), pa.array([a], pa.int64()), pa.array([b], pa.int64()),
                     pa.array([found.view(np.int64)], pa.list_(pa.int64()))],
                    ["of", "h1", "h2", "shingles"],
                )

    return sets


def _sets(docs: DataFrame, nodes: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``id`` and the full set of every asked node, settled."""
    asked, kept = sent_if_small(
        nodes.join(ids, "id").select("id", F.col("first").alias("want"), F.col("h1").alias("w1"), F.col("h2").alias("w2")), SENT
    )
    wanted = docs.withColumnRenamed("id", "of").join(asked, F.col("of") == F.col("want"), "left_semi")
    out = settled(
        wanted.mapInArrow(_setter(size), "of long, h1 long, h2 long, shingles array<long>")
        .join(asked, (F.col("of") == F.col("want")) & (F.col("h1") == F.col("w1")) & (F.col("h2") == F.col("w2")))
        .dropDuplicates(["id"])
        .select("id", "shingles")
    )
    released(kept)
    return out


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes allow the similarity and whose bins do not speak against it."""
    share = percent / 100
    least = int(BINS * share - SLACK * (BINS * share * (1 - share)) ** 0.5)
    side = lambda x: nodes.select(*(F.col(c).alias(f"{c}_{x}") for c in ("id", "n_shingles", "low")))
    same = F.size(F.filter(F.zip_with("low_a", "low_b", lambda x, y: x == y), lambda x: x))
    sizes = F.least("n_shingles_a", "n_shingles_b") * 100 >= F.greatest("n_shingles_a", "n_shingles_b") * percent
    return (
        pairs.join(side("a"), F.col("a") == F.col("id_a"))
        .join(side("b"), F.col("b") == F.col("id_b"))
        .where(sizes & (same >= least))
        .select("a", "b")
    )


def _prefixes(sets: DataFrame, homes: DataFrame, percent: int) -> DataFrame:
    """Rows (bucket, id, component), settled: the rarest shingles of each set, as many as linked sets must share one of."""
    asked = settled(sets.join(homes, "id").select("id", "component", "shingles"))
    slot = F.col("shingle").bitwiseAND(F.lit(SLOTS - 1)).cast("int")
    counted = asked.select(F.explode("shingles").alias("shingle")).groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
    found = fetched(counted)  # SLOTS rows at most
    counts = np.zeros(SLOTS, np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for i, home, value in zip(batch.column(0), batch.column(1), batch.column(2)):
                shingles = value.values.to_numpy()
                n = len(shingles) + -len(shingles) * percent // 100 + 1
                rarest = shingles[np.lexsort((shingles, counts[shingles & (SLOTS - 1)]))[:n]]
                same = lambda x: pa.array(np.full(n, x.as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(rarest), same(i), same(home)], ["bucket", "id", "component"])

    out = settled(asked.mapInArrow(prefix, "bucket long, id long, component long"))
    released(asked)
    return out


def _alike(percent: int):
    """Which rows of a table with ``shingles`` reach the similarity, for two lists of rows."""

    def near(table: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sets = table["shingles"].to_numpy()
        held = [sets[i] for i in (*left, *right)]
        n = np.array([len(s) for s in held])
        name, times = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)[1:]
        # shingles of one set alone are in no intersection; the others become columns, some at a time
        column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[name]
        row = np.repeat(np.arange(len(held)), n)[column >= 0]
        column = column[column >= 0]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(left), len(right)), np.int64)
        for at in range(0, int((times > 1).sum()), COLUMNS):
            some = slice(*np.searchsorted(column, (at, at + COLUMNS)))
            has = np.zeros((len(held), COLUMNS), np.float32)
            has[row[some], column[some] - at] = 1
            both += (has[: len(left)] @ has[len(left) :].T).astype(np.int64)
        return (both > 0) & (both * 100 >= percent * (n[: len(left)][:, None] + n[len(left) :] - both))

    return near


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity, settled."""
    ends, kept = sent_if_small(pairs.select(F.explode(F.array("a", "b")).alias("end")).distinct(), SENT)
    asked = sets.join(ends, sets["id"] == ends["end"], "left_semi")
    left = asked.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = asked.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    out = settled(
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("both", both)
        .where(F.col("both") * 100 >= percent * (F.size("sa") + F.size("sb") - F.col("both")))
        .select("a", "b")
    )
    released(kept)
    return out


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Two documents are linked when 100 * intersection >= percent * union of
    their sets of ``size``-word shingles (A-Z lower-cased, words split at ASCII
    white space; a shorter text is one shingle). ``component_id`` is the least
    id reachable by links, ``kept`` says that it is the row's own.

    Null, empty and blank texts have no set, link with nothing and are kept.
    Rows with a null id link with nothing, have a null component and are kept.
    Rows that repeat an id are documents of their own that belong together. Other
    columns are not looked at. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = settled(texts.mapInArrow(_signer(size), SIGNED))
    some = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes, copies = named_classes(some.select("id", "h1", "h2"))
    same = (F.col("of") == F.col("first")) & (F.col("s1") == F.col("h1")) & (F.col("s2") == F.col("h2"))
    held_by_first = some.select(F.col("id").alias("of"), F.col("h1").alias("s1"), F.col("h2").alias("s2"), "n_shingles", "bands", "low")
    nodes = settled(
        classes.join(held_by_first, same)
        .dropDuplicates(["node"])
        .select(F.col("node").alias("id"), "first", "n_shingles", "h1", "h2", "bands", "low")
    )
    held: list[DataFrame] = []

    def confirm(pairs: DataFrame, candidates: DataFrame, last: bool) -> DataFrame:
        if not held:
            held.append(settled(nodes.join(candidates, "id").select("id", "n_shingles", "low")))
            held.append(_sets(texts, nodes, candidates, size))
        brief, sets = held
        if last:
            return _confirmed(pairs, sets, percent)
        likely = settled(_likely(pairs, brief, percent))
        out = _confirmed(likely, sets, percent)
        released(likely)
        return out

    def rest(crowds: DataFrame) -> DataFrame:
        sets = held[1]
        homes = settled(crowds.select("id", "component").distinct())
        keyed = _prefixes(sets, homes, percent)
        out = across(keyed, sets, _alike(percent), merged=True, block=BLOCK)
        released(keyed, homes)
        return out

    reached = joined_by_stars(nodes.select("id", F.explode("bands").alias("bucket")), copies, confirm, rest, n_hubs=1, sparse=SPARSE)
    reached = joined_ids(reached, classes)
    released(nodes, classes, *held)
    return (
        signed.select("id", "n_shingles")
        .join(reached, signed["id"] == reached["node"], "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.coalesce("component", "id").alias("component_id"),
            F.coalesce("component", "id").eqNullSafe(F.col("id")).alias("kept"),
        )
    )


def drop_near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose document stands for its group, with all their columns."""
    gone = near_duplicates(docs, size, percent, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("__gone"))
    return docs.join(gone.distinct(), docs[id_col] == F.col("__gone"), "left_anti")
