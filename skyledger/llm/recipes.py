"""Exact duplicates by content-defined chunk recipes.

1. Each text is normalised where it is and cut where a rolling hash of its last
   bytes says so, so equal texts are cut alike. Its recipe is the ordered list
   of its chunks' hashes; of chunks that a task has met, one copy travels.
2. Chunks of one hash are compared byte by byte in sorted order. Where they
   differ they get variants, so that hash and variant are a verified identifier.
3. Texts are equal when their ordered lists of identifiers are. Only lists and
   ids move from here on: a long document is sent at most once, in chunks.
"""

from collections.abc import Iterator
import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
import xxhash

from skyledger.llm.settle import is_empty, settled
from skyledger.llm.shingles import mixed

#: A chunk ends where the rolling hash of the last 32 bytes has no bit of MASK, but not before LEAST bytes and by MOST.
MASK = np.uint32(((1 << 11) - 1) << 21)
LEAST, MOST = 256, 1 << 14
#: Bytes hashed at once, bytes of chunks that a task remembers, and bytes of chunks sent in one batch.
_BLOCK, _KNOWN, _BATCH = 1 << 22, 1 << 25, 1 << 22
#: Parts into which the rows of one recipe are dealt when they meet their group.
SALTS = 8
#: Repeated rows are written out so many at a time.
_COPIES = 1 << 16

_ENTRY = "struct<h1:bigint,h2:bigint,k:int>"
_SENT = f"h1 long, h2 long, content binary, part int, k int, id long, text_sha256 string, recipe array<{_ENTRY}>"
_FOUND = f"h1 long, h2 long, part int, k int, variant int, id long, text_sha256 string, recipe array<{_ENTRY}>"


def normalised(text: str | None) -> bytes:
    """UTF-8 of the text with one space for each run of ASCII white space; null is empty."""
    data = (text or "").encode("utf-8")
    words = data.split()
    if not words:
        return b" " if data else b""
    return b" " * data[:1].isspace() + b" ".join(words) + b" " * data[-1:].isspace()


def _gear() -> np.ndarray:
    return (mixed(np.arange(256, dtype=np.uint64) + np.uint64(0x1F3D5B79)) >> np.uint64(32)).astype(np.uint32)


def chunk_ends(data: bytes, gear: np.ndarray) -> list[int]:
    """Where the chunks of a text end. A place depends on the 32 bytes before it and on the last end alone."""
    ends: list[int] = []
    start = 0
    for at in range(0, len(data), _BLOCK):
        first = max(0, at - 31)
        rolled = gear[np.frombuffer(data, np.uint8, min(len(data), at + _BLOCK) - first, first)]
        for width in (1, 2, 4, 8, 16):
            rolled[width:] += rolled[:-width] << np.uint32(width)
        for place in (np.flatnonzero(rolled[at - first :] & MASK == 0) + at + 1).tolist():
            while place - start > MOST:
                start += MOST
                ends.append(start)
            if place - start >= LEAST:
                ends.append(place)
                start = place
    while len(data) - start > MOST:
        start += MOST
        ends.append(start)
    if start < len(data):
        ends.append(len(data))
    return ends


def _cutter(bits: int):
    """Recipes of all texts, and the chunks they name, each once for as long as the task remembers it.

    (part, h1, h2, k) names one content: ``k`` goes up when the task forgets, and for a chunk
    whose hash another one has.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        gear, keep = _gear(), np.int64(-1 if bits >= 64 else (1 << bits) - 1)
        known: dict[bytes, tuple[int, int, int]] = {}
        taken: set[tuple[int, int]] = set()
        held = epoch = last = 0
        chunks: list[tuple] = []
        rows: list[tuple] = []
        size = 0

        def sent() -> pa.RecordBatch:
            n, m = len(chunks), len(rows)
            h1, h2, content, k = zip(*chunks) if chunks else ((),) * 4
            ids, sums, lists = zip(*rows) if rows else ((),) * 3
            entries = [e for recipe in lists for e in recipe]
            e1, e2, ek = zip(*entries) if entries else ((),) * 3
            offsets = np.cumsum([0] * (n + 1) + [len(recipe) for recipe in lists])
            entry = pa.StructArray.from_arrays(
                [pa.array(e1, pa.int64()), pa.array(e2, pa.int64()), pa.array(ek, pa.int32())], ["h1", "h2", "k"]
            )
            recipe = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), entry, mask=pa.array(np.arange(n + m) < n) if n + m else None
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([*h1, *[None] * m], pa.int64()),
                    pa.array([*h2, *[None] * m], pa.int64()),
                    pa.array([*content, *[None] * m], pa.binary()),
                    pa.array([part] * (n + m), pa.int32()),
                    pa.array([*k, *[None] * m], pa.int32()),
                    pa.array([*[None] * n, *ids], pa.int64()),
                    pa.array([*[None] * n, *sums], pa.string()),
                    recipe,
                ],
                ["h1", "h2", "content", "part", "k", "id", "text_sha256", "recipe"],
            )

        for batch in batches:
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = normalised(text.as_py())
                recipe, start = [], 0
                for end in chunk_ends(data, gear):
                    content = data[start:end]
                    start = end
                    name = known.get(content)
                    if name is None:
                        if held > _KNOWN:
                            known.clear()
                            taken.clear()
                            held = 0
                            epoch = last = last + 1
                        h1, h2 = (np.frombuffer(xxhash.xxh3_128_digest(content), np.int64) & keep).tolist()
                        if (h1, h2) in taken:
                            last += 1
                        k = last if (h1, h2) in taken else epoch
                        taken.add((h1, h2))
                        name = known[content] = (h1, h2, k)
                        held += len(content)
                        size += len(content)
                        chunks.append((h1, h2, content, k))
                    recipe.append(name)
                rows.append((id_, hashlib.sha256(data).hexdigest(), recipe))
                size += 24 * len(recipe) + 100
                if size >= _BATCH:
                    yield sent()
                    chunks, rows, size = [], [], 0
        if chunks or rows:
            yield sent()

    return cut


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of chunks sorted by (h1, h2, content): the names of all but the first content of a hash. Recipes pass.

    A stream with one chunk of memory.
    """
    before: tuple = (None, None, None)
    variant = 0
    for batch in batches:
        keep, variants = [], []
        hashes1, hashes2 = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, content in enumerate(batch.column(2)):
            if not content.is_valid:
                keep.append(i)
                variants.append(None)
                continue
            now = (hashes1[i], hashes2[i], content.as_py())
            if now[:2] != before[:2]:
                variant = 0
            elif now[2] != before[2]:
                variant += 1
            before = now
            if variant:
                keep.append(i)
                variants.append(variant)
        out = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*(out.column(c) for c in ("h1", "h2", "part", "k")), pa.array(variants, pa.int32()),
             *(out.column(c) for c in ("id", "text_sha256", "recipe"))],
            ["h1", "h2", "part", "k", "variant", "id", "text_sha256", "recipe"],
        )


def _identified(found: DataFrame) -> DataFrame:
    """``id``, ``text_sha256`` and ``chunks``, the ordered verified identifiers, of every text."""
    texts = found.where("recipe IS NOT NULL").select("id", "text_sha256", "part", "recipe")
    several = found.where("variant IS NOT NULL").select(
        *(F.col(c).alias(f"v_{c}") for c in ("part", "h1", "h2", "k")), "variant"
    )
    if is_empty(several):
        first = F.transform("recipe", lambda c: F.struct(c["h1"].alias("h1"), c["h2"].alias("h2"), F.lit(0).alias("v")))
        return texts.select("id", "text_sha256", first.alias("chunks"))
    # chunks of one hash differ somewhere: each entry looks up its variant
    entries = texts.select("part", "recipe").distinct().select("part", "recipe", F.posexplode_outer("recipe").alias("at", "c"))
    named = entries.join(
        several,
        (F.col("part") == F.col("v_part")) & (F.col("c.h1") == F.col("v_h1")) & (F.col("c.h2") == F.col("v_h2")) & (F.col("c.k") == F.col("v_k")),
        "left",
    )
    entry = F.struct("at", F.struct("c.h1", "c.h2", F.coalesce("variant", F.lit(0)).alias("v")).alias("c"))
    lists = named.groupBy(F.col("part").alias("l_part"), F.col("recipe").alias("l_recipe")).agg(
        F.transform(F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), entry))), lambda e: e["c"]).alias("chunks")
    )
    return texts.join(lists, (F.col("part") == F.col("l_part")) & (F.col("recipe") == F.col("l_recipe"))).select(
        "id", "text_sha256", "chunks"
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """``id_col``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row of ``docs``.

    Texts are equal when they are the same after each run of ASCII white space
    has become one space; the digest is that of the text so normalised. Of a
    group the row with the least id is kept, one row even if several have that id.

    Null and empty texts are one group. Null ids come last: such a row is kept,
    with a null ``keep_id``, only where all ids of its group are null. Other
    columns are not looked at. An empty table gives no rows. ``bits`` of each of
    two chunk hashes are used; the result does not depend on it.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    cut = texts.mapInArrow(_cutter(bits), _SENT)
    found = settled(
        cut.repartition(F.coalesce("h1", F.xxhash64("id", "text_sha256", "part")))
        .sortWithinPartitions("h1", "h2", "content")
        .mapInArrow(_compared, _FOUND)
    )
    rows = _identified(found).groupBy("chunks", "id").agg(
        F.count("*").alias("copies"), F.first("text_sha256").alias("text_sha256")
    )
    rows = settled(rows)
    groups = (
        rows.groupBy("chunks")
        .agg(F.min("id").alias("least"), F.sum("copies").alias("size"), F.count("*").alias("ids"))
        .where("ids > 1")
        .select(F.col("chunks").alias("of"), "least", "size", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    first = F.explode(F.sequence(F.lit(0).cast("long"), (F.col("copies") - 1).cast("long"), F.lit(_COPIES).cast("long")))
    every = F.explode(F.sequence(F.col("from"), F.least(F.col("from") + _COPIES, F.col("copies")) - 1))
    return (
        rows.join(groups, (F.col("chunks") == F.col("of")) & (salt == F.col("salt")), "left")
        .select(
            "id",
            F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("least")).alias("keep_id"),
            F.coalesce("size", "copies").cast("long").alias("group_size"),
            "text_sha256",
            "copies",
            first.alias("from"),
        )
        .select("id", "keep_id", "group_size", "text_sha256", every.alias("copy"))
        .select(
            F.col("id").alias(id_col),
            "keep_id",
            "group_size",
            (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
            "text_sha256",
        )
    )
