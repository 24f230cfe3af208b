"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text is the set of its hashed words, pairs of neighbours and pairs with one or
two words between. Learning keeps a rate for each coordinate and an L1 penalty,
so few weights are not zero and they travel as a small broadcast.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.shingles import WordHashes, mixed

#: Weights: 2 ** BITS of four bytes at most.
BITS = 20
#: Labelled rows that learning takes, of each label, those first in a hashed order. Rows, not a share: memory is bounded.
SAMPLE = 4000
EPOCHS = 6
#: With L1 at the number of epochs, a feature of one row alone never gets a weight.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 1.0
_TRIM = bytes(c for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122))


def held_out(id_: Column) -> Column:
    """The fold that learning never sees: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(text: str | None, cache: WordHashes) -> np.ndarray:
    """Buckets of all words and word pairs of a text, as often as they occur."""
    words = (w.strip(_TRIM) for w in text.encode("utf-8").lower().split()) if text else ()
    words = [w for w in words if w]
    one = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    parts = [mixed(one)]
    for gap in (1, 2, 3):
        if len(one) > gap:
            pair = one[:-gap] * np.uint64(0x9E3779B97F4A7C15) + one[gap:] + np.uint64(gap)
            parts.append(mixed(pair))
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32)


def packed(buckets: np.ndarray) -> bytes:
    """Distinct buckets in order, as numbers of four bytes or, where that is less, a bit for each bucket: 2 ** (BITS - 3) bytes at most."""
    if 4 * len(buckets) < 1 << BITS - 3:
        return buckets.astype("<i4").tobytes()
    bits = np.zeros(1 << BITS, np.uint8)
    bits[buckets] = 1
    return np.packbits(bits).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The inverse of ``packed``."""
    if len(data) < 1 << BITS - 3:
        return np.frombuffer(data, "<i4")
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8))).astype(np.int32)


def learned(rows: list[tuple[bytes, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias by FTRL-proximal over rows (packed buckets, label): z and n for each coordinate, weights made on demand."""
    z = np.zeros(1 << BITS)
    n = np.zeros(1 << BITS)
    z0 = n0 = 0.0

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * L1 - zs
        return np.where(np.abs(zs) <= L1, 0.0, shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            data, label = rows[i]
            at = unpacked(data)
            w = weights(z[at], n[at])
            bias = -z0 / ((BETA + n0**0.5) / ALPHA)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = p - label
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
            z0 += g - ((n0 + g * g) ** 0.5 - n0**0.5) / ALPHA * bias
            n0 += g * g
    return weights(z, n).astype(np.float32), float(-z0 / ((BETA + n0**0.5) / ALPHA))


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """The model as rows (bucket, weight) with weights other than zero; bucket -1 is the bias.

    Learning takes up to ``sample`` rows of each label outside the held-out
    fold, the first by a hash of the id, with all their features. Features are made
    where the rows are; only their buckets meet, 128 kB a row at most. Of rows that
    repeat an id one is learnt, the first by its buckets. Null ids, null labels and
    labels without a document are left out. Without rows the model is empty and all
    scores are a half.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")
    )
    order = F.struct(F.xxhash64("id"), F.col("id"))
    some = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    chosen = some.where("label = 1").orderBy(order).limit(sample).union(some.where("label = 0").orderBy(order).limit(sample))
    texts = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            sets = [packed(np.unique(features(t.as_py(), cache))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sets, pa.binary())], ["id", "label", "buckets"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))]
        rows.sort()
        w, bias = learned([(b, y) for _, y, b in rows]) if rows else (np.zeros(0, np.float32), 0.0)
        kept = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(kept, -1), pa.int32()), pa.array(np.append(w[kept], bias), pa.float64())],
            ["bucket", "weight"],
        )

    return (
        texts.join(F.broadcast(chosen), texts["doc"] == chosen["id"])
        .select("doc", "text", "label")
        .mapInArrow(made, "id long, label int, buckets binary")
        .groupBy("id", "label")
        .agg(F.min("buckets").alias("buckets"))
        .repartition(1)
        .mapInArrow(fit, "bucket int, weight double")
    )


def scored(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5) of every row, from its text alone.

    Null and empty texts have no features: their score is the bias alone. Null
    ids count as not held out; ids may repeat. An empty table gives no rows.
    """
    weights = np.zeros(1 << BITS, np.float32)
    bias = 0.0
    for row in model.collect():  # 2 ** BITS rows at most
        if row.bucket < 0:
            bias = row.weight
        else:
            weights[row.bucket] = row.weight
    at = np.flatnonzero(weights).astype(np.int32)
    shared = docs.sparkSession.sparkContext.broadcast((at, weights[at], bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, bias = shared.value
        table = np.zeros(1 << BITS, np.float32)
        table[at] = values
        cache = WordHashes()
        for batch in batches:
            out = []
            for text in batch.column(1):
                found = features(text.as_py(), cache)
                found = np.unique(found[table[found] != 0])
                total = float(table[found].sum(dtype=np.float64)) + bias
                out.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], ["id", "score"])

    return (
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(score, "id long, score double")
        .select(
            F.col("id").alias(id_col),
            held_out(F.col("id")).alias("held_out"),
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
        )
    )
