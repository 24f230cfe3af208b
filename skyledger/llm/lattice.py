"""Near-duplicate vectors by lattice hashing.

In each of several tables a unit vector is projected at random onto two
eight-dimensional spaces, and each projection decoded to its nearest point of
the E8 lattice; the two points name its cell. It also goes to the neighbouring
cells whose points are next nearest. Cells propose stars, which are confirmed by
cosine. The links of each vector are then counted inside its component, block
against block, so that every linked pair counts.
"""

from collections.abc import Iterator
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.nodes import joined_ids, met_by_class, named_classes
from skyledger.llm.settle import released, settled
from skyledger.llm.shingles import mixed
from skyledger.llm.stars import across, joined_by_stars

#: A pair of cosine 0.95 shares a cell of one table in about a third of cases, of 24 tables in all but 1 of 10,000.
TABLES = 24
#: Cells are smaller the larger the scale.
SCALE = 0.6
#: Neighbouring cells in each of the two spaces.
PROBES = 3
#: Vectors compared at once with as many others.
BLOCK = 256


def _roots() -> np.ndarray:
    """The 240 shortest points of E8: two entries of +-1, or all of +-1/2 with an even number below 0."""
    whole = [
        [s * (k == i) + t * (k == j) for k in range(8)]
        for i, j in itertools.combinations(range(8), 2)
        for s in (1, -1)
        for t in (1, -1)
    ]
    half = [p for p in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in p) % 2 == 0]
    return np.array(whole + half, dtype=np.float64)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum: if it is odd, the entry rounded furthest goes the other way."""
    near = np.rint(x)
    odd = near.sum(axis=1).astype(np.int64) & 1 == 1
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(odd)
    near[rows, worst[rows]] += np.where(off[rows, worst[rows]] >= 0, 1, -1)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: the even whole points, or those moved by 1/2."""
    whole = _nearest_d8(x)
    half = _nearest_d8(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def _named(points: np.ndarray, seed: int) -> np.ndarray:
    """64-bit names of lattice points."""
    name = np.full(len(points), seed, dtype=np.uint64)
    for column in np.rint(points * 2).astype(np.int64).view(np.uint64).T:
        name = mixed(name * np.uint64(0x9E3779B97F4A7C15) + column)
    return name


def cells(units: np.ndarray, tables: int = TABLES, scale: float = SCALE, probes: int = PROBES) -> np.ndarray:
    """Keys of the cells of each unit vector: in every table its own, and the neighbours in either space."""
    roots = _roots()
    out = []
    for table in range(tables):
        spaces = []
        for space in range(2):
            draw = np.random.default_rng([units.shape[1], table, space])
            y = units @ (draw.normal(size=(units.shape[1], 8)) * scale)
            point = nearest_e8(y)
            nearest = np.argpartition(-((y - point) @ roots.T), probes, axis=1)[:, :probes]
            seed = (units.shape[1] * 1000 + table) * 2 + space
            spaces.append([_named(point, seed), *(_named(point + roots[nearest[:, k]], seed) for k in range(probes))])
        first, second = spaces
        pairs = [(first[0], s) for s in second] + [(f, second[0]) for f in first[1:]]
        out += [mixed(f * np.uint64(0x9E3779B97F4A7C15) + s).view(np.int64) for f, s in pairs]
    return np.stack(out, axis=1) if out else np.empty((len(units), 0), np.int64)


def _unit(value: pa.Scalar) -> np.ndarray | None:
    """A vector of length 1 in double precision; None of what has no direction."""
    if not value.is_valid or value.values.null_count or not len(value.values):
        return None
    vector = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
    top = np.abs(vector).max()
    if not np.isfinite(top) or top == 0:
        return None
    vector = vector / top
    return vector / np.sqrt((vector * vector).sum())


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vector, digest and cells of each row, null where it links with nothing."""
    for batch in batches:
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        rest = []
        for i, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            unit = None if i is None else _unit(value)
            if unit is None:
                rest.append(i)
            else:
                by_size.setdefault(len(unit), []).append((i, unit))
        names = ["id", "h1", "h2", "unit", "cells"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rest, pa.int64()), *(pa.nulls(len(rest), kind) for kind in kinds[1:])], names
        )
        for held in by_size.values():
            units = np.stack([v for _, v in held])
            digests = [np.frombuffer(xxhash.xxh3_128_digest(v.tobytes()), np.int64) for v in units]
            columns = ([i for i, _ in held], [int(d[0]) for d in digests], [int(d[1]) for d in digests], list(units), list(cells(units)))
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names)


def _counter(cosine: float):
    def count(key: tuple, table: pa.Table) -> pa.Table:
        """Links between two blocks of a component, or inside one; each row's count of the others' copies."""
        low, high = key[1].as_py(), key[2].as_py()
        units = np.stack(table["unit"].to_numpy())
        weight = table["copies"].to_numpy()
        block = table["block"].to_numpy()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        links = np.zeros(len(units), np.int64)
        for at in range(0, len(left), BLOCK):
            part = left[at : at + BLOCK]
            near = units[part] @ units[right].T >= cosine
            if low == high:
                near[np.arange(len(part)), np.arange(at, at + len(part))] = False
            links[part] += near @ weight[right]
            if low != high:
                links[right] += weight[part] @ near
        return pa.table({"id": table["id"], "links": pa.array(links)})

    return count


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    Vectors are linked when their cosine, in double precision, is ``cosine`` or
    more. ``component_id`` is the least id reachable by links, ``kept`` says that
    it is the row's own. Null and zero vectors, those with null or non-finite
    components, and rows with a null id link with nothing and are kept. Vectors
    of different lengths are never linked. Rows that repeat an id are vectors of
    their own that belong together; ``n_links`` counts rows. Other columns are not
    looked at. An empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    placed = settled(rows.mapInArrow(_placed, "id long, h1 long, h2 long, unit array<double>, cells array<long>"))
    equal = placed.select("id", "h1", "h2")
    usable = placed.where("h1 IS NOT NULL")
    classes, copies = named_classes(usable.select("id", "h1", "h2"))
    held_by_first = usable.select(F.col("id").alias("of"), F.col("h1").alias("s1"), F.col("h2").alias("s2"), "unit", "cells")
    same = (F.col("of") == F.col("first")) & (F.col("s1") == F.col("h1")) & (F.col("s2") == F.col("h2"))
    nodes = settled(
        classes.join(held_by_first, same).dropDuplicates(["node"]).select(F.col("node").alias("id"), "copies", "unit", "cells")
    )

    def confirm(pairs: DataFrame, candidates: DataFrame, last: bool) -> DataFrame:
        side = lambda x: nodes.select(F.col("id").alias(x), F.col("unit").alias(f"unit_{x}"))
        dot = F.aggregate(F.zip_with("unit_a", "unit_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        same = F.size("unit_a") == F.size("unit_b")
        return settled(pairs.join(side("a"), "a").join(side("b"), "b").where(same & (dot >= cosine)).select("a", "b"))

    def near(table: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        units = np.stack(table["unit"].to_numpy())
        return units[left] @ units[right].T >= cosine

    def rest(crowds: DataFrame) -> DataFrame:
        return across(crowds, nodes.select("id", "unit"), near)

    dealt = nodes.select("id", F.explode(F.array_distinct("cells")).alias("bucket"))
    found = joined_by_stars(dealt, copies, confirm, rest)

    # all links lie inside components; blocks of a component meet pair by pair
    members = nodes.join(found, nodes["id"] == found["node"]).select("component", "id", "copies", "unit")
    sizes = members.groupBy(F.col("component").alias("of")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    blocked = members.join(sizes, F.col("component") == F.col("of")).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    met = blocked.select(
        "component", "id", "copies", "unit", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    counted = (
        met.groupBy("component", "low", "high")
        .applyInArrow(_counter(cosine), "id long, links long")
        .groupBy(F.col("id").alias("counted"))
        .agg(F.sum("links").alias("links"))
    )
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    per_class = settled(
        classes.join(counted, F.col("node") == F.col("counted"), "left").select("h1", "h2", n_links.alias("n_links"))
    )
    reached = joined_ids(found, classes)
    released(nodes, classes)
    linked = met_by_class(equal, per_class.where("n_links > 0"), "left")
    return linked.join(reached, F.col("id") == F.col("node"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce("component", "id").eqNullSafe(F.col("id")).alias("kept"),
    )
