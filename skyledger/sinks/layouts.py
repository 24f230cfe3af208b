"""Layouts that serve key, time and place lookups in place of indexes.

Each is one shuffle. ``rebalance`` sizes the output from what the shuffle really
holds: small partitions are joined and a key with a large share of the rows is
spread over as many tasks as it needs, so one hot batch, day or place neither fills
a task nor leaves one huge file. The target size is the session's
``spark.sql.adaptive.advisoryPartitionSizeInBytes``. Each write replaces what was
there, so it can be repeated.
"""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from skyledger.functions.text import table_identifier
from skyledger.functions.times import day_of
from skyledger.operators.lookups import CELL_DEGREES, CURVE_BITS, cell_column, cell_of, curve_of
from skyledger.schemas import BATCHES

#: Bits of the curve that places are counted by at first, and that are added where they are crowded.
PREFIX, FINER = 12, 10
#: Sizes that a bucket and a range of the place layout are made for.
BUCKET_BYTES, RANGE_BYTES = 4 << 30, 256 << 20
#: Rows of a range that one task sorts; a larger range goes to several tasks, place by place.
TASK_ROWS = 1 << 20
#: Sizes from here on stand for unknown ones.
_UNKNOWN = 1 << 60


def stored_bytes(df: DataFrame) -> int | None:
    """Bytes of the files, tables or ranges of numbers that a frame reads, as Spark has listed them; None where it does not know."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(at).stats().sizeInBytes())) for at in range(leaves.size())]
    return sum(sizes) if sizes and max(sizes) < _UNKNOWN else None


def buckets_for(size: int) -> int:
    """Buckets for so many bytes: one per 4 GB, 16 at least, one per batch at most."""
    return min(max(16, -(-size // BUCKET_BYTES)), BATCHES)


def ranges_for(df: DataFrame) -> int:
    """Ranges for the data: one per 256 MB of the files behind it, but as many as there are cores.

    Where their size is not known, as many as ``spark.sql.shuffle.partitions``.
    """
    size = stored_bytes(df)
    if size is None:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(-(-size // RANGE_BYTES), df.sparkSession.sparkContext.defaultParallelism)


def bucket_by_batch(df: DataFrame, table: str, path: str, buckets: int | None = None) -> DataFrame:
    """A table in which one batch is found in one bucket's files.

    ``buckets`` follow from the size of the files behind ``df`` unless told otherwise.
    """
    buckets = buckets or buckets_for(stored_bytes(df) or 0)
    (
        df.hint("rebalance", "batch_id")
        .write.mode("overwrite")
        .bucketBy(buckets, "batch_id")
        .sortBy("batch_id")
        .option("path", path)
        .saveAsTable(table_identifier(table))
    )
    return df.sparkSession.table(table)


def partition_by_day(
    df: DataFrame, path: str, time_col: str = "event_time", date_col: str = "event_date"
) -> DataFrame:
    """A directory per day, rows in time order inside each file."""
    (
        df.withColumn(date_col, day_of(F.col(time_col), df.schema[time_col].dataType))
        .hint("rebalance", date_col)
        .sortWithinPartitions(date_col, time_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(date_col)
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path)


@dataclass(frozen=True)
class Place:
    """Rows of one cell whose curve starts with the bits of ``start``: where they go, ``parts`` tasks from ``first`` on."""

    cell: int
    start: int
    depth: int
    rows: int
    first: int = 0
    parts: int = 1


def _counted(rows: DataFrame, depth: int, within: list[Place]) -> list[Place]:
    """Rows of each cell and curve prefix of ``depth`` bits, in all cells at first, then in the places named."""
    span = 2 * CURVE_BITS - depth
    if within:
        up = 2 * CURVE_BITS - within[0].depth
        named = rows.sparkSession.createDataFrame([(p.cell, p.start >> up) for p in within], "in_cell int, in_prefix long")
        inside = (F.col("__cell") == F.col("in_cell")) & (F.shiftright("__curve", up) == F.col("in_prefix"))
        rows = rows.join(F.broadcast(named), inside, "left_semi")
    found = rows.groupBy("__cell", F.shiftright("__curve", span).alias("__prefix")).agg(F.count(F.lit(1)).alias("rows"))
    # bounded by the prefixes; rows without a coordinate have no place
    return [Place(r["__cell"], r["__prefix"] << span, depth, r["rows"]) for r in found.collect() if r["__prefix"] is not None]


def places(rows: DataFrame, ranges: int, most: int = TASK_ROWS) -> list[Place]:
    """Places in order of cell and curve, cut finer where more rows lie than one task takes.

    A range is a task where it has no more than ``most`` rows, else it is cut, like
    the whole, into as many equal parts as that asks for.

    ``rows`` has columns ``__cell`` and ``__curve``. The first count has at most
    4^PREFIX / 2 places besides the cells, each finer one 4^FINER for each place that is
    cut, and fewer than there are tasks are. Only a place as fine as the curve is still
    larger than a task's share; its rows go to several tasks by a hash.
    """
    level = _counted(rows, PREFIX, [])
    total = sum(p.rows for p in level)
    target = max(1, -(-total // (ranges * max(1, -(-total // (ranges * most))))))
    done: list[Place] = []
    while level:
        depth = level[0].depth
        full = depth >= 2 * CURVE_BITS
        done += [p for p in level if full or p.rows <= target]
        wide = [] if full else [p for p in level if p.rows > target]
        level = _counted(rows, min(depth + FINER, 2 * CURVE_BITS), wide) if wide else []
    done.sort(key=lambda p: (p.cell, p.start))
    out, first, room = [], 0, target
    for p in done:
        if p.rows > room and room < target:  # the range so far is closed
            first, room = first + 1, target
        parts = -(-p.rows // target)
        out.append(replace(p, first=first, parts=parts))
        if parts > 1:
            first, room = first + parts, target
        else:
            room -= p.rows
            if room <= 0:
                first, room = first + 1, target
    return out


def _range_of(df: DataFrame, found: list[Place], tasks: int, columns: list[str]) -> DataFrame:
    """``df`` with ``__range``, the task each row goes to; without a place any of them.

    The places are a few thousand rows, sent to all tasks.
    """
    span = 2 * CURVE_BITS - PREFIX
    by_prefix: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for p in found:
        by_prefix.setdefault((p.cell, p.start >> span), []).append((p.start, p.first, p.parts))
    sent = df.sparkSession.createDataFrame(
        [(cell, prefix, held) for (cell, prefix), held in by_prefix.items()],
        "at_cell int, at_prefix long, held array<struct<start:long,first:int,parts:int>>",
    )
    placed = df.join(F.broadcast(sent), (F.col("__cell") == F.col("at_cell")) & (F.shiftright("__curve", span) == F.col("at_prefix")), "left")
    place = F.when(F.size("held") == 1, F.get("held", F.lit(0))).otherwise(
        F.element_at(F.filter("held", lambda p: p["start"] <= F.col("__curve")), -1)
    )
    placed = placed.withColumn("__place", place)
    dealt = F.when(F.col("__place.parts") > 1, F.pmod(F.xxhash64(*columns), F.col("__place.parts"))).otherwise(F.lit(0))
    nowhere = F.pmod(F.xxhash64(*columns), F.lit(tasks))
    return placed.withColumn("__range", F.coalesce(F.col("__place.first") + dealt, nowhere).cast("int")).drop(
        "at_cell", "at_prefix", "held", "__place"
    )


def partition_by_cell(
    df: DataFrame, path: str, degrees: int = CELL_DEGREES, ranges: int | None = None
) -> DataFrame:
    """A directory per grid cell, rows in order of place inside it.

    Rows are dealt in ranges of cell and then of place along a curve that keeps near
    places together, so the files of a hot cell hold areas that hardly overlap and a
    small box opens few of them. Places are counted first, from the two coordinates
    alone, finer where they are crowded; then each row goes straight to its range, so
    the rows are read and shuffled once. ``ranges``, of about equal size each, are as
    many as the size of the data asks for (``ranges_for``) unless told otherwise; a range
    of more than ``TASK_ROWS`` rows is sorted and written by several tasks, each with
    a part of its places. Rows of one place, and rows without a coordinate, are dealt on by a hash of the row.
    """
    cell = cell_column(degrees)
    ranges = ranges or ranges_for(df)
    points = df.select(
        cell_of(F.col("latitude"), F.col("longitude"), degrees).alias("__cell"),
        curve_of(F.col("latitude"), F.col("longitude")).alias("__curve"),
    )
    found = places(points, ranges)
    keyed = df.withColumns(
        {
            "__cell": cell_of(F.col("latitude"), F.col("longitude"), degrees),
            "__curve": curve_of(F.col("latitude"), F.col("longitude")),
        }
    )
    tasks = max((p.first + p.parts for p in found), default=1)
    (
        _range_of(keyed, found, tasks, df.columns)
        .repartitionById(tasks, "__range")
        .withColumnRenamed("__cell", cell)
        .sortWithinPartitions(cell, "__curve")
        .drop("__curve", "__range")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(cell)
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path)
