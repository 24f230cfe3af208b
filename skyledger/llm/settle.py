"""Cutting lineage in the folder that all executors share."""

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from skyledger.sinks.shared import shared_folder

#: Shuffle files of a step go when it ends, as its result is in the shared folder or on the driver by then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Plans made inside leave no shuffle files when they have run."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the shared checkpoint folder, so lost executors lose nothing.

    Its files stay until ``released``, or, where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on, until the result is no
    longer referenced.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))
    with _tidy(spark):
        return df.select("*").checkpoint()


def released(*frames: DataFrame) -> None:
    """Remove the files of settled frames. Neither they nor what was made of them may be computed again."""
    for df in frames:
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def is_empty(df: DataFrame) -> bool:
    with _tidy(df.sparkSession):
        return not df.select("*").take(1)


def first_row(df: DataFrame) -> Row:
    with _tidy(df.sparkSession):
        return df.select("*").first()


def fetched(df: DataFrame) -> pa.Table:
    """All rows of a frame of bounded size."""
    with _tidy(df.sparkSession):
        return df.select("*").toArrow()


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether a frame has no more than ``rows`` rows."""
    return first_row(df.limit(rows + 1).agg(F.count("*")))[0] <= rows


def sent_if_small(df: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """``df``, marked for broadcast if it has no more than ``rows`` rows, else joined by a shuffle; and what to release."""
    kept = settled(df)
    return (F.broadcast(kept) if is_small(kept, rows) else kept), kept
