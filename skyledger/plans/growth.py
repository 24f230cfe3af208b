"""Finalizing a table that grows by runs: each run's rows are read once, however often the table is finalized."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from skyledger.functions.numbers import size_text
from skyledger.operators import partials
from skyledger.sinks import files, runs


@dataclass(frozen=True)
class Finalized:
    """A committed state, the statistics of all its rows, and how many rows were read to bring them up to date."""

    state: runs.Commit
    merged: DataFrame
    rows_read: int

    def summary(self, time_col: str = "event_time", value_col: str = "temperature") -> DataFrame:
        """One row: size, count, first and last time, mean value, and the rows read."""
        size = F.lit(sum(run.bytes for run in self.state.runs)).cast("long")
        told = partials.summary_of(self.merged, self.state.schema, time_col, value_col)
        return told.select(
            size_text(size).alias("table_size"), size.alias("size_bytes"), "*", F.lit(self.rows_read).cast("long").alias("rows_read")
        )

    def profile(self) -> DataFrame:
        """A row per column."""
        return partials.profile_of(self.merged, self.state.schema)


def _statistics(path: str) -> str:
    return f"{path}/statistics"


def finalize(spark: SparkSession, path: str) -> Finalized:
    """Bring the statistics of the table at ``path`` (see ``sinks.runs``) up to date with its newest commit.

    Only files of runs without statistics are read, all in one scan. Statistics belong
    to an attempt and are written in one step, so a run that is written again gets new
    ones, and a finalize that fails or runs twice changes nothing.
    """
    state = runs.newest(spark, path)
    if state is None:
        raise ValueError(f"nothing is committed at {path}")
    folder = _statistics(path)
    known = {name.removeprefix("attempt=") for name in files.names(spark, folder)}
    fresh = [run for run in state.runs if run.attempt not in known]
    rows_read = 0
    if fresh:
        seen = Observation()
        rows = runs.attempts(spark, path, state, fresh).observe(seen, F.count(F.lit(1)).alias("rows"))
        made = partials.partial_statistics(rows, state.schema, "attempt")
        # a run without rows has no group
        every = spark.createDataFrame([(run.attempt,) for run in fresh], "attempt string")
        every = made.unionByName(every, allowMissingColumns=True).groupBy("attempt").agg(
            *(F.max_by(c, F.col("rows").isNotNull()).alias(c) for c in made.columns if c != "attempt")
        )
        (
            every.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("attempt")
            .parquet(folder)
        )
        rows_read = seen.get["rows"]
    used = [run.attempt for run in state.runs]
    if not used:
        none = partials.partial_statistics(runs.attempts(spark, path, state, []), state.schema, "attempt")
        return Finalized(state, partials.merged_statistics(none, state.schema), 0)
    kept = spark.read.option("basePath", folder).parquet(*(f"{folder}/attempt={attempt}" for attempt in used))
    return Finalized(state, partials.merged_statistics(kept, state.schema), rows_read)


def remove_unused(spark: SparkSession, path: str, older_than_hours: float = 24.0) -> list[str]:
    """``runs.remove_unused``, and the statistics of what it removes."""
    gone = runs.remove_unused(spark, path, older_than_hours)
    for attempt in gone:
        files.remove(spark, f"{_statistics(path)}/attempt={attempt}")
    return gone
