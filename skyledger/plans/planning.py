"""Plans for load requests: expected time, partitions and a fitting size tier."""

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import schemas
from skyledger.functions.text import duration_text
from skyledger.sinks.jdbc import OLDER_WRITE_DEFAULTS, WRITE_DEFAULTS
from skyledger.sources.readers import load_requests, tiers

# From this many rows on, tasks per unit of parallelism, and the most tasks.
TASK_STEPS = ((100_000_000, 8, 2000), (10_000_000, 4, None), (1_000_000, 2, None))
# Fixed values of the older rule: below this many rows, rows per task; above all, the last.
OLDER_ROWS_PER_TASK = ((100_000, 10_000), (10_000_000, 50_000))
OLDER_ROWS_PER_TASK_ABOVE = 100_000
# Tier recommended from this many rows on.
RECOMMENDED = ((1_000_000_000, "xlarge"), (100_000_000, "large"), (1_000_000, "medium"))
SMALLEST = "small"


def planned_partitions(rows: Column, parallelism: Column) -> Column:
    """Generator tasks for a load, by its row count."""
    steps = None
    for threshold, factor, most in TASK_STEPS:
        tasks = parallelism * factor
        if most is not None:
            tasks = F.least(tasks, F.lit(most))
        steps = F.when(rows >= threshold, tasks) if steps is None else steps.when(rows >= threshold, tasks)
    return steps.otherwise(parallelism).cast("bigint")


def older_partitions(rows: Column, parallelism: Column) -> Column:
    """Generator tasks by the older rule: rows per task, at least the parallelism."""
    per_task = None
    for limit, size in OLDER_ROWS_PER_TASK:
        per_task = F.when(rows < limit, size) if per_task is None else per_task.when(rows < limit, size)
    per_task = per_task.otherwise(OLDER_ROWS_PER_TASK_ABOVE)
    return F.greatest(F.floor(rows / per_task), parallelism).cast("bigint")


def recommended_size(rows: Column) -> Column:
    """The tier whose row range the load falls into."""
    choice = None
    for threshold, name in RECOMMENDED:
        choice = F.when(rows >= threshold, name) if choice is None else choice.when(rows >= threshold, name)
    return choice.otherwise(SMALLEST)


def _with_tier(requests: DataFrame) -> DataFrame:
    """Requests with the settings of their tier, or of the default tier.

    The tiers are four literal rows: the planner sees their size and broadcasts them.
    """
    default = dict(
        zip(schemas.TIERS.fieldNames(), next(row for row in schemas.TIER_ROWS if row[0] == schemas.DEFAULT_TIER))
    )
    joined = load_requests(requests).join(tiers(requests.sparkSession), "data_size", "left")
    settings = [field for field in schemas.TIERS if field.name != "data_size"]
    return joined.withColumns(
        {
            field.name: F.coalesce(F.col(field.name), F.lit(default[field.name])).cast(field.dataType)
            for field in settings
        }
    )


def _extra(requests: DataFrame) -> list[str]:
    return [name for name in requests.columns if name not in schemas.LOAD_REQUEST.fieldNames()]


def load_plan(requests: DataFrame) -> DataFrame:
    """One plan per request; a map over the requests with no shuffle.

    An unknown size name is kept in ``data_size`` and planned with the default tier.
    """
    rows, parallelism = F.col("num_records"), F.col("parallelism")
    seconds = rows.cast("double") / F.col("rate_per_sec")
    partitions = planned_partitions(rows, parallelism)
    return _with_tier(requests).select(
        *_extra(requests),
        "num_records",
        "table_name",
        "data_size",
        recommended_size(rows).alias("recommended_size"),
        F.col("rate_per_sec").alias("estimated_rate_per_sec"),
        seconds.alias("estimated_time_seconds"),
        (seconds / 3600).alias("estimated_time_hours"),
        duration_text(seconds).alias("estimated_time_formatted"),
        "executor_memory",
        "executor_cores",
        "driver_memory",
        "shuffle_partitions",
        "parallelism",
        partitions.alias("planned_partitions"),
        F.least(partitions, F.lit(int(WRITE_DEFAULTS["numPartitions"]))).cast("bigint").alias("jdbc_writers"),
    )


def older_load_plan(requests: DataFrame) -> DataFrame:
    """Partitions and database writers per request by the older rule."""
    partitions = older_partitions(F.col("num_records"), F.col("parallelism"))
    return _with_tier(requests).select(
        *_extra(requests),
        "num_records",
        "data_size",
        partitions.alias("planned_partitions"),
        F.least(partitions, F.lit(int(OLDER_WRITE_DEFAULTS["numPartitions"])))
        .cast("bigint")
        .alias("jdbc_writers"),
    )
