"""The load job and what follows it: generate, write, lay out, summarise, report."""

from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal
import logging
import time

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger import schemas
from skyledger.functions.text import table_identifier
from skyledger.functions.times import time_literal
from skyledger.operators.summary import summary
from skyledger.operators.weather import weather, weather_stored
from skyledger.plans.planning import load_plan
from skyledger.plans.report import run_report
from skyledger.sinks import layouts, tables
from skyledger.sinks.jdbc import write_jdbc
from skyledger.sources.readers import row_ids

#: Columns that batch, time and place lookups filter on.
LOOKUP_COLUMNS = ("batch_id", "event_time", "latitude", "longitude")


def load_weather(
    spark: SparkSession,
    rows: int,
    table: str,
    seed: int = 0,
    load_time: datetime | None = None,
    partitions: int | None = None,
) -> dict:
    """Start the table afresh, generate the rows and append them.

    Range, projection and write in one stage: no shuffle, and rows stream to files.
    Returns the rows asked for, the rows counted while writing, and the write's time.
    Running it again after a failure gives the same table.
    """
    tables.create_table(spark, table)
    at = None if load_time is None else time_literal(load_time, T.TimestampType())
    generated = weather_stored(row_ids(spark, rows, partitions), seed, at)
    started = time.monotonic()
    written = tables.counting_rows(generated, lambda df: tables.append(df, table))
    return _load_record(table, rows, written, started)


def load_weather_jdbc(
    spark: SparkSession,
    rows: int,
    options: dict[str, str],
    table: str,
    seed: int = 0,
    partitions: int | None = None,
) -> dict:
    """Append generated rows to a database table that fills the key and load time.

    The nine generated columns go out as generated; the database narrows them to the
    types it has declared.
    """
    generated = weather(row_ids(spark, rows, partitions), seed)
    started = time.monotonic()
    written = tables.counting_rows(generated, lambda df: write_jdbc(df, options, table))
    return _load_record(table, rows, written, started)


def _load_record(table: str, requested: int, written: int, started: float) -> dict:
    return {
        "status": "success",
        "table_name": table,
        "records_requested": requested,
        "records_written": written,
        "elapsed_seconds": time.monotonic() - started,
    }


def finalize(
    spark: SparkSession,
    table: str,
    records_processed: int,
    statistics: bool = True,
    columns: tuple[str, ...] = LOOKUP_COLUMNS,
    layouts_folder: str | None = None,
    lookups: tuple[str, ...] = ("batch", "day", "cell"),
    buckets: int | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Lay the table out, refresh its statistics and return its summary as one row.

    ``columns`` names those that get column statistics: the ones lookups filter on,
    unless told otherwise. With ``layouts_folder`` the layouts in ``lookups`` are
    written there, each a copy and a shuffle of the table, with the ``buckets`` and
    ``ranges`` given or as many as the table's size asks for.
    """
    started = time.monotonic()
    if layouts_folder is not None:
        lay_out(spark, table, layouts_folder, buckets, lookups, ranges)
    if statistics:
        tables.analyze(spark, table, list(columns))
    row = summary(spark.table(table), with_size=True).first()
    return spark.createDataFrame(
        [
            (
                time.monotonic() - started,
                records_processed,
                row["table_size"],
                row["record_count"],
                float(row["avg_temperature"]),
            )
        ],
        "finalization_time_seconds double, records_processed bigint, table_size string, "
        "record_count bigint, avg_temperature double",
    )


@dataclass
class Layouts:
    """Copies of one table, each laid out for one kind of lookup; None where not wanted."""

    by_batch: DataFrame | None = None
    by_day: DataFrame | None = None
    by_cell: DataFrame | None = None


def lay_out(
    spark: SparkSession,
    table: str,
    folder: str,
    buckets: int | None = None,
    lookups: tuple[str, ...] = ("batch", "day", "cell"),
    ranges: int | None = None,
) -> Layouts:
    """Write the wanted lookup layouts of a table.

    Each is a copy and a shuffle of the whole table. The bucketed copy is the table
    ``<table>_by_batch``. ``buckets`` of it and ``ranges`` of the place layout follow
    from the sizes of the table's files unless they are given.
    """
    rows = spark.table(table_identifier(table))
    made = Layouts()
    if "batch" in lookups:
        made.by_batch = layouts.bucket_by_batch(rows, f"{table}_by_batch", f"{folder}/by_batch", buckets)
    if "day" in lookups:
        made.by_day = layouts.partition_by_day(rows, f"{folder}/by_day")
    if "cell" in lookups:
        made.by_cell = layouts.partition_by_cell(rows, f"{folder}/by_cell", ranges=ranges)
    return made


def run(
    spark: SparkSession,
    num_records: int = schemas.REQUEST_DEFAULTS["num_records"],
    table_name: str = schemas.REQUEST_DEFAULTS["table_name"],
    data_size: str = schemas.REQUEST_DEFAULTS["data_size"],
    seed: int = 0,
    load_time: datetime | None = None,
    layouts_folder: str | None = None,
    lookups: tuple[str, ...] = ("batch", "day", "cell"),
) -> DataFrame:
    """Estimate, load, finalize and report: the whole job for one request, as one row.

    With ``layouts_folder`` the job makes the access paths in ``lookups`` there too.

    ``data_size`` sets the estimate that stands next to the report; the session and
    its resources are the caller's. A load that fails is logged and reported, not
    raised; its report has the status of a run with warnings and no statistics.
    """
    request = spark.createDataFrame([(num_records, table_name, data_size)], schemas.LOAD_REQUEST)
    plan = load_plan(request).first()
    log = {"run_id": table_name, "status": "failed", "records_requested": num_records}
    try:
        loaded = load_weather(spark, num_records, table_name, seed, load_time)
        log |= {key: loaded[key] for key in ("records_written", "elapsed_seconds")}
        stored = finalize(
            spark, table_name, loaded["records_written"], layouts_folder=layouts_folder, lookups=lookups
        ).first()
        log |= {
            "status": "success",
            "finalization_seconds": stored["finalization_time_seconds"],
            "records_stored": stored["record_count"],
            "table_size": stored["table_size"],
            "avg_temperature": Decimal(str(stored["avg_temperature"])),
        }
    except Exception:
        logging.getLogger(__name__).exception("load of %s failed", table_name)
    planned = ("data_size", "recommended_size", "estimated_time_seconds", "estimated_time_formatted")
    return run_report(spark.createDataFrame([log], schemas.LOAD_LOG)).select(
        "*", *[F.lit(plan[name]).alias(name) for name in planned]
    )
