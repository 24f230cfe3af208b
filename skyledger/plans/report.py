"""Reports over a log of runs."""

from pyspark.sql import DataFrame, functions as F

from skyledger.functions.numbers import rows_per_second
from skyledger.functions.text import fixed_point, with_thousands

# Report states and messages.
COMPLETED = ("completed", "Spark ETL pipeline completed successfully")
WITH_WARNINGS = ("completed_with_warnings", "Pipeline completed but some tasks may have failed")
FAILED = ("cleanup_failed", "Cleanup failed: ")
UNKNOWN = "Unknown"


def run_report(runs: DataFrame) -> DataFrame:
    """One report row per logged run; a map over the log with no shuffle.

    A run whose report step raised has failed, one that logged ``success`` is
    complete, and any other, a missing status included, is complete with warnings.
    Only complete runs carry ``final_stats``. ``elapsed_seconds`` is the time of the
    write. Logs may leave out ``finalization_seconds``, which is then that time, and
    ``records_stored``, the rows found in the table, which are then those written.
    """
    finalized = F.col("finalization_seconds" if "finalization_seconds" in runs.columns else "elapsed_seconds")
    stored = F.col("records_stored" if "records_stored" in runs.columns else "records_written")
    failed = F.col("report_error").isNotNull()
    succeeded = F.coalesce(F.col("status") == "success", F.lit(False))
    rate = rows_per_second(F.col("records_written"), F.col("elapsed_seconds"))
    average = F.coalesce(F.col("avg_temperature").cast("string"), F.lit(UNKNOWN))
    return runs.select(
        "run_id",
        F.when(failed, FAILED[0]).when(succeeded, COMPLETED[0]).otherwise(WITH_WARNINGS[0]).alias("status"),
        F.when(failed, F.concat(F.lit(FAILED[1]), F.col("report_error")))
        .when(succeeded, COMPLETED[1])
        .otherwise(WITH_WARNINGS[1])
        .alias("message"),
        F.when(
            ~failed & succeeded,
            F.struct(
                F.coalesce(finalized, F.lit(0.0)).alias("finalization_time_seconds"),
                F.col("records_requested").alias("records_processed"),
                F.col("table_size"),
                stored.alias("record_count"),
                F.coalesce(F.col("avg_temperature").cast("double"), F.lit(0.0)).alias("avg_temperature"),
            ),
        ).alias("final_stats"),
        (
            F.col("records_written").eqNullSafe(F.col("records_requested"))
            & stored.eqNullSafe(F.col("records_written"))
        ).alias("all_rows_written"),
        rate.alias("rows_per_second"),
        F.coalesce(with_thousands(F.col("records_written")), F.lit(UNKNOWN)).alias("records_text"),
        F.coalesce("table_size", F.lit(UNKNOWN)).alias("table_size_text"),
        average.alias("average_text"),
        F.concat(fixed_point(F.coalesce("elapsed_seconds", F.lit(0.0))), F.lit(" seconds")).alias("time_text"),
        F.concat(with_thousands(rate), F.lit(" records/second")).alias("rate_text"),
    )
