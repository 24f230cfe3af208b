from decimal import Decimal

from skyledger import schemas
from skyledger.plans.report import run_report

RUNS = [
    ("good", "success", 1_000_000, 1_000_000, 4.0, "16 MB", Decimal("9.99"), None),
    ("short", "success", 10, 9, 0.0, None, None, None),
    ("bad", "failed", 10, 0, 1.005, None, None, None),
    ("missing", None, None, None, None, None, None, None),
    ("raised", "success", 5, 5, 1.0, "1 bytes", Decimal("1.00"), "no disk"),
]


def test_reports(spark):
    rows = {r.run_id: r for r in run_report(spark.createDataFrame(RUNS, schemas.RUN_LOG)).collect()}
    assert {name: r.status for name, r in rows.items()} == {
        "good": "completed",
        "short": "completed",
        "bad": "completed_with_warnings",
        "missing": "completed_with_warnings",
        "raised": "cleanup_failed",
    }
    assert rows["raised"].message == "Cleanup failed: no disk"
    assert [name for name, r in rows.items() if r.final_stats is not None] == ["good", "short"]
    good, short, bad, missing = (rows[name] for name in ("good", "short", "bad", "missing"))
    assert good.final_stats.asDict() == {
        "finalization_time_seconds": 4.0,
        "records_processed": 1_000_000,
        "table_size": "16 MB",
        "record_count": 1_000_000,
        "avg_temperature": 9.99,
    }
    assert (good.records_text, good.time_text, good.rate_text) == ("1,000,000", "4.00 seconds", "250,000 records/second")
    assert (good.average_text, good.table_size_text, good.all_rows_written) == ("9.99", "16 MB", True)
    assert (short.rows_per_second, short.rate_text, short.all_rows_written) == (None, None, False)
    assert (short.table_size_text, short.average_text, short.final_stats.avg_temperature) == ("Unknown", "Unknown", 0.0)
    assert bad.time_text == "1.00 seconds"
    assert (missing.records_text, missing.time_text) == ("Unknown", "0.00 seconds")


def test_reporting_does_not_shuffle(spark):
    plan = run_report(spark.createDataFrame(RUNS, schemas.RUN_LOG))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_missing_rows_are_reported(spark):
    log = {"run_id": "r", "status": "success", "records_requested": 10, "records_written": 10, "elapsed_seconds": 2.0}
    for stored, whole in ((10, True), (9, False)):
        rows = spark.createDataFrame([log | {"records_stored": stored, "finalization_seconds": 0.5}], schemas.LOAD_LOG)
        report = run_report(rows).first()
        assert report.all_rows_written is whole
        assert report.final_stats.record_count == stored
        assert report.final_stats.finalization_time_seconds == 0.5
        assert report.rows_per_second == 5.0
