from datetime import datetime

from pyspark.sql import functions as F
import pytest

from skyledger import schemas
from skyledger.plans.load import finalize, lay_out, load_weather, run
from skyledger.sinks import shared, tables
from skyledger.sinks.jdbc import OLDER_WRITE_DEFAULTS, jdbc_options, write_jdbc
from skyledger.sources import readers

AT = datetime(2024, 6, 1, 12)


@pytest.fixture
def table(spark):
    database = shared.new_database(spark, "test")
    yield f"{database}.weather_data"
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_created_table_has_the_declared_columns(spark, table):
    tables.create_table(spark, table)
    listed = [(r.column_name, r.data_type, r.ordinal_position) for r in readers.catalog_columns(spark, table).collect()]
    assert listed == [
        (f.name, f.dataType.simpleString(), i) for i, f in enumerate(schemas.WEATHER_TARGET, start=1)
    ]
    assert len(listed) == 11


def test_listing_one_table_of_several(spark, table):
    tables.create_table(spark, table)
    other = table.replace("weather_data", "other")
    spark.range(1).write.saveAsTable(other)
    assert readers.catalog_columns(spark, other).collect()[0].column_name == "id"


def test_append_fills_omitted_columns_and_matches_by_name(spark, table):
    tables.create_table(spark, table)
    rows = spark.range(3).select((F.col("id") % 2).cast("int").alias("batch_id"), F.col("id"))
    tables.append(rows, table)
    tables.append(rows.select("id"), table)
    stored = spark.table(table)
    assert stored.count() == 6
    assert stored.where("loaded_at IS NULL").count() == 0
    assert {(r.id, r.batch_id) for r in stored.where("batch_id IS NOT NULL").collect()} == {(0, 0), (1, 1), (2, 0)}
    assert stored.where("temperature IS NOT NULL").count() == 0


def test_creating_again_starts_empty(spark, table):
    tables.create_table(spark, table)
    tables.append(spark.range(3), table)
    tables.create_table(spark, table)
    assert spark.table(table).count() == 0
    tables.drop_table(spark, table)
    tables.drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


def test_load_can_be_run_again(spark, table):
    first = load_weather(spark, 2_500, table, seed=3, load_time=AT)
    rows = spark.table(table).drop("loaded_at").collect()
    second = load_weather(spark, 2_500, table, seed=3, load_time=AT, partitions=7)
    again = spark.table(table).drop("loaded_at").collect()
    assert sorted(rows) == sorted(again) and len(rows) == 2_500
    for run in (first, second):
        assert run["status"] == "success"
        assert run["records_requested"] == run["records_written"] == 2_500
    assert spark.table(table).select("id").distinct().count() == 2_500


def test_load_of_nothing(spark, table):
    assert load_weather(spark, 0, table)["records_written"] == 0
    row = finalize(spark, table, 0).first()
    assert (row.record_count, row.avg_temperature) == (0, 0.0)


def test_finalize_reports_what_is_stored(spark, table):
    load_weather(spark, 10_000, table, seed=3)
    row = finalize(spark, table, 10_000).first()
    assert row.record_count == row.records_processed == 10_000
    assert abs(row.avg_temperature - 10) < 1
    assert row.finalization_time_seconds > 0
    assert row.table_size.endswith(" kB")
    statistics = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").first().data_type
    assert "10000 rows" in statistics


def test_writing_a_run_again_replaces_it_and_leaves_others(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.write_run(spark.range(100), path, "one")
    tables.write_run(spark.range(50), path, "two")
    tables.write_run(spark.range(80), path, "one")
    counts = {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert counts == {"one": 80, "two": 50}


def test_rows_are_counted_while_writing(spark, tmp_path):
    path = str(tmp_path / "t")
    seen = tables.counting_rows(spark.range(1_234).where("id % 2 = 0"), lambda df: df.write.parquet(path))
    assert seen == spark.read.parquet(path).count() == 617


def test_publishing_replaces_the_named_table(spark, table):
    tables.publish(spark.range(3), table)
    tables.publish(spark.range(5), table)
    assert spark.table(table).count() == 5


@pytest.mark.parametrize("name", ["t; DROP TABLE x", "a.b.c", "T"])
def test_unsafe_table_names_are_refused(spark, name):
    with pytest.raises(ValueError):
        tables.create_table(spark, name)


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, name, default=None):
            assert name == "spark.checkpoint.dir"
            return self.value

    class Session:
        def __init__(self, master, folder):
            self.conf = Conf(folder)
            self.sparkContext = type("Context", (), {"master": master})

    assert shared.shared_folder(Session("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    assert shared.shared_folder(Session("local[2]", None)) == shared.shared_folder(Session("local[2]", None))
    with pytest.raises(ValueError):
        shared.shared_folder(Session("yarn", None))


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "me", "pw", "a.Driver")
    assert options["batchsize"] == "50000" and options["numPartitions"] == "20"
    older = jdbc_options("jdbc:x", "me", "pw", "a.Driver", **OLDER_WRITE_DEFAULTS)
    assert older["batchsize"] == "10000" and older["numPartitions"] == "10"


def test_jdbc_write_goes_to_the_named_driver(spark):
    # No database is at hand: this shows that the options reach Spark's JDBC writer.
    options = jdbc_options("jdbc:none:x", "me", "pw", "no.such.Driver")
    with pytest.raises(Exception, match="no.such.Driver"):
        write_jdbc(spark.range(1), options, "t")
    with pytest.raises(Exception, match="no.such.Driver"):
        readers.jdbc_rows(spark, options, "t")


def test_a_partitioned_jdbc_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        readers.jdbc_rows(spark, {}, "t", partitions=4)


def test_csv_under_a_declared_schema(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text('id,name,age,city,salary\n1,Ann Lee,30,"Salt Lake City, UT",5000\n2,Bo,,Rome,\n')
    rows = [tuple(r) for r in readers.csv_rows(spark, str(path)).collect()]
    assert rows == [(1, "Ann Lee", 30, "Salt Lake City, UT", 5000), (2, "Bo", None, "Rome", None)]


def test_a_csv_line_off_the_schema_fails_the_read(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("id,name,age,city,salary\nx,Ann,30,Rome,1\n")
    with pytest.raises(Exception):
        readers.csv_rows(spark, str(path)).collect()


def test_csv_headers_must_be_the_declared_ones(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("id,city,age,name,salary\n1,Rome,30,Ann,1\n")
    with pytest.raises(Exception):
        readers.csv_rows(spark, str(path)).collect()


def test_analyzing_some_columns(spark, table):
    tables.publish(spark.range(9).withColumn("x", F.lit(1)), table)
    tables.analyze(spark, table, ["id"])
    described = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} id").collect()}
    assert described["distinct_count"] == "9"
    assert {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} x").collect()}["distinct_count"] == "NULL"


def test_whole_job(spark, table):
    report = run(spark, 3_000, table, seed=2).first()
    assert (report.status, report.all_rows_written, report.records_text) == ("completed", True, "3,000")
    assert report.final_stats.record_count == spark.table(table).count() == 3_000
    assert (report.data_size, report.recommended_size, report.estimated_time_seconds) == ("medium", "small", 0.04)


def test_a_failed_job_is_reported(spark):
    report = run(spark, 150_000, "no_such_database_here.weather_data", "small").first()
    assert report.estimated_time_formatted == "0:00:10"
    assert (report.status, report.final_stats, report.records_text) == ("completed_with_warnings", None, "Unknown")


def test_all_layouts_of_a_table(spark, table, tmp_path):
    load_weather(spark, 5_000, table, seed=2)
    lay_out(spark, table, str(tmp_path / "layouts"))
    made = lay_out(spark, table, str(tmp_path / "layouts"))
    for layout in (made.by_batch, made.by_day, made.by_cell):
        assert layout.select("id").distinct().count() == layout.count() == 5_000
    assert spark.table(f"{table}_by_batch").where("batch_id = 3").count() == 5


def test_a_counted_write_that_fails_raises(spark, tmp_path):
    path = str(tmp_path / "t")
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("row seven"))).otherwise("x").alias("x"))
    with pytest.raises(Exception, match="row seven"):
        tables.counting_rows(bad, lambda df: df.write.parquet(path))
    assert not (tmp_path / "t" / "_SUCCESS").exists()


def test_a_failed_rerun_keeps_the_runs_earlier_rows(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.write_run(spark.range(100), path, "one")
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("row seven")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="row seven"):
        tables.write_run(bad, path, "one")
    assert spark.read.parquet(path).count() == 100


def test_an_empty_rerun_clears_its_run_and_no_other(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.write_run(spark.range(100), path, "a/b")
    tables.write_run(spark.range(5), path, "c")
    tables.write_run(spark.range(0), path, "a/b")
    assert [r.run_id for r in spark.read.parquet(path).select("run_id").distinct().collect()] == ["c"]
    assert spark.read.parquet(path).count() == 5


def test_the_whole_job_makes_its_access_paths(spark, table, tmp_path):
    report = run(spark, 3_000, table, seed=2, layouts_folder=str(tmp_path / "paths")).first()
    assert (report.status, report.final_stats.record_count) == ("completed", 3_000)
    assert spark.table(f"{table}_by_batch").where("batch_id = 3").count() == 3
    assert {p.name for p in (tmp_path / "paths").iterdir()} == {"by_batch", "by_day", "by_cell"}
    assert spark.read.parquet(str(tmp_path / "paths" / "by_cell")).count() == 3_000


def test_counts_of_buckets_and_ranges_can_be_given(spark, table, tmp_path):
    load_weather(spark, 3_000, table, seed=2)
    finalize(spark, table, 3_000, layouts_folder=str(tmp_path), lookups=("batch", "cell"), buckets=3, ranges=2)
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}_by_batch").collect()}
    assert described["Num Buckets"] == "3"
    assert len({f.split("part-")[1][:5] for f in spark.read.parquet(str(tmp_path / "by_cell")).inputFiles()}) <= 3
