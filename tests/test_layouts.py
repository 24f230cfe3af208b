from datetime import datetime, timedelta, timezone
from decimal import Decimal
import glob

from pyspark.sql import functions as F
import pytest

from skyledger.operators import lookups
from skyledger.operators.weather import weather_stored
from skyledger.sinks import layouts, shared


def files_read(df):
    return df.select(F.col("_metadata.file_path")).distinct().count()


def scan_tasks(df):
    return df.rdd.getNumPartitions()


@pytest.fixture(scope="module")
def readings(spark):
    """Forty days of readings, a third of them on one day, in one batch, at one place."""
    hot = F.col("id") % 3 == 0
    base = weather_stored(
        spark.range(0, 60_000, 1, 8),
        4,
        F.when(hot, F.lit("2024-02-05 00:00:00").cast("timestamp")).otherwise(
            F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 40 * 86400 + F.col("id") % 86_000)
        ),
    )
    hot = F.col("id") % 3 == 1  # stored ids are one higher
    return base.select(
        "id",
        F.when(hot, F.lit(Decimal("51.5"))).otherwise(F.col("latitude")).cast("decimal(8,6)").alias("latitude"),
        F.when(hot, F.lit(Decimal("-0.1"))).otherwise(F.col("longitude")).cast("decimal(9,6)").alias("longitude"),
        "temperature",
        "event_time",
        F.when(hot, 7).otherwise(F.col("batch_id")).cast("int").alias("batch_id"),
    )


def same(a, b, *columns):
    return sorted(map(tuple, a.select(*columns).collect())) == sorted(map(tuple, b.select(*columns).collect()))


@pytest.fixture
def bucketed(spark, readings):
    path = shared.new_path(spark, "bucket_test")
    name = path.rsplit("/", 1)[1]
    yield layouts.bucket_by_batch(readings, name, path, 16)
    spark.sql(f"DROP TABLE {name}")


def test_batch_lookup_reads_one_bucket(readings, bucketed):
    found = lookups.by_batch(bucketed, 8)
    assert same(found, lookups.by_batch(readings, 8), "id", "temperature")
    assert "SelectedBucketsCount: 1 out of 16" in found._jdf.queryExecution().executedPlan().toString() or (
        files_read(found) < files_read(bucketed)
    )
    assert bucketed.count() == readings.count()


def test_day_layout(spark, readings, tmp_path):
    path = str(tmp_path / "days")
    stored = layouts.partition_by_day(readings, path)
    start, end = datetime(2024, 2, 3, 10), datetime(2024, 2, 5, 0, 0, 1)
    found = lookups.by_time(stored, start, end)
    assert same(found, lookups.by_time(readings, start, end), "id", "event_time")
    assert found.count() > 20_000
    assert {r.event_date.day for r in found.select("event_date").distinct().collect()} == {3, 4, 5}
    assert files_read(found) < files_read(stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "GreaterThanOrEqual(event_time" in plan


def test_time_range_is_half_open(spark, readings, tmp_path):
    stored = layouts.partition_by_day(readings, str(tmp_path / "days"))
    at = datetime(2024, 2, 5)
    assert lookups.by_time(stored, at, at).count() == 0
    assert lookups.by_time(stored, datetime(2024, 2, 4, 23, 59), at).where(F.col("event_time") == F.lit(at)).count() == 0


def test_day_pruning_holds_in_another_session_zone(spark, readings, tmp_path, with_conf):
    path = str(tmp_path / "days")
    layouts.partition_by_day(readings, path)
    with_conf(spark__sql__session__timeZone="Asia/Tokyo")
    stored = spark.read.parquet(path)
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-02-03 03:00:00", "2024-02-03 21:00:00"))
    everything = readings.where((F.col("event_time") >= start) & (F.col("event_time") < end))
    found = lookups.by_time(stored, "2024-02-03 03:00:00", "2024-02-03 21:00:00")
    assert same(found, everything, "id")
    assert found.count() > 0


@pytest.mark.parametrize("degrees", [30, 10])
def test_cell_layout(spark, readings, tmp_path, degrees):
    stored = layouts.partition_by_cell(readings, str(tmp_path / "cells"), degrees)
    box = (40.0, 59.5, -20.25, 29.0)
    found = lookups.by_box(stored, *box)
    assert same(found, lookups.by_box(readings, *box), "id", "latitude")
    assert found.count() > 20_000
    assert files_read(found) < files_read(stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [cell_{degrees}" in plan.replace("isnotnull(cell", "cell")
    assert "GreaterThanOrEqual(latitude" in plan


@pytest.mark.parametrize(
    "write, label", [(layouts.partition_by_day, "event_date=2024-02-05"), (layouts.partition_by_cell, "cell_30=53")]
)
def test_a_hot_key_is_spread_over_several_tasks(spark, readings, tmp_path, with_conf, write, label):
    with_conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    path = tmp_path / "t"
    stored = write(readings, str(path))
    assert len(glob.glob(str(path / label / "*.parquet"))) > 2
    assert stored.count() == readings.count()


def test_a_hot_batch_is_spread_over_several_tasks(spark, readings, tmp_path, with_conf):
    with_conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    name = shared.new_path(spark, "hot").rsplit("/", 1)[1]
    stored = layouts.bucket_by_batch(readings, name, str(tmp_path / "t"), 4)
    assert files_read(lookups.by_batch(stored, 7)) > 2
    assert lookups.by_batch(stored, 7).count() == lookups.by_batch(readings, 7).count()
    assert stored.count() == readings.count()
    spark.sql(f"DROP TABLE {name}")


def test_writing_a_layout_again_replaces_it(spark, readings, tmp_path):
    path = str(tmp_path / "t")
    layouts.partition_by_cell(readings, path)
    assert layouts.partition_by_cell(readings.where("id <= 100"), path).count() == 100


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_plain_times_are_compared_as_written(spark, tmp_path, with_conf, zone):
    with_conf(spark__sql__session__timeZone=zone)
    hours = spark.range(96).select("id", F.expr("timestamp_ntz'2024-03-09 00:00:00' + make_dt_interval(0, id)").alias("ts"))
    stored = layouts.partition_by_day(hours, str(tmp_path / "t"), "ts")
    found = lookups.by_time(stored, datetime(2024, 3, 10), datetime(2024, 3, 11, 2), "ts")
    assert sorted(r.id for r in found.collect()) == list(range(24, 50))
    with pytest.raises(ValueError):
        lookups.by_time(stored, datetime(2024, 3, 10, tzinfo=timezone.utc), datetime(2024, 3, 11), "ts")


def test_moments_with_a_zone(spark, readings, with_conf):
    with_conf(spark__sql__session__timeZone="Asia/Tokyo")
    hot = datetime(2024, 2, 5, tzinfo=timezone.utc)
    assert lookups.by_time(readings, hot, hot + timedelta(microseconds=1)).count() >= 20_000


def test_cells(spark):
    points = [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0), (-0.000001, -0.000001), (89.999999, 179.999999), (30.0, 60.0)]
    df = spark.createDataFrame(points, "latitude double, longitude double").select(
        F.col("latitude").cast("decimal(8,6)"), F.col("longitude").cast("decimal(9,6)")
    )
    cells = [r.c for r in df.select(lookups.cell_of(F.col("latitude"), F.col("longitude")).alias("c")).collect()]
    assert cells == [0, 71, 42, 29, 71, 56]


@pytest.mark.parametrize("degrees", [30, 10, 45])
@pytest.mark.parametrize(
    "box", [(-90, 90, -180, 180), (90, 90, 180, 180), (-15.5, 44.25, -100, 60.75), (30, 30, 60, 60), (29.999999, 30, -30, 0)]
)
def test_every_point_of_a_box_lies_in_its_cells(spark, readings, box, degrees):
    cells = lookups.cells_in_box(*box, degrees)
    corners = spark.createDataFrame(
        [(float(la), float(lo)) for la in box[:2] for lo in box[2:]], "latitude double, longitude double"
    )
    points = lookups.by_box(readings.select("latitude", "longitude"), *box).unionByName(
        corners.select(F.col("latitude").cast("decimal(8,6)"), F.col("longitude").cast("decimal(9,6)"))
    )
    outside = points.where(~lookups.cell_of(F.col("latitude"), F.col("longitude"), degrees).isin(cells))
    assert outside.count() == 0


@pytest.mark.parametrize("degrees", [7, 0, 100])
def test_cells_must_divide_the_globe(degrees):
    with pytest.raises(ValueError):
        lookups.cells_in_box(0, 1, 0, 1, degrees)


def test_a_small_box_in_a_hot_cell_opens_few_files(spark, tmp_path):
    """All points in one cell: a box of a hundredth of it meets few of its files."""
    points = spark.range(40_000).selectExpr(
        "id",
        "CAST(30 + 30 * pmod(xxhash64(id, 1), 10000) / 10000 AS DECIMAL(8,6)) AS latitude",
        "CAST(30 * pmod(xxhash64(id, 2), 10000) / 10000 AS DECIMAL(9,6)) AS longitude",
    )
    stored = layouts.partition_by_cell(points, str(tmp_path / "cells"), ranges=16)
    box = lookups.by_box(stored, south=40, north=43, west=10, east=13)
    opened = box.select("_metadata.file_path").distinct().count()
    assert opened <= 4
    reach = stored.groupBy("_metadata.file_path").agg((F.max("latitude") - F.min("latitude")).alias("d"))
    assert reach.where("d < 16").count() >= 12


@pytest.mark.parametrize("write", [layouts.partition_by_day, layouts.partition_by_cell])
def test_layouts_replace_in_a_dynamic_session(spark, readings, tmp_path, with_conf, write):
    with_conf(spark__sql__sources__partitionOverwriteMode="dynamic")
    write(readings, str(tmp_path / "t"))
    few = readings.where("id < 10")
    assert write(few, str(tmp_path / "t")).count() == few.count()


def test_the_curve_interleaves_the_bits_of_both_coordinates(spark):
    points = spark.range(200).selectExpr(
        "CAST(180 * pmod(xxhash64(id, 1), 10001) / 10000 - 90 AS DECIMAL(8,6)) AS la", "CAST(360 * pmod(xxhash64(id, 2), 10001) / 10000 - 180 AS DECIMAL(9,6)) AS lo"
    )
    for r in points.withColumn("c", lookups.curve_of(F.col("la"), F.col("lo"))).collect():
        x, y = int((float(r.lo) + 180) / 360 * 65535), int((float(r.la) + 90) / 180 * 65535)
        assert r.c == sum((x >> b & 1) << 2 * b | (y >> b & 1) << 2 * b + 1 for b in range(16))


def counted_places(spark, curves, ranges):
    rows = spark.createDataFrame([(0, c) for c in curves], "__cell int, __curve long")
    return layouts.places(rows, ranges)


def test_places_are_cut_finer_where_they_are_crowded(spark):
    curves = [k * 2_000_003 % (1 << 32) for k in range(1000)] + [5_000_000 + k for k in range(1000)] + [77] * 1000
    found = counted_places(spark, curves, 10)
    assert sum(p.rows for p in found) == 3000
    assert [(p.cell, p.start) for p in found] == sorted((p.cell, p.start) for p in found)
    assert {p.depth for p in found} == {12, 22, 32}
    whole = [p for p in found if p.rows > 300]
    assert [(p.start, p.rows, p.parts) for p in whole] == [(77, 1000, 4)]
    held = {}
    for p in found:
        for k in range(p.first, p.first + p.parts):
            held[k] = held.get(k, 0) + p.rows / p.parts
    assert max(held.values()) <= 300 and len(held) <= 2 * 10 + 4 and set(held) == set(range(len(held)))


def test_the_place_layout_reads_its_rows_once(spark, readings, tmp_path):
    """One exchange of whole rows: places are counted from two columns, nothing is sampled."""
    stored = layouts.partition_by_cell(readings, str(tmp_path / "cells"), ranges=6)
    assert stored.count() == readings.count()
    sizes = [r["count"] for r in stored.groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) <= 2 * 60_000 / 6


def test_rows_without_a_place_are_kept(spark, tmp_path):
    points = spark.sql("SELECT id, IF(id % 2 = 0, CAST(1 AS DECIMAL(8,6)), NULL) AS latitude, CAST(2 AS DECIMAL(9,6)) AS longitude FROM range(10)")
    stored = layouts.partition_by_cell(points, str(tmp_path / "a"))
    assert stored.count() == 10 and lookups.by_box(stored, 0, 3, 0, 3).count() == 5
    assert layouts.partition_by_cell(points.where("id < 0").unionAll(points.where("id = 1")), str(tmp_path / "b")).count() == 1


def test_sizes_decide_counts(spark, readings, tmp_path):
    assert [layouts.buckets_for(n) for n in (0, 64 << 30, (64 << 30) + 1, 1 << 50)] == [16, 16, 17, 1000]
    unknown = spark.createDataFrame(readings.limit(5).collect(), readings.schema)
    assert layouts.stored_bytes(unknown) is None and layouts.ranges_for(unknown) == 8
    assert layouts.ranges_for(spark.range(1 << 30)) == 32
    readings.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    assert layouts.stored_bytes(stored) == size and layouts.ranges_for(stored) == spark.sparkContext.defaultParallelism


def test_a_range_is_sorted_by_as_many_tasks_as_its_rows_ask_for(spark):
    rows = spark.range(3_000).selectExpr("CAST(id % 5 AS int) AS __cell", "pmod(xxhash64(id), 4294967296) AS __curve")
    tasks = {}
    for most in (100, 200, 1_000):
        found = layouts.places(rows, 3, most=most)
        held = {}
        for p in found:
            for k in range(p.first, p.first + p.parts):
                held[k] = held.get(k, 0) + p.rows / p.parts
        assert sum(p.rows for p in found) == 3_000 and max(held.values()) <= most
        tasks[most] = len(held)
    assert tasks[100] > tasks[200] > tasks[1_000] >= 3


def test_points_off_the_curve_have_no_place(spark, tmp_path):
    off = spark.createDataFrame([(1, 10.0, 10.0), (2, 10.0, 500.0), (3, -200.0, 0.0), (4, None, 5.0)], "id long, latitude double, longitude double")
    on = {r.id: r.c for r in off.withColumn("c", lookups.curve_of(F.col("latitude"), F.col("longitude"))).collect()}
    assert on[1] is not None and on[2] is on[3] is on[4] is None
    assert layouts.partition_by_cell(off, str(tmp_path / "t")).count() == 4
