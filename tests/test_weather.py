from pyspark.sql import functions as F
import pytest

from skyledger import schemas
from skyledger.operators import coerce
from skyledger.operators.weather import weather, weather_stored
from skyledger.sources.readers import MOST_ROWS_PER_TASK, row_ids


def at():
    return F.lit("2024-06-01 12:00:00").cast("timestamp")


@pytest.mark.parametrize("rows", [0, 1, 999, 1000, 1001])
def test_row_counts_and_batches(spark, rows):
    df = weather_stored(row_ids(spark, rows), 1, at())
    counts = df.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.max("id"), F.max("batch_id")).first()
    assert counts.n == counts.ids == rows
    if rows:
        assert counts["max(id)"] == rows
        assert counts["max(batch_id)"] == min(rows, 1000) - 1


def test_generated_types(spark):
    generated = weather(row_ids(spark, 10), 1)
    kinds = {f.name: f.dataType.simpleString() for f in generated.schema}
    assert kinds == {
        "latitude": "double",
        "longitude": "double",
        "temperature": "double",
        "windspeed": "double",
        "winddirection": "int",
        "weathercode": "int",
        "is_day": "boolean",
        "event_time": "timestamp",
        "batch_id": "bigint",
    }


def test_stored_types_are_the_declared_ones(spark):
    declared = {f.name: f.dataType for f in schemas.WEATHER_TARGET if f.name != "loaded_at"}
    stored = weather_stored(row_ids(spark, 10), 1).schema
    assert {f.name: f.dataType for f in stored} == declared


def test_stored_rows_equal_the_coerced_generated_rows(spark):
    ids = row_ids(spark, 500_000)
    generated = weather(ids, 5, at(), keep_id=True).withColumn("id", F.col("id") + 1)
    coerced = coerce.strict(generated, schemas.WEATHER_TARGET)
    direct = weather_stored(ids, 5, at())
    together = coerced.join(direct.select([F.col(c).alias(f"d_{c}") for c in direct.columns]), F.col("id") == F.col("d_id"))
    same = F.lit(True)
    for name in direct.columns:
        same = same & F.col(name).eqNullSafe(F.col(f"d_{name}"))
    assert together.where(~same).count() == 0
    assert together.count() == 500_000


def test_rows_do_not_depend_on_partitioning(spark):
    def rows(partitions):
        return set(weather_stored(row_ids(spark, 3_000, partitions), 2, at()).collect())

    assert rows(2) == rows(4) == rows(8)


def test_seeds_differ(spark):
    one = weather(row_ids(spark, 100), 1, at()).select("latitude").collect()
    two = weather(row_ids(spark, 100), 2, at()).select("latitude").collect()
    assert one != two


def test_ranges_and_shares(spark):
    df = weather_stored(row_ids(spark, 1_000_000), 8)
    r = df.agg(
        *[F.min(c).alias(f"min_{c}") for c in df.columns],
        *[F.max(c).alias(f"max_{c}") for c in df.columns],
        F.avg(F.col("is_day").cast("int")).alias("day"),
        F.avg("temperature").alias("mean"),
        F.count_distinct("event_time").alias("times"),
        F.count_distinct("winddirection").alias("directions"),
    ).first()
    assert -90 <= r.min_latitude and r.max_latitude <= 90
    assert -180 <= r.min_longitude and r.max_longitude <= 180
    assert (r.min_temperature, r.max_temperature) == (-30, 50)
    assert (r.min_windspeed, r.max_windspeed) == (0, 150)
    assert (r.min_winddirection, r.max_winddirection, r.directions) == (0, 359, 360)
    assert (r.min_weathercode, r.max_weathercode) == (0, 99)
    assert (r.min_batch_id, r.max_batch_id) == (0, 999)
    assert abs(r.day - 0.5) < 0.003 and abs(float(r["mean"]) - 10) < 0.1
    assert r.times == 1


def test_ids_from_a_table_column(spark):
    events = spark.createDataFrame([(7, "2024-01-02 03:04:05")], "event_id bigint, ts string")
    row = weather_stored(events, 1, F.col("ts").cast("timestamp"), id_col="event_id").first()
    assert row.id == 8 and row.batch_id == 7 and row.event_time.minute == 4
    assert row.latitude == weather_stored(row_ids(spark, 8), 1).where("id = 8").first().latitude


def test_generation_is_one_stage_without_a_shuffle(spark):
    plan = weather_stored(row_ids(spark, 1000), 1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Project" in plan and "*(1)" in plan


def test_task_count_follows_the_load(spark):
    assert row_ids(spark, 10).rdd.getNumPartitions() == 1
    assert row_ids(spark, 1_000_000).rdd.getNumPartitions() == 4
    assert row_ids(spark, 100 * MOST_ROWS_PER_TASK + 1).rdd.getNumPartitions() == 101
    assert row_ids(spark, 10, 3).rdd.getNumPartitions() == 3
