from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from skyledger import schemas
from skyledger.functions.text import duration_text, fixed_point, identifier, table_identifier, with_thousands
from skyledger.plans.planning import load_plan, older_load_plan, recommended_size

# num_records, data_size, rate, seconds, hours, formatted, partitions, older rule
GOLDEN = [
    (0, "small", 15000, 0.0, 0.0, "0:00:00", 20, 20),
    (10000, "small", 15000, 0.6667, 0.000185, "0:00:00", 20, 20),
    (999999, "medium", 75000, 13.3333, 0.003704, "0:00:13", 50, 50),
    (1000000, "medium", 75000, 13.3333, 0.003704, "0:00:13", 100, 50),
    (9999999, "medium", 75000, 133.3333, 0.037037, "0:02:13", 100, 199),
    (10000000, "medium", 75000, 133.3333, 0.037037, "0:02:13", 200, 100),
    (99999999, "medium", 75000, 1333.3333, 0.370370, "0:22:13", 200, 999),
    (100000000, "large", 300000, 333.3333, 0.092593, "0:05:33", 800, 1000),
    (1000000000, "xlarge", 800000, 1250.0, 0.347222, "0:20:50", 2000, 10000),
    (1000000000, "small", 15000, 66666.6667, 18.518519, "18:31:06", 160, 10000),
    (1000000, "huge", 75000, 13.3333, 0.003704, "0:00:13", 100, 50),
]


@pytest.fixture(scope="module")
def golden(spark):
    rows = [(i, n, "t", size) for i, (n, size, *_) in enumerate(GOLDEN)]
    return spark.createDataFrame(rows, "i int, num_records bigint, table_name string, data_size string")


def test_golden_plans(golden):
    plans = {r.i: r for r in load_plan(golden).collect()}
    assert len(plans) == len(GOLDEN)
    for i, (rows, size, rate, seconds, hours, text, partitions, _) in enumerate(GOLDEN):
        plan = plans[i]
        assert (plan.num_records, plan.data_size, plan.estimated_rate_per_sec) == (rows, size, rate)
        assert plan.estimated_time_seconds == rows / rate
        assert round(plan.estimated_time_seconds, 4) == seconds
        assert round(plan.estimated_time_hours, 6) == hours
        assert plan.estimated_time_formatted == text
        assert plan.planned_partitions == partitions
        assert plan.jdbc_writers == 20


def test_golden_older_plans(golden):
    plans = {r.i: (r.planned_partitions, r.jdbc_writers) for r in older_load_plan(golden).collect()}
    assert plans == {i: (row[-1], 10) for i, row in enumerate(GOLDEN)}


def test_defaults_fill_what_a_request_leaves_out(spark):
    requests = spark.createDataFrame([(None, None, None), (5, "t", "small")], schemas.LOAD_REQUEST)
    rows = [(r.num_records, r.table_name, r.data_size, r.parallelism) for r in load_plan(requests).collect()]
    assert rows == [(1_000_000, "weather_data", "medium", 50), (5, "t", "small", 20)]
    only_rows = load_plan(spark.createDataFrame([(7,)], "num_records bigint")).first()
    assert (only_rows.num_records, only_rows.table_name, only_rows.data_size) == (7, "weather_data", "medium")


def test_unknown_tier_plans_as_the_default_one(spark):
    requests = spark.createDataFrame([(1, "t", "huge"), (1, "t", "medium")], schemas.LOAD_REQUEST)
    huge, medium = [r.asDict() for r in load_plan(requests).orderBy("data_size").collect()]
    assert huge.pop("data_size") == "huge" and medium.pop("data_size") == "medium"
    assert huge == medium


def test_recommended_size_bounds(spark):
    edges = [0, 999_999, 1_000_000, 99_999_999, 100_000_000, 999_999_999, 1_000_000_000]
    df = spark.createDataFrame([(n,) for n in edges], "n bigint")
    sizes = [r.s for r in df.select(recommended_size(F.col("n")).alias("s")).collect()]
    assert sizes == ["small", "small", "medium", "medium", "large", "large", "xlarge"]


def test_planning_does_not_shuffle(golden):
    plan = load_plan(golden)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(0, 1e9), min_size=300, max_size=300))
def test_duration_text(spark, seconds):
    df = spark.createDataFrame([(s,) for s in seconds], "s double")
    for row in df.select("s", duration_text(F.col("s")).alias("t")).collect():
        s = row.s
        assert row.t == f"{int(s // 3600)}:{int((s % 3600) // 60):02d}:{int(s % 60):02d}"


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(-1e12, 1e12), min_size=300, max_size=300))
def test_number_texts(spark, numbers):
    numbers += [0.125, 1.005, 2.5, 3.5, -0.5, 1234567.891]
    df = spark.createDataFrame([(n,) for n in numbers], "n double")
    for row in df.select("n", fixed_point(F.col("n")).alias("f"), with_thousands(F.col("n")).alias("t")).collect():
        assert row.f == f"{row.n:.2f}"
        assert row.t == f"{row.n:,.0f}"


@pytest.mark.parametrize("name", ["", "1a", "a-b", "a b", "A", "a;drop table b", "a.b"])
def test_unsafe_identifiers_are_refused(name):
    with pytest.raises(ValueError):
        identifier(name)


def test_table_identifiers():
    assert table_identifier("db.weather_data") == "db.weather_data"
    assert identifier("_x9") == "_x9"
    for name in ("a.b.c", "a.", "a.b c"):
        with pytest.raises(ValueError):
            table_identifier(name)
