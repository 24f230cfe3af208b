"""Statistics that merge, and tables finalized as they grow."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F
import pytest

from skyledger.operators import partials
from skyledger.operators.summary import profile, summary
from skyledger.plans import growth
from skyledger.sinks import runs

SHAPE = (
    "a int, b string, c decimal(9,3), d double, e date, f timestamp_ntz, g boolean, h binary, `i j` smallint, k array<int>"
)


def odd_rows():
    rows = [(k, f"s{k % 97}", Decimal(k) / 8, k / 3, date(2024, 1, 1 + k % 28), datetime(2024, 1, 1, k % 24), k % 2 == 0, bytes([k % 5]), k % 300, [k % 7]) for k in range(2_000)]
    rows += [(None,) * 10] * 5 + [(0, "", Decimal(0), 0.0, None, None, None, b"", None, []), (0, "", Decimal(0), -0.0, None, None, None, b"", None, [])]
    return rows


def test_merged_statistics_equal_those_of_the_whole(spark):
    df = spark.createDataFrame(odd_rows(), SHAPE).withColumn("part", F.coalesce(F.col("a") % 4, F.lit(9)))
    whole = df.drop("part")
    merged = partials.merged_statistics(partials.partial_statistics(df, whole.schema, "part"), whole.schema)
    got = {r.column_name: r for r in partials.profile_of(merged, whole.schema).collect()}
    for r in profile(whole.drop("k"), exact=True).collect():
        m = got[r.column_name]
        assert (m.data_type, m.ordinal_position, m.rows, m.nulls) == (r.data_type, r.ordinal_position, r.rows, r.nulls)
        assert (m.least, m.greatest) == (r.least, r.greatest)
        assert abs(m.distinct_values - r.distinct_values) <= partials.DISTINCT_ERROR * r.distinct_values
    assert got["k"].rows == 2_007 and got["k"].median is None and got["b"].median is None
    assert abs(got["a"].median - 1_000) <= 2_000 * partials.RANK_ERROR
    told = partials.summary_of(merged, whole.schema, "f", "c").first()
    assert tuple(told) == tuple(summary(whole, "f", "c").select(told.__fields__).first())


def test_no_rows_and_no_parts(spark):
    df = spark.createDataFrame([], SHAPE + ", part int")
    schema = df.drop("part").schema
    for rows in (df, spark.createDataFrame([(None,) * 10 + (1,)], SHAPE + ", part int")):
        merged = partials.merged_statistics(partials.partial_statistics(rows, schema, "part"), schema)
        got = partials.profile_of(merged, schema).collect()
        assert {(r.rows, r.nulls, r.distinct_values, r.least, r.median) for r in got} == {(rows.count(), rows.count(), 0, None, None)}
        assert partials.summary_of(merged, schema, "f", "c").first().avg_temperature == 0


def rows(spark, low, high):
    return spark.range(low, high).selectExpr("id", "timestamp_ntz'2024-01-01' + make_dt_interval(id) AS event_time", "CAST(id % 70 AS DECIMAL(3,1)) AS temperature")


def test_only_new_runs_are_read(spark, tmp_path):
    path = str(tmp_path)
    runs.commit_run(rows(spark, 0, 100), path, "one")
    runs.commit_run(rows(spark, 100, 130), path, "two")
    runs.commit_run(rows(spark, 0, 0), path, "nothing")
    first = growth.finalize(spark, path)
    assert first.rows_read == 130
    told = first.summary().first()
    assert told.record_count == 130 and told.size_bytes == sum(r.bytes for r in first.state.runs) and told.rows_read == 130
    plain = summary(runs.committed(spark, path)).first()
    assert all(told[name] == plain[name] for name in plain.__fields__)
    assert growth.finalize(spark, path).rows_read == 0
    runs.commit_run(rows(spark, 200, 240), path, "one")
    again = growth.finalize(spark, path)
    assert again.rows_read == 40 and again.summary().first().record_count == 70
    assert again.summary().first().earliest_event == datetime(2024, 4, 10)
    assert len(growth.remove_unused(spark, path, older_than_hours=-1)) == 1
    assert growth.finalize(spark, path).summary().first().record_count == 70


def test_a_table_without_runs(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(ValueError):
        growth.finalize(spark, path)
    runs.commit_run(rows(spark, 0, 10), path, "one")
    runs.drop_run(spark, path, "one")
    assert growth.finalize(spark, path).summary().first().record_count == 0


def test_columns_that_stand_for_folders_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        runs.commit_run(spark.range(1).withColumn("attempt", F.lit(1)), str(tmp_path), "one")
