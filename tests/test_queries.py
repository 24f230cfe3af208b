"""Each registered query against its SQL counterpart on the smallest tables."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

from skyledger.catalog import queries
from skyledger.catalog.oracles import ORACLES
from skyledger.catalog.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")

spec = importlib.util.spec_from_file_location("spark_entry", Path(__file__).parent.parent / "__spark_entry__.py")
spark_entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(spark_entry)

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def ordered(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, sql, name):
    df = spark_entry.queries()[name](spark, str(SF_DIR))
    columns = sorted(df.columns)
    expected = sql.sql(spark_entry.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert rows
    assert ordered(rows) == ordered(expected.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_every_query_has_sql_but_the_ones_sql_cannot_say():
    without = set(spark_entry.queries()) - set(spark_entry.oracle_sql())
    assert not without & set(QUERIES)
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_flagship(spark):
    row = spark_entry.entry(spark).first()
    assert row.record_count == spark.read.parquet(str(SF_DIR / "events.parquet")).count()


def test_no_query_uses_python_workers(spark):
    for name, query in QUERIES.items():
        plan = query(spark, str(SF_DIR))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_geo_box_lays_out_stored_readings(spark, monkeypatch):
    """Readings are made once, not again for each count and each write of a layout."""
    read, write = [], queries.layouts.partition_by_cell
    monkeypatch.setattr(queries.layouts, "partition_by_cell", lambda df, path: (read.extend(df.inputFiles()), write(df, path))[1])
    queries.geo_box(spark, str(SF_DIR))
    assert read and all("/readings_" in file for file in read)
