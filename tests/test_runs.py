"""Runs that become visible by one commit record."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import functions as F
import pytest

from skyledger.sinks import files, runs, tables

def counts(spark, path):
    return {r.run_id: r["count"] for r in runs.committed(spark, path).groupBy("run_id").count().collect()}


def test_a_run_written_again_replaces_its_rows_and_no_others(spark, tmp_path):
    path = str(tmp_path)
    first = runs.commit_run(spark.range(100), path, "one")
    runs.commit_run(spark.range(50), path, "two")
    again = runs.commit_run(spark.range(80), path, "one")
    assert (first.rows, again.rows) == (100, 80) and again.bytes > 0
    assert counts(spark, path) == {"one": 80, "two": 50}
    assert runs.newest(spark, path).number == 3
    assert {(r.run_id, r.rows) for r in runs.commits(spark, path).collect()} == {("one", 80), ("two", 50)}


@pytest.mark.parametrize("name", ["", " ", "a/b=c%", "__HIVE_DEFAULT_PARTITION__", "17", "é\n'\""])
def test_any_text_names_a_run(spark, tmp_path, name):
    path = str(tmp_path / "a b")
    runs.commit_run(spark.range(5), path, "other")
    runs.commit_run(spark.range(9), path, name)
    runs.commit_run(spark.range(3), path, name)
    assert counts(spark, path) == {"other": 5, name: 3}
    runs.commit_run(spark.range(0), path, name)
    assert counts(spark, path) == {"other": 5}
    assert runs.committed(spark, path, [name]).count() == 0


def test_a_run_needs_a_name(spark, tmp_path):
    with pytest.raises(ValueError):
        runs.commit_run(spark.range(1), str(tmp_path), None)
    with pytest.raises(ValueError):
        runs.committed(spark, str(tmp_path))
    with pytest.raises(ValueError):
        tables.write_run(spark.range(1), str(tmp_path), "")


def test_a_failing_write_changes_nothing_and_is_cleared(spark, tmp_path):
    path = str(tmp_path)
    runs.commit_run(spark.range(100), path, "one")
    with pytest.raises(Exception, match="row seven"):
        runs.commit_run(spark.range(10).selectExpr("if(id = 7, cast(raise_error('row seven') AS bigint), id) AS id"), path, "one")
    assert counts(spark, path) == {"one": 100} and runs.newest(spark, path).number == 1
    assert len(list(Path(path, "data").iterdir())) == 2
    assert runs.remove_unused(spark, path) == []  # it might still be running
    assert len(runs.remove_unused(spark, path, older_than_hours=-1)) == 1
    assert counts(spark, path) == {"one": 100}


def test_a_reader_keeps_the_state_it_has_read(spark, tmp_path):
    path = str(tmp_path)
    runs.commit_run(spark.range(10), path, "one")
    before = runs.committed(spark, path)
    state = runs.newest(spark, path)
    runs.commit_run(spark.range(3), path, "one")
    runs.commit_run(spark.range(4), path, "two")
    assert before.count() == 10 and runs.committed(spark, path, state=state).count() == 10
    assert runs.committed(spark, path).count() == 7


def test_runs_side_by_side_all_get_in(spark, tmp_path):
    path = str(tmp_path)
    with ThreadPoolExecutor(6) as pool:
        done = list(pool.map(lambda k: runs.commit_run(spark.range(k + 1), path, f"run {k % 9}"), range(12)))
    assert len(done) == 12 and runs.newest(spark, path).number == 12
    found = counts(spark, path)
    assert set(found) == {f"run {k}" for k in range(9)} and all(found[f"run {k}"] in (k + 1, k + 10) for k in range(9))


def test_a_taken_name_is_not_written_over(spark, tmp_path):
    path = f"{tmp_path}/folder/x.json"
    assert files.write_new(spark, path, "first é") and not files.write_new(spark, path, "second")
    assert files.read_text(spark, path) == "first é" and files.names(spark, f"{tmp_path}/folder") == ["x.json"]


def test_runs_share_their_columns(spark, tmp_path):
    path = str(tmp_path)
    runs.commit_run(spark.range(2).withColumn("run_id", F.lit("not this")), path, "one")
    with pytest.raises(ValueError):
        runs.commit_run(spark.range(2).withColumn("x", F.lit(1)), path, "two")
    assert runs.committed(spark, path).columns == ["id", "run_id"] and counts(spark, path) == {"one": 2}


def test_a_dropped_run(spark, tmp_path):
    path = str(tmp_path)
    runs.commit_run(spark.range(2), path, "one")
    runs.commit_run(spark.range(3), path, "two")
    assert runs.drop_run(spark, path, "one") and not runs.drop_run(spark, path, "one")
    assert counts(spark, path) == {"two": 3}
    runs.drop_run(spark, path, "two")
    assert runs.committed(spark, path).count() == 0


def test_rows_are_those_of_the_committed_files(spark, tmp_path):
    shuffled = spark.range(5_000).repartition(7, F.col("id") % 3).where("id % 5 <> 0")
    assert runs.commit_run(shuffled, str(tmp_path), "x").rows == 4_000


def test_reading_some_runs_opens_only_their_files(spark, tmp_path):
    for k in range(4):
        runs.commit_run(spark.range(10 * k, 10 * k + 10), str(tmp_path), f"{k}")
    some = runs.committed(spark, str(tmp_path), ["1", "3"])
    assert {f.split("__attempt=")[1].split("/")[0] for f in some.inputFiles()} == {
        r.attempt for r in runs.commits(spark, str(tmp_path)).collect() if r.run_id in ("1", "3")
    }
    assert some.count() == 20
