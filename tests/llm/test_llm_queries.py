"""The queries of the subpackage against their SQL, and the entry without the subpackage."""

from pathlib import Path
import subprocess
import sys

import duckdb
import pytest

from skyledger.llm.oracles import ORACLES
from skyledger.llm.queries import QUERIES
from tests.llm.helpers import SF

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    sql = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        sql.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = QUERIES[name](spark, SF)
    expected = sql.sql(ORACLES[name])
    columns = sorted(expected.columns)
    assert sorted(df.columns) == columns
    got = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    assert got == sorted(map(repr, expected.project(", ".join(columns)).fetchall()))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_entry_works_without_the_subpackage(tmp_path):
    root = Path(__file__).resolve().parents[2]
    (tmp_path / "skyledger").mkdir()
    for part in (root / "skyledger").iterdir():
        if part.name != "llm":
            (tmp_path / "skyledger" / part.name).symlink_to(part)
    (tmp_path / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.split()[1] == "False", done.stderr
