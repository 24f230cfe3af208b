"""A table that grows by runs, each of which becomes visible in one step.

A run is written into a folder of its own that no reader looks at. Then one commit
record is put beside the earlier ones: it lists, for every run, the folder that
holds its rows. Readers follow the newest record, so they see a run whole or not at
all, and a run that is written again takes the place of its earlier rows in the same
step, also when it has become empty. A write that fails leaves no record. What no
record needs is removed by ``remove_unused``.

    <path>/data/__attempt=<name>/part-*.parquet
    <path>/commits/<number>.json
"""

from dataclasses import asdict, dataclass, replace
import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger.sinks import files

RUN_COLUMN = "run_id"
_ATTEMPT = "__attempt"
_DIGITS = 12
#: Times a commit is tried again when others commit at the same time.
_TRIES = 100


@dataclass(frozen=True)
class Run:
    """A committed run: its rows and bytes are those of the committed files."""

    run_id: str
    attempt: str
    rows: int
    bytes: int


@dataclass(frozen=True)
class Commit:
    """The state that one record describes."""

    number: int
    schema: T.StructType
    runs: tuple[Run, ...]

    def of(self, run_id: str) -> Run | None:
        return next((run for run in self.runs if run.run_id == run_id), None)


def folder(path: str, attempt: str) -> str:
    """Where the rows of an attempt lie."""
    return f"{path}/data/{_ATTEMPT}={attempt}"


def _record(path: str, number: int) -> str:
    return f"{path}/commits/{number:0{_DIGITS}d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = files.names(spark, f"{path}/commits")
    return [int(name[:_DIGITS]) for name in found if len(name) == _DIGITS + 5 and name.endswith(".json")]


def newest(spark: SparkSession, path: str) -> Commit | None:
    """The state readers see now; None before the first commit."""
    numbers = _numbers(spark, path)
    if not numbers:
        return None
    told = json.loads(files.read_text(spark, _record(path, numbers[-1])))
    return Commit(numbers[-1], T.StructType.fromJson(told["schema"]), tuple(Run(**run) for run in told["runs"]))


def _put(spark: SparkSession, path: str, commit: Commit) -> bool:
    told = {"schema": commit.schema.jsonValue(), "runs": [asdict(run) for run in commit.runs]}
    return files.write_new(spark, _record(path, commit.number), json.dumps(told))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(field.name, field.dataType) for field in schema])


def commit_run(df: DataFrame, path: str, run_id: str) -> Run:
    """Write one run's rows and make them visible in place of any earlier rows of that run.

    The rows are counted in the footers of the files written, so the count holds
    whatever tasks and stages were run again. Any text names a run, the empty one too.
    All runs have the same columns. Runs may be written side by side; of two writes of
    one run the later commit stays. No shuffle: each task writes its files.
    """
    if not isinstance(run_id, str):
        raise ValueError("a run needs a name")
    spark = df.sparkSession
    rows = df.drop(RUN_COLUMN)
    if {"attempt", _ATTEMPT} & set(rows.columns):
        raise ValueError(f"columns named attempt or {_ATTEMPT} stand for the folders of runs")
    schema = _nullable(rows.schema)
    before = newest(spark, path)
    if before is not None and before.schema != schema:
        raise ValueError(f"the table at {path} has the columns {before.schema.simpleString()}, not {schema.simpleString()}")
    attempt = f"run-{uuid.uuid4().hex}"
    staged = folder(path, attempt)
    rows.write.parquet(staged)
    run = Run(run_id, attempt, spark.read.schema(schema).parquet(staged).count(), files.size(spark, staged))
    for _ in range(_TRIES):
        others = () if before is None else tuple(r for r in before.runs if r.run_id != run_id)
        number = 1 if before is None else before.number + 1
        if _put(spark, path, Commit(number, schema, (*others, run))):
            return run
        before = newest(spark, path)  # another run was committed meanwhile
        if before.schema != schema:
            raise ValueError(f"the table at {path} was given other columns by another run")
    raise RuntimeError(f"no commit at {path} in {_TRIES} tries")


def drop_run(spark: SparkSession, path: str, run_id: str) -> bool:
    """Take a run out of the table in one step; False if it is not in it."""
    for _ in range(_TRIES):
        before = newest(spark, path)
        if before is None or before.of(run_id) is None:
            return False
        left = tuple(run for run in before.runs if run.run_id != run_id)
        if _put(spark, path, replace(before, number=before.number + 1, runs=left)):
            return True
    raise RuntimeError(f"no commit at {path} in {_TRIES} tries")


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The newest state as rows (run_id, attempt, rows, bytes)."""
    state = newest(spark, path)
    held = [] if state is None else [(r.run_id, r.attempt, r.rows, r.bytes) for r in state.runs]
    return spark.createDataFrame(held, "run_id string, attempt string, rows long, bytes long")


def attempts(spark: SparkSession, path: str, state: Commit, some: list[Run]) -> DataFrame:
    """The rows of some of a state's runs, with the ``attempt`` that wrote them. Only their folders are listed."""
    if not some:
        return spark.createDataFrame([], T.StructType([*state.schema.fields, T.StructField("attempt", T.StringType())]))
    placed = T.StructType([*state.schema.fields, T.StructField(_ATTEMPT, T.StringType())])
    stored = spark.read.schema(placed).option("basePath", f"{path}/data").parquet(*(folder(path, run.attempt) for run in some))
    return stored.withColumnRenamed(_ATTEMPT, "attempt")


def committed(spark: SparkSession, path: str, run_ids: list[str] | None = None, state: Commit | None = None) -> DataFrame:
    """The rows of all runs, or of those named, with a column ``run_id``.

    The files are those of one record, the newest unless a ``state`` read before is
    given; later commits do not change what the frame reads, as long as
    ``remove_unused`` leaves its folders.
    """
    state = state or newest(spark, path)
    if state is None:
        raise ValueError(f"nothing is committed at {path}")
    some = [run for run in state.runs if run_ids is None or run.run_id in run_ids]
    named = spark.createDataFrame([(run.attempt, run.run_id) for run in some], f"of string, {RUN_COLUMN} string")
    rows = attempts(spark, path, state, some)
    return rows.join(F.broadcast(named), rows["attempt"] == named["of"]).select(
        *(rows[name] for name in state.schema.names), RUN_COLUMN
    )


def remove_unused(spark: SparkSession, path: str, older_than_hours: float = 24.0) -> list[str]:
    """Remove folders of attempts that the newest record does not list, and older records.

    Only what last changed longer ago than that, so that neither a write in progress
    nor a reader of an earlier record loses its files. Returns the attempts removed.
    """
    state = newest(spark, path)
    before = time.time() - older_than_hours * 3600
    used = set() if state is None else {run.attempt for run in state.runs}
    gone = []
    for name in files.names(spark, f"{path}/data"):
        attempt = name.removeprefix(f"{_ATTEMPT}=")
        if attempt not in used and files.changed(spark, f"{path}/data/{name}") < before:
            files.remove(spark, f"{path}/data/{name}")
            gone.append(attempt)
    for number in _numbers(spark, path)[:-1]:
        if files.changed(spark, _record(path, number)) < before:
            files.remove(spark, _record(path, number))
    return gone
