"""Catalog tables and re-runnable file appends."""

from collections.abc import Callable
from dataclasses import dataclass
import re

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from skyledger import schemas
from skyledger.functions.text import identifier, table_identifier
from skyledger.operators import coerce

# What Spark writes as %XX in the names of partition directories.
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")

_ORIGINAL, _OUTCOME, _ACCEPTED, _REJECTED = "__original", "__outcome", "accepted", "rejected"


def drop_table(spark: SparkSession, table: str) -> None:
    """Remove the table and its data if it is there."""
    spark.sql(f"DROP TABLE IF EXISTS {table_identifier(table)}")


def create_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType = schemas.WEATHER_TARGET,
    defaults: dict[str, str] = schemas.LOADED_AT_DEFAULT,
) -> None:
    """Start the declared table afresh, dropping what was there.

    Parquet tables have no identity columns, so the key is computed by the load;
    a default fills any column the load leaves out.
    """
    drop_table(spark, table)
    columns = ", ".join(
        f"{identifier(field.name)} {field.dataType.simpleString()}"
        + (f" DEFAULT {defaults[field.name]}" if field.name in defaults else "")
        for field in schema
    )
    spark.sql(f"CREATE TABLE {table_identifier(table)} ({columns}) USING parquet")


def append(df: DataFrame, table: str) -> None:
    """Append by column name; columns the frame lacks get the table's defaults."""
    df.sparkSession.sql(f"INSERT INTO {table_identifier(table)} BY NAME SELECT * FROM {{rows}}", rows=df)


def publish(df: DataFrame, table: str) -> None:
    """Replace the named table with this result."""
    df.write.mode("overwrite").saveAsTable(table_identifier(table))


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Write one run's rows so that writing them again replaces them.

    The run is a directory of its own and only the directories written to are
    replaced, so a retried run leaves no duplicates and other runs stay. No shuffle:
    each task adds its files to the run's directory. A run that turns out to have no
    rows touches no directory, so its own is then emptied, after the write has ended.
    Readers may see files change under them; ``runs.commit_run`` has neither fault. The
    name becomes a directory's, so it cannot be empty.
    """
    if not run_id:
        raise ValueError("a run written as a directory needs a name")

    def write(rows: DataFrame) -> None:
        (
            rows.withColumn("run_id", F.lit(run_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id")
            .parquet(path)
        )

    if counting_rows(df, write) == 0:
        folder = _ESCAPED.sub(lambda found: f"%{ord(found[0]):02X}", run_id)
        df.drop("run_id").limit(0).write.mode("overwrite").parquet(f"{path}/run_id={folder}")


@dataclass(frozen=True)
class Split:
    """Both parts of a split write, read back: rows in their declared types, and misfits as they came."""

    accepted: DataFrame
    rejected: DataFrame


def write_split(df: DataFrame, target: T.StructType, path: str) -> Split:
    """Write rows that fit ``target`` in its types, and the others as they came with ``rejected_columns``, in one pass.

    The source is read once and nothing is shuffled: each task writes its rows to the
    directory of their outcome. A rejected row keeps all its original values and
    types, an accepted one has none twice. Writing again replaces both parts.
    """
    spark = df.sparkSession
    typed = coerce.typed(df, target)
    values = {field.name: field.dataType for field in typed.drop(coerce.REJECTED).schema}
    marked = coerce.mark(df, target)
    misfit = F.size(coerce.REJECTED) > 0
    original = F.struct(*(F.col(f"`{name}`") for name in df.columns))
    rows = marked.select(
        *(F.when(~misfit, coerce.cast(df, name, kind)).alias(name) for name, kind in values.items()),
        F.when(misfit, original).alias(_ORIGINAL),
        F.when(misfit, F.col(coerce.REJECTED)).alias(coerce.REJECTED),
        F.when(misfit, _REJECTED).otherwise(_ACCEPTED).alias(_OUTCOME),
    )
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(_OUTCOME).parquet(path)
    stored = spark.read.schema(rows.schema).parquet(path)
    return Split(
        stored.where(F.col(_OUTCOME) == _ACCEPTED).select(*values),
        stored.where(F.col(_OUTCOME) == _REJECTED).select(*(F.col(_ORIGINAL)[name].alias(name) for name in df.columns), coerce.REJECTED),
    )


def counting_rows(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return how many rows it wrote, counted while writing.

    Exact for a write that adds no shuffle of its own: each finished task counts once,
    retried or not. A shuffle after the count could be run again when executors are
    lost, and count rows twice.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def analyze(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """Store row count, size and column statistics for the optimizer, in one scan.

    On a very large table name just the columns that queries filter or join on.
    """
    which = "ALL COLUMNS" if columns is None else "COLUMNS " + ", ".join(identifier(c) for c in columns)
    spark.sql(f"ANALYZE TABLE {table_identifier(table)} COMPUTE STATISTICS FOR {which}")
