"""Everything that turns stored bytes, or nothing at all, into a DataFrame."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from skyledger import schemas
from skyledger.functions.text import table_identifier

# Stored weather rows take some 16 bytes: tasks write files of 2 to 256 MB.
LEAST_ROWS_PER_TASK = 125_000
MOST_ROWS_PER_TASK = 16_000_000


def row_ids(spark: SparkSession, rows: int, partitions: int | None = None) -> DataFrame:
    """Ids 0..rows-1.

    By default one task per core, fewer for loads too small to be worth it, and more
    once a task would grow too long, so file sizes stay level however large the load.
    """
    if partitions is None:
        worthwhile = max(1, rows // LEAST_ROWS_PER_TASK)
        needed = -(-rows // MOST_ROWS_PER_TASK)
        partitions = max(min(spark.sparkContext.defaultParallelism, worthwhile), needed)
    return spark.range(0, rows, 1, partitions)


def columns_of(df: DataFrame) -> DataFrame:
    """The frame's schema as rows: name, type and position, in order."""
    rows = [
        (field.name, field.dataType.simpleString(), position)
        for position, field in enumerate(df.schema, start=1)
    ]
    listing = df.sparkSession.createDataFrame(
        rows, "column_name string, data_type string, ordinal_position int"
    )
    return listing.orderBy("ordinal_position")


def catalog_columns(spark: SparkSession, table: str) -> DataFrame:
    """Columns of one catalog table, in order."""
    return columns_of(spark.table(table_identifier(table)))


def csv_rows(spark: SparkSession, path: str, schema: T.StructType = schemas.SAMPLE_CSV) -> DataFrame:
    """A CSV with a header line, read under a declared schema in one pass.

    Nothing is inferred. A header with other names, or a line that does not match the
    types, fails the read instead of turning into NULLs. Quoted fields may hold commas
    but not line breaks, which keeps large files splittable.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def payload_bodies(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Stored JSON bodies as ``body``: one per line, or one per file."""
    return spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "body")


def load_requests(df: DataFrame) -> DataFrame:
    """Requests with their defaults filled in where a field is NULL."""
    return df.select(
        *[
            F.coalesce(F.col(field.name).cast(field.dataType), F.lit(schemas.REQUEST_DEFAULTS[field.name]))
            .cast(field.dataType)
            .alias(field.name)
            if field.name in df.columns
            else F.lit(schemas.REQUEST_DEFAULTS[field.name]).cast(field.dataType).alias(field.name)
            for field in schemas.LOAD_REQUEST
        ],
        *[name for name in df.columns if name not in schemas.LOAD_REQUEST.fieldNames()],
    )


def tiers(spark: SparkSession) -> DataFrame:
    """The size tiers as four literal rows, whose size the planner knows."""
    rows = ", ".join(str(row) for row in schemas.TIER_ROWS)
    names = ", ".join(schemas.TIERS.fieldNames())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS tiers({names})").to(schemas.TIERS)


def jdbc_rows(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    key: str = "id",
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table; with key bounds it is read by many tasks instead of one."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table_identifier(table))
    if partitions is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs the lower and upper key")
        reader = reader.options(
            partitionColumn=key, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()
