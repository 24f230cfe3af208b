"""One-pass summaries of a loaded table."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.functions.numbers import rounded_mean, size_text

# The error the optimizer's own column statistics settle for; 2 % takes three times as long.
SKETCH_ERROR = 0.05


def _file_bytes() -> Column:
    """The file's size on the first row of each Parquet file, NULL on all others.

    Summed, this counts every file once however it is split among tasks, and needs no
    grouping by file. Files without rows do not count.
    """
    return F.when(F.col("_metadata.row_index") == 0, F.col("_metadata.file_size"))


def summary(
    df: DataFrame,
    time_col: str = "event_time",
    value_col: str = "temperature",
    with_size: bool = False,
) -> DataFrame:
    """One row: count, first and last time, mean value, and the size if asked for.

    One scan of two columns, a partial aggregate in each task, one small exchange.
    ``with_size`` takes the bytes of the data files from the same scan, and needs a
    frame read from Parquet. ``value_col`` must be a decimal of up to 9 places and 28
    digits; its mean is exact and rounded once. The sum is widened to 38 digits, so it
    holds 10^10 times the largest value of a 28-digit column and far more of the stored
    ones. An empty or all-NULL column has mean 0, as has a true mean of 0;
    ``record_count`` tells the first of these apart. A mean that does not fit fails.
    """
    kind = df.schema[value_col].dataType
    total = F.sum(F.col(value_col).cast(f"decimal(28,{kind.scale})"))
    misfit = F.raise_error(f"the mean of {value_col} does not fit decimal(5,2)").cast("decimal(5,2)")
    mean = F.when(F.count(value_col) == 0, F.lit(0).cast("decimal(5,2)")).otherwise(
        F.coalesce(rounded_mean(total, F.count(value_col)), misfit)
    )
    measures = [
        F.count(F.lit(1)).alias("record_count"),
        F.min(time_col).alias("earliest_event"),
        F.max(time_col).alias("latest_event"),
        mean.alias("avg_temperature"),
    ]
    if with_size:
        size = F.coalesce(F.sum(_file_bytes()), F.lit(0))
        measures = [size_text(size).alias("table_size"), size.alias("size_bytes"), *measures]
    return df.agg(*measures)


def data_size(df: DataFrame) -> DataFrame:
    """One row with the files, bytes and printed size behind a frame read from Parquet."""
    return df.agg(
        F.count(_file_bytes()).alias("files"),
        F.coalesce(F.sum(_file_bytes()), F.lit(0)).alias("size_bytes"),
    ).withColumn("table_size", size_text(F.col("size_bytes")))


#: Bits that one bitmap of Spark holds, and its bytes; bytes of a grouped key in a shuffle, about.
BITMAP_BITS, BITMAP_BYTES, GROUPED_BYTES = 1 << 15, 1 << 12, 24
#: Buckets with repeats up to which their numbers are sent to all tasks, 1 MB at most.
SENT_BUCKETS = 1 << 17


def _grouped_keys(keys: DataFrame) -> DataFrame:
    """Rows and keys by grouping each key."""
    held = keys.groupBy("key").agg(F.count(F.lit(1)).alias("held"))
    return held.agg(
        F.coalesce(F.sum("held"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.count_if(F.col("held") > 1).alias("repeated_keys"),
    )


def _bitmapped_keys(keys: DataFrame, sent: int) -> DataFrame:
    """The same by a bit for each key; only keys of buckets that have more rows than bits are grouped."""
    number = F.bitmap_bucket_number("key")
    buckets = (
        keys.groupBy(number.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("rows"), F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("key"))).alias("bits"))
    )
    single = buckets.where("rows = bits").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bits"), F.lit(0)).alias("keys"), F.lit(0).cast("long").alias("repeated_keys")
    )
    several = buckets.where("rows > bits").select("bucket")
    few = [row["bucket"] for row in several.limit(sent + 1).collect()]
    if not few:
        return single
    if len(few) <= sent:
        several = F.broadcast(keys.sparkSession.createDataFrame([(b,) for b in few], "bucket long"))
    return single.unionAll(_grouped_keys(keys.join(several, number == F.col("bucket"), "left_semi")))


def key_check(df: DataFrame, key: str = "id", bitmaps: bool | None = None) -> DataFrame:
    """One row: rows, distinct keys, keys held by several rows, rows without a key.

    Stands in for a primary key, which file tables do not enforce, and is exact.
    Whole-number keys are told by bitmaps where that moves less: each task sends 4 kB
    for each 32,768 numbers among which it has a key, and only keys of buckets that
    have more rows than bits are grouped. Otherwise each distinct key is shuffled once;
    repeats are combined in the task first. A first pass over the keys, which moves two
    numbers for each task and bucket, tells which moves less; ``bitmaps`` says it instead.
    """
    whole = isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    if bitmaps and not whole:
        raise ValueError(f"bitmaps are for whole numbers, and {key} is {df.schema[key].dataType.simpleString()}")
    named = df.select(F.col(key).alias("key"))
    keys = named.where("key IS NOT NULL")
    if whole:
        keys = keys.select(F.col("key").cast("long"))
    if bitmaps is None:
        bitmaps = whole and _bitmaps_are_less(keys)
    found = _bitmapped_keys(keys, SENT_BUCKETS) if bitmaps else _grouped_keys(keys)
    without = named.where("key IS NULL").agg(F.count(F.lit(1)).alias("rows_without_key"))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("long")
    return found.unionByName(without, allowMissingColumns=True).agg(
        (total("rows") + total("rows_without_key")).alias("rows"),
        total("keys").alias("keys"),
        total("repeated_keys").alias("repeated_keys"),
        total("rows_without_key").alias("rows_without_key"),
    )


def _bitmaps_are_less(keys: DataFrame) -> bool:
    """Whether the bitmaps of all tasks take less than half of what the keys of all rows do."""
    made = keys.groupBy(F.spark_partition_id().alias("task"), F.bitmap_bucket_number("key").alias("bucket"))
    told = made.agg(F.count(F.lit(1)).alias("rows")).agg(F.count(F.lit(1)).alias("bitmaps"), F.sum("rows").alias("rows")).first()
    return told["bitmaps"] * BITMAP_BYTES * 2 < (told["rows"] or 0) * GROUPED_BYTES


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """Per column: position, type, rows, nulls, distinct values, least and greatest.

    The default is one scan that sketches distinct values (5 % standard error) and
    shuffles one row per task. ``exact`` groups each column by itself: repeats within
    a task are combined before its shuffle, so a value held by most rows is no burden, but
    every distinct value travels once. It reads a column at a time, which adds up to one scan of a columnar table; for very large ones raise
    ``spark.sql.files.maxPartitionBytes`` to suit single-column tasks.
    """
    rows = _exact_profile(df) if exact else _sketched_profile(df)
    return rows.orderBy("ordinal_position")


def _described(df: DataFrame, position: int) -> list[Column]:
    name = df.columns[position]
    return [
        F.lit(name).alias("column_name"),
        F.lit(df.schema[name].dataType.simpleString()).alias("data_type"),
        F.lit(position + 1).alias("ordinal_position"),
    ]


def _sketched_profile(df: DataFrame) -> DataFrame:
    measures = [F.count(F.lit(1)).alias("rows")]
    columns = []
    for position, name in enumerate(df.columns):
        measures += [
            F.count(F.col(name)).alias(f"filled_{position}"),
            F.approx_count_distinct(name, SKETCH_ERROR).alias(f"distinct_{position}"),
            F.min(name).cast("string").alias(f"least_{position}"),
            F.max(name).cast("string").alias(f"greatest_{position}"),
        ]
        columns.append(
            F.struct(
                *_described(df, position),
                F.col("rows"),
                (F.col("rows") - F.col(f"filled_{position}")).alias("nulls"),
                F.col(f"distinct_{position}").alias("distinct_values"),
                F.col(f"least_{position}").alias("least"),
                F.col(f"greatest_{position}").alias("greatest"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*columns)))


def _exact_profile(df: DataFrame) -> DataFrame:
    value, repeats = F.col("value"), F.col("repeats")
    columns = [
        df.groupBy(F.col(name).alias("value"))
        .agg(F.count(F.lit(1)).alias("repeats"))
        .agg(
            F.coalesce(F.sum(repeats), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(value.isNull(), repeats)), F.lit(0)).alias("nulls"),
            F.count(value).alias("distinct_values"),
            F.min(value).cast("string").alias("least"),
            F.max(value).cast("string").alias("greatest"),
        )
        .select(*_described(df, position), "rows", "nulls", "distinct_values", "least", "greatest")
        for position, name in enumerate(df.columns)
    ]
    return reduce(DataFrame.unionAll, columns)
