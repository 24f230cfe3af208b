"""Statistics that merge: one row for each part of a table, and what the rows of all parts say together.

A part's row holds, for each column, its filled rows, least and greatest value, an
exact total where that is a whole or decimal number, and sketches of its distinct
values (HLL) and, of numbers, of its quantiles (KLL). Rows of parts merge to the row
of the whole, so a table that grows by a part is never read whole again.
"""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.functions.numbers import rounded_mean

#: Three standard errors of a distinct sketch of 4096 buckets, and the rank error of a quantile sketch, with room.
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.03

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _exact_total(kind: T.DataType) -> bool:
    return isinstance(kind, (*_WHOLE, T.DecimalType))


def _numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _sketched(name: str, kind: T.DataType) -> Column:
    """The column in a type that a distinct sketch takes; values that differ stay different."""
    value = F.col(f"`{name}`")
    if isinstance(kind, (*_WHOLE, T.BooleanType)):
        return value.cast("bigint")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)  # one zero
    # sketches pass over empty texts, so each gets a sign before it
    return F.concat(F.lit("="), F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string"))


def _part(schema: T.StructType) -> list[Column]:
    measures = [F.count(F.lit(1)).alias("rows")]
    for at, field in enumerate(schema):
        value, kind = F.col(f"`{field.name}`"), field.dataType
        told = [
            F.count(value).alias("filled"),
            F.min(value).alias("least"),
            F.max(value).alias("greatest"),
            F.hll_sketch_agg(_sketched(field.name, kind)).alias("distinct"),
        ]
        if _exact_total(kind):
            told.append(F.sum(value.cast(f"decimal(38,{getattr(kind, 'scale', 0)})")).alias("total"))
        if _numeric(kind):
            told.append(F.kll_sketch_agg_double(value.cast("double")).alias("quantiles"))
        measures.append(F.struct(*told).alias(f"c{at}"))
    return measures


def partial_statistics(df: DataFrame, schema: T.StructType, part_col: str) -> DataFrame:
    """A row for each value of ``part_col``: the statistics of the columns of ``schema``. One scan, one row a task and part is shuffled.

    Columns must have an order (no maps). They are kept by position, ``c0``, ``c1``, ...
    """
    return df.groupBy(part_col).agg(*_part(schema))


def merged_statistics(parts: DataFrame, schema: T.StructType) -> DataFrame:
    """The one row that the rows of all parts give together. Without parts its counts are 0."""
    measures = [F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")]
    for at, field in enumerate(schema):
        of = lambda name: F.col(f"c{at}.{name}")  # noqa: B023, E731
        told = [
            F.coalesce(F.sum(of("filled")), F.lit(0)).alias("filled"),
            F.min(of("least")).alias("least"),
            F.max(of("greatest")).alias("greatest"),
            F.hll_union_agg(of("distinct")).alias("distinct"),
        ]
        if _exact_total(field.dataType):
            told.append(F.sum(of("total")).alias("total"))
        if _numeric(field.dataType):
            told.append(F.kll_merge_agg_double(of("quantiles")).alias("quantiles"))
        measures.append(F.struct(*told).alias(f"c{at}"))
    return parts.agg(*measures)


def summary_of(merged: DataFrame, schema: T.StructType, time_col: str, value_col: str) -> DataFrame:
    """Count, first and last time and mean value, as ``operators.summary.summary`` finds them in the rows."""
    time, value = (F.col(f"c{schema.names.index(name)}") for name in (time_col, value_col))
    misfit = F.raise_error(F.lit(f"the mean of {value_col} does not fit decimal(5,2)")).cast("decimal(5,2)")
    mean = F.when(value["filled"] == 0, F.lit(0).cast("decimal(5,2)")).otherwise(
        F.coalesce(rounded_mean(value["total"], value["filled"]), misfit)
    )
    return merged.select(
        F.col("rows").alias("record_count"),
        time["least"].alias("earliest_event"),
        time["greatest"].alias("latest_event"),
        mean.alias("avg_temperature"),
    )


def profile_of(merged: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column what ``operators.summary.profile`` tells, distinct values by sketch, and the median of numbers by sketch."""
    columns = []
    for at, field in enumerate(schema):
        of = F.col(f"c{at}")
        median = F.lit(None).cast("double")
        if _numeric(field.dataType):
            median = F.when(of["filled"] > 0, F.kll_sketch_get_quantile_double(of["quantiles"], F.lit(0.5).cast("double")))
        columns.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.lit(at + 1).alias("ordinal_position"),
                F.col("rows"),
                (F.col("rows") - of["filled"]).alias("nulls"),
                F.coalesce(F.hll_sketch_estimate(of["distinct"]), F.lit(0)).cast("long").alias("distinct_values"),
                of["least"].cast("string").alias("least"),
                of["greatest"].cast("string").alias("greatest"),
                median.alias("median"),
            )
        )
    return merged.select(F.inline(F.array(*columns))).orderBy("ordinal_position")
