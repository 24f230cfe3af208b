"""Narrow columns to declared types: all or nothing, or set the misfits apart."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

REJECTED = "rejected_columns"

WHOLE_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _targets(df: DataFrame, target: T.StructType) -> dict[str, T.DataType]:
    """Declared type of each column of ``df``; columns not declared keep their own."""
    declared = {field.name: field.dataType for field in target}
    return {name: declared.get(name, df.schema[name].dataType) for name in df.columns}


def _fits(value: Column, given: T.DataType, kind: T.DataType) -> Column:
    """Whether a non-NULL value can take the declared type; NULL for NULL.

    Numbers are compared with the bounds of the type. Asking ``try_cast`` would give the
    same answer, but it raises and catches an exception for each value that does not
    fit, which is some ten times slower where many do not.
    """
    if isinstance(kind, T.DecimalType) and isinstance(given, T.NumericType) and kind.precision < 38:
        # The least magnitude that rounds up to one digit too many.
        bound = Decimal(10) ** (kind.precision - kind.scale) - Decimal(5).scaleb(-kind.scale - 1)
        if isinstance(given, (T.FloatType, T.DoubleType)):
            return F.abs(value) < F.lit(float(bound))
        return F.abs(value.cast("decimal(38,0)") if isinstance(given, T.IntegralType) else value) < F.lit(bound)
    if type(kind) in WHOLE_BITS and isinstance(given, T.IntegralType):
        least = -(2 ** (WHOLE_BITS[type(kind)] - 1))
        return value.between(least, -least - 1)
    return value.try_cast(kind).isNotNull()


def _misfit(df: DataFrame, name: str, kind: T.DataType) -> Column:
    value = F.col(name)
    return value.isNotNull() & ~_fits(value, df.schema[name].dataType, kind)


def _cast(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """The value in its declared type; NULL where it does not fit."""
    value = F.col(name)
    return F.when(_fits(value, df.schema[name].dataType, kind), value.try_cast(kind))


def cast(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """A column of ``df`` in a declared type; NULL where it does not fit."""
    return _cast(df, name, kind) if _needs_cast(df, name, kind) else F.col(name)


def _needs_cast(df: DataFrame, name: str, kind: T.DataType) -> bool:
    return df.schema[name].dataType != kind


def strict(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast by name; any value that does not fit fails the job.

    Fails in ANSI and in non-ANSI sessions alike (a plain cast would write NULL in
    the latter). Decimals round half away from zero; NaN and infinities fit no decimal.
    """
    columns = []
    for name, kind in _targets(df, target).items():
        if not _needs_cast(df, name, kind):
            columns.append(F.col(name))
            continue
        message = F.concat(
            F.lit("value "), F.col(name).cast("string"), F.lit(f" of {name} does not fit {kind.simpleString()}")
        )
        columns.append(
            F.when(_misfit(df, name, kind), F.raise_error(message).cast(kind))
            .otherwise(_cast(df, name, kind))
            .alias(name)
        )
    return df.select(*columns)


def mark(df: DataFrame, target: T.StructType) -> DataFrame:
    """Add ``rejected_columns``: the names whose value does not fit, in column order.

    Column values stay as they were, so a rejected row can be looked at and mended.
    """
    tests = [
        F.when(_misfit(df, name, kind), F.lit(name))
        for name, kind in _targets(df, target).items()
        if _needs_cast(df, name, kind)
    ]
    rejected = F.array_compact(F.array(*tests)) if tests else F.array().cast("array<string>")
    return df.withColumn(REJECTED, rejected)


def typed(df: DataFrame, target: T.StructType) -> DataFrame:
    """Every row once: values in their declared types, NULL where rejected, and ``rejected_columns``.

    One projection of one scan. Filter on ``size(rejected_columns)`` to set the
    misfits apart; written partitioned by that test, both parts come of one pass.
    """
    marked = mark(df, target)
    values = [
        (_cast(df, name, kind) if _needs_cast(df, name, kind) else F.col(name)).alias(name)
        for name, kind in _targets(df, target).items()
    ]
    return marked.select(*values, REJECTED)


def split(df: DataFrame, target: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(accepted rows in their declared types, rejected rows as they came).

    Each is a filter over a narrow projection and reads the source by itself; ``typed``
    gives all rows in one scan.
    """
    marked = mark(df, target)
    fits = F.size(REJECTED) == 0
    accepted = marked.where(fits).select(
        *[
            (_cast(df, name, kind) if _needs_cast(df, name, kind) else F.col(name)).alias(name)
            for name, kind in _targets(df, target).items()
        ]
    )
    return accepted, marked.where(~fits)
