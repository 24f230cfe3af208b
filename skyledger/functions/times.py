"""Time literals and calendar days that do not depend on where they are made."""

from datetime import datetime

from pyspark.sql import Column, functions as F, types as T


def time_literal(value: datetime | str, kind: T.DataType) -> Column:
    """A moment as a column of the given timestamp type.

    A value without a zone means the clock of the session's zone (of no zone, for
    timestamps without one). ``lit`` would take it by the driver machine's zone.
    """
    if isinstance(value, datetime) and value.tzinfo and isinstance(kind, T.TimestampNTZType):
        raise ValueError("a moment with a zone cannot be compared with timestamps without one")
    return F.lit(str(value)).cast(kind)


def day_of(time: Column, kind: T.DataType) -> Column:
    """Calendar day of a timestamp; the UTC day for timestamps with a zone.

    Independent of the session's zone, so a reader prunes the days the writer made.
    """
    if isinstance(kind, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86400).cast("int"))
    return F.to_date(time)
