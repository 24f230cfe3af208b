"""Lookups that match the stored layouts, so the scan reads only what it must."""

from datetime import datetime
from decimal import Decimal
import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.functions.times import day_of, time_literal

CELL_DEGREES = 30


def by_batch(df: DataFrame, batch_id: int) -> DataFrame:
    """Rows of one batch. On a table bucketed by ``batch_id`` one bucket is read."""
    return df.where(F.col("batch_id") == batch_id)


def by_time(
    df: DataFrame,
    start: datetime | str,
    end: datetime | str,
    time_col: str = "event_time",
    date_col: str = "event_date",
) -> DataFrame:
    """Rows with ``start <= time < end``.

    If the frame has the layout's date column, days outside the range are pruned as
    directories and row groups outside it by their statistics.
    """
    kind = df.schema[time_col].dataType
    lower, upper = time_literal(start, kind), time_literal(end, kind)
    found = df.where((F.col(time_col) >= lower) & (F.col(time_col) < upper))
    if date_col in df.columns:
        found = found.where(F.col(date_col).between(day_of(lower, kind), day_of(upper, kind)))
    return found


def _grid(degrees: int) -> tuple[int, int]:
    """Rows and columns of a grid whose cells measure this many degrees each way."""
    if degrees < 1 or 180 % degrees:
        raise ValueError(f"cells of {degrees} degrees do not divide the globe evenly")
    return 180 // degrees, 360 // degrees


def cell_of(latitude: Column, longitude: Column, degrees: int = CELL_DEGREES) -> Column:
    """Number of the grid cell a point lies in; the far edges join the last cells."""
    rows, columns = _grid(degrees)
    row = F.least(F.floor((latitude.cast("double") + 90) / degrees), F.lit(rows - 1))
    column = F.least(F.floor((longitude.cast("double") + 180) / degrees), F.lit(columns - 1))
    return (row * columns + column).cast("int")


#: Bits of each coordinate on the curve.
CURVE_BITS = 16


def _spread_bits(value: Column) -> Column:
    """The 16 bits of a number, each moved to twice its place: its binary digits, read to the base of four. Null for larger numbers."""
    return F.when(value.between(0, (1 << CURVE_BITS) - 1), F.conv(F.bin(value), 4, 10).cast("bigint"))


def curve_of(latitude: Column, longitude: Column) -> Column:
    """A point's place on a curve through the globe: 16 bits of both coordinates, in turns."""
    steps = (1 << CURVE_BITS) - 1
    x = F.floor((longitude.cast("double") + 180) / 360 * steps)
    y = F.floor((latitude.cast("double") + 90) / 180 * steps)
    return _spread_bits(x).bitwiseOR(F.shiftleft(_spread_bits(y), 1))


def cells_in_box(
    south: float, north: float, west: float, east: float, degrees: int = CELL_DEGREES
) -> list[int]:
    """Numbers of all cells a latitude/longitude box touches."""
    rows, columns = _grid(degrees)

    def span(low: float, high: float, origin: int, count: int) -> range:
        first = int((low + origin) // degrees)
        last = int((high + origin) // degrees)
        return range(max(0, min(first, count - 1)), max(0, min(last, count - 1)) + 1)

    return [
        row * columns + column
        for row in span(south, north, 90, rows)
        for column in span(west, east, 180, columns)
    ]


def cell_column(degrees: int) -> str:
    """Name of the cell column; it carries the cell size, so a lookup cannot mistake it."""
    return f"cell_{degrees}"


def by_box(df: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    """Rows inside a box, both ends included; other cells' directories are pruned."""

    def within(name: str, low: float, high: float) -> Column:
        if isinstance(df.schema[name].dataType, T.DecimalType):
            # A double bound would cast the column and keep the test out of the scan.
            return F.col(name).between(Decimal(str(low)), Decimal(str(high)))
        return F.col(name).between(low, high)

    found = df.where(within("latitude", south, north) & within("longitude", west, east))
    for name in df.columns:
        if sized := re.fullmatch(r"cell_(\d+)", name):
            found = found.where(F.col(name).isin(cells_in_box(south, north, west, east, int(sized[1]))))
    return found
