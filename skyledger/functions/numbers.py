"""Exact means, sizes and rates."""

from pyspark.sql import Column, functions as F

# Size units, each 1024 times the one before.
SIZE_UNITS = ("bytes", "kB", "MB", "GB", "TB")
# A unit is used up to ten thousand and a bit of itself, then the next one takes over.
SIZE_LIMIT = 10 * 1024


def rounded_mean(total: Column, count: Column, places: int = 2, precision: int = 5) -> Column:
    """Mean of decimals from their sum and count, rounded once, half away from zero.

    ``avg`` rounds to four more digits than its input and a cast would round again,
    which can cross a tie. A wide sum divided at once would keep only six digits after
    the point, so the whole part and the remainder are divided apart: the first is
    exact and the second keeps 17 digits, enough for any count below 10^14. The cast
    is the only rounding that can show. NULL when there is nothing to average.
    """
    many = F.nullif(count.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    rest = total % many
    whole = ((total - rest) / many).cast("decimal(18,0)")
    part = (rest.cast("decimal(22,9)") / many).cast("decimal(19,17)")
    return (whole + part).cast(f"decimal({precision},{places})")


def size_text(size: Column) -> Column:
    """Bytes as ``N bytes``, ``N kB``, ``N MB``, ``N GB`` or ``N TB``, rounded half up."""
    text = F.concat(size.cast("string"), F.lit(" bytes"))
    units = SIZE_UNITS[1:]
    for power, unit in enumerate(units):
        # Half units: one bit more than the unit keeps the half for rounding.
        halves = F.shiftright(size, 9 + 10 * power)
        whole = F.shiftright(halves + 1, 1)
        reached = size >= SIZE_LIMIT if power == 0 else (
            F.shiftright(size, 9 + 10 * (power - 1)) >= 2 * SIZE_LIMIT - 1
        )
        text = F.when(reached, F.concat(whole.cast("string"), F.lit(f" {unit}"))).otherwise(text)
    return text


def rows_per_second(rows: Column, seconds: Column) -> Column:
    """Throughput as a double; NULL when no time was measured."""
    return rows.cast("double") / F.nullif(seconds, F.lit(0.0))
