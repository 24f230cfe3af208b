"""Text forms of numbers and durations, and checked identifiers."""

import re

from pyspark.sql import Column, functions as F

_IDENTIFIER = re.compile(r"[a-z_][a-z0-9_]*")


def identifier(name: str) -> str:
    """The name unchanged if it is safe to put into SQL text, else an error."""
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain lower-case identifier: {name!r}")
    return name


def table_identifier(name: str) -> str:
    """Like :func:`identifier`, with an optional ``database.`` in front."""
    parts = name.split(".")
    if len(parts) > 2:
        raise ValueError(f"expected [database.]table: {name!r}")
    return ".".join(identifier(part) for part in parts)


def duration_text(seconds: Column) -> Column:
    """``H:MM:SS`` with fractions of a second dropped and hours not padded."""
    whole = F.floor(seconds).cast("bigint")

    def two_digits(value: Column) -> Column:
        return F.lpad(value.cast("string"), 2, "0")

    return F.concat(
        F.floor(whole / 3600).cast("string"),
        F.lit(":"),
        two_digits(F.floor(F.pmod(whole, F.lit(3600)) / 60)),
        F.lit(":"),
        two_digits(F.pmod(whole, F.lit(60))),
    )


def with_thousands(value: Column, places: int = 0) -> Column:
    """``1,234,567`` or, with places, ``1,234.50``."""
    return F.format_number(value, places)


def fixed_point(value: Column, places: int = 2) -> Column:
    """``1234.50``: a fixed number of digits and no separators, ties to even."""
    return F.replace(F.format_number(value, places), F.lit(","), F.lit(""))
