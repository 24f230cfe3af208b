"""Synthetic weather rows, one per id.

All columns are functions of the id, so the projection needs no shuffle, any
number of partitions gives the same rows, and a lost task recomputes exactly
what it had produced before.
"""

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import schemas
from skyledger.functions.uniform import STEPS, scaled_decimal, unit
from skyledger.operators.draws import PREFIX, with_draws

# Column -> (span, offset) of uniform * span + offset.
MEASURES = {
    "latitude": (180, -90),
    "longitude": (360, -180),
    "temperature": (80, -30),
    "windspeed": (150, 0),
}
# Column -> number of integer levels, starting at 0.
CODES = {"winddirection": 360, "weathercode": 100}


DRAWN = [*MEASURES, *CODES, "is_day"]


def _drawn(name: str) -> Column:
    return F.col(PREFIX + name)


def _code(name: str) -> Column:
    return F.shiftright(_drawn(name) * F.lit(CODES[name]), 32)


def _is_day() -> Column:
    return (_drawn("is_day") > F.lit(STEPS // 2)).alias("is_day")


def _with_time(ids: DataFrame, id_col: str, event_time: Column | None) -> DataFrame:
    """Just the ids and the event times, by default the load's start for all rows."""
    return ids.select(
        F.col(id_col).alias("id"),
        (F.current_timestamp() if event_time is None else event_time).alias("event_time"),
    )


def weather(
    ids: DataFrame,
    seed: int = 0,
    event_time: Column | None = None,
    id_col: str = "id",
    keep_id: bool = False,
) -> DataFrame:
    """Rows as generated: doubles, ints, a boolean, a timestamp and a bigint batch id.

    ``event_time`` defaults to the load's start, one value for all rows. The id is
    dropped unless ``keep_id`` is set.
    """
    drawn = with_draws(_with_time(ids, id_col, event_time), DRAWN, seed)
    return drawn.select(
        *(["id"] if keep_id else []),
        *[(unit(_drawn(name)) * span + offset).alias(name) for name, (span, offset) in MEASURES.items()],
        *[_code(name).cast("int").alias(name) for name in CODES],
        _is_day(),
        "event_time",
        (F.col("id") % schemas.BATCHES).alias("batch_id"),
    )


def weather_stored(
    ids: DataFrame,
    seed: int = 0,
    event_time: Column | None = None,
    id_col: str = "id",
) -> DataFrame:
    """The same rows directly in their stored types, keyed 1..n for ids 0..n-1.

    Equal to coercing :func:`weather` to the target, but the four decimals are made
    from the integer draws, which avoids the slow double-to-decimal cast.
    ``loaded_at`` is left to the target's default.
    """
    stored = {field.name: field.dataType for field in schemas.WEATHER_TARGET}

    def measure(name: str) -> Column:
        span, offset = MEASURES[name]
        return scaled_decimal(_drawn(name), span, offset, stored[name].precision, stored[name].scale)

    drawn = with_draws(_with_time(ids, id_col, event_time), DRAWN, seed)
    return drawn.select(
        (F.col("id") + 1).cast(stored["id"]).alias("id"),
        *[measure(name).alias(name) for name in MEASURES],
        *[_code(name).cast(stored[name]).alias(name) for name in CODES],
        _is_day(),
        F.col("event_time").cast(stored["event_time"]).alias("event_time"),
        (F.col("id") % schemas.BATCHES).cast(stored["batch_id"]).alias("batch_id"),
    )
