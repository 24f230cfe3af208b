"""Reproducible uniform draws.

``rand(seed)`` depends on how rows fall into partitions, so a retried or
re-partitioned load would differ from the first one. These draws depend only on
(id, name, seed): any task can recompute any row, and any SQL engine with 64-bit
integers can check them. Everything is integer arithmetic inside whole-stage
codegen, about as cheap as ``rand``.
"""

import hashlib
from decimal import Decimal

from pyspark.sql import Column, functions as F

WORD = 0xFFFFFFFF
STEPS = 4294967296  # 2**32, number of distinct draws

# (right shift, multiplier) per mixing round. Multipliers stay below 2**31 so that
# a 32-bit word times one of them fits a bigint: ANSI mode raises on overflow.
ROUNDS = ((16, 0x7FEB352D), (15, 0x45D9F3B), (16, 0x7FEB352D))
LAST_SHIFT = 16


def stream_keys(name: str, seed: int) -> tuple[int, int, int]:
    """Three 32-bit constants that set one named stream apart from the others."""
    digest = hashlib.sha256(f"{seed}|{name}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8))


def started(key: str, name: str, seed: int) -> str:
    """SQL for the low half of an id column with the stream's first constant."""
    return f"({key} & {WORD}) ^ {stream_keys(name, seed)[0]}"


def mixed(word: str, turn: int, key: str, name: str, seed: int) -> str:
    """SQL for one mixing round; the high half of the id joins after the first one."""
    shift, multiplier = ROUNDS[turn]
    added = (*stream_keys(name, seed)[1:], 0)[turn]
    mix = f"((({word} ^ ({word} >> {shift})) * {multiplier} + {added}) & {WORD})"
    return f"{mix} ^ ({key} >>> 32)" if turn == 0 else mix


def finished(word: str) -> str:
    """SQL for the draw: an integer in [0, 2**32)."""
    return f"{word} ^ ({word} >> {LAST_SHIFT})"


def unit(drawn: Column) -> Column:
    """A draw as a double in [0, 1)."""
    return drawn / F.lit(float(STEPS))


def scaled_decimal(
    drawn: Column, span: int, offset: int, precision: int, scale: int
) -> Column:
    """``drawn / 2**32 * span + offset`` rounded half away from zero to a decimal.

    Same value as casting the double ``unit * span + offset`` to the decimal, at
    less than half the cost: a double-to-decimal cast goes through decimal text,
    this stays in bigint until the last step. The span and offset together, counted in
    the decimal's last place, must be below 2**31.
    """
    parts = 10**scale
    if (span + abs(offset)) * parts >= 2**31:
        raise ValueError(f"{span} from {offset} at scale {scale} does not fit 64-bit arithmetic")
    exact = drawn * F.lit(span * parts) + F.lit(offset * parts * STEPS)
    magnitude = F.shiftright(F.abs(exact) + F.lit(STEPS // 2), 32)
    signed = F.when(exact < 0, -magnitude).otherwise(magnitude)
    step = F.lit(Decimal(1).scaleb(-scale))
    return (signed.cast(f"decimal({precision + 1},0)") * step).cast(f"decimal({precision},{scale})")
