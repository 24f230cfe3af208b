from pyspark.sql import functions as F
import pytest

from skyledger.functions.uniform import scaled_decimal, stream_keys, unit
from skyledger.operators.draws import with_draws

WORD = 0xFFFFFFFF


def by_hand(number, name, seed):
    """The draw written out with Python integers, one line per step."""
    first, second, third = stream_keys(name, seed)
    word = (number & WORD) ^ first
    word = ((word ^ word >> 16) * 0x7FEB352D + second) & WORD
    word ^= number >> 32
    word = ((word ^ word >> 15) * 0x45D9F3B + third) & WORD
    word = ((word ^ word >> 16) * 0x7FEB352D) & WORD
    return word ^ word >> 16


def test_draw_equals_the_sum_done_by_hand(spark):
    numbers = [0, 1, 2, 999, 2**31, 2**32 - 1, 2**32, 5 * 2**32 + 7, 2**53, 2**63 - 1]
    ids = spark.createDataFrame([(n,) for n in numbers], "id bigint")
    rows = with_draws(ids, ["latitude"], 42).collect()
    assert {r.id: r.draw_latitude for r in rows} == {n: by_hand(n, "latitude", 42) for n in numbers}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_draw_never_overflows(spark, with_conf, ansi):
    with_conf(spark__sql__ansi__enabled=ansi)
    low, high = (
        with_draws(spark.range(0, 2**62, 2**62 // 50_000), ["x"], 7)
        .agg(F.min("draw_x"), F.max("draw_x"))
        .first()
    )
    assert 0 <= low < high < 2**32


def test_same_rows_for_any_partitioning_and_other_rows_for_another_seed(spark):
    def total(partitions, seed):
        ids = spark.range(0, 20_000, 1, partitions)
        return with_draws(ids, ["x"], seed).agg(F.sum("draw_x")).first()[0]

    assert total(2, 1) == total(4, 1) == total(8, 1)
    assert total(4, 1) != total(4, 2)


def test_uniform_looks_uniform_and_columns_independent(spark):
    names = ["a", "b", "c"]
    drawn = with_draws(spark.range(200_000), names, 3)
    df = drawn.select(*[unit(F.col(f"draw_{name}")).alias(name) for name in names])
    stats = df.agg(
        *[F.avg(name).alias(f"avg_{name}") for name in names],
        *[F.var_pop(name).alias(f"var_{name}") for name in names],
        F.corr("a", "b").alias("ab"),
        F.corr("a", "c").alias("ac"),
        F.corr("b", "c").alias("bc"),
        F.min("a").alias("low"),
        F.max("a").alias("high"),
    ).first()
    for name in names:
        assert abs(stats[f"avg_{name}"] - 0.5) < 0.004
        assert abs(stats[f"var_{name}"] - 1 / 12) < 0.002
    assert max(abs(stats["ab"]), abs(stats["ac"]), abs(stats["bc"])) < 0.01
    assert 0 <= stats["low"] and stats["high"] < 1


def test_deciles_hold_a_tenth_each(spark):
    tenths = (
        with_draws(spark.range(200_000), ["t"], 9)
        .groupBy(F.floor(unit(F.col("draw_t")) * 10).alias("tenth"))
        .count()
        .collect()
    )
    assert len(tenths) == 10
    assert all(abs(row["count"] - 20_000) < 700 for row in tenths)


def test_scaled_decimal_rounds_half_away_from_zero(spark):
    # Draws that land exactly on a tie: 0.25 and 0.75 of the way through a span of 1 at scale 0.
    steps = 2**32
    rows = spark.createDataFrame([(steps // 4,), (steps // 2,), (3 * steps // 4,), (0,)], "d bigint")
    values = rows.select(scaled_decimal(F.col("d"), 1, 0, 3, 1).cast("string").alias("v")).collect()
    assert [r.v for r in values] == ["0.3", "0.5", "0.8", "0.0"]
    below = rows.select(scaled_decimal(F.col("d"), 1, -1, 3, 1).cast("string").alias("v")).collect()
    assert [r.v for r in below] == ["-0.8", "-0.5", "-0.3", "-1.0"]


def test_scaled_decimal_refuses_spans_it_cannot_hold(spark):
    with pytest.raises(ValueError):
        scaled_decimal(F.col("d"), 5000, 0, 12, 6)
    with pytest.raises(ValueError):
        scaled_decimal(F.col("d"), 1000, 2000, 12, 6)
