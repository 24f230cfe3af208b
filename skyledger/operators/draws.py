"""Uniform draws as columns."""

from pyspark.sql import DataFrame, functions as F

from skyledger.functions.uniform import ROUNDS, finished, mixed, started

PREFIX = "draw_"


def with_draws(df: DataFrame, names: list[str], seed: int, id_col: str = "id") -> DataFrame:
    """Add ``draw_<name>``, an integer in [0, 2**32) per row and name.

    ``id_col`` must be a non-negative bigint. Each mixing round uses its input twice, so
    the rounds are projections of their own: nested in one expression they would double
    in size with each round. All of them run in one codegen stage, and draws that
    nothing reads are pruned.
    """
    kept = [F.col(name) for name in df.columns]

    def step(words: DataFrame, sql) -> DataFrame:
        return words.select(*kept, *[F.expr(sql(name, PREFIX + name)).alias(PREFIX + name) for name in names])

    words = step(df, lambda name, _: started(id_col, name, seed))
    for turn in range(len(ROUNDS)):
        words = step(words, lambda name, word: mixed(word, turn, id_col, name, seed))
    return step(words, lambda _, word: finished(word))
