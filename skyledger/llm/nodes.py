"""Names for classes of equal things whose ids may repeat."""

from itertools import count

from pyspark.sql import DataFrame, functions as F

from skyledger.llm.settle import is_empty, released, settled


#: Parts into which the rows of one class are dealt when they meet it.
SALTS = 8


def met_by_class(rows: DataFrame, classes: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` (id, h1, h2) joined with the other columns of their class, a class of many rows in several tasks."""
    each = classes.withColumnsRenamed({"h1": "c1", "h2": "c2"}).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS))
    return rows.join(each, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")) & (salt == F.col("salt")), how).drop("c1", "c2", "salt")


def named_classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Classes of rows (id, h1, h2) that are equal in both hashes, and links (a, b) that hold from the start.

    A class (``node``, ``first``, ``h1``, ``h2``, ``copies``; settled) is named by its
    least id. Where several classes have that id, one keeps it and the others, which
    are linked with it, get names of their own that are no ids. ``copies`` counts rows.
    Other links are those of a class with the ids of its rows. Only ids and hashes move.
    """
    least = F.min("id")
    grouped = settled(rows.groupBy("h1", "h2").agg(least.alias("node"), least.alias("first"), F.count("*").alias("copies")))
    shared = grouped.groupBy(F.col("first").alias("of")).agg(F.count("*").alias("n"), F.min(F.struct("h1", "h2")).alias("keeps")).where("n > 1")
    others = settled(
        grouped.join(shared, F.col("first") == F.col("of")).where("NOT (h1 = keeps.h1 AND h2 = keeps.h2)").select(
            F.col("h1").alias("o1"), F.col("h2").alias("o2")
        )
    )
    if is_empty(others):
        released(others)
        links = met_by_class(rows, grouped.where("copies > 1").select("node", "h1", "h2"))
        return grouped, links.select(F.col("node").alias("a"), F.col("id").alias("b"))
    for seed in count():
        named = others.withColumn("name", F.xxhash64("o1", "o2", F.lit(seed)))
        twice = named.groupBy("name").count().where("count > 1")
        taken = rows.join(named, F.col("id") == F.col("name"), "left_semi")
        if is_empty(twice) and is_empty(taken):
            break
    classes = settled(
        grouped.join(named, (F.col("h1") == F.col("o1")) & (F.col("h2") == F.col("o2")), "left").select(
            F.coalesce("name", "first").alias("node"), "first", "h1", "h2", "copies"
        )
    )
    released(grouped, others)
    links = met_by_class(rows, classes.select("node", "h1", "h2"))
    return classes, links.select(F.col("node").alias("a"), F.col("id").alias("b"))


def joined_ids(reached: DataFrame, classes: DataFrame) -> DataFrame:
    """``reached`` (node, component), settled, without names that are no ids: a component's is its least id."""
    extra = classes.where("node <> first").select(F.col("node").alias("name"))
    if is_empty(extra):
        return reached
    ids = reached.join(extra, F.col("node") == F.col("name"), "left_anti")
    least = ids.groupBy(F.col("component").alias("of")).agg(F.min("node").alias("least"))
    return settled(ids.join(least, F.col("component") == F.col("of")).select("node", F.col("least").alias("component")))
