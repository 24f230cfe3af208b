"""Connected components of a distributed list of links."""

from pyspark.sql import DataFrame, functions as F

from skyledger.llm.settle import is_empty, released, settled


def _around(links: DataFrame) -> DataFrame:
    """``x``, ``least`` and ``most``: the bounds of the neighbours of every node."""
    ends = F.explode(F.array(F.struct(F.col("hi").alias("x"), F.col("lo").alias("y")), F.struct(F.col("lo").alias("x"), F.col("hi").alias("y"))))
    return links.select(ends.alias("end")).groupBy("end.x").agg(F.min("end.y").alias("least"), F.max("end.y").alias("most"))


def _large_star(links: DataFrame, around: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the least of the node and its neighbours."""
    return links.join(around, F.col("lo") == F.col("x")).select("hi", F.least("x", "least").alias("lo")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all move to the least of them."""
    least = links.groupBy(F.col("hi").alias("mx")).agg(F.min("lo").alias("m"))
    joined = links.join(least, F.col("hi") == F.col("mx"))
    return (
        joined.select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo"))
        .where("hi <> lo")
        .distinct()
    )


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for each node that has a link, settled.

    Alternating large and small stars until the links are stars around least
    nodes, which the bounds of each node's neighbours tell: each round is a
    partial aggregation and a join on node ids, so a node with many links is
    combined before the shuffle and its join can be split. Links to null or to
    oneself say nothing and are left out; no links give no rows.
    """
    now = settled(
        links.select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo"))
        .where(f"{left} IS NOT NULL AND {right} IS NOT NULL AND hi <> lo")
        .distinct()
    )
    while True:
        around = settled(_around(now))
        # a node that is not the least among its neighbours has one link, to a node that is
        if is_empty(around.where("least < x AND least <> most")):
            out = settled(around.select(F.col("x").alias("node"), F.least("x", "least").alias("component")))
            released(now, around)
            return out
        moved = settled(_small_star(_large_star(now, around)))
        released(now, around)
        now = moved
