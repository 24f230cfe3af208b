"""Links found through buckets that propose stars, in rounds."""

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.components import components
from skyledger.llm.settle import is_empty, released, settled

#: Hubs that a bucket with several components proposes in each round after the first.
HUBS = 4
#: Members up to which the pairs of a crowd are listed; larger crowds meet block against block.
FEW = 16
#: Members of a large crowd compared at once with as many others.
BLOCK = 256
#: A round that confirms fewer than one in so many of its pairs is the last, where the caller says so.
SPARSE = 16


def _meeting(near: Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray]):
    def meet(key: tuple, table: pa.Table) -> pa.Table:
        """Links to other components between two blocks of a crowd, or inside one; one joins two components as well as all."""
        low, high = key[1].as_py(), key[2].as_py()
        ids, home, block = (table[c].to_numpy() for c in ("id", "component", "block"))
        right = np.flatnonzero(block == high)
        rows = np.flatnonzero(block == low)
        found = [np.empty((2, 0), np.int64)]
        for at in range(0, len(rows), BLOCK):
            part = rows[at : at + BLOCK]
            fits = near(table, part, right) & (home[part][:, None] != home[right])
            i, j = np.nonzero(fits)
            pair = np.stack((part[i], right[j]))
            found.append(ids[pair[:, np.unique(np.sort(home[pair], axis=0), axis=1, return_index=True)[1]]])
        a, b = np.sort(np.concatenate(found, axis=1), axis=0)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return meet


def across(
    crowds: DataFrame,
    seen: DataFrame,
    near: Callable[[pa.Table, np.ndarray, np.ndarray], np.ndarray],
    merged: bool = False,
    block: int = BLOCK,
) -> DataFrame:
    """Pairs (a, b) of different components that share a crowd, settled, from rows (bucket, id, component).

    Pairs of small crowds are listed, FEW / 2 for each row at most. Large ones
    meet block against block, of about ``block`` members each, and give links, one for each two components of two
    blocks: ``near(table, left, right)`` tells them, a matrix over rows of a
    table with the columns of ``seen`` (id, ...). Where ``merged``, large crowds
    that share members are one, so that no two members meet twice.
    """
    sizes = (
        crowds.groupBy(F.col("bucket").alias("of"))
        .agg(F.count("*").alias("members"), F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least <> most")
        .select("of", "members")
    )
    held = settled(crowds.join(sizes, crowds["bucket"] == sizes["of"]).drop("of"))
    # crowds of the same members are one; pairs are listed inside the row of a crowd
    few = (
        held.where(f"members <= {FEW}")
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list(F.struct("id", "component"))).alias("all"))
        .select("all")
        .distinct()
    )
    listed = (
        few.select("all", F.explode("all").alias("x"))
        .select("x", F.explode(F.filter("all", lambda y: (y["id"] > F.col("x.id")) & (y["component"] != F.col("x.component")))).alias("y"))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    )
    many = held.where(f"members > {FEW}")
    made = [held]
    if merged:
        hubs = many.groupBy(F.col("bucket").alias("of")).agg(F.min("id").alias("hub"))
        one = components(many.join(hubs, many["bucket"] == hubs["of"]).select("id", "hub"), "id", "hub")
        made.append(one)
        one = one.select("node", F.col("component").alias("bucket"))
        crowd = one.groupBy(F.col("bucket").alias("of")).agg(F.count("*").alias("members"))
        named = many.select("id", "component").distinct().join(one, F.col("id") == F.col("node")).drop("node")
        many = named.join(crowd, named["bucket"] == crowd["of"]).drop("of")
    met = (
        many.join(seen, "id")
        .withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .groupBy("bucket", "low", "high")
        .applyInArrow(_meeting(near), "a long, b long")
    )
    out = settled(listed.union(met).distinct())
    released(*made)
    return out


def joined_by_stars(
    dealt: DataFrame,
    copies: DataFrame,
    confirm: Callable[[DataFrame, DataFrame, bool], DataFrame],
    rest: Callable[[DataFrame], DataFrame],
    n_hubs: int = HUBS,
    sparse: int | None = None,
) -> DataFrame:
    """``node`` and ``component`` of everything that has a link, from rows (id, bucket).

    Each bucket proposes pairs of one member, the hub, with the members of other
    components, so pairs grow with the rows of buckets and not with the squares
    of their sizes. ``confirm(pairs, candidates, last)`` returns the pairs (a, b) that
    are links, settled, without fail in the ``last`` step; ``candidates`` holds the ids of all
    members of shared buckets and stays the same. Buckets that still hold several
    components propose ``n_hubs`` other hubs, round after round, until a round joins
    nothing or, where ``sparse`` is given, confirms fewer than one pair in so many.
    What is left then, rows (bucket, id, component) of buckets of more than two
    members in several components, goes to ``rest``, which returns pairs (a, b),
    settled, that hold all links across these components that share a bucket. ``copies`` are links (a, b)
    known before. The result is settled; what the rounds wrote is gone with them.
    """
    crowds = dealt.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1").select("bucket")
    shared = settled(dealt.join(crowds, "bucket"))
    candidates = settled(shared.select("id").distinct())
    reached = components(copies, "a", "b")
    rounds: list[DataFrame] = []
    turn = 0

    def grown(found: DataFrame) -> DataFrame:
        known = reached.select(F.col("node").alias("a"), F.col("component").alias("b"))
        out = components(known.union(found), "a", "b")
        released(reached, found)
        return out

    def members() -> DataFrame:
        return shared.join(reached, shared["id"] == reached["node"], "left").select(
            "bucket", "id", F.coalesce("component", "id").alias("component")
        )

    while True:
        placed = members()
        # the hub: the least id first, then some others by hashes of the round
        ranks = [F.xxhash64("id", F.lit(turn), F.lit(k)) for k in range(n_hubs)] if turn else [F.col("id")]
        member = lambda rank: F.struct(rank.alias("rank"), F.col("id").alias("hub"), F.col("component").alias("home"))
        hubs = (
            placed.groupBy("bucket")
            .agg(
                *(F.min(member(rank)).alias(f"hub{k}") for k, rank in enumerate(ranks)),
                F.min("component").alias("low"),
                F.max("component").alias("high"),
            )
            .where("low <> high")
            .select("bucket", F.explode(F.array_distinct(F.array(*(F.struct(f"hub{k}.hub", f"hub{k}.home") for k in range(len(ranks)))))).alias("h"))
            .select("bucket", "h.hub", "h.home")
        )
        pairs = (
            placed.join(hubs, "bucket")
            .where("component <> home")
            .select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b"))
            .distinct()
        )
        tested = reduce(DataFrame.union, rounds) if rounds else None
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = settled(pairs)
        found = confirm(pairs, candidates, False)
        rounds.append(pairs)
        enough = sparse is None or found.count() * sparse >= pairs.count()
        if not is_empty(found):
            reached = grown(found)
            turn += 1
            if enough:
                continue
            placed = members()
        # a star tests all pairs of a bucket of two
        spread = (
            placed.groupBy(F.col("bucket").alias("of"))
            .agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high"))
            .where("low <> high AND members > 2")
            .select("of")
        )
        left = settled(placed.join(spread, placed["bucket"] == spread["of"]).drop("of"))
        if not is_empty(left):
            tested = reduce(DataFrame.union, rounds)
            linked = rest(left)
            pairs = settled(linked.join(tested, ["a", "b"], "left_anti"))
            released(linked)
            rounds.append(pairs)
            found = confirm(pairs, candidates, True)
            if not is_empty(found):
                reached = grown(found)
        released(shared, candidates, left, *rounds)
        return reached
