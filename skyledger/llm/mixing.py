"""Mixing sources to target weights, in DataFrame expressions only.

1. A source's documents are dealt by a hash of the id into blocks. Block sizes
   are summed before the shuffle, so a source of any size costs its blocks.
2. Targets: the wanted total is shared by weight; a target stops at
   ``most`` times its source's size and the excess is shared again.
3. A source's blocks, in hashed order, are drawn pass after pass until one does
   not fit whole. What is missing then is filled from the documents not yet taken
   in this pass, those of the largest size that fits first, so that in the end
   none is left that fits. So every source has an exact quota of blocks.
4. A splitting tree deals the quotas to output shards: at each node, the blocks
   of each source that go left are drawn from the multivariate hypergeometric
   distribution, one source after another.
5. Each source's drawn blocks, permuted again, go to the shards by its counts.
   Within a shard rows are ordered by a hash.

All draws are hashes of ids and a seed, so reruns agree.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.settle import first_row, settled

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SHARDS = 16
#: Documents to a block, until the corpus has more than BLOCKS of these.
BLOCK_ROWS = 32
BLOCKS = 1 << 16
#: Half the width, in standard deviations, of the counts that a draw can tell apart; beyond lies less than 1e-15.
REACH = 9


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from (source, source_size).

    Weights repeat over the sources by code point, null last. When shares are
    capped from the source that is capped first, the rate (target for a unit of
    weight) only grows, so the capped sources are a prefix by size / weight:
    those whose cap is below the rate that is left for them and all after.
    """
    placed = sizes.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = placed.select(
        "source",
        "source_size",
        F.get(F.array(*(F.lit(float(w)) for w in weights)), F.expr(f"place % {len(weights)}")).alias("weight"),
    )
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    later = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = (
        weighed.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum("source_size").over(earlier), F.lit(0)) * F.lit(float(most)))
        .withColumn("rate", F.col("rest") / F.sum("weight").over(later))
        .withColumn("full", F.col("source_size") * F.lit(float(most)) <= F.col("rate") * F.col("weight"))
        .withColumn("open_rate", F.min(F.when(~F.col("full"), F.struct(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source", "rate"))).over(everything)["rate"])
    )
    target = F.when(F.col("full") | F.col("open_rate").isNull(), F.col("source_size") * F.lit(float(most))).otherwise(
        F.col("open_rate") * F.col("weight")
    )
    return ranked.select("source", "source_size", target.alias("target"))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``, by inverting the distribution at ``u``.

    Weights relative to the mode come from the ratio of neighbours, over all
    counts within REACH standard deviations.
    """
    low = F.greatest(F.lit(0).cast("long"), drawn + marked - total)
    high = F.least(marked, drawn)
    mode = F.greatest(low, F.least(high, F.floor((drawn + 1) * (marked + 1) / (total + 2))))
    rate = marked / F.greatest(total, F.lit(1))
    width = F.ceil(F.lit(REACH) * F.sqrt(drawn * rate * (1 - rate)) + REACH)

    def walk(last: Column, step: int, ratio) -> Column:
        """Weights at mode + step, mode + 2 step, ..., last."""
        steps = F.when((last - mode) * step > 0, F.sequence(mode + step, last, F.lit(step).cast("long"))).otherwise(
            F.array().cast("array<bigint>")
        )
        return F.aggregate(
            steps,
            F.struct(F.lit(1.0).alias("weight"), F.array().cast("array<double>").alias("all")),
            lambda a, k: F.struct(
                (a["weight"] * ratio(k)).alias("weight"), F.array_append(a["all"], a["weight"] * ratio(k)).alias("all")
            ),
            lambda a: a["all"],
        )

    up = walk(F.least(high, mode + width), 1, lambda k: (marked - k + 1) * (drawn - k + 1) / (k * (total - marked - drawn + k)).cast("double"))
    down = walk(F.greatest(low, mode - width), -1, lambda k: (k + 1) * (total - marked - drawn + k + 1) / ((marked - k) * (drawn - k)).cast("double"))
    weights = F.concat(F.reverse(down), F.array(F.lit(1.0)), up)
    first = mode - F.size(down)
    want = u * F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    passed = F.aggregate(
        weights,
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")),
        lambda a, w: F.struct((a["sum"] + w).alias("sum"), (a["n"] + F.when(a["sum"] + w < want, 1).otherwise(0)).alias("n")),
        lambda a: a["n"],
    )
    return F.least(first + passed, high)


_DEALING = "struct<rest:bigint,draw:bigint,taken:array<bigint>>"


def _deal(level: int, seed: int):
    """A step of the multivariate draw: the blocks of one more source that go left."""

    def deal(a: Column, c: Column) -> Column:
        u = _uniform(F.col("node"), F.lit(level), c["source"], F.lit(seed))
        k = hypergeometric(a["rest"], c["n"], a["draw"], u).cast("long")
        return F.struct(
            (a["rest"] - c["n"]).alias("rest"), (a["draw"] - k).alias("draw"), F.array_append(a["taken"], k).alias("taken")
        ).cast(_DEALING)

    return deal


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``source``, ``shard`` and ``blocks``: whole quotas dealt to shards of equal size (to within one block).

    ``shards`` is a power of two. One row per node holds its sources' counts,
    and each level of the tree is one pass over the nodes.
    """
    counts = F.sort_array(F.collect_list(F.struct("source", F.col("quota").alias("n"))))
    nodes = quotas.where("quota > 0").groupBy().agg(counts.alias("counts")).select(F.lit(0).alias("node"), "counts")
    depth = shards.bit_length() - 1
    for level in range(depth):
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c["n"])
        nodes = nodes.withColumn("total", total).withColumn(
            "left", F.shiftright(F.col("total") + (F.col("node") % 2 == 0).cast("int"), 1)
        )
        start = F.struct(F.col("total").alias("rest"), F.col("left").cast("long").alias("draw"), F.array().cast("array<bigint>").alias("taken"))
        nodes = nodes.withColumn("taken", F.aggregate("counts", start.cast(_DEALING), _deal(level, seed), lambda a: a["taken"]))
        side = lambda n: F.transform("counts", lambda c, i: F.struct(c["source"].alias("source"), n(c["n"], F.get(F.col("taken"), i)).alias("n")))
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), side(lambda n, k: k).alias("counts")),
            F.struct((F.col("node") * 2 + 1).alias("node"), side(lambda n, k: n - k).alias("counts")),
        )
        nodes = nodes.select(F.explode(halves).alias("half")).select("half.node", "half.counts")
    return settled(nodes).select(F.col("node").alias("shard"), F.inline("counts")).where("n > 0").select("source", "shard", F.col("n").alias("blocks"))


_FILLING = "struct<room:double,taken:array<struct<weight:bigint,k:bigint>>>"


def _filled(sizes: DataFrame) -> DataFrame:
    """``source``, ``weight`` and ``k``: how many documents of each size fill a source's room, from (source, room, weight, n).

    The largest first, as many as fit, so that no document that is left fits in what
    is left of the room. Sizes of which some are taken are few: together they are no
    more than the room.
    """

    def take(a: Column, c: Column) -> Column:
        k = F.least(c["n"], F.floor(a["room"] / c["weight"]))
        more = F.array_append(a["taken"], F.struct(c["weight"].alias("weight"), k.alias("k")))
        return F.struct((a["room"] - k * c["weight"]).alias("room"), F.when(k > 0, more).otherwise(a["taken"]).alias("taken")).cast(_FILLING)

    start = F.struct(F.col("room").cast("double").alias("room"), F.array().cast("array<struct<weight:bigint,k:bigint>>").alias("taken")).cast(_FILLING)
    return (
        sizes.groupBy("source", "room")
        .agg(F.sort_array(F.collect_list(F.struct("weight", "n")), asc=False).alias("sizes"))
        .select("source", F.inline(F.aggregate("sizes", start, take, lambda a: a["taken"])))
    )


def _firsts(units: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """The first ``k`` of ``units`` of each source and weight, in hashed order.

    The greatest ``k`` bounds what each task passes on, so many documents of one size
    do not meet in one task.
    """
    most = first_row(wanted.agg(F.max("k")))[0]
    if most is None:
        return units.limit(0)
    asked = units.join(wanted.withColumnsRenamed({"source": "ws", "weight": "ww"}), F.col("source").eqNullSafe(F.col("ws")) & (F.col("weight") == F.col("ww")))
    order = Window.partitionBy("source", "weight").orderBy(F.xxhash64("id", F.lit("fit"), F.lit(seed)), "id", "size")
    return asked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= int(most)).where("rank <= k")


def draws(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    shards: int = SHARDS,
    seed: int = 7,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``id``, ``source``, ``size``, ``source_size``, ``target`` and ``taken_by`` of every row of ``docs``.

    ``taken_by`` is an array of (pass, shard): the document goes into the mix
    once for each. Whole documents are taken, so a source falls short of its
    target by less than its least document that could still be taken. A document
    is taken ``most`` times at most.

    Null texts and texts without words have size 0. A null source is a source,
    the last one. Null ids hash alike. Rows alike in id, source and size are
    taken together. An empty table gives no rows. Other columns are not looked at.
    """
    sized = settled(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), words(F.col(text_col)).alias("size")
        )
    )
    totals = settled(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")))
    aims = targets(totals.select("source", "source_size"), weights, share, most)
    every = F.greatest(F.lit(BLOCK_ROWS), F.ceil(F.sum("rows").over(Window.partitionBy()) / BLOCKS))
    sources = settled(
        totals.drop("source_size")
        .withColumn("every", every)
        .join(aims.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .select("of", "source_size", "target", F.greatest(F.lit(1), F.ceil(F.col("rows") / F.col("every"))).alias("n_blocks"))
    )
    placed = settled(
        sized.join(sources, sized["source"].eqNullSafe(sources["of"]))
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit("block"), F.lit(seed)), F.col("n_blocks")))
        .drop("of", "n_blocks")
    )

    # whole blocks in hashed order, pass after pass, until the target; then part of one
    sums = placed.groupBy("source", "block").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    order = Window.partitionBy("source").orderBy(F.xxhash64("source", "block", F.lit("order"), F.lit(seed)), "block")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = settled(sums.withColumn("before", before))
    slots = settled(
        ordered.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
        .withColumn("room", F.col("target") - F.col("pass") * F.col("source_size") - F.col("before"))
        .where("room > 0")
        .select("source", "block", "pass", "room", "before", (F.col("words") > F.col("room")).alias("partial"))
    )

    # shards of the slots
    cuts = (
        split_quotas(slots.groupBy("source").agg(F.count("*").alias("quota")), shards, seed)
        .groupBy(F.col("source").alias("of"))
        .agg(F.sort_array(F.collect_list(F.struct("shard", "blocks"))).alias("dealt"))
    )
    deal = Window.partitionBy("source").orderBy(F.xxhash64("source", "block", "pass", F.lit("deal"), F.lit(seed)), "block", "pass")
    passed = F.aggregate(
        "dealt",
        F.struct(F.col("rank").cast("long").alias("rest"), F.lit(None).cast("int").alias("shard")),
        lambda a, d: F.struct(
            (a["rest"] - d["blocks"]).alias("rest"),
            F.when((a["rest"] > 0) & (a["rest"] <= d["blocks"]), d["shard"]).otherwise(a["shard"]).alias("shard"),
        ),
        lambda a: a["shard"],
    )
    sharded = settled(
        slots.withColumn("rank", F.row_number().over(deal))
        .join(cuts, F.col("source").eqNullSafe(F.col("of")))
        .select("source", "block", "pass", "room", "before", "partial", passed.alias("shard"))
    )
    whole = sharded.where("NOT partial").groupBy(F.col("source").alias("ws"), F.col("block").alias("wb")).agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("whole")
    )

    # what is missing where a block did not fit whole: documents of that block and of all after it
    last = sharded.where("partial").select(
        F.col("source").alias("ps"), F.col("before").alias("from"), "room", F.struct("pass", "shard").alias("part")
    )
    open_blocks = ordered.join(last, F.col("source").eqNullSafe(F.col("ps")) & (F.col("before") >= F.col("from"))).select(
        F.col("source").alias("os"), F.col("block").alias("ob"), "room", "part"
    )
    # rows alike count as one document of all their words
    units = settled(
        placed.join(open_blocks, F.col("source").eqNullSafe(F.col("os")) & (F.col("block") == F.col("ob")))
        .where("size > 0")
        .groupBy("source", "id", "size")
        .agg(F.count("*").alias("n"), F.first("room").alias("room"), F.first("part").alias("part"))
        .withColumn("weight", F.col("size") * F.col("n"))
        .where("weight <= room")
        .select("source", "id", "size", "weight", "room", "part")
    )
    wanted = settled(_filled(units.groupBy("source", "room", "weight").agg(F.count("*").alias("n"))))
    extra = _firsts(units, wanted, seed).select(
        F.col("source").alias("es"), F.col("id").alias("eid"), F.col("size").alias("esize"), "part"
    )
    return (
        placed.join(whole, F.col("source").eqNullSafe(F.col("ws")) & (F.col("block") == F.col("wb")), "left")
        .join(
            extra,
            F.col("id").eqNullSafe(F.col("eid")) & F.col("source").eqNullSafe(F.col("es")) & (F.col("size") == F.col("esize")),
            "left",
        )
        .select(
            "id",
            "source",
            "size",
            "source_size",
            "target",
            F.array_compact(F.array_append(F.coalesce("whole", F.array().cast("array<struct<pass:int,shard:int>>")), F.col("part"))).alias("taken_by"),
        )
    )


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``id_col``, ``size``, ``source_size``, ``target`` and ``taken`` (words the mix takes) of every row, and ``taken_by``."""
    return draws(docs, id_col=id_col, **options).select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("taken_by")).alias("taken"),
        "taken_by",
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 7, **options
) -> DataFrame:
    """The rows of the mix, with all columns of ``docs``: a row for each time it is taken, shuffled.

    Rows of a shard lie together by a hash of shard and place, in hashed order.
    """
    plan = (
        draws(docs, id_col=id_col, source_col=source_col, text_col=text_col, seed=seed, **options)
        .where(F.size("taken_by") > 0)
        .select(F.col("id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__size"), F.col("taken_by").alias("__by"))
        .distinct()
    )
    same = (
        docs[id_col].eqNullSafe(F.col("__id"))
        & docs[source_col].cast("string").eqNullSafe(F.col("__source"))
        & (words(docs[text_col]) == F.col("__size"))
    )
    taken = docs.join(plan, same).withColumn("__draw", F.explode("__by"))
    place = F.xxhash64("__id", F.col("__draw.pass"), F.lit("place"), F.lit(seed))
    return (
        taken.withColumn("__place", place)
        .repartition(F.col("__draw.shard"), F.shiftrightunsigned("__place", 56))
        .sortWithinPartitions(F.col("__draw.shard"), "__place")
        .select(*(taken[c] for c in docs.columns))
    )
