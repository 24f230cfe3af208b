"""Quality rules: text statistics and robust multivariate outliers, in DataFrame expressions only.

Statistics of a text become a vector of ratios on log scales. For each language
and source the minimum-covariance-determinant estimate is found by
concentration steps from a robust start; rows far from its centre in its own
metric are rejected.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.settle import is_empty, is_small, settled

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
LINES = "__n_lines"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns STATS, LINES (lines with words), and ``base_failed``; a null text is empty. Equal names are replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    words = F.col("__words")
    windows = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        1,
        F.greatest(F.size(words) - 2, F.lit(0)),
    )
    sorted_ = F.col("__sorted")
    again = F.filter(
        sorted_, lambda p, k: (p["h"] == F.get(sorted_, k - 1)["h"]) | (p["h"] == F.get(sorted_, k + 1)["h"])
    )
    at = F.col("__at")
    covered = F.transform(at, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1), i + 3) - i))
    return (
        docs.withColumn("__words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
        .withColumn("__windows", windows)
        # the places of windows that occur again, found by sorting where there are any
        .withColumn(
            "__sorted",
            F.when(
                F.size(F.array_distinct("__windows")) < F.size("__windows"),
                F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
            ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
        )
        .withColumn("__at", F.sort_array(F.transform(again, lambda p: p["i"])))
        .withColumns(
            {
                "n_words": F.size("__words").cast("long"),
                "word_chars": F.length(F.array_join("__words", "")).cast("long"),
                "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
                LINES: F.size(lines).cast("long"),
                "n_repeat_words": F.aggregate(covered, F.lit(0), lambda a, n: a + n).cast("long"),
            }
        )
        .withColumn("base_failed", (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))
        .drop("__words", "__windows", "__sorted", "__at")
    )


#: Noise of each coordinate that is never held against a text, as a standard deviation. The last two lie in 0 to 1, as roots
#: of shares: a quarter is at 0.5, and beyond the cut-off by itself where a group has none.
FLOORS = (0.08, 0.3, 0.08, 0.08)
#: Squared distance that one of a million normal vectors of four coordinates exceeds.
CUTOFF = 33.4
#: Fall of the logarithm of the determinant below which a step changes nothing.
FALL = 1e-3
#: Rows below which a language and source are judged by the whole language, and a language by the whole corpus.
LEAST_ROWS = 50
#: Groups up to which their estimates are sent to all tasks; some 300 bytes each.
SENT_GROUPS = 10_000
_UNIT = 10_000
_P = len(FLOORS)
_Y = [f"__y{i}" for i in range(_P)]
_C = [f"__c{i}" for i in range(_P)]
_L = {(i, j): f"__l{i}{j}" for i in range(_P) for j in range(i + 1)}


def _vector() -> dict[str, Column]:
    """The transformed statistics, as whole numbers of 1 / _UNIT, so that their sums are exact."""
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    shown = (
        F.log(F.greatest(per_word("word_chars"), F.lit(1e-3))),
        F.log1p(100 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        F.sqrt(F.col("n_dup_lines") / F.greatest(F.col(LINES), F.lit(1))),
        F.sqrt(per_word("n_repeat_words")),
    )
    return {y: F.round(v * _UNIT).cast("long") for y, v in zip(_Y, shown)}


def _sent(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is small enough to be."""
    return F.broadcast(df) if is_small(df, SENT_GROUPS) else df


def _consistency(share: Column) -> Column:
    """What makes the covariance of the nearest ``share`` of normal rows that of all of them, for four coordinates."""
    most = F.least(share, F.lit(1 - 1e-9))
    # half the squared distance within which the share lies, by Newton's steps
    step = lambda x, _: F.least(F.lit(40.0), x - (1 - F.exp(-x) * (1 + x) - most) / (x * F.exp(-x)))
    within = lambda x: share / (1 - F.exp(-x) * (1 + x + x * x / 2))
    return F.when(share >= 1, F.lit(1.0)).otherwise(F.aggregate(F.sequence(F.lit(1), F.lit(6)), F.lit(1.7), step, within))


def _with_factor(moments: DataFrame) -> DataFrame:
    """Centre and Cholesky factor of covariance plus noise floor, and ``__det``, the logarithm of its root determinant."""
    n = F.col("n")
    mean = {i: F.col(f"s{i}") / n for i in range(_P)}
    out = moments.withColumns({_C[i]: mean[i] for i in range(_P)})
    for i in range(_P):
        for j in range(i + 1):
            value = (F.col(f"s{i}{j}") / n - F.col(_C[i]) * F.col(_C[j])) * F.col("__scale") / _UNIT**2
            if i == j:
                value = F.greatest(value, F.lit(0.0)) + FLOORS[i] ** 2
            value = reduce(lambda v, k: v - F.col(_L[i, k]) * F.col(_L[j, k]), range(j), value)  # noqa: B023
            value = F.sqrt(F.greatest(value, F.lit(1e-12))) if i == j else value / F.col(_L[j, j])
            out = out.withColumn(_L[i, j], value)
    det = reduce(lambda a, b: a + b, (F.log(_L[i, i]) for i in range(_P)))
    return settled(out.select("__group", *_C, *_L.values(), det.alias("__det")))


def _with_distance(rows: DataFrame) -> DataFrame:
    """``__d``: the squared Mahalanobis distance, by forward substitution."""
    for i in range(_P):
        rest = reduce(lambda v, k: v - F.col(_L[i, k]) * F.col(f"__z{k}"), range(i), (F.col(_Y[i]) - F.col(_C[i])) / _UNIT)  # noqa: B023
        rows = rows.withColumn(f"__z{i}", rest / F.col(_L[i, i]))
    total = reduce(lambda a, b: a + b, (F.col(f"__z{i}") * F.col(f"__z{i}") for i in range(_P)))
    return rows.withColumn("__d", total).drop(*(f"__z{i}" for i in range(_P)))


def _moments(rows: DataFrame) -> DataFrame:
    """Sums over the inner rows and, by the part of it that counts, the last bin; exact until the two are put together."""
    exact = lambda c: F.sum(c.cast("decimal(38,0)"))
    sums = {"n": F.lit(1)} | {f"s{i}": F.col(_Y[i]) for i in range(_P)} | {f"s{i}{j}": F.col(_Y[i]) * F.col(_Y[j]) for i, j in _L}
    inner = F.col("__bin") < F.col("__last")
    whole = {f"{k}_in": exact(F.when(inner, v).otherwise(0)) for k, v in sums.items()}
    edge = {f"{k}_at": exact(F.when(inner, 0).otherwise(v)) for k, v in sums.items()}
    both = lambda k: (F.col(f"{k}_in").cast("double") + F.col(f"{k}_at").cast("double") * F.col("__part")).alias(k)
    summed = rows.groupBy("__group", "__part", "__scale").agg(*(c.alias(k) for k, c in (whole | edge).items()))
    return settled(summed).select("__group", "__scale", *(both(k) for k in sums))


def _medians(rows: DataFrame) -> DataFrame:
    """A start: each coordinate's median, to a hundredth, with the noise floors as scale. Counts of values, not rows, meet."""
    step = _UNIT // 100
    values = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.round(F.col(y) / step).cast("int").alias("v")) for i, y in enumerate(_Y))))
    counted = rows.select("__group", values.alias("x")).groupBy("__group", "x.i", "x.v").agg(F.count("*").alias("n"))
    middle = counted.groupBy("__group", "i").agg(F.expr("percentile(v, 0.5, n)").alias("m"))
    start = middle.groupBy("__group").agg(*(F.max(F.when(F.col("i") == i, F.col("m") * step)).alias(_C[i]) for i in range(_P)))
    scale = {name: F.lit(FLOORS[i] if i == j else 0.0) for (i, j), name in _L.items()}
    return settled(start.withColumns(scale).withColumn("__det", F.lit(float("inf"))))


def estimates(rows: DataFrame) -> DataFrame:
    """Centre and factor of every ``__group`` of rows with the vector: the minimum-covariance-determinant estimate.

    Each step takes mean and covariance of the (n + p + 1) / 2 rows of a group
    that lie nearest in the metric so far, by a histogram of distances whose
    last bin counts by the part of it that is wanted, so that tied rows are not
    taken whole. Steps go on until the determinant of no group falls; the
    estimate of the least one is kept. All sums are partial sums of whole
    numbers, so the result does not depend on how rows are dealt.
    """
    best = _medians(rows)
    # no step has more groups than the first
    sent = F.broadcast if is_small(best, SENT_GROUPS) else lambda df: df
    best = best.withColumn("__falls", F.lit(True))
    while True:
        now = best.where("__falls").drop("__falls")
        placed = _with_distance(rows.join(sent(now), "__group")).withColumn("__bin", F.floor(F.log1p("__d") * 64))
        bins = placed.groupBy("__group", "__bin").agg(F.count("*").alias("k"))
        want = F.least(F.col("all").cast("double"), (F.col("all") + _P + 1) / 2)
        # the bins of a group are few: the logarithm bounds them
        nearest = (
            bins.groupBy("__group")
            .agg(F.sort_array(F.collect_list(F.struct("__bin", "k"))).alias("h"), F.sum("k").alias("all"))
            .select(
                "__group",
                _consistency(want / F.col("all")).alias("__scale"),
                F.aggregate(
                    "h",
                    F.struct(F.lit(0).cast("long").alias("sum"), F.lit(None).cast("long").alias("bin"), F.lit(0.0).alias("part")),
                    lambda a, b: F.struct(
                        (a["sum"] + b["k"]).alias("sum"),
                        F.when(a["sum"] < want, b["__bin"]).otherwise(a["bin"]).alias("bin"),
                        F.when(a["sum"] < want, F.least(F.lit(1.0), (want - a["sum"]) / b["k"])).otherwise(a["part"]).alias("part"),
                    ),
                ).alias("__edge"),
            )
            .select("__group", "__scale", F.col("__edge.bin").alias("__last"), F.col("__edge.part").alias("__part"))
        )
        inner = placed.join(sent(settled(nearest)), "__group").where("__bin <= __last")
        stepped = _with_factor(_moments(inner))
        values = [*_C, *_L.values(), "__det"]
        named = stepped.select(F.col("__group").alias("__of"), *(F.col(c).alias(f"{c}_now") for c in values))
        falls = F.coalesce(F.col("__det_now") < F.col("__det") - FALL, F.lit(False))
        best = settled(
            best.join(sent(named), F.col("__group") == F.col("__of"), "left").select(
                "__group", *(F.when(falls, F.col(f"{c}_now")).otherwise(F.col(c)).alias(c) for c in values), falls.alias("__falls")
            )
        )
        if is_empty(best.where("__falls")):
            return best.drop("__falls")


def _measured(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """``docs`` with statistics, vector and the names of its own group and its pool."""
    return (
        with_statistics(docs, text_col)
        .withColumns(_vector())
        .withColumn("__own", F.to_json(F.struct(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))))
        .withColumn("__pool", F.to_json(F.array(F.coalesce(F.col(lang_col).cast("string"), F.lit("")))))
    )


def _judged(measured: DataFrame, fitted: DataFrame) -> DataFrame:
    """``measured`` with ``kept``, by estimates from the rows of ``fitted``."""
    sizes = settled(fitted.groupBy("__own", "__pool").agg(F.count("*").alias("n")))
    pools = settled(sizes.groupBy("__pool").agg(F.sum("n").alias("total"), F.min("n").alias("least")).withColumnRenamed("__pool", "of"))
    own, pool = F.col("n") >= LEAST_ROWS, F.col("total") >= LEAST_ROWS
    everyone = F.lit("*" if not is_empty(pools.where(~pool)) else None)
    levels = settled(
        sizes.join(pools, sizes["__pool"] == pools["of"]).select(
            F.col("__own").alias("__named"),
            F.when(own, F.col("__own")).when(pool, F.col("__pool")).otherwise(F.lit("*")).alias("__group"),
            # the estimates that its rows count in
            F.array_compact(
                F.array(F.when(own, F.col("__own")), F.when(pool & (F.col("least") < LEAST_ROWS), F.col("__pool")), everyone)
            ).alias("__groups"),
        )
    )
    named = lambda df: df.join(_sent(levels), df["__own"] == F.col("__named"), "left")
    rows = settled(named(fitted).select(F.explode("__groups").alias("__group"), *_Y))
    placed = _with_distance(named(measured).join(_sent(estimates(rows)), "__group", "left"))
    far = F.coalesce(F.col("__d") > CUTOFF, F.lit(False))
    return placed.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(~far))


def judged(
    docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """``id_col``, the statistics, ``base_failed`` and ``kept`` of every row.

    Rows that fail the base rules (under 50 words, or more than half of them in
    repeated three-word windows) are rejected and do not count in estimates.
    Null languages and sources are values of their own. Groups under LEAST_ROWS
    rows are judged by all rows of their language, and by the whole corpus where these are too few.
    Null texts are empty and fail. Ids may be null or repeat. An empty table
    gives no rows.
    """
    seen = docs.select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text")
    )
    measured = settled(_measured(seen, "lang", "source", "text").drop("text", "lang", "source"))
    return _judged(measured, measured.where("NOT base_failed")).select(
        F.col("id").alias(id_col), *STATS, "base_failed", "kept"
    )


def passing(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns."""
    clear = docs.select(F.struct("*").alias("__row"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    measured = _measured(clear, "lang", "source", "text")
    # kept before it is filtered: a filter would be pushed into the statistics and repeat them
    fitted = settled(measured.select("base_failed", "__own", "__pool", *_Y)).where("NOT base_failed")
    return _judged(measured, fitted).where("kept").select("__row.*")
