"""Conversations as one marked-up text each, with a loss mask, in Spark expressions only.

Template: ``<|im_start|>`` role newline texts ``<|im_end|>`` newline for each run
of turns of one role; the texts of a run are parted by ``<|im_sep|>``.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    """``text`` without ``<|``: one more backslash goes between ``<`` and ``|``, whatever backslashes are there."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``."""
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _role_escaped(role: Column) -> Column:
    """A role on one line."""
    return F.replace(escaped(role), F.lit("\n"), F.lit(NEWLINE))


def _role_unescaped(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def formatted(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``formatted`` and ``loss_spans`` of every conversation.

    Turns are taken in order of ``turn_col`` (null first; ties by role, then
    text). Null roles and texts are empty. A null id is a conversation of its
    own. Control strings inside roles and texts are escaped reversibly.
    ``loss_spans`` holds start and length, in code points of ``formatted`` from 0,
    of the escaped text of every assistant turn, in order. Other columns are not
    looked at. Roles and texts are escaped and measured before the shuffle.
    """
    rows = conversations.select(
        F.col(id_col).alias("id"),
        F.col(turn_col).alias("turn"),
        _role_escaped(F.coalesce(F.col(role_col).cast("string"), F.lit(""))).alias("role"),
        escaped(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"),
    )
    # each turn's part of the text and where it starts, so that nothing is added up inside a conversation's row
    order = Window.partitionBy("id").orderBy("turn", "role", "text")
    opens = ~F.lag("role").over(order).eqNullSafe(F.col("role"))
    closes = ~F.lead("role").over(order).eqNullSafe(F.col("role"))
    before = F.coalesce(F.sum(F.length("part")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = (
        rows.withColumns({"opens": opens, "closes": closes})
        .withColumn("head", F.when(F.col("opens"), F.concat(F.lit(START), "role", F.lit("\n"))).otherwise(F.lit(SEP)))
        .withColumn("part", F.concat("head", "text", F.when(F.col("closes"), END + "\n").otherwise("")))
        .withColumn("at", before)
    )
    span = F.struct((F.col("at") + F.length("head")).cast("int").alias("start"), F.length("text").alias("length"))
    told = F.struct("at", "part", F.when(F.col("role") == ASSISTANT, span).alias("span"))
    return (
        parts.groupBy("id")
        .agg(F.sort_array(F.collect_list(told)).alias("told"))
        .select(
            F.col("id").alias(id_col),
            F.array_join(F.transform("told", lambda t: t["part"]), "").alias("formatted"),
            F.array_compact(F.transform("told", lambda t: t["span"])).alias("loss_spans"),
        )
    )


def turns_of(text: Column) -> Column:
    """Role and text of every turn, read back from a formatted text."""
    blocks = F.split(text, r"<\|im_end\|>\n")
    whole = F.slice(blocks, 1, F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        texts = F.split(F.substr(block, F.length(role) + 2), r"<\|im_sep\|>")
        said = _role_unescaped(F.substr(role, F.lit(len(START) + 1)))
        return F.transform(texts, lambda t: F.struct(said.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(whole, turns))


def loss_text(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped: each assistant text once, in order, nothing between.

    Spans are cut out of four bytes a code point, where a place is found without counting
    up to it. A letter before each keeps a mark at its start from being read as a byte order.
    """
    first = F.encode(F.lit("x"), "UTF-32")
    cut = lambda wide, s: F.concat(first, F.substr(wide, s["start"] * 4 + 1, s["length"] * 4))
    plain = lambda wide, s: unescaped(F.substr(F.decode(cut(wide, s), "UTF-32"), F.lit(2)))
    joined = lambda wide: F.array_join(F.transform(spans, lambda s: plain(wide, s)), "")
    return F.get(F.transform(F.array(F.encode(text, "UTF-32")), joined), F.lit(0))


def read_back(made: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digests of what formatted conversations hold, taken from the formatted texts and their masks alone."""
    turns = turns_of(F.col("formatted"))
    return (
        made.withColumn("read", turns)
        .withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans")))
        .select(
            id_col,
            F.size("read").cast("long").alias("n_turns"),
            F.sha2(
                F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
                256,
            ).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
        )
    )
