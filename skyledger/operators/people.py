"""Payload bodies to people, and people to sentences."""

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import schemas

FALLBACK_NUMBER = len(schemas.FALLBACK_PEOPLE)


def fallback_people() -> Column:
    """The constant list that stands in for an unreadable payload."""
    return F.array(
        *[
            F.struct(F.lit(craft).alias("craft"), F.lit(name).alias("name"))
            for craft, name in schemas.FALLBACK_PEOPLE
        ]
    )


def with_payload(df: DataFrame, body_col: str = "body") -> DataFrame:
    """Add ``number``, ``people`` and ``used_fallback`` read from a JSON body.

    A body counts as readable when it is one JSON object that has both keys. NULL,
    empty, broken or truncated text, text after the object, or a missing key gives
    the whole fallback list. A key that is there with a null value is kept as NULL.
    """
    body = F.col(body_col)
    # Parsing the body as the single element of an array rejects text after the object,
    # which the parser would otherwise pass over.
    parsed = F.from_json(
        F.concat(F.lit("["), body, F.lit("]")),
        f"array<{schemas.PAYLOAD.simpleString()}>",
        {"allowSingleQuotes": "false"},
    )
    keys = F.json_object_keys(body)
    readable = F.coalesce(
        (F.array_size(parsed) == 1)
        & F.array_contains(keys, "number")
        & F.array_contains(keys, "people"),
        F.lit(False),
    )
    payload = F.try_element_at(parsed, F.lit(1))
    return (
        df.withColumn("used_fallback", ~readable)
        .withColumn(
            "number", F.when(readable, payload["number"]).otherwise(F.lit(FALLBACK_NUMBER))
        )
        .withColumn("people", F.when(readable, payload["people"]).otherwise(fallback_people()))
    )


def explode_people(df: DataFrame) -> DataFrame:
    """One row per listed person with ``craft`` and ``name``; an empty list gives none.

    A plain ``inline`` would make the optimizer filter on the list's size first, and
    parse every body a second time for it. The outer form does not, and the position
    tells the row of an empty list from the row of a missing person.
    """
    others = [name for name in df.columns if name != "people"]
    return (
        df.select(*others, F.posexplode_outer("people").alias("position", "person"))
        .where(F.col("position").isNotNull())
        .select(*others, "person.craft", "person.name")
    )


def with_sentence(df: DataFrame, greeting: str = schemas.GREETING) -> DataFrame:
    """Add the sentence for each person; NULL where craft or name is missing."""
    return df.withColumn(
        "sentence",
        F.concat(
            F.col("name"),
            F.lit(" is currently in space flying on the "),
            F.col("craft"),
            F.lit("! "),
            F.lit(greeting),
        ),
    )


def people_counts(df: DataFrame) -> DataFrame:
    """Replace ``people`` by its length beside ``number``, and say whether they agree."""
    return (
        df.withColumn("listed", F.coalesce(F.array_size("people"), F.lit(0)))
        .withColumn("counts_agree", F.col("number").eqNullSafe(F.col("listed")))
        .drop("people")
    )
