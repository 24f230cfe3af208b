"""The people job: stored payload bodies to one sentence per listed person."""

from pyspark.sql import DataFrame

from skyledger import schemas
from skyledger.operators.people import explode_people, with_payload, with_sentence


def people(bodies: DataFrame, body_col: str = "body") -> DataFrame:
    """People listed in each body, or the fallback people."""
    return explode_people(with_payload(bodies, body_col).drop(body_col, "number"))


def sentences(
    bodies: DataFrame, body_col: str = "body", greeting: str = schemas.GREETING
) -> DataFrame:
    """One sentence per person; a map over the bodies with no shuffle."""
    return with_sentence(people(bodies, body_col), greeting)
