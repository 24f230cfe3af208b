"""Write to a database table over JDBC."""

from pyspark.sql import DataFrame

from skyledger.functions.text import table_identifier

# Rows per insert batch and most parallel connections, now and in
# the older settings.
WRITE_DEFAULTS = {"batchsize": "50000", "numPartitions": "20"}
OLDER_WRITE_DEFAULTS = {"batchsize": "10000", "numPartitions": "10"}


def jdbc_options(
    url: str, user: str, password: str, driver: str, **overrides: str
) -> dict[str, str]:
    """Connection and write options as Spark takes them."""
    return {
        "url": url,
        "user": user,
        "password": password,
        "driver": driver,
        **WRITE_DEFAULTS,
        **{name: str(value) for name, value in overrides.items()},
    }


def write_jdbc(df: DataFrame, options: dict[str, str], table: str, replace: bool = False) -> None:
    """Append the frame's columns, the database filling any others, or replace the table.

    ``numPartitions`` caps the connections by merging tasks before the write, and so
    also caps how many tasks compute the rows: for an expensive frame write it to
    files first and append from there. Each task commits its own rows, so an append
    that failed half-way must be cleared in the database before it is run again;
    ``replace`` drops and creates the table with the frame's types, which makes the
    write repeatable.
    """
    (
        df.write.format("jdbc")
        .options(**options)
        .option("dbtable", table_identifier(table))
        .mode("overwrite" if replace else "append")
        .save()
    )
