"""A corpus made ready for training, stage by stage.

Each stage takes all that its predecessor kept, as written to Parquet and read
again, and all but the last return the columns of ``documents``.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import bpe, minhash, mixing, quality, suffix
from skyledger.sinks import files
from skyledger.sinks.shared import new_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust outlier rule reject go, null and empty texts among them.

    Ids do not matter: null and repeated ones stay where their texts pass.
    """
    return quality.passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 or more.

    Rows with a null id stay. Rows that repeat an id belong together and stay or go together.
    """
    return minhash.drop_near_duplicates(docs, size=5, percent=80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes or more that occur earlier are cut out of the texts; the length column follows.

    All rows stay. Rows that repeat an id, or have none, are judged apart; of rows that repeat id and text one keeps its text.
    """
    cut = suffix.drop_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights: a document has a row for each time it is taken.

    Null ids and sources are values like others; rows alike in id, source and size are taken together.
    """
    return mixing.mixed_documents(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it. A null text has no ids; ids of documents may be null or repeat."""
    coded = bpe.encoded(docs.select("doc_id", "lang", "source", "text"), check_col="decodes")
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decodes")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("source_mix", source_mix),
    ("bpe_tokens", bpe_tokens),
]

#: SQL cannot express the estimates, the draws and the merges of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each but the last written to the shared folder and read again.

    A stage's folder goes when the next one's is written. Empty tables give no rows;
    null and repeated ids, null texts and extra columns pass as each stage says.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    earlier = None
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if earlier is not None:
            files.remove(spark, earlier)
        docs, earlier = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
