"""Training corpus from raw documents: good ones, without copies, near copies and test items, as pieces.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes
each as Parquet to the shared folder and reads it again for the next, so a lost
executor costs no more than the stage at hand. Tables that a stage needs for
itself, and its input, are deleted once its result is written.
"""

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import decontaminate, exact_dedup, pieces, quality, simhash
from shelfline.llm.base import discard_written, written, written_so_far
from shelfline.llm.queries import table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_copies(docs)


def distant_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component, the document with the least doc_id."""
    return simhash.keep_firsts(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item was found."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of each document, and whether decoding them gives its text back."""
    return pieces.checked_documents(docs)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", different_documents),
    ("simhash near-dedup", distant_documents),
    ("benchmark decontamination", clean_documents),
    ("sentencepiece", encoded_documents),
]

#: The classifier, the fingerprints and the pieces have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of documents."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        before = written_so_far()
        docs = written(stage(spark, docs, sf_dir), f"stage{number}")
        discard_written(spark, max(0, before - (number > 1)), but_last=True)  # its own tables and its input
    return docs
