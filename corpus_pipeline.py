"""From raw documents to packed sequences: five stages, each one operator of ``anemos.llm``.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
Between stages the documents are a table in the shared folder, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from anemos.llm import exact_dedup, mixing, packing, quality_classifier, simhash
from anemos.llm.queries import table, tokenizer_path
from anemos.session import delete_path, scratch_path, scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps, by id and text.

    Null texts are empty and weigh nothing; null ids have no label; rows that repeat an id and its text stay or go together.
    Without good labels, or with no documents, all stay. Texts are read whole, columns of any name go through.
    """
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id; of null ids alone all stay.

    Null texts equal empty ones. Two texts under one id are judged each by its own group, and repeats of the row that stays stay with
    it. No documents give none; texts are compared whole, columns of any name go through.
    """
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the smallest id, null ids last, then the smallest hash of the text.

    Texts without words, null ones too, have one fingerprint and are linked like any others. Repeats of the row that stays
    stay with it. No documents give none; texts are read whole, columns of any name go through.
    """
    return simhash.drop_near_duplicates(docs, shingle=3, distance=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once per pass, in the order of its slots.

    Texts without words, null ones too, take no place and go. Null sources are one source; null and repeated ids and repeated
    rows are documents of their own. The last copy of a source may be cut, joined by single spaces. No documents give none; columns of any name go through.
    """
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the packed sequences.

    A null text is an empty one and still has its end id; null and repeated ids and repeated rows are documents of their own.
    Long texts are cut into pieces. No documents give no rows; other columns are not read.
    """
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", quality), ("exact_dedup", exact), ("simhash_near_dedup", near),
    ("source_mixing", mix), ("best_fit_packing", pack),
]

# The classifier, the fingerprints and the tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``. What a stage wrote is deleted when the next one is written; the tables that
    the last one reads stay, as the result does."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            delete_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
