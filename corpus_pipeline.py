"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. All but the last return
the columns of documents. A stage's result is written as Parquet to the shared folder and read again
as the next one's docs, so that lost executors re-read files instead of repeating stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievetally.llm import jaccard_tree, packing, pii, toxicity
from sievetally.llm.common import as_row, from_row, small_batches, table
from sievetally.llm.queries import PACK_FILE, identify_languages, toxicity_model
from sievetally.session import cut_lineage, pin_settings


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus: those whose language is undetermined or too unsure go."""
    small_batches(pin_settings(spark))
    return from_row(identify_languages(docs, keep_rows=True).where("NOT rejected"), docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(as_row(docs).alias("row"), toxicity.toxicity(model, docs, F.col("text")).alias("score"))
    return from_row(scored.where("score < 0.5"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    small_batches(pin_settings(spark))
    return jaccard_tree.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    pin_settings(spark)
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 1024: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    small_batches(pin_settings(spark))
    with open(public_tokenizers.path(PACK_FILE), encoding="utf-8") as file:
        return packing.pack_documents(docs, file.read(), public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

# Models and packing are not to be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, beginning with the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
