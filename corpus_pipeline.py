"""From raw documents to packed training sequences, in five stages of the corpus operators.

Each stage takes all that the one before it kept. Documents, with their columns, go in and out of every stage but the
last, which returns the places of their pieces in the sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcspark import files
from cdcspark.llm import decontaminate, langid, neardup, packing, pii
from cdcspark.llm.common import read_table, vocabulary
from cdcspark.session import fresh_dir, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents near a language that their labels teach; those without a label get the one found.

    The model learns from the rows that ``op2`` may learn from. Texts without letters, and texts too far from every
    centroid, go.
    """
    docs = docs.select(*COLUMNS)
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs, model).where("NOT rejected")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of every group of near-duplicates. Rows without an id stay.

    A row is named by its id and its text's hash, so a copy takes no other text of the same id with it.
    """
    docs = docs.select(*COLUMNS)
    gone = neardup.near_duplicates(docs, text_hash=True).where("NOT kept AND doc_id IS NOT NULL")
    return neardup.without_rows(docs, written(gone.select("doc_id", "text_hash").distinct(), "near-copies"))


def clear_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that a benchmark's windows contaminate."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data, plain or in disguise, replaced by its kind; n_chars follows the text."""
    masked = pii.mask(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    # Workers go on from stage to stage, so what they remember is kept smaller than where packing is all they do.
    return packing.pack(packing.tokenize(docs, vocabulary("word_bpe_49k.json"), most_words=250_000))


STAGES = [
    ("language", known_language),
    ("near_dedup", without_near_copies),
    ("decontaminate", clear_of_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]

#: A trained model, transducers and a packing are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read by the next one, after which it is removed."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = fresh_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            files.remove(spark, before)
        before = path
    return docs
