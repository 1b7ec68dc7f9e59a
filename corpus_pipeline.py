"""A training-data pipeline over ``documents``: five stages, each stored and read by the next.

A stage is a function of (spark, docs, sf_dir).  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.llm import exact_dedup, langid, mixing, near_copies, pieces
from hourmart.llm.common import Scratch, tuned
from hourmart.llm.queries import VOCABULARY, language_model, table

#: A text is rejected if its language explains a smaller share of its trigrams.
LEAST_LANGUAGE_SCORE = 0.2


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language; those without letters, or that no language explains, go."""
    tuned(spark)
    found = langid.predict(docs, language_model(docs))
    wanted = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return wanted.select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of equal ones."""
    tuned(spark)
    return exact_dedup.content_sort(docs).where("kept").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest identifier of each group of near copies.

    Near copies share four fifths of their 5-word shingles, or have SimHash fingerprints linked as in
    ``simhash.near_duplicates``.  Rows that repeat this identifier stay with it.
    """
    tuned(spark)
    found = near_copies.near_copies(docs, by_prints=True)
    return found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and cut documents so that sources meet their targets."""
    tuned(spark)
    return mixing.mixed_rows(mixing.mix(docs)).select(*docs.columns)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode all texts; ``round_trip`` says whether decoding gives the text again.

    The ids are stored before they are decoded: in one step each core would hold the
    Python workers of both, beside the vocabulary and the words that encoding remembers.
    """
    tuned(spark)
    scratch = Scratch(spark, "pieces-stage")
    known = pieces.load_pieces(VOCABULARY)
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    encoded = scratch.store(pieces.encode(hashed, known, keep=["doc_id", "source", "text_hash"]), "encoded")
    return pieces.decode(encoded, known).select(
        "doc_id",
        "source",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("decoded").eqNullSafe(F.col("text_hash")).alias("round_trip"),
        "ids",
    )


STAGES = [
    ("language", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("pieces", pieces_stage),
]

#: SQL has no n-gram filters, XXH64 or piece vocabularies; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; every stage but the last is stored for the next."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = scratch.store(docs, name)
    return docs
