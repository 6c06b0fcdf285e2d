"""From raw documents to packed sequences: five stages, each on what the one before it kept.

All stages keep the rows' columns, whatever their names, but for the last, which has its own.  Null texts count as empty;
empty ones are judged, compared and packed like others.  Rows that repeat an id with the same text are one document, with
another text they are others.  An empty table gives an empty one.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordloom.llm import decontaminate, packing, paragraphs, simhash, toxicity
from recordloom.llm.queries import THRESHOLD, vocabulary
from recordloom.llm.scratch import Scratch
from recordloom.runtime import table


ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Texts that go to a Python worker at a time; each batch is held several times over, on either side.
BATCH = 1000


def _in_small_batches(stage):
    """The stage, in a session whose Arrow batches have at most BATCH rows; they do not change what it gives."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(ROWS)) <= BATCH:
            spark.conf.set(ROWS, BATCH)
        return stage(spark, docs, sf_dir)

    return run_stage


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel classifier scores as toxic go; it learns from all labelled documents."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), F.lit(True), THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    SimHash over distinct runs of five words proposes pairs: of 768 bits in 32-bit bands, hashed by balls of radius 3, a
    pair at a Jaccard similarity of 0.8 shares one with a probability of 0.9994.  36 of the 128 bits beside the band is far
    above the 19 such a pair is expected to differ in.  The exact Jaccard similarity decides."""
    return simhash.keep_one(docs, shingle=5, words=12, width=32, radius=36, similarity=0.8)


def repeated_paragraphs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicate paragraphs only the first stays."""
    return paragraphs.drop_repeated_paragraphs(docs, shingle=5, similarity=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary(), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_paragraphs),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]
STAGES = [(name, _in_small_batches(stage)) for name, stage in STAGES]

#: SQL cannot express the stages; tests/llm compares them with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
