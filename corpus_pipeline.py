"""From raw documents to packed token sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and gives the documents that it keeps, with their columns;
the last one gives the pieces of the sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.llm.common import read_table, stored
from sheetspark.llm.decontaminate import without_contaminated
from sheetspark.llm.language import labelled_windows, train, with_known_language
from sheetspark.llm.line_dedup import without_repeats
from sheetspark.llm.near_duplicates import without_near_duplicates
from sheetspark.llm.packing import pack


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; learned from the labelled ones among them.

    A null or empty text, or one without a letter, goes.
    """
    return with_known_language(docs, train(labelled_windows(docs)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that stand earlier, ``n_chars`` to match.

    A document of which nothing but white space is left goes; a null text stays.
    """
    cleaned = without_repeats(docs)
    gone = (F.col("__removed") > 0) & (F.col("text").rlike(r"^\s*$"))
    kept = cleaned.where(~F.coalesce(gone, F.lit(False)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.when(F.col("__removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", length.cast(kind))
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, similarity 0.8."""
    return without_near_duplicates(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL can't express the network of the first stage; a brute-force version is tested instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
