"""A training-data pipeline of five stages over the table of documents.

Each stage reads what its predecessor wrote and returns the columns of the
documents, the last one their ids. ``run`` writes every stage as Parquet below
spark.checkpoint.dir, so that a stage never repeats the one before it.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import decontaminate, linefreq, lshforest, quality, spbpe
from ordermill.llm.queries import ACCEPTED, held_out
from ordermill.llm.tables import importable, lean, stored, table, unused


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the rows not held out."""
    labels = table(lean(spark), sf_dir, "labels").filter(~held_out())
    model = quality.fit(docs, labels, "doc_id", "text", "quality")
    score = unused(docs.columns, "_score")
    return (quality.scored(docs, "text", model, score).filter(F.col(score) >= ACCEPTED)
            .select(*docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; none goes, and ``n_chars``
    follows the text."""
    dropped = unused(docs.columns, "_dropped")
    short = linefreq.drop_boilerplate(docs, "source", "text", dropped=dropped)
    if "n_chars" in docs.columns:
        short = short.withColumn("n_chars", F.when(
            F.col(dropped) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return short.select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 0.8 on five-word shingles."""
    lean(spark)
    return lshforest.one_of_each(docs, "doc_id", "text", k=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any stretch of a benchmark item."""
    return decontaminate.clean(docs, "text", table(lean(spark), sf_dir, "benchmark"), "item_id", "text")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids (decimal, joined by spaces, with the end id) and the text they decode to."""
    lean(spark)
    return spbpe.encode_decode(docs.select("doc_id", "text"), "text",
                               public_tokenizers.path("piece_bpe_32k.model")).drop("text")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: SQL can't express the classifier, the alignment or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    docs = importable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs, _ = stored(stage(spark, docs, sf_dir), f"stage{at}")
    return docs
