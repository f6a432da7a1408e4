"""From raw documents to packed sequences, in five stages.

Each stage works on what the one before kept and returns the columns of
``documents``; the last one returns the pieces and their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seatledger.llm import decontamination, jaccard, lines, packing, toxicity
from seatledger.llm.common import read
from seatledger.llm.queries import tokenizer_file
from seatledger.sources.workspace import workspace


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text scores below 0.5; the model learns from ``labels`` and these documents."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that stand on many sites (their first occurrence stays)."""
    cleaned = lines.remove_widespread(docs)
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", length).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest ``doc_id``.

    Documents without words, and those without ``doc_id``, belong to no group
    and stay.  Rows of one ``doc_id`` go only if none of them is kept; of rows
    that repeat ``doc_id`` and text one stays.
    """
    found = jaccard.near_duplicates(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    gone = found.filter("NOT kept").alias("g")
    kept = docs.alias("d").join(gone, F.col("d.doc_id") == F.col("g.doc_id"), "left_anti").select("d.*")
    again = "_again"
    while again in docs.columns:
        again += "_"
    number = F.row_number().over(W.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id"))
    once = kept.filter("doc_id IS NOT NULL").withColumn(again, number).filter(F.col(again) == 1)
    return once.select(*docs.columns).union(kept.filter("doc_id IS NULL"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences."""
    return packing.packed(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: A trained model, a sampled join and a tokenizer decide here; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = workspace(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
