"""Corpus pipeline: toxic and poor documents go, near copies and repeated strings go, the rest is packed.

Each stage reads what its predecessor kept (written as Parquet between them) and returns the columns of
``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.llm.common import materialise, read_table
from formtide.llm.jaccard import similarity_classes
from formtide.llm.packing import pack_documents
from formtide.llm.quality import drop_low_quality, learn_quality
from formtide.llm.queries import tokenizer_path
from formtide.llm.suffix_dedup import remove_repeats
from formtide.llm.toxicity import drop_toxic, learn_toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below one half (classifier chain)."""
    return drop_toxic(docs, learn_toxicity(docs, read_table(spark, sf_dir, "labels")))


def without_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a quality score of 0.3 or more (positive-unlabelled learning)."""
    return drop_low_quality(docs, learn_quality(docs, read_table(spark, sf_dir, "labels")))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that similarities of 0.8 connect, the document with the smallest id.

    Rows that share an id count as one document; a row without an id belongs to no group and stays.
    """
    gone = similarity_classes(docs).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("stays"))
    gone = gone.filter("NOT stays").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 50-byte strings that a document with a smaller id has (suffix arrays).

    A document of which nothing is left goes, unless it was empty before; ``n_chars`` counts what is left.
    Rows that share an id keep their own texts: the text before tells them apart.
    """
    cut = remove_repeats(docs, with_text=True, with_input=True).filter("n_removed > 0")
    cut = cut.select(F.col("doc_id").alias("_id"), F.col("input_sha256").alias("_input"), F.col("kept").alias("_kept"))
    cut = cut.dropDuplicates(["_id", "_input"])
    same = (F.col("doc_id") == F.col("_id")) & (F.sha2(F.coalesce("text", F.lit("")), 256) == F.col("_input"))
    joined = docs.join(cut, same, "left")
    text = F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.col("_kept"))
    size = F.when(F.col("_kept").isNull(), F.col("n_chars")).otherwise(F.length("_kept").cast("long"))
    left = joined.withColumns({"text": text, "n_chars": size} if "n_chars" in docs.columns else {"text": text})
    return left.filter(F.col("_kept").isNull() | (F.trim("_kept") != "")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids (harmonic packing)."""
    return pack_documents(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("quality", without_poor),
    ("near_copies", one_of_near_copies),
    ("repeated_strings", without_repeated_strings),
    ("packing", packed),
]

# Learned models, similarity classes and byte offsets have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
