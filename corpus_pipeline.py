"""From raw documents to packed training sequences: quality rules, near-duplicates, repeats, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and gives the next one's documents; the last gives the pieces of sequences.
Documents with null or empty text fail the quality rules. An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm import decontaminate, near_dedup, packing, repetition, suffix_dedup
from duelframe.llm.storage import Stored, documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return repetition.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.keep_one(spark, docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of earlier documents; documents that lose everything go, n_chars follows the text.

    Rows without doc_id pass as they are, a null text as an empty one.
    """
    left = suffix_dedup.remove_repeats(spark, docs, carry=True).where("n_removed = 0 or n_removed < n_bytes")
    length = F.char_length("kept_text")
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"),
               "n_chars": length.cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return left.select(*(columns.get(c, F.col(f"carried_{c}")).alias(c) for c in docs.columns))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    return packing.pack_added(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup_stage), ("suffix_dedup", suffix_dedup_stage),
          ("decontaminate", decontaminate_stage), ("packing", packing_stage)]

#: Suffix arrays, MinHash, BM25 and tokenizers are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, store = documents(spark, sf_dir), Stored(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = store.save(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
