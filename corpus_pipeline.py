"""A training corpus from raw documents: quality rules, near-dedup, passage dedup, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.llm.near_copies import near_copies
from snapcredit.llm.packing import pack
from snapcredit.llm.quality import keep_good
from snapcredit.llm.simhash import keep_one
from snapcredit.llm.suffix_dedup import drop_repeated_strings
from snapcredit.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def kept_text(kept: Column) -> Column:
    """UTF-8 text of the kept bytes without the characters that a cut went through.

    What is not valid becomes U+FFFD and goes; those of the text itself are written otherwise meanwhile."""
    text = kept.cast("string")
    for plain, escaped in (("\x01", "\x01a"), ("\ufffd", "\x01b")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    text = F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))
    for plain, escaped in (("\ufffd", "\x01b"), ("\x01", "\x01a")):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return keep_good(docs).select(COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, Jaccard similarity 0.8 or more.

    Candidates are SimHash fingerprints within four bits, then MinHash bands; the similarity itself decides."""
    return keep_one(docs, near_copies).select(COLUMNS)


def passage_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated 200-byte strings; a character that is cut goes whole.

    A text that nothing is left of stays, as an empty one."""
    done = drop_repeated_strings(docs, keep=["lang", "source"])
    done = done.withColumn("text", kept_text(F.col("kept")))
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_array_dedup", passage_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: Near copies and their components have no SQL form; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from `documents` on, each written as Parquet and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
