"""One query per operator, over its whole table, and SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapcredit.llm.bpe import encode_decode
from snapcredit.llm.collocations import collocations
from snapcredit.llm.html_text import extract_main_text
from snapcredit.llm.importance import resample
from snapcredit.llm.licences import scan_licences
from snapcredit.llm.neighbours import nearest
from snapcredit.llm.oracles import ORACLES  # noqa: F401
from snapcredit.llm.packing import pack
from snapcredit.llm.quality import quality_rules
from snapcredit.llm.simhash import near_duplicates
from snapcredit.llm.substring_dedup import drop_repeated_windows
from snapcredit.llm.suffix_dedup import drop_repeated_strings
from snapcredit.llm.token_counts import section_tokens
from snapcredit.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def digest(column: str) -> Column:
    return F.sha2(F.col(column).cast("binary"), 256)


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query
def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return done.select(
        "doc_id", "n_tokens", digest("ids").alias("ids_sha256"), digest("decoded").alias("decoded_sha256")
    )


@query
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("failed", ",").alias("failed"),
    )


@query
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("licences")
    return scan_licences(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.size(found).cast("long").alias("n_passages"),
        F.array_join(F.array_sort(F.array_distinct(found["licence"])), ",").alias("licence_names"),
        F.coalesce(F.array_min(found["line"]), F.lit(-2)).cast("long").alias("first_line"),
        F.coalesce(F.array_max(found["dice"]), F.lit(0.0)).alias("best_dice"),
    )


@query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeated_strings(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        digest("kept").alias("kept_sha256"),
    )


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = drop_repeated_windows(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", digest("kept_text").alias("kept_sha256"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("spans").cast("long").alias("n_spans"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query
def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
