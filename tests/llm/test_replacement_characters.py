"""Replacement characters of the input stay through passage dedup; bytes of cut characters go."""

import corpus_pipeline as pipeline
from pyspark.sql import functions as F


def test_replacement_characters_stay(spark):
    raw = ["a�b".encode(), "a�".encode() + b"\xe6\x97" + "�b".encode(), b"\x01b\x01a\x01", "\x01�".encode() + b"\xa9"]
    frame = spark.createDataFrame([(n, r) for n, r in enumerate(raw)], "n int, kept binary")
    got = {r.n: r.text for r in frame.select("n", pipeline.kept_text(F.col("kept")).alias("text")).collect()}
    assert [got[n] for n in range(len(raw))] == [r.decode("utf-8", "ignore") for r in raw]
    assert got[0] == "a�b"


def test_stage(spark):
    rows = [(n, f"some text {n} � here", "en", "s", 0) for n in range(3)]
    done = pipeline.passage_dedup_stage(spark, spark.createDataFrame(rows, pipeline.COLUMNS), "").collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in done} == {(n, t, len(t)) for n, t, *_ in rows}
