"""The corpus pipeline, stage by stage, against brute force."""

import brute
import corpus_pipeline as pipeline
from pyspark.sql import functions as F
from test_near_copies import components as similar_components

from snapcredit.llm.quality import quality_rules


def kept_text(text, docs):
    """A text without the repeated strings of the documents, and without characters that a cut went through."""
    raw = {d: t.encode() for d, t in docs}
    seen = {}
    for b in raw.values():
        for i in range(len(b) - 199):
            seen[b[i : i + 200]] = seen.get(b[i : i + 200], 0) + 1
    b = text.encode()
    gone = bytearray(len(b))
    for i in range(len(b) - 199):
        if seen[b[i : i + 200]] > 1:
            gone[i : i + 200] = b"\1" * 200
    return bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")


def test_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in quality_rules(docs).where("kept").collect()}
    known = [(d, rows[d].text) for d in sorted(good)]
    one_each = set(similar_components(known))
    kept = [(d, t) for d, t in known if d in one_each]
    expected = {d: kept_text(t, kept) for d, t in kept}
    for name, stage in pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == pipeline.COLUMNS
        assert {r.doc_id for r in docs.collect()} == (good if name == "quality_rules" else one_each)
    left = {r.doc_id: r for r in docs.collect()}
    assert {d: r.text for d, r in left.items()} == expected
    assert all(r.n_chars == len(r.text) and r.source == rows[d].source and r.lang == rows[d].lang for d, r in left.items())
    packed = pipeline.run(spark, sf_dir)
    words = {r.doc_id: r.n for r in packed.groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()}
    assert words == {d: len(brute.WORD.findall(t)) for d, t in expected.items()}


def test_hostile_rows(spark, hostile, sf_dir, tmp_path):
    for docs in (hostile.drop("n_words", "kept"), hostile.drop("n_words", "kept").limit(0)):
        for _, stage in pipeline.STAGES:
            path = str(tmp_path / f"{len(list(tmp_path.iterdir()))}")
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)


def test_cut_characters_go(spark):
    frame = spark.createDataFrame([(b"a\xc3\xa9b\xa9c\xe6\x97",), (b"",), (None,)], "kept binary")
    assert [r[0] for r in frame.select(pipeline.kept_text(F.col("kept"))).collect()] == ["aébc", "", None]
