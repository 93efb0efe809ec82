"""Texts of several MB in every operator on documents, beside short ones."""

import hashlib

import corpus_pipeline as pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from snapcredit.llm.bpe import encode_decode
from snapcredit.llm.licences import TEMPLATES, scan_licences
from snapcredit.llm.packing import pack
from snapcredit.llm.quality import quality_rules
from snapcredit.llm.simhash import fingerprint, near_duplicates
from snapcredit.llm.substring_dedup import drop_repeated_windows
from snapcredit.llm.suffix_dedup import drop_repeated_strings

WORDS = 400_000


def invented(seed, n):
    """Words of letters by number, none twice: about ten bytes a word."""
    letters = np.array(list("abcdefghijklmnop"))
    numbers = np.random.default_rng(seed).permutation(n) + seed * 10_000_000
    digits = (numbers[:, None] >> (4 * np.arange(8))) & 15
    return ["".join(row) for row in letters[digits]]


PASSAGE = " ".join(invented(7, 60))


@pytest.fixture(scope="module")
def texts():
    """A text of 3.6 MB with a passage twice and a licence, one of a single word, one line, and a short one with the passage."""
    words = invented(1, WORDS)
    for at in range(30, WORDS, 40):
        words[at] += ".\n"
    half = WORDS // 2
    long = " ".join([*words[:half], PASSAGE, *words[half:], PASSAGE]) + "\n\n" + TEMPLATES["MIT-text"]
    return {1: long, 2: "x" * 3_000_000, 3: "short " + PASSAGE + " text", 4: None}


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(d, t, "en", "s", len(t or "")) for d, t in texts.items()]
    return spark.createDataFrame(rows, pipeline.COLUMNS).repartition(2).cache()


def test_strings(docs, texts):
    got = {r.doc_id: r for r in drop_repeated_strings(docs).collect()}
    # The passage three times, with what little is the same before and after it; one run of x.
    removed = {d: r.n_bytes - len(r.kept) for d, r in got.items()}
    assert removed[2] == 3_000_000 and removed[4] == 0
    assert len(PASSAGE) <= removed[3] <= len(PASSAGE) + 10 and 2 * len(PASSAGE) <= removed[1] <= 2 * len(PASSAGE) + 20
    assert len(got[1].spans) == 2 and got[1].n_bytes == len(texts[1].encode())


def test_windows(docs, texts):
    got = {r.doc_id: r for r in drop_repeated_windows(docs).collect()}
    words = texts[1].split()
    kept = words[: WORDS + 60] + words[WORDS + 120 :]
    assert got[1].n_removed == 60 and got[1].kept_text == " ".join(kept)
    assert got[3].kept_text == "short text" and got[2].n_words == 1 and got[4].n_words == 0


def test_fingerprints(docs, texts):
    got = {r.doc_id: r.fp & (1 << 64) - 1 for r in near_duplicates(docs).collect()}
    assert got == {d: fingerprint((t or "").encode(), 4, 42) for d, t in texts.items()}


def test_quality(docs, texts):
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert got[1].n_words == len(texts[1].split()) and got[1].n_repeat_words >= 120
    assert got[2].n_words == 1 and got[2].word_chars == 3_000_000 and not got[2].kept


def test_licences(docs):
    got = {r.doc_id: [x.licence for x in r.licences] for r in scan_licences(docs).collect()}
    assert got == {1: ["MIT-text"], 2: [], 3: [], 4: []}


def test_encoding(docs, texts):
    done = encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    for r in done:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        expected = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert hashlib.sha256(bytes(r.ids)).hexdigest() == expected


def test_packing(docs, texts):
    words = {r.doc_id: r.n for r in pack(docs).groupBy("doc_id").agg(F.sum("n_words").alias("n")).collect()}
    assert words == {d: len((t or "").split()) for d, t in texts.items()}


def test_pipeline(spark, docs, texts, tmp_path):
    """A long text with stop words goes through all stages, whole but for its passage."""
    words = [w if i % 4 else "the and of".split()[i // 4 % 3] for i, w in enumerate(texts[1].split())]
    more = spark.createDataFrame([(5, " ".join(words), "en", "s", 0)], pipeline.COLUMNS)
    docs = docs.unionByName(more)
    for name, stage in pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.where("doc_id = 5").agg(F.sum("n_words")).first()[0] > 0.99 * WORDS
