"""Extra columns with the names that operators use inside change no result and crash nothing."""

import re
from pathlib import Path

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import snapcredit.llm
from snapcredit.llm.bpe import encode_decode
from snapcredit.llm.collocations import collocations
from snapcredit.llm.html_text import extract_main_text
from snapcredit.llm.importance import resample
from snapcredit.llm.licences import scan_licences
from snapcredit.llm.near_copies import near_copies
from snapcredit.llm.packing import pack
from snapcredit.llm.quality import keep_good, quality_rules
from snapcredit.llm.simhash import keep_one, near_duplicates
from snapcredit.llm.substring_dedup import drop_repeated_windows
from snapcredit.llm.suffix_dedup import drop_repeated_strings
from snapcredit.llm.token_counts import section_tokens
from snapcredit.llm.toxicity import toxicity

BASE = ["doc_id", "text", "lang", "source", "n_chars"]


def inner_names():
    """Every word in quotes in the package that could name a column."""
    found = set()
    for path in Path(snapcredit.llm.__file__).parent.glob("*.py"):
        found |= set(re.findall(r'"(_?[a-z][a-z_]{0,14})"', path.read_text()))
    return sorted(found - set(BASE) - {"html", "url", "page_id"})


@pytest.fixture(scope="module")
def plain(spark, hostile):
    return hostile.select(BASE).cache()


@pytest.fixture(scope="module")
def wide(plain):
    return plain.withColumns({name: F.lit(f"x {i}") for i, name in enumerate(inner_names())}).cache()


def words(name):
    return public_tokenizers.path(name)


OPERATORS = {
    "pack": pack,
    "encode_decode": lambda d: encode_decode(d, words("word_bpe_49k.json")),
    "quality_rules": quality_rules,
    "keep_good": keep_good,
    "scan_licences": scan_licences,
    "strings": drop_repeated_strings,
    "strings_keep": lambda d: drop_repeated_strings(d, keep=["lang", "source"]),
    "section_tokens": lambda d: section_tokens(d, words("byte_bpe_50k.json")),
    "windows": drop_repeated_windows,
    "near_duplicates": near_duplicates,
    "keep_one": keep_one,
    "keep_one_near": lambda d: keep_one(d, near_copies),
    "collocations": lambda d: collocations(d, least=3),
    "resample": lambda d: resample(d, d),
    "toxicity": lambda d: toxicity(d, d.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))),
    "html": lambda d: extract_main_text(d.withColumn("html", F.concat(F.lit("<p>"), "text"))),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_names(plain, wide, name):
    expected, got = OPERATORS[name](plain), OPERATORS[name](wide)
    assert set(expected.columns) <= set(got.columns)
    rows = [sorted(map(str, df.select(expected.columns).collect())) for df in (expected, got)]
    assert rows[0] == rows[1] and len(set(got.columns)) == len(got.columns)


def test_kept_columns(wide):
    names = [c for c in inner_names() if c not in ("kept", "n_bytes", "spans")]
    done = drop_repeated_strings(wide, keep=names)
    assert done.columns == ["doc_id", *names, "n_bytes", "spans", "kept"]
    assert done.select(names).distinct().collect() == wide.select(names).distinct().collect()
    with pytest.raises(ValueError, match="kept"):
        drop_repeated_strings(wide, keep=["kept"])
