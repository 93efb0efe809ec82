import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def sentence(seed, n):
    return " ".join(WORDS[(seed * 7 + i * i + 3 * i) % len(WORDS)] + str((seed + i) % 23) for i in range(n))


@pytest.fixture(scope="session")
def hostile_rows():
    """Ids and texts with nulls, empty and long texts, copies, repeated rows and shared passages."""
    passage, other = sentence(1, 60), sentence(2, 45)
    return [
        (1, sentence(3, 80)),
        (2, sentence(4, 10) + " " + passage + " " + sentence(5, 10)),
        (3, passage + "\n" + sentence(6, 30)),
        (4, sentence(3, 80)),
        (5, sentence(3, 79) + " changed"),
        (6, None),
        (7, ""),
        (8, " \t\n\x0b\x0c\r "),
        (9, "été ß 日本 " * 40 + other),
        (10, other + " été ß 日本 " * 40),
        (11, "a"),
        (11, "a"),
        (12, passage),
        (12, sentence(9, 50)),
        (None, passage),
        (None, None),
        (13, "x y " * 2_000 + other),
        (14, "UPPER Case TEXT and # symbols $$ | | <> here"),
        (15, "aaaa" * 120),
        (16, sentence(3, 80).upper()),
    ]


@pytest.fixture(scope="session")
def hostile(spark, hostile_rows):
    """The rows with columns whose names the operators use themselves."""
    rows = [(i, t, "en", f"s{n % 3}" if n % 5 else None, len(t or ""), n, "x") for n, (i, t) in enumerate(hostile_rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def no_rows(hostile):
    return hostile.limit(0)


@pytest.fixture(scope="session")
def documents(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()
