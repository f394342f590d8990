from __future__ import annotations

import pytest

# Rows that every operator has to stand: nulls, empty and long texts, ties, repeated rows.
BASE = ("the cat sat on the mat and looked at the moon while seven dogs ran over green hills to find old bones under "
        "wide trees near cold rivers that flow past small towns where people sell bread cheese wine and warm coats ") * 2
ODD = [
    (1, "alpha beta gamma " * 30),
    (2, BASE + "one"),
    (3, BASE + "two"),
    (4, BASE + "one"),
    (5, None),
    (6, ""),
    (7, "  \t\n "),
    (None, "no id here but some words"),
    (None, None),
    (8, "É à l'été 12's ĳ " * 9 + "\x0b\x0cend"),
    (9, "x" * 5000),
    (9, "x" * 5000),
    (10, "a  b   c\n\n  d\t e " * 40),
    (11, "Long " + " ".join(f"w{i * 7919 % 1000}" for i in range(20_000))),
    (12, 'key token = "0f3c9a7be2d1485f96a07c3bd2e18f4570bb91de" end'),
    (13, "<|endoftext|> Literal <|startoftext|>"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """ODD with columns whose names clash with the operators' own."""
    rows = [(k, t, "en" if (k or 0) % 2 else None, "src", 1, "x", 2.0) for k, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, mark string, shard double").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tiny_rows(spark, tiny):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def odd_rows():
    return list(ODD)
