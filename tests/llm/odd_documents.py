from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

# Workers import the package to unpickle what operators hand them.
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).parents[2]), os.environ.get("PYTHONPATH", "")])

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977}x{i}" for i in range(20_000))


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    from orestar.session import prepare

    return prepare(spark)


def documents(spark, rows):
    """Documents with columns whose names operators use inside."""
    wide = [(*r, i, f"h{i}", float(i), "kept?") for i, r in enumerate(rows)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars int, hash string, score double, kept string"
    return spark.createDataFrame(wide, schema)


@pytest.fixture
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    return [
        (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "s1"),
        (2, "alpha  beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "s1"),
        (2, "alpha  beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "s1"),
        (3, "ALPHA beta gamma delta epsilon zeta eta theta iota kappa lambda nu", "de", None),
        (4, None, "en", "s2"),
        (5, "", None, "s2"),
        (6, " \t\n", "fr", None),
        (7, LONG, "en", "s3"),
        (8, LONG + " tail", None, "s3"),
        (None, "a row without an id, of ten words at least, all its own", "en", "s1"),
        (None, None, None, None),
        (9, "x", "es", "s10"),
        (10, "First line of the page\nfirst LINE of the page \nother line entirely\n\nshort", "en", "s1"),
        (11, "  first line of the page\t\nshort\nOther Line Entirely", "en", "é"),
        (12, "Übung macht den Meister ſ K \U0001f600 tail", "de", "é"),
        (10, "another text under the id of a page that is there already", "en", "s1"),
    ]


@pytest.fixture
def odd_docs(spark, odd_rows):
    return documents(spark, odd_rows)


# Names that operators give to columns of their own.
CLASHING = ["label", "label_id", "known_id", "mix_id", "mix_place", "mix_shards", "mix_copy", "id", "name", "n", "words", "digest", "gone_id", "item"]


def clashing(docs):
    """The documents with more columns, a struct among them."""
    more = {c: F.lit(i) for i, c in enumerate(CLASHING)}
    return docs.withColumns({**more, "place": F.struct(F.lit(1).alias("id"), F.lit("x").alias("text"))})


@pytest.fixture
def no_docs(spark):
    return documents(spark, [])
