"""Fixtures and helpers of the operator tests (no conftest: there is one above)."""

import re
from collections import Counter

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, g long, u string, rid string, size string, "
        "node string, digest string, label string, bucket string, block string, _id string, words string, quality string")


def shingle_counts(text):
    w = WORD.findall(text or "")
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if k else Counter()


@pytest.fixture(scope="session")
def documents(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): nulls, empties, white space, long text, ties and repeated rows."""
    prose = "it is a long and winding road that leads to the door of the house on the hill"
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n", None, "a"), (4, "one", "en", None),
            (5, prose, "en", "a"), (5, prose, "en", "a"), (6, prose, "de", "b"), (None, prose, "en", "b"),
            (None, None, None, None), (7, prose + " today", "en", "b"), (8, "a" * 30_000, "en", "b"),
            (9, " ".join(f"w{i % 977}" for i in range(60_000)), "en", "a"), (10, "été  ß 😀 </s>\x1cx", "fr", "c"),
            (11, "Licensed under CC BY-NC 4.0.", "en", "c"), (7, "another text under the same id", "en", "b")]
    return rows + [(100 + i, f"{prose} {i % 3} {prose} {i % 5}", "en", "hot") for i in range(40)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns whose names the operators use inside."""
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    return spark.createDataFrame([(*r, None, *["x" if i else 1 for i in range(12)]) for r in odd_rows], DOCS).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)
