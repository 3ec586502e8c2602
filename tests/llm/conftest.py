import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

#: Null, empty, blank, one word, very long, odd white space, surrogate-free Unicode, repeated rows.
LONG = " ".join(f"word{i % 700} and" for i in range(30000))
EDGES = [
    None, "", " ", "\n", "\n\n \n", "word", "A b", "  two  spaces\tand tabs \x0b\x0c\r ", "ünïcode É ß 字 😀 ＡＢ",
    "a\x00b\x1c\x85c d​e", "'s 're don't  1234 ²٣ !!!", LONG, LONG, "x" * 3000, "same text here", "same text here",
    "Shared line of some length here\nown line one\nShared line of some length here",
    "  SHARED line of some length here\t\nsecond", "shared line of some length here", "shared line of some length here\n",
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Documents of every awkward kind, with columns that clash with those of the results."""
    rows = [(i, text, f"src{i % 3}" if i % 5 else None, "x", 7) for i, text in enumerate(EDGES)]
    rows += [rows[3], rows[16]]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, n_words string, shard int"
    ).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    """(doc_id, text) of the smallest table."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [(r["doc_id"], r["text"]) for r in rows]


@pytest.fixture(scope="session")
def both(documents, edge_docs):
    """The smallest table and the awkward documents, as (doc_id, text)."""
    return documents + [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
