import os

import pytest

from tickguard.llm.common import ship

SF = os.environ.get("TICKGUARD_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


#: Texts that every operator must take: null, empty, white space, one word, no space, ties, repeats.
TEXTS = [None, "", " \n\t ", "word", "x" * 5000, "Same text here, twice.", "Same text here, twice.",
         "Mail a.b@c.de or call +1 (555) 010-2030 now.\nMail a.b@c.de", "ß é 東京 \u2003 12.5.1.9 4111 1111 1111 1111",
         "ab " * 3000, "ab " * 3000, "A very long text of many words, and some more. " * 25_000]
#: Columns that operators use names like; they must not meet.
CLASHES = ["score", "k", "fp", "start", "length", "bucket", "n", "a", "b", "label", "features",
           "host", "path", "rule", "verdict", "key", "word", "row", "turn", "half", "kind", "size", "shard", "k1", "k2",
           "cls", "info", "held", "root", "term", "item", "rank", "vec", "block", "slice"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with null ids, languages and sources, a row three times, and clashing columns."""
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", None) for i, t in enumerate(TEXTS)]
    rows += [rows[3]] * 2 + [(None, "a row without an id", "en", "s", 3), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHES])


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("doc_id < 0")
