import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

#: Null key and text, empty text, one of blanks only, a repeated row, a repeated key, one long text.
LONG = " ".join(f"word{i % 4000} of the" for i in range(6000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog " * 2, "en"),
    (1, "the quick brown fox jumps over the lazy dog " * 2, "en"),
    (1, "another text under the same key", "en"),
    (2, "", "en"),
    (3, None, None),
    (None, "a text of and without a key, it is here", "de"),
    (4, " \t\n ", "en"),
    (5, LONG, "en"),
    (6, "naïve Œuvre 東京 straße \x0b\x0c done", "fr"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents of every awkward kind, with extra columns whose names the operators also use."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return df.selectExpr("*", *[f"'{c}' AS {c}" for c in ("row", "spans", "fp", "kept", "_row", "key", "chunk", "mark")])


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
