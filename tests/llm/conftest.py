import pytest

from tests.conftest import SF

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, size int, label string"


@pytest.fixture(scope="session")
def docs(spark):
    """The smallest documents table, cached."""
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="session")
def rows(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank, very long and repeated rows, clashing extra columns."""
    long_text = "\n".join(f"line {i} of a very long text about things {i * 7919 % 1009}" for i in range(300))
    texts = [None, "", " \n\t ", "one", "one", "x" * 30_000, long_text, long_text + " end", "a b c d e f g h",
             "Ünïcode ▁ text 漢字 \x1c <|endoftext|> 😀", "the same line\nthe same line\n\nother words here"]
    made = [(i, t, "en" if i % 2 else None, "s1" if i % 3 else None, None, "x", 1, "y") for i, t in enumerate(texts)]
    made += [(3, "one", None, None, None, None, None, None), (3, "one", None, None, None, None, None, None),
             (None, "row without an id and some words", "fr", "s2", 1, None, None, None)]
    return spark.createDataFrame(made, SCHEMA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
