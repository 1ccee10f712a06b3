import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

import pytest  # noqa: E402

DOCS = "doc_id long, text string, lang string, score double, keep string, t string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from lodestar.session import ship_package
    ship_package(spark)


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, clashing names."""
    rows = [(1, "the cat sat on the mat with a hat", "en", 1.0, "k", "t"), (2, None, None, None, None, None),
            (3, "", "en", 0.0, "", ""), (1, "the cat sat on the mat with a hat", "en", 1.0, "k", "t"),
            (None, "der hund und die katze sind im haus", "de", 2.0, "k", "t"), (4, "word " * 40_000, "en", 1.0, "k", "t"),
            (5, "x" * 100_000, None, 1.0, "k", "t"), (6, "123 456 !!!", "de", 1.0, "k", "t"),
            (7, "a\tb\r\nc d é İ. 1² <|endoftext|> it's  two\n\n\nlines ", "en", 1.0, "k", "t")]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
