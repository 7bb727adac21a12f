import pytest

from loadbay.llm.ship import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """Make a documents table of (doc_id, text[, lang, source])."""
    def make(rows):
        rows = [(*r, *("en", "s0")[len(r) - 2:], None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return make
