import pytest

from marketlake.llm.registry import ready, table

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    return ready(spark)


@pytest.fixture(scope="session")
def documents(llm):
    return table(llm, SMALL, "documents")


@pytest.fixture(scope="session")
def docs(llm):
    """Makes documents from texts or (id, text) pairs."""

    def make(texts, more=""):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return llm.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)

    return make
