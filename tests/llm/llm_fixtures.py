import pytest

from ledgerline.llm.common import ship_package
from ledgerline.session import ensure_checkpoint_dir

# extra columns whose names clash with what the operators use inside
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept boolean, score double, digest string, bucket int, "
          "h string, n int, component string, stats string, `row` long, words string")


@pytest.fixture(scope="session")
def llm(spark):
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def make_docs(llm):
    def make(rows):
        full = [(i, t, "en", "s", None, True, 0.5, "d", 1, "h", 1, "c", "s", 7, "w") for i, t in rows]
        return llm.createDataFrame(full, SCHEMA)
    return make


LONG = " ".join(f"word{i % 997}" for i in range(60_000))
#: null, empty, blank and very long texts, a null id, ties and repeated rows
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (None, "a text without an id"), (6, "a text without an id"),
        (7, "Same TEXT here"), (8, "same text HERE"), (8, "same text HERE"), (9, "É é A"), (10, "é é a")]


@pytest.fixture(scope="session")
def edge(make_docs):
    return make_docs(EDGE)
