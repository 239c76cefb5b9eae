import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from texts; ids count from 1, sources go round three sites."""

    def build(texts, ids=None):
        rows = [(ids[i] if ids else i + 1, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, SCHEMA)

    return build


#: Texts that every operator must take: null, empty, blank, non-ASCII, one long word, a very long text, repeats.
ODD = [None, "", "  \n\t ", "é東😀 ß", "x" * 5000, "word " * 30000, "a b c", "a b c", "line\nline\n\nline"]


@pytest.fixture(scope="session")
def odd():
    return ODD
