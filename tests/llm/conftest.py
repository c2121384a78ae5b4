import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents of (doc_id, text) pairs, beside columns whose names clash with those of results."""

    def build(pairs, clash=False):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        made = spark.createDataFrame(rows, DOCUMENTS)
        if clash:
            made = made.toDF("doc_id", "text", "TEXT", "spans", "score")
        return made

    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, non-ASCII and very long texts."""
    return [None, "", " \t\n ", "é ß Ω", "x" * 300_000, "word " * 60_000, "日本語 テキスト", "🙂" * 50]
