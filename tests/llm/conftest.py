import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words long, class string, id int, size double"


@pytest.fixture
def docs(spark):
    """Rows to documents, with extra columns whose names clash with those that operators use inside."""
    def make(rows):
        full = [(i, t, lang, source, len(t or ""), 7, "x", 9, 0.5) for i, t, lang, source in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def rough():
    """Texts that operators must bear: null, empty, blank, one word, very long, odd characters, repetitions."""
    texts = [None, "", " \t\n ", "word", "x" * 100_000, "a b " * 20_000, "é😀    \x1c b", "same text here", "same text here", "1" * 5000 + "@" * 3000, "\n" * 1000]
    return [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "s", ) for i, t in enumerate(texts)] + [(None, "no id", "en", "s"), (7, "same text here", "en", "s")]
