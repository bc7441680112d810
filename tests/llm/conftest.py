import pytest

# Names that the operators use inside; documents may have columns of that name.
CLASHING = ["size", "fp", "key", "part", "spans", "passes", "row_hash", "node", "bucket", "length", "shard"]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture
def documents(spark):
    """Documents of (doc_id, text[, source]) rows, with extra columns of clashing names."""

    def build(*rows):
        full = [
            (i, text, "en", (more or ["s"])[0], None if text is None else len(text), *CLASHING)
            for i, text, *more in rows
        ]
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, schema + "".join(f", {c} string" for c in CLASHING))

    return build


ODD_TEXTS = [None, "", "   ", "\n\t ", "one", "one two", "ONE  two\n", "a b c d e f g", "é ü 日本 😀", "x" * 5000, "w " * 30000]


@pytest.fixture
def odd(documents):
    """Nulls, empty and long texts, repeated rows, one id twice and a null id."""
    rows = list(enumerate(ODD_TEXTS))
    return documents(*rows, rows[6], rows[6], (3, "another text with id three"), (None, "no id"), (None, None))


@pytest.fixture
def none(documents, spark, odd):
    return odd.limit(0)
