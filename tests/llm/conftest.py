import pytest

# Clashing names: columns that the operators also use inside or return.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, spans string, x string"

LINE = "This line is long enough to count, and it repeats."
WORDS = [f"w{i}" for i in range(400)]


def row(doc_id, text, lang="en", source="s0"):
    return (doc_id, text, lang, source, None if text is None else len(text), 7, "clash", None)


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long_text = " ".join(WORDS[i % 400] for i in range(30_000))
    return [
        row(1, "alpha beta gamma delta epsilon"), row(2, ""), row(3, None), row(4, "x", None, None),
        (None, "null id text with some words", None, None, None, None, None, None),
        row(5, "  \n\t\n"), row(6, "Ünï çødé ÀB\r\nzwei\n\nzwei"), row(7, long_text), row(8, long_text),
        row(9, "same text"), row(9, "same text"), row(9, "other text of one id"),
        *[row(20 + i, f"start {i}\n  {LINE.upper() if i % 2 else LINE}\t\nend {i}\n{LINE}") for i in range(6)],
        row(30, "a" * 300_000), row(31, "\n" * 50), row(32, "the the the the the the the"),
    ]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
