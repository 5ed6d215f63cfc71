import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of (doc_id, text, source) rows, with columns whose names the operators use themselves."""

    def make(rows):
        full = [(d, t, None if d is None else "en", s, None if t is None else len(t), 1.5, "x") for d, t, s in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", size double, __row string").repartition(3)

    return make


@pytest.fixture(scope="session")
def hard_rows():
    """Null columns, empty and long texts, ties, repeated rows and odd characters."""
    long = " ".join(f"word{i % 977} and then." for i in range(6000))
    texts = ["", None, "one", " \t\n ", "Hello, world! Hello, world! Hello, world!", "a  b\x0bc\r\nd", "Zoë ate 12 pies 😀. <|endoftext|> it's", long, long, "x" * 9000, "日本語。" * 40]
    rows = [(i, t, ("a", "b", None, "é")[i % 4]) for i, t in enumerate(texts)]
    return rows + [rows[4]] * 3 + [rows[2]] * 2 + [(None, "no id at all", "a"), (None, None, None), (4, "same id, other text", "b")]
