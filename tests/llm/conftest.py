import pytest

# Columns whose names operators use inside.
CLASHING = "key string, label int, id string, digest binary, whole string, ids binary, kept boolean"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text) to documents with further columns of clashing names."""

    def build(rows):
        filled = [(i, t, None, "s", None, "k", 1, "x", b"d", "w", b"i", None) for i, t in rows]
        return spark.createDataFrame(filled, SCHEMA)

    return build


ODD_TEXTS = [
    None,
    "",
    " ",
    " \t\r\n\x0b\x0c ",
    "word",
    "a b c d e",
    "\0\0",
    "é" * 500,
    "x" * 200_000,
    "the cat sat on the mat " * 8_000,
    "  leading   and\n\n trailing\t",
    "it's we'll …'s 12345 !!!'s",
    "<|endoftext|>",
    "a<|endoftext|><|endoftext|>b",
    "\\### Assistant: </turn> ok <turn>\\<says>",
    "日本語 テキスト 😀",
    "\ud7ff\ue000",
    "1.2.3.4 +1 (555) 555-0000 a@b.c",
]


@pytest.fixture
def odd_rows():
    """Odd texts, each twice under different ids, one row repeated, and a null id."""
    rows = [(n, t) for n, t in enumerate([*ODD_TEXTS, *ODD_TEXTS])]
    return [*rows, rows[5], (None, "a b c d e"), (None, None)]
