import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) tuples, with the table's other columns."""

    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, COLUMNS)
        return df.selectExpr("*", *extra.split(";")) if extra else df

    return make


#: Nulls, empty and blank texts, ties and repeated rows, a long text.
AWKWARD = [
    (1, None), (2, ""), (3, "  \n\t"), (4, "one two three four five six"), (5, "one two  three four five six"),
    (6, "one two three four five six"), (6, "one two three four five six"), (None, "one two three four five six"),
    (None, None), (7, "word " * 5000), (8, "é ß 日本 🙂 <|endoftext|> don't"), (9, "12 !!"),
]
CLASHES = "doc_id AS _digest;1 AS _maybe;2 AS fp;'x' AS _gone;3 AS component;4 AS node;5 AS _row;6 AS row"
