import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def hard(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns that clash with the operators' own."""
    long_text = "the and of to in is was for with that " * 6000
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", None, 0),
        (3, "   \n\t ", None, "a", 5),
        (4, "The cat and the dog went over the hill to see the other side of the river.", "en", "a", 1),
        (5, "The  cat and the dog went over the hill to see the other side of the river. ", "en", "b", 1),
        (5, "The  cat and the dog went over the hill to see the other side of the river. ", "en", "b", 1),
        (6, "the cat and the dog went over the hill to see the other side of the river.", "en", "b", 1),
        (7, "Der Hund und die Katze gehen über den Hügel und sehen die andere Seite des Flusses.", "de", "b", 1),
        (8, long_text, "en", "c", len(long_text)),
        (9, "12345 67890 !!", "en", "c", 14),
        (10, "x", "en", "c", 1),
        (None, "a text without an id that has a few more words", "en", "c", 1),
        (11, "日本語のテキスト", None, None, None),
        (12, "a " + "xy" * (3 << 19) + " b c", "en", "c", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    clash = ["content", "sha256", "keep_id", "id", "band", "bins", "component", "score", "block", "a", "b", "hub", "component_id", "kept", "found", "label", "text_sha256"]
    for c in clash:
        docs = docs.selectExpr("*", f"'clash' AS {c}")
    return docs


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
