import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark, tmp_path):
    """Writes rows as the documents table of a folder, and returns the folder."""

    def write(rows, schema=DOCS, name="documents"):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def awkward():
    """Nulls, empty and blank texts, repeated rows, ties, many scripts, and a long text."""
    words = "the of and to in that it is was for on are as with his they at be this from".split()
    long = " ".join(words[(i * i) % 20] + ("x" * (i % 3)) for i in range(6000))
    texts = [
        None, "", "   \n\t ", "one", "One two", "the cat sat on the mat " * 5, "the cat sat on the mat " * 5, "THE CAT sat on the mat " * 5,
        "Ünïcödé tëxt, 漢字 and ελληνικά 😀", long, "a\x0bb\x0cc\x1cd e f", "x" * 3000, " " * 3000, "12345 67890 !!! ???", "spam " * 20000,
    ]
    rows = [(i, t, "en" if i % 3 else None, ["a", "b", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    return [*rows, rows[5], rows[5], (None, "no id here", "en", "a", 10), (None, None, None, None, None)]
