import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank string, kept string, count long, row string, key string, h long, _rank string, _own string, `a.b` string"


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents from texts or (id, text) pairs, with extra columns whose names operators use inside."""

    def make(rows):
        out = []
        for i, r in enumerate(rows):
            doc_id, text = r if isinstance(r, tuple) else (i, r)
            out.append((doc_id, text, "en", f"s{i % 3}" if i else None, None, "x", "y", 5, "r", "k", 7, "_r", "_o", "a.b"))
        return spark.createDataFrame(out, DOCS)

    return make
