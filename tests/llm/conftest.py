import pytest

from lograil.llm.common import prepared

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs; more columns whose names clash with internal ones."""
    prepared(spark)

    def make(pairs, extra=True, lang=None):
        rows = [(i, t, (lang or {}).get(i, "en"), "s", None if t is None else len(t)) for i, t in pairs]
        df = spark.createDataFrame(rows, DOC)
        if extra:
            for name in ("block", "key", "score", "fp", "ids", "kept", "words", "row", "part"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df
    return make
