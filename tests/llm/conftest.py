import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """``documents`` rows from ``(doc_id, text)`` pairs."""
    def make(pairs, parts=3):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(parts)
    return make


@pytest.fixture(scope="session")
def sample_texts():
    import duckdb
    return [r for r in duckdb.sql(
        "select doc_id, text from '/root/testdata/sf0.001/documents.parquet' order by 1").fetchall()]
