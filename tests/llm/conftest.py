import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts (ids from 0) or (id, text) pairs, with an extra column whose name clashes with operators' own."""

    def make(texts, **extra):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, extra.get("lang"), "s", len(t or "")) for i, t in rows], DOCS)
        return df.selectExpr("*", "'x' AS score", "1 AS id", "2 AS size", "'y' AS host")

    return make


@pytest.fixture(scope="session")
def sample(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
