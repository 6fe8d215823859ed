import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=False):
    """Documents from (doc_id, text[, source]); with `extra`, columns whose names clash with those of operators."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:
        for name in ("n_tokens", "ids", "c", "n", "label", "kept", "failed", "component_id", "part", "queue", "toxic", "digest", "id", "x", "y", "of"):
            df = df.selectExpr("*", f"'clash' AS {name}")
    return df


@pytest.fixture
def make(spark):
    return lambda rows, extra=False: documents(spark, rows, extra)


@pytest.fixture(scope="session")
def sf():
    import os

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("driver tables not present")
    return folder
