import pytest

LONG = "über alles the quick brown fox jumps over lazy dogs " * 400


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, very long, tied and repeated rows, clashing extra columns."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    rows = [
        (1, base, "a"), (2, base + " ", "b"), (3, "ALPHA" + base[5:], "a"), (4, None, None), (5, "", "a"), (6, " \t\n", "b"),
        (7, LONG, "c"), (8, LONG + "x", "c"), (9, "word", None), (10, "word\u00a0two  three", "a"), (None, base, "b"),
        (11, "ñ" * 60 + base, "c"), (11, "ñ" * 60 + base, "c"), (12, "a" * 3000, "d"), (13, "a" * 2500, "d"),
        (14, base + " omega " + base, "a"), (15, None, "z"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.selectExpr("*", "'x' AS hash", "1 AS size", "2 AS node", "text AS bytes", "'k' AS key", "'r' AS row", "3 AS digest", "'en' AS lang")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
