import pytest


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls, ties, repeated rows, a long text, and columns named like the operators' own."""
    long = " ".join(f"word{i % 977} other{i % 31}" for i in range(30_000))
    rows = [
        (1, "One two three four five six seven.", "a"),
        (1, "One two three four five six seven.", "a"),
        (2, None, None),
        (3, "", "b"),
        (None, "One two three four five six seven.", "c"),
        (None, None, "c"),
        (4, "   \n\n ", "b"),
        (5, long, "d"),
        (5, long + " end", "e"),
        (6, "Ünïcode ‘quotes’ 日本語 🙂 \u0000 tab\there", "f"),
        (7, "short", "g"),
    ]
    schema = "doc_id long, text string, source string"
    return spark.createDataFrame(rows, schema).selectExpr(
        "*", "7 AS of", "8 AS hash", "9 AS _again", "10 AS need", "11 AS gone", "'x' AS n", "'y' AS piece", "1 AS length", "2 AS node", "3 AS cid", "4 AS score", "5 AS n_removed", "6 AS h1"
    )


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
