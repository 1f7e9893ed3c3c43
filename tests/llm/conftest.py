import pytest

ODD = [
    (1, None, "en", "a", 0),
    (2, "", None, None, None),
    (3, "   \n\t ", "en", "a", 5),
    (4, "one two", "fr", "", 7),
    (5, "one two", "fr", "b", 7),
    (6, "x" * 70_000, "en", "a", 70_000),
    (7, " ".join(f"w{i}" for i in range(9_000)), "en", "a", 1),
    (7, " ".join(f"w{i}" for i in range(9_000)), "en", "a", 1),
    (8, " ".join(f"v{i}" for i in range(100)) + "\n" + " ".join(f"w{i}" for i in range(40)), "de", "b", 1),
    (9, "A b c   \x1c d \U0001f600 é é <|endoftext|>", "en", "c", 3),
    (None, "no id here", "en", "a", 2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows, and columns with clashing names."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(1) for c in ("_g", "_b", "key", "id", "sig", "s", "size", "slot", "length", "_text", "score", "page", "label")})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
