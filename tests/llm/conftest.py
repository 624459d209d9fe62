import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """``documents((doc_id, text), ...)`` with the columns of the given table."""

    def build(*rows, source="s1"):
        data = [(i, t, "en", source, None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(data, SCHEMA)

    return build


@pytest.fixture(scope="session")
def awkward(spark):
    """Null ids, null and empty texts, repeated rows, a long text, columns with names that operators use."""
    long_text = " ".join(f"word{i % 977} next{i % 13}" for i in range(20_000))
    rows = [
        (1, "A first text with enough words to look at and some more of them.", "en", "b", 1),
        (1, "A first text with enough words to look at and some more of them.", "en", "b", 1),
        (2, None, "en", None, None),
        (3, "", None, "a", 0),
        (None, "A row without an id.", "en", "a", 3),
        (None, None, None, None, None),
        (4, " \t\n ", "de", "b", 4),
        (5, long_text, "en", "a", len(long_text)),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for clash in ("row", "fingerprint", "component_id", "root", "ids", "token_ids", "score", "size", "rate", "u", "n", "base", "shard", "place", "kept", "a.b"):
        frame = frame.withColumn(clash, frame["n_chars"])
    return frame


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    return build
