import pytest

# clashing names, nulls in every column, empty and long texts, repeated rows and ids
EDGE = [
    (1, "alpha beta gamma", "en", "n"), (1, "alpha beta gamma", "en", "n"), (1, "another text here", "en", "n"),
    (2, None, None, None), (None, "no id here", "de", "m"), (None, None, None, None), (3, "", "fr", "x"),
    (4, " \n\t ", "fr", "x"), (5, "é日😀 <|endoftext|> x\x00y", "es", "y"), (6, "wort " * 30_000, "de", "z"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Rows with extra columns named like results and helpers of the operators."""
    df = spark.createDataFrame(EDGE, "doc_id long, text string, lang string, n_tokens string")
    for name in ("key", "row", "kind", "spans", "fp", "id", "keep", "kept", "fingerprint", "score"):
        df = df.withColumn(name, df.lang)
    return df


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
