"""Small tables with the odd cases that every operator and stage must take."""
import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd_docs(spark):
    words = " ".join(f"word{i}" for i in range(60))
    rows = [(1, words, "en", "a"), (2, words, "en", "a"), (2, words, "en", "a"), (3, None, None, None), (4, "", "en", "b"),
            (None, words + " tail", "de", None), (None, None, None, "a"), (5, " \t\n ", "en", "b"), (6, "one two", None, "b"),
            (7, "x" * 50_000, "en", "c"), (8, "long text " * 20_000, "en", "c"), (9, "a\x00b é 😀 \u2028 ▁ end", "fr", ""),
            (10, " ".join(f"Word{i}" for i in range(60)), "en", "b")]
    return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """The same rows with more columns, named like those that operators make."""
    from pyspark.sql import functions as F
    for c in ("size", "key", "k", "th", "n", "cls", "token", "score", "spans", "_size", "target", "host", "bad", "row", "cell"):
        df = df.withColumn(c, F.lit("extra"))
    return df
