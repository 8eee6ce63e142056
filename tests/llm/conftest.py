import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

LONG = " ".join(f"word{i % 977} number {i}" for i in range(40_000))


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, with two extra columns that clash with result and helper names."""
    from vigil.llm import common
    common.tune(spark)

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, None, "s", len(t) if t is not None else None) for i, t in rows], DOCS)
        if not extra:
            return df
        for c in ("keep_id", "score", "fingerprint", "length", "shard"):
            df = df.selectExpr("*", f"'x' as {c}")
        return df
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    return [(1, "Alpha beta gamma delta"), (1, "Alpha beta gamma delta"), (2, "alpha BETA gamma delta"), (None, "alpha beta gamma delta"),
            (3, None), (4, ""), (None, None), (None, None), (5, "É alpha"), (6, "é alpha"), (7, " \n"), (8, LONG), (9, LONG),
            (10, LONG + " tail"), (11, "one"), (12, "two words"), (7, "other text with that id")]
