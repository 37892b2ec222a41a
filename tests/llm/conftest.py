import pytest


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns."""
    long = "lorem ipsum dolor sit amet consectetur " * 20_000
    rows = [(1, "The cat sat on the mat and then it slept.", "en", "b"), (1, "The cat sat on the mat and then it slept.", "en", "b"),
            (2, None, None, None), (3, "", "en", "a"), (None, "no id here at all, none", "en", "a"),
            (4, "THE CAT sat on the mat and then it slept.", "en", None), (5, long, "en", "a"), (6, "12 34 !!", "de", "b"),
            (7, " \t\n", "de", "b"), (8, "é à ü ñ 你好 мир", "fr", "b")]
    names = ["target", "shard", "score", "kept", "th", "mk", "lang_pred", "n_words", "host", "run"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for n in names:
        from pyspark.sql import functions as F

        df = df.withColumn(n, F.lit("clash"))
    return df
