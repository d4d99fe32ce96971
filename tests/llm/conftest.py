import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text."""
    long_text = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))
    return [
        (1, "Alpha beta  gamma", "en", "a", 17), (2, "Alpha beta gamma", "en", "a", 16), (2, "Alpha beta gamma", "en", "a", 16), (3, None, None, None, None),
        (4, "", "de", "b", 0), (None, "Alpha\tbeta gamma", None, "b", 1), (None, None, None, None, None), (5, " \n ", "fr", None, 3), (6, long_text, "en", "c", 9),
        (7, long_text + " tail", "en", "c", 9), (8, "12 34 !!", "en", "b", 8), (9, "Ünï ǅ ΣΑΣ 数字 <|endoftext|> it's", "de", "b", 1), (9, "other text of nine", "de", "a", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """With an extra column whose name clashes with results."""
    from pyspark.sql import functions as F

    return spark.createDataFrame(odd_rows, DOCS).withColumn("score", F.lit("x")).withColumn("size", F.lit("y")).withColumn("component_id", F.lit("z"))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
