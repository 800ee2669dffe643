import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 997}x{i}" for i in range(60_000))
PROSE = ("The river carried the boats past the old town while the people on the bank watched and waited for news. "
         "Nobody could say when the first of them would return, but every evening a lamp was lit in the tower. ") * 3

#: (doc_id, text, lang, source): nulls, empty and blank texts, ties, repeated rows, one very long text.
ROWS = [
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, " " + PROSE, "en", None), (4, None, "en", "a"),
    (5, "", None, "b"), (6, " \n\t ", None, "b"), (7, "word", "en", "b"), (8, "one two three four", "en", "b"),
    (9, LONG, "en", "b"), (10, "12 34 56 !!", None, None), (None, "no id here", "en", "b"), (None, None, None, None),
    (11, "Ünïcödé text ÿ 字字字 \x00   \x85 end", "de", "c"), (12, PROSE.replace("river", "canal", 1), "en", "a"),
]
#: Extra columns whose names the operators use themselves.
CLASHES = ["row", "row_key", "node", "label", "digest", "norm", "maybe", "mask", "word", "bucket", "kept", "tokens", "topic", "p", "draw", "piece", "length", "best"]


def documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *(F.lit(i).alias(c) for i, c in enumerate(CLASHES)))


@pytest.fixture(scope="session")
def odd_docs(spark):
    return documents(spark, ROWS).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def small_docs():
    import duckdb
    return duckdb.sql("SELECT doc_id, text, lang, source FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY doc_id").fetchall()
