"""No join of op11 sends words or their signatures to the driver, however small Spark thinks they are."""

from larch.llm import spelling


def test_words_are_not_broadcast(spark):
    words = spark.createDataFrame([(a + "arch" + b, n) for n, (a, b) in enumerate([("l", ""), ("m", ""), ("st", ""), ("l", "e")], 3)], "word string, n long")
    near = spelling.near_words(words)
    assert near.count() == 2
    out = spelling.spelling_variants(words.unionByName(spark.createDataFrame([("larcj", 1)], "word string, n long")))
    assert {(r["word"], r["root"]) for r in out.collect()} >= {("larcj", "larche"), ("starch", "starch")}
    for df in (near, out):
        df.count()
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
