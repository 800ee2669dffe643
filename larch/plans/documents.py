"""Second binary task: document quality from ``labels`` + ``documents``.

Only ``doc_id, n_chars, lang, source`` are read from ``documents`` (the
text column is pruned at the scan). Labels join their documents on
``doc_id``; how the join moves them is left to Spark.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.operators import evaluate, features as fe, models, split
from larch.sources.trips import read_table

NUMERIC = ["log_chars"]
CATEGORICAL = ["lang", "source"]


def labeled_documents(spark: SparkSession, sf: str, target: str = "quality") -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    labels = read_table(spark, sf, "labels").select("doc_id", target)
    d = docs.join(labels, ["doc_id"])
    d = d.withColumn("log_chars", F.log1p(F.col("n_chars").cast("double")))
    return split.with_split(d, "doc_id")


def quality_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """M2 + V9 on documents: train-mode prediction."""
    d = labeled_documents(spark, sf)
    cls = models.classification_baseline(d.filter(~F.col("is_test")), "quality")
    pred = models.predict_class_constant(d, cls)
    return evaluate.classification_report(pred, "quality", p1="p1", predicted="prediction")


def length_auc(spark: SparkSession, sf: str) -> DataFrame:
    """V7 on documents: AUC of the document length as a quality score."""
    d = labeled_documents(spark, sf)
    return evaluate.roc_auc(d, "quality", "n_chars", ["is_test"])


def quality_logistic(spark: SparkSession, sf: str, C: float = 1.0) -> DataFrame:
    """M7 on documents: log length + one-hot language and source."""
    d = labeled_documents(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    train = d.filter(~F.col("is_test"))
    pipe = Pipeline(stages=[fe.PopulationScaler(numericCols=NUMERIC),
                            fe.OneHot(categoricalCols=CATEGORICAL),
                            VectorAssembler(inputCols=NUMERIC + [c + "_ohe" for c in CATEGORICAL],
                                            outputCol="features")])
    feats = pipe.fit(train).transform(d)
    n = feats.filter(~F.col("is_test")).count()
    model = models.logistic_regression(C, n, "quality").fit(feats.filter(~F.col("is_test")))
    pred = model.transform(feats).withColumn("p1", models.p_one("probability"))
    out = evaluate.classification_report(pred, "quality", p1="p1")
    d.unpersist()
    return out.withColumn("C", F.lit(float(C)))
