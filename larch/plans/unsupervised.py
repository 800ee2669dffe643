"""Unsupervised course topics on the ``embeddings`` table.

Vectors come from the ``array<float>`` column with ``array_to_vector``
(JVM side). K-means and PCA are MLlib fits; the centroid assignment and
the covariance that PCA diagonalizes are exposed as their own queries.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from larch.sources.trips import read_table

SEED = 123
N_CLUSTERS = 10
N_COMPONENTS = 3


def embedding_vectors(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "embeddings")
    return e.select("vec_id", "label", array_to_vector("embedding").alias("features"),
                    "embedding")


def kmeans_clusters(spark: SparkSession, sf: str, k: int = N_CLUSTERS) -> DataFrame:
    """K-means (k-means|| init, seeded); per cluster size and the
    share of its majority label."""
    v = embedding_vectors(spark, sf)
    model = KMeans(k=k, seed=SEED, maxIter=50, featuresCol="features").fit(v)
    pred = model.transform(v)
    per = pred.groupBy("prediction", "label").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(F.col("prediction").cast("long").alias("cluster")).agg(
        F.sum("n").alias("size"), (F.max("n") / F.sum("n")).alias("purity")) \
        .withColumn("training_cost", F.lit(float(model.summary.trainingCost)))


def label_centers(v: DataFrame) -> list[tuple[int, list[float]]]:
    """Per-label mean vectors (k x d numbers; bounded by labels x dims)."""
    rows = v.groupBy("label").agg(Summarizer.mean(F.col("features")).alias("c")).collect()
    return sorted((int(r["label"]), [float(x) for x in r["c"]]) for r in rows)


def assign_to_centers(v: DataFrame, centers: list[tuple[int, list[float]]],
                      array_col: str = "embedding") -> DataFrame:
    """K-means assignment step to fixed centers: nearest center by squared
    Euclidean distance, computed with array functions (no join)."""
    x = F.col(array_col)
    dists = []
    for lab, c in centers:
        cen = F.array(*[F.lit(float(t)) for t in c])
        d = F.aggregate(F.zip_with(x, cen, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b)),
                        F.lit(0.0), lambda acc, t: acc + t)
        dists.append(F.struct(d.alias("d"), F.lit(lab).alias("center")))
    best = F.array_min(F.array(*dists))
    return v.select("vec_id", "label", best["center"].cast("long").alias("center"))


def kmeans_assign_label_centers(spark: SparkSession, sf: str) -> DataFrame:
    """M15 predict step: every vector assigned to the nearest label mean."""
    v = embedding_vectors(spark, sf)
    return assign_to_centers(v, label_centers(v)).select(
        F.col("vec_id"), F.col("label").cast("long").alias("label"), "center")


def pca_components(spark: SparkSession, sf: str, k: int = N_COMPONENTS) -> DataFrame:
    """Explained variance of the first k components."""
    v = embedding_vectors(spark, sf)
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(v)
    ev = model.explainedVariance.toArray()
    return spark.createDataFrame([Row(component=i, explained_variance=float(x))
                                  for i, x in enumerate(ev)], "component long, explained_variance double")


def pca_projection_summary(spark: SparkSession, sf: str, k: int = N_COMPONENTS) -> DataFrame:
    """M16 transform: per label, the mean of each projected component."""
    v = embedding_vectors(spark, sf)
    model = PCA(k=k, inputCol="features", outputCol="pca").fit(v)
    from pyspark.ml.functions import vector_to_array
    p = model.transform(v).withColumn("pc", vector_to_array("pca"))
    return p.groupBy(F.col("label").cast("long").alias("label")).agg(
        *[F.avg(F.col("pc")[i]).alias(f"pc{i}_mean") for i in range(k)])


def embedding_covariance(spark: SparkSession, sf: str) -> DataFrame:
    """Sample covariance of the embedding dimensions (what PCA
    diagonalizes), as a long (i, j, cov) table; one distributed pass."""
    v = embedding_vectors(spark, sf)
    corr = Correlation.corr(v, "features", "pearson").first()[0].toArray()
    sd = v.select(Summarizer.std(F.col("features")).alias("s")).first()["s"].toArray()
    d = len(sd)
    # a constant dimension has no correlation, and covariance 0
    rows = [Row(i=i, j=j, cov=float(corr[i, j] * sd[i] * sd[j]) if sd[i] and sd[j] else 0.0)
            for i in range(d) for j in range(d)]
    return spark.createDataFrame(rows, "i long, j long, cov double")
