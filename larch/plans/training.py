"""Task data preparation and fit-and-evaluate plans (E8, E9, M*, V*).

``prepare`` builds the feature frame once: trips -> (pair reduction) ->
task rows and label -> raw features -> key-hash split -> feature pipeline
fitted on the train side -> applied to both sides. The result is
persisted; every later fit reads it, and a lost block is recomputed from
a deterministic lineage (hash split, literal statistics).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larch.operators import evaluate, features as fe, models, reduce as rd, split, targets
from larch.session import target_partitions, unique_path
from larch.sources import runs as runlog, trips as trip_source


@dataclass
class TaskData:
    task: str
    label: str
    frame: DataFrame
    feature_model: PipelineModel
    n_features: int
    max_categories: int
    stats: models.LabelStats
    options: dict = field(default_factory=dict)

    @property
    def train(self) -> DataFrame:
        return self.frame.filter(~F.col("is_test"))

    def release(self) -> None:
        self.frame.unpersist()


def feature_pipeline(task: str, enable_categorical: bool = False, drop_first: bool = False,
                     scale: bool = False, impute: bool = True) -> Pipeline:
    """E8 (regression) / E9 (classification) as one MLlib pipeline."""
    num, cat = targets.feature_lists(task)
    stages = []
    if impute:
        stages.append(fe.MeanModeImputer(numericCols=num, categoricalCols=cat))
    if scale:
        stages.append(fe.PopulationScaler(numericCols=num))
    if enable_categorical:
        stages.append(fe.indexer(cat, "_code"))
        vec_inputs = num + [c + "_code" for c in cat]
    else:
        stages.append(fe.OneHot(categoricalCols=cat, dropFirst=drop_first))
        vec_inputs = num + [c + "_ohe" for c in cat]
    stages.append(VectorAssembler(inputCols=vec_inputs, outputCol="features", handleInvalid="error"))
    return Pipeline(stages=stages)


def raw_task_frame(spark: SparkSession, sf_dir: str, task: str, reduce_pairs: bool = True,
                   test_size: float = 0.3, seed: int = split.DEFAULT_SEED) -> DataFrame:
    """Trips -> reduced trips -> task rows -> raw features + split flag."""
    t = trip_source.trips(spark, sf_dir)
    if reduce_pairs:
        t = rd.reduce_trips(t)
    rows = targets.task_frame(t, task, request_target=True)
    feats = targets.feature_columns(rows, task)
    return split.with_split(feats, "trip_id", test_size, seed)


def _max_categories(model: PipelineModel) -> int:
    for st in model.stages:
        if isinstance(st, PipelineModel):
            return _max_categories(st)
        if isinstance(st, StringIndexerModel):
            return max(fe.label_counts(st)) + 1
    return 2


def prepare(spark: SparkSession, sf_dir: str, task: str, enable_categorical: bool = False,
            drop_first: bool = False, scale: bool | None = None, impute_from: str = "train",
            reduce_pairs: bool = True, test_size: float = 0.3,
            seed: int = split.DEFAULT_SEED, extra_cols: list[str] | None = None) -> TaskData:
    """Build, fit and persist the feature frame of a task.

    ``impute_from="frame"`` fills each side from its own statistics (the
    original's behavior); ``"train"`` fills both from train statistics.
    Scaling defaults to on for classification, as in the original."""
    if scale is None:
        scale = task == "classification"
    label = targets.target_for(task)
    # read by the fit of each feature stage and by the transform
    raw = raw_task_frame(spark, sf_dir, task, reduce_pairs, test_size, seed).persist(StorageLevel.MEMORY_AND_DISK)
    num, cat = targets.feature_lists(task)
    if impute_from == "frame":
        raw = fe.impute_within_groups(raw, num, cat, "is_test")
    elif impute_from != "train":
        raise ValueError("impute_from must be 'train' or 'frame'")
    pipe = feature_pipeline(task, enable_categorical, drop_first, scale,
                            impute=(impute_from == "train"))
    fitted = pipe.fit(raw.filter(~F.col("is_test")))
    keep = ["trip_id", "is_test", label, "features"] + list(extra_cols or [])
    if task == "regression":
        keep += num + cat      # imputed raw columns for the Gram-based ridge
    wide = fitted.transform(raw).select(*keep)
    # read in the JVM: as JSON the schema would have a text per category
    n_features = int(wide._jdf.schema().apply("features").metadata().getMetadata("ml_attr").getLong("num_attrs"))
    # without a name per category, which every task of every later job would carry
    size_only = F.col("features").alias("features", metadata={"ml_attr": {"num_attrs": n_features}})
    frame = rebalance(wide.withColumn("features", size_only))
    raw.unpersist()
    stats = models.label_stats(frame.filter(~F.col("is_test")), label,
                               with_mode=(task == "classification"))
    return TaskData(task, label, frame, fitted, n_features, _max_categories(fitted), stats,
                    dict(enable_categorical=enable_categorical, drop_first=drop_first,
                         scale=scale, impute_from=impute_from))


def rebalance(frame: DataFrame, key: str = "trip_id") -> DataFrame:
    """Persist a frame, dealt out by key hash over :func:`target_partitions`
    parts. Rows, not cores, set their number, so fits don't depend on the
    cluster; the first copy is only read once."""
    first = frame.persist(StorageLevel.MEMORY_AND_DISK)
    out = first.repartition(target_partitions(first.count()), key).sortWithinPartitions(key).persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    first.unpersist()
    return out


def scores(td: TaskData, model) -> DataFrame:
    """Predictions of both sides in one frame."""
    pred = model.transform(td.frame)
    if td.task == "classification":
        if "probability" in pred.columns:
            pred = pred.withColumn("p1", models.p_one("probability"))
        elif "p1" not in pred.columns:  # boosted trees give it themselves
            pred = pred.withColumn("p1", models.margin("rawPrediction"))
    return pred


def evaluate_model(td: TaskData, model, threshold: float = 0.5) -> dict:
    """V8 / V9 of a fitted model as a dict of metrics."""
    pred = scores(td, model)
    if td.task == "regression":
        return evaluate.regression_report(pred, td.label).first().asDict()
    if "probability" in pred.columns or "rawPrediction" not in pred.columns:
        rep = evaluate.classification_report(pred, td.label, p1="p1", threshold=threshold)
    else:
        rep = evaluate.classification_report(pred, td.label, predicted="prediction", score="p1")
    return rep.first().asDict()


def baseline_metrics(td: TaskData) -> dict:
    """M1 / M2 evaluated on both sides."""
    if td.task == "regression":
        pred = models.predict_constant(td.frame, td.stats.mean)
        return evaluate.regression_report(pred, td.label).first().asDict()
    pred = models.predict_class_constant(td.frame, int(td.stats.mode))
    return evaluate.classification_report(pred, td.label, p1="p1",
                                          predicted="prediction").first().asDict()


def fit_and_evaluate(td: TaskData, estimator, threshold: float = 0.5) -> tuple[object, dict]:
    model = estimator.fit(td.train)
    return model, evaluate_model(td, model, threshold)


def save_pipeline(td: TaskData, model, name: str) -> str:
    """S5 + S6: the fitted feature stages and the model as one pipeline."""
    return runlog.save_model(PipelineModel(stages=[*td.feature_model.stages, model]),
                             unique_path(td.frame.sparkSession, "models", name))


def fit_evaluate_save(td: TaskData, estimator, name: str) -> tuple[dict, str]:
    model, metrics = fit_and_evaluate(td, estimator)
    return metrics, save_pipeline(td, model, name)
