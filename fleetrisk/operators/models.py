"""MLlib models: training, time-ordered search, comparison, importance, ensembles, persistence."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, ImputerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetrisk.functions.numbers import finite
from fleetrisk.operators import evaluation as ev
from fleetrisk.operators.features import columns_with_nulls, fill_median
from fleetrisk.operators.oversampling import oversample
from fleetrisk.operators.training_sets import expanding_folds, in_time_order, with_class_weights
from fleetrisk.session import stored

SEED = 42
#: Rows of all fits that run side by side; the trees that the driver holds meanwhile grow with them.
SIDE_ROWS = 200_000
FAMILIES = ("logistic_regression", "random_forest", "boosted_trees", "gradient_boosting")


@dataclass
class Search:
    """Best parameters of a family, its mean score, all (parameters, fold, score) and the refitted model."""

    family: str
    params: dict
    score: float
    scores: list = field(default_factory=list)
    model: PipelineModel | None = None


def classifier(family: str, label: str = "label", weight: str | None = None, **params) -> Estimator:
    common = {"labelCol": label, "featuresCol": "features", **params}
    if weight:
        common["weightCol"] = weight
    if family == "logistic_regression":
        return LogisticRegression(**{"maxIter": 1000, **common})
    if family == "random_forest":
        return RandomForestClassifier(**{"seed": SEED, **common})
    if family in ("boosted_trees", "gradient_boosting"):
        return GBTClassifier(**{"seed": SEED, **common})
    raise ValueError(f"Unknown model family: {family}")


def parameter_grid(family: str) -> list[dict]:
    """The search space of a family, as named parameters.

    MLlib trees have no minimum split size and end at depth 30, which stands for "unlimited".
    """
    # The search grids.
    spaces = {
        "logistic_regression": {},
        "random_forest": {"numTrees": [100, 200], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2]},
        "boosted_trees": {"maxIter": [100, 200], "maxDepth": [3, 6, 9], "stepSize": [0.01, 0.1], "subsamplingRate": [0.8, 1.0]},
        "gradient_boosting": {"maxIter": [100, 200], "stepSize": [0.01, 0.1], "maxDepth": [3, 5]},
    }
    model = classifier(family)
    builder = ParamGridBuilder()
    for name, values in spaces[family].items():
        builder = builder.addGrid(model.getParam(name), values)
    return [{p.name: v for p, v in point.items()} for point in builder.build()]


def check_training_data(df: DataFrame, label: str) -> None:
    classes = df.select(F.countDistinct(label).alias("n")).first()["n"]
    if classes < 2:
        raise ValueError("training needs rows of two classes")


def stages(features: list[str], gaps: list[str] | None = None) -> list:
    """Median imputation and assembly, saved with the model so that scoring needs nothing else.

    A model for rows that are known to have ``gaps`` in some features only needs the medians of those.
    """
    gaps = list(features) if gaps is None else gaps
    filled = [f"{c}_filled" for c in gaps]
    ready = dict(zip(gaps, filled))
    imputer = [Imputer(strategy="median", inputCols=gaps, outputCols=filled)] if gaps else []
    return [*imputer, VectorAssembler(inputCols=[ready.get(c, c) for c in features], outputCol="features", handleInvalid="keep")]


def model_input(df: DataFrame, features: list[str], *others: str) -> DataFrame:
    """Only what a fit needs; features as doubles with NaN as null."""
    return df.select(*[finite(F.col(c)).alias(c) for c in features], *others)


def train(df: DataFrame, family: str, features: list[str], label: str = "label", balanced: bool = False,
          check: bool = True, written: bool = False, **params) -> PipelineModel:
    """One model; ``balanced`` weights the classes equally.

    A fit passes over its input many times, so what makes the rows runs once and they are written, unless they are
    ``written`` already. A pass has as many tasks as the bytes ask for instead of one for each shuffle partition.
    """
    if not features:
        raise ValueError("training needs at least one feature")
    data = model_input(df, features, label)
    if not written:
        data = stored(data, "training")
    weight = "_weight" if balanced else None
    if balanced:  # the class counts double as the check
        data = with_class_weights(data, label, weight, classes=2 if check else 1)
    elif check:
        check_training_data(data, label)
    return Pipeline(stages=[*stages(features), classifier(family, label, weight, **params)]).fit(data)


def train_logistic_regression(df, features, label="label", **params) -> PipelineModel:
    return train(df, "logistic_regression", features, label, **params)


def train_random_forest(df, features, label="label", balanced=True, **params) -> PipelineModel:
    return train(df, "random_forest", features, label, balanced=balanced, **params)


def train_boosted_trees(df, features, label="label", **params) -> PipelineModel:
    return train(df, "boosted_trees", features, label, **params)


def train_gradient_boosting(df, features, label="label", **params) -> PipelineModel:
    return train(df, "gradient_boosting", features, label, **params)


def predict(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """df with ``probability`` of class 1 and ``prediction`` 0/1; the model's own columns are dropped."""
    features = feature_names(model)
    inputs = [c for c in df.columns if c not in ("probability", "prediction")]
    clean = df.select(*[finite(F.col(c)).alias(c) if c in features else F.col(c) for c in df.columns])
    scored = model.transform(clean).withColumn("_p", vector_to_array("probability")[1])
    keep = [F.col(c) for c in inputs]
    return scored.select(*keep, F.col("_p").alias("probability"),
                         F.when(F.col("_p") > threshold, 1).otherwise(0).alias("prediction"))


def feature_names(model: PipelineModel) -> list[str]:
    """The features that go into the vector; a stage before may derive them from raw readings."""
    return list(next(s for s in model.stages if isinstance(s, ImputerModel)).getInputCols())


def from_readings(features: Transformer, model: PipelineModel) -> PipelineModel:
    """A model of features as one of raw readings: what is saved, loaded and scored is the whole way."""
    return PipelineModel([features, *model.stages])


def roc_auc(model: PipelineModel, df: DataFrame, label: str, features: list[str] | None = None) -> float:
    """Exact area (numBins=0: every score is a threshold), by a distributed sort."""
    judge = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", numBins=0)
    return float(judge.evaluate(model.transform(model_input(df, features or feature_names(model), label))))


def search(df: DataFrame, grids: dict[str, list[dict]], features: list[str], label: str = "label", folds: int = 5,
           share: float | None = None, balanced: tuple = ("random_forest",), parallelism: int | None = None, refit: bool = True,
           order: dict | None = None, written: bool = False) -> list[Search]:
    """One Search per family over expanding time folds.

    Folds are the outer loop, so each is prepared (oversampled, imputed, cached) once for all
    families and parameters, and only one is held at a time. ``share`` oversamples training parts
    only. A fold with one class only has no area and is left out. Ties go to the earlier point.
    The rows are written once in the order of time, unless they are ``written`` so already. ``parallelism`` fits run side by
    side; by default as many as keep the cores busy with the passes over a small fold, but two over a large one.
    """
    if not written:
        df = in_time_order(df, [(order or {}).get("ts", "ts"), (order or {}).get("seq", "event_id")])
    points = [(family, point) for family, grid in grids.items() for point in grid]
    # A fold's models see no other rows than these: medians of features without gaps would not be used.
    gaps, scores = columns_with_nulls(df, features), []
    for k, (past, coming) in enumerate(expanding_folds(df, folds, **(order or {}))):
        past = _weighted(past, features, label, share, balanced)
        coming = model_input(coming, features, label).persist()
        held = [coming]
        if share:  # made rows are held; others are read again from where they were written
            held.append(past.persist())
        try:
            if min(past.select(label).distinct().count(), coming.select(label).distinct().count()) < 2:
                continue
            prepared = Pipeline(stages=stages(features, gaps)).fit(past)
            ready = prepared.transform(past).select("features", label, "_weight").persist()
            held.append(ready)

            side = parallelism or side_by_side(ready)

            def fit(job: tuple) -> tuple[str, dict, int, float]:
                family, point = job
                head = classifier(family, label, "_weight" if family in balanced else None, **point).fit(ready)
                return family, point, k, roc_auc(PipelineModel([*prepared.stages, head]), coming, label, features)

            with ThreadPoolExecutor(side) as pool:
                scores += list(pool.map(fit, points))
        finally:
            for part in held:
                part.unpersist()
    if not scores:
        raise ValueError("no fold holds both classes")

    found = []
    for family, grid in grids.items():
        own = [(p, k, v) for f, p, k, v in scores if f == family]
        means = [sum(v for p, _, v in own if p == point) / sum(p == point for p, _, _ in own) for point in grid]
        best = means.index(max(means))
        found.append(Search(family, grid[best], means[best], own))
    if refit:
        data = _weighted(df, features, label, share, balanced)
        if share:
            data.persist()
        prepared = Pipeline(stages=stages(features)).fit(data)
        ready = prepared.transform(data).select("features", label, "_weight").persist()
        try:
            for s in found:
                head = classifier(s.family, label, "_weight" if s.family in balanced else None, **s.params).fit(ready)
                s.model = PipelineModel([*prepared.stages, head])
        finally:
            ready.unpersist()
            data.unpersist()
    return found


def side_by_side(ready: DataFrame) -> int:
    """How many fits run at once: a pass over few rows has few tasks, and the driver holds the trees of each fit."""
    return max(2, min(ready.sparkSession.sparkContext.defaultParallelism // ready.rdd.getNumPartitions(), SIDE_ROWS // max(1, ready.count())))


def _weighted(df: DataFrame, features: list[str], label: str, share: float | None, balanced: tuple) -> DataFrame:
    """Training input with a ``_weight``; oversampled if asked for."""
    # Gaps are filled before rows are made from others, by the medians of these rows only.
    rows = oversample(fill_median(df, columns_with_nulls(df, features)), label, features, share) if share else df
    rows = with_class_weights(rows, label, "_weight") if balanced else rows.withColumn("_weight", F.lit(1.0))
    return model_input(rows, features, label, "_weight")


def grid_search(df: DataFrame, family: str, features: list[str], label: str = "label", grid: list[dict] | None = None,
                **args) -> Search:
    """Best mean area of one family over the folds, refitted on all rows."""
    return search(df, {family: grid if grid is not None else parameter_grid(family)}, features, label, **args)[0]


def cross_validate(df: DataFrame, family: str, features: list[str], label: str = "label", params: dict | None = None,
                   **args) -> DataFrame:
    """One row (model_name, params, mean_score, std_score, all_scores) for one set of parameters."""
    found = search(df, {family: [params or {}]}, features, label, refit=False, **args)
    return cv_summary(scores_table(df.sparkSession, found))


def scores_table(spark: SparkSession, searches: list[Search]) -> DataFrame:
    """(model_name, params, fold, score) of every fit."""
    rows = [(s.family, str(sorted(p.items())), k, float(v)) for s in searches for p, k, v in s.scores]
    return spark.createDataFrame(rows, "model_name string, params string, fold int, score double")


def cv_summary(scores: DataFrame) -> DataFrame:
    """(model_name, params, mean_score, std_score, all_scores): population deviation, as of a fixed set of folds."""
    return scores.groupBy("model_name", "params").agg(
        F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"),
        F.transform(F.sort_array(F.collect_list(F.struct("fold", "score"))), lambda s: s["score"]).alias("all_scores"))


def model_metrics(model: PipelineModel, test: DataFrame, name: str, label: str = "label", threshold: float = 0.5) -> DataFrame:
    """One row: counts, rates and exact areas on the test set."""
    scored = predict(model, test.select(*feature_names(model), F.col(label).alias("label")), threshold).persist()
    try:
        areas = ev.ranking_metrics(scored).first()
        row = ev.class_metrics(ev.confusion_matrix(scored)).first()
    finally:
        scored.unpersist()
    values = {**row.asDict(), **areas.asDict()}
    schema = "model_name string, " + ", ".join(
        f"{c} {'bigint' if isinstance(row.asDict().get(c), int) and c.startswith(('true_', 'false_')) and not c.endswith('_rate') else 'double'}"
        for c in values)
    return test.sparkSession.createDataFrame(
        [(name, *[v if isinstance(v, int) else None if v is None else float(v) for v in values.values()])], schema)


def compare_models(models: dict[str, PipelineModel], test: DataFrame, label: str = "label") -> tuple[DataFrame, str]:
    """(one row per model, name of the one with the highest area; the first one given wins a tie)."""
    table = None
    for name, model in models.items():
        row = model_metrics(model, test, name, label)
        table = row if table is None else table.unionByName(row)
    areas = {r["model_name"]: r["roc_auc"] or 0.0 for r in table.select("model_name", "roc_auc").collect()}
    return table, max(models, key=lambda name: areas[name])


def feature_importance(model: PipelineModel, spark: SparkSession, top: int | None = None) -> DataFrame:
    """(feature, importance) in descending order: tree importances, or absolute coefficients."""
    head = model.stages[-1]
    if hasattr(head, "featureImportances"):
        values = head.featureImportances.toArray()
    elif hasattr(head, "coefficients"):
        values = abs(head.coefficients.toArray())
    else:
        raise ValueError("the model has neither importances nor coefficients")
    rows = sorted(zip(feature_names(model), map(float, values)), key=lambda r: (-r[1], r[0]))[:top]
    return spark.createDataFrame(rows, "feature string, importance double")


def top_by_forest(df: DataFrame, features: list[str], label: str, k: int, **params) -> list[str]:
    """The k features a random forest leans on most."""
    model = train(df, "random_forest", features, label, **params)
    return [r["feature"] for r in feature_importance(model, df.sparkSession, k).collect()]


def ensemble(models: list[PipelineModel], df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Soft vote: the mean probability of the models, in one pass over the rows."""
    out = df
    names = [f"_p{i}" for i in range(len(models))]
    for name, model in zip(names, models):
        out = predict(model, out).withColumnRenamed("probability", name).drop("prediction")
    mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / float(len(names))
    keep = [c for c in df.columns if c not in ("probability", "prediction")]
    return out.select(*keep, mean.alias("probability"), F.when(mean > threshold, 1).otherwise(0).alias("prediction"))


def save_model(model: PipelineModel, path: str, name: str, trained: str, importance: bool = True, metrics: dict | None = None) -> None:
    """The model, a one-row metadata table with its metrics, and its importances under one folder."""
    spark = SparkSession.getActiveSession()
    path = path.rstrip("/")
    model.write().overwrite().save(f"{path}/model")
    features = feature_names(model)
    measured = {k: float(v) for k, v in (metrics or {}).items() if v is not None and not isinstance(v, str)}
    spark.createDataFrame([(name, len(features), features, trained, measured)],
                          "model_name string, features_used int, features array<string>, training_date string, metrics map<string,double>"
                          ).coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    if importance:
        feature_importance(model, spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/importance")


def load_model(path: str) -> tuple[PipelineModel, DataFrame]:
    """(model, metadata)."""
    spark = SparkSession.getActiveSession()
    path = path.rstrip("/")
    schema = "model_name string, features_used int, features array<string>, training_date string, metrics map<string,double>"
    return PipelineModel.load(f"{path}/model"), spark.read.schema(schema).json(f"{path}/metadata")
