"""The training flow: features, time split, search over model families, comparison, saving."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetrisk.operators import evaluation as ev
from fleetrisk.operators import models as ml
from fleetrisk.operators.features import FleetFeatures, FleetFeaturesModel
from fleetrisk.operators.training_sets import in_time_order, ordered_split


def training_table(readings: DataFrame, target: str = "failure_in_next_7d", **params) -> tuple[DataFrame, FleetFeaturesModel]:
    """(features with order key and label, the stage that makes them). Written once: every fit starts from it.

    The rows are parquet in the order of time, so a split or fold, which is a comparison with literals, reads its own row
    groups, and a fit reads only the columns that it needs.
    """
    stage, table = FleetFeatures(**params).fit_table(readings)
    order = list(stage.getOrDefault("orderCols"))
    keep = [c for c in (stage.getOrDefault("keyCol"), *order) if c in table.columns]
    table = table.select(*keep, *stage.features(), table[target].alias("label"))
    return in_time_order(table, order), stage


def train_and_select(readings: DataFrame, target: str = "failure_in_next_7d",
                     families=("random_forest", "boosted_trees", "gradient_boosting"), grids: dict | None = None,
                     test_share: float = 0.2, share: float | None = 0.3, folds: int = 5, parallelism: int | None = None,
                     path: str | None = None, run_date: str = "") -> dict:
    """Searches every family on the older rows and keeps the model with the best area on the newest ones.

    The pipeline that is returned and saved takes raw readings; ``model`` is its part from the features on. The medians
    of the features are those of all readings given.
    """
    if target not in readings.columns:
        raise ValueError(f"Target column '{target}' not found in DataFrame")
    table, stage = training_table(readings, target)
    features = stage.features()
    past, newest = ordered_split(table, test_share)
    searches = ml.search(past, {f: (grids or {}).get(f) or ml.parameter_grid(f) for f in families}, features,
                         folds=folds, share=share, parallelism=parallelism, written=True)
    comparison, best = ml.compare_models({s.family: s.model for s in searches}, newest)
    model = next(s.model for s in searches if s.family == best)
    pipeline = ml.from_readings(stage, model)
    if path:
        metrics = comparison.where(comparison["model_name"] == best).drop("model_name").first().asDict()
        ml.save_model(pipeline, path, best, run_date, metrics=metrics)
    scored = ml.predict(model, newest)
    return {
        "model": model, "pipeline": pipeline, "best": best, "searches": searches, "comparison": comparison, "predictions": scored,
        "scores": ml.scores_table(table.sparkSession, searches),
        "importance": ml.feature_importance(model, table.sparkSession),
        "savings": ev.business_savings(ev.confusion_matrix(scored)),
    }
