"""Evaluation of predictions (columns ``label``, ``prediction``, ``probability``), technical and in money.

Everything starts from one aggregate: four conditional counts, or counts per distinct score.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetrisk.functions import fixed
from fleetrisk.functions.numbers import count_if, ratio, ratio_or_zero
from fleetrisk.operators.running import ONE_TASK_ROWS, running_totals


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row (true_negative, false_positive, false_negative, true_positive), whatever classes occur."""
    y, p = F.col(label), F.col(prediction)
    return df.agg(
        count_if((y == 0) & (p == 0)).alias("true_negative"), count_if((y == 0) & (p == 1)).alias("false_positive"),
        count_if((y == 1) & (p == 0)).alias("false_negative"), count_if((y == 1) & (p == 1)).alias("true_positive"))


def class_metrics(cm: DataFrame) -> DataFrame:
    """Rates from a confusion matrix; a rate without cases is 0."""
    tn, fp, fn, tp = (F.col(c) for c in ("true_negative", "false_positive", "false_negative", "true_positive"))
    recall, alarms = ratio_or_zero(tp, tp + fn), ratio_or_zero(fp, fp + tn)
    return cm.select(
        "*", ratio_or_zero(tp + tn, tp + tn + fp + fn).alias("accuracy"), ratio_or_zero(tp, tp + fp).alias("precision"),
        recall.alias("recall"), ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        ratio_or_zero(tn, tn + fp).alias("specificity"), alarms.alias("false_positive_rate"),
        ratio_or_zero(fn, fn + tp).alias("false_negative_rate"), recall.alias("detection_rate"),
        alarms.alias("false_alarm_rate"))


def score_points(df: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """(threshold, pos, neg) per distinct score."""
    return df.where(F.col(label).isNotNull() & F.col(probability).isNotNull()).groupBy(
        F.col(probability).alias("threshold")).agg(
        count_if(F.col(label) == 1).alias("pos"), count_if(F.col(label) == 0).alias("neg"))


def _curve(df: DataFrame, label: str, probability: str, one_task_rows: int):
    """Points from the highest score down, with cumulative positives (cum_pos) and negatives (cum_neg)."""
    return running_totals(score_points(df, label, probability), F.col("threshold").desc(), ["pos", "neg"], one_task_rows)


def roc_curve(df, label="label", probability="probability", one_task_rows=ONE_TASK_ROWS) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the starting point (null, 0, 0), where nothing is flagged.

    Rates are null when a class is absent; no scores give no rows.
    """
    points, total = _curve(df, label, probability, one_task_rows)
    curve = points.select("threshold", _share(F.col("cum_neg"), total["neg"]).alias("fpr"),
                          _share(F.col("cum_pos"), total["pos"]).alias("tpr"))
    return _with_start(curve, total, fpr=_share(F.lit(0), total["neg"]), tpr=_share(F.lit(0), total["pos"]))


def pr_curve(df, label="label", probability="probability", one_task_rows=ONE_TASK_ROWS) -> DataFrame:
    """(threshold, precision, recall, no_skill) per distinct score, and the starting point of precision 1 and recall 0.

    no_skill is the share of positives. The starting point has no threshold; no scores give no rows.
    """
    points, total = _curve(df, label, probability, one_task_rows)
    n = (total["pos"] or 0) + (total["neg"] or 0)
    no_skill = _share(F.lit(total["pos"] or 0), n)
    curve = points.select(
        "threshold", ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        _share(F.col("cum_pos"), total["pos"]).alias("recall"), no_skill.alias("no_skill"))
    return _with_start(curve, total, precision=F.lit(1.0), recall=_share(F.lit(0), total["pos"]), no_skill=no_skill)


def _with_start(curve: DataFrame, total: dict, **start: Column) -> DataFrame:
    """The curve and the point above its highest score, if it has any."""
    if total["pos"] is None:
        return curve
    kind = curve.schema["threshold"].dataType
    point = curve.sparkSession.range(1).select(
        F.lit(None).cast(kind).alias("threshold"), *[c.alias(n) for n, c in start.items()])
    return curve.unionByName(point)


def ranking_metrics(df, label="label", probability="probability", one_task_rows=ONE_TASK_ROWS) -> DataFrame:
    """One row (roc_auc, average_precision, pr_auc): exact, ties counted half; null when a class is absent."""
    points, total = _curve(df, label, probability, one_task_rows)
    d = {c: F.col(c).cast("double") for c in ("pos", "neg", "cum_pos", "cum_neg")}
    here = ratio(d["cum_pos"], d["cum_pos"] + d["cum_neg"])
    before = F.coalesce(ratio(d["cum_pos"] - d["pos"], d["cum_pos"] - d["pos"] + d["cum_neg"] - d["neg"]), F.lit(1.0))
    sums = points.agg(
        F.sum(d["neg"] * (d["cum_pos"] - d["pos"] / 2.0)).alias("auc"),
        F.sum(d["pos"] * here).alias("ap"), F.sum(d["pos"] * (here + before) / 2.0).alias("pr"))
    pairs = float(total["pos"] or 0) * float(total["neg"] or 0)
    return sums.select(_share(F.col("auc"), pairs).alias("roc_auc"),
                       _share(F.col("ap"), total["pos"]).alias("average_precision"),
                       _share(F.col("pr"), total["pos"]).alias("pr_auc"))


def _share(x: Column, total) -> Column:
    return x.cast("double") / float(total) if total else F.lit(None).cast("double")


def calibration_bins(df, label="label", probability="probability", bins: int = 10) -> DataFrame:
    """(bin, mean_predicted, fraction_positive, n) of equal bins closed on the right; empty bins are left out."""
    p = F.col(probability)
    which = F.greatest(F.ceil(p * bins) - 1, F.lit(0)).cast("int")
    return df.where(p.isNotNull()).groupBy(which.alias("bin")).agg(
        F.avg(probability).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"))


def classification_report(df, label="label", prediction="prediction") -> DataFrame:
    """(label, precision, recall, f1_score, support) per class, then accuracy, macro and weighted average.

    One row per pair of classes after the first aggregate; all the rest runs on those.
    """
    pairs = df.groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("said"),
                 F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hit")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("said"),
                 F.lit(0).cast("bigint").alias("hit")))).alias("s")).select("s.*")
    by_class = sides.groupBy("label").agg(F.sum("actual").alias("support"), F.sum("said").alias("said"),
                                          F.sum("hit").alias("hit"))
    scored = by_class.select(
        "label", ratio_or_zero(F.col("hit"), F.col("said")).alias("precision"),
        ratio_or_zero(F.col("hit"), F.col("support")).alias("recall"),
        ratio_or_zero(2 * F.col("hit"), F.col("said") + F.col("support")).alias("f1_score"), "support", "hit")
    # The averages are windows over one row per class; the first class carries the summary rows.
    rates = ("precision", "recall", "f1_score")
    whole = Window.partitionBy()
    n = F.sum("support").over(whole)
    hits = F.sum("hit").over(whole)

    def row(name, values, support):
        return F.struct(name.alias("label"), *[v.alias(c) for c, v in zip(rates, values)], support.alias("support"))

    accuracy = ratio_or_zero(hits, n)
    macro = [F.avg(c).over(whole) for c in rates]
    weighted = [ratio_or_zero(F.sum(F.col(c) * F.col("support")).over(whole), n) for c in rates]
    wide = scored.select("*", row(F.lit("accuracy"), [accuracy] * 3, n).alias("a"), row(F.lit("macro avg"), macro, n).alias("m"),
                         row(F.lit("weighted avg"), weighted, n).alias("w"),
                         F.row_number().over(Window.orderBy("label")).alias("i"))
    own = row(F.col("label"), [F.col(c) for c in rates], F.col("support"))
    return wide.select(F.explode(F.when(F.col("i") == 1, F.array(own, "a", "m", "w")).otherwise(F.array(own))).alias("r")).select("r.*")


# -- money ------------------------------------------------------------------------------------------

def _counts():
    return (F.col(c).cast("double") for c in ("true_negative", "false_positive", "false_negative", "true_positive"))


def _cost_columns(costs: dict | None) -> dict[str, Column]:
    c = {**fixed.COSTS_EVALUATION, **(costs or {})}
    tn, fp, fn, tp = _counts()
    n = tn + fp + fn + tp
    cost = tp * c["preventive"] + fp * (c["preventive"] + c["false_alarm"]) + fn * c["missed"]
    base = n * c["reactive"]
    return {
        "total_cost_with_pm": cost,
        "total_cost_without_pm": base,
        "cost_savings": base - cost,
        "savings_percentage": ratio_or_zero((base - cost) * 100.0, base),
        "preventive_maintenances": F.col("true_positive") + F.col("false_positive"),
        "reactive_maintenances_avoided": F.col("true_positive"),
        "missed_failures": F.col("false_negative"),
        "false_alarms": F.col("false_positive"),
        "cost_per_vehicle": ratio_or_zero(cost, n),
    }


def business_cost(cm: DataFrame, costs: dict | None = None) -> DataFrame:
    """Costs with and without prediction, against repairing every case after it failed."""
    return cm.select(*[e.alias(n) for n, e in _cost_columns(costs).items()])


def business_plan(cm: DataFrame, costs: dict | None = None) -> DataFrame:
    """Savings, return and payback of an investment; payback is null when nothing is saved."""
    c = {**fixed.COSTS_PLANNING, **(costs or {})}
    tn, fp, fn, tp = _counts()
    n = tn + fp + fn + tp
    cost = (tp + fp) * c["preventive"] + fn * c["reactive"] + fp * c["false_alarm"]
    base = n * c["reactive"]
    saved = base - cost
    invest = F.lit(float(c["investment"]))
    return cm.select(
        cost.alias("total_cost_with_pm"), base.alias("total_cost_without_pm"), saved.alias("total_savings"),
        ratio_or_zero(saved * 100.0, base).alias("savings_percentage"), invest.alias("investment_cost"),
        ratio_or_zero(saved * 100.0, invest).alias("roi_percentage"),
        F.when(saved > 0, ratio(invest, saved * 12.0)).alias("payback_period_years"),
        (F.col("true_positive") + F.col("false_positive")).alias("preventive_maintenances"),
        F.col("true_positive").alias("reactive_maintenances_avoided"), F.col("false_negative").alias("missed_failures"),
        F.col("false_positive").alias("false_alarms"), ratio_or_zero(tp, tp + fn).alias("detection_rate"),
        ratio_or_zero(fp, fp + tn).alias("false_alarm_rate"),
        F.floor(tp * c["downtime_hours"]).cast("bigint").alias("downtime_hours_avoided"),
        (tp * c["downtime_hour"] * c["downtime_hours"]).alias("downtime_cost_avoided"),
        F.lit(float(c["downtime_hours"])).alias("avg_downtime_hours"))


def business_savings(cm: DataFrame, costs: dict | None = None) -> DataFrame:
    """Savings of early detections less the price of false alarms, and the first-year return."""
    c = {**fixed.COSTS_TRAINING, **(costs or {})}
    tn, fp, fn, tp = _counts()
    saved = tp * c["saved"] - fp * c["planned"]
    return cm.select(
        (F.col("true_positive") + F.col("false_negative")).alias("total_failures"),
        ratio_or_zero(tp, tp + fn).alias("detection_rate"), ratio_or_zero(fp, fp + tn).alias("false_alarm_rate"),
        saved.alias("estimated_savings"), (saved / (c["planned"] * 100.0)).alias("roi_first_year"))


# -- words ------------------------------------------------------------------------------------------

def _texts() -> dict[str, Column]:
    """Sentences over the columns of ``class_metrics`` and ``business_cost``."""
    def pct(c):
        return F.format_string("%.1f%%", F.col(c) * 100.0)

    summary = F.concat(
        F.lit("The model achieves "), pct("accuracy"), F.lit(" accuracy with "), pct("precision"),
        F.lit(" precision and "), pct("recall"),
        F.lit(" recall. This indicates good predictive capability for vehicle maintenance needs."))
    impact = F.concat(
        F.lit("Implementing this predictive maintenance system could save "),
        F.format_string("$%,.2f (%.1f%%)", "cost_savings", "savings_percentage"),
        F.lit(" compared to reactive maintenance. It would enable "), F.col("reactive_maintenances_avoided").cast("string"),
        F.lit(" preventive interventions while generating "), F.col("false_alarms").cast("string"), F.lit(" false alarms."))
    advice = F.array_compact(F.array(
        F.when(F.col("recall") < 0.7, fixed.ADVICE_RECALL), F.when(F.col("precision") < 0.6, fixed.ADVICE_PRECISION),
        F.when(F.col("false_alarms") > F.col("reactive_maintenances_avoided"), fixed.ADVICE_ALARMS)))
    advice = F.when(F.size(advice) == 0, F.array(F.lit(fixed.ADVICE_GOOD))).otherwise(advice)
    return {"performance_summary": summary, "business_impact": impact, "recommendations": advice}


def full_metrics(cm: DataFrame, costs: dict | None = None) -> DataFrame:
    """Class metrics and money side by side: one row, one projection."""
    return class_metrics(cm).select("*", *[e.alias(n) for n, e in _cost_columns(costs).items()])


def interpretation(metrics: DataFrame) -> DataFrame:
    """(section, position, text): summary, impact and one row per piece of advice."""
    t = _texts()
    rows = metrics.select(
        F.concat(
            F.array(F.struct(F.lit("performance_summary").alias("section"), F.lit(0).alias("position"),
                             t["performance_summary"].alias("text"))),
            F.array(F.struct(F.lit("business_impact").alias("section"), F.lit(0).alias("position"),
                             t["business_impact"].alias("text"))),
            F.transform(t["recommendations"], lambda x, i: F.struct(
                F.lit("recommendations").alias("section"), i.alias("position"), x.alias("text")))).alias("rows"))
    return rows.select(F.explode("rows").alias("r")).select("r.*")


def evaluation_report(df: DataFrame, model_name: str, run_date: str, costs: dict | None = None, label="label",
                      prediction="prediction", probability="probability") -> DataFrame:
    """One JSON document: model, dataset, metrics, money and interpretation."""
    metrics = full_metrics(confusion_matrix(df, label, prediction), costs)
    ranked = ranking_metrics(df, label, probability).first()  # three numbers
    t = _texts()
    counts = ["true_negative", "false_positive", "false_negative", "true_positive"]
    rates = ["accuracy", "precision", "recall", "f1_score", "specificity", "false_positive_rate",
             "false_negative_rate", "detection_rate", "false_alarm_rate"]
    money = list(_cost_columns(costs))
    n = reduce(lambda a, b: a + b, [F.col(c) for c in counts])
    doc = F.struct(
        F.lit(run_date).alias("run_date"), F.lit(model_name).alias("model_name"),
        F.struct(n.alias("records"), (F.col("true_positive") + F.col("false_negative")).alias("positives")).alias("dataset_info"),
        F.struct(*rates, *[F.lit(ranked[c]).cast("double").alias(c) for c in ranked.asDict()],
                 F.struct(*counts).alias("confusion_matrix")).alias("performance_metrics"),
        F.struct(*money).alias("business_metrics"),
        F.struct(*[e.alias(k) for k, e in t.items()]).alias("model_interpretation"))
    return metrics.select(F.lit(model_name).alias("model_name"), F.to_json(doc).alias("report"))
