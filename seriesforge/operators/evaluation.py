"""Metrics over long predictions: (model, row keys, y_true, y_pred)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.functions.distributions import t_p_value
from seriesforge.functions.scalar import clip_at_zero, improvement, percentage_error
from seriesforge.operators.ordering import running_totals
from seriesforge.specs import RAIN_THRESHOLD

METRICS = ("MAE", "MSE", "RMSE", "R2")
LOWER_IS_BETTER = {"MAE": True, "MSE": True, "RMSE": True, "MAPE": True, "R2": False, "AUC_ROC": False}


def long_predictions(
    df: DataFrame, actual: str, predicted: dict[str, str], keep: Sequence[str], common: bool = True
) -> DataFrame:
    """Columns of predictions, one per model, in long form.

    Only rows that every model predicts are kept, so that metrics compare models on the same rows; without ``common``
    each model keeps the rows it predicts.
    """
    pairs = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("y_pred")) for m, c in predicted.items()]
    )
    rows = df.dropna(subset=[actual, *predicted.values()]) if common else df
    long = rows.select(*keep, F.col(actual).cast("double").alias("y_true"), F.inline(pairs))
    return long.filter(F.col("y_pred").isNotNull() & F.col("y_true").isNotNull())


def residuals(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("residuals", F.col("y_true") - F.col("y_pred"))


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Error metrics per model, all in one aggregate.

    MAPE keeps the sign-carrying denominator y + 1e-8; the residual deviation is
    the population one.
    """
    e = F.col("y_true") - F.col("y_pred")
    squared = F.sum(e * e)
    spread = F.var_pop("y_true") * F.count("y_true")
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("MAE"),
        F.avg(e * e).alias("MSE"),
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        (F.lit(1.0) - F.try_divide(squared, spread)).alias("R2"),
        (F.avg(percentage_error(F.col("y_true"), F.col("y_pred"))) * 100).alias("MAPE"),
        F.avg(e).alias("Mean_Residual"),
        F.stddev_pop(e).alias("Std_Residual"),
    )


def occurrences(predictions: DataFrame, threshold: float = RAIN_THRESHOLD) -> DataFrame:
    """Actual and predicted events (value above the threshold) as booleans."""
    return predictions.withColumns(
        {"event": F.col("y_true") > F.lit(threshold), "predicted_event": F.col("y_pred") > F.lit(threshold)}
    )


def confusion_counts(predictions: DataFrame, threshold: float = RAIN_THRESHOLD) -> DataFrame:
    """tp, fp, fn, tn per model; absent cells are 0."""
    hit, said = F.col("event"), F.col("predicted_event")
    return (
        occurrences(predictions, threshold)
        .groupBy("model")
        .agg(
            F.count_if(hit & said).alias("tp"),
            F.count_if(~hit & said).alias("fp"),
            F.count_if(hit & ~said).alias("fn"),
            F.count_if(~hit & ~said).alias("tn"),
        )
    )


def confusion_matrix(predictions: DataFrame, threshold: float = RAIN_THRESHOLD) -> DataFrame:
    """The same in long form: (model, event, predicted_event, n), four rows per model."""
    cells = [
        F.struct(F.lit(a).alias("event"), F.lit(p).alias("predicted_event"), F.col(c).alias("n"))
        for a, p, c in ((True, True, "tp"), (False, True, "fp"), (True, False, "fn"), (False, False, "tn"))
    ]
    return confusion_counts(predictions, threshold).select("model", F.inline(F.array(*cells)))


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and the AUC of the thresholded prediction."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return counts.select(
        "model",
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(2 * precision * recall, precision + recall).alias("f1"),
        ((recall + F.try_divide(tn, tn + fp)) / 2).alias("auc_roc"),
    )


def _score_counts(predictions: DataFrame, threshold: float, floor: bool) -> DataFrame:
    """Positives and negatives per model and distinct score: everything ROC needs."""
    score = clip_at_zero(F.col("y_pred")) if floor else F.col("y_pred")
    event = F.col("y_true") > F.lit(threshold)
    return predictions.groupBy("model", score.alias("score")).agg(
        F.count_if(event).alias("pos"), F.count_if(~event).alias("neg")
    )


def auc_roc(predictions: DataFrame, threshold: float = RAIN_THRESHOLD, floor: bool = False) -> DataFrame:
    """Exact AUC per model from continuous scores, ties counted half; NULL with one class only.

    Scores are reduced to counts per distinct value and cumulated per score
    bucket, so no model's scores are ordered in one task.
    """
    counted = _score_counts(predictions, threshold, floor)
    totals = running_totals(counted, ["model"], "score", ["pos", "neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total")
    return totals.groupBy("model").agg(F.try_divide(wins, pairs).alias("AUC_ROC"))


def roc_points(predictions: DataFrame, threshold: float = RAIN_THRESHOLD, floor: bool = False) -> DataFrame:
    """(model, score, fpr, tpr) for every distinct score taken as the cut, highest first."""
    counted = _score_counts(predictions, threshold, floor)
    totals = running_totals(counted, ["model"], "score", ["pos", "neg"], descending=True)
    return totals.select(
        "model",
        "score",
        F.try_divide(F.col("neg_before") + F.col("neg"), "neg_total").alias("fpr"),
        F.try_divide(F.col("pos_before") + F.col("pos"), "pos_total").alias("tpr"),
    )


def rank_models(metrics: DataFrame, by: str = "RMSE") -> DataFrame:
    """Comparison table with ``rank``, best first; equal values are ordered by name.

    One row per model, so ordering it in one task is fine.
    """
    best = F.col(by).asc_nulls_last() if LOWER_IS_BETTER.get(by, False) else F.col(by).desc_nulls_last()
    return metrics.withColumn("rank", F.row_number().over(Window.orderBy(best, "model")))


def best_model(metrics: DataFrame, by: str = "RMSE") -> DataFrame:
    return rank_models(metrics, by).filter("rank = 1")


def metric_ranking(metrics: DataFrame, names: Sequence[str] = ("RMSE", "MAE", "R2")) -> DataFrame:
    """Long form for charts: (model, metric, value, rank), each metric ranked in its direction."""
    cells = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(m).alias("value"),
                (F.col(m) if LOWER_IS_BETTER[m] else -F.col(m)).alias("_sort"),
            )
            for m in names
        ]
    )
    long = metrics.select("model", F.inline(cells))
    order = Window.partitionBy("metric").orderBy(F.col("_sort").asc_nulls_last(), "model")
    return long.withColumn("rank", F.row_number().over(order)).drop("_sort")


def improvement_over(metrics: DataFrame, baseline: str, metric: str = "RMSE") -> DataFrame:
    """Percentage gain of each model over the baseline model."""
    base = metrics.filter(F.col("model") == baseline).agg(F.max(metric)).scalar()
    return metrics.select("model", metric, improvement(base, F.col(metric)).alias("improvement"))


def compare_feature_sets(without: DataFrame, engineered: DataFrame, metric: str = "RMSE") -> DataFrame:
    """Per model: the metric with and without engineered features, and the gain."""
    joined = without.select("model", F.col(metric).alias("original")).join(
        engineered.select("model", F.col(metric).alias("engineered")), "model"
    )
    return joined.withColumn("improvement", improvement(F.col("original"), F.col("engineered")))


def prediction_table(predictions: DataFrame, models: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Aligned predictions: keys, Actual, one ``<model>_pred`` column per model."""
    picks = [F.max(F.when(F.col("model") == m, F.col("y_pred"))).alias(f"{m}_pred") for m in models]
    return predictions.groupBy(*keys).agg(F.max("y_true").alias("Actual"), *picks)


def paired_tests(predictions: DataFrame, models: Sequence[str], keys: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """Paired t-tests of absolute errors for every pair of models.

    The rows of one key are first folded into one row with an error per model;
    all pairs are then one aggregate over column differences.  The number of
    models is small, the number of rows is not.
    """
    errors = [F.max(F.when(F.col("model") == m, F.abs(F.col("y_true") - F.col("y_pred")))).alias(f"_e{i}") for i, m in enumerate(models)]
    wide = predictions.groupBy(*keys).agg(*errors)
    pairs = list(combinations(range(len(models)), 2))
    folded = []
    for i, j in pairs:
        d = F.col(f"_e{i}") - F.col(f"_e{j}")
        folded += [
            F.count(d).alias(f"n_{i}_{j}"),
            F.avg(d).alias(f"mean_{i}_{j}"),
            F.stddev_samp(d).alias(f"sd_{i}_{j}"),
        ]
    cells = [
        F.struct(
            F.lit(models[i]).alias("first"),
            F.lit(models[j]).alias("second"),
            F.col(f"n_{i}_{j}").alias("n"),
            F.col(f"mean_{i}_{j}").alias("mean_difference"),
            F.try_divide(F.col(f"mean_{i}_{j}"), F.col(f"sd_{i}_{j}") / F.sqrt(F.col(f"n_{i}_{j}"))).alias("t"),
        )
        for i, j in pairs
    ]
    tests = wide.agg(*folded).select(F.inline(F.array(*cells)))
    tests = tests.withColumn("p_value", t_p_value(F.col("t"), F.col("n") - 1))
    return tests.withColumn("significant", F.col("p_value") < alpha)


def significance_matrix(tests: DataFrame, models: Sequence[str]) -> DataFrame:
    """Square matrix of p-values: one row and one column per model."""
    both = tests.select("first", "second", "p_value").union(tests.select("second", "first", "p_value"))
    cells = [F.max(F.when(F.col("second") == m, F.col("p_value"))).alias(m) for m in models]
    return both.groupBy(F.col("first").alias("model")).agg(*cells)


def test_summary(tests: DataFrame) -> DataFrame:
    """Which model of each pair has the smaller errors, where the difference is significant."""
    better = (
        F.when(~F.col("significant"), F.lit("no significant difference"))
        .when(F.col("mean_difference") < 0, F.col("first"))
        .otherwise(F.col("second"))
    )
    return tests.withColumn("better", better)


def single_class(df: DataFrame, label: str) -> Column:
    """Scalar: whether a label column holds one class only."""
    return df.agg(F.min(label) == F.max(label)).scalar()
