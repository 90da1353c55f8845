"""Registered queries: metrics and model comparison, over two simple forecasts of the target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.operators import evaluation as ev
from seriesforge.operators.windows import window_features
from seriesforge.plans.catalog import dbl, query
from seriesforge.plans.inputs import WEEKLY, WEEKLY_SQL, weekly_weather
from seriesforge.sources.writers import append_metrics
from seriesforge.specs import TARGET, average_columns, lag_columns

MODELS = ("lag_1", "ma_3")
HEAVY = 75.0
KEYS = ["station", "Date"]


def forecasts(spark: SparkSession, folder: str, common: bool = True) -> DataFrame:
    """Persistence, and the mean of the three preceding weeks, in long form."""
    frame = weekly_weather(spark, folder).select("station", "Date", TARGET)
    wide = window_features(
        frame,
        WEEKLY,
        lags=lag_columns([TARGET], (1,)),
        averages=average_columns([TARGET], (3,)),
        exclude_current=True,
    )
    return ev.long_predictions(wide, TARGET, {"lag_1": f"{TARGET}_lag_1", "ma_3": f"{TARGET}_ma_3"}, KEYS, common)


_PAST = 'OVER (PARTITION BY station ORDER BY "Date" ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)'
FORECAST_SQL = f"""{WEEKLY_SQL}, wide AS (SELECT station, "Date", "{TARGET}" AS y,
  lag("{TARGET}", 1) OVER (PARTITION BY station ORDER BY "Date") AS lag_1,
  CASE WHEN count("{TARGET}") {_PAST} = 3 THEN avg("{TARGET}") {_PAST} END AS ma_3 FROM weekly),
f AS (SELECT station, "Date", y, 'lag_1' AS model, lag_1 AS p FROM wide WHERE lag_1 IS NOT NULL AND ma_3 IS NOT NULL
  UNION ALL SELECT station, "Date", y, 'ma_3', ma_3 FROM wide WHERE lag_1 IS NOT NULL AND ma_3 IS NOT NULL),
m AS (SELECT model, CAST(count(*) AS BIGINT) AS n, avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse,
  1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2, avg(abs((y - p) / (y + 1e-8))) * 100 AS mape,
  avg(y - p) AS mr, stddev_pop(y - p) AS sr FROM f GROUP BY model)"""

_METRICS = ", ".join(
    dbl(e, n)
    for e, n in (
        ("mae", "MAE"),
        ("mse", "MSE"),
        ("sqrt(mse)", "RMSE"),
        ("r2", "R2"),
        ("mape", "MAPE"),
        ("mr", "Mean_Residual"),
        ("sr", "Std_Residual"),
    )
)


@query(f"WITH {FORECAST_SQL} SELECT model, n, {_METRICS} FROM m")
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return ev.regression_metrics(forecasts(spark, folder))


@query(
    f"""WITH {FORECAST_SQL} SELECT model, CAST(row_number() OVER (ORDER BY mse, model) AS INTEGER) AS rank, n, {_METRICS}
FROM m"""
)
def rank_models(spark: SparkSession, folder: str) -> DataFrame:
    return ev.rank_models(ev.regression_metrics(forecasts(spark, folder)))


@query(f"WITH {FORECAST_SQL} SELECT model, CAST(1 AS INTEGER) AS rank, n, {_METRICS} FROM m ORDER BY mse, model LIMIT 1")
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return ev.best_model(ev.regression_metrics(forecasts(spark, folder)))


@query(
    f"""WITH {FORECAST_SQL}, l AS (SELECT model, 'RMSE' AS metric, sqrt(mse) AS v, sqrt(mse) AS s FROM m
  UNION ALL SELECT model, 'MAE', mae, mae FROM m UNION ALL SELECT model, 'R2', r2, -r2 FROM m)
SELECT model, metric, {dbl('v', 'value')},
  CAST(row_number() OVER (PARTITION BY metric ORDER BY s, model) AS INTEGER) AS rank FROM l"""
)
def metric_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return ev.metric_ranking(ev.regression_metrics(forecasts(spark, folder)))


@query(
    f"""WITH {FORECAST_SQL}, b AS (SELECT sqrt(mse) AS base FROM m WHERE model = 'lag_1')
SELECT model, {dbl('sqrt(mse)', 'RMSE')}, {dbl('(base - sqrt(mse)) / base * 100', 'improvement')} FROM m, b"""
)
def improvement(spark: SparkSession, folder: str) -> DataFrame:
    return ev.improvement_over(ev.regression_metrics(forecasts(spark, folder)), "lag_1")


@query(
    f"""WITH {FORECAST_SQL} SELECT model, n, {dbl('mae', 'MAE')}, NULL::DOUBLE AS "AUC_ROC" FROM m
UNION ALL SELECT model || '_again', NULL, {dbl('mae', 'MAE')}, 0.5 FROM m"""
)
def append_metrics_table(spark: SparkSession, folder: str) -> DataFrame:
    """One model's metrics added to an existing comparison with other columns."""
    metrics = ev.regression_metrics(forecasts(spark, folder)).select("model", "n", "MAE")
    added = metrics.select(
        F.concat("model", F.lit("_again")).alias("model"), "MAE", F.lit(0.5).alias("AUC_ROC")
    )
    return append_metrics(metrics, added)


@query(
    f"""WITH {FORECAST_SQL} SELECT station, "Date", model, {dbl('y', 'y_true')}, {dbl('p', 'y_pred')},
  {dbl('y - p', 'residuals')} FROM f"""
)
def residual_table(spark: SparkSession, folder: str) -> DataFrame:
    return ev.residuals(forecasts(spark, folder))


@query(
    f"""WITH {FORECAST_SQL} SELECT station, "Date", {dbl('y', 'Actual')}, {dbl('lag_1', 'lag_1_pred')},
  {dbl('ma_3', 'ma_3_pred')} FROM wide WHERE lag_1 IS NOT NULL"""
)
def pred_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return ev.prediction_table(forecasts(spark, folder, common=False), MODELS, KEYS)


_CELLS = f"""c AS (SELECT model, CAST(count(CASE WHEN y > {HEAVY} AND p > {HEAVY} THEN 1 END) AS BIGINT) AS tp,
  CAST(count(CASE WHEN y <= {HEAVY} AND p > {HEAVY} THEN 1 END) AS BIGINT) AS fp,
  CAST(count(CASE WHEN y > {HEAVY} AND p <= {HEAVY} THEN 1 END) AS BIGINT) AS fn,
  CAST(count(CASE WHEN y <= {HEAVY} AND p <= {HEAVY} THEN 1 END) AS BIGINT) AS tn FROM f GROUP BY model)"""


@query(
    f"""WITH {FORECAST_SQL}, {_CELLS} SELECT model, true AS event, true AS predicted_event, tp AS n FROM c
UNION ALL SELECT model, false, true, fp FROM c UNION ALL SELECT model, true, false, fn FROM c
UNION ALL SELECT model, false, false, tn FROM c"""
)
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return ev.confusion_matrix(forecasts(spark, folder), HEAVY)


@query(
    f"""WITH {FORECAST_SQL}, {_CELLS}, r AS (SELECT model, tp, fp, fn, tn, tp / CAST(tp + fp AS DOUBLE) AS pr,
  tp / CAST(tp + fn AS DOUBLE) AS re FROM c)
SELECT model, {dbl('(tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE)', 'accuracy')}, {dbl('pr', 'precision')},
  {dbl('re', 'recall')}, {dbl('2 * pr * re / (pr + re)', 'f1')},
  {dbl('(re + tn / CAST(tn + fp AS DOUBLE)) / 2', 'auc_roc')} FROM r"""
)
def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return ev.classification_metrics(ev.confusion_counts(forecasts(spark, folder), HEAVY))


@query(
    f"""WITH {FORECAST_SQL}, {_CELLS}, r AS (SELECT model, tp, fp, fn, tn, tp / CAST(tp + fp AS DOUBLE) AS pr,
  tp / CAST(tp + fn AS DOUBLE) AS re, (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2 AS auc FROM c)
SELECT model, {dbl('(tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE)', 'accuracy')}, {dbl('pr', 'precision')},
  {dbl('re', 'recall')}, {dbl('2 * pr * re / (pr + re)', 'f1')}, {dbl('auc', 'auc_roc')},
  CAST(row_number() OVER (ORDER BY auc DESC, model) AS INTEGER) AS rank FROM r"""
)
def class_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Models compared as event forecasts, the best by AUC first."""
    return ev.rank_models(ev.classification_metrics(ev.confusion_counts(forecasts(spark, folder), HEAVY)), "auc_roc")


_SCORES = f"""s AS (SELECT model, p AS score, count(CASE WHEN y > {HEAVY} THEN 1 END) AS pos,
  count(CASE WHEN y <= {HEAVY} THEN 1 END) AS neg FROM f GROUP BY 1, 2)"""


@query(
    f"""WITH {FORECAST_SQL}, {_SCORES}, t AS (SELECT model, pos, neg,
  sum(neg) OVER (PARTITION BY model ORDER BY score) - neg AS below FROM s)
SELECT model, {dbl('sum(pos * (below + neg / 2.0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE))', 'AUC_ROC')}
FROM t GROUP BY model"""
)
def auc_rank(spark: SparkSession, folder: str) -> DataFrame:
    return ev.auc_roc(forecasts(spark, folder), HEAVY)


@query(
    f"""WITH {FORECAST_SQL}, {_SCORES}, t AS (SELECT model, score,
  sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
  sum(neg) OVER (PARTITION BY model) AS n, sum(pos) OVER (PARTITION BY model) AS m FROM s)
SELECT model, {dbl('score', 'score')}, {dbl('fp / CAST(n AS DOUBLE)', 'fpr')}, {dbl('tp / CAST(m AS DOUBLE)', 'tpr')} FROM t"""
)
def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    return ev.roc_points(forecasts(spark, folder), HEAVY)


@query(
    f"""WITH {FORECAST_SQL}, d AS (SELECT abs(y - lag_1) - abs(y - ma_3) AS d FROM wide)
SELECT 'lag_1' AS first, 'ma_3' AS second, CAST(count(d) AS BIGINT) AS n, {dbl('avg(d)', 'mean_difference')},
  {dbl('avg(d) / (stddev_samp(d) / sqrt(count(d)))', 't')} FROM d"""
)
def paired_t(spark: SparkSession, folder: str) -> DataFrame:
    return ev.paired_tests(forecasts(spark, folder), MODELS, KEYS).drop("p_value", "significant")


@query()
def significance_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Paired tests with p-values, and which model is better."""
    return ev.test_summary(ev.paired_tests(forecasts(spark, folder), MODELS, KEYS))


@query()
def significance_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return ev.significance_matrix(ev.paired_tests(forecasts(spark, folder), MODELS, KEYS), MODELS)


@query(
    f"""WITH {FORECAST_SQL}, e AS (SELECT station, count(*) AS n, avg(abs(y - p)) AS mae FROM f
  WHERE model = 'ma_3' GROUP BY station)
SELECT station, CAST(n AS BIGINT) AS n, {dbl('mae', 'MAE')} FROM e"""
)
def metrics_by_series(spark: SparkSession, folder: str) -> DataFrame:
    predictions = forecasts(spark, folder).filter("model = 'ma_3'")
    return ev.regression_metrics(predictions, ["station"]).select("station", "n", "MAE")


@query(
    f"""WITH {FORECAST_SQL} SELECT model, min(y > {HEAVY}) = max(y > {HEAVY}) AS one_class FROM f GROUP BY model"""
)
def single_class_guard(spark: SparkSession, folder: str) -> DataFrame:
    flags = ev.occurrences(forecasts(spark, folder), HEAVY)
    return flags.groupBy("model").agg((F.min("event") == F.max("event")).alias("one_class"))
