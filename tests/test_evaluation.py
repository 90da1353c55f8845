import pytest
from pyspark.sql import functions as F

from seriesforge.functions.distributions import student_t_two_sided
from seriesforge.operators import correlation, evaluation as ev, scaling, statistics

# Published test statistics over 178 rows and their p-values.
PUBLISHED_TESTS = [
    (-7.38994, 5.597e-12),
    (-5.40109, 2.112e-07),
    (-5.42039, 1.925e-07),
    (-58.99596, 2.464e-118),
    (19.08588, 7.955e-45),
    (17.66978, 6.280e-41),
    (-110.90312, 1.667e-165),
    (0.71052, 0.4783),
    (-112.66976, 1.056e-166),
    (-112.00925, 2.948e-166),
]
# Tp, fp, fn, tn and the accuracy, precision, recall, F1 and AUC published for them.
PUBLISHED_CLASSES = {
    "knn": ((23, 1, 143, 10), (0.1864, 0.9583, 0.1386, 0.2421, 0.5238)),
    "random_forest": ((30, 0, 136, 11), (0.2316, 1.0, 0.1807, 0.3061, 0.5904)),
    "xgboost": ((31, 0, 135, 11), (0.2373, 1.0, 0.1867, 0.3147, 0.5934)),
}
# Published errors without and with engineered features, and the gain in percent.
PUBLISHED_GAINS = {
    "ann": (32.45, 25.13, 22.56),
    "mlr": (35.78, 31.24, 12.69),
    "knn": (33.91, 28.76, 15.19),
    "rf": (30.12, 24.05, 20.15),
    "xgb": (29.87, 23.64, 20.86),
    "arima": (36.43, 34.52, 5.24),
}


def predictions(spark, pairs, model="m"):
    rows = [(model, i, float(a), float(b)) for i, (a, b) in enumerate(pairs)]
    return spark.createDataFrame(rows, "model string, row_id int, y_true double, y_pred double")


def test_small_regression(spark):
    df = predictions(spark, [(10, 10.5), (12, 11.5), (15, 14.5), (11, 11.2), (13, 12.8)])
    row = ev.regression_metrics(df).first()
    assert row["MAE"] == pytest.approx(0.38) and row["MSE"] == pytest.approx(0.166)
    assert row["RMSE"] == pytest.approx(0.166**0.5)
    assert row["R2"] == pytest.approx(1 - 0.83 / 14.8)
    assert row["Mean_Residual"] == pytest.approx(0.1)


def test_constant_target_has_no_r2(spark):
    assert ev.regression_metrics(predictions(spark, [(1, 2), (1, 3)])).first()["R2"] is None


@pytest.mark.parametrize("pairs,threshold,expected", [
    ([(0, 0.1), (1, 0.8), (1, 0.6), (0, 0.2), (1, 0.9), (0, 0.3), (0, 0.4), (1, 0.7)], 0.5, 1.0),
    ([(0.05, 0.1), (10.2, 8), (0, 0.5), (5.5, 3), (0.02, 0)], 0.1, 1.0),
    ([(1, 0.5), (0, 0.5)], 0.5, 0.5),
    ([(1, 0.2), (0, 0.9), (1, 0.9), (0, 0.1)], 0.5, 0.625),
    ([(1, 0.2), (1, 0.9)], 0.5, None),
])
def test_auc(spark, pairs, threshold, expected):
    assert ev.auc_roc(predictions(spark, pairs), threshold).first()["AUC_ROC"] == expected


def test_auc_floor_merges_negative_scores(spark):
    df = predictions(spark, [(1, -1), (0, -2), (1, 3)])
    assert ev.auc_roc(df, 0.5).first()["AUC_ROC"] == 1.0
    assert ev.auc_roc(df, 0.5, floor=True).first()["AUC_ROC"] == 0.75


def test_roc_ends_at_one(spark):
    df = predictions(spark, [(1, 0.2), (0, 0.9), (1, 0.9), (0, 0.1)])
    points = ev.roc_points(df, 0.5).orderBy(F.desc("score")).collect()
    assert [(p["fpr"], p["tpr"]) for p in points] == [(0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_published_class_metrics(spark):
    rows = [(m, *c) for m, (c, _) in PUBLISHED_CLASSES.items()]
    counts = spark.createDataFrame(rows, "model string, tp long, fp long, fn long, tn long")
    for r in ev.classification_metrics(counts).collect():
        got = [r[c] for c in ("accuracy", "precision", "recall", "f1", "auc_roc")]
        assert got == pytest.approx(list(PUBLISHED_CLASSES[r["model"]][1]), abs=5e-5)


def test_confusion_has_all_cells(spark):
    cells = ev.confusion_matrix(predictions(spark, [(1, 1), (1, 1)]), 0.5).collect()
    assert sorted(c["n"] for c in cells) == [0, 0, 0, 2]


@pytest.mark.parametrize("t,p", PUBLISHED_TESTS)
def test_published_p_values(t, p):
    assert student_t_two_sided(t, 177) == pytest.approx(p, rel=2e-3)


def test_paired_tests(spark):
    a = predictions(spark, [(10, 11), (10, 12), (10, 13), (10, 10)], "a")
    b = predictions(spark, [(10, 10.5), (10, 10), (10, 11), (10, 10)], "b")
    tests = ev.paired_tests(a.union(b), ["a", "b"], ["row_id"])
    row = tests.first()
    # Differences 0.5, 2, 2, 0.
    assert row["n"] == 4 and row["mean_difference"] == pytest.approx(1.125)
    assert row["t"] == pytest.approx(1.125 / (1.0307764064 / 2))
    assert ev.test_summary(tests).first()["better"] == "no significant difference"
    matrix = {r["model"]: (r["a"], r["b"]) for r in ev.significance_matrix(tests, ["a", "b"]).collect()}
    assert matrix["a"][0] is None and matrix["a"][1] == matrix["b"][0] == pytest.approx(row["p_value"])


def test_published_gains(spark):
    a = spark.createDataFrame([(m, v[0]) for m, v in PUBLISHED_GAINS.items()], "model string, RMSE double")
    b = spark.createDataFrame([(m, v[1]) for m, v in PUBLISHED_GAINS.items()], "model string, RMSE double")
    for r in ev.compare_feature_sets(a, b).collect():
        assert r["improvement"] == pytest.approx(PUBLISHED_GAINS[r["model"]][2], abs=0.006)


def test_ranking_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "model string, RMSE double")
    assert [r["model"] for r in ev.rank_models(df).orderBy("rank").collect()] == ["c", "a", "b"]
    assert ev.best_model(df).first()["model"] == "c"
    up = df.withColumnRenamed("RMSE", "AUC_ROC")
    assert ev.best_model(up, "AUC_ROC").first()["model"] == "a"
    assert ev.improvement_over(df, "a").filter("model = 'c'").first()["improvement"] == 50.0


def test_prediction_table(spark):
    a, b = predictions(spark, [(1, 2), (3, 4)], "a"), predictions(spark, [(1, 5)], "b")
    got = ev.prediction_table(a.union(b), ["a", "b"], ["row_id"]).orderBy("row_id").collect()
    assert [tuple(r) for r in got] == [(0, 1.0, 2.0, 5.0), (1, 3.0, 4.0, None)]


def test_constant_column_statistics(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, c double")
    assert correlation.target_correlations(df, "x", ["c"]).first()["correlation"] is None
    for method in ("standard", "minmax"):
        table = scaling.scaler_table(df, ["c"], method)
        assert [r["c"] for r in scaling.apply_scaler(df, table, ["c"]).collect()] == [0.0] * 3
    assert statistics.histogram(df, "c").first()["n"] == 3


def test_correlation_is_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, None), (None, 9.0), (4.0, 7.0)], "x double, y double")
    r = correlation.target_correlations(df, "y", ["x"]).first()["correlation"]
    import numpy as np

    assert r == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 7])[0, 1])


def test_standard_scaling_uses_the_population_deviation(spark, tmp_path):
    df = spark.createDataFrame([(float(i),) for i in range(6)], "x double")
    fitted = scaling.FittedScaler.fit(df, ["x"])
    assert fitted.parameters["x"][1] == pytest.approx((35 / 12) ** 0.5)
    fitted.save(spark, str(tmp_path / "s"))
    again = scaling.FittedScaler.load(spark, str(tmp_path / "s"))
    back = again.transform(df).select(again.reverse(F.col("x"), "x").alias("x"))
    assert sorted(r["x"] for r in back.collect()) == pytest.approx([0, 1, 2, 3, 4, 5])


def test_box_plot_without_groups(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double")
    row = statistics.box_plot(df, [], "x").first()
    assert (row["q1"], row["median"], row["q3"]) == (2.0, 3.0, 4.0)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 4.0, 1)


def test_describe_matches_pandas(spark):
    import pandas as pd

    values = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0]
    got = statistics.describe(spark.createDataFrame([(v,) for v in values], "x double"), ["x"]).first()
    want = pd.Series(values).describe()
    for ours, theirs in zip(("count", "mean", "std", "min", "p25", "p50", "p75", "max"), want):
        assert got[ours] == pytest.approx(theirs)
