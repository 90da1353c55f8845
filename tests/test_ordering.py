import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesforge.operators import ordering, outliers, splitting, statistics, windows
from seriesforge.operators.imputation import impute
from seriesforge.plans.features import feature_table
from seriesforge.specs import Derived, SeriesSpec


@pytest.fixture(scope="module")
def long_series(spark):
    """1,000 rows without a key; a third of them share one day."""
    source = random.Random(3)
    rows = []
    for i in range(1000):
        day = 40 if i % 3 == 0 else source.randint(0, 90)
        rows.append((dt.date(2020, 1, 1) + dt.timedelta(days=day), i, source.random()))
    return spark.createDataFrame(rows, "t date, id int, x double").repartition(7)


def ordered(df):
    return sorted(df.collect(), key=lambda r: (r["t"], r["id"]))


@pytest.mark.parametrize("cell", [2, 60, 5000])
def test_row_index_matches_a_global_order(long_series, cell):
    spec = SeriesSpec(time="t", tie=("id",), cell_rows=cell)
    assert [r["row_index"] for r in ordered(ordering.row_index(long_series, spec))] == list(range(1000))


def largest_cell(cells, df, groups):
    return cells.apply(df, "_cell").groupBy(*groups, "_cell").count().agg(F.max("count")).first()[0]


def test_a_hot_day_is_split_by_its_ties(long_series):
    cells = ordering.order_cells(long_series, [], ["t", "id"], 50)
    assert largest_cell(cells, long_series, []) <= 50
    by_day = cells.apply(long_series, "_cell").filter("t = DATE '2020-02-10'").select("_cell").distinct().count()
    assert by_day >= 334 / 50


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_a_hot_hour_of_a_hot_user_is_split(spark, kind):
    """A third of all rows in one hour of one user, most of them at one instant; ties are names."""
    source = random.Random(9)
    start = dt.datetime(2024, 3, 31, 1, 0, 0, 5)
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        at = start + dt.timedelta(microseconds=source.randint(0, 3) if hot else source.randint(0, 10**12))
        rows.append(("u0" if hot else f"u{source.randint(1, 40)}", at, f"name {i // 2 if i % 5 else i * 7919}-{i}"))
    rows += [("u0", start, None), ("u0", start, "")]
    df = spark.createDataFrame(rows, f"u string, ts {kind}, name string").repartition(5)
    spec = SeriesSpec(keys=("u",), time="ts", tie=("name",), regular=False, cell_rows=20)
    cells = ordering.order_cells(df, ["u"], ["ts", "name"], 20)
    assert largest_cell(cells, df, ["u"]) <= 20 and len(cells.levels) > 1
    got = {(r["u"], r["ts"], r["name"]): r["row_index"] for r in ordering.row_index(df, spec).collect()}
    for u in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == u), key=lambda r: (r[1], r[2] is not None, (r[2] or "").encode()))
        assert [got[r] for r in own] == list(range(len(own)))


def test_cells_follow_any_numbers(spark):
    """Doubles of every size, infinities, NaN and NULL; longs near the limits; decimals."""
    source = np.random.default_rng(4)
    x = [float(v) for v in source.normal(0, 1, 300) * 10.0 ** source.integers(-300, 300, 300)]
    x += [0.0, -0.0, float("inf"), float("-inf"), float("nan"), None, 1e15, 1e15 + 0.25, 1e15 + 0.5] * 3
    rows = [(i, v, (2**63 - 1 - i) if i % 2 else -(2**63) + i, f"{(i * 37) % 101}.{i % 10}") for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "i int, x double, n long, s string").selectExpr("*", "cast(s as decimal(12, 3)) AS d")
    for column in ("x", "n", "d"):
        cells = ordering.order_cells(df, [], [column], 4).apply(df, "_cell")
        by_value = [r["i"] for r in cells.orderBy(column, "i").select("i").collect()]
        by_cell = [r["i"] for r in cells.orderBy("_cell", column, "i").select("i").collect()]
        assert by_cell == by_value
        counts = cells.groupBy("_cell").agg(F.count("*").alias("n"), F.countDistinct(column).alias("values"))
        assert counts.filter("n > 4 AND values > 1").isEmpty()


def test_percentiles_of_a_hot_range(spark):
    """Nine tenths of the values in a narrow range, half of those equal: cells that hold ranks stay small."""
    source = np.random.default_rng(8)
    x = np.concatenate([1 + source.random(900) * 1e-9, np.full(900, 1 + 5e-10), source.random(200) * 1e6])
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(6)
    probs = (0.1, 0.25, 0.5, 0.75, 0.97)
    got = statistics.percentiles(df, [], ["x"], probs, cell_rows=30).first()["q"]
    assert got == pytest.approx(list(np.quantile(x, probs)), rel=1e-15)
    long = statistics.melt(df, [], ["x"])
    cells = ordering.order_cells(long, ["column"], ["value"], 30)
    sizes = cells.apply(long, "_cell").groupBy("_cell").agg(F.countDistinct("value").alias("values"), F.count("*").alias("n"))
    assert sizes.filter("n > 30 AND values > 1").isEmpty()


@pytest.mark.parametrize("block", [1, 5, 100, 5000])
def test_blocked_windows_match_one_ordered_window(long_series, block):
    spec = SeriesSpec(time="t", tie=("id",), block_rows=block)
    got = ordered(
        windows.window_features(
            long_series, spec, [Derived("l", "x", 3)], [Derived("m", "x", 4)], [Derived("s", "x", 3)]
        )
    )
    x = np.array([r["x"] for r in got])
    assert len(got) == 1000
    for i, r in enumerate(got):
        assert r["l"] == (x[i - 3] if i >= 3 else None)
        assert r["m"] == (pytest.approx(x[i - 3 : i + 1].mean()) if i >= 3 else None)
        assert r["s"] == (pytest.approx(x[i - 2 : i + 1].std(ddof=1)) if i >= 2 else None)


def test_blocked_windows_with_keys_and_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", dt.datetime(2020, 1, 1) + dt.timedelta(minutes=7 * i), float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t timestamp, x double")
    blocked = SeriesSpec(keys=("k",), time="t", regular=False, block_rows=16)
    single = SeriesSpec(keys=("k",), time="t")
    d = ([Derived("l", "x", 2)], [Derived("m", "x", 3)])
    a = sorted(map(tuple, windows.window_features(df, blocked, *d).collect()), key=str)
    b = sorted(map(tuple, windows.window_features(df, single, *d).collect()), key=str)
    assert a == b


def test_null_time_is_refused_not_dropped(spark):
    df = spark.createDataFrame([(None, 1), (dt.date(2020, 1, 1), 2)], "t date, id int")
    with pytest.raises(Exception, match="must not be NULL"):
        ordering.row_index(df, SeriesSpec(time="t", tie=("id",))).collect()


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    source = random.Random(1)
    rows = [(g, float(v), source.randint(0, 5)) for g in "ab" for v in source.sample(range(5000), 300)]
    df = spark.createDataFrame(rows, "g string, v double, n int")
    got = {(r["g"], r["v"]): (r["n_before"], r["n_total"]) for r in ordering.running_totals(df, ["g"], "v", ["n"], 16, descending).collect()}
    for g in "ab":
        before = 0
        for v, n in sorted(((v, n) for h, v, n in rows if h == g), reverse=descending):
            assert got[(g, v)] == (before, sum(m for h, _, m in rows if h == g))
            before += n
    assert len(got) == 600


@pytest.mark.parametrize("n", [1, 2, 3, 7, 1000])
@pytest.mark.parametrize("ties", [False, True])
def test_percentiles_are_exact(spark, n, ties):
    source = np.random.default_rng(n)
    values = source.integers(0, 5, n).astype(float) if ties else np.exp(source.normal(0, 4, n))
    df = spark.createDataFrame([("g", float(v), -float(v)) for v in values], "k string, x double, y double")
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    for by in ([], ["k"]):
        got = {r["column"]: r["q"] for r in statistics.percentiles(df, by, ["x", "y"], probs, cell_rows=8).collect()}
        assert got["x"] == pytest.approx(list(np.quantile(values, probs)))
        assert got["y"] == pytest.approx(list(np.quantile(-values, probs)))


def test_percentiles_ignore_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, None)], "x double, y double")
    got = {r["column"]: r["q"] for r in statistics.percentiles(df, [], ["x", "y"], (0.5,)).collect()}
    assert got == {"x": [1.5]}


def series(spark, n):
    return spark.createDataFrame([(dt.date(2020, 1, 1) + dt.timedelta(days=i), i) for i in range(n)], "Date date, id int")


KEYLESS = SeriesSpec(tie=("id",), cell_rows=4)


def test_split_sizes(spark):
    counts = splitting.split_counts(splitting.chronological_split(series(spark, 100), KEYLESS)).first()
    assert (counts["train_rows"], counts["test_rows"]) == (80, 20)
    split = splitting.chronological_split(series(spark, 10), KEYLESS)
    assert sorted(r["id"] for r in split.filter("NOT is_train").collect()) == [8, 9]
    assert splitting.train_rows(94, 0.2) == 75


def test_split_guards(spark):
    with pytest.raises(ValueError):
        splitting.chronological_split(series(spark, 3), KEYLESS, 1.0)
    with pytest.raises(ValueError):
        splitting.require_both_parts(splitting.chronological_split(series(spark, 1), KEYLESS))


def test_contiguous_folds(spark):
    got = splitting.contiguous_folds(series(spark, 11), KEYLESS, 3).orderBy("id").collect()
    assert [r["fold"] for r in got] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2, 2]


def test_folds_of_a_short_series(spark):
    got = splitting.contiguous_folds(series(spark, 2), KEYLESS, 3).orderBy("id").collect()
    assert [r["fold"] for r in got] == [0, 1]


def test_expanding_folds(spark):
    folded = splitting.expanding_folds(series(spark, 10), KEYLESS, 3)
    assert [r["test_fold"] for r in folded.orderBy("id").collect()] == [-1] * 4 + [0, 0, 1, 1, 2, 2]
    sizes = [(a.count(), b.count()) for a, b in splitting.expanding_pairs(folded, 3)]
    assert sizes == [(4, 2), (6, 2), (8, 2)]


def test_last_rows_and_yearly_split(spark):
    assert sorted(r["id"] for r in splitting.last_rows(series(spark, 10), KEYLESS, 3).collect()) == [7, 8, 9]
    df = spark.createDataFrame(
        [(dt.date(y, 1, 1) + dt.timedelta(days=i), y * 100 + i) for y in (2020, 2021) for i in range(10)], "Date date, id int"
    )
    split = splitting.yearly_split(df, KEYLESS)
    assert split.filter("NOT is_train").count() == 4


def test_autocorrelation(spark, by_station):
    source = np.random.default_rng(0)
    x = source.normal(size=80).cumsum()
    rows = [(1, dt.date(2020, 1, 5) + dt.timedelta(weeks=i), float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "station int, Date date, x double")
    c = x - x.mean()
    expected = [float((c[k:] * c[:-k]).sum() / (c * c).sum()) for k in range(1, 5)]
    got = [r["acf"] for r in windows.autocorrelation(df, by_station, "x", 4).orderBy("lag").collect()]
    assert got == pytest.approx(expected)
    keyless = SeriesSpec(block_rows=20, cell_rows=30)
    assert [r["acf"] for r in windows.autocorrelation(df, keyless, "x", 4).orderBy("lag").collect()] == pytest.approx(expected)
    r = [1.0, *expected]
    pacf = []
    for k in range(1, 5):
        matrix = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        pacf.append(np.linalg.solve(matrix, r[1 : k + 1])[-1])
    got = [row["pacf"] for row in windows.partial_autocorrelation(df, by_station, "x", 4).orderBy("lag").collect()]
    assert got == pytest.approx(pacf)


def test_percentiles_keep_few_values_of_large_groups(spark, monkeypatch):
    """Only values near the wanted ranks are kept; ties, far values and a sketch that is wrong change no result."""
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=90_000), np.repeat(0.5, 20_000), rng.normal(size=10) * 1e12])
    df = spark.createDataFrame(pd.DataFrame({"g": np.arange(len(values)) % 2, "x": values, "y": np.round(values)}))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    kept = statistics._candidates(df, [], ["x"], probs, 1)
    assert kept.count() < 1000
    want = {(g, c): np.percentile(v[np.arange(len(v)) % 2 == g], [p * 100 for p in probs]) for g in (0, 1) for c, v in (("x", values), ("y", np.round(values)))}

    def check():
        for r in statistics.percentiles(df, ["g"], ["x", "y"], probs, cell_rows=5000).collect():
            assert np.allclose(r["q"], want[r["g"], r["column"]], rtol=1e-12)

    check()
    monkeypatch.setattr(statistics.F, "percentile_approx", lambda c, p, accuracy: statistics.F.array(*[statistics.F.max(c)] * len(p)))
    check()


def test_percentile_queries_evaluate_their_input_once(spark):
    """Feature tables, describe, fences, medians and box plots write what they read several times."""
    seen = spark.sparkContext.accumulator(0)

    def rows(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.createDataFrame([(i % 3, float(i)) for i in range(300)], "g int, x double").mapInPandas(rows, "g int, x double")
    days = [(dt.date(2020, 1, 5) + dt.timedelta(weeks=i), 1, float(i % 7), float(i % 5), float(i % 3), float(i % 11)) for i in range(300)]
    schema = "Date date, station int, Temp_avg double, Relative_Humidity double, Wind_kmh double, Precipitation_mm double"
    series = spark.createDataFrame(days, schema).mapInPandas(rows, schema)
    for i, run in enumerate(
        [
            lambda: feature_table(series, SeriesSpec(keys=("station",)), top_n=3).rows,
            lambda: statistics.describe(df, ["x"]),
            lambda: outliers.treat_outliers(df, ["x"]),
            lambda: impute(df, ["x"], "median"),
            lambda: statistics.box_plot(df, ["g"], "x"),
        ]
    ):
        assert run().collect()
        assert seen.value == 300 * (i + 1)
