"""Registered queries against their SQL at the smallest scale, and the plans of the main ones."""

import io
import math
from contextlib import redirect_stdout

import duckdb
import pytest

import __spark_entry__ as entry
from seriesforge.plans import registry

from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# Six models or whole searches; ``model_status`` and the tests of models cover what they run.
SLOW_WITHOUT_SQL = {
    "train_and_compare", "with_without_features", "feature_importances", "forest_random_search", "boosting_grid_search",
    "end_to_end", "network_history",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    clean = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(repr(clean(r[i])) for i in order) for r in rows))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert comparable(df.columns, df.collect()) == comparable(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW_WITHOUT_SQL))
def test_query_without_sql_runs(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "humidity_High" in df.columns


def plan(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def test_flagship_plan_is_lean(spark):
    from seriesforge.plans.inputs import WEEKLY, weekly_weather
    from seriesforge.operators.windows import window_features
    from seriesforge.specs import MEASURES, average_columns, lag_columns, std_columns

    df = window_features(
        weekly_weather(spark, SF), WEEKLY, lag_columns(MEASURES, (1, 2)), average_columns(MEASURES, (3, 4)), std_columns(MEASURES)
    )
    text = plan(df)
    # One shuffle to resample (after partial aggregation), one for every window together.
    assert text.split("(1) ")[0].count("Exchange") == 2
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double,l_shipdate:timestamp_ntz>" in text
    assert "partial_avg" in text


def test_no_unpartitioned_joins(spark):
    """No registered plan multiplies two tables."""
    heavy = ("knn_predict", "keyless_window_features", "paired_t", "describe", "auc_rank", "impute_mean", "standard_scale")
    for name in heavy:
        text = plan(registry()[name].run(spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_filter_reaches_the_scan(spark):
    from pyspark.sql import functions as F

    from seriesforge.sources.readers import read_table

    df = read_table(spark, SF, "lineitem").filter(F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp_ntz")).select("l_suppkey")
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in plan(df)
