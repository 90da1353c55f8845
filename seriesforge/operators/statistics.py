"""Describe, exact percentiles, box-plot statistics and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.operators.ordering import (
    BROADCAST_ROWS,
    bucket_totals,
    count_groups,
    join_group_table,
    order_cells,
    with_scalar,
)
from seriesforge.operators.quality import unpivot_row
from seriesforge.session import materialize, store
from seriesforge.specs import CELL_ROWS

QUARTILES = (0.25, 0.5, 0.75)
#: Accuracy of the sketch that brackets ranks: a bracket is off by some n / SKETCH ranks.
SKETCH = 10_000
#: Groups of at most so many values have no bracket.
SKETCH_ROWS = 4 * SKETCH
#: The part of values that serve all probabilities without a bracket.
_ALL = -1


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.lit(len(df.columns)).alias("column_count"))


def melt(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Non-NULL values in long form: (by, column, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*by, F.inline(pairs)).filter(F.col("value").isNotNull())


def percentiles(
    df: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    bounded: bool = False,
    cell_rows: int = CELL_ROWS,
    groups: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Exact, linearly interpolated percentiles: one row per (by, column) with an array ``q``.

    ``bounded=True`` promises groups that fit a task (a series of weeks, say) and
    uses the built-in aggregate, which keeps a group's distinct values in memory.
    Otherwise no group is ever brought together: the rows are written once (``stored``
    says that ``df`` is), a quantile sketch brackets every wanted rank, and exact counts tell
    how many values lie below each bracket and whether it holds its rank.  Only values
    inside brackets go on, as counts per distinct value; where more than ``cell_rows`` of
    them are left they are split into cells.  A bracket that misses its rank, and groups of few
    values, keep all their values.
    """
    by = list(by)
    probabilities = list(probabilities)
    if bounded:
        return melt(df, by, columns).groupBy(*by, "column").agg(_builtin(probabilities).alias("q"))

    rows = df if stored else store(df.select(*by, *dict.fromkeys(columns)), "values")
    groups = count_groups(rows, by) if groups is None else groups
    group = [*by, "column", "part"]
    values = materialize(_candidates(rows, by, columns, probabilities, groups))

    def ranks() -> list[tuple[str, int, Column]]:
        out = []
        for i, p in enumerate(probabilities):
            position = F.lit(p) * (F.col("count_all") - 1)
            out += [(f"_lo{i}", i, F.floor(position)), (f"_hi{i}", i, F.ceil(position))]
        return out

    def holds(i: int, rank: Column, before: Column, n: Column) -> Column:
        return F.col("part").isin(i, _ALL) & (rank >= before) & (rank < before + n)

    constant = [*group, "less", "count_all"]
    long = order_cells(values, group, ["value"], cell_rows, stored=True).apply(values, "_bucket")
    before = F.col("less") + F.col("_off_n")
    wanted = bucket_totals(long, constant, ["n"]).filter(_any([holds(i, r, before, F.col("_in_n")) for _, i, r in ranks()]))
    wanted = wanted.select(*group, "_bucket", before.alias("_before"))
    # At most two cells per group, column and probability are wanted.
    if groups * len(columns) * 2 * len(probabilities) <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    inside = long.join(wanted, [*group, "_bucket"])
    window = (
        Window.partitionBy(*group, "_bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = inside.withColumn("_start", F.col("_before") + F.sum("n").over(window) - F.col("n"))
    picks = [F.max(F.when(holds(i, r, F.col("_start"), F.col("n")), F.col("value"))).alias(name) for name, i, r in ranks()]
    found = inside.groupBy(*by, "column").agg(F.max("count_all").alias("count_all"), *picks)
    values = []
    for i, p in enumerate(probabilities):
        position = F.lit(p) * (F.col("count_all") - 1)
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        values.append(low + (high - low) * (position - F.floor(position)))
    return found.select(*by, "column", F.array(*values).alias("q"))


def _candidates(rows: DataFrame, by: list[str], columns: Sequence[str], probabilities: list[float], groups: int) -> DataFrame:
    """(by, column, part, less, count_all, value, n): counts of the values that may hold a wanted rank.

    Part i brackets probability i, with ``less`` values below the bracket; part ``_ALL`` has all values of a group
    of which some probability has no bracket.
    """
    reach, last = 2 / SKETCH, len(probabilities)
    edges = [min(max(p + side * reach, 0.0), 1.0) for side in (-1, 1) for p in probabilities]
    values = rows.select(*by, *[F.col(c).cast("double").alias(f"_v{k}") for k, c in enumerate(columns)])

    def attached(table: DataFrame, name: str) -> DataFrame:
        if not by:
            return with_scalar(values, table.select(F.struct("*")), name)
        small = table.select(*by, F.struct(*[c for c in table.columns if c not in by]).alias(name))
        return values.join(F.broadcast(small) if groups * len(columns) <= BROADCAST_ROWS else small, by)

    sketched, counted = [], []
    for k in range(len(columns)):
        v, edge = F.col(f"_v{k}"), F.col("_at")[f"e{k}"]
        n = F.count(v)
        sketched += [F.when(n > SKETCH_ROWS, F.percentile_approx(v, edges, SKETCH)).alias(f"e{k}")]
        less, upto = ([F.count_if(test(v, edge[i + at])) for i in range(last)] for test, at in ((lambda a, b: a < b, 0), (lambda a, b: a <= b, last)))
        for i, p in enumerate(probabilities):
            position = F.lit(p) * (n - 1)
            held = (F.floor(position) >= less[i]) & (F.ceil(position) < upto[i])
            counted += [F.when(held, F.struct(F.first(edge[i]).alias("low"), F.first(edge[i + last]).alias("high"), less[i].alias("less"))).alias(f"b{k}_{i}")]
        counted += [n.alias(f"n{k}")]
    brackets = attached(values.groupBy(*by).agg(*sketched), "_at").groupBy(*by).agg(*counted)

    found, tests = [], []
    for k, c in enumerate(columns):
        v, n = F.col(f"_v{k}"), F.col("_in")[f"n{k}"]
        bracket = [F.col("_in")[f"b{k}_{i}"] for i in range(last)]
        cases = [(i, b["less"], (v >= b["low"]) & (v <= b["high"])) for i, b in enumerate(bracket)]
        cases.append((_ALL, F.lit(0).cast("long"), v.isNotNull() & _any([b.isNull() for b in bracket])))
        for part, less, test in cases:
            tests.append(F.coalesce(test, F.lit(False)))
            fields = {"column": F.lit(c), "part": F.lit(part), "less": less, "count_all": n, "value": v}
            found.append(F.when(tests[-1], F.struct(*[f.alias(name) for name, f in fields.items()])))
    chosen = attached(brackets, "_in").filter(_any(tests)).select(*by, F.inline(F.array_compact(F.array(*found))))
    return chosen.groupBy(*by, "column", "part", "less", "count_all", "value").agg(F.count(F.lit(1)).alias("n"))


def _builtin(probabilities: Sequence[float]) -> Column:
    return F.percentile("value", F.array(*[F.lit(p) for p in probabilities]))


def _any(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for c in conditions[1:]:
        result = result | c
    return result


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), bounded: bool = False) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles per column (and group)."""
    by = list(by)
    rows = df if bounded else store(df.select(*by, *dict.fromkeys(columns)), "values")
    names = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    cells = [f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in columns for n, f in names.items()]
    wide = rows.groupBy(*by).agg(*cells)
    moments = unpivot_row(wide, columns, {n: "{}_" + n for n in names}).filter(F.col("count") > 0)
    quartiles = percentiles(rows, by, columns, QUARTILES, bounded, stored=True)
    named = [F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))]
    return moments.join(quartiles, [*by, "column"]).select(
        *by, "column", "count", "mean", "std", "min", *named, "max"
    )


def box_plot(df: DataFrame, by: Sequence[str], column: str, bounded: bool = False, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier count of a column per group.

    Whiskers are the extreme values within ``reach`` times the interquartile range.
    The quartiles join the rows as a small table, and what is left is one
    aggregate with partial sums.
    """
    by = list(by)
    df = df if bounded else store(df.select(*by, column), "values")
    groups = count_groups(df, by)
    names = ("q1", "median", "q3")
    quartiles = percentiles(df, by, [column], QUARTILES, bounded, groups=groups, stored=True)
    quartiles = quartiles.select(*by, *[F.col("q")[i].alias(n) for i, n in enumerate(names)])
    rows = df.select(*by, column).filter(F.col(column).isNotNull())
    if by:
        joined = join_group_table(rows, quartiles, by, groups)
    else:
        joined = with_scalar(rows, quartiles.select(F.struct("*")), "_q").select("*", "_q.*")
    value, margin = F.col(column), F.lit(reach) * (F.col("q3") - F.col("q1"))
    inside = (value >= F.col("q1") - margin) & (value <= F.col("q3") + margin)
    return joined.groupBy(*by, *names).agg(
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def histogram(df: DataFrame, column: str, bins: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """Fixed-width bins between the extremes of the column; empty bins are left out."""
    bounds = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high")))
    low, high = F.col("_bounds.low"), F.col("_bounds.high")
    number = F.least(F.floor(F.try_divide(F.col(column) - low, (high - low) / F.lit(bins))), F.lit(bins - 1))
    number = F.coalesce(number, F.lit(0)).cast("int")
    present = with_scalar(df.filter(F.col(column).isNotNull()), bounds, "_bounds")
    return present.groupBy(*by, number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
