"""Positions and running totals over ordered rows, without ordering any large group in one task.

Rows are dealt to cells, which follow each other in the order of the rows.  A group
(a series, a column) that holds more rows than one task should order is split by
the values of its order columns, and each part that is still too large is split
again between its own extremes, until every cell is small enough or holds equal
rows only.  Counts per cell then give each cell its offset, and rows are ordered
inside their cell.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesforge.session import materialize
from seriesforge.specs import CELL_ROWS, SeriesSpec

BROADCAST_ROWS = 100_000
#: At most so many cells are split at a time: each holds more than this share of all rows.
SPLIT_CELLS = 20_000
#: Parts that a cell is split into.
FANOUT = 512


def row_index(df: DataFrame, spec: SeriesSpec, name: str = "row_index") -> DataFrame:
    """Number the rows of each series from 0 in (time, tie) order.

    A regular keyed series is numbered directly.  Otherwise rows are counted per
    cell, the counts (one row per key and cell) become offsets, and each row adds
    its number within its cell.  The offsets are joined on the columns the
    in-cell window is already partitioned by, so the rows are shuffled once.
    """
    if spec.one_task_per_series:
        window = Window.partitionBy(*spec.keys).orderBy(*spec.order)
        return df.withColumn(name, F.row_number().over(window) - F.lit(1))

    missing = F.col(spec.time).isNull()
    for key in spec.keys:
        missing = missing | F.col(key).isNull()
    refused = F.raise_error(F.lit("series keys and time must not be NULL")).cast("long")
    cells = order_cells(df, spec.keys, spec.order, spec.cell_rows)
    placed = cells.apply(df, "_cell")
    place = [*spec.keys, "_cell"]
    rank = F.row_number().over(Window.partitionBy(*place).orderBy(*spec.order)) - F.lit(1)
    if not cells.levels:
        return placed.withColumn(name, F.when(missing, refused).otherwise(rank)).select(*df.columns, name)
    before = Window.partitionBy(*spec.keys).orderBy("_cell")
    offsets = (
        placed.groupBy(*place)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.sum("_n").over(before) - F.col("_n"))
        .drop("_n")
    )
    position = F.when(missing, refused).otherwise(F.col("_offset") + F.col("_rank"))
    return placed.withColumn("_rank", rank).join(offsets, place, "left").withColumn(name, position).select(*df.columns, name)


def _key_parts(column: str, kind: T.DataType) -> list[Column]:
    """Numbers that order as the column does, compared one after the other; NULL comes first.

    Each is weakly monotone among rows that agree on those before it, which is all
    that cells need: rows are ordered by the column itself inside a cell.
    """
    value = F.col(column)
    whole = lambda c: F.coalesce(c.cast("decimal(20,0)"), F.lit("-10000000000000000000").cast("decimal(20,0)"))
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return [whole(value.cast("long"))]
    if isinstance(kind, T.DecimalType):
        return [F.coalesce(value.cast("double"), F.lit(float("-inf"))), whole(F.floor(value))]
    if isinstance(kind, T.DateType):
        return [whole(F.datediff(value, F.lit("1970-01-01").cast("date")))]
    if isinstance(kind, T.TimestampType):
        return [whole(F.unix_micros(value))]
    if isinstance(kind, T.TimestampNTZType):
        day = F.datediff(value.cast("date"), F.lit("1970-01-01").cast("date"))
        second = F.date_part(F.lit("SECONDS"), value) * F.lit(1_000_000)
        return [whole(day), whole((F.hour(value) * 60 + F.minute(value)).cast("long") * 60_000_000 + second)]
    if isinstance(kind, T.FractionalType):
        x = value.cast("double")
        # Logarithms first, so that a few far values do not keep all others together; then the values as they are.
        size = F.when(F.isnan(x), F.lit(3000.0)).when(F.abs(x) == float("inf"), F.lit(2500.0)).otherwise(F.ln(F.abs(x)) + 1000)
        rough = F.coalesce(F.when(x == 0, F.lit(0.0)).when(x < 0, -size).otherwise(size), F.lit(-3000.0))
        fine = F.coalesce(F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x), F.lit(0.0))
        return [rough, fine]
    if isinstance(kind, (T.StringType, T.BinaryType)):
        raw = F.coalesce(value.cast("binary"), F.lit(b""))
        seven = lambda at: F.conv(F.rpad(F.hex(F.substring(raw, at, 7)), 14, "0"), 16, 10)
        return [whole(seven(at)) for at in (1, 8, 15, 22)]
    return []


@dataclass
class Cells:
    """How the rows of each group are dealt to cells; a cell is the path of parts that leads to it."""

    groups: list[str]
    parts: list[Column]
    levels: list[DataFrame] = field(default_factory=list)

    def _joined(self, df: DataFrame, level: DataFrame, path: str, how: str) -> DataFrame:
        """``df`` with the split of its cell, if that is split, and the path one step longer."""
        theirs = {c: f"_split_{c}" for c in [*self.groups, "path"]}
        split = F.broadcast(level.select(*[F.col(c).alias(n) for c, n in theirs.items()], "_part", "_low", "_high"))
        on = F.col(path) == F.col("_split_path")
        for g in self.groups:
            on = on & F.col(g).eqNullSafe(F.col(f"_split_{g}"))
        step = F.lit(None).cast("int")
        for i, key in enumerate(self.parts):
            low, high = F.col("_low")[f"k{i}"], F.col("_high")[f"k{i}"]
            # Halves keep the difference of two large doubles finite.
            share = (key / 2 - low / 2).cast("double") / (high / 2 - low / 2).cast("double")
            at = F.least(F.greatest(F.floor(share * FANOUT), F.lit(0)), F.lit(FANOUT - 1)).cast("int")
            step = F.when(F.col("_part") == i, at).otherwise(step)
        longer = F.when(F.col("_part").isNotNull(), F.concat(F.col(path), F.array(step))).otherwise(F.col(path))
        return df.join(split, on, how).withColumn(path, longer).drop(*theirs.values(), "_part", "_low", "_high")

    def apply(self, df: DataFrame, name: str) -> DataFrame:
        """Add the cell of each row, an array; arrays order as the rows do."""
        placed = df.withColumn(name, F.array().cast("array<int>"))
        for level in self.levels:
            placed = self._joined(placed, level, name, "left")
        return placed


def order_cells(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[str],
    cell_rows: int,
    wanted: Callable[[], Column] | None = None,
    stored: bool = False,
) -> Cells:
    """Cells of at most ``cell_rows`` rows, or a 20,000th of all, or of rows alike in ``order``.

    With ``wanted``, a condition on ``_before`` and ``_n`` (rows before and in a
    cell) and ``_total`` (of its group), only cells that meet it are split.  Where
    ``df`` is small, or no group is too large, one or two passes tell so and that is all.
    Otherwise the group and order columns are checkpointed (unless ``stored`` says that ``df``
    is), and each level reads the rows of the cells it splits.  Such cells are few, as each
    holds a 20,000th of all rows; the driver fetches their extremes.
    """
    groups = list(groups)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    parts = [k for c in order for k in _key_parts(c, kinds[c])]
    cells = Cells(groups, parts)
    names = [f"k{i}" for i in range(len(parts))]
    slim = df.select(*groups, *dict.fromkeys(c for c in order if c not in groups))
    total = slim.count() if parts else 0
    if total <= cell_rows:
        return cells
    limit = max(cell_rows, total // SPLIT_CELLS)

    def extremes() -> list[Column]:
        both = [F.struct(*[f(k).alias(n) for k, n in zip(parts, names)]).alias(label) for f, label in ((F.min, "_low"), (F.max, "_high"))]
        return [F.count(F.lit(1)).alias("_n"), *both]

    def too_large(stats: DataFrame) -> list:
        """The cells to split, with the first number that differs inside each."""
        choice = F.lit(None).cast("int")
        for i, n in reversed(list(enumerate(names))):
            choice = F.when(F.col("_low")[n] < F.col("_high")[n], F.lit(i)).otherwise(choice)
        large = stats.withColumn("_part", choice).filter((F.col("_n") > limit) & F.col("_part").isNotNull())
        large = large.filter(wanted()) if wanted else large
        found = large.collect()
        if found:
            cells.levels.append(df.sparkSession.createDataFrame(found, large.schema))
        return found

    nothing = F.array().cast("array<int>")
    whole = {"path": nothing, "_before": F.lit(0).cast("long"), "_total": F.col("_n")}
    found = too_large(slim.groupBy(*groups).agg(*extremes()).withColumns(whole))
    rows = None
    while found:
        if rows is None:
            rows = (slim if stored else materialize(slim)).withColumn("_path", nothing)
        level = cells.levels[-1]
        rows = cells._joined(rows, level, "_path", "inner")
        stats = rows.groupBy(*groups, F.col("_path").alias("path")).agg(*extremes())
        # Rows before a part: those before the cell, and those of the parts before it.
        above = level.select(*[F.col(g).alias(f"_above_{g}") for g in groups], F.col("path").alias("_above"), F.col("_before").alias("_start"), "_total")
        on = F.col("_parent") == F.col("_above")
        for g in groups:
            on = on & F.col(g).eqNullSafe(F.col(f"_above_{g}"))
        earlier = Window.partitionBy(*groups, "_parent").orderBy("path")
        stats = stats.withColumn("_parent", F.slice("path", 1, len(cells.levels) - 1))
        stats = stats.withColumn("_earlier", F.sum("_n").over(earlier) - F.col("_n")).join(F.broadcast(above), on)
        stats = stats.withColumn("_before", F.col("_start") + F.col("_earlier"))
        found = too_large(stats.select(*groups, "path", "_n", "_low", "_high", "_before", "_total"))
    return cells


def with_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Attach a one-row, one-column aggregate as a column, by a scalar subquery.

    Referring to the column keeps the subquery single in the plan, however many
    expressions use it.
    """
    return df.withColumn(name, one_row.scalar())


def with_series_windows(
    df: DataFrame, spec: SeriesSpec, horizon: int, build: Callable[[Window], dict[str, Column]]
) -> DataFrame:
    """Add (or replace) the columns ``build(window)``, which look back at most ``horizon`` rows.

    All columns share one window, hence one shuffle and one sort.  For unbounded
    series each block also receives the last ``horizon`` rows of the block before
    it; these halo rows feed the windows and are dropped afterwards.
    """
    if spec.one_task_per_series:
        return df.withColumns(build(Window.partitionBy(*spec.keys).orderBy(*spec.order)))

    size = max(spec.block_rows, horizon, 1)
    home = F.expr(f"_position div {size}")
    homes = F.when(F.col("_position") % size >= size - horizon, F.array(home, home + 1)).otherwise(F.array(home))
    blocked = row_index(df, spec, "_position").withColumn("_block", F.explode(homes))
    window = Window.partitionBy(*spec.keys, "_block").orderBy("_position")
    return (
        blocked.withColumns(build(window))
        .filter(F.col("_block") == home)
        .drop("_position", "_block")
    )


def count_groups(df: DataFrame, by: Sequence[str]) -> int:
    """About how many groups there are, from one small sketch."""
    return int(df.agg(F.approx_count_distinct(F.struct(*by))).first()[0]) if by else 1


def join_group_table(df: DataFrame, table: DataFrame, by: Sequence[str], groups: int) -> DataFrame:
    """Attach a table with one row per group: broadcast if it is known to be small, else left to Spark."""
    return df.join(F.broadcast(table) if groups <= BROADCAST_ROWS else table, list(by), "left")


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: str,
    sums: Sequence[str],
    cell_rows: int = CELL_ROWS,
    descending: bool = False,
) -> DataFrame:
    """For rows distinct in (groups, order): totals of ``sums`` before each row, as ``<sum>_before``.

    Group totals are returned as ``<sum>_total``.  ``df`` is evaluated once.
    """
    df = materialize(df)
    placed = order_cells(df, groups, [order], cell_rows, stored=True).apply(df, "_bucket")
    return prefix_totals(placed, groups, order, sums, descending).drop("_bucket")


def prefix_totals(
    bucketed: DataFrame, groups: Sequence[str], order: str, sums: Sequence[str], descending: bool = False
) -> DataFrame:
    """``running_totals`` for rows that already carry ``_bucket``."""
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    inside = (
        Window.partitionBy(*groups, "_bucket")
        .orderBy(direction(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = bucketed.select("*", *[F.sum(s).over(inside).alias(f"_run_{s}") for s in sums])
    joined = ranked.join(bucket_totals(bucketed, groups, sums, descending), [*groups, "_bucket"])
    added = [(F.col(f"_off_{s}") + F.col(f"_run_{s}") - F.col(s)).alias(f"{s}_before") for s in sums]
    return joined.select(*bucketed.columns, *added, *[F.col(f"{s}_total") for s in sums])


def bucket_totals(
    bucketed: DataFrame, groups: Sequence[str], sums: Sequence[str], descending: bool = False
) -> DataFrame:
    """Per (groups, bucket): ``_in_<sum>``, ``_off_<sum>`` of earlier buckets, ``<sum>_total`` of the group."""
    earlier = (
        Window.partitionBy(*groups)
        .orderBy(F.col("_bucket").desc() if descending else F.col("_bucket").asc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy(*groups)
    totals = bucketed.groupBy(*groups, "_bucket").agg(*[F.sum(s).alias(f"_in_{s}") for s in sums])
    columns = [F.col(f"_in_{s}") for s in sums]
    for s in sums:
        columns.append((F.sum(f"_in_{s}").over(earlier) - F.col(f"_in_{s}")).alias(f"_off_{s}"))
        columns.append(F.sum(f"_in_{s}").over(whole).alias(f"{s}_total"))
    return totals.select(*groups, "_bucket", *columns)
