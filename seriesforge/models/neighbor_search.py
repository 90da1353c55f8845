"""Nearest neighbours: an exact search over a tree of pivots, and an approximate one over p-stable hashes.

Exact: donors belong to leaves around pivots, and leaves to tops.  Sizes and radii
of the leaves bound the distance of a query's k-th neighbour (triangle inequality),
so a query visits the leaves that can hold a neighbour, and the answer is exact.  The
number of leaves follows the number of donors, so that what a query is compared with
does not.  A query first meets its home leaf, whose k-th nearest donor is a close bound
for the rest.  Leaves are packed into blocks of bounded size (a large leaf is cut into
several); a query is sent to a block once, with the leaves it visits there.

Approximate: several tables of p-stable projections, each cut into cells.  A query
looks at its own cell and the neighbouring cells it lies closest to; all donors found
are compared exactly.  Width and number of projections follow a sample of the donors.

Distances that agree to nine decimals count as equal, so that ties do not depend
on the last bits of a recomputed mean; equal distances are ordered by donor.
Neither search ever brings a cell, a bucket or the set of pairs together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seriesforge.operators.ordering import join_group_table
from seriesforge.session import materialize, store

CHUNK_ROWS = 20_000
BLOCK_CELLS = 2_000_000
#: Neighbours found that a task holds before it keeps the best of each row.
HELD_FOUND = 500_000
LEAF_ROWS = 200
#: What all pivots together may take; they are sent to every task.
PIVOT_BYTES = 32 << 20
#: Leaves have boxes in at most so many dimensions; in more, boxes rule out little.
BOX_DIMENSIONS = 16
SAMPLE_ROWS = 2_000
#: Width of a hash cell, in distances of the k-th neighbour.
WIDTH = 4.0
DECIMALS = 9
SLACK = 1e-6
_FOUND = "query_id long, donor_id long, target double, distance double"


def to_decimals(distance: np.ndarray) -> np.ndarray:
    """Rounded to ``DECIMALS`` as SQL does: a half goes up, where ``np.round`` takes the even neighbour."""
    scaled = distance * 10.0**DECIMALS
    whole = np.floor(scaled)
    with np.errstate(invalid="ignore"):
        return np.where(scaled - whole == 0.5, whole + 1, np.rint(scaled)) / 10.0**DECIMALS


def distances(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """Minkowski distances of matching rows; by differences, so equal rows are at 0."""
    gap = np.abs(a - b)
    return to_decimals(gap.sum(axis=-1) if p == 1 else np.sqrt((gap * gap).sum(axis=-1)))


def rough_scores(a: np.ndarray, b: np.ndarray, p: int) -> tuple[np.ndarray, float]:
    """Values ordered like the distances of all rows of ``a`` to all of ``b``, and their error.

    For p = 2 these are squared distances through one matrix product.
    """
    if p == 1:
        total = np.zeros((len(a), len(b)))
        for j in range(a.shape[1]):
            total += np.abs(a[:, j, None] - b[None, :, j])
        return total, 1e-8
    left, right = (a * a).sum(axis=1), (b * b).sum(axis=1)
    scores = a @ b.T
    scores *= -2.0
    scores += left[:, None]
    scores += right[None, :]
    return scores, 1e-8 + 1e-12 * float(left.max(initial=0) + right.max(initial=0))


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in column])


def _reach(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    scores, _ = rough_scores(a, b, p)
    return scores if p == 1 else np.sqrt(np.maximum(scores, 0.0))


def closest(
    asked: np.ndarray, donors: np.ndarray, k: int, p: int, allowed: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, donor position, distance) of the k nearest donors of each row.

    Rough scores select a few candidates, a little past the k-th; their exact
    distances decide, earlier donors first among equals.  ``allowed`` is a matrix
    of the pairs that count.
    """
    scores, error = rough_scores(asked, donors, p)
    if allowed is not None:
        scores[~allowed] = np.inf
    if len(donors) > k:
        border = np.partition(scores, k - 1, axis=1)[:, k - 1]
        border = border + 2 * error + 4e-9 * np.sqrt(np.maximum(border, 0.0))
        rows, picked = np.nonzero((scores <= border[:, None]) & np.isfinite(scores))
    else:
        rows, picked = np.nonzero(np.isfinite(scores))
    return first_k(rows, picked, distances(asked[rows], donors[picked], p), k)


def first_k(rows: np.ndarray, picked: np.ndarray, exact: np.ndarray, k: int):
    """The k smallest entries of every row, ordered by distance and position."""
    order = np.lexsort((picked, exact, rows))
    rows, picked, exact = rows[order], picked[order], exact[order]
    starts = np.searchsorted(rows, rows, side="left")
    kept = np.arange(len(rows)) - starts < k
    return rows[kept], picked[kept], exact[kept]


def complete(vector: str):
    """Whether a vector is there and all its coordinates are finite numbers."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


@dataclass(frozen=True)
class PivotTree:
    """Leaf pivots grouped by top pivots; a vector's leaf is the nearest of its nearest top."""

    tops: np.ndarray
    leaves: np.ndarray
    first: np.ndarray  # the leaves of top t are first[t] .. first[t + 1]
    p: int

    @classmethod
    def grow(cls, vectors: np.ndarray, p: int) -> "PivotTree":
        tops = vectors[: int(np.ceil(np.sqrt(len(vectors))))]
        home = _reach(vectors, tops, p).argmin(axis=1)
        used = np.unique(home)
        order = np.argsort(home, kind="stable")
        first = np.append(np.searchsorted(home[order], used), len(vectors))
        return cls(tops[used], vectors[order], first, p)

    def children(self, top: int) -> slice:
        return slice(self.first[top], self.first[top + 1])

    @cached_property
    def to_top(self) -> np.ndarray:
        """How far each leaf pivot is from its top."""
        return np.concatenate([_reach(self.tops[t : t + 1], self.leaves[self.children(t)], self.p)[0] for t in range(len(self.tops))])

    def home(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, distance to its pivot) of each row."""
        near = _reach(rows, self.tops, self.p).argmin(axis=1)
        leaf = np.zeros(len(rows), np.int64)
        for top in np.unique(near):
            mine = near == top
            leaf[mine] = self.first[top] + _reach(rows[mine], self.leaves[self.children(top)], self.p).argmin(axis=1)
        return leaf, distances(rows, self.leaves[leaf], self.p)


def _to_boxes(rows: np.ndarray, low: np.ndarray, high: np.ndarray, p: int) -> np.ndarray:
    """How far each row is from its box."""
    gap = np.maximum(np.maximum(low - rows, rows - high), 0.0)
    return gap.sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1))


@dataclass(frozen=True)
class LeafTable:
    """Per stage and leaf, over the donors of all earlier stages: how many, the farthest from the pivot, the k-th nearest.

    In few dimensions also the box around all donors of a leaf (low and high corners).
    """

    sizes: np.ndarray
    radii: np.ndarray
    kth: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def near_enough(self, asked: np.ndarray, leaves: np.ndarray, limit: np.ndarray, p: int) -> np.ndarray:
        """Whether the box of each leaf reaches within ``limit`` of its row; pair by pair."""
        if self.low is None:
            return np.ones(len(leaves), bool)
        return _to_boxes(asked, self.low[leaves], self.high[leaves], p) <= limit

    def top_boxes(self, tree: PivotTree) -> tuple[np.ndarray, np.ndarray] | None:
        """Low and high corners around all donors of each top."""
        if self.low is None:
            return None
        starts = tree.first[:-1]
        return np.minimum.reduceat(self.low, starts), np.maximum.reduceat(self.high, starts)

    @classmethod
    def of(cls, placed: DataFrame, leaves: int, stages: int, k: int, width: int) -> "LeafTable":
        shape = (stages, leaves)
        sizes, radii, kth = np.zeros(shape, np.int64), np.zeros(shape), np.full(shape, np.inf)
        inner = Window.partitionBy("leaf", "stage").orderBy("gap")
        nearest_k = placed.select("leaf", "stage", "gap", F.row_number().over(inner).alias("r")).filter(F.col("r") <= k)
        counts = placed.groupBy("leaf", "stage").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius"))
        ranked = nearest_k.groupBy("leaf", "stage").agg(F.max("gap").alias("kth"), F.max("r").alias("r"))
        for r in counts.join(ranked, ["leaf", "stage"]).collect():
            at = (r["stage"], r["leaf"])
            sizes[at], radii[at] = r["n"], r["radius"]
            if r["r"] == k:
                kth[at] = r["kth"]
        stages_ = (sizes.cumsum(axis=0), np.maximum.accumulate(radii, axis=0), np.minimum.accumulate(kth, axis=0))
        if width > BOX_DIMENSIONS:
            return cls(*stages_)
        low, high = np.full((leaves, width), np.inf), np.full((leaves, width), -np.inf)
        corners = [f(F.col("vector")[i]) for f in (F.min, F.max) for i in range(width)]
        for r in placed.groupBy("leaf").agg(F.array(*corners).alias("corners")).collect():
            low[r["leaf"]], high[r["leaf"]] = r["corners"][:width], r["corners"][width:]
        return cls(*stages_, low, high)


def visits(
    tree: PivotTree, table: LeafTable, asked: np.ndarray, stage: int, k: int, known: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of all leaves that can hold one of a row's k nearest donors of earlier stages than ``stage``.

    ``known`` is a distance within which a row is known to have k donors, or infinite.
    """
    parts = list(visit_parts(tree, table, asked, stage, k, known))
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *[rows for rows, _ in parts]]), np.concatenate([nothing, *[leaves for _, leaves in parts]])


def visit_parts(
    tree: PivotTree, table: LeafTable, asked: np.ndarray, stage: int, k: int, known: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``visits`` in parts of at most ``BLOCK_CELLS`` pairs (or one row); a row is in one part only."""
    nothing = np.zeros(0, np.int64)
    if stage < 1 or not len(asked):
        return
    stage = min(stage, len(table.sizes))
    sizes, radii, kth = (a[stage - 1] for a in (table.sizes, table.radii, table.kth))
    if not sizes.any():
        return
    to_tops = _reach(asked, tree.tops, tree.p)
    bound = known.copy()
    near = to_tops.argmin(axis=1)
    for top in np.unique(near[np.isinf(known)]):
        mine, own = np.isinf(known) & (near == top), tree.children(top)
        bound[mine] = (_reach(asked[mine], tree.leaves[own], tree.p) + kth[own]).min(axis=1)
    lost = np.flatnonzero(np.isinf(bound))
    together = max(1, BLOCK_CELLS // len(tree.leaves))
    for start in range(0, len(lost), together):  # k donors lie within whole leaves taken by reach
        some = lost[start : start + together]
        to_leaves = _reach(asked[some], tree.leaves, tree.p)
        farthest = np.where(sizes > 0, to_leaves + radii, np.inf)
        order = np.argsort(farthest, axis=1)
        enough = np.cumsum(sizes[order], axis=1) >= min(k, sizes.sum())
        each = np.arange(len(some))
        bound[some] = np.minimum(farthest[each, order[each, enough.argmax(axis=1)]], (to_leaves + kth).min(axis=1))
    # A top reaches as far as the farthest of its leaves.
    reach = np.maximum.reduceat(np.where(sizes > 0, tree.to_top + radii, -np.inf), tree.first[:-1])
    # Pairs of a top and a row it may hold a neighbour of, by top.
    tops, rows_ = np.nonzero((to_tops - reach[None, :] <= (bound + SLACK * (1 + bound))[:, None]).T)
    boxes = table.top_boxes(tree)
    if boxes is not None:
        limit = (bound + SLACK * (1 + bound))[rows_]
        inside = _to_boxes(asked[rows_], boxes[0][tops], boxes[1][tops], tree.p) <= limit
        tops, rows_ = tops[inside], rows_[inside]
    cells = int(np.diff(tree.first)[tops].sum())
    if cells > BLOCK_CELLS and len(asked) > 1:
        # Fewer rows at a time, so that their distances to the leaves they meet stay within ``BLOCK_CELLS``.
        parts = np.array_split(np.arange(len(asked)), min(len(asked), -(-cells // BLOCK_CELLS) + 1))
        for mine in parts:
            for rows, leaves in visit_parts(tree, table, asked[mine], stage, k, bound[mine]):
                yield mine[rows], leaves
        return
    seen = []
    used, starts = np.unique(tops, return_index=True)
    for top, mine in zip(used, np.split(rows_, starts[1:])):
        own = tree.children(top)
        mine = mine[to_tops[mine, top] - reach[top] <= bound[mine] + SLACK * (1 + bound[mine])]
        if len(mine):
            gaps = _reach(asked[mine], tree.leaves[own], tree.p)
            bound[mine] = np.minimum(bound[mine], (gaps + kth[own]).min(axis=1))
            seen.append((mine, own, gaps))
    rows, leaves = [nothing], [nothing]
    for mine, own, gaps in seen:
        limit = bound[mine] + SLACK * (1 + bound[mine])
        at, leaf = np.nonzero((gaps - radii[own] <= limit[:, None]) & (sizes[own] > 0))
        close = table.near_enough(asked[mine[at]], own.start + leaf, limit[at], tree.p)
        rows.append(mine[at[close]])
        leaves.append(own.start + leaf[close])
    yield np.concatenate(rows), np.concatenate(leaves)


def _pack(sizes: np.ndarray, chunk_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, number of blocks) per leaf: neighbouring leaves share a block, a large one has several."""
    first, pieces = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // chunk_rows))
    block, held = 0, 0
    for leaf, n in enumerate(sizes):
        if held and held + n > chunk_rows:
            block, held = block + 1, 0
        first[leaf] = block
        if pieces[leaf] > 1:
            block, held = block + int(pieces[leaf]), 0
        else:
            held += n
    return first, pieces


def _pivots(donors: DataFrame, wanted: int, n: int) -> np.ndarray:
    """About ``wanted`` donor vectors, drawn by a hash of the id; they steer the work, not the result."""
    mixed = F.xxhash64("donor_id", F.lit("pivot"))
    share = min(1.0, wanted / n)
    rows = donors.filter(F.pmod(mixed, F.lit(1 << 30)) < int(share * (1 << 30))).select(mixed.alias("h"), "donor_id", "vector").collect()
    rows = sorted(rows, key=lambda r: (r["h"], r["donor_id"])) or donors.limit(1).select("vector").collect()
    return np.array([r["vector"] for r in rows], dtype=float)


def nearest(
    queries: DataFrame, donors: DataFrame, k: int, p: int = 2, leaf_rows: int = LEAF_ROWS, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """The k nearest donors of each query: (query_id, donor_id, target, distance, rank).

    ``queries`` has ``query_id long, vector array<double>``; ``donors`` has
    ``donor_id long, vector, target double``.  Equal distances are ordered by
    donor id.  Vectors that are NULL or hold NULL, NaN or infinity take no part on
    either side (``complete`` finds them).  Where both sides have ``stage int``, from 0,
    a query only meets donors of earlier stages.

    Donors are stored and placed in leaves; pivots and leaf sizes are all that the driver
    sees, within ``PIVOT_BYTES``.
    """
    if p not in (1, 2):
        raise ValueError("p must be 1 or 2")
    staged = "stage" in queries.columns and "stage" in donors.columns
    if not staged:
        queries, donors = queries.withColumn("stage", F.lit(1)), donors.withColumn("stage", F.lit(0))
    queries = queries.filter(complete("vector")).select("query_id", "vector", F.col("stage").cast("int").alias("stage"))
    donors = store(donors.filter(complete("vector")).select("donor_id", "vector", "target", F.col("stage").cast("int").alias("stage")), "donors")
    head = donors.agg(F.count(F.lit(1)).alias("n"), F.max("stage").alias("last"), F.max(F.size("vector")).alias("width")).first()
    if not head["n"]:
        return _nothing(queries)
    leaves = max(1, min(-(-head["n"] // leaf_rows), PIVOT_BYTES // (8 * max(head["width"], 1))))
    tree = PivotTree.grow(_pivots(donors, leaves, head["n"]), p)
    _ = tree.to_top  # found once, here, and sent with the tree

    @F.pandas_udf("leaf int, gap double")
    def home(vectors: pd.Series) -> pd.DataFrame:
        leaf, gap = tree.home(stacked(vectors))
        return pd.DataFrame({"leaf": leaf.astype("int32"), "gap": gap})

    placed = store(donors.withColumn("_home", home("vector")).select(*donors.columns, "_home.leaf", "_home.gap"), "placed")
    table = LeafTable.of(placed, len(tree.leaves), head["last"] + 1, k, head["width"])
    first, pieces = _pack(table.sizes[-1], chunk_rows)

    def to_blocks(choose):
        """Rows (query, block, leaves) from what ``choose`` gives for a part of a batch: (row, leaf) pairs."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # Rows meet all tops, and only the leaves of tops in reach: the work of a row follows the tops, not the leaves.
            step = max(1, BLOCK_CELLS // len(tree.tops))
            for batch in batches:
                for start in range(0, len(batch), step):
                    part = batch.iloc[start : start + step]
                    for rows, leaf in choose(part, stacked(part["vector"])):
                        # A leaf in several blocks is visited in each.
                        times = pieces[leaf]
                        block = np.repeat(first[leaf], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                        rows, leaf = np.repeat(rows, times), np.repeat(leaf, times)
                        order = np.lexsort((leaf, block, rows))
                        rows, block, leaf = rows[order], block[order], leaf[order]
                        new = np.flatnonzero((np.diff(rows, prepend=-1) != 0) | (np.diff(block, prepend=-1) != 0))
                        if not len(new):
                            continue
                        out = part.iloc[rows[new]][["query_id", "vector", "stage", "known"]].reset_index(drop=True)
                        out["block"] = block[new].astype("int32")
                        out["leaves"] = np.split(leaf.astype("int32"), new[1:])
                        yield out

        return run

    def at_home(part: pd.DataFrame, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield np.arange(len(part)), tree.home(asked)[0]

    def elsewhere(part: pd.DataFrame, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        stages, known = part["stage"].to_numpy(), part["known"].fillna(np.inf).to_numpy(float)
        home_leaf = tree.home(asked)[0]
        for stage in np.unique(stages):
            mine = np.flatnonzero(stages == stage)
            for rows, leaf in visit_parts(tree, table, asked[mine], int(stage), k, known[mine]):
                other = home_leaf[mine[rows]] != leaf
                yield mine[rows[other]], leaf[other]

    sent = "query_id long, vector array<double>, stage int, known double, block int, leaves array<int>"

    @F.pandas_udf("int")
    def block_of(leaf: pd.Series, mixed: pd.Series) -> pd.Series:
        at = leaf.to_numpy()
        return pd.Series((first[at] + mixed.to_numpy() % pieces[at]).astype("int32"))

    right = placed.withColumn("block", block_of("leaf", F.pmod(F.xxhash64("donor_id"), F.lit(1 << 40))))

    def compared(choose, asked: DataFrame) -> DataFrame:
        left = store(asked.mapInPandas(to_blocks(choose), sent), "visits")
        left, donors_, task = _sliced(left, right, ["block"], chunk_rows)
        # New attributes for one side: queries and donors may stem from the same frame.
        left = left.select(*[F.col(c).alias(c) for c in left.columns])
        return left.groupBy(*task).cogroup(donors_.groupBy(*task)).applyInPandas(_in_leaves(k, p, staged), _FOUND)

    queries = store(queries, "queries")
    near = store(compared(at_home, queries.withColumn("known", F.lit(None).cast("double"))), "near")
    return _merge(near.unionByName(compared(elsewhere, _bounded(queries, near, k))), k)


def _bounded(queries: DataFrame, near: DataFrame, k: int) -> DataFrame:
    """``queries`` with ``known``: the distance of the k-th donor in ``near``, NULL where it holds fewer."""
    known = near.groupBy(F.col("query_id").alias("_id")).agg(F.get(F.sort_array(F.collect_list("distance")), F.lit(k - 1)).alias("known"))
    return queries.join(known, F.col("query_id") == F.col("_id"), "left").drop("_id")


def _within(found, known: pd.Series):
    """What lies no farther than the k-th donor a row is known to have; a donor beyond it never counts."""
    rows, picked, exact = found
    near = exact <= known.fillna(np.inf).to_numpy(float)[rows]
    return rows[near], picked[near], exact[near]


def _sliced(left: DataFrame, right: DataFrame, task: list[str], chunk_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Tasks that many queries go to are cut into slices of them, each with all donors of the task."""
    busy = left.groupBy(*task).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > chunk_rows)
    left, right = _with_pieces((left, right), busy, task, chunk_rows, "_slices")
    left = left.withColumn("slice", F.pmod(F.xxhash64("query_id"), F.col("_slices")).cast("int"))
    right = right.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
    return left.drop("_slices"), right.drop("_slices"), [*task, "slice"]


def _with_pieces(frames: tuple[DataFrame, ...], large: DataFrame, by: list[str], chunk_rows: int, name: str) -> list[DataFrame]:
    """Add the number of pieces of each group: 1, but for the ``large`` ones (by, _n), which few rows tell."""
    large = materialize(large.select(*by, F.ceil(F.col("_n") / chunk_rows).cast("int").alias(name)))
    groups = large.count()
    if not groups:
        return [df.withColumn(name, F.lit(1)) for df in frames]
    return [join_group_table(df, large, by, groups).withColumn(name, F.coalesce(name, F.lit(1))) for df in frames]


def _table(names: np.ndarray, ids: np.ndarray, targets: np.ndarray, found) -> pd.DataFrame:
    rows, picked, exact = found
    return pd.DataFrame({"query_id": names[rows], "donor_id": ids[picked], "target": targets[picked], "distance": exact})


def _in_groups(asked, donors, pairs, k, p, allowed=None):
    """k nearest per query over (query rows, donor positions) groups that are compared with each other.

    A row met in many groups keeps its best k from time to time, so what is held follows the rows and not the groups.
    """
    parts, held, most = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], 0, HELD_FOUND
    for rows, members in pairs:
        step = max(1, BLOCK_CELLS // max(1, len(members)))
        for start in range(0, len(rows), step):
            some = rows[start : start + step]
            matrix = allowed(some, members) if allowed else None
            at, picked, exact = closest(asked[some], donors[members], k, p, matrix)
            parts.append((some[at], members[picked], exact))
            held += len(at)
            if held > most:
                parts = [first_k(*(np.concatenate(x) for x in zip(*parts)), k)]
                held = len(parts[0][0])
                most = max(HELD_FOUND, 2 * held)
    rows, picked, exact = (np.concatenate(x) for x in zip(*parts))
    return rows, picked, exact


def _in_leaves(k: int, p: int, staged: bool):
    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "donor_id": [], "target": [], "distance": []})
        right = right.sort_values("donor_id", kind="stable")
        donors, asked = stacked(right["vector"]), stacked(left["vector"])
        lists = [np.asarray(v) for v in left["leaves"]]
        leaf = np.concatenate(lists)
        row = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
        order = np.argsort(leaf, kind="stable")
        leaf, row = leaf[order], row[order]
        home = right["leaf"].to_numpy()
        members = np.argsort(home, kind="stable")
        homes = home[members]
        stage_of, stage_asked = right["stage"].to_numpy(), left["stage"].to_numpy()
        earlier = (lambda rows, them: stage_of[them][None, :] < stage_asked[rows][:, None]) if staged else None

        def pairs():
            for at in np.unique(leaf):
                own = members[np.searchsorted(homes, at) : np.searchsorted(homes, at, side="right")]
                if len(own):
                    yield row[np.searchsorted(leaf, at) : np.searchsorted(leaf, at, side="right")], own

        found = _within(first_k(*_in_groups(asked, donors, pairs(), k, p, earlier), k), left["known"])
        return _table(left["query_id"].to_numpy(), right["donor_id"].to_numpy(), right["target"].to_numpy(), found)

    return compare


def _merge(partial: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("distance", "donor_id")
    return partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _merge_once(partial: DataFrame, k: int) -> DataFrame:
    """As ``_merge`` where a donor may come several times: it comes with one distance, so one shuffle serves."""
    order = Window.partitionBy("query_id").orderBy("distance", "donor_id")
    few = partial.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k)
    return few.dropDuplicates(["query_id", "donor_id"])


def _nothing(queries: DataFrame) -> DataFrame:
    empty = queries.limit(0).select("query_id")
    return empty.select(
        "query_id",
        F.lit(None).cast("long").alias("donor_id"),
        F.lit(None).cast("double").alias("target"),
        F.lit(None).cast("double").alias("distance"),
        F.lit(None).cast("int").alias("rank"),
    )


@dataclass(frozen=True)
class StableHashes:
    """Tables of ``functions`` random projections cut into cells of one width."""

    directions: np.ndarray  # (tables, functions, dimensions)
    offsets: np.ndarray  # (tables, functions), in cells
    width: float
    mixers: np.ndarray  # odd numbers that fold a cell's coordinates into one key

    @classmethod
    def fit(cls, sample: np.ndarray, n: int, k: int, p: int, tables: int, bucket_rows: int, seed: int) -> "StableHashes":
        """Width from the distance at which nine of ten donors have k neighbours; as many projections as keep cells small.

        Copies of a vector lie in one cell whatever is chosen, so they count once.
        """
        source = np.random.default_rng(seed)
        n = max(1, round(n * len(np.unique(sample, axis=0)) / len(sample)))
        sample = np.unique(sample, axis=0)
        dimensions = sample.shape[1]
        near = 0.0
        if len(sample) > 1:
            rank = k * len(sample) / n  # of a donor's k-th neighbour among the sample
            gaps = np.sort(_reach(sample, sample, p), axis=1)[:, 1:]
            own = gaps[:, min(gaps.shape[1], max(1, int(np.ceil(rank)))) - 1]
            # Below the sample's resolution the distance shrinks with the root of the rank.
            near = float(np.quantile(own, 0.9)) * min(1.0, rank) ** (1 / dimensions)
        width = WIDTH * near if near > 0 else 1.0
        draw = source.standard_normal if p == 2 else source.standard_cauchy
        most = 24
        directions, offsets = draw((tables, most, dimensions)), source.random((tables, most))
        mixers = source.integers(1, 1 << 62, most, dtype=np.int64) * 2 + 1
        cells = np.floor(sample @ directions[0].T / width + offsets[0])
        together = ~np.eye(len(sample), dtype=bool)
        functions = 0
        while functions < most and (functions == 0 or n * together.mean() > bucket_rows):
            together &= cells[:, functions, None] == cells[None, :, functions]
            functions += 1
        return cls(directions[:, :functions], offsets[:, :functions], width, mixers[:functions])

    def _keys(self, cells: np.ndarray, table: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.mixers).sum(axis=-1) * 16 + table

    def keys(self, rows: np.ndarray, probes: int = 0, p: int = 2) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per table the keys (rows, 1 + probes) of a row's own cell and the cells it lies closest to, and how far they are at least.

        Rows of two cells differ in a projection by what is left to the border, so their distance is that by its norm or more.
        """
        out = []
        for t in range(len(self.directions)):
            at = rows @ self.directions[t].T / self.width + self.offsets[t]
            cells = np.floor(at)
            if not probes:
                out.append((self._keys(cells, t)[:, None], np.zeros((len(rows), 1))))
                continue
            inside = at - cells
            steps = np.concatenate([-np.eye(cells.shape[1]), np.eye(cells.shape[1])])
            cost = np.concatenate([inside**2, (1 - inside) ** 2], axis=1)
            a, b = np.triu_indices(len(steps), 1)
            apart = np.abs(steps[a] * steps[b]).sum(axis=1) == 0  # two different projections
            moves = np.concatenate([steps, steps[a[apart]] + steps[b[apart]]])
            costs = np.concatenate([cost, cost[:, a[apart]] + cost[:, b[apart]]], axis=1)
            kept = np.argpartition(costs, min(probes, costs.shape[1]) - 1, axis=1)[:, :probes]
            near = cells[:, None, :] + moves[kept]
            norms = np.abs(self.directions[t]).max(axis=1) if p == 1 else np.sqrt((self.directions[t] ** 2).sum(axis=1))
            each = np.sqrt(cost) * self.width / np.maximum(np.concatenate([norms, norms]), 1e-300)
            apart_ = np.concatenate([each, np.maximum(each[:, a[apart]], each[:, b[apart]])], axis=1)
            away = np.concatenate([np.zeros((len(rows), 1)), np.take_along_axis(apart_, kept, axis=1)], axis=1)
            out.append((np.concatenate([self._keys(cells, t)[:, None], self._keys(near, t)], axis=1), away))
        return out


def nearest_hashed(
    queries: DataFrame,
    donors: DataFrame,
    k: int,
    p: int = 2,
    tables: int = 4,
    probes: int = 6,
    bucket_rows: int = 200,
    chunk_rows: int = CHUNK_ROWS,
    seed: int = 42,
) -> DataFrame:
    """As ``nearest``, but among the donors that share a cell of some table with the query or lie in a cell beside it.

    Distances and ranks are exact for the donors found, and queries that find fewer than k are
    searched for exactly.  A cell of many donors is cut into
    pieces, and one of many queries into slices, so no task follows the size of a cell.
    """
    if p not in (1, 2):
        raise ValueError("p must be 1 or 2")
    queries = materialize(queries.filter(complete("vector")).select("query_id", "vector"))
    donors = materialize(donors.filter(complete("vector")).select("donor_id", "vector", "target"))
    n = donors.count()
    if not n:
        return _nothing(queries)
    hashes = StableHashes.fit(_pivots(donors, SAMPLE_ROWS, n), n, k, p, tables, bucket_rows, seed)
    parts = max(1, -(-n * tables // chunk_rows))

    def own(name: str, extra: list[str]):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    found = np.concatenate([keys for keys, _ in hashes.keys(stacked(batch["vector"]))], axis=1)
                    out = batch.iloc[np.repeat(np.arange(len(batch)), found.shape[1])].reset_index(drop=True)
                    out["key"] = found.ravel()
                    yield out[[name, "vector", *extra, "key"]]

        return run

    def beside(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = hashes.keys(stacked(batch["vector"]), probes, p)
                keys, away = (np.concatenate([f[i][:, 1:] for f in found], axis=1) for i in (0, 1))
                limit = batch["known"].fillna(np.inf).to_numpy(float)
                rows, at = np.nonzero(away <= (limit + SLACK * (1 + limit))[:, None])
                out = batch.iloc[rows].reset_index(drop=True)
                out["key"] = keys[rows, at]
                yield out[["query_id", "vector", "known", "key"]]

    keyed = donors.mapInPandas(own("donor_id", ["target"]), "donor_id long, vector array<double>, target double, key long")
    part = F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")
    # Keys of more donors than a task should hold; each has more than ``chunk_rows`` of them, so they are few.
    large = materialize(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > chunk_rows))

    def compared(left: DataFrame) -> DataFrame:
        # Rows by key are hashed anew where they are read: there are many times more of them than of vectors, too many to keep.
        left, right = _with_pieces((left, keyed), large, ["key"], chunk_rows, "_pieces")
        right = right.withColumns({"part": part, "piece": F.pmod(F.xxhash64("donor_id"), F.col("_pieces")).cast("int")})
        left = left.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))).withColumn("part", part)
        left, right, task = _sliced(left.drop("_pieces"), right.drop("_pieces"), ["part", "piece"], chunk_rows)
        left = left.select(*[F.col(c).alias(c) for c in left.columns])
        return left.groupBy(*task).cogroup(right.groupBy(*task)).applyInPandas(_in_buckets(k, p), _FOUND)

    # Own cells first: their k-th donor rules out cells beside them, and what lies beyond it there.
    at_home = queries.mapInPandas(own("query_id", []), "query_id long, vector array<double>, key long")
    near = materialize(_merge_once(compared(at_home.withColumn("known", F.lit(None).cast("double"))), k))
    elsewhere = _bounded(queries, near, k).mapInPandas(beside, "query_id long, vector array<double>, known double, key long")
    found = materialize(_merge_once(near.drop("rank").unionByName(compared(elsewhere)), k))
    enough = found.filter(F.col("rank") == min(k, n)).select("query_id")
    lost = materialize(queries.join(enough, "query_id", "left_anti"))
    if lost.isEmpty():
        return found
    return found.join(enough, "query_id", "left_semi").unionByName(nearest(lost, donors, k, p, chunk_rows=chunk_rows))


def _in_buckets(k: int, p: int):
    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "donor_id": [], "target": [], "distance": []})
        right = right.sort_values(["key", "donor_id"], kind="stable")
        keys = right["key"].to_numpy()
        left = left[left["key"].isin(keys)].sort_values("key", kind="stable")
        if left.empty:
            return pd.DataFrame({"query_id": [], "donor_id": [], "target": [], "distance": []})
        asked_keys = left["key"].to_numpy()
        asked, donors = stacked(left["vector"]), stacked(right["vector"])

        def pairs():
            for key in np.unique(asked_keys):
                rows = np.arange(np.searchsorted(asked_keys, key), np.searchsorted(asked_keys, key, side="right"))
                yield rows, np.arange(np.searchsorted(keys, key), np.searchsorted(keys, key, side="right"))

        # A query comes once per key; its best of the task are all that leave it.
        names = left["query_id"].to_numpy()
        rows, picked, exact = _within(_in_groups(asked, donors, pairs(), k, p), left["known"])
        found = _table(names, right["donor_id"].to_numpy(), right["target"].to_numpy(), (rows, picked, exact))
        found = found.drop_duplicates(["query_id", "donor_id"]).sort_values(["query_id", "distance", "donor_id"])
        return found.groupby("query_id").head(k)

    return compare
