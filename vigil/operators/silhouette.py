"""Mean silhouette with Euclidean distances to a stated error.

The silhouette of a row needs its mean distance to the rows of every cluster: all
pairs of rows. Here the rows of a cluster are cut into cells, and a row meets cells.
For a cell of n rows with mean m and variance v (mean squared distance to m) the
mean distance of its rows to a point x lies between |x - m| (convexity) and
sqrt(|x - m|² + v) (concavity of the root), which is narrow for small or far cells.
Sums over the cells bound a row's mean distances, these its silhouette, and the
average of the bounds holds the mean silhouette.

Cells start as an even grid over each cluster, as fine as the error suggests. As
long as the bounds are wider than asked for, the cells that widen them most are halved
at the mean of their widest dimension. How many cells that takes depends on the error
and on the space the clusters fill, not on the number of rows: rows added to a cell
widen no bound. A cell of equal rows is exact. The cells (a few numbers each) go to
the tasks; no pair of rows is formed, and the driver sees sums per cell only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..session import checkpoint

#: Distance of the mean's bounds from the estimate at which the cells are fine enough.
ERROR = 1e-3
#: Deviation of the first cells, in roots of the error: a deviation d widens a distance
#: r by d²/2r, so the bounds ask for some root of the error.
START = 3.5
#: Rows and cells whose distances a task holds at once: few enough for a core's own cache, and
#: products so small that the matrix library starts no threads beside the other tasks.
BLOCK, CELLS = 96, 256
#: Rows of a task while rows meet cells, and most tasks: the work of a row is some
#: thousand distances, so tasks are cut by rows and not by their few bytes.
TASK_ROWS, TASKS = 20_000, 512
#: Squared distances below this are taken from the differences: the product form cancels.
NEAR = 1e-4
#: Variances below this are rounding.
FLAT = 1e-13


@dataclass
class Cells:
    """Sums of the cells, in the order of their ids."""

    ids: np.ndarray       # ids as of a binary tree: halves of cell i are 2i and 2i + 1
    cluster: np.ndarray   # index of its cluster
    n: np.ndarray
    mean: np.ndarray
    spread: np.ndarray    # variance by dimension

    @property
    def variance(self) -> np.ndarray:
        v = self.spread.sum(axis=1)
        return np.where(v > FLAT, v, 0.0)


def _cells(rows: DataFrame, cols: list[str], clusters: list) -> Cells:
    """Sums of the cells in one aggregation."""
    got = (rows.groupBy("cell").agg(F.first("cluster").alias("cluster"), F.count(F.lit(1)).alias("n"),
                                    *[F.avg(c).alias(f"m_{c}") for c in cols], *[F.var_pop(c).alias(f"v_{c}") for c in cols])
           .toPandas().sort_values("cell"))  # a row for each cell
    return Cells(got["cell"].to_numpy(np.int64), np.array([clusters.index(c) for c in got["cluster"]], dtype=np.int64),
                 got["n"].to_numpy(float), got[[f"m_{c}" for c in cols]].to_numpy(float), got[[f"v_{c}" for c in cols]].to_numpy(float))


def _grid(rows: DataFrame, cols: list[str], clusters: list, error: float) -> DataFrame:
    """Rows with the id of their first cell: cluster and bins of an even grid."""
    ends = rows.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    lo, width = [ends[f"lo_{c}"] for c in cols], [ends[f"hi_{c}"] - ends[f"lo_{c}"] for c in cols]
    used = sum(w > 0 for w in width)
    side = START * np.sqrt(error) * np.sqrt(12.0 / max(used, 1))  # deviation of rows spread evenly over a bin
    bins = [max(1, min(1 << 6, int(np.ceil(w / side)))) for w in width]
    cell, n = F.array_position(F.array(*[F.lit(c) for c in clusters]), F.col("cluster")) - 1, len(clusters)
    for c, start, w, k in zip(cols, lo, width, bins):
        if k > 1:
            at = F.least(F.floor((F.col(c) - F.lit(start)) / F.lit(w / k)), F.lit(k - 1))
            cell, n = cell + at * F.lit(n), n * k
    return rows.withColumn("cell", (cell + F.lit(1 << (n - 1).bit_length())).cast("long"))


def _halve(rows: DataFrame, cols: list[str], cells: Cells, chosen: np.ndarray) -> DataFrame:
    """Rows of the chosen cells go to the half their value is in; means split both ways."""
    widest = cells.spread[chosen].argmax(axis=1)
    cuts = pd.DataFrame({"cell": cells.ids[chosen], "axis": widest, "cut": cells.mean[chosen, widest]})
    # at most a row for each cell
    cuts = F.broadcast(rows.sparkSession.createDataFrame(cuts.astype({"cell": "int64", "axis": "int32"}), "cell long, axis int, cut double"))
    value = F.element_at(F.array(*[F.col(c) for c in cols]), F.col("axis") + 1)
    half = F.when(F.col("cut").isNull(), F.col("cell")).otherwise(2 * F.col("cell") + (value > F.col("cut")).cast("long"))
    return rows.join(cuts, "cell", "left").withColumn("cell", half).drop("axis", "cut")


def _heaviest(weight: np.ndarray, share: float) -> np.ndarray:
    """Places of the greatest weights that hold the share of all."""
    order = np.argsort(-weight, kind="stable")
    kept = np.searchsorted(np.cumsum(weight[order]), share * weight.sum()) + 1
    return order[:kept][weight[order[:kept]] > 0]


def _rows_side(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, (x * x).sum(axis=1), np.ones(len(x))])


def _means_side(mean: np.ndarray) -> tuple[np.ndarray, float]:
    """Factor of the product that gives squared distances, and the least that it is taken for."""
    return (np.vstack([-2.0 * mean.T, np.ones(len(mean)), (mean * mean).sum(axis=1)]),
            NEAR * max(1.0, float(np.abs(mean).max(initial=0.0)) ** 2))


def _distances(x: np.ndarray, mean: np.ndarray, sides: tuple | None = None, out: np.ndarray | None = None) -> np.ndarray:
    """Squared distances of rows to means, as one product of matrices (squares included: each
    further pass over the distances takes as long as the product). ``sides``: its factors, if known."""
    left, (right, least) = sides or (_rows_side(x), _means_side(mean))
    d = np.matmul(left, right, out=out)
    # by place in the flat array: finding pairs in two dimensions takes longer than two roots
    near = np.flatnonzero(d < least)
    if len(near):
        at, cell = np.divmod(near, len(mean))
        d[at, cell] = ((x[at] - mean[cell]) ** 2).sum(axis=1)
    return d


@dataclass
class Tiles:
    """Cells in pieces that rows meet one after the other, with what is the same for all rows."""

    size: np.ndarray     # rows of each cluster
    weight: np.ndarray   # share of its cluster that a cell has
    pieces: list[tuple]  # (place, means, factor and least distance, rows by cluster, variances)

    @classmethod
    def of(cls, cells: Cells, k: int) -> Tiles:
        size = np.bincount(cells.cluster, cells.n, k)
        member = np.zeros((len(cells.n), k))
        member[np.arange(len(cells.n)), cells.cluster] = cells.n
        places = [slice(i, min(i + CELLS, len(cells.n))) for i in range(0, len(cells.n), CELLS)]
        variance = cells.variance
        return cls(size, cells.n / size[cells.cluster],
                   [(at, cells.mean[at], _means_side(cells.mean[at]), member[at], variance[at]) for at in places])


def _bounds(x: np.ndarray, own: np.ndarray, tiles: Tiles, k: int, weigh: bool):
    """Bounds of the silhouettes of some rows, their middle, and what each cell adds to
    the width of the mean distances (if asked for)."""
    size, left, ones = tiles.size, _rows_side(x), np.ones(len(x))
    low, high = np.zeros((len(x), k)), np.zeros((len(x), k))
    added = np.zeros(len(tiles.weight)) if weigh else None
    held = [np.empty(len(x) * CELLS) for _ in range(2)]  # two arrays for all pieces stay in the cache
    for at, mean, right, member, variance in tiles.pieces:
        near, far = (h[:len(x) * len(mean)].reshape(len(x), len(mean)) for h in held)
        _distances(x, mean, (left, right), near)
        np.sqrt(np.add(near, variance, out=far), out=far)
        np.sqrt(near, out=near)
        low += near @ member
        high += far @ member
        if weigh:
            added[at] = ones @ far - ones @ near
    if weigh:
        added *= tiles.weight
    others = np.where(np.arange(k) == own[:, None], np.maximum(size - 1, 1), size)
    low, high = low / others, high / others
    at = np.arange(len(x))

    def split(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rest = d.copy()
        rest[at, own] = np.inf
        return d[at, own], rest.min(axis=1)

    def silhouette(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        top = np.maximum(a, b)
        s = np.divide(b - a, top, out=np.zeros_like(top), where=top > 0)
        return np.where(size[own] <= 1, 0.0, s)

    (a_low, b_low), (a_high, b_high) = split(low), split(high)
    middle = silhouette(*split((low + high) / 2))
    return silhouette(a_high, b_low), silhouette(a_low, b_high), middle, added


def _blocks(batches: Iterator[pd.DataFrame], cols: list[str], clusters: list) -> Iterator[tuple]:
    """(batch, its rows, their coordinates and cluster indexes) in blocks whose meeting with
    the cells stays small."""
    index = {c: i for i, c in enumerate(clusters)}
    for b in batches:
        x, own = b[cols].to_numpy(float), b["cluster"].map(index).to_numpy(np.int64)
        for start in range(0, len(b), BLOCK):
            at = slice(start, start + BLOCK)
            yield b, at, x[at], own[at]


def _measure(rows: DataFrame, cols: list[str], clusters: list, cells: Cells) -> tuple[float, float, float, np.ndarray]:
    """Mean lower bound, mean upper bound, mean middle, and the width that each cell adds."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles = Tiles.of(shared.value, len(clusters))
        total, added = np.zeros(4), np.zeros(len(tiles.weight))
        for _, _, x, own in _blocks(batches, cols, clusters):
            low, high, middle, more = _bounds(x, own, tiles, len(clusters), True)
            total += len(x), low.sum(), high.sum(), middle.sum()
            added += more
        yield pd.DataFrame({"place": np.arange(-4, len(added)), "value": np.r_[total, added]})

    # summed over the tasks: a row for each cell
    got = rows.mapInPandas(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("v")).toPandas().sort_values("place")
    v = got["v"].to_numpy()
    return v[1] / v[0], v[2] / v[0], v[3] / v[0], v[4:]


def silhouette(df: DataFrame, cols: list[str] | None = None, cluster: str = "kmeans_cluster", id_col: str = "user_id_raiz",
               error: float = ERROR) -> tuple[DataFrame, float, float]:
    """M9: (rows with the silhouette and its bounds, mean silhouette, its error).

    The exact mean is within the returned error, which is at most ``error``; 0 with
    fewer than two clusters, and for the only row of a cluster."""
    cols = cols or C.FEATURE_COLUMNS
    rows = checkpoint(df.filter(F.col(cluster).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(cluster).alias("cluster"), *[F.col(c).cast("double").alias(c) for c in cols]))
    clusters = sorted(r[0] for r in rows.select("cluster").distinct().collect())
    names = [F.col("id").alias(id_col), F.col("cluster").alias(cluster)]
    if len(clusters) < 2:
        zero = [F.lit(0.0).alias(c) for c in ("silhouette", "silhouette_low", "silhouette_high")]
        return rows.select(*names, *zero), 0.0, 0.0
    tasks = min(TASKS, -(-rows.count() // TASK_ROWS))
    rows = checkpoint(_grid(rows.repartition(max(tasks, rows.rdd.getNumPartitions())), cols, clusters, error))
    while True:
        cells = _cells(rows, cols, clusters)
        low, high, middle, added = _measure(rows, cols, clusters, cells)
        middle = min(max(middle, low), high)
        within = max(high - middle, middle - low)
        added = np.where(cells.variance > 0, added, 0.0)
        if within <= error or not added.any():
            break
        # a halved cell keeps some half of its width: go for twice what is too much
        share = min(0.9, 2.2 * (1 - error / within))
        rows = checkpoint(_halve(rows, cols, cells, _heaviest(added, share)))
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles = Tiles.of(shared.value, len(clusters))
        for b, at, x, own in _blocks(batches, cols, clusters):
            low, high, mid, _ = _bounds(x, own, tiles, len(clusters), False)
            yield b[["id", "cluster"]].iloc[at].assign(silhouette=mid, silhouette_low=low, silhouette_high=high)

    id_type, cluster_type = (rows.schema[c].dataType.simpleString() for c in ("id", "cluster"))
    scored = rows.mapInPandas(score, f"id {id_type}, cluster {cluster_type}, silhouette double, silhouette_low double, silhouette_high double")
    return scored.select(*names, "silhouette", "silhouette_low", "silhouette_high"), float(middle), float(within)
