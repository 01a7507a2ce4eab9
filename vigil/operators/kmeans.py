"""k-means pieces: fit, assign, one Lloyd step, risk cluster.

Centers (k ≤ 10) are the only driver values; assignment is a column
expression over literal centers, so labelling never joins or shuffles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import expressions as X


def assign_column(cols: list[str], centers: list[list[float]]) -> tuple[F.Column, F.Column]:
    """Nearest center (first index wins ties) and its squared distance."""
    d = [X.sq_distance(cols, c) for c in centers]
    best = d[0]
    for di in d[1:]:
        best = F.least(best, di)
    label = F.lit(None).cast("int")
    for i in reversed(range(len(d))):
        label = F.when(d[i] == best, F.lit(i)).otherwise(label)
    return label, best


def assign_to_centers(matrix: DataFrame, centers: list[list[float]],
                      cols: list[str] | None = None, out: str = "kmeans_cluster") -> DataFrame:
    cols = cols or C.FEATURE_COLUMNS
    label, best = assign_column(cols, centers)
    return matrix.withColumn(out, label).withColumn("center_distance", F.sqrt(best))


def lloyd_step(assigned: DataFrame, cols: list[str] | None = None,
               cluster: str = "kmeans_cluster") -> DataFrame:
    """New centers = per-cluster means (partial aggregation, k rows out)."""
    cols = cols or C.FEATURE_COLUMNS
    return (assigned.groupBy(F.col(cluster).alias("cluster"))
            .agg(*[F.avg(c).alias(c) for c in cols], F.count(F.lit(1)).alias("n_users")))


def centers_of(step: DataFrame, cols: list[str] | None = None) -> list[list[float]]:
    """Collect ≤ k center rows, ordered by cluster id."""
    cols = cols or C.FEATURE_COLUMNS
    return [[r[c] for c in cols] for r in step.orderBy("cluster").collect()]


def risk_cluster(centers: list[list[float]], plus: int = C.RISK_CENTER_PLUS,
                 minus: int = C.RISK_CENTER_MINUS) -> int:
    """M6 + O4: argmax(center[days] − center[communities]); first index wins ties."""
    scores = [c[plus] - c[minus] for c in centers]
    return max(range(len(scores)), key=lambda i: (scores[i], -i))


# ------------------------------------------------------------------- fit (M5)

#: Points drawn in each oversampling round of a start, in centers asked for.
OVERSAMPLING = 2
ROUNDS = 2


def _uniform(row: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in (0, 1) from row hashes, one stream for each salt."""
    h = row.view(np.uint64).copy()
    for s in salt:
        h = (h ^ np.uint64(s + 1)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h = h * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest center (first wins) and its squared distance."""
    values = np.ascontiguousarray(x.T)
    best, least = np.zeros(len(x), dtype=np.int64), None
    for i, center in enumerate(centers):  # a column at a time: nothing of rows x centers x columns is held
        d = np.zeros(len(x))
        for v, c in zip(values, center):
            d += (v - c) ** 2
        if least is None:
            least = d
            continue
        nearer = d < least
        best[nearer], least[nearer] = i, d[nearer]
    return best, least


def _read(b: pa.RecordBatch, cols: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return b.column("row").to_numpy(zero_copy_only=False), np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols])


def _draw(rows: DataFrame, cols: list[str], seed: int, step: int, centers: list[np.ndarray | None], n: int) -> list[np.ndarray]:
    """For every run n rows, drawn by squared distance to its centers (or evenly, without
    centers) as the n least of -ln(u) / distance. One pass for all runs; a task hands on n
    rows for each."""
    schema = "run int, key double, row long, " + ", ".join(f"{c} double" for c in cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in centers]
        for b in batches:
            row, x = _read(b, cols)
            for r, known in enumerate(centers):
                weight = np.ones(len(x)) if known is None else _nearest(x, known)[1]
                key = np.full(len(x), np.inf)
                np.divide(-np.log(_uniform(row, seed, r, step)), weight, out=key, where=weight > 0)
                best = np.argsort(key, kind="stable")[:n]
                held[r] = sorted([*held[r], *zip(key[best].tolist(), row[best].tolist(), x[best].tolist())])[:n]
        flat = [(r, k, i, *v) for r, part in enumerate(held) for k, i, v in part if k < np.inf]
        columns = list(zip(*flat)) if flat else [[] for _ in range(3 + len(cols))]
        kinds = [pa.int32(), pa.float64(), pa.int64(), *[pa.float64()] * len(cols)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["run", "key", "row", *cols])

    order = Window.partitionBy("run").orderBy("key", "row")
    least = rows.mapInArrow(run, schema).withColumn("at", F.row_number().over(order)).filter(F.col("at") <= n)
    out: list[list] = [[] for _ in centers]
    for r in sorted(least.collect(), key=lambda r: (r["run"], r["at"])):  # n rows for each run
        out[r["run"]].append([r[c] for c in cols])
    return [np.array(v, dtype=float).reshape(-1, len(cols)) for v in out]


def _sums(rows: DataFrame, cols: list[str], centers: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """For every run: rows, coordinate sums by nearest center, and the cost. One pass and one
    aggregation for all runs; a task hands on a row for each run and center."""
    schema = "run int, center int, n double, cost double, " + ", ".join(f"{c} double" for c in cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {r: np.zeros((len(c), 2 + len(cols))) for r, c in centers.items()}
        for b in batches:
            _, x = _read(b, cols)
            for r, c in centers.items():
                best, d = _nearest(x, c)
                total[r] += np.column_stack([np.bincount(best, w, len(c)) for w in (None, d, *x.T)])
        flat = [(r, i, *t) for r, part in total.items() for i, t in enumerate(part.tolist())]
        names = ["run", "center", "n", "cost", *cols]
        kinds = [pa.int32(), pa.int32(), *[pa.float64()] * (2 + len(cols))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat), kinds)], names=names)

    found = rows.mapInArrow(run, schema).groupBy("run", "center").agg(*[F.sum(c).alias(c) for c in ("n", "cost", *cols)]).collect()
    out = {r: (np.zeros(len(c)), np.zeros_like(c), 0.0) for r, c in centers.items()}
    for r in found:  # a row for each run and center
        n, sums, cost = out[r["run"]]
        n[r["center"]], sums[r["center"]] = r["n"], [r[c] for c in cols]
        out[r["run"]] = n, sums, cost + r["cost"]
    return out


def _reduce(points: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k centers of a few weighted points: drawn by weighted distance, then settled."""
    points, weight = points[weight > 0], weight[weight > 0]
    centers = points[rng.choice(len(points), p=weight / weight.sum())][None]
    while len(centers) < min(k, len(points)):
        p = weight * _nearest(points, centers)[1]
        if p.sum() <= 0:
            break
        centers = np.vstack([centers, points[rng.choice(len(points), p=p / p.sum())]])
    for _ in range(30):
        best = _nearest(points, centers)[0]
        n = np.bincount(best, weight, len(centers))
        sums = np.column_stack([np.bincount(best, weight * v, len(centers)) for v in points.T])
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1e-300)[:, None], centers)
    return centers


def _starts(rows: DataFrame, cols: list[str], k: int, seed: int, runs: int) -> list[np.ndarray]:
    """Start centers of every run: one even draw, ``ROUNDS`` draws by distance, then the
    drawn points weighted by the rows nearest to them. All runs share the passes."""
    drawn = _draw(rows, cols, seed, 0, [None] * runs, 1)
    for step in range(1, ROUNDS + 1):
        more = _draw(rows, cols, seed, step, drawn, OVERSAMPLING * k)
        drawn = [np.vstack([a, b]) for a, b in zip(drawn, more)]
    near = _sums(rows, cols, dict(enumerate(drawn)))
    return [_reduce(points, near[r][0], k, np.random.default_rng([seed, r])) for r, points in enumerate(drawn)]


def fit_kmeans(matrix: DataFrame, k: int = C.KMEANS_K, seed: int = C.KMEANS_SEED,
               restarts: int = C.KMEANS_RESTARTS, cols: list[str] | None = None,
               max_iter: int = 300, tol: float = 1e-4, id_col: str = "user_id_raiz") -> tuple[list[list[float]], float]:
    """M5: k-means from ``restarts`` starts, least cost wins, ties to the first.

    Returns (centers, cost). All runs go through the rows together: one job for each
    Lloyd iteration, whatever their number; a run whose centers move by at most ``tol``
    rests. The input should be cheap to read again (cached or written)."""
    if not (C.N_CLUSTERS_MIN <= k <= C.N_CLUSTERS_MAX):
        raise ValueError(f"k must be in {C.N_CLUSTERS_MIN}..{C.N_CLUSTERS_MAX}")
    cols = cols or C.FEATURE_COLUMNS
    rows = matrix.select(F.xxhash64(F.col(id_col).cast("string")).alias("row"), *[F.col(c).cast("double").alias(c) for c in cols])
    if rows.isEmpty():
        return [], 0.0
    centers = dict(enumerate(_starts(rows, cols, k, seed, restarts)))
    moving = dict(centers)
    for _ in range(max_iter):
        for r, (n, sums, _) in _sums(rows, cols, moving).items():
            new = np.where(n[:, None] > 0, sums / np.maximum(n, 1.0)[:, None], moving[r])
            if np.sqrt(((new - moving[r]) ** 2).sum(axis=1)).max() <= tol:
                del moving[r]
            else:
                moving[r] = new
            centers[r] = new
        if not moving:
            break
    cost = {r: c for r, (_, _, c) in _sums(rows, cols, centers).items()}
    best = min(cost, key=lambda r: (cost[r], r))
    return centers[best].tolist(), cost[best]
