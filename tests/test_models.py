"""Silhouette bounds, forest samples, k-means passes and the stored model against brute force."""

from __future__ import annotations

import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil import constants as C
from vigil.operators import dbscan as DB
from vigil.operators import ensemble as EN
from vigil.operators import iforest as IF
from vigil.operators import kmeans as KM
from vigil.operators import quality as QL
from vigil.operators import silhouette as SI
from vigil.plans import contract_ensemble as CE
from vigil.session import checkpoint, scratch_path

FC = C.FEATURE_COLUMNS


@pytest.fixture(scope="module")
def matrix(spark):
    return checkpoint(CE.ensemble_matrix(spark, "/root/testdata/sf0.01"))


def brute_silhouettes(x, label):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    names = np.unique(label)
    size = np.array([(label == c).sum() for c in names])
    total = np.column_stack([d[:, label == c].sum(axis=1) for c in names])
    own = np.searchsorted(names, label)
    at = np.arange(len(x))
    a = total[at, own] / np.maximum(size[own] - 1, 1)
    b = np.where(np.arange(len(names)) == own[:, None], np.inf, total / size).min(axis=1)
    top = np.maximum(a, b)
    return np.where((size[own] <= 1) | (top == 0), 0.0, (b - a) / np.where(top == 0, 1, top))


def test_silhouette_within_its_error_at_sf001(spark, matrix):
    rows = checkpoint(KM.assign_to_centers(matrix, CE.CENTERS))
    pdf = rows.toPandas()
    exact = brute_silhouettes(pdf[FC].to_numpy(), pdf["kmeans_cluster"].to_numpy())
    for error in (1e-3, 2e-2):
        out, mean, stated = SI.silhouette(rows, error=error)
        assert stated <= error and abs(mean - exact.mean()) <= min(stated, 1e-3 if error == 1e-3 else error)
        got = out.toPandas().set_index("user_id_raiz").loc[pdf["user_id_raiz"]]
        assert (got["silhouette_low"].to_numpy() <= exact + 1e-9).all() and (exact <= got["silhouette_high"].to_numpy() + 1e-9).all()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_silhouette_edges(spark):
    def mean(rows, error=1e-3):
        df = spark.createDataFrame([(i, c, float(x), float(y)) for i, (c, x, y) in enumerate(rows)], "user_id_raiz long, kmeans_cluster int, x double, y double")
        out, m, e = SI.silhouette(df, ["x", "y"], error=error)
        assert out.count() == sum(c is not None for c, _, _ in rows)
        return m, e

    assert mean([]) == mean([(1, 0, 0)]) == mean([(3, 0, 0)] * 5) == (0.0, 0.0)
    assert mean([(1, 0, 0), (2, 0, 0)]) == (0.0, 0.0)  # each alone
    assert mean([(1, 2, 2)] * 3 + [(2, 2, 2)] * 3) == (0.0, 0.0)  # no distance at all
    m, e = mean([(1, 0, 0)] * 50 + [(2, 3, 4)] * 70 + [(None, 9, 9)])
    assert (m, e) == (pytest.approx(1.0), pytest.approx(0.0))
    rng = np.random.default_rng(0)
    rows = [(int(c), *rng.normal(c, 1, 2)) for c in rng.integers(0, 3, 300)] + [(7, 100.0, -50.0)]
    exact = brute_silhouettes(np.array([r[1:] for r in rows]), np.array([r[0] for r in rows])).mean()
    m, e = mean(rows, 5e-3)
    assert abs(m - exact) <= e <= 5e-3


def test_silhouette_cells_follow_space_not_rows(spark):
    """A hundred copies of the rows need no more cells."""
    rng = np.random.default_rng(1)
    x = rng.random((200, 3))
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(user_id_raiz=range(200), kmeans_cluster=(x[:, 0] > 0.5).astype(int))
    df = spark.createDataFrame(pdf)
    counts = []
    for n in (1, 100):
        rows = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n))))
        grid = SI._grid(rows.withColumnRenamed("kmeans_cluster", "cluster"), ["a", "b", "c"], [0, 1], 1e-2)
        counts.append(grid.select("cell").distinct().count())
    assert counts[0] == counts[1]


# ----------------------------------------------------------------------------- forest

def test_forest_samples_are_the_least_hashes(spark):
    df = spark.range(3000).select(F.col("id").alias("user_id_raiz"), *[F.rand(i).alias(c) for i, c in enumerate(FC)]).repartition(7)
    df = checkpoint(df)

    def samples(bound):
        pdf = IF.sample_per_tree(df, FC, "user_id_raiz", 5, 64, 42, bound).toPandas()
        return {t: g.nsmallest(64, ["hash", "row"])[["hash", "row"]].apply(tuple, axis=1).tolist() for t, g in pdf.groupby("tree")}

    everything = samples(1.0)
    assert samples(4 * 64 / 3000) == everything and all(len(set(v)) == 64 for v in everything.values())
    rows = {t: {r for _, r in v} for t, v in everything.items()}
    assert all(len(rows[a] & rows[b]) < 20 for a in rows for b in rows if a < b)  # trees draw apart
    # a bound that leaves trees short is lifted
    short, full = (IF.fit(df, trees=5, max_samples=64, spare=s) for s in (0.5, 4.0))
    assert sorted(short["nodes"]) == sorted(full["nodes"]) and all(n[6] == 64 for n in full["nodes"] if n[1] == 0)


def test_forest_of_few_and_equal_rows(spark):
    for n in (1, 2, 5):
        df = spark.range(n).select(F.col("id").alias("user_id_raiz"), *[F.lit(0.5).alias(c) for c in FC])
        out, _ = IF.predict(df, IF.fit(df, trees=3))
        assert {r.iso_prediction for r in out.collect()} == {1}


# ---------------------------------------------------------------------------- k-means

def test_kmeans_is_no_worse_than_restarts_of_spark_ml(spark, matrix):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    centers, cost = KM.fit_kmeans(matrix, k=4, restarts=10)
    vec = VectorAssembler(inputCols=FC, outputCol="f").transform(matrix).cache()
    best = min(KMeans(k=4, seed=42 + r, maxIter=300, featuresCol="f").fit(vec).summary.trainingCost for r in range(5))
    vec.unpersist()
    assert cost <= best * (1 + 1e-6)
    x = matrix.select(*FC).toPandas().to_numpy()
    d = ((x[:, None] - np.array(centers)[None]) ** 2).sum(axis=2)
    assert cost == pytest.approx(d.min(axis=1).sum())
    again, cost_again = KM.fit_kmeans(matrix.repartition(5), k=4, restarts=10)
    assert cost_again == pytest.approx(cost)  # draws follow the ids, not the partitions


def test_lloyd_steps_from_literal_starts(spark, matrix):
    rows = matrix.select(F.xxhash64(F.col("user_id_raiz").cast("string")).alias("row"), *FC)
    x = matrix.select(*FC).toPandas().to_numpy()
    starts = {0: np.array(CE.CENTERS), 1: np.array(CE.CENTERS)[::-1] * 0.9, 2: np.array(CE.CENTERS)[:2]}
    for r, (n, sums, cost) in KM._sums(rows, FC, starts).items():
        d = ((x[:, None] - starts[r][None]) ** 2).sum(axis=2)
        near = d.argmin(axis=1)
        assert cost == pytest.approx(d.min(axis=1).sum()) and n.tolist() == np.bincount(near, minlength=len(starts[r])).tolist()
        assert sums == pytest.approx(np.array([x[near == k].sum(axis=0) for k in range(len(starts[r]))]))


def test_kmeans_of_few_distinct_rows(spark):
    df = spark.range(40).select(F.col("id").alias("user_id_raiz"), *[(F.col("id") % 2).cast("double").alias(c) for c in FC])
    centers, cost = KM.fit_kmeans(df, k=3, restarts=2)
    assert cost == pytest.approx(0.0) and {round(c[0]) for c in centers} == {0, 1}
    assert KM.fit_kmeans(df.limit(0), k=3) == ([], 0.0)


# ------------------------------------------------------------------------- stored model

def test_stored_model_scores_alike(spark, matrix):
    """A fit, and the model it stored as another session reads it, give equal scores; only
    buckets of neighbouring cells are read."""
    sample = matrix.filter(F.col("user_id_raiz") % 3 == 0)
    fit = EN.fit_predict(sample, restarts=2, with_pca=False)
    path = scratch_path(spark, "model")
    fit.save(path)
    other = spark.newSession()
    new = matrix.filter(F.col("user_id_raiz") % 3 == 1)
    columns = ["user_id_raiz", "kmeans_cluster", "dbscan_cluster", "iso_score", "total_votes", "risk_level", "severity_index"]
    want = sorted(map(tuple, fit.score_batch(new).select(*columns).collect()))
    got = sorted(map(tuple, EN.EnsembleModel.load(other, path).score(other.createDataFrame(new.toPandas())).select(*columns).collect()))
    assert len(want) == len(got) == new.count()
    for a, b in zip(want, got):
        assert (a[:3], a[4:6]) == (b[:3], b[4:6]) and a[3] == pytest.approx(b[3]) and a[6] == pytest.approx(b[6])
    core = DB.CorePoints.read(spark, f"{path}/core", len(FC))
    cell = core.cells.orderBy(F.col("n").desc()).limit(1)
    points = core.points_of(cell.select("cell"))
    assert points.count() == cell.first()["n"] and "PartitionFilters" in points._jdf.queryExecution().toString()


def test_new_rows_against_brute_force_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.random((600, len(FC))) * [1, 1, 1, 0.2, 0.2, 0.2]
    df = spark.createDataFrame(pd.DataFrame(x, columns=FC).assign(user_id_raiz=range(600)))
    labels = DB.dbscan(df, eps=0.25)
    core = df.join(labels.filter("is_core").select("user_id_raiz", "dbscan_cluster"), "user_id_raiz")
    pdf = core.toPandas()
    new = rng.random((150, len(FC))) * [1, 1, 1, 0.3, 0.3, 0.3]
    near = ((new[:, None] - pdf[FC].to_numpy()[None]) ** 2).sum(axis=2) <= 0.25**2
    want = [min(pdf["dbscan_cluster"][n], default=-1) for n in near]
    got = DB.assign_to_fit(spark.createDataFrame(pd.DataFrame(new, columns=FC).assign(user_id_raiz=range(150))), core, eps=0.25)
    assert [r.dbscan_cluster for r in got.orderBy("user_id_raiz").collect()] == want and len(set(want)) > 1


def test_silhouette_deals_rows_not_bytes(spark):
    """Rows of few bytes in one partition are measured by several tasks."""
    n = 2 * SI.TASK_ROWS + 1
    rows = spark.range(n).coalesce(1).select(F.col("id").alias("user_id_raiz"), (F.col("id") % 2).cast("int").alias("kmeans_cluster"),
                                             ((F.col("id") % 2) + (F.col("id") % 7) / 70).alias("x"))
    scored, mean, error = SI.silhouette(rows, ["x"], error=0.02)
    assert scored.rdd.getNumPartitions() >= 3 and scored.count() == n
    assert error <= 0.02 and 0.8 < mean < 1


def test_silhouette_distances_do_not_cancel():
    rng = np.random.default_rng(5)
    mean = rng.random((40, 6)) + 100.0
    x = np.vstack([mean[:20], mean[20:] + 1e-9, rng.random((20, 6)) + 100.0])
    exact = ((x[:, None, :] - mean[None]) ** 2).sum(axis=2)
    got = SI._distances(x, mean)
    assert np.abs(np.sqrt(got) - np.sqrt(exact)).max() < 1e-8 and (got[np.arange(20), np.arange(20)] == 0).all()


def test_silhouette_bounds_hold_over_pieces_of_cells(spark, monkeypatch):
    """the cells' side of the distances is made once and pieces are met in arrays that stay."""
    monkeypatch.setattr(SI, "CELLS", 16)
    rng = np.random.default_rng(9)
    k, per = 3, rng.integers(1, 6, 50)
    cell = np.repeat(np.arange(50), per)
    center = rng.random((50, 6))
    x = center[cell] + rng.normal(0, 0.02, (len(cell), 6)) * (cell % 2)[:, None]  # every other cell has equal rows
    cluster = np.arange(50) % k
    stats = [(x[cell == i].mean(axis=0), x[cell == i].var(axis=0)) for i in range(50)]
    cells = SI.Cells(np.arange(50), cluster, per.astype(float), np.array([m for m, _ in stats]), np.array([v for _, v in stats]))
    tiles = SI.Tiles.of(cells, k)
    assert [p[0] for p in tiles.pieces] == [slice(0, 16), slice(16, 32), slice(32, 48), slice(48, 50)]
    low, high, middle, added = SI._bounds(x, cluster[cell], tiles, k, True)
    exact = brute_silhouettes(x, cluster[cell])
    assert (low <= exact + 1e-9).all() and (exact <= high + 1e-9).all() and ((low <= middle + 1e-12) & (middle <= high + 1e-12)).all()
    near = np.sqrt(((x[:, None] - cells.mean[None]) ** 2).sum(axis=2))
    far = np.sqrt(near ** 2 + cells.variance)
    size = np.bincount(cluster, per, k)
    assert added == pytest.approx((far - near).sum(axis=0) * per / size[cluster], abs=1e-9)
    factors = []
    means_side = SI._means_side
    monkeypatch.setattr(SI, "_means_side", lambda mean: factors.append(len(mean)) or means_side(mean))
    tiles = SI.Tiles.of(cells, k)
    for i in range(0, len(x), 10):
        SI._bounds(x[i:i + 10], cluster[cell][i:i + 10], tiles, k, True)
    assert factors == [16, 16, 16, 2]  # not once more for each block of rows


def test_squared_silhouette_sums_are_worked_out_once(spark):
    """the sums over the clusters are columns, not copied into each branch."""
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.random((200, 6)), columns=FC).assign(user_id_raiz=range(200), kmeans_cluster=np.arange(200) % 4)
    rows, mean = QL.silhouette_sq(spark.createDataFrame(pdf).repartition(2))
    x, label = pdf[FC].to_numpy(), pdf["kmeans_cluster"].to_numpy()
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    total = np.column_stack([d[:, label == c].sum(axis=1) for c in range(4)])
    at = np.arange(200)
    a, b = total[at, label] / 49, np.where(np.arange(4) == label[:, None], np.inf, total / 50).min(axis=1)
    assert mean == pytest.approx(((b - a) / np.maximum(a, b)).mean())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(rf"{FC[0]}#\d+ \*", plan)) <= 5  # the square, and once for each cluster


def test_nearest_center_holds_no_rows_by_centers_by_columns():
    """the working memory of a pass is a few columns of its rows."""
    rng = np.random.default_rng(4)
    x, centers = np.round(rng.random((20_000, 6)), 2), np.round(rng.random((21, 6)), 1)
    d = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
    tracemalloc.start()
    best, least = KM._nearest(x, centers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (best == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()  # to the bit, ties to the first
    assert peak < 2 * x.nbytes + 6 * 20_000 * 8


def test_sub_cells_are_aggregated_without_sorting_points(spark):
    """and the one point of a sub-cell is a point of it."""
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame(np.round(rng.random((500, 2)), 1), columns=["x0", "x1"]).assign(cid=np.arange(500) % 3)
    pts = spark.createDataFrame(pdf)
    sub = DB._sub_cells(pts, 2, 0.5, 1)
    assert "SortAggregate" not in sub._jdf.queryExecution().sparkPlan().toString()
    side = DB._side_of(sub, 2, "a").toPandas()
    key = DB._sub_key(2, 0.5, 1).alias("key")
    points = set(map(tuple, pts.select("cid", key, "x0", "x1").collect()))
    assert side["n_a"].sum() == 500
    for r in side.itertuples():
        assert (r.cid_a, r.next_a, r.aone0, r.aone1) in points
