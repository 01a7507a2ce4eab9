"""Properties of the learning operators on the small fixture."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil import constants as C
from vigil.operators import dbscan as DB
from vigil.operators import iforest as IF
from vigil.operators import kmeans as KM
from vigil.operators import projection as PJ
from vigil.operators import quality as QL
from vigil.operators import stats as ST
from vigil.plans import contract_ensemble as CE
from vigil.session import checkpoint

FC = C.FEATURE_COLUMNS


@pytest.fixture(scope="module")
def matrix(spark, sf_dir):
    return checkpoint(CE.ensemble_matrix(spark, sf_dir))


@pytest.fixture(scope="module")
def points(matrix):
    rows = matrix.orderBy("user_id_raiz").collect()
    return np.array([r["user_id_raiz"] for r in rows]), np.array([[r[c] for c in FC] for r in rows])


def textbook_dbscan(X, eps, min_samples):
    """Plain sequential DBSCAN in index order (the reference library's expansion order)."""
    n = len(X)
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    nb = [np.flatnonzero(d2[i] <= eps * eps) for i in range(n)]
    core = np.array([len(x) >= min_samples for x in nb])
    labels = np.full(n, -1)
    c = 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        labels[i] = c
        stack = [i]
        while stack:
            j = stack.pop()
            for k in nb[j]:
                if labels[k] == -1:
                    labels[k] = c
                    if core[k]:
                        stack.append(k)
        c += 1
    return labels, core


def test_dbscan_equals_textbook(matrix, points):
    ids, X = points
    want, core = textbook_dbscan(X, C.DBSCAN_EPS, C.DBSCAN_MIN_SAMPLES)
    got = {r["user_id_raiz"]: (r["dbscan_cluster"], r["is_core"]) for r in DB.dbscan(matrix).collect()}
    assert [got[i][1] for i in ids] == list(core)
    assert [got[i][0] for i in ids] == list(want)


def test_kmeans_properties(matrix, points):
    centers, cost = KM.fit_kmeans(matrix, k=4, restarts=3)
    _, X = points
    d = ((X[:, None, :] - np.array(centers)[None]) ** 2).sum(-1)
    lab = np.array([r["kmeans_cluster"] for r in KM.assign_to_centers(matrix, centers).orderBy("user_id_raiz").collect()])
    assert (lab == d.argmin(1)).all()                       # every row goes to its nearest center
    assert cost == pytest.approx(d.min(1).sum(), rel=1e-6)  # cost = within-cluster SSE
    single, single_cost = KM.fit_kmeans(matrix, k=4, restarts=1)
    assert cost <= single_cost + 1e-9                       # best of restarts ≤ one run
    assert KM.risk_cluster([[0, 1, 0, 0, 0, 0], [0, 2, 0, 0, 0, 1], [0, 3, 0, 0, 0, 2]]) == 0  # first wins ties


def test_isolation_forest_contamination(matrix):
    model = IF.fit(matrix)
    out, offset = IF.predict(matrix, model, 0.1)
    rows = out.collect()
    share = sum(r["vote_iso"] for r in rows) / len(rows)
    assert abs(share - 0.1) <= 0.02
    assert all((r["iso_score"] < 0) == (r["iso_prediction"] == -1) for r in rows)
    assert len(model["nodes"]) <= C.IFOREST_TREES * (2 * model["psi"] - 1)


def test_pca_properties(matrix, points):
    model = PJ.fit_pca(matrix)
    proj = np.array([[r["pca_x"], r["pca_y"]] for r in PJ.pca_project(matrix, model).collect()])
    assert abs(proj.mean(0)).max() < 1e-9                  # centered
    cov = np.cov(proj.T)
    assert abs(cov[0, 1]) < 1e-9                            # uncorrelated
    assert cov[0, 0] >= cov[1, 1]                           # variance ordered
    for j in range(2):                                      # sign rule
        assert proj[np.argmax(np.abs(proj[:, j])), j] > 0
    _, X = points
    w = np.linalg.eigvalsh(np.cov(X.T))[::-1][:2]
    assert model["explained_variance"] == pytest.approx(list(w), rel=1e-6)


def test_quality_against_brute_force(matrix, points):
    centers = CE.CENTERS
    asg = KM.assign_to_centers(matrix, centers)
    lab = np.array([r["kmeans_cluster"] for r in asg.orderBy("user_id_raiz").collect()])
    _, X = points
    # Calinski–Harabasz
    mu = X.mean(0)
    ks = sorted(set(lab))
    ssb = sum((lab == k).sum() * ((X[lab == k].mean(0) - mu) ** 2).sum() for k in ks)
    ssw = sum(((X[lab == k] - X[lab == k].mean(0)) ** 2).sum() for k in ks)
    want_ch = ssb * (len(X) - len(ks)) / (ssw * (len(ks) - 1))
    assert QL.calinski_harabasz(asg) == pytest.approx(want_ch, rel=1e-9)
    # squared-Euclidean silhouette
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() <= 1:
            s.append(0.0)
            continue
        a = d2[i, own].sum() / (own.sum() - 1)
        b = min(d2[i, lab == k].mean() for k in ks if k != lab[i])
        s.append((b - a) / max(a, b))
    assert QL.silhouette_sq(asg)[1] == pytest.approx(float(np.mean(s)), rel=1e-9)


def test_exact_percentile(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=30000), np.full(5000, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(8)
    for q in (0.0, 0.1, 0.5, 0.9, 1.0):
        assert ST.exact_percentile(df, "v", q) == pytest.approx(float(np.percentile(vals, q * 100)), abs=1e-12)


def test_assign_ids_dense(spark):
    from vigil.operators.sinks import assign_ids

    df = spark.range(0, 5000, 3).withColumnRenamed("id", "user_id_raiz").repartition(7)
    rows = assign_ids(df, start=10).orderBy("user_id_raiz").collect()
    assert [r["id"] for r in rows] == list(range(10, 10 + len(rows)))


def test_score_batch_reproduces_fit(spark, sf_dir):
    """Scoring the fitted rows again gives the fit's own labels and scores."""
    from vigil.operators import ensemble as EN
    from vigil.plans.contract import sources

    feats = CE.ensemble_features(sources(spark, sf_dir))
    fit = EN.fit_predict(feats, restarts=2, with_pca=False)
    want = {r["user_id_raiz"]: r for r in fit.results.collect()}
    got = {r["user_id_raiz"]: r for r in fit.score_batch(feats).collect()}
    assert set(got) == set(want)
    for uid, w in want.items():
        g = got[uid]
        for c in ("kmeans_cluster", "dbscan_cluster", "vote_iso", "total_votes", "risk_level"):
            assert g[c] == w[c], (uid, c)
        assert g["iso_score"] == pytest.approx(w["iso_score"], abs=1e-12)
        assert g["severity_index"] == pytest.approx(w["severity_index"], abs=1e-9)


def test_trained_scorer_separates_labels(spark, sf_dir):
    """X2(b): the spark.ml scorer ranks labelled toxic texts above clean ones."""
    from vigil.operators import sentiment as S

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    train = docs.join(labels, "doc_id").select("text", F.col("toxic").alias("label"))
    scorer = S.TrainedScorer().fit(train, "text", "label")
    scored = scorer(train.withColumnRenamed("text", "content"))
    m = {r["label"]: r["s"] for r in scored.groupBy("label").agg(F.avg("score").alias("s")).collect()}
    assert m[1] > m[0]
    assert scored.filter((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
