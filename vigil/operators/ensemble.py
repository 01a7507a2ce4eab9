"""Risk ensemble: k-means + DBSCAN + forest vote.

Plan: scaled matrix (cached once) → three branches keyed by user → one join
(DBSCAN labels; k-means labels and forest scores are columns on the same
rows) → votes, level, severity → PCA columns. Driver values: ≤ 10 centers,
min/max rows, the forest nodes, the 6×6 PCA basis.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import expressions as X
from . import dbscan as DB
from . import features as FT
from . import iforest as IF
from . import kmeans as KM
from . import projection as PJ
from . import quality as QL
from . import reports as R
from . import silhouette as SI


def combine_votes(df: DataFrame) -> DataFrame:
    """M8: total votes and level (≥2 high, 1 moderate, 0 low)."""
    return (df.withColumn("total_votes", F.col("vote_kmeans") + F.col("vote_dbscan") + F.col("vote_iso"))
            .withColumn("risk_level", X.level_from_votes("total_votes")))


def severity_index(df: DataFrame, risk_center: list[float] | None, cols: list[str] | None = None,
                   w_iso: float = C.SEVERITY_WEIGHT_IFOREST, w_db: float = C.SEVERITY_WEIGHT_DBSCAN,
                   w_km: float = C.SEVERITY_WEIGHT_KMEANS, eps: float = C.SEVERITY_EPS,
                   bounds: dict | None = None) -> DataFrame:
    """M13 + J10 + F18 + F19 + F7: 100·(w1(1−iso_n) + w2·noise + w3(1−dist_n)), clipped.

    ``bounds`` (ilo, ihi, dlo, dhi) come from the data unless given (X3 scoring
    of new rows reuses the fit's bounds).
    """
    cols = cols or C.FEATURE_COLUMNS
    if risk_center is not None:
        df = df.withColumn("risk_distance", X.distance(cols, risk_center))
    else:
        df = df.withColumn("risk_distance", F.lit(None).cast("double"))
    b = bounds or severity_bounds(df)
    iso_n = X.minmax("iso_score", b["ilo"] or 0.0, b["ihi"] or 0.0, eps)
    if risk_center is not None:
        dist_n = X.minmax("risk_distance", b["dlo"] or 0.0, b["dhi"] or 0.0, eps)
    else:
        dist_n = F.lit(0.0)
    sev = (F.lit(w_iso) * (F.lit(1.0) - iso_n) + F.lit(w_db) * F.col("vote_dbscan")
           + F.lit(w_km) * (F.lit(1.0) - dist_n))
    return (df.withColumn("distance_norm", dist_n)
            .withColumn("severity_index", X.clip(sev * F.lit(100.0), 0.0, 100.0)))


def severity_bounds(df: DataFrame) -> dict:
    """A7 for the severity terms: one global aggregate row."""
    r = df.agg(F.min("iso_score").alias("ilo"), F.max("iso_score").alias("ihi"),
               F.min("risk_distance").alias("dlo"), F.max("risk_distance").alias("dhi")).first()
    return r.asDict()


@dataclass
class EnsembleModel:
    """What scoring new rows needs of a fit (X3); all but the core points is small."""

    centers: list[list[float]]
    risk_cluster_id: int
    matrix_bounds: dict
    forest: dict
    iso_offset: float
    severity_bounds: dict
    core: DB.CorePoints

    def save(self, spark: SparkSession, root: str, core: DataFrame) -> None:
        """Write the model to a folder; ``core`` are the fit's core rows."""
        small = {f.name: getattr(self, f.name) for f in fields(self) if f.name != "core"}
        DB.CorePoints.write(core, f"{root}/core", C.FEATURE_COLUMNS)
        # written last: a folder without it is no model
        spark.createDataFrame([(json.dumps(small),)], "value string").coalesce(1).write.text(f"{root}/model")

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> EnsembleModel:
        small = json.loads(spark.read.text(f"{root}/model").first()["value"])
        small["forest"]["nodes"] = [tuple(n) for n in small["forest"]["nodes"]]
        return cls(**small, core=DB.CorePoints.read(spark, f"{root}/core", len(C.FEATURE_COLUMNS)))

    def score(self, features: DataFrame, id_col: str = "user_id_raiz") -> DataFrame:
        """Score new rows with the fitted models (no refit).

        Fit's MinMax bounds → nearest fitted center (k-means vote), forest
        score minus the fit's offset (forest vote), ε-neighbour of a fitted
        core point (DBSCAN vote) → level; severity with the fit's bounds.
        """
        cols = C.FEATURE_COLUMNS
        x = FT.apply_minmax(FT.matrix_columns(features, id_col, cols), self.matrix_bounds)
        x = KM.assign_to_centers(x, self.centers).drop("center_distance")
        x = x.withColumn("vote_kmeans", (F.col("kmeans_cluster") == F.lit(self.risk_cluster_id)).cast("int"))
        x = (x.withColumn("iso_score", -IF.score_column(self.forest) - F.lit(self.iso_offset))
             .withColumn("iso_prediction", F.when(F.col("iso_score") < 0, F.lit(-1)).otherwise(F.lit(1)))
             .withColumn("vote_iso", (F.col("iso_prediction") == -1).cast("int")))
        db = DB.assign_to_fit(x.select(id_col, *cols), self.core, cols, id_col=id_col)
        res = combine_votes(x.join(db, id_col))
        return severity_index(res, self.centers[self.risk_cluster_id], cols, bounds=self.severity_bounds)


@dataclass
class EnsembleResult:
    results: DataFrame
    matrix: DataFrame
    centers: list[list[float]]
    risk_cluster_id: int | None
    metrics: dict = field(default_factory=dict)
    pca: dict | None = None
    matrix_bounds: dict | None = None
    forest: dict | None = None
    iso_offset: float | None = None
    severity_bounds: dict | None = None
    core: DataFrame | None = None

    def model(self) -> EnsembleModel:
        return EnsembleModel(self.centers, self.risk_cluster_id, self.matrix_bounds, self.forest, self.iso_offset,
                             self.severity_bounds, DB.CorePoints.of(self.core, C.FEATURE_COLUMNS))

    def save(self, root: str) -> None:
        """Write the fitted model; ``EnsembleModel.load`` reads it, in any session."""
        self.model().save(self.results.sparkSession, root, self.core)

    def score_batch(self, features: DataFrame, id_col: str = "user_id_raiz") -> DataFrame:
        """Score new rows with the fitted models (no refit)."""
        return self.model().score(features, id_col)

    def as_scorer(self):
        """T3 ``scorer``: features → risk_level + severity_index."""
        return self.model().score

    def summary(self, spark, execution_date: str) -> DataFrame:
        """One row — date, metrics, counts per level, centers, risk cluster."""
        dist = R.risk_counts(self.results).collect()
        counts = {r["risk_level"]: r["n_users"] for r in dist}
        row = {
            "execution_date": execution_date,
            "silhouette": float(self.metrics.get("silhouette", 0.0)),
            "silhouette_sq": float(self.metrics.get("silhouette_sq", 0.0)),
            "calinski_harabasz": float(self.metrics.get("calinski_harabasz", 0.0)),
            "total_users": int(self.metrics.get("total_users", 0)),
            "high_risk_percentage": float(self.metrics.get("high_risk_percentage", 0.0)),
            "n_bajo": int(counts.get(C.LEVEL_LOW, 0)),
            "n_moderado": int(counts.get(C.LEVEL_MODERATE, 0)),
            "n_alto": int(counts.get(C.LEVEL_HIGH, 0)),
            "risk_cluster_id": self.risk_cluster_id,
            "cluster_centers": [[float(v) for v in c] for c in self.centers],
        }
        return spark.createDataFrame([row], schema=(
            "execution_date string, silhouette double, silhouette_sq double, calinski_harabasz double, total_users long, "
            "high_risk_percentage double, n_bajo long, n_moderado long, n_alto long, risk_cluster_id int, "
            "cluster_centers array<array<double>>"))

    def users_by_level(self, level: str) -> DataFrame:
        return R.users_by_level(self.results, level)

    def cluster_profiles(self) -> DataFrame:
        """A10 over the fitted k-means labels."""
        return R.cluster_profiles(self.matrix.join(self.results.select("user_id_raiz", "kmeans_cluster"),
                                                   "user_id_raiz"), self.risk_cluster_id)


def fit_predict(features: DataFrame, n_clusters: int = C.KMEANS_K,
                contamination: float = C.IFOREST_CONTAMINATION, id_col: str = "user_id_raiz",
                restarts: int = C.KMEANS_RESTARTS, with_pca: bool = True,
                silhouette_error: float = 5e-3) -> EnsembleResult:
    """The full ensemble over a feature table. The Euclidean silhouette among the
    metrics is within ``silhouette_error``."""
    if not (C.N_CLUSTERS_MIN <= n_clusters <= C.N_CLUSTERS_MAX):
        raise ValueError(f"n_clusters must be in {C.N_CLUSTERS_MIN}..{C.N_CLUSTERS_MAX}")
    cols = C.FEATURE_COLUMNS
    from ..session import checkpoint
    matrix, mbounds = FT.prepare_matrix_fit(features, id_col, cols)
    matrix = checkpoint(matrix)

    centers, _cost = KM.fit_kmeans(matrix, k=n_clusters, restarts=restarts)
    risk_idx = KM.risk_cluster(centers)
    km = KM.assign_to_centers(matrix, centers).drop("center_distance")
    km = km.withColumn("vote_kmeans", (F.col("kmeans_cluster") == F.lit(risk_idx)).cast("int"))

    model = IF.fit(matrix, cols, id_col)
    scored, offset = IF.predict(km, model, contamination)

    db = checkpoint(DB.dbscan(matrix, cols, id_col=id_col))
    core = matrix.join(db.filter("is_core").select(id_col, "dbscan_cluster"), id_col)
    res = combine_votes(scored.join(db.select(id_col, "dbscan_cluster", "vote_dbscan"), id_col))
    res = res.withColumn("risk_distance", X.distance(cols, centers[risk_idx]))
    sbounds = severity_bounds(res)
    # written once: metrics, projection and callers read it, and nothing is left in memory
    res = checkpoint(severity_index(res.drop("risk_distance"), centers[risk_idx], cols, bounds=sbounds))

    n_labels = res.select("kmeans_cluster").distinct().limit(2).count()
    metrics = {}
    if n_labels > 1:
        metrics["silhouette_sq"] = QL.silhouette_sq(res, cols, "kmeans_cluster", id_col)[1]
        _, metrics["silhouette"], metrics["silhouette_error"] = SI.silhouette(res, cols, "kmeans_cluster", id_col, silhouette_error)
        metrics["calinski_harabasz"] = QL.calinski_harabasz(res, cols, "kmeans_cluster")
    else:
        metrics["silhouette_sq"] = metrics["silhouette"] = metrics["silhouette_error"] = 0.0
        metrics["calinski_harabasz"] = 0.0
    tot = R.risk_totals(res).first()
    metrics["total_users"] = tot["total_users"]
    metrics["high_risk_percentage"] = tot["high_risk_percentage"] or 0.0

    pca = None
    if with_pca:
        pca = PJ.fit_pca(matrix, cols, id_col=id_col)
        res = PJ.pca_project(res, pca, cols)
    out = res.select(id_col, "kmeans_cluster", "vote_kmeans", "dbscan_cluster", "vote_dbscan",
                     "iso_prediction", "iso_score", "vote_iso", "total_votes", "risk_level",
                     "severity_index", *(["pca_x", "pca_y"] if with_pca else []))
    return EnsembleResult(out, matrix, centers, risk_idx, metrics, pca, mbounds, model, offset, sbounds, core)
