"""Clustering quality from per-cluster sums: O(n·k), no pairs.

* Calinski–Harabasz is exact from cluster counts, sums and squared norms.
* ``silhouette_sq`` uses squared Euclidean distance, which decomposes exactly:
  Σ_j |x−y_j|² = N|x|² − 2x·S + Q per cluster (the metric of Spark ML's
  ClusteringEvaluator). The Euclidean silhouette is in ``silhouette``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def cluster_sums(df: DataFrame, cols: list[str], cluster: str) -> list[dict]:
    """k rows: count, per-dimension sums, sum of squared norms."""
    sq = sum((F.col(c) * F.col(c) for c in cols[1:]), F.col(cols[0]) * F.col(cols[0]))
    rows = (df.groupBy(F.col(cluster).alias("k"))
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s_{c}") for c in cols],
                 F.sum(sq).alias("q")).collect())
    return [{"k": r["k"], "n": r["n"], "s": [r[f"s_{c}"] for c in cols], "q": r["q"]} for r in rows]


def calinski_harabasz(df: DataFrame, cols: list[str] | None = None, cluster: str = "kmeans_cluster") -> float:
    """(SSB/(k−1)) / (SSW/(n−k)); 1.0 when SSW = 0; 0.0 with one cluster."""
    cols = cols or C.FEATURE_COLUMNS
    sums = cluster_sums(df, cols, cluster)
    k = len(sums)
    if k < 2:
        return 0.0
    n = sum(s["n"] for s in sums)
    total = [sum(s["s"][i] for s in sums) for i in range(len(cols))]
    mean = [t / n for t in total]
    centers = {s["k"]: [v / s["n"] for v in s["s"]] for s in sums}
    ssb = sum(s["n"] * sum((centers[s["k"]][i] - mean[i]) ** 2 for i in range(len(cols))) for s in sums)
    # SSW as a second pass against the k literal centers (stable, no cancellation)
    expr = None
    for key, cen in centers.items():
        d = sum(((F.col(c) - F.lit(float(v))) ** 2 for c, v in zip(cols[1:], cen[1:])),
                (F.col(cols[0]) - F.lit(float(cen[0]))) ** 2)
        expr = F.when(F.col(cluster) == F.lit(key), d) if expr is None else expr.when(F.col(cluster) == F.lit(key), d)
    ssw = df.agg(F.sum(expr).alias("w")).first()["w"] or 0.0
    if ssw == 0.0:
        return 1.0
    return ssb * (n - k) / (ssw * (k - 1.0))


def silhouette_sq(df: DataFrame, cols: list[str] | None = None, cluster: str = "kmeans_cluster",
                  id_col: str = "user_id_raiz") -> tuple[DataFrame, float]:
    """M9 (squared Euclidean): per-row silhouette and its mean; 0.0 with one cluster."""
    cols = cols or C.FEATURE_COLUMNS
    sums = cluster_sums(df, cols, cluster)
    xx = sum((F.col(c) * F.col(c) for c in cols[1:]), F.col(cols[0]) * F.col(cols[0]))
    per, totals = {}, []
    for i, s in enumerate(sums):
        dot = sum((F.col(c) * F.lit(float(v)) for c, v in zip(cols[1:], s["s"][1:])),
                  F.col(cols[0]) * F.lit(float(s["s"][0])))
        totals.append((F.lit(float(s["n"])) * F.col("_xx") - F.lit(2.0) * dot + F.lit(float(s["q"]))).alias(f"_t{i}"))
        per[s["k"]] = (s["n"], F.col(f"_t{i}"))
    if len(sums) < 2:
        return df.select(id_col, F.lit(0.0).alias("silhouette_sq")), 0.0
    a = None
    b = None
    own_n = None
    for key, (n, tot) in per.items():
        is_own = F.col(cluster) == F.lit(key)
        a_k = tot / F.lit(float(max(n - 1, 1)))
        a = F.when(is_own, a_k) if a is None else a.when(is_own, a_k)
        own_n = F.when(is_own, F.lit(n)) if own_n is None else own_n.when(is_own, F.lit(n))
        other = F.when(~is_own, tot / F.lit(float(n)))
        b = other if b is None else F.least(b, other)
    s = F.when((own_n <= 1) | (F.greatest(a, b) <= 0), F.lit(0.0)).otherwise(F.try_divide(b - a, F.greatest(a, b)))
    # a row's sums over the clusters are columns: as part of the expression they'd be worked out anew
    # wherever they occur, in code too long to be compiled
    names = list(dict.fromkeys([id_col, cluster]))
    told = df.select(*names, *cols, xx.alias("_xx")).select(*names, *totals)
    rows = told.select(F.col(id_col), F.col(cluster), s.alias("silhouette_sq"))
    mean = rows.agg(F.avg("silhouette_sq").alias("m")).first()["m"]
    return rows, float(mean if mean is not None else 0.0)
