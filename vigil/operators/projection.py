"""PCA to two components and the covariance it is built from.

The 6×6 covariance comes from one aggregation; the eigen-decomposition runs
on the driver (a 6×6 matrix); projections are column expressions.
Sign rule (as the reference library): in each projected column the entry
of greatest magnitude is positive (ties: least user id).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def feature_covariance(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long form: (i, j, col_i, col_j, mean_i, mean_j, cov) for i ≤ j (covar_samp)."""
    cols = cols or C.FEATURE_COLUMNS
    aggs = [F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    aggs += [F.covar_samp(cols[i], cols[j]).alias(f"c{i}_{j}") for i, j in pairs]
    row = df.agg(*aggs)
    structs = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(cols[i]).alias("col_i"),
                        F.lit(cols[j]).alias("col_j"), F.col(f"m{i}").alias("mean_i"),
                        F.col(f"m{j}").alias("mean_j"), F.col(f"c{i}_{j}").alias("cov"))
               for i, j in pairs]
    return row.select(F.inline(F.array(*structs)))


def fit_pca(df: DataFrame, cols: list[str] | None = None, k: int = C.PCA_COMPONENTS,
            id_col: str = "user_id_raiz") -> dict:
    cols = cols or C.FEATURE_COLUMNS
    d = len(cols)
    cov_rows = feature_covariance(df, cols).collect()
    mean = np.zeros(d)
    cov = np.zeros((d, d))
    for r in cov_rows:
        mean[r["i"]] = r["mean_i"]
        mean[r["j"]] = r["mean_j"]
        v = r["cov"] if r["cov"] is not None else 0.0
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = v
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1][:k]
    comps = vecs[:, order].T  # k × d
    # sign: largest-magnitude projected value positive
    proj = [projection_column(cols, mean, comps[i]) for i in range(k)]
    # least negated magnitude, then least id: the same for numbers and text ids
    probe = df.agg(*[F.min(F.struct((-F.abs(p)).alias("m"), F.col(id_col).alias("id"), p.alias("p"))).alias(f"e{i}")
                     for i, p in enumerate(proj)]).first()
    for i in range(k):
        e = probe[f"e{i}"]
        if e is not None and e["p"] is not None and e["p"] < 0:
            comps[i] = -comps[i]
    total = float(np.sum(vals)) if np.sum(vals) > 0 else 1.0
    return {"mean": mean.tolist(), "components": comps.tolist(),
            "explained_variance": [float(vals[o]) for o in order],
            "explained_variance_ratio": [float(vals[o]) / total for o in order]}


def projection_column(cols: list[str], mean, comp) -> F.Column:
    out = None
    for c, m, w in zip(cols, mean, comp):
        t = (F.col(c) - F.lit(float(m))) * F.lit(float(w))
        out = t if out is None else out + t
    return out


def pca_project(df: DataFrame, model: dict, cols: list[str] | None = None,
                names: tuple[str, ...] = ("pca_x", "pca_y")) -> DataFrame:
    cols = cols or C.FEATURE_COLUMNS
    return df.withColumns({n: projection_column(cols, model["mean"], model["components"][i])
                           for i, n in enumerate(names)})
