"""Isolation forest on Spark.

* Sampling: tree t takes the ψ = min(256, n) rows with the smallest hashes of
  (seed, t, id). One pass over the rows: a task hashes each row for all trees at
  once in numpy and hands on only rows below a hash that some 4ψ rows of all are
  below, and of these at most the ψ smallest per tree. If a tree still falls short
  the pass runs again without that bound (exact).
* Growing: ``groupBy(tree).applyInPandas`` — one group = the tree's few rows, cut to ψ.
* Scoring: the forest (≤ 100 × 511 nodes, a proven bound) is shipped to an
  Arrow-batched pandas UDF that walks all trees level by level in numpy.
* Threshold: offset = exact percentile (numpy linear rule) of training
  scores at 100·contamination; decision = score − offset; −1 when < 0.

The library's random stream cannot be reproduced, so values differ from
the reference; properties (share of −1 ≈ contamination) are tested.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from . import stats

EULER = 0.5772156649015329


def avg_path(n):
    """c(n): average path length of an unsuccessful BST search."""
    n = np.asarray(n, dtype="float64")
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


NODE_SCHEMA = T.StructType([
    T.StructField("tree", T.IntegerType()), T.StructField("node", T.IntegerType()),
    T.StructField("feature", T.IntegerType()), T.StructField("threshold", T.DoubleType()),
    T.StructField("left", T.IntegerType()), T.StructField("right", T.IntegerType()),
    T.StructField("size", T.LongType()), T.StructField("depth", T.IntegerType()),
])


def _grow(pdf: pd.DataFrame, cols: list[str], seed: int, max_depth: int, psi: int) -> pd.DataFrame:
    tree = int(pdf["tree"].iloc[0])
    pdf = pdf.nsmallest(psi, ["hash", "row"])
    rng = np.random.default_rng([seed, tree])
    X = pdf[cols].to_numpy(dtype="float64")
    rows = []
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        node, idx, depth = stack.pop()
        sub = X[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        splittable = np.flatnonzero(hi > lo)
        if depth >= max_depth or len(idx) <= 1 or len(splittable) == 0:
            rows.append((tree, node, -1, 0.0, -1, -1, len(idx), depth))
            continue
        f = int(rng.choice(splittable))
        thr = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < thr
        l_id, r_id = next_id, next_id + 1
        next_id += 2
        rows.append((tree, node, f, thr, l_id, r_id, len(idx), depth))
        stack.append((l_id, idx[go_left], depth + 1))
        stack.append((r_id, idx[~go_left], depth + 1))
    return pd.DataFrame(rows, columns=[f.name for f in NODE_SCHEMA.fields])


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sample_per_tree(matrix: DataFrame, cols: list[str], id_col: str, trees: int, psi: int, seed: int,
                    bound: float) -> DataFrame:
    """(tree, hash, row, *cols): a superset of every tree's ψ rows with the smallest
    hashes, as far as these are below ``bound`` (a share of all hashes). ``row`` is a hash
    of the id that orders rows with equal tree hashes."""
    salts = _mix(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    below = np.uint64(min(int(bound * 2**64), 2**64 - 1))
    schema = T.StructType([T.StructField("tree", T.IntegerType()), T.StructField("hash", T.LongType()),
                           T.StructField("row", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in cols]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pd.DataFrame(columns=[f.name for f in schema.fields])
        for b in batches:
            row = b.column("row").to_numpy(zero_copy_only=False)
            h = _mix(row.view(np.uint64)[:, None] ^ salts)
            at, tree = np.nonzero(h <= below)
            new = pd.DataFrame({"tree": tree, "hash": (h[at, tree] >> np.uint64(1)).astype(np.int64), "row": row[at]}
                               | {c: b.column(c).to_numpy(zero_copy_only=False)[at] for c in cols})
            new = new if held.empty else pd.concat([held, new])
            held = new.sort_values(["tree", "hash", "row"]).groupby("tree").head(psi) if len(new) > trees * psi else new
        out = held.sort_values(["tree", "hash", "row"]).groupby("tree").head(psi) if len(held) else held
        yield pa.RecordBatch.from_pandas(out.astype({"tree": "int32", "hash": "int64", "row": "int64"} | {c: "float64" for c in cols}),
                                         preserve_index=False)

    rows = matrix.select(F.xxhash64(F.col(id_col).cast("string")).alias("row"), *[F.col(c).cast("double").alias(c) for c in cols])
    return rows.mapInArrow(run, schema)


def fit(matrix: DataFrame, cols: list[str] | None = None, id_col: str = "user_id_raiz",
        trees: int = C.IFOREST_TREES, max_samples: int = C.IFOREST_MAX_SAMPLES,
        seed: int = C.IFOREST_SEED, spare: float = 4.0) -> dict:
    """``spare``: how many times ψ rows of a tree are expected below the hash bound."""
    cols = cols or C.FEATURE_COLUMNS
    n = matrix.count()
    psi = min(max_samples, n)
    max_depth = int(math.ceil(math.log2(max(psi, 2))))
    for bound in (spare * psi / n, 1.0) if n > spare * psi else (1.0,):
        sample = sample_per_tree(matrix, cols, id_col, trees, psi, seed, bound)
        nodes = (sample.groupBy("tree")
                 .applyInPandas(lambda pdf: _grow(pdf, cols, seed, max_depth, psi), NODE_SCHEMA)
                 .collect())  # ≤ trees × (2ψ − 1) rows
        if sum(r["node"] == 0 and r["size"] == psi for r in nodes) == trees:
            break  # every tree has its ψ rows
    return {"cols": cols, "psi": psi, "trees": trees, "nodes": [tuple(r) for r in nodes]}


def _forest_arrays(model: dict):
    nodes = sorted(model["nodes"], key=lambda r: (r[0], r[1]))
    trees = model["trees"]
    width = max(r[1] for r in nodes) + 1
    feat = np.full((trees, width), -1, dtype=np.int64)
    thr = np.zeros((trees, width))
    left = np.full((trees, width), -1, dtype=np.int64)
    right = np.full((trees, width), -1, dtype=np.int64)
    size = np.zeros((trees, width))
    depth = np.zeros((trees, width))
    for t, node, f, th, l, r, s, dp in nodes:
        feat[t, node], thr[t, node], left[t, node], right[t, node] = f, th, l, r
        size[t, node], depth[t, node] = s, dp
    leaf_len = depth + avg_path(size)
    return feat, thr, left, right, leaf_len


def score_column(model: dict) -> F.Column:
    """Anomaly score s = 2^(−E[h]/c(ψ)) as an Arrow pandas UDF (higher = more anomalous)."""
    cols = model["cols"]
    psi = model["psi"]
    c_psi = float(avg_path([psi])[0]) or 1.0
    feat, thr, left, right, leaf_len = _forest_arrays(model)

    @F.pandas_udf(T.DoubleType())
    def iso_score(pdf: pd.DataFrame) -> pd.Series:
        X = pdf.to_numpy(dtype="float64")
        m = len(X)
        total = np.zeros(m)
        rows = np.arange(m)
        for t in range(feat.shape[0]):
            node = np.zeros(m, dtype=np.int64)
            while True:
                f = feat[t, node]
                inner = f >= 0
                if not inner.any():
                    break
                go_left = X[rows, np.where(inner, f, 0)] < thr[t, node]
                node = np.where(inner, np.where(go_left, left[t, node], right[t, node]), node)
            total += leaf_len[t, node]
        return pd.Series(np.power(2.0, -(total / feat.shape[0]) / c_psi))

    return iso_score(F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(cols)]))


def predict(matrix: DataFrame, model: dict, contamination: float = C.IFOREST_CONTAMINATION) -> tuple[DataFrame, float]:
    """Adds iso_score (decision function), iso_prediction (±1) and vote_iso."""
    if not (C.CONTAMINATION_MIN <= contamination <= C.CONTAMINATION_MAX):
        raise ValueError(f"contamination must be in {C.CONTAMINATION_MIN}..{C.CONTAMINATION_MAX}")
    scored = matrix.withColumn("_raw", -score_column(model))
    from ..session import checkpoint
    scored = checkpoint(scored)  # the UDF runs once; percentile and output reuse it
    offset = stats.exact_percentile(scored, "_raw", contamination)
    out = (scored.withColumn("iso_score", F.col("_raw") - F.lit(offset)).drop("_raw")
           .withColumn("iso_prediction", F.when(F.col("iso_score") < 0, F.lit(-1)).otherwise(F.lit(1)))
           .withColumn("vote_iso", (F.col("iso_prediction") == -1).cast("int")))
    return out, offset
