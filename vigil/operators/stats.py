"""Distributed exact statistics with bounded driver memory."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024


def kth_smallest(df: DataFrame, col: str, k: int, n: int | None = None) -> float:
    """Exact k-th smallest value (0-based) by bucket refinement.

    Each pass is one grouped count over ≤ ``BUCKETS`` buckets of the current
    range; the bucket holding rank ``k`` becomes the next range, shrunk to the
    values in it, until it holds one value. No pass moves more than a bucket
    histogram to the driver, at any input size.
    """
    base = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    all_rows = base.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not 0 <= k < (all_rows["n"] if n is None else n):
        raise ValueError("rank out of range")
    lo, hi, below = all_rows["lo"], all_rows["hi"], 0  # below: rows under the range
    while lo < hi:
        width = (hi - lo) / BUCKETS
        b = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit(width)), F.lit(BUCKETS - 1)) if width > 0 else F.lit(0)
        if width == 0 or lo + width == lo:  # neighbouring doubles: halve by value
            b = (F.col("v") > F.lit(lo)).cast("int")
        parts = (base.filter(F.col("v").between(lo, hi)).groupBy(b.alias("b"))
                 .agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        for r in sorted(parts, key=lambda r: r["lo"]):
            if below + r["c"] > k:
                lo, hi = r["lo"], r["hi"]
                break
            below += r["c"]
    return float(lo)


def exact_percentile(df: DataFrame, col: str, q: float) -> float:
    """numpy ``percentile`` (linear interpolation) of a column, computed exactly.
    The upper neighbour comes from one aggregate over the rows above the lower one."""
    n = df.filter(F.col(col).isNotNull()).count()
    if n == 0:
        return float("nan")
    pos = q * (n - 1)
    lo_k = math.floor(pos)
    a = kth_smallest(df, col, lo_k, n)
    if lo_k == pos:
        return a
    v = F.col(col).cast("double")
    row = df.agg(F.count_if(v <= a).alias("upto"), F.min(F.when(v > a, v)).alias("next")).first()
    b = a if row["upto"] > lo_k + 1 else row["next"]
    return a + (b - a) * (pos - lo_k)
