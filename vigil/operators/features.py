"""Feature operators: J5, M1, M2, M3, J6, P8–P11.

No Python per row: every KPI is a Column expression. Scaling needs one
global min/max row (A7), fetched once to the driver as literals.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import expressions as X
from ..sources import extract
from ..sources.tables import SourceTables


def materialize(df: DataFrame, how: str | None) -> DataFrame:
    """Reuse an intermediate: ``cache`` (recomputed from lineage if an
    executor is lost) or ``checkpoint`` (written to spark.checkpoint.dir,
    lineage cut). ``None`` keeps it lazy."""
    if how == "cache":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        from ..session import checkpoint
        return checkpoint(df)
    return df


def merge_datasets(social: DataFrame, messaging: DataFrame) -> DataFrame:
    """Social ⟕ messaging on profile id."""
    return social.join(messaging, social["profile_id_social"] == messaging["profile_id"], "left")


def calculate_kpis(df: DataFrame, as_of: str) -> DataFrame:
    """M1: KPIs 1–4."""
    return df.withColumns({
        "reciprocity_ratio": X.guarded_ratio("following_count", "followers_count"),
        "days_since_last_seen": X.days_between("last_seen_at", as_of),
        "ratio_night_messages": X.guarded_ratio("night_messages", "total_messages"),
        "is_profile_incomplete": X.null_true_and("profile_bio_missing", "complete_profile_missing"),
    })


def scaler_bounds(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with min/max of each column after the null/NaN → 0 fill."""
    aggs = []
    for c in cols:
        v = X.fill_zero(c)
        aggs += [F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max")]
    return df.agg(*aggs)


def fit_minmax(df: DataFrame, cols: list[str]) -> dict[str, tuple[float | None, float | None]]:
    """A7 as driver literals: a global aggregate has exactly one row."""
    if not cols:
        return {}
    row = scaler_bounds(df, cols).first()
    return {c: (row[f"{c}__min"], row[f"{c}__max"]) for c in cols}


def apply_minmax(df: DataFrame, bounds: dict[str, tuple], eps: float = 0.0) -> DataFrame:
    """M2 transform: fill 0, then (x-min)/(max-min); constant column → 0 (Q6)."""
    exprs = {}
    for c, (lo, hi) in bounds.items():
        if lo is None:  # empty input: no rows to scale
            exprs[c] = X.fill_zero(c)
        else:
            exprs[c] = X.minmax(X.fill_zero(c), float(lo), float(hi), eps)
    return df.withColumns(exprs)


def normalize_features(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """M2 + P9 + P6: scale the columns that exist, then rename to *_norm."""
    cols = cols or C.SCALED_RAW_COLUMNS
    present = [c for c in cols if c in df.columns]
    out = apply_minmax(df, fit_minmax(df, present))
    return out.withColumnsRenamed({k: v for k, v in C.RENAMES.items() if k in out.columns})


def select_final_columns(df: DataFrame) -> DataFrame:
    """Final vector in fixed order; missing columns get typed defaults."""
    sel = []
    for c in C.FINAL_COLUMNS:
        if c == "int_gaming_one_hot" and c not in df.columns:
            sel.append(F.lit(False).alias(c))
        elif c in df.columns:
            sel.append(F.col(c))
        elif "norm" in c or "ratio" in c or "index" in c:
            sel.append(F.lit(0.0).alias(c))
        else:
            sel.append(F.lit(False).alias(c))
    return df.select(*sel)


def raw_kpis(src: SourceTables, as_of: str) -> DataFrame:
    """S1 ⟕ S2 (J5) → M1."""
    return calculate_kpis(merge_datasets(extract.social_metrics(src), extract.messaging_metrics(src)), as_of)


def run_transformation(src: SourceTables, as_of: str, skip_nlp: bool = False,
                       scorer=None, resolve_ids: bool = True,
                       negativity: DataFrame | None = None,
                       materialize_kpis: str | None = "checkpoint") -> DataFrame:
    """M3: extract → KPIs → (M17) → M2 → P8.

    The KPI frame is read twice (global min/max, then the scaled output), so
    it is materialized once (default: reliable checkpoint) instead of
    re-running every extract join for each pass.

    ``negativity`` may be given directly as (user_id, sentiment_negativity_index);
    otherwise it is computed with ``scorer`` unless ``skip_nlp``.
    """
    from . import sentiment

    df = raw_kpis(src, as_of)
    if negativity is None and not skip_nlp:
        negativity = sentiment.negativity_index(src, scorer=scorer, resolve_ids=resolve_ids)
    if negativity is not None:
        df = sentiment.join_negativity(df, negativity)
    else:
        df = df.withColumn("sentiment_negativity_index", F.lit(0.0))
    df = materialize(df, materialize_kpis)
    return select_final_columns(normalize_features(df))


def prepare_matrix(df: DataFrame, id_col: str = "user_id_raiz",
                   cols: list[str] | None = None) -> DataFrame:
    """P10 + P11 + P7 + Q8: required-column check, bool→int, fill 0, MinMax again."""
    return prepare_matrix_fit(df, id_col, cols)[0]


def matrix_columns(df: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """P11 + P7: booleans as 0/1, nulls and NaN as 0."""
    types = dict(df.dtypes)
    return df.select(F.col(id_col), *[X.fill_zero(F.col(c).cast("int")).alias(c)
                                      if types[c] == "boolean" else X.fill_zero(c).alias(c)
                                      for c in cols])


def prepare_matrix_fit(df: DataFrame, id_col: str = "user_id_raiz",
                       cols: list[str] | None = None) -> tuple[DataFrame, dict]:
    """``prepare_matrix`` that also returns the fitted MinMax bounds (for scoring new rows)."""
    cols = cols or C.FEATURE_COLUMNS
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    x = matrix_columns(df, id_col, cols)
    bounds = fit_minmax(x, cols)
    return apply_minmax(x, bounds), bounds
