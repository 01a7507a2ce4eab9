"""Report operators: A8–A20, O1–O3, P13–P16, M18, T5.

Zero-filled reports (three levels, five or twenty bins) are one global
aggregation with a ``count_if`` per slot, exploded into rows: one pass,
partial aggregation on every partition, no join against a level table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import expressions as X


# ---------------------------------------------------------------- T5

def heuristic_risk(df: DataFrame) -> DataFrame:
    """T5: weighted KPI score, level by cut-offs, severity = score × 100."""
    score = X.heuristic_score("days_since_last_seen_norm", "ratio_night_messages",
                              "is_profile_incomplete", "sentiment_negativity_index",
                              "num_community_categories_norm")
    return (df.withColumn("risk_score", score)
            .withColumn("risk_level", X.level_from_score("risk_score"))
            .withColumn("severity_index", F.col("risk_score") * F.lit(100.0)))


def labelled(df: DataFrame, label: str = "cluster_label") -> DataFrame:
    """P13."""
    return df.filter(F.col(label).isNotNull())


def _explode_slots(agg_row: DataFrame, slots: list[tuple]) -> DataFrame:
    """Turn one aggregate row with columns c0..cn into one row per slot."""
    structs = [F.struct(*[F.lit(v).alias(k) for k, v in meta.items()], F.col(cname).alias("n"))
               for cname, meta in slots]
    return agg_row.select(F.inline(F.array(*structs)), *[c for c in agg_row.columns if c.startswith("_keep_")])


# ---------------------------------------------------------------- A8, A9, A12, A17, A19

def risk_counts(df: DataFrame, level: str = "risk_level") -> DataFrame:
    """Rows per level."""
    return df.groupBy(F.col(level).alias("risk_level")).agg(F.count(F.lit(1)).alias("n_users"))


def risk_totals(df: DataFrame, level: str = "risk_level") -> DataFrame:
    """Total rows and high-risk share (%)."""
    return df.agg(F.count(F.lit(1)).alias("total_users"),
                  (F.avg(F.when(F.col(level) == C.LEVEL_HIGH, 1.0).otherwise(0.0)) * 100.0)
                  .alias("high_risk_percentage"))


def risk_distribution(df: DataFrame, level: str = "cluster_label") -> DataFrame:
    """A12 + O3 + F12: three fixed levels zero-filled, total of all labels, high-risk % (1 dp)."""
    lv = F.col(level)
    row = df.agg(*[F.count_if(lv == name).alias(f"c{i}") for i, name in enumerate(C.LEVELS)],
                 F.count(lv).alias("_keep_total"), F.count_if(lv == C.LEVEL_HIGH).alias("_keep_high"))
    slots = [(f"c{i}", {"risk_level": name, "label": name.replace("_", " "), "ordinal": i})
             for i, name in enumerate(C.LEVELS)]
    out = _explode_slots(row, slots)
    high = F.col("_keep_high")
    return out.select(
        "risk_level", "label", "ordinal", F.col("n").alias("n_users"),
        F.col("_keep_total").alias("total_users"),
        F.when(F.col("_keep_total") > 0,
               F.round(high / F.col("_keep_total") * 100.0, 1)).otherwise(F.lit(0.0))
        .alias("high_risk_percentage"))


def distribution_message(df: DataFrame, level: str = "risk_level") -> DataFrame:
    """Per present level, count and share (1 dp); 0 when the total is 0."""
    counts = risk_counts(df, level)
    total = F.sum("n_users").over(Window.partitionBy())
    return (counts.withColumn("total_users", total)
            .withColumn("percentage", F.when(F.col("total_users") > 0,
                                             F.round(F.col("n_users") / F.col("total_users") * 100.0, 1))
                        .otherwise(F.lit(0.0)))
            .withColumn("type", F.lit(C.MSG_DISTRIBUTION_UPDATE)))


def distribution_update(df: DataFrame, level: str = "risk_level") -> DataFrame:
    """A17 as the one message: counts and shares per level as two maps, and the JSON body."""
    rows = distribution_message(df, level)
    entry = F.sort_array(F.collect_list(F.struct("risk_level", "n_users", "percentage")))
    out = rows.agg(entry.alias("_e"), F.coalesce(F.max("total_users"), F.lit(0)).alias("total_users"))
    out = out.select(
        F.lit(C.MSG_DISTRIBUTION_UPDATE).alias("type"), "total_users",
        F.map_from_entries(F.transform("_e", lambda e: F.struct(e["risk_level"], e["n_users"]))).alias("distribution"),
        F.map_from_entries(F.transform("_e", lambda e: F.struct(e["risk_level"], e["percentage"]))).alias("percentages"))
    payload = F.struct("distribution", "percentages", "total_users")
    return out.withColumn("body", F.to_json(F.struct("type", payload.alias("payload"))))


def distribution_bars(df: DataFrame, level: str = "risk_level") -> DataFrame:
    """Three bars with count and % of all rows (1 dp)."""
    lv = F.col(level)
    row = df.agg(*[F.count_if(lv == name).alias(f"c{i}") for i, name in enumerate(C.LEVELS)],
                 F.count(F.lit(1)).alias("_keep_rows"))
    slots = [(f"c{i}", {"risk_level": name, "label": name.replace("_", " "), "ordinal": i})
             for i, name in enumerate(C.LEVELS)]
    out = _explode_slots(row, slots)
    return out.select("risk_level", "label", "ordinal", F.col("n").alias("n_users"),
                      F.when(F.col("_keep_rows") > 0, F.round(F.col("n") / F.col("_keep_rows") * 100.0, 1))
                      .otherwise(F.lit(0.0)).alias("share"))


# ---------------------------------------------------------------- A13

def radar_by_level(df: DataFrame, level: str = "cluster_label", digits: int = 3) -> DataFrame:
    """Per level, mean of the six KPIs (boolean as 0/1), rounded."""
    def r(c):
        return F.round(F.avg(c), digits)
    return (labelled(df, level).groupBy(F.col(level).alias("risk_level"))
            .agg(r("reciprocity_ratio_norm").alias("reciprocity"),
                 r("days_since_last_seen_norm").alias("inactivity"),
                 r("ratio_night_messages").alias("night_messages"),
                 r(F.when(F.col("is_profile_incomplete"), 1.0).otherwise(0.0)).alias("profile_incomplete"),
                 r("sentiment_negativity_index").alias("negativity"),
                 r("num_community_categories_norm").alias("community")))


# ---------------------------------------------------------------- A14, A15, A18

def report_severity(df: DataFrame) -> DataFrame:
    """F9 with the profile term, ×100, over labelled rows."""
    return (labelled(df).withColumn("severity_index", X.heuristic_score(
        "days_since_last_seen_norm", "ratio_night_messages", "is_profile_incomplete",
        "sentiment_negativity_index", "num_community_categories_norm") * F.lit(100.0)))


def severity_histogram(df: DataFrame, sev: str = "severity_index") -> DataFrame:
    """Bins (0,20] … (80,100]; 0 and out-of-range values fall in none."""
    s = F.col(sev)
    b = C.SEVERITY_BINS
    row = df.agg(*[F.count_if((s > b[i]) & (s <= b[i + 1])).alias(f"c{i}") for i in range(len(b) - 1)])
    slots = [(f"c{i}", {"bin": C.SEVERITY_BIN_LABELS[i], "ordinal": i}) for i in range(len(b) - 1)]
    return _explode_slots(row, slots).withColumnRenamed("n", "n_users")


def severity_summary(df: DataFrame, sev: str = "severity_index") -> DataFrame:
    """Mean and max (1 dp), % of rows ≥ 60 (1 dp)."""
    s = F.col(sev)
    return df.agg(F.round(F.avg(s), 1).alias("mean_severity"),
                  F.round(F.max(s), 1).alias("max_severity"),
                  F.when(F.count(F.lit(1)) > 0, F.round(
                      F.try_divide(F.count_if(s >= C.SEVERITY_HIGH_MARK), F.count(F.lit(1))) * 100.0, 1))
                  .otherwise(F.lit(0.0)).alias("above_60_percent"))


def chart_histogram(df: DataFrame, sev: str = "severity_index", bins: int = C.CHART_BINS) -> DataFrame:
    """Equal-width bins over [min, max] (constant input widened by ±0.5),
    band by left edge (<30 low, <60 moderate, else high). Zero-filled.

    Bin rule of the reference's histogram library: edge_i = i·step + min
    (last edge = max), index = trunc((x − min)/(max − min)·bins), then moved
    down one when x < edge_index and up one when x ≥ edge_(index+1) (not for
    the last bin).
    """
    s = F.col(sev)
    bounds = df.agg(F.min(s).alias("lo"), F.max(s).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    if lo is None:
        lo, hi = 0.0, 1.0
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins

    def edge(i):
        return F.when(i == bins, F.lit(float(hi))).otherwise(i.cast("double") * F.lit(step) + F.lit(float(lo)))

    i0 = F.floor((s - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(bins))).cast("int")
    i0 = F.when(i0 == bins, F.lit(bins - 1)).otherwise(i0)
    i1 = F.when(s < edge(i0), i0 - 1).otherwise(i0)
    idx = F.when((s >= edge(i1 + 1)) & (i1 != bins - 1), i1 + 1).otherwise(i1)
    row = df.agg(*[F.count_if(idx == i).alias(f"c{i}") for i in range(bins)])
    slots = []
    for i in range(bins):
        left = i * step + lo
        band = (C.LEVEL_LOW if left < C.CHART_BAND_LOW else
                C.LEVEL_MODERATE if left < C.CHART_BAND_HIGH else C.LEVEL_HIGH)
        slots.append((f"c{i}", {"bin": i, "left_edge": float(left), "band": band}))
    return _explode_slots(row, slots).withColumnRenamed("n", "n_users")


# ---------------------------------------------------------------- A16, O1

def kpi_trends(df: DataFrame, as_of: str, hours: int = C.TREND_HOURS_DEFAULT) -> DataFrame:
    """A16 + P14 + O1: hourly means of three KPIs over the last ``hours``. Of a table
    partitioned by ``extraction_day`` only the days since the cutoff are read."""
    if not (C.TREND_HOURS_MIN <= hours <= C.TREND_HOURS_MAX):
        raise ValueError(f"hours must be in {C.TREND_HOURS_MIN}..{C.TREND_HOURS_MAX}")
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(hours))
    bucket = F.date_trunc("hour", F.col("extraction_date").cast("timestamp"))
    if "extraction_day" in df.columns:
        df = df.filter(F.col("extraction_day") >= F.to_date(cutoff))

    def r(c):
        return F.round(F.coalesce(F.avg(c), F.lit(0.0)), 3)
    return (df.filter(F.col("extraction_date").cast("timestamp") >= cutoff)
            .groupBy(bucket.alias("bucket"))
            .agg(r("days_since_last_seen_norm").alias("avg_inactivity"),
                 r("sentiment_negativity_index").alias("avg_negativity"),
                 r("ratio_night_messages").alias("avg_night_ratio"),
                 F.count(F.lit(1)).alias("user_count"))
            .select(X.ts_text("bucket").alias("time_bucket"),
                    F.date_format("bucket", "HH:mm").alias("label"),
                    "avg_inactivity", "avg_negativity", "avg_night_ratio", "user_count")
            .orderBy("time_bucket"))


# ---------------------------------------------------------------- O2, P15

def high_risk_users(df: DataFrame, limit: int = C.TOPK_DEFAULT) -> DataFrame:
    """O2: top-k high-risk rows by inactivity, then negativity (nulls first, Q14);
    severity without the profile term (Q12); factors ×100, 1 dp."""
    if not (C.TOPK_MIN <= limit <= C.TOPK_MAX):
        raise ValueError(f"limit must be in {C.TOPK_MIN}..{C.TOPK_MAX}")
    d, n, c, g = (F.col("days_since_last_seen_norm"), F.col("ratio_night_messages"),
                  F.col("sentiment_negativity_index"), F.col("num_community_categories_norm"))
    sev = (d * C.HEUR_W_DAYS + n * C.HEUR_W_NIGHT + c * C.HEUR_W_NEGATIVITY
           + (F.lit(1.0) - g) * C.HEUR_W_COMMUNITY) * F.lit(100.0)
    top = (df.filter(F.col("cluster_label") == C.LEVEL_HIGH)
           .orderBy(d.desc_nulls_first(), c.desc_nulls_first(), F.col("user_id_raiz").asc())
           .limit(limit))
    return top.select(
        F.col("user_id_raiz").cast("string").alias("user_id"),
        F.col("cluster_label").alias("risk_level"),
        F.round(sev, 1).alias("severity_index"),
        F.round(d * 100.0, 1).alias("inactivity"),
        F.round(n * 100.0, 1).alias("night_activity"),
        F.round(c * 100.0, 1).alias("negativity"),
        F.round(g * 100.0, 1).alias("community_engagement"),
        F.date_format(F.col("extraction_date"), "yyyy-MM-dd'T'HH:mm:ss").alias("last_updated"))


# ---------------------------------------------------------------- P16, M18, A10, A11, A20

def users_by_level(results: DataFrame, level: str) -> DataFrame:
    """Rows of one level, four columns; unknown level raises."""
    if level not in C.LEVELS:
        raise ValueError(f"unknown risk level {level!r}; use one of {C.LEVELS}")
    return (results.filter(F.col("risk_level") == level)
            .select("user_id_raiz", "risk_level", "severity_index", "total_votes"))


def scatter_series(df: DataFrame, series: str = "cluster_label", x: str = "reciprocity_ratio_norm",
                   y: str = "days_since_last_seen_norm", digits: int = 3) -> DataFrame:
    """Labelled points with series name and rounded coordinates."""
    return (df.filter(F.col(series).isNotNull())
            .select(F.col("user_id_raiz"), X.label_text(F.col(series).cast("string")).alias("series"),
                    F.round(F.col(x), digits).alias("x"), F.round(F.col(y), digits).alias("y")))


def feature_count(df: DataFrame) -> DataFrame:
    """A11."""
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def cluster_profiles(matrix: DataFrame, risk_cluster: int | None,
                     cluster: str = "kmeans_cluster") -> DataFrame:
    """A10: mean of each scaled feature per non-empty cluster, count, risk flag."""
    return (matrix.groupBy(F.col(cluster).alias("cluster"))
            .agg(*[F.avg(c).alias(c) for c in C.FEATURE_COLUMNS], F.count(F.lit(1)).alias("n_users"))
            .withColumn("is_risk_cluster",
                        F.coalesce(F.col("cluster") == F.lit(risk_cluster), F.lit(False))))


def metrics_summary(silhouette_sq: float, calinski: float, results: DataFrame) -> DataFrame:
    """Chart values — silhouette over squared distances, min(CH/500, 1), and level shares."""
    shares = distribution_bars(results)
    return shares.select(F.lit(float(silhouette_sq)).alias("silhouette_sq"),
                         F.lit(min(calinski / C.CH_CHART_SCALE, 1.0)).alias("calinski_scaled"),
                         "risk_level", "n_users", "share")
