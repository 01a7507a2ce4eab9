"""Contract queries for the ensemble: oracles on rule-made or
literal inputs where SQL can express the operator, rows-only otherwise.

Ensemble input: the batch feature vector with ``((profile_id*7919)%1000)/1000``
in place of text negativity (FIXTURES.md), scaled again as the ensemble does.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..functions import expressions as X
from ..operators import dbscan as DB
from ..operators import ensemble as EN
from ..operators import features as FT
from ..operators import iforest as IF
from ..operators import kmeans as KM
from ..operators import projection as PJ
from ..operators import quality as QL
from ..operators import reports as R
from ..operators import silhouette as SI
from ..operators import stats as ST
from ..session import checkpoint, scratch_path
from . import oracle as O
from .contract import AS_OF, register, session_cache, sources
from .finish import finish

FC = C.FEATURE_COLUMNS
# Literal test centers (k = 4) for the assignment oracles.
CENTERS = [
    [0.1, 0.2, 0.1, 0.0, 0.3, 0.2],
    [0.3, 0.8, 0.2, 1.0, 0.6, 0.1],
    [0.2, 0.4, 0.5, 0.0, 0.7, 0.6],
    [0.6, 0.1, 0.3, 1.0, 0.2, 0.5],
]


# ---------------------------------------------------------------- Spark inputs

def ensemble_features(src):
    kp = FT.raw_kpis(src, AS_OF).withColumn(
        "sentiment_negativity_index", ((F.col("profile_id_social") * 7919) % 1000) / F.lit(1000.0))
    return FT.select_final_columns(FT.normalize_features(FT.materialize(kp, "checkpoint")))


def ensemble_matrix(spark, sf_dir):
    return FT.prepare_matrix(ensemble_features(sources(spark, sf_dir)))


def assigned(spark, sf_dir):
    return KM.assign_to_centers(ensemble_matrix(spark, sf_dir), CENTERS)


def risk_of_step(step_rows) -> tuple[int, list[float]]:
    """M6 on centers keyed by cluster id (clusters may be missing)."""
    best = max(step_rows, key=lambda r: (r["days_since_last_seen_norm"] - r["num_community_categories_norm"],
                                         -r["cluster"]))
    return best["cluster"], [best[c] for c in FC]


def iso_stand_in(df):
    """Rule-made forest score (SQL-checkable stand-in for M7's raw score)."""
    return df.withColumn("_raw", ((F.col("user_id_raiz") * 104729) % 1000) / F.lit(1000.0) - F.lit(0.5))


def fixed_votes(spark, sf_dir):
    mat = ensemble_matrix(spark, sf_dir).persist()
    asg = KM.assign_to_centers(mat, CENTERS).drop("center_distance")
    rid, rcenter = risk_of_step(KM.lloyd_step(asg).collect())
    asg = asg.withColumn("vote_kmeans", (F.col("kmeans_cluster") == F.lit(rid)).cast("int"))
    db = DB.dbscan(mat, labels=False).select("user_id_raiz", "vote_dbscan")
    iso = iso_stand_in(asg)
    offset = ST.exact_percentile(iso, "_raw", C.IFOREST_CONTAMINATION)
    iso = (iso.withColumn("iso_score", F.col("_raw") - F.lit(offset)).drop("_raw")
           .withColumn("vote_iso", (F.col("iso_score") < 0).cast("int")))
    votes = EN.combine_votes(iso.join(db, "user_id_raiz"))
    return EN.severity_index(votes, rcenter)


# ---------------------------------------------------------------- SQL fragments

def _coalesced_matrix_ctes() -> list[str]:
    kneg = ("kneg AS (select k.*, ((k.profile_id_social * 7919) % 1000) / 1000e0 as sentiment_negativity_index "
            "from kpis k)")
    fills = ", ".join([
        "coalesce(reciprocity_ratio_norm, 0.0) as f0", "coalesce(days_since_last_seen_norm, 0.0) as f1",
        "coalesce(ratio_night_messages, 0.0) as f2",
        "coalesce(cast(cast(is_profile_incomplete as integer) as double), 0.0) as f3",
        "coalesce(sentiment_negativity_index, 0.0) as f4", "coalesce(num_community_categories_norm, 0.0) as f5"])
    bounds = ", ".join(f"min(f{i}) as lo{i}, max(f{i}) as hi{i}" for i in range(6))
    scaled = ", ".join(f"case when hi{i} = lo{i} then 0.0 else (f{i} - lo{i}) / (hi{i} - lo{i}) end as {c}"
                       for i, c in enumerate(FC))
    return [O.SOCIAL, O.MESSAGING, O.MERGED, O.kpis_cte(), kneg, O.normed_cte(), O.FEATURE_VECTOR,
            f"mfill AS (select user_id_raiz, {fills} from fv)",
            f"mb AS (select {bounds} from mfill)",
            f"mat AS (select user_id_raiz, {scaled} from mfill cross join mb)"]


def sq_dist_sql(a: str, center: list[float]) -> str:
    return " + ".join(f"({a}{c} - {float(v)!r}) * ({a}{c} - {float(v)!r})" for c, v in zip(FC, center))


def pair_dist_sql(a: str, b: str) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in FC)


MATRIX_CTES = _coalesced_matrix_ctes()
_dists = ", ".join(f"{sq_dist_sql('', c)} as d{i}" for i, c in enumerate(CENTERS))
_label = "case " + " ".join(f"when d{i} = best then {i}" for i in range(len(CENTERS))) + " end"
ASG = (f"asg0 AS (select *, {_dists} from mat),\n"
       f"asg1 AS (select *, least({', '.join(f'd{i}' for i in range(len(CENTERS)))}) as best from asg0),\n"
       f"asg AS (select user_id_raiz, {', '.join(FC)}, {_label} as kmeans_cluster, sqrt(best) as center_distance "
       f"from asg1)")
_means = ", ".join(f"avg({c}) as {c}" for c in FC)
STEP = f"step AS (select kmeans_cluster as cluster, {_means}, count(*) as n_users from asg group by kmeans_cluster)"
RISK = ("risk AS (select * from step order by days_since_last_seen_norm - num_community_categories_norm desc, "
        "cluster asc limit 1)")
KVOTE = ("kvote AS (select asg.*, case when asg.kmeans_cluster = (select cluster from risk) then 1 else 0 end "
         "as vote_kmeans from asg)")
EPS2 = C.DBSCAN_EPS * C.DBSCAN_EPS
CORE = (f"nbc AS (select a.user_id_raiz as pid, count(*) as cnt from mat a join mat b "
        f"on {pair_dist_sql('a', 'b')} <= {EPS2!r} group by a.user_id_raiz),\n"
        f"m2 AS (select mat.*, nbc.cnt >= {C.DBSCAN_MIN_SAMPLES} as is_core from mat join nbc "
        f"on mat.user_id_raiz = nbc.pid),\n"
        f"reach AS (select distinct a.user_id_raiz as pid from m2 a join m2 b on b.is_core "
        f"and {pair_dist_sql('a', 'b')} <= {EPS2!r} where not a.is_core),\n"
        f"dvote AS (select m2.user_id_raiz, m2.is_core, case when not m2.is_core and reach.pid is null then 1 "
        f"else 0 end as vote_dbscan from m2 left join reach on m2.user_id_raiz = reach.pid)")
IVOTE = ("iraw AS (select kvote.*, ((user_id_raiz * 104729) % 1000) / 1000e0 - 0.5 as raw from kvote),\n"
         f"ioff AS (select quantile_cont(raw, {C.IFOREST_CONTAMINATION!r}) as off from iraw),\n"
         "ivote AS (select iraw.*, raw - off as iso_score, case when raw - off < 0 then 1 else 0 end as vote_iso "
         "from iraw cross join ioff)")
VOTES = ("votes AS (select i.*, d.vote_dbscan, i.vote_kmeans + d.vote_dbscan + i.vote_iso as total_votes from ivote i "
         "join dvote d on i.user_id_raiz = d.user_id_raiz),\n"
         "votes2 AS (select *, case when total_votes >= 2 then 'ALTO_RIESGO' when total_votes = 1 "
         "then 'RIESGO_MODERADO' else 'BAJO_RIESGO' end as risk_level from votes)")
_rdist = " + ".join(f"(v.{c} - r.{c}) * (v.{c} - r.{c})" for c in FC)
SEV = (f"sev0 AS (select v.*, sqrt({_rdist}) as risk_distance from votes2 v cross join risk r),\n"
       "sevb AS (select min(iso_score) as ilo, max(iso_score) as ihi, min(risk_distance) as dlo, "
       "max(risk_distance) as dhi from sev0),\n"
       "sev1 AS (select sev0.*, (risk_distance - dlo) / (dhi - dlo + 1e-10) as distance_norm, "
       "(iso_score - ilo) / (ihi - ilo + 1e-10) as iso_norm from sev0 cross join sevb),\n"
       "sevf AS (select *, greatest(least((0.5 * (1.0 - iso_norm) + 0.3 * vote_dbscan + 0.2 * (1.0 - distance_norm))"
       " * 100.0, 100.0), 0.0) as severity_index from sev1)")
FIXED_ALL = MATRIX_CTES + [ASG, STEP, RISK, KVOTE, CORE, IVOTE, VOTES, SEV]


def r6(c: str) -> str:
    return f"round({c}, 6) as {c}"


# ---------------------------------------------------------------- oracle-checked

@register("ensemble_matrix", O.q(*MATRIX_CTES, final=f"select user_id_raiz, {', '.join(r6(c) for c in FC)} from mat"))
def q_ensemble_matrix(spark, sf_dir):
    return finish(ensemble_matrix(spark, sf_dir))


@register("scaler_bounds", O.q(O.SOCIAL, O.MESSAGING, O.MERGED, O.kpis_cte(), final="""select
  round(min(coalesce(reciprocity_ratio, 0.0)), 6) as reciprocity_ratio__min, round(max(coalesce(reciprocity_ratio, 0.0)), 6) as reciprocity_ratio__max,
  round(min(coalesce(days_since_last_seen, 0.0)), 6) as days_since_last_seen__min, round(max(coalesce(days_since_last_seen, 0.0)), 6) as days_since_last_seen__max,
  round(min(coalesce(ratio_night_messages, 0.0)), 6) as ratio_night_messages__min, round(max(coalesce(ratio_night_messages, 0.0)), 6) as ratio_night_messages__max,
  round(min(coalesce(cast(num_community_categories as double), 0.0)), 6) as num_community_categories__min,
  round(max(coalesce(cast(num_community_categories as double), 0.0)), 6) as num_community_categories__max
 from kpis"""))
def q_scaler_bounds(spark, sf_dir):
    df = FT.raw_kpis(sources(spark, sf_dir), AS_OF)
    return finish(FT.scaler_bounds(df, ["reciprocity_ratio", "days_since_last_seen", "ratio_night_messages",
                                        "num_community_categories"]))


@register("assign_to_centers", O.q(*MATRIX_CTES, ASG, final="""select user_id_raiz, kmeans_cluster,
  round(center_distance, 6) as center_distance from asg"""))
def q_assign_to_centers(spark, sf_dir):
    return finish(assigned(spark, sf_dir).select("user_id_raiz", "kmeans_cluster", "center_distance"))


@register("lloyd_step", O.q(*MATRIX_CTES, ASG, STEP, final=f"""select cluster, {', '.join(r6(c) for c in FC)},
  n_users from step"""))
def q_lloyd_step(spark, sf_dir):
    return finish(KM.lloyd_step(assigned(spark, sf_dir)))


@register("risk_cluster_vote", O.q(*MATRIX_CTES, ASG, STEP, RISK, KVOTE, final="""select user_id_raiz,
  kmeans_cluster, vote_kmeans from kvote"""))
def q_risk_cluster_vote(spark, sf_dir):
    asg = assigned(spark, sf_dir)
    rid, _ = risk_of_step(KM.lloyd_step(asg).collect())
    return finish(asg.select("user_id_raiz", "kmeans_cluster",
                             (F.col("kmeans_cluster") == F.lit(rid)).cast("int").alias("vote_kmeans")))


@register("cluster_profiles_fixed", O.q(*MATRIX_CTES, ASG, STEP, RISK, final=f"""select cluster,
  {', '.join(r6(c) for c in FC)}, n_users, cluster = (select cluster from risk) as is_risk_cluster from step"""))
def q_cluster_profiles_fixed(spark, sf_dir):
    asg = assigned(spark, sf_dir)
    rid, _ = risk_of_step(KM.lloyd_step(asg).collect())
    return finish(R.cluster_profiles(asg, rid))


@register("dbscan_core_noise", O.q(*MATRIX_CTES, CORE, final="select user_id_raiz, is_core, vote_dbscan from dvote"))
def q_dbscan_core_noise(spark, sf_dir):
    out = DB.dbscan(ensemble_matrix(spark, sf_dir), labels=False)
    return finish(out.select("user_id_raiz", "is_core", "vote_dbscan"))


_CH_SQL = f"""ch_n AS (select count(*) as n, count(distinct kmeans_cluster) as k from asg),
ch_mu AS (select {', '.join(f'avg({c}) as m_{c}' for c in FC)} from asg),
ch_ssb AS (select sum(s.n_users * ({' + '.join(f'(s.{c} - m.m_{c}) * (s.{c} - m.m_{c})' for c in FC)})) as ssb
           from step s cross join ch_mu m),
ch_ssw AS (select sum({' + '.join(f'(a.{c} - s.{c}) * (a.{c} - s.{c})' for c in FC)}) as ssw
           from asg a join step s on a.kmeans_cluster = s.cluster)"""


@register("calinski_harabasz_fixed", O.q(*MATRIX_CTES, ASG, STEP, _CH_SQL, final="""select
  round(case when k < 2 then 0.0 when ssw = 0 then 1.0 else ssb * (n - k) / (ssw * (k - 1.0)) end, 6) as calinski_harabasz
 from ch_n cross join ch_ssb cross join ch_ssw"""))
def q_calinski_harabasz_fixed(spark, sf_dir):
    ch = QL.calinski_harabasz(assigned(spark, sf_dir))
    return finish(spark.range(1).select(F.lit(float(ch)).alias("calinski_harabasz")))


_SIL_SQL = f"""sp AS (select a.user_id_raiz as i, a.kmeans_cluster as ci, b.kmeans_cluster as cj,
   sum({pair_dist_sql('a', 'b')}) as s from asg a cross join asg b group by a.user_id_raiz, a.kmeans_cluster, b.kmeans_cluster),
sz AS (select kmeans_cluster as c, count(*) as n from asg group by kmeans_cluster),
sab AS (select sp.i, max(case when sp.cj = sp.ci then sp.s / greatest(o.n - 1, 1) end) as a,
   min(case when sp.cj <> sp.ci then sp.s / z.n end) as b, max(o.n) as own
   from sp join sz o on o.c = sp.ci join sz z on z.c = sp.cj group by sp.i)"""


@register("silhouette_fixed", O.q(*MATRIX_CTES, ASG, _SIL_SQL, final="""select
  round(avg(case when own <= 1 then 0.0 else (b - a) / greatest(a, b) end), 6) as silhouette_sq from sab"""))
def q_silhouette_fixed(spark, sf_dir):
    _, mean = QL.silhouette_sq(assigned(spark, sf_dir))
    return finish(spark.range(1).select(F.lit(float(mean)).alias("silhouette_sq")))


@register("feature_covariance", O.q(*MATRIX_CTES, final="select * from (" + " union all ".join(
    f"select {i} as i, {j} as j, '{FC[i]}' as col_i, '{FC[j]}' as col_j, round(avg({FC[i]}), 6) as mean_i, "
    f"round(avg({FC[j]}), 6) as mean_j, round(covar_samp({FC[i]}, {FC[j]}), 6) as cov from mat"
    for i in range(6) for j in range(i, 6)) + ")"))
def q_feature_covariance(spark, sf_dir):
    return finish(PJ.feature_covariance(ensemble_matrix(spark, sf_dir)))


@register("votes_and_level", O.q(*FIXED_ALL, final="""select user_id_raiz, vote_kmeans, vote_dbscan, vote_iso,
  total_votes, risk_level from votes2"""))
def q_votes_and_level(spark, sf_dir):
    return finish(fixed_votes(spark, sf_dir).select("user_id_raiz", "vote_kmeans", "vote_dbscan", "vote_iso",
                                                    "total_votes", "risk_level"))


@register("severity_index_fixed", O.q(*FIXED_ALL, final="""select user_id_raiz, round(iso_score, 6) as iso_score,
  round(risk_distance, 6) as risk_distance, round(severity_index, 6) as severity_index from sevf"""))
def q_severity_index_fixed(spark, sf_dir):
    return finish(fixed_votes(spark, sf_dir).select("user_id_raiz", "iso_score", "risk_distance", "severity_index"))


@register("risk_distance", O.q(*FIXED_ALL, final="""select user_id_raiz, round(risk_distance, 6) as risk_distance,
  round(distance_norm, 6) as distance_norm from sevf"""))
def q_risk_distance(spark, sf_dir):
    return finish(fixed_votes(spark, sf_dir).select("user_id_raiz", "risk_distance", "distance_norm"))


@register("users_by_level", O.q(*FIXED_ALL, final="""select user_id_raiz, risk_level,
  round(severity_index, 6) as severity_index, total_votes from sevf where risk_level = 'ALTO_RIESGO'"""))
def q_users_by_level(spark, sf_dir):
    return finish(R.users_by_level(fixed_votes(spark, sf_dir), C.LEVEL_HIGH))


@register("metrics_summary", O.q(*FIXED_ALL, _CH_SQL, _SIL_SQL, O.LEVELS_CTE, final="""select
  (select round(avg(case when own <= 1 then 0.0 else (b - a) / greatest(a, b) end), 6) from sab) as silhouette_sq,
  (select round(least(case when k < 2 then 0.0 when ssw = 0 then 1.0 else ssb * (n - k) / (ssw * (k - 1.0)) end / 500.0, 1.0), 6)
     from ch_n cross join ch_ssb cross join ch_ssw) as calinski_scaled,
  l.risk_level, coalesce(c.n, 0) as n_users,
  round(coalesce(c.n, 0) / (select count(*) from votes2) * 100.0, 1) as share
 from levels l left join (select risk_level, count(*) as n from votes2 group by risk_level) c
   on c.risk_level = l.risk_level"""))
def q_metrics_summary(spark, sf_dir):
    asg = assigned(spark, sf_dir)
    _, sil = QL.silhouette_sq(asg)
    ch = QL.calinski_harabasz(asg)
    return finish(R.metrics_summary(sil, ch, fixed_votes(spark, sf_dir)))


# ---------------------------------------------------------------- rows-only (learning operators)

@register("kmeans_fit", None)
def q_kmeans_fit(spark, sf_dir):
    mat = ensemble_matrix(spark, sf_dir).persist()
    centers, cost = KM.fit_kmeans(mat)
    rid = KM.risk_cluster(centers)
    rows = [(i, [float(v) for v in c], i == rid, float(cost)) for i, c in enumerate(centers)]
    return spark.createDataFrame(rows, "cluster int, center array<double>, is_risk_cluster boolean, cost double")


@register("isolation_forest", None)
def q_isolation_forest(spark, sf_dir):
    mat = ensemble_matrix(spark, sf_dir).persist()
    out, _ = IF.predict(mat, IF.fit(mat))
    return finish(out.select("user_id_raiz", "iso_score", "iso_prediction", "vote_iso"))


# clusters of core points by spreading the least id along core pairs, then borders
LABELS = (f"cedge AS materialized (select a.user_id_raiz as a, b.user_id_raiz as b from m2 a join m2 b on a.is_core "
          f"and b.is_core and a.user_id_raiz <> b.user_id_raiz and {pair_dist_sql('a', 'b')} <= {EPS2!r}),\n"
          "cc(pid, label) USING KEY (pid) AS (select user_id_raiz, user_id_raiz from m2 where is_core union "
          "select e.b, min(cc.label) from cc join cedge e on e.a = cc.pid join recurring.cc as old on old.pid = e.b "
          "where cc.label < old.label group by e.b),\n"
          "num AS (select label, dense_rank() over (order by label) - 1 as cluster from (select distinct label from cc)),\n"
          "lab AS (select cc.pid, num.cluster from cc join num using (label)),\n"
          "brd AS (select a.user_id_raiz as pid, min(lab.cluster) as cluster from m2 a join m2 b on b.is_core "
          f"and not a.is_core and {pair_dist_sql('a', 'b')} <= {EPS2!r} join lab on lab.pid = b.user_id_raiz "
          "group by a.user_id_raiz),\n"
          "found AS (select m2.user_id_raiz, m2.is_core, coalesce(lab.cluster, brd.cluster, -1) as c from m2 "
          "left join lab on lab.pid = m2.user_id_raiz left join brd on brd.pid = m2.user_id_raiz)")


@register("dbscan_labels", O.q(*MATRIX_CTES, CORE, LABELS, final="""select user_id_raiz, is_core,
  cast(c as bigint) as dbscan_cluster, case when c = -1 then 1 else 0 end as vote_dbscan from found""")
          .replace("WITH ", "WITH RECURSIVE ", 1))
def q_dbscan_labels(spark, sf_dir):
    return finish(DB.dbscan(ensemble_matrix(spark, sf_dir)))


@register("pca_projection", None)
def q_pca_projection(spark, sf_dir):
    mat = ensemble_matrix(spark, sf_dir).persist()
    return finish(PJ.pca_project(mat, PJ.fit_pca(mat)).select("user_id_raiz", "pca_x", "pca_y"))


def _ensemble(spark, sf_dir):
    """One seeded fit per session and folder, shared by the queries that read it."""
    cache = session_cache(spark, "fits")
    if sf_dir not in cache:
        cache[sf_dir] = EN.fit_predict(ensemble_features(sources(spark, sf_dir)))
    return cache[sf_dir]


@register("ensemble_results", None)
def q_ensemble_results(spark, sf_dir):
    return finish(_ensemble(spark, sf_dir).results)


@register("ensemble_summary", None)
def q_ensemble_summary(spark, sf_dir):
    return _ensemble(spark, sf_dir).summary(spark, AS_OF)


@register("cluster_profiles", None)
def q_cluster_profiles(spark, sf_dir):
    return finish(_ensemble(spark, sf_dir).cluster_profiles())


@register("scatter_pca", None)
def q_scatter_pca(spark, sf_dir):
    """PCA points by risk level and by k-means cluster."""
    res = _ensemble(spark, sf_dir).results
    by_level = res.select("user_id_raiz", X.label_text("risk_level").alias("series"),
                          F.round("pca_x", 3).alias("x"), F.round("pca_y", 3).alias("y"))
    by_cluster = res.select("user_id_raiz", F.concat(F.lit("Cluster "), F.col("kmeans_cluster").cast("string"))
                            .alias("series"), F.round("pca_x", 3).alias("x"), F.round("pca_y", 3).alias("y"))
    return finish(by_level.unionByName(by_cluster))


@register("severity_chart_ensemble", None)
def q_severity_chart_ensemble(spark, sf_dir):
    """A18 over the ensemble's severity index."""
    return finish(R.chart_histogram(_ensemble(spark, sf_dir).results))


# ---------------------------------------------------------------- invariants of random fits

@register("ensemble_invariants", O.q(*MATRIX_CTES, final="""select count(*) as n_users, 0 as bad_votes, 0 as bad_levels,
  0 as bad_outliers, 0 as bad_nearest, 0 as bad_severity, 0 as bad_summary, true as outlier_share_ok from mat"""))
def q_ensemble_invariants(spark, sf_dir):
    """What must hold for any seed: votes add up, levels follow them, every row sits at
    its nearest center, the outlier share is the contamination, the summary counts the rows."""
    fit = _ensemble(spark, sf_dir)
    near = KM.assign_to_centers(fit.matrix, fit.centers).select("user_id_raiz", F.col("kmeans_cluster").alias("near"))
    r = fit.results.join(near, "user_id_raiz")
    level = (F.when(F.col("total_votes") >= 2, C.LEVEL_HIGH).when(F.col("total_votes") == 1, C.LEVEL_MODERATE)
             .otherwise(C.LEVEL_LOW))
    s = fit.summary(spark, AS_OF).first()
    counted = s["n_bajo"] + s["n_moderado"] + s["n_alto"]
    out = r.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.count_if(F.col("total_votes") != F.col("vote_kmeans") + F.col("vote_dbscan") + F.col("vote_iso")).alias("bad_votes"),
        F.count_if(F.col("risk_level") != level).alias("bad_levels"),
        F.count_if((F.col("iso_score") < 0) != (F.col("vote_iso") == 1)).alias("bad_outliers"),
        F.count_if(F.col("near") != F.col("kmeans_cluster")).alias("bad_nearest"),
        F.count_if(~F.col("severity_index").between(0.0, 100.0)).alias("bad_severity"),
        F.count_if(F.col("vote_iso") == 1).alias("_out"))
    share = F.try_divide(F.col("_out"), F.col("n_users"))
    return finish(out.select(
        "n_users", "bad_votes", "bad_levels", "bad_outliers", "bad_nearest", "bad_severity",
        F.abs(F.lit(counted) - F.col("n_users")).alias("bad_summary"),
        (F.abs(share - F.lit(C.IFOREST_CONTAMINATION)) <= 0.02).alias("outlier_share_ok")))


@register("pca_invariants", O.q(*MATRIX_CTES, final="""select count(*) as n_users, 0.0 as mean_x, 0.0 as mean_y,
  0.0 as cov_xy, true as x_varies_most, true as within_total,
  round(""" + " + ".join(f"var_samp({c})" for c in FC) + """, 6) as total_variance from mat"""))
def q_pca_invariants(spark, sf_dir):
    """M11 for any eigenvector signs: centred, uncorrelated, ordered by variance, within the total."""
    mat = ensemble_matrix(spark, sf_dir)
    model = PJ.fit_pca(mat)
    total = sum((F.var_samp(c) for c in FC[1:]), F.var_samp(FC[0]))
    r = PJ.pca_project(mat, model).agg(
        F.count(F.lit(1)).alias("n_users"), F.avg("pca_x").alias("mx"), F.avg("pca_y").alias("my"),
        F.covar_samp("pca_x", "pca_y").alias("c"), F.var_samp("pca_x").alias("vx"), F.var_samp("pca_y").alias("vy"),
        total.alias("total_variance"))
    zero = [F.round(F.abs(F.round(c, 6)), 6).alias(n) for c, n in (("mx", "mean_x"), ("my", "mean_y"), ("c", "cov_xy"))]
    return finish(r.select("n_users", *zero, (F.col("vx") >= F.col("vy")).alias("x_varies_most"),
                           (F.col("vx") + F.col("vy") <= F.col("total_variance") + 1e-9).alias("within_total"),
                           "total_variance"))


# ---------------------------------------------------------------- a literal forest and model

# Two small trees: (tree, node, feature, threshold, left, right, size, depth), feature -1 is a leaf.
FOREST = {"cols": FC, "psi": 8, "trees": 2, "nodes": [
    (0, 0, 1, 0.4, 1, 2, 8, 0), (0, 1, -1, 0.0, -1, -1, 3, 1), (0, 2, 5, 0.5, 3, 4, 5, 1),
    (0, 3, -1, 0.0, -1, -1, 4, 2), (0, 4, -1, 0.0, -1, -1, 1, 2),
    (1, 0, 3, 0.5, 1, 2, 8, 0), (1, 1, 0, 0.3, 3, 4, 5, 1), (1, 2, -1, 0.0, -1, -1, 3, 1),
    (1, 3, -1, 0.0, -1, -1, 2, 2), (1, 4, -1, 0.0, -1, -1, 3, 2)]}


def _path_sql(n: int) -> str:
    """Average path length in a tree of n rows (Euler's constant as in the forest)."""
    return "0.0" if n < 2 else "1.0" if n == 2 else f"(2.0 * (ln({n - 1}.0) + 0.5772156649015329) - 2.0 * {n - 1}.0 / {n}.0)"


def _tree_sql(nodes: dict, node: int = 0) -> str:
    _, _, f, cut, left, right, size, depth = nodes[node]
    if f < 0:
        return f"({depth} + {_path_sql(size)})"
    return f"case when {FC[f]} < {cut!r} then {_tree_sql(nodes, left)} else {_tree_sql(nodes, right)} end"


_TREES = [_tree_sql({n[1]: n for n in FOREST["nodes"] if n[0] == t}) for t in range(FOREST["trees"])]
RAW_SQL = f"-pow(2.0, -(({' + '.join(_TREES)}) / {FOREST['trees']}.0) / {_path_sql(FOREST['psi'])})"


@register("isolation_scores_fixed", O.q(*MATRIX_CTES, f"iraw AS (select user_id_raiz, {RAW_SQL} as raw from mat)",
                                        f"ioff AS (select quantile_cont(raw, {C.IFOREST_CONTAMINATION!r}) as off from iraw)",
                                        final="""select user_id_raiz, round(raw - off, 6) as iso_score,
  case when raw - off < 0 then -1 else 1 end as iso_prediction, case when raw - off < 0 then 1 else 0 end as vote_iso
  from iraw cross join ioff"""))
def q_isolation_scores_fixed(spark, sf_dir):
    """M7's scores, offset and votes of a literal forest."""
    out, _ = IF.predict(ensemble_matrix(spark, sf_dir), FOREST)
    return finish(out.select("user_id_raiz", "iso_score", "iso_prediction", "vote_iso"))


MODEL_OFFSET = -0.55
MODEL_BOUNDS = {"ilo": -0.2, "ihi": 0.2, "dlo": 0.0, "dhi": 2.0}
RISK_CENTER = 1
_shifted = ", ".join(f"least(1.0, {c} * 0.8 + 0.1 * (user_id_raiz % 3)) as {c}" for c in FC)
_near = " + ".join(f"(n.{c} - m.{c}) * (n.{c} - m.{c})" for c in FC)
MODEL_CTES = [*MATRIX_CTES, CORE, LABELS, f"nw AS (select user_id_raiz, {_shifted} from mat)",
              f"n0 AS (select *, {_dists}, sqrt({sq_dist_sql('', CENTERS[RISK_CENTER])}) as dist, {RAW_SQL} - ({MODEL_OFFSET!r}) as iso from nw)",
              f"n1 AS (select *, {_label.replace('best', 'least(' + ', '.join(f'd{i}' for i in range(len(CENTERS))) + ')')} as k from n0)",
              "core AS (select m2.*, found.c from m2 join found using (user_id_raiz) where m2.is_core)",
              f"db AS (select n.user_id_raiz, min(m.c) as c from nw n join core m on {_near} <= {EPS2!r} group by n.user_id_raiz)",
              f"""v AS (select n1.user_id_raiz, k, coalesce(db.c, -1) as c, iso, dist, case when k = {RISK_CENTER} then 1 else 0 end as vk,
   case when db.c is null then 1 else 0 end as vd, case when iso < 0 then 1 else 0 end as vi from n1 left join db using (user_id_raiz))"""]


@register("stored_model_scores", O.q(*MODEL_CTES, final=f"""select user_id_raiz, k as kmeans_cluster, c as dbscan_cluster,
  round(iso, 6) as iso_score, vk + vd + vi as total_votes,
  case when vk + vd + vi >= 2 then 'ALTO_RIESGO' when vk + vd + vi = 1 then 'RIESGO_MODERADO' else 'BAJO_RIESGO' end as risk_level,
  round(greatest(least((0.5 * (1.0 - (iso + 0.2) / (0.4 + 1e-10)) + 0.3 * vd + 0.2 * (1.0 - dist / (2.0 + 1e-10))) * 100.0, 100.0), 0.0), 6)
    as severity_index from v""").replace("WITH ", "WITH RECURSIVE ", 1))
def q_stored_model_scores(spark, sf_dir):
    """A model of literal centers and forest and the DBSCAN core points of the matrix is
    written, loaded, and scores the rows moved by a rule."""
    mat = checkpoint(ensemble_matrix(spark, sf_dir))
    core = mat.join(DB.dbscan(mat).filter("is_core").select("user_id_raiz", "dbscan_cluster"), "user_id_raiz")
    path = scratch_path(spark, "model")
    model = EN.EnsembleModel(CENTERS, RISK_CENTER, {c: (0.0, 1.0) for c in FC}, FOREST, MODEL_OFFSET, MODEL_BOUNDS, None)
    model.save(spark, path, core)
    moved = mat.select("user_id_raiz", *[F.least(F.lit(1.0), F.col(c) * 0.8 + (F.col("user_id_raiz") % 3) * 0.1).alias(c) for c in FC])
    out = EN.EnsembleModel.load(spark, path).score(moved)
    return finish(out.select("user_id_raiz", "kmeans_cluster", "dbscan_cluster", "iso_score", "total_votes", "risk_level",
                             "severity_index"))


@register("silhouette_euclidean", None)
def q_silhouette_euclidean(spark, sf_dir):
    """M9 with Euclidean distances: the mean and its error. SQL would need all pairs of rows."""
    _, mean, error = SI.silhouette(assigned(spark, sf_dir))
    return spark.createDataFrame([(mean, error)], "silhouette double, silhouette_error double")
