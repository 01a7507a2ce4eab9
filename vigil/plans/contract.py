"""Contract queries: name → (Spark callable, oracle SQL or None).

Each callable takes (spark, sf_dir), builds the fixture sources over the
driver's tables and returns a lazy DataFrame (actions only where an
operator needs a driver literal: scaler bounds, k ≤ 10 centers, PCA).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures
from ..operators import features as FT
from ..operators import reports as R
from ..operators import sentiment as S
from ..operators import sinks as K
from ..session import scratch_path
from ..sources import extract as E
from ..sources.tables import SourceTables
from . import oracle as O
from .finish import finish

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

AS_OF = fixtures.BATCH_AS_OF
REPORT_AS_OF = fixtures.REPORT_AS_OF


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def session_cache(spark: SparkSession, name: str) -> dict:
    """A dict that lives as long as the session object itself."""
    caches = spark.__dict__.setdefault("_vigil_caches", {})
    return caches.setdefault(name, {})


def sources(spark: SparkSession, sf_dir: str) -> SourceTables:
    """Fixture sources, built once per session and folder (lazy plans, no data cached)."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    # fixture timestamps are zone-less (as DuckDB reads them): compare in UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    cache = session_cache(spark, "sources")
    if sf_dir not in cache:
        cache[sf_dir] = SourceTables.from_fixtures(spark, sf_dir)
    return cache[sf_dir]


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture feature table (§1.3 schema) that reports read."""
    return sources(spark, sf_dir).frames["user_feature_vector"]


# ================================================================ S1–S3, J5, M1–M3

@register("social_metrics", O.q(O.SOCIAL, final=f"""select user_id_raiz, profile_id_social, followers_count,
  following_count, profile_bio_missing, complete_profile_missing, num_community_categories,
  comm_voluntariado_one_hot from social"""))
def q_social_metrics(spark, sf_dir):
    return finish(E.social_metrics(sources(spark, sf_dir)))


@register("messaging_metrics", O.q(O.MESSAGING, final=f"""select profile_id, {O.ts('last_seen_at')} as last_seen_at,
  total_messages, night_messages from messaging"""))
def q_messaging_metrics(spark, sf_dir):
    return finish(E.messaging_metrics(sources(spark, sf_dir)))


@register("text_corpus", O.q(O.TEXTS, final="select user_id, content, source from texts"))
def q_text_corpus(spark, sf_dir):
    return finish(E.text_corpus(sources(spark, sf_dir), resolve_ids=True))


@register("merged_users", O.q(O.SOCIAL, O.MESSAGING, O.MERGED, final=f"""select user_id_raiz, profile_id_social,
  followers_count, following_count, profile_bio_missing, complete_profile_missing, num_community_categories,
  comm_voluntariado_one_hot, profile_id, {O.ts('last_seen_at')} as last_seen_at, total_messages, night_messages
  from merged"""))
def q_merged_users(spark, sf_dir):
    src = sources(spark, sf_dir)
    return finish(FT.merge_datasets(E.social_metrics(src), E.messaging_metrics(src)))


RAW_KPI_COLS = ["user_id_raiz", "reciprocity_ratio", "days_since_last_seen", "ratio_night_messages",
                "is_profile_incomplete", "total_messages", "night_messages", "num_community_categories"]


@register("raw_kpis", O.q(O.SOCIAL, O.MESSAGING, O.MERGED, O.kpis_cte(), final=f"""select user_id_raiz,
  {O.r6('reciprocity_ratio', 'reciprocity_ratio')}, {O.r6('days_since_last_seen', 'days_since_last_seen')},
  {O.r6('ratio_night_messages', 'ratio_night_messages')}, is_profile_incomplete, total_messages, night_messages,
  num_community_categories from kpis"""))
def q_raw_kpis(spark, sf_dir):
    return finish(FT.raw_kpis(sources(spark, sf_dir), AS_OF).select(*RAW_KPI_COLS))


@register("normalized_features", O.q(*O.feature_vector_ctes(nlp=False)[:-1], final=f"""select user_id_raiz,
  {O.r6('reciprocity_ratio_norm', 'reciprocity_ratio_norm')}, {O.r6('days_since_last_seen_norm', 'days_since_last_seen_norm')},
  {O.r6('ratio_night_messages', 'ratio_night_messages')}, {O.r6('sentiment_negativity_index', 'sentiment_negativity_index')},
  {O.r6('num_community_categories_norm', 'num_community_categories_norm')} from normed"""))
def q_normalized_features(spark, sf_dir):
    df = FT.raw_kpis(sources(spark, sf_dir), AS_OF).withColumn("sentiment_negativity_index", F.lit(0.0))
    out = FT.normalize_features(df)
    return finish(out.select("user_id_raiz", "reciprocity_ratio_norm", "days_since_last_seen_norm",
                             "ratio_night_messages", "sentiment_negativity_index",
                             "num_community_categories_norm"))


@register("feature_vector", O.q(*O.feature_vector_ctes(nlp=False), final=O.FV_SELECT))
def q_feature_vector(spark, sf_dir):
    return finish(FT.run_transformation(sources(spark, sf_dir), AS_OF, skip_nlp=True))


# ================================================================ M15, A6, M17

@register("text_scores", O.q(O.TEXTS, O.SCORED, final=f"""select user_id, source, content,
  {O.r6('score', 'score')} from scored"""))
def q_text_scores(spark, sf_dir):
    texts = E.text_corpus(sources(spark, sf_dir), resolve_ids=True)
    return finish(S.score_texts(texts).select("user_id", "source", "content", "score"))


@register("negativity_index", O.q(O.TEXTS, O.SCORED, O.NEGATIVITY, final=f"""select user_id,
  {O.r6('sentiment_negativity_index', 'sentiment_negativity_index')} from negativity"""))
def q_negativity_index(spark, sf_dir):
    return finish(S.negativity_index(sources(spark, sf_dir)).filter(F.col("user_id").isNotNull()))


@register("sentiment_kpi", O.q(O.SOCIAL, O.MESSAGING, O.MERGED, O.kpis_cte(), O.TEXTS, O.SCORED, O.NEGATIVITY,
                               O.with_negativity_cte(), final=f"""select user_id_raiz,
  {O.r6('sentiment_negativity_index', 'sentiment_negativity_index')} from kneg"""))
def q_sentiment_kpi(spark, sf_dir):
    src = sources(spark, sf_dir)
    df = S.join_negativity(FT.raw_kpis(src, AS_OF), S.negativity_index(src))
    return finish(df.select("user_id_raiz", "sentiment_negativity_index"))


@register("feature_vector_nlp", O.q(*O.feature_vector_ctes(nlp=True), final=O.FV_SELECT))
def q_feature_vector_nlp(spark, sf_dir):
    return finish(FT.run_transformation(sources(spark, sf_dir), AS_OF, skip_nlp=False))


@register("texts_per_user", O.q(O.TEXTS, final="""select user_id, count(*) as n_texts,
  cast(sum(length(content)) as bigint) as n_chars from texts where user_id is not null group by user_id"""))
def q_texts_per_user(spark, sf_dir):
    return finish(S.texts_per_user(E.text_corpus(sources(spark, sf_dir))))


@register("model_adapter_scores", O.q(O.TEXTS, O.SCORED, final=f"""select user_id, source,
  {O.r6('score', 'score')} from scored"""))
def q_model_adapter_scores(spark, sf_dir):
    texts = E.text_corpus(sources(spark, sf_dir), resolve_ids=True)
    return finish(S.score_texts(texts, S.model_adapter()).select("user_id", "source", "score"))


@register("extract_row_counts", O.q(O.SOCIAL, O.MESSAGING, O.TEXTS, final="""
  select 'social_metrics' as dataset, count(*) as n_rows from social
  union all select 'messaging_metrics', count(*) from messaging
  union all select 'text_content', count(*) from texts"""))
def q_extract_row_counts(spark, sf_dir):
    return finish(E.extraction_row_counts(E.extraction(sources(spark, sf_dir))))


# ================================================================ T5 + reports over the feature table

@register("heuristic_risk", O.q(O.HEUR, final=f"""select user_id_raiz, {O.r6('risk_score', 'risk_score')},
  risk_level, {O.r6('severity_index', 'severity_index')} from heur2"""))
def q_heuristic_risk(spark, sf_dir):
    return finish(R.heuristic_risk(feature_table(spark, sf_dir))
                  .select("user_id_raiz", "risk_score", "risk_level", "severity_index"))


@register("risk_counts", O.q(final="""select cluster_label as risk_level, count(*) as n_users
  from user_feature_vector where cluster_label is not null group by cluster_label"""))
def q_risk_counts(spark, sf_dir):
    return finish(R.risk_counts(R.labelled(feature_table(spark, sf_dir)), "cluster_label"))


@register("risk_totals", O.q(O.HEUR, final="""select count(*) as total_users,
  round(avg(case when risk_level = 'ALTO_RIESGO' then 1.0 else 0.0 end) * 100.0, 6) as high_risk_percentage from heur2"""))
def q_risk_totals(spark, sf_dir):
    return finish(R.risk_totals(R.heuristic_risk(feature_table(spark, sf_dir))))


@register("risk_distribution", O.q(O.LEVELS_CTE, final="""select l.risk_level, l.label, l.ordinal,
  coalesce(c.n, 0) as n_users, t.total as total_users,
  case when t.total > 0 then round(coalesce(h.n, 0) / t.total * 100.0, 1) else 0.0 end as high_risk_percentage
 from levels l
 left join (select cluster_label, count(*) as n from user_feature_vector where cluster_label is not null
            group by cluster_label) c on c.cluster_label = l.risk_level
 cross join (select count(cluster_label) as total from user_feature_vector) t
 cross join (select count(*) as n from user_feature_vector where cluster_label = 'ALTO_RIESGO') h"""))
def q_risk_distribution(spark, sf_dir):
    return finish(R.risk_distribution(feature_table(spark, sf_dir)))


@register("distribution_message", O.q(O.HEUR, final="""select risk_level, n_users, total_users,
  case when total_users > 0 then round(n_users / total_users * 100.0, 1) else 0.0 end as percentage,
  'DISTRIBUTION_UPDATE' as type
 from (select risk_level, count(*) as n_users, sum(count(*)) over () as total_users from heur2 group by risk_level)"""))
def q_distribution_message(spark, sf_dir):
    return finish(R.distribution_message(R.heuristic_risk(feature_table(spark, sf_dir))))


@register("distribution_update", O.q(O.HEUR, final="""select 'DISTRIBUTION_UPDATE' as type, sum(n) as total_users,
  string_agg(risk_level || '=' || n, ',' order by risk_level) as counts,
  string_agg(risk_level || '=' || round(n * 100.0 / total, 1), ',' order by risk_level) as shares
 from (select risk_level, count(*) as n, sum(count(*)) over () as total from heur2 group by risk_level)"""))
def q_distribution_update(spark, sf_dir):
    m = R.distribution_update(R.heuristic_risk(feature_table(spark, sf_dir)))

    def flat(c):
        pairs = F.sort_array(F.map_entries(c))
        return F.array_join(F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")

    return finish(m.select("type", "total_users", flat("distribution").alias("counts"), flat("percentages").alias("shares")))


@register("distribution_bars", O.q(O.LEVELS_CTE, O.HEUR, final="""select l.risk_level, l.label, l.ordinal,
  coalesce(c.n, 0) as n_users,
  case when t.total > 0 then round(coalesce(c.n, 0) / t.total * 100.0, 1) else 0.0 end as share
 from levels l left join (select risk_level, count(*) as n from heur2 group by risk_level) c
   on c.risk_level = l.risk_level cross join (select count(*) as total from heur2) t"""))
def q_distribution_bars(spark, sf_dir):
    return finish(R.distribution_bars(R.heuristic_risk(feature_table(spark, sf_dir))))


RADAR = {"reciprocity": "reciprocity_ratio_norm", "inactivity": "days_since_last_seen_norm",
         "night_messages": "ratio_night_messages", "profile_incomplete": "cast(is_profile_incomplete as integer)",
         "negativity": "sentiment_negativity_index", "community": "num_community_categories_norm"}
# one row per user and axis, averaged per level
RADAR_LONG = f"""axis AS (select cluster_label as risk_level, unnest({list(RADAR)}) as k,
  unnest([{', '.join(RADAR.values())}]::double[]) as v from user_feature_vector where cluster_label is not null)"""


@register("radar_by_level", O.q(RADAR_LONG, final="select risk_level, " + ", ".join(
    f"round(avg(v) filter (where k = '{k}'), 3) as {k}" for k in RADAR) + " from axis group by risk_level"))
def q_radar_by_level(spark, sf_dir):
    return finish(R.radar_by_level(feature_table(spark, sf_dir)))


SEV_CTE = f"""sev AS (select user_id_raiz, ({O.heuristic_expr()}) * 100.0 as severity_index
 from user_feature_vector where cluster_label is not null)"""


@register("severity_histogram", O.q(SEV_CTE, final="""select b.bin, b.ordinal,
  (select count(*) from sev where severity_index > b.lo and severity_index <= b.hi) as n_users
 from (values ('0-20', 0, 0, 20), ('20-40', 1, 20, 40), ('40-60', 2, 40, 60), ('60-80', 3, 60, 80),
              ('80-100', 4, 80, 100)) b(bin, ordinal, lo, hi)"""))
def q_severity_histogram(spark, sf_dir):
    return finish(R.severity_histogram(R.report_severity(feature_table(spark, sf_dir))))


@register("severity_summary", O.q(SEV_CTE, final="""select round(avg(severity_index), 1) as mean_severity,
  round(max(severity_index), 1) as max_severity,
  round(count(*) filter (where severity_index >= 60) / count(*) * 100.0, 1) as above_60_percent from sev"""))
def q_severity_summary(spark, sf_dir):
    return finish(R.severity_summary(R.report_severity(feature_table(spark, sf_dir))))


@register("severity_histogram_20", O.q(SEV_CTE, """b AS (select min(severity_index) as lo0, max(severity_index) as hi0 from sev),
b2 AS (select case when lo0 = hi0 then lo0 - 0.5 else lo0 end as lo, case when lo0 = hi0 then hi0 + 0.5 else hi0 end as hi from b),
i0 AS (select severity_index as s, lo, hi, (hi - lo) / 20 as step,
   least(cast(floor((severity_index - lo) / (hi - lo) * 20.0) as integer), 19) as k from sev cross join b2),
i1 AS (select *, case when s < (case when k = 20 then hi else k * step + lo end) then k - 1 else k end as k1 from i0),
idx AS (select case when s >= (case when k1 + 1 = 20 then hi else (k1 + 1) * step + lo end) and k1 <> 19
   then k1 + 1 else k1 end as bin from i1),
bins AS (select range as bin from range(20))""", final="""select bins.bin, round(bins.bin * ((b2.hi - b2.lo) / 20) + b2.lo, 6) as left_edge,
  case when bins.bin * ((b2.hi - b2.lo) / 20) + b2.lo < 30 then 'BAJO_RIESGO'
       when bins.bin * ((b2.hi - b2.lo) / 20) + b2.lo < 60 then 'RIESGO_MODERADO' else 'ALTO_RIESGO' end as band,
  (select count(*) from idx where idx.bin = bins.bin) as n_users
 from bins cross join b2"""))
def q_severity_histogram_20(spark, sf_dir):
    return finish(R.chart_histogram(R.report_severity(feature_table(spark, sf_dir))))


TRENDS_SQL = O.q(final=f"""select {O.ts("date_trunc('hour', extraction_date)")} as time_bucket,
  strftime(date_trunc('hour', extraction_date), '%H:%M') as label,
  round(coalesce(avg(days_since_last_seen_norm), 0.0), 3) as avg_inactivity,
  round(coalesce(avg(sentiment_negativity_index), 0.0), 3) as avg_negativity,
  round(coalesce(avg(ratio_night_messages), 0.0), 3) as avg_night_ratio, count(*) as user_count
 from user_feature_vector where extraction_date >= timestamp '{REPORT_AS_OF}' - interval 24 hour
 group by date_trunc('hour', extraction_date)""")


@register("kpi_trends", TRENDS_SQL)
def q_kpi_trends(spark, sf_dir):
    return finish(R.kpi_trends(feature_table(spark, sf_dir), REPORT_AS_OF, 24))


@register("kpi_trends_by_day", O.q(final=f"""select {O.ts("date_trunc('hour', extraction_date)")} as time_bucket,
  strftime(date_trunc('hour', extraction_date), '%H:%M') as label, count(*) as user_count
 from user_feature_vector where extraction_date >= timestamp '{REPORT_AS_OF}' - interval 24 hour
 group by date_trunc('hour', extraction_date)"""))
def q_kpi_trends_by_day(spark, sf_dir):
    """The same report from a table partitioned by day; older days aren't read. Hours and
    counts only: thousandths of the means hang on the order of the sums where they tie."""
    path = scratch_path(spark, "by_day")
    K.write_by_day(feature_table(spark, sf_dir), path)
    return finish(R.kpi_trends(spark.read.parquet(path), REPORT_AS_OF, 24).select("time_bucket", "label", "user_count"))


@register("high_risk_users", O.q(final="""select cast(user_id_raiz as varchar) as user_id, cluster_label as risk_level,
  round((days_since_last_seen_norm * 0.25 + ratio_night_messages * 0.2 + sentiment_negativity_index * 0.25
         + (1.0 - num_community_categories_norm) * 0.15) * 100.0, 1) as severity_index,
  round(days_since_last_seen_norm * 100.0, 1) as inactivity, round(ratio_night_messages * 100.0, 1) as night_activity,
  round(sentiment_negativity_index * 100.0, 1) as negativity,
  round(num_community_categories_norm * 100.0, 1) as community_engagement,
  strftime(extraction_date, '%Y-%m-%dT%H:%M:%S') as last_updated
 from user_feature_vector where cluster_label = 'ALTO_RIESGO'
 order by days_since_last_seen_norm desc nulls first, sentiment_negativity_index desc nulls first, user_id_raiz
 limit 10"""))
def q_high_risk_users(spark, sf_dir):
    return finish(R.high_risk_users(feature_table(spark, sf_dir), 10))


@register("scatter_series", O.q(final="""select user_id_raiz, replace(cluster_label, '_', ' ') as series,
  round(reciprocity_ratio_norm, 3) as x, round(days_since_last_seen_norm, 3) as y
 from user_feature_vector where cluster_label is not null"""))
def q_scatter_series(spark, sf_dir):
    return finish(R.scatter_series(feature_table(spark, sf_dir)))


@register("feature_count", O.q(final="select count(*) as total_records from user_feature_vector"))
def q_feature_count(spark, sf_dir):
    return finish(R.feature_count(feature_table(spark, sf_dir)))


@register("text_scores_trained", None)
def q_text_scores_trained(spark, sf_dir):
    """X2(b): spark.ml classifier fitted on labelled documents, scoring every text."""
    src = sources(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    train = docs.join(labels, "doc_id").select("text", F.col("toxic").alias("label"))
    scorer = S.TrainedScorer().fit(train, "text", "label")
    texts = E.text_corpus(src, resolve_ids=True)
    return finish(S.score_texts(texts, scorer).select("user_id", "source", "score"))
