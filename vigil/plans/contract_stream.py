"""Contract queries for change capture, streaming and sinks.

Batch forms run the same functions as the ``foreachBatch`` body over all
change events at once; ``stream_pipeline`` and ``stateful_transitions`` run
real streams (file source, availableNow) into a scratch folder under
spark.checkpoint.dir and return what they wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import cdc
from ..operators import reports as R
from ..operators import sinks as K
from ..session import checkpoint, scratch_path
from ..sources import extract as E
from ..sources.tables import SourceTables
from ..streaming import changes as CH
from ..streaming import pipeline as PL
from ..streaming.maintained import COUNTED, KEYED, MESSAGE_COLUMNS, MaintainedMetrics
from . import oracle as O
from .contract import AS_OF, register, sources
from .finish import finish

# ---------------------------------------------------------------- SQL fragments

PC = """pc AS (select event_id, source, channel, received_at, payload, reason is null as ok, reason from (
   select *, case when not json_valid(payload) then 'malformed_json'
     when payload->>'timestamp' is not null and try_cast(payload->>'timestamp' as timestamp) is null
     then 'unreadable_timestamp' end as reason from change_events)),
pv AS (select event_id, source, channel, received_at, payload->>'table' as tbl, payload->>'operation' as operation,
   payload->>'user_id' as user_id, try_cast(payload->>'timestamp' as timestamp) as event_time
   from pc where ok),
pu AS (select * from pv where user_id <> ''),
lk AS (select distinct * from (select 'root' as space, root_id as id, root_id from id_map
   union all select 'profile', profile_id, root_id from id_map
   union all select 'messaging', messaging_id, root_id from id_map where messaging_id is not null)),
res AS (select pu.*, lk.root_id from pu join lk on cast(lk.id as varchar) = pu.user_id and lk.space = case when pu.tbl = 'messages'
   then 'messaging' when pu.tbl in ('users', 'community_members') then 'profile' else 'root' end),
lat AS (select * from (select res.*, row_number() over (partition by root_id order by received_at desc, event_id desc) as rn,
   count(*) over (partition by root_id) as n_events from res) where rn = 1)"""

AFF = """aff AS (select s.user_id_raiz, s.profile_id_social, s.followers_count, s.following_count, s.profile_bio_missing,
   s.complete_profile_missing, s.num_community_categories, m.last_seen_at, m.total_messages, m.night_messages
   from social s join lat on s.user_id_raiz = lat.root_id left join messaging m on m.profile_id = s.profile_id_social)"""


def inc_cte(name: str, src: str, as_of: str, extra: str) -> str:
    return f"""{name} AS (select {extra},
   least((case when coalesce(s.followers_count, 0) > 0 then cast(coalesce(s.following_count, 0) as double)
     / cast(coalesce(s.followers_count, 0) as double) else 0.0 end) / 10.0, 1.0) as reciprocity_ratio_norm,
   least(coalesce(cast(epoch_us(cast({as_of} as timestamp)) - epoch_us(cast(s.last_seen_at as timestamp)) as double)
     / 86400000000e0, 365e0) / 365.0, 1.0) as days_since_last_seen_norm,
   case when coalesce(s.total_messages, 0) > 0 then cast(coalesce(s.night_messages, 0) as double)
     / cast(coalesce(s.total_messages, 0) as double) else 0.0 end as ratio_night_messages,
   case when coalesce(s.profile_bio_missing, true) and coalesce(s.complete_profile_missing, true) then 1.0 else 0.0 end
     as is_profile_incomplete,
   0.0 as sentiment_negativity_index,
   least(cast(coalesce(s.num_community_categories, 0) as double) / 12.0, 1.0) as num_community_categories_norm
   from {src})"""


INC = inc_cte("inc", "aff s join lat on s.user_id_raiz = lat.root_id", "lat.received_at",
              "s.user_id_raiz, lat.received_at as as_of, lat.tbl")
SCORE = """sc AS (select inc.*, days_since_last_seen_norm * 0.25 + ratio_night_messages * 0.2
     + case when is_profile_incomplete > 0.5 then 0.15 else 0.0 end + sentiment_negativity_index * 0.25
     + (1.0 - num_community_categories_norm) * 0.15 as risk_score from inc),
sc2 AS (select sc.*, case when risk_score >= 0.6 then 'ALTO_RIESGO' when risk_score >= 0.3 then 'RIESGO_MODERADO'
     else 'BAJO_RIESGO' end as risk_level, risk_score * 100.0 as severity_index, u.cluster_label as previous_risk
   from sc left join user_feature_vector u on u.user_id_raiz = sc.user_id_raiz)"""


def factor(text: str) -> str:
    """A fixed alert text as an SQL literal."""
    return "'" + text.replace("'", "''") + "'"


UPD_MSG = f"""upd AS (select cast(user_id_raiz as varchar) as user_id, risk_level, round(severity_index, 2) as severity_index,
   previous_risk, coalesce(previous_risk is not null and previous_risk <> risk_level, false) as risk_changed,
   tbl as triggering_table, as_of, 'USER_RISK_UPDATE' as type from sc2),
alr AS (select cast(user_id_raiz as varchar) as user_id, case when severity_index > 80 then 'URGENT' else 'HIGH' end
   as priority, round(severity_index, 2) as severity_index,
   concat_ws(' | ', {factor(C.ALERT_FACTOR_TABLE)} || tbl, {factor(C.ALERT_FACTOR_PREVIOUS)} || ifnull(previous_risk, 'N/A'),
   {factor(C.ALERT_FACTOR_CURRENT)} || risk_level) as factors, as_of, 'CRITICAL_ALERT' as type
   from sc2 where risk_level = 'ALTO_RIESGO' and previous_risk is distinct from 'ALTO_RIESGO'),
msgs AS (select user_id, type, as_of as server_timestamp, 'clustering' as channel from upd
   union all select user_id, type, as_of, 'alerts' from alr
   union all select user_id, type, as_of, 'clustering' from alr)"""
STREAM_CTES = [O.SOCIAL, O.MESSAGING, PC, AFF, INC, SCORE, UPD_MSG]


def final_table_sql() -> str:
    cols = ", ".join(
        f"case when p.user_id_raiz is not null then p.{c} else u.{c} end as {c}"
        for c in ["reciprocity_ratio_norm", "days_since_last_seen_norm", "ratio_night_messages",
                  "sentiment_negativity_index", "num_community_categories_norm"])
    return f"""fin AS (select u.id, u.user_id_raiz,
   case when p.user_id_raiz is not null then p.as_of else u.extraction_date end as extraction_date, {cols},
   case when p.user_id_raiz is not null then p.is_profile_incomplete > 0.5 else u.is_profile_incomplete end
     as is_profile_incomplete, u.int_gaming_one_hot, u.comm_voluntariado_one_hot,
   case when p.user_id_raiz is not null then p.risk_level else u.cluster_label end as cluster_label
   from user_feature_vector u left join sc2 p on p.user_id_raiz = u.user_id_raiz
   union all
   select (select max(id) from user_feature_vector) + row_number() over (order by p.user_id_raiz), p.user_id_raiz,
     p.as_of, p.reciprocity_ratio_norm, p.days_since_last_seen_norm, p.ratio_night_messages,
     p.sentiment_negativity_index, p.num_community_categories_norm, p.is_profile_incomplete > 0.5, null, null,
     p.risk_level
   from sc2 p where p.user_id_raiz not in (select user_id_raiz from user_feature_vector))"""


FT_SELECT = """select id, user_id_raiz, strftime(extraction_date, '%Y-%m-%d %H:%M:%S') as extraction_date,
  round(reciprocity_ratio_norm, 6) as reciprocity_ratio_norm, round(days_since_last_seen_norm, 6) as days_since_last_seen_norm,
  round(ratio_night_messages, 6) as ratio_night_messages, is_profile_incomplete,
  round(sentiment_negativity_index, 6) as sentiment_negativity_index,
  round(num_community_categories_norm, 6) as num_community_categories_norm,
  int_gaming_one_hot, comm_voluntariado_one_hot, cluster_label from fin"""


# ---------------------------------------------------------------- Spark helpers

def batch_outputs(spark, sf_dir):
    src = sources(spark, sf_dir)
    return src, PL.score_changes(src, src.frames["change_events"], src.frames["user_feature_vector"])


def resolved_all(spark, sf_dir):
    src = sources(spark, sf_dir)
    parsed = CH.parse_changes(src.frames["change_events"])
    return src, CH.resolve_users(CH.with_user(CH.valid_changes(parsed)), E.id_map(src))


def scored_history(spark, sf_dir):
    """Every resolved event scored with as_of = its received_at (input of W4/T10)."""
    src, res = resolved_all(spark, sf_dir)
    roots = res.select("root_id").distinct()
    metrics = PL.affected_user_metrics(src, roots)
    ev = res.select("root_id", "event_id", "received_at", "table")
    m = ev.join(metrics, ev["root_id"] == metrics["user_id_raiz"], "inner")
    scored = R.heuristic_risk(PL.incremental_features(m, F.col("received_at")))
    return scored.select("root_id", "event_id", "received_at", "risk_level")


# ---------------------------------------------------------------- T1, T2, J9, W3, T9

@register("parsed_changes", O.q(PC, final=f"""select event_id, source, channel, {O.ts('received_at')} as received_at,
  tbl as "table", operation, user_id, {O.ts('event_time')} as event_time from pv"""))
def q_parsed_changes(spark, sf_dir):
    p = CH.valid_changes(CH.parse_changes(sources(spark, sf_dir).frames["change_events"]))
    return finish(p.select("event_id", "source", "channel", "received_at", "table", "operation", "user_id",
                           "event_time"))


@register("rejected_changes", O.q(PC, final="""select event_id, source, payload, reason
  from pc where not ok"""))
def q_rejected_changes(spark, sf_dir):
    p = CH.parse_changes(sources(spark, sf_dir).frames["change_events"])
    return finish(CH.rejected_changes(p).select("event_id", "source", "payload", "reason"))


@register("resolved_events", O.q(PC, final="""select event_id, tbl as "table", user_id, root_id from res"""))
def q_resolved_events(spark, sf_dir):
    _, res = resolved_all(spark, sf_dir)
    return finish(res.select("event_id", "table", "user_id", "root_id"))


@register("latest_change_per_user", O.q(PC, final=f"""select root_id, event_id, tbl as "table",
  {O.ts('received_at')} as received_at, n_events from lat"""))
def q_latest_change_per_user(spark, sf_dir):
    _, res = resolved_all(spark, sf_dir)
    return finish(CH.latest_per_user(res).select("root_id", "event_id", "table", "received_at", "n_events"))


@register("changes_per_window", O.q(PC, final=f"""select {O.ts("date_trunc('hour', event_time)")} as window_start,
  {O.ts("date_trunc('hour', event_time) + interval 1 hour")} as window_end, tbl as "table", count(*) as n_changes
  from pv where event_time is not null group by date_trunc('hour', event_time), tbl"""))
def q_changes_per_window(spark, sf_dir):
    p = CH.valid_changes(CH.parse_changes(sources(spark, sf_dir).frames["change_events"]))
    return finish(CH.changes_per_window(p.filter(F.col("event_time").isNotNull())))


# ---------------------------------------------------------------- J7, T4, J12, T5–T7, K5, W1, W2

@register("affected_user_metrics", O.q(O.SOCIAL, O.MESSAGING, PC, AFF, final=f"""select user_id_raiz,
  profile_id_social, followers_count, following_count, profile_bio_missing, complete_profile_missing,
  num_community_categories, {O.ts('last_seen_at')} as last_seen_at, total_messages, night_messages from aff"""))
def q_affected_user_metrics(spark, sf_dir):
    src, res = resolved_all(spark, sf_dir)
    return finish(PL.affected_user_metrics(src, res.select("root_id")))


@register("incremental_features", O.q(*STREAM_CTES[:5], final=f"""select user_id_raiz, {O.ts('as_of')} as as_of,
  round(reciprocity_ratio_norm, 6) as reciprocity_ratio_norm, round(days_since_last_seen_norm, 6) as days_since_last_seen_norm,
  round(ratio_night_messages, 6) as ratio_night_messages, round(is_profile_incomplete, 6) as is_profile_incomplete,
  round(sentiment_negativity_index, 6) as sentiment_negativity_index,
  round(num_community_categories_norm, 6) as num_community_categories_norm from inc"""))
def q_incremental_features(spark, sf_dir):
    _, out = batch_outputs(spark, sf_dir)
    return finish(out["scored"].select("user_id_raiz", "as_of", "reciprocity_ratio_norm", "days_since_last_seen_norm",
                                       "ratio_night_messages", "is_profile_incomplete", "sentiment_negativity_index",
                                       "num_community_categories_norm"))


@register("previous_levels", O.q(*STREAM_CTES[:6], final="""select user_id_raiz, previous_risk from sc2"""))
def q_previous_levels(spark, sf_dir):
    _, out = batch_outputs(spark, sf_dir)
    return finish(out["scored"].select("user_id_raiz", "previous_risk"))


@register("risk_updates", O.q(*STREAM_CTES, final=f"""select user_id, risk_level, severity_index, previous_risk,
  risk_changed, triggering_table, {O.ts('as_of')} as as_of, type from upd"""))
def q_risk_updates(spark, sf_dir):
    _, out = batch_outputs(spark, sf_dir)
    return finish(out["risk_updates"].select("user_id", "risk_level", "severity_index", "previous_risk",
                                             "risk_changed", "triggering_table", "as_of", "type"))


@register("critical_alerts", O.q(*STREAM_CTES, final=f"""select user_id, priority, severity_index, factors,
  {O.ts('as_of')} as as_of, type from alr"""))
def q_critical_alerts(spark, sf_dir):
    _, out = batch_outputs(spark, sf_dir)
    return finish(out["alerts"].select("user_id", "priority", "severity_index",
                                       F.array_join("factors", " | ").alias("factors"), "as_of", "type"))


@register("channel_messages", O.q(*STREAM_CTES, final=f"""select user_id, type, {O.ts('server_timestamp')}
  as server_timestamp, channel from msgs"""))
def q_channel_messages(spark, sf_dir):
    _, out = batch_outputs(spark, sf_dir)
    return finish(out["messages"].select("user_id", "type", "server_timestamp", "channel"))


HIST_SQL = ("hist AS (select *, row_number() over (partition by channel order by server_timestamp desc, user_id desc, "
            "type desc) as rank from msgs)")


@register("channel_history", O.q(*STREAM_CTES, HIST_SQL, final=f"""select channel, rank, user_id, type,
  {O.ts('server_timestamp')} as server_timestamp from hist where rank <= 50"""))
def q_channel_history(spark, sf_dir):
    _, out = batch_outputs(spark, sf_dir)
    return finish(PL.channel_history(out["messages"]).select("channel", "rank", "user_id", "type", "server_timestamp"))


@register("recent_messages", O.q(*STREAM_CTES, HIST_SQL, final=f"""select channel, rank, user_id, type,
  {O.ts('server_timestamp')} as server_timestamp from hist where rank <= 10"""))
def q_recent_messages(spark, sf_dir):
    _, out = batch_outputs(spark, sf_dir)
    return finish(PL.recent_messages(out["messages"]).select("channel", "rank", "user_id", "type", "server_timestamp"))


# ---------------------------------------------------------------- W4, T10

HISTORY_CTES = [O.SOCIAL, O.MESSAGING, PC,
                """aff2 AS (select s.user_id_raiz, s.profile_id_social, s.followers_count, s.following_count,
   s.profile_bio_missing, s.complete_profile_missing, s.num_community_categories, m.last_seen_at, m.total_messages,
   m.night_messages from social s join (select distinct root_id from res) r on s.user_id_raiz = r.root_id
   left join messaging m on m.profile_id = s.profile_id_social)""",
                inc_cte("hinc", "aff2 s join res e on s.user_id_raiz = e.root_id", "e.received_at",
                        "e.root_id, e.event_id, e.received_at"),
                """hsc AS (select *, case when r >= 0.6 then 'ALTO_RIESGO' when r >= 0.3 then 'RIESGO_MODERADO'
   else 'BAJO_RIESGO' end as risk_level from (select hinc.*, days_since_last_seen_norm * 0.25 + ratio_night_messages * 0.2
   + case when is_profile_incomplete > 0.5 then 0.15 else 0.0 end + sentiment_negativity_index * 0.25
   + (1.0 - num_community_categories_norm) * 0.15 as r from hinc)),
htr AS (select root_id, event_id, received_at, risk_level,
   lag(risk_level) over (partition by root_id order by received_at, event_id) as previous_level from hsc)"""]
TRANSITIONS_FINAL = f"""select root_id, event_id, {O.ts('received_at')} as received_at, risk_level, previous_level,
  previous_level is distinct from risk_level as is_transition from htr"""


@register("risk_transitions", O.q(*HISTORY_CTES, final=TRANSITIONS_FINAL))
def q_risk_transitions(spark, sf_dir):
    return finish(PL.risk_transitions(scored_history(spark, sf_dir))
                  .select("root_id", "event_id", "received_at", "risk_level", "previous_level", "is_transition"))


@register("stateful_transitions", O.q(*HISTORY_CTES, final=TRANSITIONS_FINAL))
def q_stateful_transitions(spark, sf_dir):
    """T10 as a real stream: scored events → applyInPandasWithState → parquet."""
    base = scratch_path(spark, "transitions")
    hist = scored_history(spark, sf_dir)
    hist.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(hist.schema).parquet(f"{base}/in")
    q = (PL.stateful_transitions(stream).writeStream.format("parquet").outputMode("append")
         .option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.schema(PL.transition_schema(hist)).parquet(f"{base}/out")
    return finish(out.select("root_id", "event_id", "received_at", "risk_level", "previous_level", "is_transition"))


@register("transitions_with_expiry", O.q(*HISTORY_CTES, final=TRANSITIONS_FINAL))
def q_transitions_with_expiry(spark, sf_dir, chunks: int = 3):
    """T10 with state that expires: time slices, and users idle for two days are forgotten
    by the state and found in the table of last levels."""
    base = scratch_path(spark, "expiry")
    hist = checkpoint(scored_history(spark, sf_dir))
    ends = hist.agg(F.min("received_at").alias("lo"), F.max("received_at").alias("hi")).first()
    step = (ends["hi"] - ends["lo"]) / chunks
    for i in range(chunks):
        part = hist.filter(F.col("received_at") >= F.lit(ends["lo"] + step * i))
        if i < chunks - 1:
            part = part.filter(F.col("received_at") < F.lit(ends["lo"] + step * (i + 1)))
        part.write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(hist.schema).parquet(f"{base}/in")
        out = PL.run_transitions(stream, f"{base}/out", f"{base}/ckpt", idle="2 days")
    return finish(out.drop("is_first", "is_late"))


# ---------------------------------------------------------------- K3, T3 stream, K4, K6, K1/K2/S5, S7

@register("upsert_features", O.q(*STREAM_CTES, final_table_sql(), final=FT_SELECT))
def q_upsert_features(spark, sf_dir):
    src, out = batch_outputs(spark, sf_dir)
    return finish(K.upsert(src.frames["user_feature_vector"], out["updates"]))


@register("stream_pipeline", O.q(*STREAM_CTES, final_table_sql(), final=FT_SELECT))
def q_stream_pipeline(spark, sf_dir, chunks: int = 3):
    """T3 end to end: time slices of the change events, each taken by a restarted stream."""
    src = sources(spark, sf_dir).stored(spark, *STREAM_SOURCES)
    base = scratch_path(spark, "stream")
    for _ in change_slices(spark, src, f"{base}/in", chunks):
        # each slice arrives, then the stream resumes from its checkpoint and takes it
        sinks = PL.run_stream(spark, src, f"{base}/in", f"{base}/out", f"{base}/ckpt",
                              initial=src.frames["user_feature_vector"], max_files=None)
    return finish(sinks.features.read())


#: Sources that a stream reads in every micro-batch and that are views with joins here.
STREAM_SOURCES = ["community_members", "users"]


def change_slices(spark, src, path: str, chunks: int):
    """Write the change events to a folder in time slices; yields after each."""
    ev = src.frames["change_events"].select("event_id", "source", "channel",
                                            F.col("received_at").cast("timestamp").alias("received_at"), "payload")
    bounds = ev.agg(F.min("received_at").alias("lo"), F.max("received_at").alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"]
    step = (hi - lo) / chunks
    for i in range(chunks):
        a = lo + step * i
        part = ev.filter(F.col("received_at") >= F.lit(a))
        if i < chunks - 1:
            part = part.filter(F.col("received_at") < F.lit(a + step))
        part.write.mode("append").parquet(path)
        yield i


@register("stream_history", O.q(*STREAM_CTES, HIST_SQL, final=f"""select channel, rank, user_id, type,
  {O.ts('server_timestamp')} as server_timestamp from hist where rank <= 50"""))
def q_stream_history(spark, sf_dir):
    """The newest messages as the stream keeps them; the log, folded, holds the same."""
    src = sources(spark, sf_dir)
    base = scratch_path(spark, "history")
    for _ in change_slices(spark, src, f"{base}/in", 1):
        sinks = PL.run_stream(spark, src, f"{base}/in", f"{base}/out", f"{base}/ckpt",
                              initial=src.frames["user_feature_vector"], max_files=None)
    sinks.compact_messages(0)
    kept, whole = (d.select("channel", "rank", "user_id", "type", "server_timestamp") for d in (sinks.history(), PL.channel_history(sinks.messages())))
    return finish(kept.intersectAll(whole))


LOADED = """loaded AS (select row_number() over (order by user_id_raiz % 3 = 0, user_id_raiz) as id, user_id_raiz,
   timestamp '{as_of}' as extraction_date, reciprocity_ratio_norm, days_since_last_seen_norm, ratio_night_messages,
   is_profile_incomplete, sentiment_negativity_index, num_community_categories_norm, int_gaming_one_hot,
   comm_voluntariado_one_hot, cast(null as varchar) as cluster_label from fv)"""
FT_NO_ID = FT_SELECT.replace("select id, ", "select ", 1)


@register("stream_after_loads", O.q(
    *O.feature_vector_ctes(nlp=False), LOADED.format(as_of=AS_OF), PC, AFF, INC, SCORE.replace("user_feature_vector", "loaded"),
    final_table_sql().replace("user_feature_vector", "loaded"), final=FT_NO_ID))
def q_stream_after_loads(spark, sf_dir, chunks: int = 3):
    """K2 and K1 into a new table, then the stream into the same table: no batch and no load is lost."""
    from ..operators import features as FT
    src = sources(spark, sf_dir).stored(spark, *STREAM_SOURCES)
    base = scratch_path(spark, "loads")
    fv = FT.run_transformation(src, AS_OF, skip_nlp=True)
    table = PL.StreamSinks(spark, f"{base}/out").features
    K.truncate_reload(table, fv.filter(F.col("user_id_raiz") % 3 != 0), AS_OF)
    K.append_features(table, fv.filter(F.col("user_id_raiz") % 3 == 0), AS_OF)
    for _ in change_slices(spark, src, f"{base}/in", chunks):
        sinks = PL.run_stream(spark, src, f"{base}/in", f"{base}/out", f"{base}/ckpt", max_files=None)
    return finish(sinks.features.read().drop("id"))


def earlier(src):
    """An earlier state of the source tables: rows that are there now were not yet, or
    were others, and some were there that are gone."""
    def gone(df, key, every):
        """Copies under other keys; the current tables lack them."""
        return df.unionByName(df.filter(F.col(key) % every == 0).withColumn(key, F.col(key) + 10**12))

    t = src.frames
    sender, deleted = F.col("sender_profile_id"), F.col("is_deleted")
    messages = (t["messages"].filter("id % 7 <> 0").withColumn("sender_profile_id", F.when(F.col("id") % 11 == 0, sender + 1).otherwise(sender))
                .withColumn("is_deleted", F.when(F.col("id") % 5 == 0, ~deleted).otherwise(deleted)))
    members = t["community_members"].filter("(user_id + community_id) % 5 <> 0")
    profiles = t["user_profiles"].withColumn("following_count", F.col("following_count") + F.col("id") % 3)
    return SourceTables({
        "messages": gone(messages, "id", 13),
        # only every third community can be one of those moved to
        "community_members": members.unionByName(members.filter("community_id % 3 = 0").withColumn("community_id", F.col("community_id") + 1)
                                                 .join(t["community_members"].filter("pmod(community_id, 3) = 1"), ["user_id", "community_id"], "left_anti")),
        "complete_profiles": gone(t["complete_profiles"].filter("user_id % 4 <> 0"), "user_id", 6),
        "user_profiles": gone(profiles.filter("user_id % 9 <> 0"), "user_id", 10),
        "users": t["users"].withColumn("last_seen_at", F.when(F.col("id") % 2 == 0, F.col("last_seen_at"))),
        "communities": t["communities"].withColumn("category", F.when(F.col("id") % 4 == 0, F.lit("Voluntariado")).otherwise(F.col("category")))})


@register("maintained_metrics", O.q(O.SOCIAL, O.MESSAGING, final=f"""select user_id_raiz, profile_id_social,
  followers_count, following_count, profile_bio_missing, complete_profile_missing, num_community_categories,
  {O.ts('last_seen_at')} as last_seen_at, total_messages, night_messages
  from social s left join messaging m on m.profile_id = s.profile_id_social"""))
def q_maintained_metrics(spark, sf_dir, batches: int = 2):
    """J7 from maintained tables: an earlier state, then batches of row changes with updates and deletes
    (one delivered again); the metrics of all users equal those of the current tables."""
    src = sources(spark, sf_dir).stored(spark, "community_members")  # read eight times
    before, store = earlier(src).stored(spark, "community_members"), MaintainedMetrics(spark, scratch_path(spark, "maintained"), buckets=8)
    store.bootstrap(before)
    keys = {"messages": "id", "user_profiles": "user_id", "users": "id", "communities": "id", "complete_profiles": "user_id",
            "community_members": ["user_id", "community_id"]}
    images = {}
    for t in (*COUNTED, *KEYED):
        columns = sum(KEYED[t], []) if t in KEYED else MESSAGE_COLUMNS if t == "messages" else COUNTED[t][1]
        images[t] = checkpoint(cdc.row_images(before[t], src[t], keys[t], columns))
    for b in [*range(batches), 1]:
        store.apply({t: d.filter(F.pmod(F.xxhash64("row_key"), F.lit(batches)) == b) for t, d in images.items()}, b)
    return finish(store.of_users(src["user_profiles"].select(F.col("user_id").alias("root_id"))))


LABEL_CTES = O.feature_vector_ctes(nlp=False) + [
    f"hl AS (select user_id_raiz, {O.level_expr('(' + O.heuristic_expr() + ')')} as risk_level from fv)"]


@register("label_update", O.q(*LABEL_CTES, final="""select u.id, u.user_id_raiz,
  strftime(u.extraction_date, '%Y-%m-%d %H:%M:%S') as extraction_date,
  round(u.reciprocity_ratio_norm, 6) as reciprocity_ratio_norm, round(u.days_since_last_seen_norm, 6) as days_since_last_seen_norm,
  round(u.ratio_night_messages, 6) as ratio_night_messages, u.is_profile_incomplete,
  round(u.sentiment_negativity_index, 6) as sentiment_negativity_index,
  round(u.num_community_categories_norm, 6) as num_community_categories_norm, u.int_gaming_one_hot,
  u.comm_voluntariado_one_hot, coalesce(hl.risk_level, u.cluster_label) as cluster_label
 from user_feature_vector u left join hl on hl.user_id_raiz = u.user_id_raiz"""))
def q_label_update(spark, sf_dir):
    from ..operators import features as FT
    src = sources(spark, sf_dir)
    fv = R.heuristic_risk(FT.run_transformation(src, AS_OF, skip_nlp=True))
    return finish(K.label_update(src.frames["user_feature_vector"], fv))


@register("duplicate_check", O.q(*STREAM_CTES, final="""select user_id_raiz, count(*) as n_rows from (
  select user_id_raiz from user_feature_vector union all select user_id_raiz from sc2) group by user_id_raiz
  having count(*) > 1 or user_id_raiz is null"""))
def q_duplicate_check(spark, sf_dir):
    src, out = batch_outputs(spark, sf_dir)
    both = K.conform(src.frames["user_feature_vector"]).unionByName(K.conform(out["updates"]))
    return finish(K.assert_feature_table(both))


LOAD_SQL = O.q(*O.feature_vector_ctes(nlp=False), final=f"""select row_number() over (order by user_id_raiz) as id,
  user_id_raiz, '{AS_OF}' as extraction_date, round(reciprocity_ratio_norm, 6) as reciprocity_ratio_norm,
  round(days_since_last_seen_norm, 6) as days_since_last_seen_norm, round(ratio_night_messages, 6) as ratio_night_messages,
  is_profile_incomplete, round(sentiment_negativity_index, 6) as sentiment_negativity_index,
  round(num_community_categories_norm, 6) as num_community_categories_norm, int_gaming_one_hot,
  comm_voluntariado_one_hot, cast(null as varchar) as cluster_label from fv""")


@register("truncate_reload", LOAD_SQL)
def q_truncate_reload(spark, sf_dir):
    from ..operators import features as FT
    table = K.FeatureTable(spark, scratch_path(spark, "features"))
    n = K.truncate_reload(table, FT.run_transformation(sources(spark, sf_dir), AS_OF, skip_nlp=True), AS_OF)
    assert n >= 0
    return finish(table.read())


@register("append_features", LOAD_SQL)
def q_append_features(spark, sf_dir):
    from ..operators import features as FT
    table = K.FeatureTable(spark, scratch_path(spark, "features"))
    K.append_features(table, FT.run_transformation(sources(spark, sf_dir), AS_OF, skip_nlp=True), AS_OF)
    return finish(table.read())


@register("feature_scan", LOAD_SQL)
def q_feature_scan(spark, sf_dir):
    from ..operators import features as FT
    table = K.FeatureTable(spark, scratch_path(spark, "features"))
    K.truncate_reload(table, FT.run_transformation(sources(spark, sf_dir), AS_OF, skip_nlp=True), AS_OF)
    return finish(E.feature_scan(table))


SNAP = """snap_old AS (select * from user_profiles where user_id % 23 <> 0),
snap_new AS (select user_id, id, followers_count,
   case when user_id % 7 = 0 then following_count + 1 else following_count end as following_count, bio, is_active
   from user_profiles where user_id % 29 <> 0),
diff AS (select coalesce(n.user_id, o.user_id) as user_id, coalesce(n.id, o.id) as profile_id,
   case when o.id is null then 'INSERT' when n.id is null then 'DELETE'
        when o.followers_count is distinct from n.followers_count or o.following_count is distinct from n.following_count
          or o.bio is distinct from n.bio or o.is_active is distinct from n.is_active then 'UPDATE' end as operation,
   o.following_count as o_following, n.following_count as n_following, o.bio as o_bio, n.bio as n_bio
   from snap_old o full outer join snap_new n on o.id = n.id),
diff2 AS (select *, case when operation = 'UPDATE' and o_following is distinct from n_following then 'following_count'
   when operation = 'UPDATE' and o_bio is distinct from n_bio then 'bio' else 'other' end as field_changed
   from diff where operation is not null)"""


def snapshots(spark, sf_dir):
    up = sources(spark, sf_dir).frames["user_profiles"]
    old = up.filter(F.col("user_id") % 23 != 0)
    new = (up.filter(F.col("user_id") % 29 != 0)
           .withColumn("following_count", F.when(F.col("user_id") % 7 == 0, F.col("following_count") + 1)
                       .otherwise(F.col("following_count"))))
    return cdc.snapshot_diff(old, new, "id", ["followers_count", "following_count", "bio", "is_active"],
                             "user_profiles", "user_id", "profile_id", ["following_count", "bio"], as_of=AS_OF)


@register("snapshot_changes", O.q(SNAP, final=f"""select 'user_profiles' as "table", operation, user_id, profile_id,
  field_changed, json_object('table', 'user_profiles', 'operation', operation, 'user_id', user_id,
  'profile_id', profile_id, 'field_changed', field_changed, 'timestamp', '{AS_OF}')::varchar as payload from diff2"""))
def q_snapshot_changes(spark, sf_dir):
    return finish(snapshots(spark, sf_dir))


@register("change_payload_fields", O.q(SNAP, final="""select operation, field_changed, count(*) as n_changes
  from diff2 group by operation, field_changed"""))
def q_change_payload_fields(spark, sf_dir):
    d = snapshots(spark, sf_dir)
    return finish(d.groupBy("operation", "field_changed").agg(F.count(F.lit(1)).alias("n_changes")))


@register("changes_per_window_stream", O.q(PC, final=f"""select {O.ts("date_trunc('hour', event_time)")} as window_start,
  {O.ts("date_trunc('hour', event_time) + interval 1 hour")} as window_end, tbl as "table", count(*) as n_changes
  from pv where event_time is not null group by date_trunc('hour', event_time), tbl"""))
def q_changes_per_window_stream(spark, sf_dir, chunks: int = 4):
    """T9 as a stream over out-of-order slices; what each window holds is counted or late."""
    base = scratch_path(spark, "windows")
    ev = sources(spark, sf_dir).frames["change_events"].select(
        "event_id", "source", "channel", F.col("received_at").cast("timestamp").alias("received_at"), "payload")
    for i in range(chunks):
        ev.filter(F.pmod("event_id", F.lit(chunks)) == i).write.mode("append").parquet(f"{base}/in")
        out = PL.run_window_counts(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    late = CH.changes_per_window(out.late())
    both = out.counts().unionByName(late.withColumn("n_changes", F.col("n_changes").cast("long")))
    return finish(both.groupBy("window_start", "window_end", "table").agg(F.sum("n_changes").alias("n_changes")))


@register("changes_per_window_sources", O.q(PC, final=f"""select {O.ts("date_trunc('hour', event_time)")} as window_start,
  {O.ts("date_trunc('hour', event_time) + interval 1 hour")} as window_end, tbl as "table", count(*) as n_changes
  from pv where event_time is not null group by date_trunc('hour', event_time), tbl"""))
def q_changes_per_window_sources(spark, sf_dir, chunks: int = 3):
    """S6 + T9: social and messaging changes from folders of their own, the messaging ones a
    slice later; every change is counted in its window, none is late."""
    src = sources(spark, sf_dir)
    base = scratch_path(spark, "sources")
    waiting = None
    paths = {name: f"{base}/{name}" for name in ("social", "messaging")}
    ev = src.frames["change_events"].select("event_id", "source", "channel",
                                            F.col("received_at").cast("timestamp").alias("received_at"), "payload")
    ends = ev.agg(F.min("received_at").alias("lo"), F.max("received_at").alias("hi")).first()
    step = (ends["hi"] - ends["lo"]) / chunks
    place = F.least(F.floor((F.col("received_at").cast("double") - ends["lo"].timestamp()) / step.total_seconds()), F.lit(chunks - 1))
    for path in paths.values():
        ev.limit(0).write.parquet(path)
    for i in range(chunks + 1):
        ev.filter((place == i) & (F.col("source") == "social")).write.mode("append").parquet(paths["social"])
        if waiting is not None:
            ev.filter((place == waiting) & (F.col("source") == "messaging")).write.mode("append").parquet(paths["messaging"])
        waiting = i
        out = PL.run_window_counts(spark, paths, f"{base}/out", f"{base}/ckpt")
    return finish(out.counts())


@register("ensemble_batch_scores", None)
def q_ensemble_batch_scores(spark, sf_dir):
    """The stream's batch features scored by the fitted ensemble instead of T5."""
    from . import contract_ensemble as CE

    src = sources(spark, sf_dir)
    fit = CE._ensemble(spark, sf_dir)
    out = PL.score_changes(src, src.frames["change_events"], src.frames["user_feature_vector"],
                           scorer=fit.as_scorer())
    return finish(out["risk_updates"].select("user_id", "risk_level", "severity_index", "previous_risk",
                                             "risk_changed", "triggering_table"))
