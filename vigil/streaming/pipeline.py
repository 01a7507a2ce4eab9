"""Incremental scoring: T3–T8, T10, K3, K5, J7, J12, P12, W1, W2, W4.

``process_batch`` is the ``foreachBatch`` body: W3 → J9 → J7 → T4 → J12 →
T5 → K3 → T6/T7 → K5. Every step is a DataFrame join keyed by the users
of the micro-batch; the affected ids are semi-joined into the source tables
*below* their aggregates (P12), so a batch never re-aggregates whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial, reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import expressions as X
from ..operators import reports as R
from ..operators import sinks as K
from ..operators.bucket_table import BucketTable
from ..session import checkpoint, remove
from ..sources import extract as E
from ..sources.tables import SourceTables
from . import changes as CH


# ---------------------------------------------------------------- J7 + P12

def restrict_sources(src: SourceTables, roots: DataFrame) -> SourceTables:
    """Source tables cut down to the affected users (semi joins below aggregates)."""
    up, wanted = src["user_profiles"], roots.select(F.col("root_id").cast("string").alias("_root")).distinct()
    # ids compare as text: an event may carry an id that isn't a number
    up = up.join(wanted, up["user_id"].cast("string") == wanted["_root"], "left_semi")
    prof = up.select(F.col("id").alias("_pid"))
    users = src["users"].join(prof, src["users"]["profile_id"] == prof["_pid"], "left_semi")
    msg_ids = users.select(F.col("id").alias("_mid"))
    frames = dict(src.frames)
    frames.update({
        "user_profiles": up,
        "complete_profiles": src["complete_profiles"].join(prof, src["complete_profiles"]["user_id"] == prof["_pid"],
                                                           "left_semi"),
        "community_members": src["community_members"].join(prof, src["community_members"]["user_id"] == prof["_pid"],
                                                           "left_semi"),
        "users": users,
        "messages": src["messages"].join(msg_ids, src["messages"]["sender_profile_id"] == msg_ids["_mid"],
                                         "left_semi"),
    })
    return SourceTables(frames)


def affected_user_metrics(src: SourceTables, roots: DataFrame) -> DataFrame:
    """Social row (inner: missing drops the event) ⟕ messaging row by profile id.
    The stream's social extract has no volunteering flag (as in the reference)."""
    r = restrict_sources(src, roots)
    social = E.social_metrics(r, with_volunteer=False)
    msg = E.messaging_metrics(r)
    return social.join(msg, social["profile_id_social"] == msg["profile_id"], "left").drop("profile_id")


# ---------------------------------------------------------------- T4

def incremental_features(metrics: DataFrame, as_of, negativity: DataFrame | None = None) -> DataFrame:
    """T4: KPIs with fixed caps (10, 365, 12); negativity 0 unless a stored value is given."""
    following = F.coalesce(F.col("following_count"), F.lit(0))
    followers = F.coalesce(F.col("followers_count"), F.lit(0))
    recip = X.guarded_ratio(following, followers)
    days = X.days_between("last_seen_at", as_of)
    night = X.guarded_ratio(F.coalesce(F.col("night_messages"), F.lit(0)),
                            F.coalesce(F.col("total_messages"), F.lit(0)))
    incomplete = X.null_true_and("profile_bio_missing", "complete_profile_missing")
    out = metrics.select(
        "*",
        X.cap(recip, C.CAP_RECIPROCITY).alias("reciprocity_ratio_norm"),
        X.cap(days, C.CAP_DAYS).alias("days_since_last_seen_norm"),
        night.alias("ratio_night_messages"),
        F.when(incomplete, F.lit(1.0)).otherwise(F.lit(0.0)).alias("is_profile_incomplete"),
        F.lit(0.0).alias("sentiment_negativity_index"),
        X.cap(F.coalesce(F.col("num_community_categories"), F.lit(0)), C.CAP_COMMUNITIES)
        .alias("num_community_categories_norm"))
    if negativity is not None:
        from ..operators.sentiment import join_negativity
        out = join_negativity(out, negativity)
    return out


# ---------------------------------------------------------------- J12, T5, T6, T7

def previous_levels(updates: DataFrame, table: DataFrame, key: str = "user_id_raiz") -> DataFrame:
    """The label stored before this batch writes."""
    prev = table.select(F.col(key).alias("_pk"), F.col("cluster_label").alias("previous_risk"))
    return updates.join(prev, updates[key].cast("string") == prev["_pk"].cast("string"), "left").drop("_pk")


def risk_update_messages(scored: DataFrame) -> DataFrame:
    """USER_RISK_UPDATE rows (+ JSON body)."""
    changed = F.col("previous_risk").isNotNull() & (F.col("previous_risk") != F.col("risk_level"))
    factors = F.array(F.struct(F.col("table").alias("source"), F.lit("update").alias("action")))
    out = scored.select(
        F.col("user_id_raiz").cast("string").alias("user_id"), "risk_level",
        F.round("severity_index", 2).alias("severity_index"), "previous_risk",
        F.coalesce(changed, F.lit(False)).alias("risk_changed"),
        F.col("table").alias("triggering_table"), factors.alias("triggering_factors"),
        F.col("as_of"), F.lit(C.MSG_USER_RISK_UPDATE).alias("type"))
    return out.withColumn("body", F.to_json(F.struct(
        F.col("type"), F.struct("user_id", "risk_level", "severity_index", "previous_risk", "risk_changed",
                                "triggering_factors").alias("payload")), {"ignoreNullFields": "false"}))


def critical_alerts(scored: DataFrame) -> DataFrame:
    """T7 + F20: transition into ALTO_RIESGO (a null previous counts)."""
    into_high = (F.col("risk_level") == C.LEVEL_HIGH) & ~F.col("previous_risk").eqNullSafe(C.LEVEL_HIGH)
    factors = F.array(F.concat(F.lit(C.ALERT_FACTOR_TABLE), F.col("table")),
                      F.concat(F.lit(C.ALERT_FACTOR_PREVIOUS), F.coalesce(F.col("previous_risk"), F.lit("N/A"))),
                      F.concat(F.lit(C.ALERT_FACTOR_CURRENT), F.col("risk_level")))
    out = scored.filter(into_high).select(
        F.col("user_id_raiz").cast("string").alias("user_id"),
        F.when(F.col("severity_index") > C.URGENT_SEVERITY, F.lit(C.PRIORITY_URGENT))
        .otherwise(F.lit(C.PRIORITY_HIGH)).alias("priority"),
        F.round("severity_index", 2).alias("severity_index"), factors.alias("factors"),
        F.lit(C.ALERT_ACTION).alias("suggested_action"), F.lit(C.ALERT_CONTEXT).alias("context"),
        F.col("as_of"), F.lit(C.MSG_CRITICAL_ALERT).alias("type"))
    return out.withColumn("body", F.to_json(F.struct(
        F.col("type"), F.struct("priority", "user_id", "severity_index", "factors", "suggested_action",
                                "context").alias("payload"))))


def route_messages(updates: DataFrame, alerts: DataFrame) -> DataFrame:
    """K5: updates → clustering; alerts → alerts and clustering; server timestamp = as_of."""
    u = updates.select("user_id", "type", "as_of", "body",
                       F.explode(F.array(F.lit(C.CHANNEL_CLUSTERING))).alias("channel"))
    a = alerts.select("user_id", "type", "as_of", "body",
                      F.explode(F.array(F.lit(C.CHANNEL_ALERTS), F.lit(C.CHANNEL_CLUSTERING))).alias("channel"))
    return u.unionByName(a).withColumnRenamed("as_of", "server_timestamp")


def history_order() -> list:
    return [F.col("server_timestamp").desc(), F.col("user_id").desc(), F.col("type").desc()]


def channel_history(messages: DataFrame, n: int = C.HISTORY_MAX, buckets: int | None = None) -> DataFrame:
    """Newest n messages per channel (order: time, user, type).

    Exact two-stage top-n: a channel has only a few keys, so ranking it in
    one window would put the whole channel in one task. Rows are first ranked
    inside salted buckets (keep n each; as many buckets as shuffle partitions,
    so a hot channel uses every task), then the ≤ buckets·n survivors per
    channel are ranked once more.
    """
    buckets = buckets or int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("user_id", "server_timestamp", "type"), F.lit(buckets))
    local = (messages.withColumn("_salt", salt)
             .withColumn("_r", F.row_number().over(Window.partitionBy("channel", "_salt").orderBy(*history_order())))
             .filter(F.col("_r") <= n).drop("_r", "_salt"))
    return (local.withColumn("rank", F.row_number().over(Window.partitionBy("channel").orderBy(*history_order())))
            .filter(F.col("rank") <= n))


def recent_messages(messages: DataFrame, n: int = C.HISTORY_ON_CONNECT) -> DataFrame:
    """Last n per channel, oldest first (rank n … 1)."""
    return channel_history(messages, n).orderBy("channel", F.col("rank").desc())


def risk_transitions(history: DataFrame, key: str = "root_id", partitions: int | None = None) -> DataFrame:
    """Previous level over a per-user history of scored events.

    Skew-safe ``lag``: rows are range-partitioned on (user, time), so one
    user's history may span many partitions; the lag runs inside each
    partition and a partition's first row per user takes the last level of
    that user in the previous partition (a table with ≤ partitions rows per
    user). No task holds a whole hot user.
    """
    order = ["received_at", "event_id"]
    n = partitions or int(history.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # range bounds are sampled per exchange: number the partitions once, in a written copy
    r = checkpoint(history.repartitionByRange(n, key, *order).withColumn("_p", F.spark_partition_id()))
    w = Window.partitionBy(key, "_p").orderBy(*order)
    local = (r.withColumn("previous_level", F.lag("risk_level").over(w))
             .withColumn("_first", F.row_number().over(w) == 1))
    tails = (r.groupBy(key, "_p").agg(F.max_by("risk_level", F.struct(*order)).alias("_tail"))
             .withColumn("_prev_tail", F.lag("_tail").over(Window.partitionBy(key).orderBy("_p")))
             .drop("_tail"))
    out = (local.join(tails, [key, "_p"], "left")
           .withColumn("previous_level", F.when(F.col("_first"), F.col("_prev_tail"))
                       .otherwise(F.col("previous_level")))
           .drop("_p", "_first", "_prev_tail"))
    return out.withColumn("is_transition", ~F.col("previous_level").eqNullSafe(F.col("risk_level")))


# ---------------------------------------------------------------- batch body

def score_changes(src: SourceTables, events: DataFrame, table: DataFrame | K.FeatureTable, resolve_ids: bool = True,
                  scorer=None, metrics: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """T3 over one batch of envelopes. Returns the DataFrames the sinks write.

    ``table`` holds the stored labels; of a ``FeatureTable`` only the buckets of the
    batch's users are read. ``scorer`` (X3) maps the batch features to risk_level +
    severity_index, e.g. ``EnsembleResult.as_scorer()``; default is the T5 heuristic
    (Q18). ``metrics`` gives the metrics of users (root_id) in place of the source
    tables, e.g. ``MaintainedMetrics.of_users``.
    """
    parsed = CH.parse_changes(events)
    valid = CH.with_user(CH.valid_changes(parsed))
    resolved = CH.resolve_users(valid, E.id_map(src) if resolve_ids else None, resolve_ids)
    rejects = CH.rejected_changes(parsed).unionByName(CH.unknown_users(valid, resolved))
    # the batch's users (bounded by the trigger size) feed every semi join below:
    # materialize them once instead of re-deriving parse → resolve → latest per use
    latest = checkpoint(CH.latest_per_user(resolved).select("root_id", "table", "event_id",
                                                            F.col("received_at").alias("as_of")))
    found = (metrics or partial(affected_user_metrics, src))(latest.select("root_id"))
    m = found.join(latest, found["user_id_raiz"].cast("string") == latest["root_id"].cast("string"), "inner").drop("root_id")
    feats = incremental_features(m, F.col("as_of"))
    if scorer is None:
        scored = R.heuristic_risk(feats)
    else:
        s = scorer(feats).select("user_id_raiz", "risk_level", "severity_index")
        scored = feats.join(s, "user_id_raiz")
    stored = table.of_users(latest, "root_id") if isinstance(table, K.FeatureTable) else table
    scored = previous_levels(scored, stored)
    updates = scored.select(
        "user_id_raiz", F.col("as_of").alias("extraction_date"), "reciprocity_ratio_norm",
        "days_since_last_seen_norm", "ratio_night_messages",
        (F.col("is_profile_incomplete") > 0.5).alias("is_profile_incomplete"),
        "sentiment_negativity_index", "num_community_categories_norm",
        F.col("risk_level").alias("cluster_label"))
    msgs = risk_update_messages(scored)
    alerts = critical_alerts(scored)
    return {"parsed": parsed, "rejects": rejects, "resolved": resolved, "scored": scored,
            "updates": updates, "messages": route_messages(msgs, alerts), "risk_updates": msgs,
            "alerts": alerts}


def _read_if_written(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


@dataclass
class StreamSinks:
    """Where the stream writes: feature table, messages, rejects."""
    spark: SparkSession
    root: str
    features: K.FeatureTable = field(init=False)
    newest: BucketTable = field(init=False)

    def __post_init__(self):
        self.features = K.FeatureTable(self.spark, f"{self.root}/features")
        self.newest = BucketTable(self.spark, f"{self.root}/newest", "channel", buckets=1)

    @property
    def messages_path(self) -> str:
        return f"{self.root}/messages"

    def update_history(self, messages: DataFrame, batch_id: int, n: int = C.HISTORY_MAX) -> None:
        """The newest n messages of every channel, from the last ones and the batch's."""
        def combine(current: DataFrame | None, new: DataFrame, _) -> DataFrame:
            new = new.withColumn("part", F.lit(None).cast("string"))
            both = new if current is None else current.unionByName(new)
            return channel_history(both, n, buckets=1).drop("rank")  # at most n + n rows of a channel

        batch = channel_history(messages, n).select("channel", "user_id", "type", "server_timestamp", "body")
        self.newest.merge(checkpoint(batch), combine, STREAM, batch_id)

    def history(self, n: int = C.HISTORY_MAX) -> DataFrame:
        """The newest n messages of every channel, ranked; the log isn't read."""
        rows = self.newest.read()
        if rows is None:
            rows = self.spark.createDataFrame([], "channel string, user_id string, type string, server_timestamp timestamp, body string")
        return channel_history(rows, n, buckets=1)

    def _compacted(self) -> DataFrame | None:
        return _read_if_written(self.spark, f"{self.root}/messages_old")

    def messages(self) -> DataFrame:
        """The whole message log: folded batches and those after them."""
        columns = ["channel", "user_id", "type", "server_timestamp", "body"]
        old, new = self._compacted(), _read_if_written(self.spark, self.messages_path)
        if old is not None and new is not None:
            new = new.filter(F.col("batch_id") > old.agg(F.max("upto")).first()[0])
        parts = [p.select(*columns) for p in (old, new) if p is not None]
        none = "channel string, user_id string, type string, server_timestamp timestamp, body string"
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], none)

    def compact_messages(self, upto: int) -> None:
        """Fold the log's batches up to one into a few files for each channel, and remove
        their folders. Cut short after the write, the next call removes the rest."""
        old, new = self._compacted(), _read_if_written(self.spark, self.messages_path)
        done = -1 if old is None else old.agg(F.max("upto")).first()[0]
        if new is None:
            return
        batches = [r[0] for r in new.filter(F.col("batch_id") <= upto).select("batch_id").distinct().collect()]
        fresh = new.filter((F.col("batch_id") > done) & (F.col("batch_id") <= upto))
        if any(b > done for b in batches):
            (fresh.withColumn("upto", F.lit(upto)).drop("batch_id").repartition("channel", F.pmod(F.xxhash64("user_id"), F.lit(4)))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("upto", "channel")
             .parquet(f"{self.root}/messages_old"))
        for b in batches:
            remove(self.spark, f"{self.messages_path}/batch_id={b}")

    @property
    def rejects_path(self) -> str:
        return f"{self.root}/rejects"


#: Name of the stream's commits in the feature table; loads have other names.
STREAM = "stream"


def make_batch_fn(src: SourceTables, sinks: StreamSinks, resolve_ids: bool = True, scorer=None, metrics=None):
    """foreachBatch body with replay safety: a batch of this stream that the feature table
    holds is skipped. Loads into the same table don't count as batches."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= sinks.features.last_batch(STREAM):
            return
        batch = batch.persist()
        out = score_changes(src, batch, sinks.features, resolve_ids, scorer, metrics)
        # three writes below share the scored users (cache lookup matches the subplan)
        out["scored"].persist()
        # messages and rejects first (overwrite their batch partition: idempotent), table commit last
        (out["messages"].withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "channel")
         .parquet(sinks.messages_path))
        (out["rejects"].withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sinks.rejects_path))
        sinks.update_history(out["messages"], batch_id)
        sinks.features.upsert(out["updates"], STREAM, batch_id)
        out["scored"].unpersist()
        batch.unpersist()
    return run


def run_stream(spark: SparkSession, src: SourceTables, input_path: str, root: str, checkpoint: str,
               initial: DataFrame | None = None, fmt: str = "parquet", max_files: int | None = 1,
               resolve_ids: bool = True, scorer=None, metrics=None) -> StreamSinks:
    """S6 → foreachBatch(T3) with an availableNow trigger; returns the sinks."""
    sinks = StreamSinks(spark, root)
    if initial is not None and not sinks.features.exists():
        rows = K.conform(initial)
        sinks.features.reload(rows, next_id=(rows.agg(F.max("id")).first()[0] or 0) + 1)
    stream = CH.change_stream(spark, input_path, fmt, max_files)
    q = (stream.writeStream.foreachBatch(make_batch_fn(src, sinks, resolve_ids, scorer, metrics))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return sinks


# ---------------------------------------------------------------- T9 streaming form

def readable_changes(parsed: DataFrame) -> DataFrame:
    return (parsed.filter(~F.col("is_malformed") & F.col("event_time").isNotNull())
            .select("source", "event_id", "table", "event_time"))


def distinct_changes(parsed: list[DataFrame], delay: str) -> DataFrame:
    """Readable events of some sources, each id of a source once; events behind the
    watermark are dropped. Every source has a watermark of its own and the least one
    holds (Spark's default for several), so a source that lags loses nothing. Spark
    keeps the ids in its state store until the watermark has passed them."""
    marked = [readable_changes(p).withWatermark("event_time", delay) for p in parsed]
    return reduce(DataFrame.unionByName, marked).dropDuplicatesWithinWatermark(["source", "event_id"])


def windowed_change_counts(parsed: list[DataFrame], duration: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Tumbling-window counts of distinct changes, in Spark's state store. In update
    mode a trigger gives the new totals of the windows it changed."""
    return (distinct_changes(parsed, delay).groupBy(F.window("event_time", duration).alias("w"), "table")
            .agg(F.count(F.lit(1)).alias("n_changes"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "table", "n_changes"))


@dataclass
class WindowOutputs:
    """What the window stream writes: totals per window, counted ids, late events."""
    spark: SparkSession
    root: str
    totals: BucketTable = field(init=False)

    def __post_init__(self):
        self.totals = BucketTable(self.spark, f"{self.root}/totals", "window_key", buckets=8)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def counts(self) -> DataFrame:
        """(window_start, window_end, table, n_changes): distinct events per window."""
        rows = self.totals.read()
        if rows is None:
            return self.spark.createDataFrame([], "window_start timestamp, window_end timestamp, table string, n_changes long")
        return rows.drop("window_key")

    def events(self, name: str) -> DataFrame:
        """``counted`` or ``late`` events (source, event_id, table, event_time, day, batch_id)."""
        schema = "source string, event_id long, table string, event_time timestamp, day date, batch_id long"
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # nothing written yet
                raise
            return self.spark.createDataFrame([], schema)

    def late(self) -> DataFrame:
        return self.events("late")

    def write(self, events: DataFrame, name: str, batch_id: int) -> None:
        """Replace this batch's rows: a replayed batch leaves the output as it was."""
        rows = events.select("source", "event_id", "table", "event_time", F.to_date("event_time").alias("day"),
                             F.lit(batch_id).cast("long").alias("batch_id"))
        (rows.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch_id").parquet(self.path(name)))


def _replace_totals(current: DataFrame | None, changed: DataFrame, _) -> DataFrame:
    new = changed.withColumn("part", F.lit(None).cast("string"))
    if current is None:
        return new
    return current.join(changed.select("window_key"), "window_key", "left_anti").unionByName(new)


def window_batch(out: WindowOutputs):
    """foreachBatch body of ``run_window_counts``: a micro-batch holds every event as it
    came (kind raw), the distinct ones that were counted, and the totals they changed."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        kind = {k: batch.filter(F.col("kind") == k) for k in ("raw", "counted", "total")}
        totals = kind["total"].select(F.concat_ws("|", F.col("window_start").cast("string"), F.col("table")).alias("window_key"),
                                      "window_start", "window_end", "table", "n_changes")
        out.totals.merge(totals, _replace_totals, "windows", batch_id)
        out.write(kind["counted"], "counted", batch_id)
        # what wasn't counted now is late, unless it was counted (or late) in an earlier batch
        ids = ["source", "event_id"]
        # ids grow with the events: they are shuffled, never sent to the driver to be broadcast
        rest = kind["raw"].dropDuplicates(ids).join(kind["counted"].select(*ids).hint("merge"), ids, "left_anti")
        days = [r[0] for r in rest.select(F.to_date("event_time")).distinct().collect()]  # a few, whatever the batch
        for name in ("counted", "late"):
            known = out.events(name).filter(F.col("day").isin(*days) & (F.col("batch_id") < batch_id))
            rest = rest.join(known.select(*ids).hint("merge"), ids, "left_anti")
        out.write(rest, "late", batch_id)
        batch.unpersist()
    return run


def run_window_counts(spark: SparkSession, input_path: str | dict[str, str], root: str, checkpoint: str,
                      max_files: int | None = None, duration: str = "1 hour", delay: str = "10 minutes") -> WindowOutputs:
    """T9 end to end in one query over a file stream, or one for each source by name:
    counts + late events = distinct events. Watermark, seen ids and window totals are
    Spark's state; the side output is checked against the counted ids of the late
    events' days."""
    out = WindowOutputs(spark, root)
    streams = (CH.change_streams(spark, input_path, max_files=max_files).values() if isinstance(input_path, dict)
               else [CH.change_stream(spark, input_path, max_files=max_files)])
    parsed = [CH.parse_changes(s) for s in streams]
    raw = reduce(DataFrame.unionByName, [readable_changes(p) for p in parsed])
    parts = {"raw": raw, "counted": distinct_changes(parsed, delay), "total": windowed_change_counts(parsed, duration, delay)}
    both = None
    for kind, rows in parts.items():
        rows = rows.withColumn("kind", F.lit(kind))
        both = rows if both is None else both.unionByName(rows, allowMissingColumns=True)
    q = (both.writeStream.outputMode("update").foreachBatch(window_batch(out))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out


# ---------------------------------------------------------------- T10

def transition_schema(events: DataFrame) -> T.StructType:
    """Output of T10: the id columns keep the types of the events. ``is_first``: nothing
    was known of the user; ``is_late``: older than what was known."""
    return T.StructType([
        T.StructField("root_id", events.schema["root_id"].dataType),
        T.StructField("event_id", events.schema["event_id"].dataType),
        T.StructField("received_at", T.TimestampType()), T.StructField("risk_level", T.StringType()),
        T.StructField("previous_level", T.StringType()), T.StructField("is_transition", T.BooleanType()),
        T.StructField("is_first", T.BooleanType()), T.StructField("is_late", T.BooleanType()),
    ])


def _transitions(key, pdfs, state, idle_ms: int | None):
    """The rows of one user in a trigger, in order, against the state: last level, time and id."""
    if state.hasTimedOut:
        state.remove()
        return
    # most users have a few rows: plain values, as each call of pandas costs more than they do
    parts = list(pdfs)
    rows = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
    if len(rows) > 1:
        rows = rows.sort_values(["received_at", "event_id"])
    at, ids = rows["received_at"].tolist(), rows["event_id"].tolist()
    level = [v if isinstance(v, str) else None for v in rows["risk_level"].tolist()]
    known = state.get if state.exists else None
    last = None if known is None else (pd.Timestamp(known[1]), known[2])
    late = [last is not None and (t, i) <= last for t, i in zip(at, ids)]
    first = len(late) if all(late) else late.index(False)  # late rows come first
    previous = [None] * first + [None if known is None else known[0], *level[first:-1]][:len(level) - first]
    if first < len(level):
        state.update((level[-1], at[-1].to_pydatetime(), int(ids[-1])))
    if idle_ms is not None:
        newest = pd.Timestamp(state.get[1])
        state.setTimeoutTimestamp(max(int(newest.value // 10**6) + idle_ms, state.getCurrentWatermarkMs() + 1))
    changed = [None] * first + [p != v for p, v in zip(previous[first:], level[first:])]
    yield pd.DataFrame({"root_id": rows["root_id"].array, "event_id": rows["event_id"].array, "received_at": rows["received_at"].array,
                        "risk_level": level, "previous_level": previous, "is_transition": changed,
                        "is_first": [known is None and k == first for k in range(len(level))], "is_late": late})


def stateful_transitions(scored_events: DataFrame, idle: str | None = None, delay: str = "0 seconds") -> DataFrame:
    """Keyed transition detector (state = last level per user) for streams. With
    ``idle`` (in event time) the state of users without events for so long is dropped:
    it is bounded by the active users."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    schema = transition_schema(scored_events)
    if idle is not None:
        scored_events = scored_events.withWatermark("received_at", delay)
    idle_ms = None if idle is None else int(pd.Timedelta(idle).total_seconds() * 1000)

    def run(key, pdfs, state):
        return _transitions(key, pdfs, state, idle_ms)

    state = T.StructType([T.StructField("last_level", T.StringType()), T.StructField("last_at", T.TimestampType()),
                          T.StructField("last_id", T.LongType())])
    return (scored_events.select("root_id", "event_id", "received_at", "risk_level")
            .groupBy("root_id")
            .applyInPandasWithState(run, schema, state, "append",
                                    GroupStateTimeout.NoTimeout if idle is None else GroupStateTimeout.EventTimeTimeout))


def run_transitions(scored_stream: DataFrame, root: str, checkpoint_path: str, idle: str, delay: str = "0 seconds") -> DataFrame:
    """T10 end to end with bounded state: the last level of every user is also kept in a
    table, where a user that comes back after its state was dropped finds it. Late rows,
    also those that Spark drops behind the watermark, are written with ``is_late`` and no
    previous level. Returns what was written."""
    spark = scored_stream.sparkSession
    last = BucketTable(spark, f"{root}/last", "root_id", buckets=8)
    columns = [f.name for f in transition_schema(scored_stream).fields]

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = checkpoint(batch)  # the state is asked once
        rows = batch.filter("NOT raw").drop("raw")
        dropped = batch.filter("raw").drop("raw").dropDuplicates(["root_id", "event_id"]).join(
            rows.select("root_id", "event_id"), ["root_id", "event_id"], "left_anti")
        stored = last.read_keys(rows.filter("is_first"), "root_id")
        if stored is not None:
            stored = stored.select("root_id", "last_level", "last_at", "last_id")
            rows = rows.join(stored, "root_id", "left")
            # a first row older than what is stored is late after all
            old = F.col("is_first") & (F.struct("received_at", "event_id") <= F.struct("last_at", "last_id"))
            back = F.col("is_first") & F.col("last_at").isNotNull() & ~old
            rows = rows.withColumns({
                "previous_level": F.when(back, F.col("last_level")).otherwise(F.col("previous_level")),
                "is_transition": F.when(back, ~F.col("last_level").eqNullSafe(F.col("risk_level"))).when(old, None).otherwise(F.col("is_transition")),
                "is_late": F.coalesce(old, F.lit(False)) | F.col("is_late")})
        rows = checkpoint(rows.select(*columns).unionByName(dropped.select(*columns)))
        (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{root}/transitions"))
        newest = rows.filter("NOT is_late").groupBy("root_id").agg(F.max_by(F.struct("risk_level", "received_at", "event_id"),
                                                                           F.struct("received_at", "event_id")).alias("l"))
        newest = newest.select("root_id", F.col("l.risk_level").alias("last_level"), F.col("l.received_at").alias("last_at"),
                               F.col("l.event_id").alias("last_id"))

        def combine(current: DataFrame | None, new: DataFrame, _) -> DataFrame:
            new = new.withColumn("part", F.lit(None).cast("string"))
            return new if current is None else current.join(new.select("root_id"), "root_id", "left_anti").unionByName(new)

        last.merge(newest, combine, STREAM, batch_id)

    found = stateful_transitions(scored_stream, idle, delay).withColumn("raw", F.lit(False))
    raw = scored_stream.select("root_id", "event_id", "received_at", "risk_level", F.lit(None).cast("string").alias("previous_level"),
                               F.lit(None).cast("boolean").alias("is_transition"), F.lit(False).alias("is_first"),
                               F.lit(True).alias("is_late"), F.lit(True).alias("raw"))
    q = (found.unionByName(raw).writeStream.foreachBatch(write)
         .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{root}/transitions").select(*columns)
