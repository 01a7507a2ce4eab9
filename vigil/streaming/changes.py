"""Change events: S6, T1, T2, P17, J9, W3, T9.

An event is an envelope (event_id, source, channel, received_at, payload)
whose payload is the JSON object the row-change capture emits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C

# Ids are text: the sources use UUIDs as well as numbers.
PAYLOAD_ID_COLUMNS = ["message_id", "post_id", "comment_id", "profile_id", "community_id"]
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("operation", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("message_id", T.StringType()),
    T.StructField("field_changed", T.StringType()),
    T.StructField("post_id", T.StringType()),
    T.StructField("comment_id", T.StringType()),
    T.StructField("profile_id", T.StringType()),
    T.StructField("community_id", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("received_at", T.TimestampType()),
    T.StructField("payload", T.StringType()),
])

REJECT_JSON, REJECT_TIMESTAMP, REJECT_USER = "malformed_json", "unreadable_timestamp", "unknown_user"

# Which id space each captured table's user_id is in.
TABLE_ID_SPACE = {
    "messages": "messaging",
    "users": "profile",
    "community_members": "profile",
    "user_profiles": "root",
    "posts": "root",
    "comments": "root",
}


def change_stream(spark: SparkSession, path: str, fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A file-backed change stream (JSON lines or parquet envelopes)."""
    r = spark.readStream.schema(ENVELOPE_SCHEMA).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def change_streams(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet",
                   max_files: int | None = None) -> dict[str, DataFrame]:
    """One stream for each source, by its name, which its events carry. Event ids
    count within their source."""
    return {name: change_stream(spark, path, fmt, max_files).withColumn("source", F.lit(name)) for name, path in paths.items()}


def kafka_change_stream(spark: SparkSession, servers: str, topic: str, source: str) -> DataFrame:
    """S6 over Kafka (production): value = payload, timestamp = received_at.
    Needs the Kafka connector on the classpath; not exercised in tests."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).load())
    return raw.select(F.col("offset").alias("event_id"), F.lit(source).alias("source"),
                      F.lit(C.CHANGE_CHANNEL).alias("channel"), F.col("timestamp").alias("received_at"),
                      F.col("value").cast("string").alias("payload"))


def parse_changes(events: DataFrame) -> DataFrame:
    """T1 + F14: decode the payload. What can't be read never raises: ``reject_reason``
    says why a row goes to the rejects (T2), ``is_malformed`` that it does."""
    p = F.from_json(F.col("payload"), PAYLOAD_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    out = events.withColumn("_p", p).withColumn("_at", F.try_to_timestamp(F.col("_p.timestamp")))
    reason = (F.when(F.col("_p").isNull() | F.col("_p._corrupt").isNotNull(), F.lit(REJECT_JSON))
              .when(F.col("_p.timestamp").isNotNull() & F.col("_at").isNull(), F.lit(REJECT_TIMESTAMP)))
    return out.select(
        "event_id", "source", "channel", F.col("received_at").cast("timestamp").alias("received_at"), "payload",
        F.col("_p.table").alias("table"), F.col("_p.operation").alias("operation"),
        F.col("_p.user_id").alias("user_id"),
        F.col("_at").alias("event_time"),
        F.col("_p.field_changed").alias("field_changed"),
        *[F.col(f"_p.{c}").alias(c) for c in PAYLOAD_ID_COLUMNS],
        reason.isNotNull().alias("is_malformed"), reason.alias("reject_reason"))


def valid_changes(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("is_malformed"))


def _rejects(changes: DataFrame, reason: Column) -> DataFrame:
    return changes.select("event_id", "source", "channel", "received_at", "payload", reason.alias("reason"))


def rejected_changes(parsed: DataFrame) -> DataFrame:
    """T2 reject output: unreadable payloads and timestamps (the reference printed and
    dropped these)."""
    return _rejects(parsed.filter(F.col("is_malformed")), F.col("reject_reason"))


def with_user(parsed: DataFrame) -> DataFrame:
    """Drop events without a user id, null or empty."""
    return parsed.filter(F.col("user_id") != "")


def unknown_users(changes: DataFrame, resolved: DataFrame) -> DataFrame:
    """Rejects of the events whose user id no id space knows."""
    known = resolved.select("event_id").distinct()
    return _rejects(changes.join(known, "event_id", "left_anti"), F.lit(REJECT_USER))


def id_lookup(id_map: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """J9 in long form: (space, id as text, root_id) for the three id spaces."""
    spaces = {"root": "root_id", "profile": "profile_id", "messaging": "messaging_id"}
    return (id_map.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("space"), F.col(c).cast("string").alias("id"), F.col("root_id").alias("root_id"))
        for s, c in spaces.items()])))
        .filter(F.col("id").isNotNull()).transform(
            lambda d: d if wanted is None else d.join(wanted, ["space", "id"], "left_semi"))
        .dropDuplicates(["space", "id"]))


def space_of(table_col) -> F.Column:
    """Id space of a captured table (TABLE_ID_SPACE)."""
    return (F.when(table_col == "messages", F.lit("messaging"))
            .when(table_col.isin("users", "community_members"), F.lit("profile"))
            .otherwise(F.lit("root")))


def resolve_users(changes: DataFrame, id_map: DataFrame | None, resolve_ids: bool = True) -> DataFrame:
    """Map each event's user id to the root id through its table's id space.
    ``resolve_ids=False`` takes the payload id as the root id (reference behaviour)."""
    if not resolve_ids or id_map is None:
        return changes.withColumn("root_id", F.col("user_id"))
    ch = changes.withColumn("_space", space_of(F.col("table")))
    # cut the id map down to the ids of these changes before it is de-duplicated
    wanted = ch.select(F.col("_space").alias("space"), F.col("user_id").alias("id")).distinct()
    lk = id_lookup(id_map, wanted)
    return (ch.join(lk, (ch["_space"] == lk["space"]) & (ch["user_id"] == lk["id"]), "inner")
            .drop("_space", "space", "id"))


def latest_per_user(changes: DataFrame, key: str = "root_id") -> DataFrame:
    """The newest event per user (received_at, then event id) — one groupBy, no window."""
    cols = [c for c in changes.columns if c != key]
    order = F.struct(F.col("received_at"), F.col("event_id"))
    return (changes.groupBy(key)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_l"),
                 F.count(F.lit(1)).alias("n_events"))
            .select(key, "_l.*", "n_events"))


def changes_per_window(changes: DataFrame, duration: str = "1 hour", ts: str = "event_time") -> DataFrame:
    """Change counts per table in tumbling event-time windows."""
    return (changes.groupBy(F.window(F.col(ts).cast("timestamp"), duration).alias("w"), F.col("table"))
            .agg(F.count(F.lit(1)).alias("n_changes"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "table", "n_changes"))
