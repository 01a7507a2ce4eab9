"""Extraction: S1–S5, P1–P7, J1–J4, J9, U1, A1–A4.

Every aggregate runs before its join (partial + final aggregation keyed by
the join key, so the join reuses that partitioning and never sees a hot
key with more than one row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import expressions as X
from ..operators.joins import salts
from .tables import SourceTables


def community_stats(src: SourceTables, with_volunteer: bool = True) -> DataFrame:
    """J2 + A1 + A2: per member, distinct categories and the volunteering flag."""
    cm = src["community_members"].select(F.col("user_id").alias("member_id"), "community_id")
    comm = src["communities"].select(F.col("id").alias("community_id"), "category")
    # communities is a dimension table; AQE broadcasts it when its runtime
    # size is under spark.sql.autoBroadcastJoinThreshold, else sort-merge.
    j = cm.join(comm, "community_id", "inner")
    aggs = [F.count_distinct("category").alias("distinct_categories")]
    if with_volunteer:
        aggs.append((F.max(F.when(F.col("category") == C.VOLUNTEER_CATEGORY, 1).otherwise(0)) == 1)
                    .alias("is_in_voluntariado"))
    return j.groupBy("member_id").agg(*aggs)


def social_metrics(src: SourceTables, with_volunteer: bool = True) -> DataFrame:
    """One row per active profile."""
    up = src["user_profiles"].filter(F.col("is_active") == F.lit(True))
    # Distinct keys so duplicate complete_profiles rows never fan out.
    cp = src["complete_profiles"].select(F.col("user_id").alias("cp_user_id")).distinct()
    stats = community_stats(src, with_volunteer)
    j = (up.join(cp, up["id"] == cp["cp_user_id"], "left")
           .join(stats, up["id"] == stats["member_id"], "left"))
    cols = [
        F.col("user_id").alias("user_id_raiz"),
        F.col("id").alias("profile_id_social"),
        F.col("followers_count"),
        F.col("following_count"),
        F.col("bio").isNull().alias("profile_bio_missing"),
        F.col("cp_user_id").isNull().alias("complete_profile_missing"),
        F.coalesce(F.col("distinct_categories"), F.lit(0)).cast("long").alias("num_community_categories"),
    ]
    if with_volunteer:
        cols.append(F.coalesce(F.col("is_in_voluntariado"), F.lit(False)).alias("comm_voluntariado_one_hot"))
    return j.select(*cols)


def message_stats(messages: DataFrame) -> DataFrame:
    """A3 + A4 over non-deleted messages (P3), keyed by sender."""
    return (messages.filter(F.col("is_deleted") == F.lit(False))
            .groupBy("sender_profile_id")
            .agg(F.count(F.lit(1)).alias("total_messages"),
                 F.count_if(X.night_flag("created_at")).alias("night_messages")))


def messaging_metrics(src: SourceTables, with_messaging_id: bool = False, stats: DataFrame | None = None) -> DataFrame:
    """One row per active messaging user (J4). ``stats``: message counts by sender
    that are there already."""
    u = src["users"].filter(F.col("is_active") == F.lit(True))
    ms = message_stats(src["messages"]) if stats is None else stats
    j = u.join(ms, u["id"] == ms["sender_profile_id"], "left")
    cols = [
        F.col("profile_id"),
        F.col("last_seen_at"),
        F.coalesce(F.col("total_messages"), F.lit(0)).cast("long").alias("total_messages"),
        F.coalesce(F.col("night_messages"), F.lit(0)).cast("long").alias("night_messages"),
    ]
    if with_messaging_id:
        cols.insert(0, F.col("id").alias("messaging_id"))
    return j.select(*cols)


def id_map(src: SourceTables) -> DataFrame:
    """Root id ↔ social profile id ↔ messaging id."""
    up = src["user_profiles"].select(F.col("user_id").alias("root_id"), F.col("id").alias("profile_id"))
    u = src["users"].select(F.col("id").alias("messaging_id"), F.col("profile_id").alias("u_profile_id"))
    return (up.join(u, up["profile_id"] == u["u_profile_id"], "left")
              .select("root_id", "profile_id", "messaging_id"))


def text_sources(src: SourceTables) -> dict[str, DataFrame]:
    """P4 + P5 per source: (user_id, content, source); ids in the source's own space."""
    posts = (src["posts"].filter(F.col("content").isNotNull() & (F.col("is_active") == F.lit(True)))
             .select(F.col("user_id"), F.col("content"), F.lit("post").alias("source")))
    comments = (src["comments"].filter(F.col("content").isNotNull() & (F.col("is_active") == F.lit(True)))
                .select(F.col("user_id"), F.col("content"), F.lit("comment").alias("source")))
    messages = (src["messages"].filter(F.col("content").isNotNull() & (F.col("is_deleted") == F.lit(False)))
                .select(F.col("sender_profile_id").alias("user_id"), F.col("content"),
                        F.lit("message").alias("source")))
    return {"post": posts, "comment": comments, "message": messages}


def text_corpus(src: SourceTables, resolve_ids: bool = True) -> DataFrame:
    """S3 + U1: all texts, UNION ALL, no dedupe.

    ``resolve_ids`` (D1) maps message senders from messaging ids to root ids;
    ``False`` keeps the reference's raw sender id.
    """
    parts = text_sources(src)
    messages = parts["message"]
    if resolve_ids:
        # texts of one sender are spread over tasks; the narrow id map is repeated
        n = salts(messages.sparkSession)
        m = (id_map(src).filter(F.col("messaging_id").isNotNull())
             .select("messaging_id", "root_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_part")))
        dealt = messages.withColumn("_salt", F.pmod(F.xxhash64("content"), F.lit(n)).cast("int"))
        messages = (dealt.join(m, (dealt["user_id"] == m["messaging_id"]) & (dealt["_salt"] == m["_part"]), "left")
                    .select(F.col("root_id").alias("user_id"), "content", "source"))
    return parts["post"].unionByName(parts["comment"]).unionByName(messages)


def extraction(src: SourceTables, resolve_ids: bool = True) -> dict[str, DataFrame]:
    """The three extracts, lazy."""
    return {
        "social_metrics": social_metrics(src),
        "messaging_metrics": messaging_metrics(src),
        "text_content": text_corpus(src, resolve_ids),
    }


def extraction_row_counts(bundle: dict[str, DataFrame]) -> DataFrame:
    """S4 row counts as one small DataFrame (one global count per extract)."""
    out = None
    for name, df in bundle.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


def feature_scan(table) -> DataFrame:
    """Full scan of the feature table."""
    return table.read()
