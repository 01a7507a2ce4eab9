"""Per-user metrics kept up to date from row changes (J7, P12 without source scans).

The stream asks for the metrics of a few users per micro-batch. Computed from the
source tables that scans them whole; here every table the metrics need is kept by
the key the next lookup has, and row changes (before and after image) are merged
into the buckets they touch:

* messages, memberships and complete profiles as counts: an after image adds to
  its key, a before image takes away again, so updates and deletes need no rescan;
* profiles, messaging users and communities as their newest row, a deleted one
  marked as gone.

A lookup goes root id → profile → memberships, messaging user → message counts and
reads only the buckets of the ids at hand. Every table remembers the last change
batch it took, so a batch that is delivered again, or was cut short between two
tables, is completed and never applied twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators.bucket_table import BUCKETS, MERGED, BucketTable
from ..session import checkpoint
from ..sources import extract as E
from ..sources.tables import SourceTables

#: Tables kept as their newest rows: columns that tell a row, the first of them the key
#: of the lookup, and the other columns.
KEYED = {
    "user_profiles": (["user_id", "id"], ["followers_count", "following_count", "bio", "is_active"]),
    "users": (["profile_id", "id"], ["last_seen_at", "is_active"]),
    "communities": (["id"], ["category"]),
}
#: Tables kept as counts: key of the lookup and columns that are counted apart.
COUNTED = {
    "messages": ("sender_profile_id", ["sender_profile_id"]),
    "community_members": ("user_id", ["user_id", "community_id"]),
    "complete_profiles": ("user_id", ["user_id"]),
}
MESSAGE_COLUMNS = ["sender_profile_id", "created_at", "is_deleted"]
WRITER = "changes"


def _measures(table: str) -> dict[str, Column]:
    """What one row adds to its key."""
    if table != "messages":
        return {"n": F.lit(1)}
    counts = F.col("is_deleted") == F.lit(False)
    return {"total_messages": F.when(counts, 1).otherwise(0),
            "night_messages": F.when(counts & X.night_flag("created_at"), 1).otherwise(0)}


def _counts(table: str, rows: DataFrame, sign: int = 1) -> DataFrame:
    """Counts of rows by the table's columns; rows without a key count nowhere."""
    key, columns = COUNTED[table]
    return rows.filter(F.col(key).isNotNull()).groupBy(*columns).agg(
        *[F.sum(m * sign).cast("long").alias(name) for name, m in _measures(table).items()])


def _add(table: str, current: DataFrame | None, delta: DataFrame, parts: tuple[str, ...] = (MERGED,)) -> DataFrame:
    # a row's part goes through the aggregation as a number, not as the text
    known = F.array(*[F.lit(p) for p in sorted(parts)])
    delta = delta.withColumn("part", F.lit(None).cast("long"))
    both = delta if current is None else current.withColumn("part", F.array_position(known, F.col("part"))).select(*delta.columns).unionByName(delta)
    names = list(_measures(table))
    out = both.groupBy(*COUNTED[table][1]).agg(*[F.sum(n).cast("long").alias(n) for n in names], F.max("part").alias("part"))
    # element_at alone takes a null place for some element
    return out.withColumn("part", F.when(F.col("part").isNotNull(), F.element_at(known, F.col("part").cast("int"))))


class MaintainedMetrics:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        keys = {t: key for t, (key, _) in COUNTED.items()} | {t: row[0] for t, (row, _) in KEYED.items()}
        self.spark = spark
        self.tables = {t: BucketTable(spark, f"{root}/{t}", key, buckets) for t, key in keys.items()}

    def bootstrap(self, src: SourceTables) -> None:
        """Start from full source tables: the only scan of them."""
        for t, (keys, columns) in KEYED.items():
            rows = src[t].filter(F.col(keys[0]).isNotNull()).select(*keys, *columns, F.lit(False).alias("gone"))
            self.tables[t].reload(rows)
        for t in COUNTED:
            self.tables[t].reload(_counts(t, src[t]))

    def apply(self, changes: dict[str, DataFrame], batch_id: int) -> None:
        """Merge one batch of row changes: for each table (seq, before, after), the
        images as structs of the table's columns, null where there is no row."""
        for t, rows in changes.items():
            (self._apply_counted if t in COUNTED else self._apply_keyed)(t, rows, batch_id)

    def _apply_counted(self, t: str, rows: DataFrame, batch_id: int) -> None:
        images = [_counts(t, rows.filter(F.col(image).isNotNull()).select(f"{image}.*"), sign)
                  for image, sign in (("before", -1), ("after", 1))]
        # one row for each key of the batch, whatever the number of its changes
        delta = checkpoint(_add(t, None, images[0].unionByName(images[1])).drop("part"))
        self.tables[t].merge(delta, lambda current, d, st: _add(t, current, d, st.parts), WRITER, batch_id)

    def _apply_keyed(self, t: str, rows: DataFrame, batch_id: int) -> None:
        keys, columns = KEYED[t]

        def images(image: str, gone: bool) -> DataFrame:
            return rows.filter(F.col(f"{image}.{keys[0]}").isNotNull()).select(
                *[F.col(f"{image}.{k}").alias(k) for k in keys], "seq", F.lit(gone).alias("gone"),
                *[F.col(f"{image}.{c}").alias(c) for c in columns])

        # of several changes of a row the last one holds; an after image beats the before image
        # of the same change, so only rows that moved or were deleted are gone
        last = F.max_by(F.struct("gone", *columns), F.struct("seq", ~F.col("gone"))).alias("last")
        last = images("after", False).unionByName(images("before", True)).groupBy(*keys).agg(last)
        last = checkpoint(last.select(*keys, *[F.col(f"last.{c}").alias(c) for c in (*columns, "gone")]))

        def same(a: DataFrame, b: DataFrame) -> Column:
            return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])

        def combine(current: DataFrame | None, changed: DataFrame, _) -> DataFrame:
            if current is None:
                return changed.withColumn("part", F.lit(None).cast("string"))
            stay = current.join(changed, same(current, changed), "left_anti")
            place = current.select(*keys, "part").alias("place")
            moved = changed.join(place, reduce(lambda x, y: x & y, [changed[k].eqNullSafe(F.col(f"place.{k}")) for k in keys]), "left")
            return stay.unionByName(moved.select(*[changed[c] for c in changed.columns], "part"))

        self.tables[t].merge(last, combine, WRITER, batch_id)

    # ------------------------------------------------------------------ lookups

    def _of(self, t: str, keys: DataFrame, key: str, empty: str) -> DataFrame:
        """Rows of a table for some keys; of a keyed table those that exist, of a counted
        one those that count."""
        rows = self.tables[t].read_keys(keys, key)
        if rows is None:
            return self.spark.createDataFrame([], empty)
        if t in KEYED:
            return rows.filter(~F.col("gone")).drop("gone")
        return rows if t == "messages" else rows.filter(F.col("n") > 0).drop("n")

    def of_users(self, roots: DataFrame) -> DataFrame:
        """The metrics of users (root_id) as ``affected_user_metrics`` gives them. Lookups
        are written out between the steps: each is bounded by the users asked for."""
        profiles = checkpoint(self._of("user_profiles", roots, "root_id",
                                       "user_id long, id long, followers_count long, following_count long, bio string, is_active boolean"))
        members = checkpoint(self._of("community_members", profiles, "id", "user_id long, community_id long"))
        users = checkpoint(self._of("users", profiles, "id", "profile_id long, id long, last_seen_at timestamp, is_active boolean"))
        src = SourceTables({
            "user_profiles": profiles, "community_members": members, "users": users,
            "complete_profiles": self._of("complete_profiles", profiles, "id", "user_id long"),
            "communities": self._of("communities", members, "community_id", "id long, category string")})
        sent = self._of("messages", users, "id", "sender_profile_id long, total_messages long, night_messages long")
        social = E.social_metrics(src, with_volunteer=False)
        messaging = E.messaging_metrics(src, stats=sent)
        return social.join(messaging, social["profile_id_social"] == messaging["profile_id"], "left").drop("profile_id")
