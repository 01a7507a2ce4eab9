"""Feature-table sinks: K1–K6, W5.

Plain parquet has no MERGE, so the feature table is a ``BucketTable``: a load
writes a part of its own, an upsert rewrites the buckets of its users, and every
commit names its writer and, for a stream, the micro-batch. Loads and streams
share a table; a replayed micro-batch is a no-op (exactly-once effect over
at-least-once delivery).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..session import checkpoint
from .bucket_table import BucketTable, State

FEATURE_TABLE_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("user_id_raiz", T.LongType(), False),
    T.StructField("extraction_date", T.TimestampType()),
    T.StructField("reciprocity_ratio_norm", T.DoubleType()),
    T.StructField("days_since_last_seen_norm", T.DoubleType()),
    T.StructField("ratio_night_messages", T.DoubleType()),
    T.StructField("is_profile_incomplete", T.BooleanType()),
    T.StructField("sentiment_negativity_index", T.DoubleType()),
    T.StructField("num_community_categories_norm", T.DoubleType()),
    T.StructField("int_gaming_one_hot", T.BooleanType()),
    T.StructField("comm_voluntariado_one_hot", T.BooleanType()),
    T.StructField("cluster_label", T.StringType()),
])
FEATURE_TABLE_COLUMNS = [f.name for f in FEATURE_TABLE_SCHEMA.fields]
# K3: columns an upsert replaces (the rest keep their value on update).
UPSERT_COLUMNS = ["extraction_date", "reciprocity_ratio_norm", "days_since_last_seen_norm",
                  "ratio_night_messages", "is_profile_incomplete", "sentiment_negativity_index",
                  "num_community_categories_norm", "cluster_label"]


def conform(df: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Cast to the 12-column feature schema (missing columns → null); the user id
    keeps its own type, a number or a UUID as text. ``carry``: further columns to keep."""
    types = {f.name: f.dataType for f in FEATURE_TABLE_SCHEMA.fields}
    if "user_id_raiz" in df.columns:
        types["user_id_raiz"] = df.schema["user_id_raiz"].dataType
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c)
                       for c in FEATURE_TABLE_COLUMNS], *(carry or []))


class FeatureTable(BucketTable):
    """The stored feature vectors, by user id."""

    def __init__(self, spark: SparkSession, root: str, **kw):
        super().__init__(spark, root, "user_id_raiz", **kw)

    def read(self) -> DataFrame:
        rows = super().read()
        return self.spark.createDataFrame([], FEATURE_TABLE_SCHEMA) if rows is None else rows

    def of_users(self, users: DataFrame, key: str) -> DataFrame:
        """The stored vectors of the users in a column; reads their buckets only."""
        rows = self.read_keys(users, key)
        return self.spark.createDataFrame([], FEATURE_TABLE_SCHEMA) if rows is None else rows

    def upsert(self, updates: DataFrame, writer: str = "upsert", batch_id: int | None = None) -> bool:
        """K3 in place: only buckets that hold updated users are rewritten."""
        def combine(current: DataFrame | None, changes: DataFrame, st: State) -> DataFrame:
            if current is None:
                current = self.spark.createDataFrame([], FEATURE_TABLE_SCHEMA).withColumn("part", F.lit(None).cast("string"))
            return upsert(current, changes, start=st.next_id, carry=["part"])

        return self.merge(updates, combine, writer, batch_id, id_col="id")


# ---------------------------------------------------------------- W5, K1, K2

def assign_ids(df: DataFrame, order_col: str = "user_id_raiz", start: int = 1, id_col: str = "id") -> DataFrame:
    """Dense surrogate ids in ``order_col`` order without one global window:
    rank inside range partitions, then add each partition's offset.

    Range bounds are sampled and partitions may be merged at run time, so the
    partitioned rows are written once together with their partition number;
    ranks and offsets both read that copy.
    """
    ranged = checkpoint(df.repartitionByRange(order_col).withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn("_rn", F.row_number().over(Window.partitionBy("_pid").orderBy(order_col)))
    sizes = local.groupBy("_pid").agg(F.max("_rn").alias("_n"))  # one row per partition
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (local.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
            .withColumn(id_col, (F.col("_off") + F.col("_rn") + F.lit(start - 1)).cast("long"))
            .drop("_pid", "_rn", "_off"))


def with_load_columns(features: DataFrame, as_of: str) -> DataFrame:
    """K1: load timestamp; cluster_label is not in the vector, so it loads as null."""
    return features.withColumn("extraction_date", F.lit(as_of).cast("timestamp")).withColumn(
        "cluster_label", F.lit(None).cast("string"))


def assert_feature_table(df: DataFrame) -> DataFrame:
    """K6: schema check (raises) + rows that break the unique non-null user id rule."""
    missing = [c for c in FEATURE_TABLE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"feature table misses columns {missing}")
    return (df.groupBy("user_id_raiz").agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("user_id_raiz").isNull() | (F.col("n_rows") > 1)))


def append_features(table: FeatureTable, features: DataFrame, as_of: str, check: bool = True) -> int:
    """K1 + D2: append with a load timestamp; duplicates of existing user ids raise.
    Only the new rows are written, and checked among themselves and by a semi
    join against the ids that are there. Returns the number of rows added."""
    start = table.state().next_id
    new = checkpoint(conform(assign_ids(with_load_columns(features, as_of), start=start)))
    if check:
        there = table.read().select(F.col("user_id_raiz").cast("string").alias("_id"))
        again = new.join(there, F.col("user_id_raiz").cast("string") == F.col("_id"), "left_semi")
        if not (assert_feature_table(new).isEmpty() and again.isEmpty()):
            raise ValueError("append would duplicate user_id_raiz (unique key)")
    n = new.count()
    table.append(new, next_id=start + n)
    return n


def truncate_reload(table: FeatureTable, features: DataFrame, as_of: str) -> int:
    """K2: empty input does nothing and returns 0; else replace the table, ids from 1."""
    new = checkpoint(conform(assign_ids(with_load_columns(features, as_of), start=1)))
    n = new.count()
    if n:
        table.reload(new, next_id=n + 1)
    return n


# ---------------------------------------------------------------- K3, K4

def upsert(target: DataFrame, updates: DataFrame, key: str = "user_id_raiz",
           columns: list[str] | None = None, start: int | None = None, carry: list[str] | None = None) -> DataFrame:
    """K3: replace ``columns`` for matching keys; insert the rest with next ids.

    Updated rows keep id and one-hots; inserted rows get null one-hots and ids
    from ``start`` (unless given, after the current maximum). ``carry`` names further
    columns of the target to keep (null on inserted rows). One full outer join on the key.
    """
    carry = carry or []
    columns = columns or UPSERT_COLUMNS
    t = conform(target, carry).withColumn(key, F.col(key).cast(updates.schema[key].dataType)).withColumn("_t", F.lit(True))
    u = updates.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_u_{c}") for c in columns if c in updates.columns])
    j = t.join(u, t[key] == u["_k"], "full_outer")
    matched = F.col("_k").isNotNull()
    sel = []
    for c in [*FEATURE_TABLE_COLUMNS, *carry]:
        if c == key:
            sel.append(F.coalesce(F.col(key), F.col("_k")).alias(key))
        elif c in columns and f"_u_{c}" in u.columns:
            sel.append(F.when(matched, F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            sel.append(F.col(c))
    merged = j.select(*sel, F.col("_t").isNull().alias("_insert"))
    kept = merged.filter(~F.col("_insert")).drop("_insert")
    ins = merged.filter(F.col("_insert")).drop("_insert")
    if start is None:
        start = (t.agg(F.max("id").alias("m")).first()["m"] or 0) + 1
    ins = assign_ids(ins.drop("id"), start=start)
    return conform(kept, carry).unionByName(conform(ins, carry))


def merge_into(spark: SparkSession, table: str, updates: DataFrame, key: str = "user_id_raiz",
               columns: list[str] | None = None) -> None:
    """K3 for table formats with MERGE (Delta/Iceberg catalogs): rewrite only touched files.
    Such a table generates ``id`` itself (identity column).
    Not exercised here (no such format on the classpath)."""
    columns = columns or UPSERT_COLUMNS
    src = updates.alias("s")
    (src.mergeInto(table, F.expr(f"{table}.{key} = s.{key}"))
        .whenMatched().update({c: F.col(f"s.{c}") for c in columns})
        .whenNotMatched().insert({c: F.col(f"s.{c}") for c in [key] + columns})
        .merge())


def label_update(target: DataFrame, labels: DataFrame, key: str = "user_id_raiz",
                 level: str = "risk_level") -> DataFrame:
    """K4: cluster_label ← new level by user id (one join instead of n UPDATEs)."""
    lab = labels.select(F.col(key).alias("_k"), F.col(level).alias("_lvl"))
    j = conform(target).join(lab, F.col(key) == F.col("_k"), "left")
    return j.select(*[F.coalesce(F.col("_lvl"), F.col(c)).alias(c) if c == "cluster_label" else F.col(c)
                      for c in FEATURE_TABLE_COLUMNS])


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append",
               batch_size: int = C.LOAD_CHUNK_ROWS, partitions: int | None = None) -> None:
    """K1/K2 to a database: parallel writers, ``batchsize`` rows per INSERT batch.
    ``mode="overwrite"`` with ``truncate=true`` keeps the table definition.
    Not exercised here (no driver jar, no database)."""
    out = df.repartition(partitions) if partitions else df
    w = out.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    if mode == "overwrite":
        w = w.option("truncate", "true")
    for k, v in properties.items():
        w = w.option(k, v)
    w.mode(mode).save()


# ---------------------------------------------------------------- P14

def write_by_day(features: DataFrame, path: str, files: int = 8) -> None:
    """The feature table partitioned by the day of extraction, for reports over recent
    days; a day is written by up to ``files`` tasks, however many of all rows it holds."""
    rows = conform(features).withColumn("extraction_day", F.to_date("extraction_date"))
    spread = F.pmod(F.xxhash64(F.col("user_id_raiz").cast("string")), F.lit(files))
    (rows.repartition(F.col("extraction_day"), spread).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("extraction_day").parquet(path))
