"""Joins of large tables to lookup tables with unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows and bytes up to which a lookup table is broadcast; above it the join is salted.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 128 << 20
#: Least and most copies of the lookup table in a salted join: a key with a third of
#: all rows is read by so many tasks.
SALTS, MOST_SALTS = 16, 128


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a (materialised or cheap) table has at most that many rows and bytes.
    Texts and nested values count as long as they are, other values as 8 bytes."""
    if rows < 0:
        return False
    wide = [f.name for f in df.schema if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))]
    fixed = 8 * (len(df.columns) - len(wide))
    length = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in wide]))) if wide else F.lit(0)
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(length.cast("long") + fixed).alias("bytes")).first()
    return got["n"] <= rows and (got["bytes"] or 0) <= size


def salts(spark: SparkSession) -> int:
    """Tasks that share a hot key: a quarter of the shuffle's, within bounds."""
    return max(SALTS, min(MOST_SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4))


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes values of the type: not maps, at any depth."""
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str,
                rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a large table that may have hot keys to a table with unique keys.

    The right side is broadcast when its counted rows and bytes allow it. Beyond that
    it is repeated and every left row picks one copy by a hash of its other columns, so
    that a hot key is spread over tasks; the result is the same. Rows that are equal in
    all columns pick the same copy: the skew join of adaptive execution splits these.
    """
    if is_small(right, rows):
        return left.join(F.broadcast(right), on, how)
    salt, n = "__salt", salts(left.sparkSession)
    copies = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    picks = [F.col(f"`{f.name}`") for f in left.schema if _hashable(f.dataType)]
    dealt = left.withColumn(salt, F.pmod(F.xxhash64(*picks), F.lit(n)).cast("int"))
    return dealt.join(copies, [*on, salt], how).drop(salt)
