"""Source tables as a named bundle of DataFrames.

Production reads a parquet folder per table or a JDBC table; tests use the
fixture views. Nothing here collects.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .. import fixtures
from ..session import scratch_path

SOCIAL_TABLES = ["user_profiles", "complete_profiles", "communities", "community_members",
                 "posts", "comments"]
MESSAGING_TABLES = ["users", "messages"]
REQUIRED = {
    "user_profiles": ["user_id", "id", "followers_count", "following_count", "bio", "is_active"],
    "complete_profiles": ["user_id"],
    "communities": ["id", "category"],
    "community_members": ["user_id", "community_id"],
    "users": ["id", "profile_id", "last_seen_at", "is_active"],
    "messages": ["id", "sender_profile_id", "content", "created_at", "is_deleted"],
    "posts": ["id", "user_id", "content", "is_active"],
    "comments": ["id", "user_id", "content", "is_active"],
}


@dataclass
class SourceTables:
    """Named source DataFrames; ``get`` validates the columns a query needs (P10)."""

    frames: dict[str, DataFrame] = field(default_factory=dict)

    def get(self, name: str) -> DataFrame:
        if name not in self.frames:
            raise KeyError(f"source table {name!r} not provided")
        df = self.frames[name]
        missing = [c for c in REQUIRED.get(name, []) if c not in df.columns]
        if missing:
            raise ValueError(f"{name}: missing columns {missing}")
        return df

    def __getitem__(self, name: str) -> DataFrame:
        return self.get(name)

    def __contains__(self, name: str) -> bool:
        return name in self.frames

    def stored(self, spark: SparkSession, *names: str) -> "SourceTables":
        """These sources with some tables written once to the scratch folder: for jobs that
        read them many times, where they are views with joins of their own."""
        frames = dict(self.frames)
        for n in names:
            path = scratch_path(spark, n)
            frames[n].write.parquet(path)
            frames[n] = spark.read.schema(frames[n].schema).parquet(path)
        return SourceTables(frames)

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str) -> "SourceTables":
        return cls(fixtures.fixture_tables(spark, sf_dir))

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, names: list[str] | None = None) -> "SourceTables":
        names = names or SOCIAL_TABLES + MESSAGING_TABLES
        return cls({n: spark.read.parquet(os.path.join(root, n)) for n in names})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, urls: dict[str, str], properties: dict[str, str],
                  partitioning: dict[str, dict] | None = None) -> "SourceTables":
        """S1/S2 over JDBC: ``urls`` maps table → JDBC URL of its database.

        ``partitioning`` gives per-table ``partitionColumn/lowerBound/upperBound/
        numPartitions`` so large tables are read by parallel range scans.
        No driver jar ships with this repo; the option is built, not tested.
        """
        frames = {}
        for name, url in urls.items():
            r = spark.read.format("jdbc").option("url", url).option("dbtable", name)
            for k, v in properties.items():
                r = r.option(k, v)
            for k, v in (partitioning or {}).get(name, {}).items():
                r = r.option(k, v)
            frames[name] = r.load()
        return cls(frames)
