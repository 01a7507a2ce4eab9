"""Fixture views (FIXTURES.md): source-shaped views over the driver's tables.

The SQL text runs unchanged in Spark SQL and DuckDB, so the same dict is
used to register Spark temp views and as the CTE prefix of oracle queries.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]

FIXTURE_SQL: dict[str, str] = {
    "user_profiles": """
select c_custkey as user_id, c_custkey+1000000 as id,
  case when c_custkey%11=0 then 0 when c_custkey%13=0 then null else c_custkey%97 end as followers_count,
  c_nationkey*3+c_custkey%5 as following_count,
  case when c_custkey%4=0 then null else c_name end as bio,
  c_acctbal>-500 as is_active
from customer""",
    "complete_profiles": """
select c_custkey+1000000 as user_id from customer where c_custkey%3<>0""",
    "communities": """
select p_partkey as id,
  case when p_brand='Brand#2' then 'Voluntariado' else p_brand end as category
from part""",
    "community_members": """
select distinct o_custkey+1000000 as user_id, l_partkey as community_id
from orders join lineitem on o_orderkey=l_orderkey""",
    "users": """
select c_custkey+2000000 as id, c_custkey+1000000 as profile_id,
  case when c_custkey%17=0 then null else m end as last_seen_at,
  c_acctbal>-700 as is_active
from customer left join
  (select o_custkey, max(o_orderdate) m from orders group by o_custkey) o
  on o_custkey=c_custkey""",
    "messages": """
select event_id as id, user_id+2000000 as sender_profile_id,
  cast(null as string) as content, ts as created_at, event_type='error' as is_deleted
from events
union all
select 100000000+conv_id*1000+turn, conv_id+2000000, text, cast(null as timestamp), false
from conversations where role='user'""",
    "posts": """
select doc_id as id, doc_id%150 as user_id, text as content, source<>'src0' as is_active
from documents""",
    "comments": """
select conv_id*1000+turn as id, conv_id as user_id, text as content, turn<>3 as is_active
from conversations where role='assistant'""",
    "id_map": """
select up.user_id as root_id, up.id as profile_id, u.id as messaging_id
from user_profiles up left join users u on u.profile_id=up.id""",
    "user_feature_vector": """
select c_custkey+1 as id, c_custkey as user_id_raiz,
  timestamp '2024-01-31 00:00:00' - interval '1' hour * cast(c_custkey%48 as int) as extraction_date,
  (c_custkey*7919%1000)/1000e0 as reciprocity_ratio_norm,
  (c_custkey*104729%1000)/1000e0 as days_since_last_seen_norm,
  (c_custkey*1299709%1000)/1000e0 as ratio_night_messages,
  c_custkey%3=0 as is_profile_incomplete,
  case when c_custkey%5=0 then 0e0 else (c_custkey*15485863%1000)/1000e0 end as sentiment_negativity_index,
  (c_custkey*32452843%1000)/1000e0 as num_community_categories_norm,
  false as int_gaming_one_hot, c_custkey%10=0 as comm_voluntariado_one_hot,
  case when c_custkey%19=0 then null when c_custkey%7=0 then 'ALTO_RIESGO'
       when c_custkey%7<3 then 'RIESGO_MODERADO' else 'BAJO_RIESGO' end as cluster_label
from customer""",
    "change_events": """
select event_id,
  case when event_type in ('click','view') then 'messaging' else 'social' end as source,
  'data_change' as channel, ts as received_at,
  case when event_id%97=0 then '{bad' else concat(
    '{"table":"', case event_type when 'click' then 'messages' when 'view' then 'users'
        when 'signup' then 'user_profiles' when 'purchase' then 'posts' else 'community_members' end,
    '","operation":"', case when event_id%3=0 then 'INSERT'
        when event_type='error' and event_id%5=0 then 'DELETE' else 'UPDATE' end,
    '","user_id":', case when event_id%89=0 then 'null' when event_id%103=0 then '""' else cast(user_id + case event_type
        when 'click' then 2000000 when 'view' then 1000000 when 'error' then 1000000 else 0 end
        as varchar(20)) end,
    ',"timestamp":"', case when event_id%101=0 then 'not a time' else cast(ts as varchar(40)) end, '"}') end as payload
from events""",
}

# Batch "now" for the fixture sources: orders end on 2001-08-01.
BATCH_AS_OF = "2001-08-02 00:00:00"
# "now" for report queries over the fixture feature table.
REPORT_AS_OF = "2024-01-31 00:00:00"


def cte_prefix(names: list[str] | None = None) -> str:
    """``WITH a AS (...), b AS (...)`` over the fixture views, in dependency order."""
    names = list(FIXTURE_SQL) if names is None else names
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in FIXTURE_SQL if n in names]
    return "WITH " + ",\n".join(parts)


#: Lineitems of a task while memberships are built, so that its memory doesn't grow with the tables.
MEMBER_ROWS = 1_000_000


def community_members(spark: SparkSession) -> DataFrame:
    """The view ``community_members`` (same rows as its SQL), dealt over as many tasks as the
    number of lineitems asks for, whatever the session's number of shuffle partitions."""
    items = spark.table("lineitem")
    n = max(spark.sparkContext.defaultParallelism, -(-items.count() // MEMBER_ROWS))
    items = items.select("l_orderkey", "l_partkey").repartition(n, "l_orderkey")
    orders = spark.table("orders").select("o_orderkey", "o_custkey").repartition(n, "o_orderkey")
    pairs = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(
        (F.col("o_custkey") + 1000000).alias("user_id"), F.col("l_partkey").alias("community_id"))
    return pairs.repartition(n, "user_id", "community_id").distinct()


def register_base_tables(spark: SparkSession, sf_dir: str) -> None:
    for t in BASE_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path) or "://" in sf_dir:
            spark.read.parquet(path).createOrReplaceTempView(t)


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Register base tables and fixture views; return the views as DataFrames."""
    register_base_tables(spark, sf_dir)
    out = {}
    for name, sql in FIXTURE_SQL.items():
        df = community_members(spark) if name == "community_members" else spark.sql(sql)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out
