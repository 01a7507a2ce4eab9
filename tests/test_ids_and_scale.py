"""Ids of any type, row counts that must survive range partitioning, and work that
must not grow with the square of a cell."""

from __future__ import annotations

import json
import time
import uuid

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil.operators import dbscan as DB
from vigil.operators import graph
from vigil.operators import projection as PJ
from vigil.operators import sinks as K
from vigil.operators import stats as ST
from vigil.session import scratch_path
from vigil.streaming import changes as CH
from vigil.streaming import pipeline as PL

N = 400_000


def features(spark, n, start=0, as_text=False):
    key = (F.col("id") * 7919 + start).cast("string" if as_text else "long")
    return spark.range(n).select(
        key.alias("user_id_raiz"), F.lit(0.5).alias("reciprocity_ratio_norm"), F.lit(0.1).alias("days_since_last_seen_norm"),
        F.lit(0.2).alias("ratio_night_messages"), F.lit(True).alias("is_profile_incomplete"),
        F.lit(0.0).alias("sentiment_negativity_index"), F.lit(0.3).alias("num_community_categories_norm"),
        F.lit(False).alias("int_gaming_one_hot"), F.lit(False).alias("comm_voluntariado_one_hot"))


@pytest.mark.parametrize("as_text", [False, True])
def test_ids_are_dense_and_no_row_is_lost(spark, as_text):
    df = features(spark, N, as_text=as_text)
    out = K.assign_ids(df)
    r = out.agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
    assert (r.n, r.d, r.lo, r.hi) == (N, N, 1, N)
    w = Window.orderBy("id")
    assert out.select((F.col("user_id_raiz") < F.lag("user_id_raiz").over(w)).alias("bad")).filter("bad").isEmpty()


def test_sinks_keep_every_row(spark):
    t = K.FeatureTable(spark, scratch_path(spark, "rows"))
    assert K.truncate_reload(t, features(spark, N), "2024-01-01 00:00:00") == N
    assert K.append_features(t, features(spark, N, start=1), "2024-01-02 00:00:00") == N
    now = t.read()
    assert now.count() == 2 * N and now.agg(F.countDistinct("id"), F.max("id")).first()[:] == (2 * N, 2 * N)
    with pytest.raises(ValueError):
        K.append_features(t, features(spark, 10), "2024-01-03 00:00:00")
    up = features(spark, N, start=2).unionByName(features(spark, 100)).withColumn(
        "extraction_date", F.lit("2024-01-04 00:00:00").cast("timestamp")).withColumn("cluster_label", F.lit("x"))
    merged = K.upsert(now, up)
    assert merged.count() == 3 * N and merged.filter("cluster_label = 'x'").count() == N + 100


def test_text_ids_through_the_sinks(spark):
    t = K.FeatureTable(spark, scratch_path(spark, "text"))
    ids = spark.createDataFrame([(str(uuid.UUID(int=i)),) for i in range(5)], "user_id_raiz string")
    K.append_features(t, ids.crossJoin(features(spark, 1).drop("user_id_raiz")), "2024-01-01 00:00:00")
    up = t.read().select("user_id_raiz").unionByName(spark.createDataFrame([("new",)], "user_id_raiz string"))
    up = up.withColumn("extraction_date", F.lit("2024-01-04 00:00:00").cast("timestamp")).withColumn("cluster_label", F.lit("x"))
    out = K.upsert(t.read(), up, columns=["extraction_date", "cluster_label"])
    assert out.count() == 6 and out.filter("cluster_label = 'x'").count() == 6


def test_transitions_equal_lag_with_extra_columns(spark):
    ev = spark.range(N).select(
        (F.col("id") % 50).cast("string").alias("root_id"), F.col("id").alias("event_id"),
        F.timestamp_seconds(F.xxhash64("id") % 100_000).alias("received_at"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.pmod(F.hash("id"), F.lit(3)) + 1)).alias("risk_level"),
        F.concat(F.lit("extra"), "id").alias("extra"))
    got = PL.risk_transitions(ev).select("event_id", "previous_level")
    want = ev.select("event_id", F.lag("risk_level").over(Window.partitionBy("root_id").orderBy("received_at", "event_id")).alias("w"))
    assert got.join(want, "event_id").filter(~F.col("previous_level").eqNullSafe(F.col("w"))).count() == 0
    assert got.count() == N


def test_uuid_events_are_parsed_and_resolved(spark):
    user, message = str(uuid.uuid4()), str(uuid.uuid4())
    body = {"table": "messages", "operation": "INSERT", "user_id": user, "message_id": message, "timestamp": "2024-01-01 00:00:00"}
    rows = [(1, "messaging", "c", None, json.dumps(body)), (2, "social", "c", None, '{"table":"posts","user_id":42,"post_id":7}'),
            (3, "social", "c", None, "{bad")]
    ev = spark.createDataFrame(rows, CH.ENVELOPE_SCHEMA)
    p = {r.event_id: r for r in CH.parse_changes(ev).collect()}
    assert (p[1].user_id, p[1].message_id, p[1].is_malformed) == (user, message, False)
    assert (p[2].user_id, p[2].post_id, p[3].is_malformed) == ("42", "7", True)
    ids = spark.createDataFrame([("root-1", "p", user), ("42", "q", None)], "root_id string, profile_id string, messaging_id string")
    got = CH.resolve_users(CH.with_user(CH.valid_changes(CH.parse_changes(ev))), ids)
    assert {(r.event_id, r.root_id) for r in got.collect()} == {(1, "root-1"), (2, "42")}


def brute_dbscan(x, eps, min_samples):
    near = ((x[:, None] - x[None]) ** 2).sum(-1) <= eps * eps
    core = near.sum(1) >= min_samples
    label, n = -np.ones(len(x), int), 0
    for i in np.flatnonzero(core):
        if label[i] < 0:
            stack, label[i] = [i], n
            while stack:
                j = stack.pop()
                new = np.flatnonzero(near[j] & core & (label < 0))
                label[new] = n
                stack += new.tolist()
            n += 1
    for i in np.flatnonzero(~core):
        around = label[np.flatnonzero(near[i] & core)]
        label[i] = around.min() if len(around) else -1
    return core, label


@pytest.mark.parametrize("shape", ["spread", "clumps"])
def test_dbscan_with_text_ids_equals_brute_force(spark, shape):
    rng = np.random.default_rng(3)
    if shape == "spread":
        x, eps = rng.random((400, 2)), 0.06
    else:
        x, eps = np.r_[rng.random((150, 3)), rng.normal(0.5, 0.03, (250, 3)), rng.uniform(0, 0.1, (300, 3))], 0.12
    cols = [f"f{k}" for k in range(x.shape[1])]
    df = spark.createDataFrame([(f"u{i:04d}", *map(float, v)) for i, v in enumerate(x)], ["user_id_raiz", *cols])
    core, label = brute_dbscan(x, eps, 5)
    got = {r.user_id_raiz: (r.is_core, r.dbscan_cluster) for r in DB.dbscan(df, cols, eps, 5).collect()}
    assert got == {f"u{i:04d}": (bool(core[i]), int(label[i])) for i in range(len(x))}
    assert set(PJ.fit_pca(df, cols)) >= {"components", "mean"}


def test_two_near_dense_cells_do_not_meet_point_by_point(spark):
    """No pair within eps, though the cells' boxes overlap its reach: a staircase edge."""
    def cells(n):
        rows = spark.range(n).select(F.col("id"), F.rand(1).alias("t"), F.rand(2).alias("s"))
        left = rows.select(F.col("id").alias("user_id_raiz"), (F.col("s") * F.col("t") * 0.1).alias("f0"), (F.col("t") * 0.1).alias("f1"))
        right = rows.select((F.col("id") + n).alias("user_id_raiz"), (F.lit(0.3502) - F.col("s") * (1 - F.col("t")) * 0.1).alias("f0"),
                            (F.col("t") * 0.1).alias("f1"))
        return left.unionByName(right)

    took = []
    for n in (2_000, 100_000):
        t0 = time.time()
        DB.dbscan(cells(n), ["f0", "f1"], 0.25, 5).groupBy("dbscan_cluster").count().collect()
        took.append(time.time() - t0)
    assert took[1] < 10 * took[0] + 10


def test_components(spark):
    e = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 901)], "a long, b long").repartition(7)
    got = {r.node: r.root for r in graph.components(e).collect()}
    assert got == {k: 0 for k in range(1, 301)} | {901: 900}


def test_percentile_equals_numpy_at_any_size(spark):
    rng = np.random.default_rng(1)
    for v in (rng.random(50_000), np.r_[np.zeros(1000), rng.random(5)], np.array([3.0]), np.array([1.0, np.nextafter(1, 2)])):
        df = spark.createDataFrame([(float(x),) for x in v], "v double")
        for q in (0.0, 0.1, 0.5, 0.999, 1.0):
            assert ST.exact_percentile(df, "v", q) == pytest.approx(float(np.percentile(v, 100 * q)), abs=1e-12)


def test_lookup_join_above_the_limit_with_any_columns(spark):
    """Map columns, dotted names and null keys; broadcast and salted joins give the same."""
    from vigil.operators import joins

    left = spark.createDataFrame([(k % 5 if k % 7 else None, {"a": k}, [{"b": k}], "t" * (k % 3)) for k in range(200)],
                                 "k long, `m.x` map<string, int>, l array<map<string, int>>, t string")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(3)], "k long, v string")
    for how in ("inner", "left", "left_anti", "left_semi"):
        few, many = (sorted(map(repr, joins.lookup_join(left, right, ["k"], how, rows).collect())) for rows in (100, -1))
        assert few == many and few


def test_broadcasts_are_bounded_in_bytes(spark):
    from vigil.operators import joins

    wide = spark.createDataFrame([(k, "x" * 1000, [1] * 50) for k in range(100)], "k long, t string, a array<int>")
    assert joins.is_small(wide) and not joins.is_small(wide, 99) and not joins.is_small(wide, size=100_000)
    assert joins.is_small(wide.select("k"), size=800) and not joins.is_small(wide.select("k"), size=799)
    assert joins.is_small(wide.limit(0), 0)
