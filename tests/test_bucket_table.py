"""The feature table: commits, cut-short writes, loads and streams together, poison events."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from vigil.operators import sinks as K
from vigil.operators.bucket_table import BucketTable
from vigil.plans.contract import sources
from vigil.session import scratch_path
from vigil.streaming import changes as CH
from vigil.streaming import pipeline as PL

AT = "2024-01-01 00:00:00"


def users(spark, lo, hi, label=None):
    return spark.range(lo, hi).select(F.col("id").alias("user_id_raiz"), F.lit(0.5).alias("reciprocity_ratio_norm"),
                                      F.lit(label).cast("string").alias("cluster_label"))


def files(table):
    return set(table._rows(table.state()).inputFiles())


def rows(table):
    return sorted(tuple(r) for r in table.read().select("id", "user_id_raiz", "cluster_label").collect())


def test_upsert_rewrites_only_touched_buckets(spark):
    t = K.FeatureTable(spark, scratch_path(spark, "t"), buckets=64)
    K.truncate_reload(t, users(spark, 0, 5000), AT)
    before = files(t)
    changed = users(spark, 100, 105, "x").unionByName(users(spark, 9000, 9002, "new"))
    touched = {r[0] for r in changed.select(t._bucket(F.col("user_id_raiz"), t.state())).distinct().collect()}
    assert t.upsert(changed)
    gone, kept = before - files(t), before & files(t)
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in gone} <= touched and len(touched) <= 7
    assert len(kept) >= len(before) - len(touched)
    got = rows(t)
    assert len(got) == 5002 and [r for r in got if r[2]] == (
        [(101 + i, 100 + i, "x") for i in range(5)] + [(5001, 9000, "new"), (5002, 9001, "new")])
    assert t.of_users(users(spark, 101, 103), "user_id_raiz").count() == 2
    plan = t.of_users(users(spark, 101, 102), "user_id_raiz")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "bucket" in plan


def test_append_touches_no_file_and_continues_ids(spark):
    t = K.FeatureTable(spark, scratch_path(spark, "t"), buckets=4)
    assert K.append_features(t, users(spark, 0, 10), AT) == 10
    before = files(t)
    assert K.append_features(t, users(spark, 10, 15), AT) == 5
    assert before < files(t)
    assert t.upsert(users(spark, 14, 16, "y"))  # updates a row of the second load, inserts one
    assert [r[:2] for r in rows(t)] == [(i + 1, i) for i in range(16)]
    assert t.state().next_id == 17
    K.truncate_reload(t, users(spark, 3, 5), AT)
    assert rows(t) == [(1, 3, None), (2, 4, None)]
    t.upsert(users(spark, 7, 8))
    assert [r[:2] for r in rows(t)] == [(1, 3), (2, 4), (3, 7)]


@pytest.mark.parametrize("write", [
    lambda spark, t: K.append_features(t, users(spark, 10, 20), AT), lambda spark, t: K.truncate_reload(t, users(spark, 10, 20), AT),
    lambda spark, t: t.upsert(users(spark, 5, 20, "x"), "s", 0)])
def test_a_write_without_commit_is_not_seen(spark, monkeypatch, write):
    t = K.FeatureTable(spark, scratch_path(spark, "t"), buckets=4)
    K.truncate_reload(t, users(spark, 0, 10), AT)
    before = rows(t)

    def fails(*_):
        raise OSError("log")

    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_write_log", fails)
        with pytest.raises(OSError):
            write(spark, t)
    assert rows(t) == before and t.last_batch("s") == -1
    write(spark, t)  # again, and now it counts
    assert rows(t) != before


def test_a_merge_cut_short_is_put_in_place_later(spark, monkeypatch):
    t = K.FeatureTable(spark, scratch_path(spark, "t"), buckets=4)
    K.truncate_reload(t, users(spark, 0, 10), AT)

    def fails(*_):
        raise OSError("executors lost")

    with monkeypatch.context() as m:
        m.setattr(BucketTable, "_put_in_place", fails)
        with pytest.raises(OSError):
            t.upsert(users(spark, 5, 12, "x"), "s", 0)
    again = K.FeatureTable(spark, t.root)
    assert again.last_batch("s") == 0 and sum(r[2] == "x" for r in rows(again)) == 7 and len(rows(again)) == 12
    assert not again.upsert(users(spark, 0, 5, "z"), "s", 0)  # the batch is there


def test_batches_count_by_writer(spark):
    t = K.FeatureTable(spark, scratch_path(spark, "t"), buckets=2)
    K.truncate_reload(t, users(spark, 0, 3), AT)
    K.append_features(t, users(spark, 3, 5), AT)
    assert t.last_batch("a") == -1 and t.upsert(users(spark, 0, 1, "a0"), "a", 0)
    K.truncate_reload(t, users(spark, 0, 3), AT)  # a load between batches
    assert t.upsert(users(spark, 1, 2, "a1"), "a", 1) and not t.upsert(users(spark, 1, 2, "again"), "a", 1)
    assert t.last_batch("b") == -1 and t.upsert(users(spark, 2, 3, "b0"), "b", 0)
    assert rows(t) == [(1, 0, None), (2, 1, "a1"), (3, 2, "b0")]


def test_empty_writes(spark):
    t = K.FeatureTable(spark, scratch_path(spark, "t"), buckets=2)
    assert t.read().count() == 0 and not t.exists()
    assert t.upsert(users(spark, 0, 0), "s", 0) and t.read().count() == 0 and t.last_batch("s") == 0
    assert K.append_features(t, users(spark, 0, 0), AT) == 0 and t.read().count() == 0
    assert t.upsert(users(spark, 0, 2, "x"), "s", 1) and len(rows(t)) == 2
    assert t.of_users(users(spark, 5, 5), "user_id_raiz").count() == 0


# ------------------------------------------------------------------- poison events

def event(i, payload):
    return (i, "social", "c", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), payload if isinstance(payload, str) or payload is None
            else json.dumps({"table": "posts", "operation": "INSERT", "timestamp": "2024-01-01 00:00:00"} | payload))


POISON = [(1, {"user_id": 7}), (2, {"user_id": 8, "timestamp": "not a time"}), (3, {"user_id": ""}), (4, {"user_id": None}),
          (5, {"user_id": "abc"}), (6, "{bad"), (7, None), (8, "[1]"), (9, {"user_id": 9, "timestamp": None}), (10, {"user_id": 10, "timestamp": ""})]


@pytest.mark.parametrize("resolve", [True, False])
def test_poison_events_are_rejected_not_raised(spark, sf_dir, resolve):
    src = sources(spark, sf_dir)
    base = scratch_path(spark, "poison")
    spark.createDataFrame([event(*e) for e in POISON], CH.ENVELOPE_SCHEMA).write.parquet(f"{base}/in")
    out = PL.run_stream(spark, src, f"{base}/in", f"{base}/out", f"{base}/ckpt", resolve_ids=resolve)
    reasons = {r.event_id: r.reason for r in spark.read.parquet(out.rejects_path).collect()}
    expected = {2: "unreadable_timestamp", 6: "malformed_json", 7: "malformed_json", 8: "malformed_json", 10: "unreadable_timestamp"}
    assert reasons == expected | ({5: "unknown_user"} if resolve else {})
    active = {r[0] for r in src["user_profiles"].filter("is_active AND user_id IN (7, 9)").select("user_id").collect()}
    assert {int(r.user_id_raiz) for r in out.features.read().collect()} == active
