"""Streaming: replay is idempotent, batches split the same, rejects land, T10 = W4."""

from __future__ import annotations

from pyspark.sql import functions as F

from vigil.operators import sinks as K
from vigil.plans import contract_stream as CS
from vigil.plans.contract import sources
from vigil.session import scratch_path
from vigil.streaming import changes as CH
from vigil.streaming import pipeline as PL


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _write_events(spark, sf_dir, base, chunks):
    ev = sources(spark, sf_dir).frames["change_events"].select(
        "event_id", "source", "channel", F.col("received_at").cast("timestamp").alias("received_at"), "payload")
    b = ev.agg(F.min("received_at").alias("lo"), F.max("received_at").alias("hi")).first()
    step = (b["hi"] - b["lo"]) / chunks
    for i in range(chunks):
        part = ev.filter(F.col("received_at") >= F.lit(b["lo"] + step * i))
        if i < chunks - 1:
            part = part.filter(F.col("received_at") < F.lit(b["lo"] + step * (i + 1)))
        part.coalesce(1).write.mode("append").parquet(f"{base}/in")
    return ev


def test_stream_replay_and_split(spark, sf_dir):
    src = sources(spark, sf_dir)
    initial = src.frames["user_feature_vector"]
    one = scratch_path(spark, "s1")
    _write_events(spark, sf_dir, one, 1)
    a = PL.run_stream(spark, src, f"{one}/in", f"{one}/out", f"{one}/ckpt", initial=initial, max_files=1)
    v1 = a.features.state()
    assert a.features.last_batch(PL.STREAM) == 0
    first = _rows(a.features.read())
    # replay with the same checkpoint: nothing new is applied
    a2 = PL.run_stream(spark, src, f"{one}/in", f"{one}/out", f"{one}/ckpt", initial=initial, max_files=1)
    assert a2.features.state() == v1
    assert _rows(a2.features.read()) == first
    # the same events split over three batches end in the same table
    three = scratch_path(spark, "s3")
    _write_events(spark, sf_dir, three, 3)
    b = PL.run_stream(spark, src, f"{three}/in", f"{three}/out", f"{three}/ckpt", initial=initial, max_files=1)
    assert b.features.last_batch(PL.STREAM) == 2
    assert _rows(b.features.read()) == first
    # rejects: malformed payloads are kept, not dropped
    rej = spark.read.parquet(b.rejects_path)
    bad = src.frames["change_events"].filter(~F.col("payload").startswith("{\"") | F.col("payload").contains("not a time"))
    assert rej.count() == bad.count()
    # alerts equal the transitions into ALTO_RIESGO seen batch by batch
    msgs = spark.read.parquet(b.messages_path)
    assert msgs.filter("type = 'CRITICAL_ALERT'").count() % 2 == 0   # each alert on two channels


def test_stateful_equals_lag(spark, sf_dir):
    lag = _rows(CS.q_risk_transitions(spark, sf_dir))
    state = _rows(CS.q_stateful_transitions(spark, sf_dir))
    assert lag == state


def test_upsert_keeps_ids_and_inserts(spark):
    t = spark.createDataFrame([(1, 10, "A", True), (2, 20, "B", False)],
                              "id long, user_id_raiz long, cluster_label string, comm_voluntariado_one_hot boolean")
    u = spark.createDataFrame([(20, "X"), (30, "Y")], "user_id_raiz long, cluster_label string")
    out = {r["user_id_raiz"]: r for r in K.upsert(t, u).collect()}
    assert out[10]["cluster_label"] == "A" and out[10]["id"] == 1
    assert out[20]["cluster_label"] == "X" and out[20]["id"] == 2 and out[20]["comm_voluntariado_one_hot"] is False
    assert out[30]["id"] == 3 and out[30]["comm_voluntariado_one_hot"] is None


def test_skew_safe_lag_across_partitions(spark):
    """A hot user spread over many range partitions gets the same lag as one window."""
    from pyspark.sql import Window

    rows = [(1 if i % 3 else 2 + i % 5, i, f"2024-01-01 00:{i // 60 % 60:02d}:{i % 60:02d}",
             ["BAJO_RIESGO", "ALTO_RIESGO", "RIESGO_MODERADO"][(i * 7) % 3]) for i in range(600)]
    h = (spark.createDataFrame(rows, "root_id long, event_id long, ts string, risk_level string")
         .withColumn("received_at", F.to_timestamp("ts")).drop("ts"))
    got = _rows(PL.risk_transitions(h, partitions=40).select("root_id", "event_id", "previous_level"))
    w = Window.partitionBy("root_id").orderBy("received_at", "event_id")
    want = _rows(h.withColumn("previous_level", F.lag("risk_level").over(w)).select("root_id", "event_id", "previous_level"))
    assert got == want


def test_two_stage_top_n(spark):
    msgs = spark.createDataFrame(
        [(str(u), "USER_RISK_UPDATE", f"2024-01-01 00:00:{u % 60:02d}", "clustering") for u in range(500)],
        "user_id string, type string, ts string, channel string").withColumn(
        "server_timestamp", F.to_timestamp("ts")).drop("ts")
    from pyspark.sql import Window
    got = _rows(PL.channel_history(msgs, 50, buckets=16).select("channel", "rank", "user_id"))
    w = Window.partitionBy("channel").orderBy(*PL.history_order())
    want = _rows(msgs.withColumn("rank", F.row_number().over(w)).filter("rank <= 50").select("channel", "rank", "user_id"))
    assert got == want


def _change(i, minutes):
    import datetime as dt
    import json

    at = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
    return (i, "social", "c", at, json.dumps({"table": "posts", "operation": "INSERT", "user_id": "u", "timestamp": str(at)}))


def _arrive(spark, base, slices):
    for rows in slices:
        spark.createDataFrame(rows, CH.ENVELOPE_SCHEMA).write.mode("append").parquet(f"{base}/in")
        out = PL.run_window_counts(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt")
    return out


def test_window_counts_over_out_of_order_triggers(spark):
    """Several triggers, the last files older than the watermark: nothing vanishes."""
    slices = [[_change(i, i) for i in range(100)], [_change(100 + i, 200 + i) for i in range(100)],
              [_change(200 + i, 100 + i) for i in range(100)],  # 100..199 min: older than the newest seen less 10 min
              [_change(300 + i, 290 + i) for i in range(100)] + [_change(250, 150), _change(199, 299)]]  # two repeats
    base = scratch_path(spark, "late")
    out = _arrive(spark, base, slices)
    counted = [r.event_id for r in out.events("counted").collect()]
    late = [r.event_id for r in out.late().collect()]
    assert sorted(counted + late) == list(range(400))  # each once, in one of the two
    assert set(late) == set(range(200, 300))
    assert sum(r.n_changes for r in out.counts().collect()) == 300
    assert {(r.window_start.hour, r.n_changes) for r in out.counts().collect()} >= {(0, 60), (1, 40), (3, 40), (4, 70), (5, 60), (6, 30)}


def test_events_delivered_again_behind_the_watermark(spark):
    """Counted ids come back in every later trigger: neither counted nor late again."""
    first = [_change(1, 0), _change(2, 30)]
    slices = [first, [_change(3, 300)], [*first, _change(4, 10)], [*first, _change(4, 10), _change(5, 400)], first]
    base = scratch_path(spark, "again")
    out = _arrive(spark, base, slices)
    assert sum(r.n_changes for r in out.counts().collect()) == 4
    assert [r.event_id for r in out.late().collect()] == [4]
    # a micro-batch that is delivered again changes nothing
    counts, late = _rows(out.counts()), _rows(out.late())
    kinds = "kind string, source string, event_id long, table string, event_time timestamp, window_start timestamp, window_end timestamp, n_changes long"
    PL.window_batch(out)(spark.createDataFrame([], kinds), 0)
    assert _rows(out.counts()) == counts and _rows(out.late()) == late


def test_history_is_kept_and_the_log_folded(spark, sf_dir):
    src = sources(spark, sf_dir)
    base = scratch_path(spark, "hist")
    _write_events(spark, sf_dir, base, 3)
    sinks = PL.run_stream(spark, src, f"{base}/in", f"{base}/out", f"{base}/ckpt",
                          initial=src.frames["user_feature_vector"], max_files=1)
    columns = ["channel", "rank", "user_id", "type", "server_timestamp", "body"]
    whole, log = _rows(PL.channel_history(sinks.messages()).select(*columns)), _rows(sinks.messages())
    assert whole and _rows(sinks.history().select(*columns)) == whole
    assert _rows(sinks.history(3).select(*columns)) == [r for r in whole if r[1] <= 3]
    for upto in (0, 0, 1):  # folded batches leave the log as it is, also when folded again
        sinks.compact_messages(upto)
        assert _rows(sinks.messages()) == log
        assert [r[0] for r in spark.read.parquet(sinks.messages_path).select("batch_id").distinct().collect()] == list(range(upto + 1, 3)) \
            or upto == 0
    sinks.compact_messages(5)
    assert _rows(sinks.messages()) == log
    sinks.update_history(sinks.messages().limit(0), 2)  # a batch that is there
    assert _rows(sinks.history().select(*columns)) == whole


def test_transitions_of_idle_and_late_users(spark):
    """State of idle users is dropped; they come back to their stored level. Late rows are told apart."""
    import datetime as dt

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("root_id", T.LongType()), T.StructField("event_id", T.LongType()),
                           T.StructField("received_at", T.TimestampType()), T.StructField("risk_level", T.StringType())])
    t0, levels = dt.datetime(2024, 1, 1), ["BAJO_RIESGO", "ALTO_RIESGO", "RIESGO_MODERADO"]
    rows, late = [], []
    for day in range(6):
        for user in range(8):
            if user < 2 or day % (user + 1) == 0:  # users 0 and 1 are active daily, others come back after days
                rows.append((day, (user, day * 100 + user, t0 + dt.timedelta(days=day, minutes=user), levels[(day * user + day) % 3])))
    late = (0, 999, t0 + dt.timedelta(days=1, hours=5), levels[0])
    base = scratch_path(spark, "idle")
    for day in range(6):
        part = [r for d, r in rows if d == day] + ([late] if day == 4 else [])
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{base}/in")
        out = PL.run_transitions(spark.readStream.schema(schema).parquet(f"{base}/in"), f"{base}/out", f"{base}/ckpt", idle="1 day")
    got = {r.event_id: r for r in out.collect()}
    assert len(got) == len(rows) + 1 and [i for i, r in got.items() if r.is_late] == [999] and got[999].previous_level is None
    last = {}
    for _, (user, event, _, level) in rows:
        assert got[event].previous_level == last.get(user) and got[event].is_transition == (last.get(user) != level)
        last[user] = level
    assert sum(r.is_first for r in got.values()) > 8  # some users' state had been dropped


def test_a_late_source_loses_nothing(spark):
    """Messaging changes arrive hours after the social ones' event times; equal ids of two sources are two changes."""
    base = scratch_path(spark, "two")
    paths = {n: f"{base}/{n}" for n in ("social", "messaging")}
    arrive = [([_change(i, i) for i in range(60)], []), ([_change(100 + i, 600 + i) for i in range(60)], [_change(i, i) for i in range(60)]),
              ([], [_change(100 + i, 600 + i) for i in range(60)])]
    for path in paths.values():
        spark.createDataFrame([], CH.ENVELOPE_SCHEMA).write.parquet(path)
    for slices in arrive:
        for path, part in zip(paths.values(), slices):
            spark.createDataFrame(part, CH.ENVELOPE_SCHEMA).write.mode("append").parquet(path)
        out = PL.run_window_counts(spark, paths, f"{base}/out", f"{base}/ckpt")
    assert out.late().count() == 0
    assert {(r.window_start.hour, r.n_changes) for r in out.counts().collect()} == {(0, 120), (10, 120)}
    # one stream of both marks the messaging changes late
    both = scratch_path(spark, "one")
    for social, messaging in arrive:
        for part in (social, messaging):
            spark.createDataFrame([(i + 1000 * (part is messaging), *r) for i, *r in part], CH.ENVELOPE_SCHEMA).write.mode("append").parquet(f"{both}/in")
        out = PL.run_window_counts(spark, f"{both}/in", f"{both}/out", f"{both}/ckpt")
    assert sum(r.n_changes for r in out.counts().collect()) + out.late().count() == 240
