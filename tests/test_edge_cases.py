"""Hand-made edge rows (FIXTURES.md, SURVEY §5)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigil import constants as C
from vigil.operators import features as FT
from vigil.operators import reports as R
from vigil.operators import sentiment as S
from vigil.operators import sinks as K
from vigil.sources import extract as E
from vigil.sources.tables import SourceTables
from vigil.streaming import pipeline as PL

AS_OF = "2024-01-10 00:00:00"

UP = "user_id long, id long, followers_count long, following_count long, bio string, is_active boolean"
CP = "user_id long"
COMM = "id long, category string"
CM = "user_id long, community_id long"
USERS = "id long, profile_id long, last_seen_at timestamp, is_active boolean"
MSG = "id long, sender_profile_id long, content string, created_at timestamp, is_deleted boolean"
TXT = "id long, user_id long, content string, is_active boolean"


def ts(s):
    return dt.datetime.fromisoformat(s) if s else None


def make_sources(spark, profiles, complete=(), members=(), communities=(), users=(), messages=(),
                 posts=(), comments=()):
    return SourceTables({
        "user_profiles": spark.createDataFrame(list(profiles), UP),
        "complete_profiles": spark.createDataFrame(list(complete), CP),
        "communities": spark.createDataFrame(list(communities), COMM),
        "community_members": spark.createDataFrame(list(members), CM),
        "users": spark.createDataFrame(list(users), USERS),
        "messages": spark.createDataFrame(list(messages), MSG),
        "posts": spark.createDataFrame(list(posts), TXT),
        "comments": spark.createDataFrame(list(comments), TXT),
    })


@pytest.fixture(scope="module")
def src(spark):
    profiles = [
        (1, 101, 0, None, "bio", True),      # followers 0
        (2, 102, None, None, None, True),    # followers null
        (3, 103, 5, None, "x", True),        # followers 5, following null
        (4, 104, 4, 8, None, True),
        (5, 105, 1, 1, None, False),         # inactive: dropped
    ]
    complete = [(101,), (101,), (103,)]       # duplicate row for one profile
    communities = [(1, "Voluntariado"), (2, "Gaming"), (3, "Gaming")]
    members = [(101, 1), (101, 2), (101, 3), (104, 2)]
    users = [
        (201, 101, ts("2024-01-09 00:00:00"), True),
        (202, 102, None, True),                      # never seen
        (203, 103, ts("2024-01-20 00:00:00"), True),  # future
        (204, 104, ts("2024-01-01 00:00:00"), True),
    ]
    messages = [
        (1, 201, None, ts("2024-01-01 00:59:59"), False),
        (2, 201, None, ts("2024-01-01 01:00:00"), False),
        (3, 201, None, ts("2024-01-01 05:59:59"), False),
        (4, 201, None, ts("2024-01-01 06:00:00"), False),
        (5, 201, None, None, False),
        (6, 201, None, ts("2024-01-01 02:00:00"), True),   # deleted
        (7, 204, "you stupid clown", ts("2024-01-01 03:00:00"), False),
    ]
    long_text = "a" * 550 + " idiot " + "b" * 43
    posts = [(1, 1, "", True), (2, 1, "  a ", True), (3, 2, long_text, True), (4, 3, "all good here", True),
             (5, 3, "trash", False)]
    comments = [(1, 3, "what a loser", True)]
    return make_sources(spark, profiles, complete, members, communities, users, messages, posts, comments)


def by_user(df, key="user_id_raiz"):
    return {r[key]: r for r in df.collect()}


def test_social_no_fanout_and_flags(src):
    s = by_user(E.social_metrics(src))
    assert sorted(s) == [1, 2, 3, 4]                      # inactive dropped, no duplicate for profile 101
    assert s[1]["num_community_categories"] == 2 and s[1]["comm_voluntariado_one_hot"] is True
    assert s[2]["num_community_categories"] == 0 and s[2]["comm_voluntariado_one_hot"] is False
    assert s[1]["complete_profile_missing"] is False and s[2]["complete_profile_missing"] is True


def test_night_hours_and_deleted(src):
    m = {r["profile_id"]: r for r in E.messaging_metrics(src).collect()}
    # 00:59 no, 01:00 yes, 05:59 yes, 06:00 no, null counted in total only; deleted excluded
    assert m[101]["total_messages"] == 5 and m[101]["night_messages"] == 2
    assert m[102]["total_messages"] == 0 and m[102]["night_messages"] == 0


def test_kpis(src):
    k = by_user(FT.raw_kpis(src, AS_OF))
    assert k[1]["reciprocity_ratio"] == 0.0                 # followers 0
    assert k[2]["reciprocity_ratio"] == 0.0                 # followers null
    assert k[3]["reciprocity_ratio"] is None                # following null → filled later
    assert k[4]["reciprocity_ratio"] == 2.0
    assert k[2]["days_since_last_seen"] == 365.0            # never seen
    assert k[3]["days_since_last_seen"] == -10.0            # future goes negative
    assert k[1]["ratio_night_messages"] == pytest.approx(0.4)
    assert k[2]["ratio_night_messages"] == 0.0              # zero messages
    assert k[2]["is_profile_incomplete"] is True and k[1]["is_profile_incomplete"] is False
    assert k[4]["is_profile_incomplete"] is True


def test_minmax_constant_and_null(spark):
    df = spark.createDataFrame([(1, 3.0, None), (2, 3.0, None), (3, 3.0, None)], "user_id_raiz long, a double, b double")
    out = FT.apply_minmax(df, FT.fit_minmax(df, ["a", "b"])).collect()
    assert all(r["a"] == 0.0 and r["b"] == 0.0 for r in out)


def test_feature_vector_shape(src):
    fv = FT.run_transformation(src, AS_OF, skip_nlp=False, materialize_kpis=None)
    assert fv.columns == C.FINAL_COLUMNS
    rows = by_user(fv)
    for r in rows.values():
        for c in ["reciprocity_ratio_norm", "days_since_last_seen_norm", "ratio_night_messages",
                  "sentiment_negativity_index", "num_community_categories_norm"]:
            assert 0.0 <= r[c] <= 1.0
        assert r["int_gaming_one_hot"] is False


def test_text_rules(spark):
    long_text = "a" * 550 + " idiot " + "b" * 43
    df = spark.createDataFrame([(1, ""), (2, "  a "), (3, long_text), (4, None), (5, "Stupid, STUPID moron!")],
                               "id long, content string")
    sc = {r["id"]: r["score"] for r in S.lexicon_scorer(df).collect()}
    assert sc[1] == 0.0 and sc[2] == 0.0 and sc[4] == 0.0
    assert sc[3] == pytest.approx(1 / 3)      # whole text: the word past 512 chars counts
    assert sc[5] == pytest.approx(1.0)
    py = S.LexiconModel()([None or "", "  a ", long_text, "", "Stupid, STUPID moron!"])
    assert py == [0.0, 0.0, pytest.approx(1 / 3), 0.0, pytest.approx(1.0)]


def test_negativity_resolves_message_ids(src):
    n = {r["user_id"]: r["sentiment_negativity_index"] for r in S.negativity_index(src).collect()}
    # user 4's message (messaging id 204) is mapped to root id 4
    assert n[4] == pytest.approx(2 / 3)
    assert n[3] == pytest.approx(1 / 3)       # "loser" comment; inactive "trash" post excluded
    assert n[1] == 0.0


def test_severity_bins_exact_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 20, 60, 80, 100)], "severity_index double")
    h = {r["bin"]: r["n_users"] for r in R.severity_histogram(df).collect()}
    assert h == {"0-20": 1, "20-40": 0, "40-60": 1, "60-80": 1, "80-100": 1}
    s = R.severity_summary(df).first()
    assert s["above_60_percent"] == 60.0 and s["max_severity"] == 100.0


def test_previous_level_transitions(spark):
    rows = [(1, "ALTO_RIESGO", None, 90.0), (2, "ALTO_RIESGO", "ALTO_RIESGO", 70.0),
            (3, "ALTO_RIESGO", "BAJO_RIESGO", 70.0), (4, "BAJO_RIESGO", "ALTO_RIESGO", 10.0)]
    df = (spark.createDataFrame(rows, "user_id_raiz long, risk_level string, previous_risk string, severity_index double")
          .withColumn("table", F.lit("messages")).withColumn("as_of", F.lit(AS_OF).cast("timestamp")))
    upd = {r["user_id"]: r for r in PL.risk_update_messages(df).collect()}
    assert upd["1"]["risk_changed"] is False       # null previous: not "changed"
    assert upd["2"]["risk_changed"] is False and upd["3"]["risk_changed"] is True
    alerts = {r["user_id"]: r for r in PL.critical_alerts(df).collect()}
    assert sorted(alerts) == ["1", "3"]            # null previous counts as a transition
    assert alerts["1"]["priority"] == "URGENT" and alerts["3"]["priority"] == "HIGH"
    assert "Riesgo anterior: N/A" in alerts["1"]["factors"]


def test_stream_features_caps(src):
    roots = src["user_profiles"].sparkSession.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "root_id long")
    m = PL.affected_user_metrics(src, roots)
    f = by_user(PL.incremental_features(m, F.lit(AS_OF).cast("timestamp")))
    assert sorted(f) == [1, 2, 3, 4]               # inactive profile drops the event
    assert f[2]["days_since_last_seen_norm"] == 1.0   # 365 days / 365, capped
    assert f[3]["reciprocity_ratio_norm"] == 0.0      # following null → 0
    assert f[4]["reciprocity_ratio_norm"] == pytest.approx(0.2)
    assert f[1]["num_community_categories_norm"] == pytest.approx(2 / 12)


def test_empty_tables(spark):
    empty = make_sources(spark, [])
    fv = FT.run_transformation(empty, AS_OF, skip_nlp=True, materialize_kpis=None)
    assert fv.count() == 0
    from vigil.session import scratch_path
    t = K.FeatureTable(spark, scratch_path(spark, "empty"))
    assert K.truncate_reload(t, fv, AS_OF) == 0
    assert not t.exists()


def test_argument_ranges(spark):
    df = spark.createDataFrame([(1,)], "x long")
    with pytest.raises(ValueError):
        R.high_risk_users(df, 0)
    with pytest.raises(ValueError):
        R.kpi_trends(df, AS_OF, 169)
    with pytest.raises(ValueError):
        R.users_by_level(df, "UNKNOWN")
    with pytest.raises(ValueError):
        FT.prepare_matrix(df, "x")


def test_chart_histogram_equals_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    cases = [rng.uniform(0, 100, 2000), np.array([5.0] * 10),
             np.concatenate([np.linspace(0, 100, 21), rng.uniform(10, 90, 300)])]
    for vals in cases:
        df = spark.createDataFrame([(float(v),) for v in vals], "severity_index double")
        rows = R.chart_histogram(df).orderBy("bin").collect()
        want, edges = np.histogram(vals, bins=20)
        assert [r["n_users"] for r in rows] == list(want)
        assert [r["left_edge"] for r in rows] == list(edges[:-1])


def test_append_rejects_duplicate_user(spark, src):
    from vigil.session import scratch_path

    fv = FT.run_transformation(src, AS_OF, skip_nlp=True, materialize_kpis=None)
    t = K.FeatureTable(spark, scratch_path(spark, "append"))
    K.append_features(t, fv, AS_OF)
    first = t.read().orderBy("user_id_raiz").collect()
    assert [r["id"] for r in first] == [1, 2, 3, 4] and all(r["cluster_label"] is None for r in first)
    with pytest.raises(ValueError):
        K.append_features(t, fv, AS_OF)        # D2: second load of the same users


def test_snapshot_diff_operations(spark):
    from vigil.operators import cdc

    old = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, None)], "id long, uid long, v string")
    new = spark.createDataFrame([(2, 20, "B"), (3, 30, None), (4, 40, "d")], "id long, uid long, v string")
    d = {r["profile_id"]: r for r in cdc.snapshot_diff(old, new, "id", ["v"], "t", "uid", "profile_id", ["v"],
                                                       as_of="2024-01-01 00:00:00").collect()}
    assert {k: v["operation"] for k, v in d.items()} == {1: "DELETE", 2: "UPDATE", 4: "INSERT"}  # null = null
    assert d[2]["field_changed"] == "v" and d[4]["field_changed"] == "other"
    only_delete = cdc.snapshot_diff(old, new, "id", ["v"], "t", "uid", "profile_id", operations=["DELETE"])
    assert [r["profile_id"] for r in only_delete.collect()] == [1]
