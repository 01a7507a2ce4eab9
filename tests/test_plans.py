"""Plan checks: no cross products, no Python in the relational paths, pushdown reaches the scan."""

from __future__ import annotations

import pytest

from vigil.plans import registry

REG = registry.all_queries()
RELATIONAL = ["feature_vector_nlp", "text_scores", "negativity_index", "risk_distribution", "high_risk_users",
              "kpi_trends", "risk_updates", "upsert_features", "snapshot_changes", "channel_history",
              "risk_transitions", "dbscan_core_noise", "votes_and_level", "silhouette_fixed"]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", RELATIONAL)
def test_no_cross_product_or_python(spark, sf_dir, name):
    plan = physical(REG[name][0](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_pushdown_and_pruning(spark, sf_dir):
    from vigil.operators import features as FT
    from vigil.plans.contract import AS_OF, sources

    plan = physical(FT.raw_kpis(sources(spark, sf_dir), AS_OF))
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,-500.0)]" in plan
    # the lineitem scan reads only the columns the membership view needs
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


def test_aggregate_before_join(spark, sf_dir):
    """Message stats are partially aggregated before any join."""
    from vigil.plans.contract import sources
    from vigil.sources import extract as E

    plan = physical(E.messaging_metrics(sources(spark, sf_dir)))
    assert plan.count("HashAggregate") >= 2  # partial + final


def test_trends_read_only_recent_days(spark, sf_dir):
    plan = physical(REG["kpi_trends_by_day"][0](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(extraction_day" in plan and "extraction_day#" in plan


def test_trends_by_day_have_the_same_means(spark, sf_dir):
    from vigil.operators import reports as R
    from vigil.operators import sinks as K
    from vigil.plans.contract import REPORT_AS_OF, feature_table
    from vigil.session import scratch_path

    path = scratch_path(spark, "by_day")
    K.write_by_day(feature_table(spark, sf_dir), path)
    one, other = (R.kpi_trends(d, REPORT_AS_OF, 24).collect() for d in (feature_table(spark, sf_dir), spark.read.parquet(path)))
    assert len(one) == len(other) > 0
    for a, b in zip(one, other):
        assert (a.time_bucket, a.user_count) == (b.time_bucket, b.user_count)
        assert max(abs(a[c] - b[c]) for c in ("avg_inactivity", "avg_negativity", "avg_night_ratio")) < 0.0011
