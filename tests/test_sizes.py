"""Work and memory of a task must not grow with the tables or with neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd

from vigil import fixtures
from vigil.operators import dbscan as DB


def test_memberships_are_dealt_by_lineitems(spark, monkeypatch):
    """as many tasks as the lineitems ask for, and the rows of the view's SQL."""
    monkeypatch.setattr(fixtures, "MEMBER_ROWS", 10)
    orders = spark.createDataFrame([(i, i % 7 if i % 5 else None) for i in range(100)] + [(None, 3)], "o_orderkey long, o_custkey long")
    items = spark.createDataFrame([(i % 120 if i % 11 else None, i % 9 if i % 13 else None) for i in range(400)], "l_orderkey long, l_partkey long")
    orders.createOrReplaceTempView("orders")
    items.createOrReplaceTempView("lineitem")
    got, want = fixtures.community_members(spark), spark.sql(fixtures.FIXTURE_SQL["community_members"])
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.rdd.getNumPartitions() == 40


def test_settled_cells_meet_no_rows(spark, monkeypatch):
    """rows of a cell that a core cell settles aren't multiplied by its neighbours."""
    rng = np.random.default_rng(1)
    x = pd.DataFrame(rng.random((3000, 2)), columns=["x", "y"]).assign(user_id_raiz=range(3000), dbscan_cluster=0)
    core = spark.createDataFrame(x)
    written = []
    cut = DB._cut
    monkeypatch.setattr(DB, "_cut", lambda df: written.append(cut(df)) or written[-1])
    out = DB.assign_to_fit(core.drop("dbscan_cluster"), core, ["x", "y"], eps=0.3)
    assert out.filter("dbscan_cluster = 0 AND vote_dbscan = 0").count() == out.count() == 3000
    met = [d for d in written if "within" in d.columns]
    assert len(met) == 1 and met[0].count() < 3000
