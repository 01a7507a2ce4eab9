"""Ids of the window stream are shuffled, not sent to the driver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from vigil.streaming import pipeline as PL


def test_window_ids_are_not_broadcast(spark, tmp_path, monkeypatch):
    rows = [("raw", "social", i, "posts", dt.datetime(2024, 1, 1, 0, i)) for i in range(4)]
    rows += [("counted", *r[1:]) for r in rows[:3]]
    schema = "kind string, source string, event_id long, table string, event_time timestamp"
    none = "cast(null as timestamp) as window_start, cast(null as timestamp) as window_end, cast(null as long) as n_changes"
    out = PL.WindowOutputs(spark, str(tmp_path / "out"))
    plans: list[str] = []
    write = PL.WindowOutputs.write

    def seen(self, events: DataFrame, name: str, batch_id: int) -> None:
        if name == "late":
            plans.append(events._jdf.queryExecution().executedPlan().toString())
        write(self, events, name, batch_id)

    monkeypatch.setattr(PL.WindowOutputs, "write", seen)
    for batch_id in range(2):
        PL.window_batch(out)(spark.createDataFrame(rows, schema).selectExpr("*", *none.split(", ")), batch_id)
    assert len(plans) == 2 and all("Broadcast" not in p and "SortMergeJoin" in p for p in plans)
    assert sorted((r.event_id, r.batch_id) for r in out.late().collect()) == [(3, 0)]
