"""Sources that are views with joins are built once for a job."""

from __future__ import annotations

import pytest

from vigil.plans import contract_stream as CS
from vigil.sources.tables import SourceTables


@pytest.mark.parametrize("query", [CS.q_stream_pipeline, CS.q_stream_after_loads, CS.q_maintained_metrics])
def test_memberships_are_built_once(spark, sf_dir, monkeypatch, query):
    """A view with joins of its own is read once, not in every batch or step."""
    src = SourceTables.from_fixtures(spark, sf_dir)
    frames, rows = dict(src.frames), spark.sparkContext.accumulator(0)
    members = frames["community_members"]

    def count(batches):
        for b in batches:
            rows.add(b.num_rows)
            yield b

    frames["community_members"] = members.mapInArrow(count, members.schema)
    monkeypatch.setattr(CS, "sources", lambda *_: SourceTables(frames))
    assert query(spark, sf_dir).count() > 0
    # the load of stream_after_loads reads the stored copy, too
    assert rows.value == members.count()
