"""Row images by several key columns, and counts kept with their parts."""

from __future__ import annotations

from vigil.operators import cdc
from vigil.streaming import maintained as MM


def test_row_images_of_a_key_with_nulls(spark):
    """key columns are compared as they are: (1, null) isn't (null, 1)."""
    old = spark.createDataFrame([(1, None), (2, 2), (3, 3)], "a long, b long")
    new = spark.createDataFrame([(None, 1), (2, 2), (4, 4)], "a long, b long")
    got = {(r.row_key, r.before and tuple(r.before), r.after and tuple(r.after)) for r in cdc.row_images(old, new, ["a", "b"], ["a", "b"]).collect()}
    assert got == {("1", (1, None), None), ("3:3", (3, 3), None), ("1", None, (None, 1)), ("4:4", None, (4, 4))}


def test_parts_go_through_counts_as_numbers(spark):
    """rows keep their part, new rows get none, and no text is aggregated."""
    current = spark.createDataFrame([(1, 2, "pb"), (2, 5, "p0")], "user_id long, n long, part string")
    delta = spark.createDataFrame([(1, 1), (3, 4)], "user_id long, n long")
    got = MM._add("complete_profiles", current, delta, ("p0", "pb"))
    assert sorted(map(tuple, got.select("user_id", "n", "part").collect())) == [(1, 3, "pb"), (2, 5, "p0"), (3, 4, None)]
    assert "SortAggregate" not in got._jdf.queryExecution().executedPlan().toString()
