"""T10's rows of one user by plain values."""

from __future__ import annotations

import datetime as dt

import pandas as pd

from vigil.streaming import pipeline as PL


class State:
    hasTimedOut = False

    def __init__(self, value=None):
        self.value = value

    @property
    def exists(self) -> bool:
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, value) -> None:
        self.value = value


def test_one_part_is_not_copied_together(monkeypatch):
    """The usual user has one part of few rows; late rows keep no previous level."""
    def no(*_, **__):
        raise AssertionError("concat of one part")

    monkeypatch.setattr(PL.pd, "concat", no)
    at = [dt.datetime(2024, 1, 1, h) for h in (3, 1, 2)]
    pdf = pd.DataFrame({"root_id": ["7"] * 3, "event_id": [30, 10, 20], "received_at": pd.to_datetime(at), "risk_level": ["B", "A", None]})
    state = State(("A", dt.datetime(2024, 1, 1, 1), 10))
    (out,) = PL._transitions(("7",), iter([pdf]), state, None)
    got = [tuple(None if pd.isna(v) else v for v in r) for r in out.itertuples(index=False)]
    assert got == [("7", 10, pd.Timestamp(at[1]), "A", None, None, False, True), ("7", 20, pd.Timestamp(at[2]), None, "A", True, False, False),
                   ("7", 30, pd.Timestamp(at[0]), "B", None, True, False, False)]
    assert state.value == ("B", at[0], 30)
