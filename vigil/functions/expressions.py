"""Scalar expressions as built-in Column functions.

All stay JVM-side so whole-stage codegen keeps them in one stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def night_flag(ts) -> Column:
    """hour 1..5 inclusive (01:00:00–05:59:59); null stays null."""
    return F.hour(col(ts)).between(C.NIGHT_HOUR_FIRST, C.NIGHT_HOUR_LAST)


def guarded_ratio(num, den) -> Column:
    """num/den when den > 0, else 0.0 (null den counts as 0)."""
    return F.when(col(den) > 0, col(num).cast("double") / col(den).cast("double")).otherwise(F.lit(0.0))


def days_between(ts, as_of: str | Column, when_null: float = C.DAYS_WHEN_NEVER_SEEN) -> Column:
    """fractional days from ts to as_of; null → 365.0; future dates go negative."""
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of.cast("timestamp")
    micros = F.unix_micros(now) - F.unix_micros(col(ts).cast("timestamp"))
    return F.coalesce(micros.cast("double") / F.lit(C.SECONDS_PER_DAY * 1e6), F.lit(float(when_null)))


def null_true_and(a, b) -> Column:
    """a AND b with a missing flag counted as true."""
    return F.coalesce(col(a), F.lit(True)) & F.coalesce(col(b), F.lit(True))


def cap(x, c: float) -> Column:
    """min(x / c, 1)."""
    return F.least(col(x).cast("double") / F.lit(float(c)), F.lit(1.0))


def clip(x, lo: float, hi: float) -> Column:
    """clip to [lo, hi]."""
    return F.greatest(F.least(col(x), F.lit(float(hi))), F.lit(float(lo)))


def fill_zero(x) -> Column:
    """Null and NaN → 0.0 (Spark NaN is not NULL)."""
    return F.coalesce(F.nanvl(col(x).cast("double"), F.lit(0.0)), F.lit(0.0))


def py_whitespace_class() -> str:
    return "[" + "".join(f"\\x{{{cp}}}" for cp in C.PY_WHITESPACE) + "]"


def py_strip(x) -> Column:
    """Python ``str.strip()`` (Spark ``trim`` removes spaces only)."""
    ws = py_whitespace_class()
    return F.regexp_replace(col(x), f"^{ws}+|{ws}+$", "")


def label_text(level) -> Column:
    """'ALTO_RIESGO' → 'ALTO RIESGO'."""
    return F.translate(col(level), "_", " ")


def minmax(x, lo, hi, eps: float = 0.0) -> Column:
    """(x - lo) / (hi - lo); a zero range maps to 0 (Q6)."""
    lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
    rng = hi_c - lo_c
    if eps:
        return (col(x) - lo_c) / (rng + F.lit(eps))
    return F.when(rng == 0, F.lit(0.0)).otherwise((col(x) - lo_c) / rng)


def ts_text(x, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """timestamp as fixed text (stable across engines)."""
    return F.date_format(col(x), fmt)


def heuristic_score(days, night, incomplete, negativity, community) -> Column:
    """T5 score: weighted KPI sum; ``incomplete`` may be boolean or 0/1."""
    inc = col(incomplete)
    inc_num = F.when(inc.cast("boolean"), F.lit(1.0)).otherwise(F.lit(0.0))
    return (col(days) * C.HEUR_W_DAYS + col(night) * C.HEUR_W_NIGHT
            + inc_num * C.HEUR_W_INCOMPLETE + col(negativity) * C.HEUR_W_NEGATIVITY
            + (F.lit(1.0) - col(community)) * C.HEUR_W_COMMUNITY)


def level_from_score(score) -> Column:
    """T5 cut-offs: ≥0.6 high, ≥0.3 moderate, else low."""
    s = col(score)
    return (F.when(s >= C.HEUR_CUT_HIGH, F.lit(C.LEVEL_HIGH))
            .when(s >= C.HEUR_CUT_MODERATE, F.lit(C.LEVEL_MODERATE))
            .otherwise(F.lit(C.LEVEL_LOW)))


def level_from_votes(votes) -> Column:
    """M8: ≥2 votes high, 1 moderate, 0 low."""
    v = col(votes)
    return (F.when(v >= 2, F.lit(C.LEVEL_HIGH)).when(v == 1, F.lit(C.LEVEL_MODERATE))
            .otherwise(F.lit(C.LEVEL_LOW)))


def level_ordinal(level) -> Column:
    """O3: report order of the three levels."""
    lv = col(level)
    return (F.when(lv == C.LEVEL_LOW, F.lit(0)).when(lv == C.LEVEL_MODERATE, F.lit(1))
            .when(lv == C.LEVEL_HIGH, F.lit(2)))


def sq_distance(cols: list[str], center: list[float]) -> Column:
    """Squared Euclidean distance of a row to a literal point."""
    terms = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(cols, center)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def distance(cols: list[str], center: list[float]) -> Column:
    """Euclidean norm to a literal point."""
    return F.sqrt(sq_distance(cols, center))
