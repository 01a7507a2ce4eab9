"""Output normalisation shared by contract queries.

Doubles are rounded to 6 decimals and timestamps rendered as fixed text, so
results compare across engines whose float summation order or timestamp
types differ. The oracle SQL applies the same rounding by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGITS = 6


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    out = []
    for name, typ in df.dtypes:
        c = F.col(f"`{name}`")
        if typ in ("double", "float"):
            out.append(F.round(c.cast("double"), digits).alias(name))
        elif typ.startswith("timestamp"):
            out.append(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name))
        elif typ in ("int", "smallint", "tinyint"):
            out.append(c.cast("long").alias(name))
        else:
            out.append(c)
    return df.select(*out)
