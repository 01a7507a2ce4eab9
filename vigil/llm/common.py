"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import BROADCAST_ROWS, is_small, lookup_join  # noqa: F401  (used through this module)
from ..session import checkpoint

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD_SEP = r"[\x20\x09-\x0D]+"
NON_WORD_SEP = r"[^\x20\x09-\x0D]+"

def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only; other letters (É, Ü …) keep their case."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def words_of(c: Column, separators: str = WORD_SEP) -> Column:
    """Array of the non-empty pieces between separators; empty for null."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), separators), "")


def count_words(c: Column) -> Column:
    """Number of whitespace-separated words without building them; 0 for null."""
    marks = F.regexp_replace(F.coalesce(c, F.lit("")), NON_WORD_SEP, "x")
    return F.char_length(F.regexp_replace(marks, WORD_SEP, "")).cast("long")


def row_key(*cols: str) -> Column:
    """Digest of the given columns. Rows that agree in all of them share the
    key (nulls count as a value), whatever partition or attempt they are read in."""
    parts = [F.when(F.col(f"`{c}`").isNull(), F.lit("n")).otherwise(
        F.concat(F.lit("v"), F.col(f"`{c}`").cast("string"))) for c in cols]
    return F.md5(F.concat_ws("\u001f", *parts))


def settled(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder; later plans read
    those files, also after executors are lost."""
    return checkpoint(df)


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "16m") -> None:
    """Bound what a Python worker holds at once: Arrow batches end at that many
    rows or bytes, so that batches of very long texts stay small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
