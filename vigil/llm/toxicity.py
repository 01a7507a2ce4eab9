"""Toxicity by a factorization machine over hashed terms.

Terms are the words of the whole text and their prefixes, hashed; the machine
(``fm``) weighs terms and pairs of terms. It is fitted on the driver from a bounded
sample: at most ``per_label`` labelled documents of each label, of which only the
hashed terms leave the tasks. Scoring runs in the tasks with the broadcast model,
whose size is bounded by the terms kept from the sample.

Edge cases: a null or empty text has no terms and scores the machine's bias; texts of
any length are scored whole;
documents without label are only scored; a label table that is empty or knows one
label gives a constant score; equal texts get equal scores; an empty table gives no
rows; other columns pass through ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fm
from .common import small_batches
from .sample import labelled_texts
from .terms import word_terms

TERM_BITS = 22
PREFIXES = (4, 5, 6)
PER_LABEL = 3000
THRESHOLD = 0.7


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> fm.FactorizationMachine:
    """Fit on labelled documents; ``labels`` has doc_id and toxic (0 or 1)."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("binary")
    def hashed_terms(text: pd.Series) -> pd.Series:
        return text.map(lambda t: word_terms(t, TERM_BITS, PREFIXES).astype(np.int32).tobytes())

    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
    sample = labelled_texts(docs, marked.filter("label IN (0, 1)"), per_label)
    rows = sample.select("doc_id", "label", hashed_terms(F.coalesce("text", F.lit(""))).alias("terms")).collect()
    rows.sort(key=lambda r: str(r["doc_id"]))
    texts = [np.frombuffer(r["terms"], dtype=np.int32) for r in rows]
    return fm.fit(texts, np.array([r["label"] for r in rows]))


def scorer(docs: DataFrame, model: fm.FactorizationMachine):
    """A function of a text column that gives the score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(word_terms(t, TERM_BITS, PREFIXES)) for t in texts], dtype="float64")

    def apply(text: Column) -> Column:
        return score(F.coalesce(text, F.lit("")))

    return apply


def with_scores(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> DataFrame:
    """doc_id, text-free: the score of every document."""
    model = train(docs, labels, per_label)
    return docs.select("doc_id", scorer(docs, model)(F.col("text")).alias("score"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more."""
    model = train(docs, labels)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    scored = docs.select(row, scorer(docs, model)(F.col("text")).alias("score"))
    return scored.filter(F.col("score") < threshold).select("row.*")
