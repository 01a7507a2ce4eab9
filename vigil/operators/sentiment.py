"""Text negativity: M15, M16, M17, A5, A6, J6, X2.

A scorer is ``Callable[[DataFrame, str], DataFrame]``: it gets rows with a
text column and returns them with a ``score`` column (probability of the
negative label, 0..1). Three scorers ship:

* ``lexicon_scorer`` – built-in expressions only (JVM, codegen), SQL-checkable.
* ``TrainedScorer`` – spark.ml RegexTokenizer → HashingTF → IDF →
  LogisticRegression fitted on labelled documents.
* ``model_adapter`` – wraps any Python batch model through ``mapInPandas``
  (Arrow batches of the model's batch size; model built once per task).

Texts are scored whole (no 512-character prefix): that cut is a model input
limit, which the lexicon does not have; a wrapped model truncates by itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import expressions as X
from ..sources import extract
from ..sources.tables import SourceTables

TOKEN_PATTERN = "[a-z]+"


def _blank_guard(text: F.Column) -> F.Column:
    """Missing, or fewer than 3 characters after Python-style strip.

    Written as one anchored match with possessive quantifiers (whitespace*,
    at most two non-space characters, whitespace*), so a long text is
    rejected after its first few characters instead of being stripped.
    """
    ws = X.py_whitespace_class()
    nws = "[^" + ws[1:]
    return text.isNull() | text.rlike(f"^{ws}*+(?:{nws}{{1,{C.TEXT_MIN_STRIPPED - 1}}})?{ws}*+$")


def lexicon_score(text, lexicon: list[str] | None = None) -> F.Column:
    """M15 (lexicon form): share of lower-case ASCII word tokens found in the lexicon.

    Tokens are maximal ``[a-z]+`` runs of the lower-cased text; hits are
    lexicon words matched as whole tokens. Both are regex counts, so no
    per-text token array is built.
    """
    lexicon = lexicon or C.NEGATIVE_LEXICON
    t = X.col(text)
    body = F.lower(t)
    n = F.regexp_count(body, F.lit(TOKEN_PATTERN))
    words = "|".join(lexicon)
    hits = F.regexp_count(body, F.lit(f"(?<![a-z])(?:{words})(?![a-z])"))
    return (F.when(_blank_guard(t) | (n == 0), F.lit(0.0))
            .otherwise(hits.cast("double") / n.cast("double")))


def lexicon_scorer(df: DataFrame, text_col: str = "content") -> DataFrame:
    return df.withColumn("score", lexicon_score(text_col))


def score_texts(texts: DataFrame, scorer: Callable | None = None, text_col: str = "content") -> DataFrame:
    """M15 over a text DataFrame."""
    return (scorer or lexicon_scorer)(texts, text_col)


def negativity_from_scores(scored: DataFrame, key: str = "user_id") -> DataFrame:
    """Mean of strictly positive scores per key, else 0.0 (partial agg, no lists)."""
    return (scored.groupBy(key)
            .agg(F.coalesce(F.avg(F.when(F.col("score") > 0, F.col("score"))), F.lit(0.0))
                 .alias("sentiment_negativity_index")))


def negativity_index(src: SourceTables, scorer: Callable | None = None,
                     resolve_ids: bool = True) -> DataFrame:
    """U1 → M15 → A6 keyed by root id.

    With ``resolve_ids`` message scores are first summed per messaging id
    (map-side combine), then mapped to root ids through J9 — the join sees
    one row per sender, so a sender holding a third of all messages costs
    one row, not a third of the shuffle.
    """
    parts = extract.text_sources(src)
    pos = F.when(F.col("score") > 0, F.col("score"))

    def partial(df: DataFrame) -> DataFrame:
        return (score_texts(df, scorer).groupBy("user_id")
                .agg(F.sum(pos).alias("s"), F.count(pos).alias("n")))

    social = partial(parts["post"].unionByName(parts["comment"]))
    msgs = partial(parts["message"])
    if resolve_ids:
        m = extract.id_map(src).select("messaging_id", "root_id")
        msgs = (msgs.join(m, msgs["user_id"] == m["messaging_id"], "inner")
                .select(F.col("root_id").alias("user_id"), "s", "n"))
    both = social.unionByName(msgs)
    return (both.groupBy("user_id")
            .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
            .select("user_id",
                    F.when(F.col("n") > 0, F.col("s") / F.col("n")).otherwise(F.lit(0.0))
                    .alias("sentiment_negativity_index")))


def join_negativity(features: DataFrame, negativity: DataFrame, key: str = "user_id_raiz") -> DataFrame:
    """Features ⟕ negativity on root id, missing → 0.0."""
    n = negativity.select(F.col("user_id").alias("_neg_uid"),
                          F.col("sentiment_negativity_index").alias("_neg"))
    if "sentiment_negativity_index" in features.columns:
        features = features.drop("sentiment_negativity_index")
    return (features.join(n, features[key] == n["_neg_uid"], "left")
            .withColumn("sentiment_negativity_index", F.coalesce(F.col("_neg"), F.lit(0.0)))
            .drop("_neg_uid", "_neg"))


def texts_per_user(texts: DataFrame) -> DataFrame:
    """A5 in long form: texts and characters per user (null ids drop out)."""
    return (texts.filter(F.col("user_id").isNotNull()).groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("n_texts"),
                 F.sum(F.length("content")).cast("long").alias("n_chars")))


# ---------------------------------------------------------------- M16 / X2(c)

class LexiconModel:
    """Python twin of ``lexicon_score`` for the adapter (same tokens, same guard)."""

    def __init__(self, lexicon: list[str] | None = None):
        self.lexicon = frozenset(lexicon or C.NEGATIVE_LEXICON)
        self.token = re.compile(TOKEN_PATTERN)

    def __call__(self, texts: list[str]) -> list[float]:
        out = []
        for t in texts:
            if not t or len(t.strip()) < C.TEXT_MIN_STRIPPED:
                out.append(0.0)
                continue
            toks = self.token.findall(t.lower())
            out.append(sum(w in self.lexicon for w in toks) / len(toks) if toks else 0.0)
        return out


def model_adapter(model_factory: Callable[[], Callable[[list[str]], list[float]]] = LexiconModel,
                  batch_size: int = C.MODEL_BATCH):
    """Scorer that runs a Python batch model with ``mapInPandas``.

    The factory is called once per task (model load), batches follow the
    model batch size, and nulls become "" as in the reference batch path.
    """
    def scorer(df: DataFrame, text_col: str = "content") -> DataFrame:
        schema = T.StructType(df.schema.fields + [T.StructField("score", T.DoubleType())])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = model_factory()
            for pdf in batches:
                texts = pdf[text_col].fillna("").astype(str).tolist()
                scores: list[float] = []
                for i in range(0, len(texts), batch_size):
                    scores.extend(model(texts[i:i + batch_size]))
                yield pdf.assign(score=pd.Series(scores, index=pdf.index, dtype="float64"))

        return df.mapInPandas(run, schema)
    return scorer


# ---------------------------------------------------------------- X2(b)

class TrainedScorer:
    """spark.ml text classifier fitted on labelled texts (label 1 = negative)."""

    def __init__(self, num_features: int = 1 << 16, reg_param: float = 0.01, max_iter: int = 30):
        self.num_features = num_features
        self.reg_param = reg_param
        self.max_iter = max_iter
        self.model = None

    def fit(self, labelled: DataFrame, text_col: str = "text", label_col: str = "label") -> "TrainedScorer":
        from pyspark.ml import Pipeline
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

        data = labelled.select(F.col(text_col).alias("_text"), F.col(label_col).cast("double").alias("_label"))
        pipe = Pipeline(stages=[
            RegexTokenizer(inputCol="_text", outputCol="_tok", pattern="[^a-z]+", toLowercase=True),
            HashingTF(inputCol="_tok", outputCol="_tf", numFeatures=self.num_features),
            IDF(inputCol="_tf", outputCol="_feat"),
            LogisticRegression(featuresCol="_feat", labelCol="_label", probabilityCol="_prob",
                               regParam=self.reg_param, maxIter=self.max_iter),
        ])
        self.model = pipe.fit(data)
        return self

    def __call__(self, df: DataFrame, text_col: str = "content") -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        if self.model is None:
            raise RuntimeError("TrainedScorer.fit first")
        scored = self.model.transform(df.withColumn("_text", F.coalesce(F.col(text_col), F.lit(""))))
        p = vector_to_array("_prob")[1]
        return (scored.withColumn("score", F.when(_blank_guard(F.col(text_col)), F.lit(0.0)).otherwise(p))
                .drop("_text", "_tok", "_tf", "_feat", "rawPrediction", "_prob", "prediction"))
