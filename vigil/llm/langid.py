"""Language identification in two steps: family, then language within the family.

Linear support vector machines on hashed byte n-grams. The first level tells
families apart, the second the languages of one family, both one against one:
every pair of classes has its machine, the class with the most wins is taken, and
summed margins decide ties. Machines are fitted on the driver from a bounded
sample of at most ``per_lang`` labelled documents of each language and broadcast;
whole texts are read in the tasks.

Edge cases: a null text, or one without letters, is ``und`` with score 0; without
labelled documents every text is ``und``; with one language it is that language;
a language missing from FAMILIES is a family of its own; equal texts get equal
answers; texts of any length are read whole; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .sample import held_out, labelled_texts
from .terms import gram_counts

GRAM_BITS = 12
GRAM_SIZES = (2, 3, 4)
PER_LANG = 800
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")

# Families of languages by their codes.
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "lb", "nb", "nl", "nn", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "semitic": ["ar", "he", "mt"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang.lower() in langs), lang)


def features(text: str | None) -> np.ndarray:
    """Square roots of n-gram shares, of length one."""
    x = np.sqrt(gram_counts(text, GRAM_BITS, GRAM_SIZES))
    norm = float(np.sqrt((x * x).sum()))
    return x / norm if norm else x


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 20.0, rounds: int = 150) -> np.ndarray:
    """Weights and bias (last) of a linear machine with squared hinge loss, both
    classes weighing the same; accelerated gradient descent. y is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    step = 1.0 / (1.0 + 4.0 * cost)
    w = z = np.zeros(x.shape[1], dtype=np.float32)
    for k in range(rounds):
        slack = np.maximum(0.0, 1.0 - y * (x @ z))
        grad = z - 2.0 * cost * (x.T @ (share * y * slack))
        new = z - step * grad
        z = new + (k / (k + 3.0)) * (new - w)
        w = new
    return w.astype(np.float32)


@dataclass
class Level:
    """One-against-one machines between classes."""

    classes: list[str]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    weights: np.ndarray | None = None

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray) -> "Level":
        classes = sorted(set(labels.tolist()))
        level = cls(classes, list(combinations(range(len(classes)), 2)))
        fitted = []
        for a, b in level.pairs:
            pick = (labels == classes[a]) | (labels == classes[b])
            fitted.append(fit_svm(x[pick], np.where(labels[pick] == classes[a], 1.0, -1.0).astype(np.float32)))
        level.weights = np.array(fitted, dtype=np.float32) if fitted else None
        return level

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """The class, and how sure its weakest machine is (0 to 1)."""
        if self.weights is None:
            return self.classes[0], 1.0
        margins = self.weights[:, :-1] @ x + self.weights[:, -1]
        wins, total = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        for (a, b), m in zip(self.pairs, margins):
            wins[a if m >= 0 else b] += 1
            total[a] += m
            total[b] -= m
        best = max(range(len(self.classes)), key=lambda k: (wins[k], total[k]))
        own = [m if best == a else -m for (a, b), m in zip(self.pairs, margins) if best in (a, b)]
        return self.classes[best], float(1.0 / (1.0 + np.exp(-3.0 * min(own))))


@dataclass
class Model:
    families: Level
    within: dict[str, Level]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.families.classes or not text or not LETTER.search(text):
            return UNKNOWN, 0.0
        x = features(text)
        family, sure = self.families.predict(x)
        lang, sure_too = self.within[family].predict(x)
        return lang, sure * sure_too


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Fit on documents with a language that aren't held out."""
    small_batches(docs.sparkSession)
    with_text = docs.filter(F.col("text").isNotNull())  # others take no place in the sample
    labels = with_text.select("doc_id", F.col("lang").alias("label"))

    @F.pandas_udf("binary")
    def grams(text: pd.Series) -> pd.Series:
        return text.map(lambda t: features(t).tobytes() if t and LETTER.search(t) else b"")

    rows = labelled_texts(with_text, labels, per_lang).select("doc_id", "label", grams("text").alias("x")).collect()
    rows = sorted((r for r in rows if r["x"]), key=lambda r: str(r["doc_id"]))
    if not rows:
        return Model(Level([]), {})
    x = np.stack([np.frombuffer(r["x"], dtype=np.float32) for r in rows])
    langs = np.array([r["label"] for r in rows])
    family = np.array([family_of(v) for v in langs])
    within = {f: Level.fit(x[family == f], langs[family == f]) for f in sorted(set(family.tolist()))}
    return Model(Level.fit(x, family), within)


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, per_lang))

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang", "score"])

    out = docs.select("doc_id", predict("text").alias("p"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("p.lang").alias("lang_pred"), "p.score")
