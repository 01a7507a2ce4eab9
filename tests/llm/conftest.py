from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names the operators use inside must not clash with columns of the input
    T.StructField("key", T.StringType()), T.StructField("row", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("words", T.StringType()),
    T.StructField("h", T.StringType()), T.StructField("p", T.StringType()), T.StructField("n", T.StringType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) tuples, with extra columns of clashing names."""
    def make(rows):
        return spark.createDataFrame([(i, t, la, s, None if t is None else len(t), "k", "r", "s", "w", "h", "p", "n")
                                      for i, t, la, s in rows], DOCS)
    return make


LONG = "One line that is long enough to count and comes in many documents."


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    very_long = "\n".join(f"word{i} and some more words {i % 7} of a very long text" for i in range(20_000))
    return [
        (None, None, None, None), (None, None, None, None), (1, None, "en", "a"), (2, "", "en", "a"),
        (3, " \t\n\r ", None, "b"), (4, "...!?", "de", None), (5, "short", "en", ""), (6, f"{LONG}\n\n{LONG}", "en", "a"),
        (7, f"  {LONG.upper()}\t\nÉcole Ü", "fr", "b"), (8, LONG, "en", "b"), (8, LONG, "en", "b"),
        (8, "the same id with another text", "en", "c"), (None, f"{LONG}\nno id", "en", "a"),
        (9, very_long, "en", "a"), (10, "a\x00b \\ <turn> % # | & ünïcödé 😀 text", "en", "c"), (2**62, LONG, "en", "z")]


@pytest.fixture(scope="session")
def edge_docs(make_docs, edge_rows):
    return make_docs(edge_rows)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])


def as_set(df, *columns):
    return sorted(map(tuple, df.select(*(columns or df.columns)).collect()), key=repr)
