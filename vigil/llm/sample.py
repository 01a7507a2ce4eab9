"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import lookup_join, settled


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3: 1 marks the held-out documents."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 1, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """At most ``per_label`` documents (doc_id, label, text) of each label in
    ``labels`` (doc_id, label), never a held-out one.

    The documents with the smallest hashes of their ids are taken, so reruns take
    the same. Labels are counted first: only ids whose hash is in the share that
    holds about twice the wanted number are ranked, however many a label has. Texts
    are read for the documents taken. Of rows with the same doc_id one is taken;
    documents without id or label are not.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold(F.col("doc_id")) != 1))
    known = settled(known.groupBy("doc_id").agg(F.max("label").alias("label")))
    counts = settled(known.groupBy("label").agg(F.count("*").alias("n")))
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 1) / F.lit(float(1 << 63))
    near = lookup_join(known.withColumn("place", place), counts, ["label"], "inner")
    near = near.filter(F.col("place") * F.col("n") <= 2 * per_label + 20)
    order = W.partitionBy("label").orderBy("place", "doc_id")
    taken = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_label).select("doc_id", "label")
    taken = settled(taken)  # at most per_label rows of each label
    texts = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")
    return texts.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
