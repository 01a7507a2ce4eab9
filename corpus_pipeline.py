"""The corpus pipeline: toxic documents go, repeated lines go, one document of each
near-duplicate group stays, contaminated documents go, and the sources are mixed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of
``docs``; the last one repeats documents as the mix takes them. ``run`` writes every
stage's rows to a new folder under the checkpoint folder and rereads them, so a
stage starts from files that survive lost executors, and no stage is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import decontam, linededup, mixing, simhash, toxicity
from vigil.llm.queries import SOURCE_WEIGHTS
from vigil.session import remove, scratch_path


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the factorization machine rejects."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated lines; no document goes."""
    return linededup.deduplicate_lines(docs, min_chars=20, min_docs=3)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash group."""
    return simhash.deduplicate(docs, shingle=3, distance=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat the documents so that the sources come to their target weights."""
    return mixing.mix(docs, SOURCE_WEIGHTS, share=1.5, max_epochs=2.0)


STAGES = [
    ("toxicity", toxic),
    ("line_dedup", lines),
    ("simhash", near_duplicates),
    ("decontamination", benchmark),
    ("mixing", mix),
]

#: SQL can't express the fitted machine or the fingerprints; tests hold the rows
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``. A stage's copy is removed once the
    next stage is written; the last one is what is returned."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs
