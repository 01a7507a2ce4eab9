"""Registered queries of the corpus operators, with production parameters.

Each query reads its whole tables, runs the operator and derives the digest
columns of its contract from the operator's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, hardneg, langid, linededup, mixing, oracle, pii, quality, ranked, sample, simhash, toxicity, urlfilter

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}

#: Rules of the URL query: (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: File of the public vocabulary, found by the installed package that holds it.
VOCABULARY = "byte_bpe_50k.json"
#: Weights of the sources in code point order, repeated.
SOURCE_WEIGHTS = [3, 1, 2]


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_decontamination", oracle.DECONTAMINATION)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@register("op2_url_filter", oracle.URL_FILTER)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules, default="allow")


@register("op3_pii_surrogates")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.vigil.surrogates.key", "surrogates-1")  # a job sets its own
    return pii.replace(table(spark, sf_dir, "documents"), key).select("doc_id", "n_entities", "text")


@register("op4_chat_format")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.read_back(chat.format_windows(turns.unionByName(probe)), in_order=True)


@register("op5_quality_rules", oracle.QUALITY)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    base = quality.POLICIES["base"]
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       (~quality.passes(base)).alias("base_failed"),
                       quality.passes(quality.POLICIES[quality.CURRENT]).alias("kept"),
                       "failed")


@register("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@register("op7_line_dedup", oracle.LINE_DEDUP)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.line_report(table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


@register("op8_mixing", oracle.MIXING)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS, share=1.5, max_epochs=2.0)


@register("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toxicity.with_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", sample.held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@register("op10_simhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.group(table(spark, sf_dir, "documents"), shingle=3, distance=3)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register("op11_hard_negatives", oracle.HARD_NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, wrong = F.col("vec_id"), F.col("embedding")
    finite = F.forall(wrong, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    vectors = table(spark, sf_dir, "embeddings").filter(finite).select(
        "vec_id", F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vector"))
    return hardneg.mine(vectors, vec_id % 100 == 0, n_pos=5, n_neg=10, low=30, high=90)


@register("op12_bpe")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = bpe.Vocabulary.read(public_tokenizers.path(VOCABULARY))
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    out = bpe.decode(encoded.select("doc_id", "ids"), vocabulary)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op13_ranked_search", oracle.RANKED_SEARCH)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
