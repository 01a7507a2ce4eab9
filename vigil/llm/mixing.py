"""Mixing sources to target weights by capped water-filling.

Targets share ``share`` of all sizes by weight; a source whose target exceeds
``max_epochs`` times its size is clamped there and the excess goes to the others
by weight, until none is above. The fixed point is found without a loop: sources
are clamped in the order of size per weight, so prefix sums over that order give
the water level each source would see, and the first source below its cap sets
the level for all that follow.

Repetitions: every document is taken ``floor(target / source_size)`` times, and
the rest of the target is filled with further single copies in the order of a
seeded hash. The cut in that order is found from sums over hash buckets, and by
prefix sums over the distinct order values of the one bucket per source that holds
the cut, range by range; no source is sorted whole. Rows that agree in id, size and
text share an order value: if the cut lies among them, only as many are taken as
come up to the target, found from counts by partition.

Edge cases: a null text has size 0; a null source is a source of its own, ordered
last; a null doc_id is a value like any other; equal rows tie on everything and
are interchangeable, their number doesn't matter; a text of any length is one
document, so a source ends within half its last document of the target; an empty
table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import count_words, lookup_join, settled

BUCKET_BITS = 12
HASH_BITS = 52


def seeded_hash(seed: int, doc_id: Column) -> Column:
    """52 bits of an MD5 over seed and id, as a long."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _order(seed: int) -> Column:
    """Where a document stands in its source's order (`size` must exist)."""
    return F.struct(seeded_hash(seed, F.col("doc_id")).alias("u"),
                    F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                    F.col("size").alias("size"),
                    F.xxhash64("text").alias("text"))


def _source_key(c: Column) -> Column:
    """Non-null stand-in for a source, so that joins match the null source."""
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c.cast("string")))


def ledger(docs: DataFrame, seed: int) -> DataFrame:
    """One narrow row per document: source, size and place in the order, written once."""
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"),
                        "text", count_words(F.col("text")).alias("size"))
    return settled(sized.select("doc_id", "source", _source_key(F.col("source")).alias("skey"),
                                "size", _order(seed).alias("at")))


def water_fill(sizes: DataFrame, weights: list[int], share: float, max_epochs: float) -> DataFrame:
    """(skey, source, source_size) → with w and target, one row per source."""
    by_name = W.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("rn", F.row_number().over(by_name))
    s = s.withColumn("w", F.element_at(cycle, ((F.col("rn") - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", max_epochs * F.col("source_size").cast("double"))
    order = W.orderBy(F.col("cap") / F.col("w"), "rn")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.select("*", (share * F.sum("source_size").over(everything)).alias("total"),
                 F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("used"),
                 F.sum("w").over(onward).alias("w_left"),
                 F.row_number().over(order).alias("k"))
    s = s.withColumn("num", F.col("total") - F.col("used"))
    s = s.withColumn("clamped", F.col("w") * F.col("num") > F.col("cap") * F.col("w_left"))
    level = F.min(F.when(~F.col("clamped"), F.struct("k", "num", "w_left"))).over(everything)
    s = s.withColumn("level", level)
    under = F.col("level").isNotNull() & (F.col("k") >= F.col("level.k"))
    return s.select("skey", "source_size", "w", F.when(
        under, F.col("w") * F.col("level.num") / F.col("level.w_left")).otherwise(F.col("cap")).alias("target"))


def mix_plan(rows: DataFrame, weights: list[int], share: float, max_epochs: float) -> DataFrame:
    """Per source: size, target, whole copies, the last place in the order that still
    gets one more copy (null: none does), and how many of the rows there get it."""
    bucket = F.shiftright(F.col("at.u"), HASH_BITS - BUCKET_BITS)
    sums = settled(rows.groupBy("skey", "source", bucket.alias("bucket")).agg(F.sum("size").alias("words")))
    sizes = sums.groupBy("skey", "source").agg(F.sum("words").alias("source_size"))
    plan = water_fill(sizes, weights, share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.withColumn("whole", whole.cast("long"))
    plan = settled(plan.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")))

    upto = W.partitionBy("skey").orderBy("bucket")
    cum = sums.withColumn("end", F.sum("words").over(upto)).withColumn("start", F.col("end") - F.col("words"))
    cum = lookup_join(cum, plan.select("skey", "need"), ["skey"], "inner")
    edge = settled(cum.filter((F.col("start") <= F.col("need")) & (F.col("need") < F.col("end")))
                   .groupBy("skey", "need").agg(F.min("bucket").alias("edge"), F.min("start").alias("start")))
    inside = lookup_join(rows.select("skey", "size", "at", bucket.alias("bucket")), edge, ["skey"], "inner")
    inside = inside.filter(F.col("bucket") == F.col("edge"))
    ties = inside.groupBy("skey", "need", "start", "at").agg(F.count("*").alias("n"))
    # prefix sums over ranges of the order: sums of the ranges before, and within the range
    ties = settled(ties.repartitionByRange("skey", "at").withColumn("range", F.spark_partition_id()))
    words = F.col("n") * F.col("at.size")
    before = W.partitionBy("skey").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    ranges = ties.groupBy("skey", "range").agg(F.sum(words).alias("words"))
    ranges = ranges.select("skey", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("earlier"))
    within = W.partitionBy("skey", "range").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    ties = ties.withColumn("inner", F.coalesce(F.sum(words).over(within), F.lit(0)))
    ties = lookup_join(ties, settled(ranges), ["skey", "range"], "inner")
    # the j-th of the tied rows (from 0) is taken if its middle is within the need
    room = F.col("need") - F.col("start") - F.col("earlier") - F.col("inner") - F.col("at.size") / 2
    fit = F.when(F.col("at.size") > 0, F.floor(F.try_divide(room, F.col("at.size"))) + 1).otherwise(F.when(room >= 0, F.col("n")))
    take = F.least(F.greatest(F.coalesce(fit, F.lit(0)), F.lit(0)), F.col("n")).cast("long")
    cuts = ties.withColumn("take", take).filter("take > 0").groupBy("skey").agg(
        F.max_by(F.struct("at", "take", "n"), "at").alias("last"))
    cuts = cuts.select("skey", F.col("last.at").alias("cut"), "last.take", F.col("last.n").alias("tied"))
    plan = plan.drop("need").join(edge.select("skey", "edge"), "skey", "left").join(cuts, "skey", "left")
    return settled(plan)


def _with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (skey, at, …) with their source's plan and ``copies``: the whole ones, and one
    more up to the source's cut."""
    bucket = F.shiftright(F.col("at.u"), HASH_BITS - BUCKET_BITS)
    more = (bucket < F.col("edge")) | ((bucket == F.col("edge")) & F.col("cut").isNotNull() & (F.col("at") <= F.col("cut")))
    out = lookup_join(rows, plan, ["skey"], "inner")
    out = out.withColumn("copies", F.col("whole") + F.coalesce(more, F.lit(False)).cast("long"))
    if plan.filter("take < tied").isEmpty():
        return out
    # the cut lies among tied rows of some source: these are written out and the first ones taken
    split = F.coalesce((F.col("take") < F.col("tied")) & (F.col("at") == F.col("cut")), F.lit(False))
    tied = settled(out.filter(split).withColumn("place", F.monotonically_increasing_id()))
    part = F.shiftright("place", 33)  # partition of the written rows
    before = W.partitionBy("skey").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = tied.groupBy("skey", part.alias("part")).count()
    parts = settled(parts.select("skey", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier")))
    tied = lookup_join(tied.withColumn("part", part), parts, ["skey", "part"], "inner")
    # all of a partition's rows, none, or (one partition of each source) the first few
    inner = F.row_number().over(W.partitionBy("skey", "part").orderBy("place"))
    tied = tied.withColumn("copies", F.col("whole") + (F.col("earlier") + inner <= F.col("take")).cast("long"))
    return out.filter(~split).unionByName(tied.drop("place", "part", "earlier"))


def mix_report(docs: DataFrame, weights: list[int], share: float = 1.5, max_epochs: float = 2.0,
               seed: int = 17) -> DataFrame:
    """Per document: size, its source's size and target, and the words the mix takes."""
    rows = ledger(docs, seed)
    plan = mix_plan(rows, weights, share, max_epochs)
    out = _with_copies(rows, plan)
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, weights: list[int], share: float = 1.5, max_epochs: float = 2.0,
        seed: int = 17) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it."""
    plan = mix_plan(ledger(docs, seed), weights, share, max_epochs)
    cols = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(cols, "doc_id", "text", F.col("source").cast("string").alias("source"),
                       count_words(F.col("text")).alias("size"))
    rows = rows.select("row", _source_key(F.col("source")).alias("skey"), _order(seed).alias("at"))
    out = _with_copies(rows, plan).filter("copies > 0")
    return out.select(F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "row").select("row.*")
