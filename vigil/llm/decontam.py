"""Benchmark decontamination by normalised word n-grams.

Every benchmark item gives its windows of ``n`` consecutive words (an item with
fewer words is one window). Every position of every document hashes the window that
starts there to 64 bits and looks it up in a broadcast set of the benchmark's hashes;
a hash that is found is verified by comparing the words. A set that is too large is
broadcast in blocks of hashes, each block against all documents. Only hits and one
narrow row per document are shuffled, at any size of the benchmark.

Edge cases: a null text has no words; items without words give no window; a null
item_id contaminates but is not listed; windows shared by items list all of them;
equal documents are all returned, each with the same result; documents are told
apart by doc_id and text, so a repeated doc_id with another text is judged by
itself; texts and items of any length are read whole; empty tables give no rows or no
hits; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, is_small, lookup_join, lower_ascii, row_key, settled, words_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Hashes of windows that are broadcast at once when windows with their words are too many.
BLOCK_HASHES = 4_000_000
PIECES = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased: runs of letters, digits and non-ASCII."""
    return words_of(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)


def _window(length: int) -> tuple[Column, Column]:
    """Hash and text of the window of that many words at position p of `words`."""
    parts = [F.get(F.col("words"), F.col("p") + k) for k in range(length)]
    return F.xxhash64(*parts), F.concat_ws(" ", *parts)


def benchmark_windows(items: DataFrame, n: int = 10) -> DataFrame:
    """Distinct windows (len, hash, gram) with the ids of the items that hold them."""
    b = items.select(F.col("item_id").cast("string").alias("item"), normal_words(F.col("text")).alias("words"))
    b = b.withColumn("size", F.size("words")).filter("size > 0")
    b = b.withColumn("len", F.least("size", F.lit(n)))
    b = b.select("item", "words", "len", F.explode(F.sequence(F.lit(0), F.col("size") - F.col("len"))).alias("p"))
    by_length = [(k, _window(k)) for k in range(1, n + 1)]
    pick = [F.coalesce(*[F.when(F.col("len") == k, w[i]) for k, w in by_length]) for i in (0, 1)]
    b = b.select("item", "len", pick[0].alias("hash"), pick[1].alias("gram"))
    return b.groupBy("len", "hash", "gram").agg(F.collect_set("item").alias("items"))


def _events(docs: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per (document, hit) and one marker per document (gram null unless a
    hit is there too); equal rows are counted in `copies`."""
    d = docs.select("doc_id", row_key("doc_id", "text").alias("key"), normal_words(F.col("text")).alias("words"))
    d = d.select("doc_id", "key", F.size("words").alias("n_words"), "words", F.posexplode_outer("words").alias("p", "w"))
    at = [F.struct(F.lit(k).alias("len"),
                   F.when(F.col("p") + k <= F.col("n_words"), _window(k)[0]).alias("hash")) for k in lengths]
    if len(at) == 1:
        d = d.select("doc_id", "key", "n_words", "words", "p", *[at[0][c].alias(c) for c in ("len", "hash")])
    else:
        d = d.select("doc_id", "key", "n_words", "words", "p", F.explode(F.array(*at)).alias("a"))
        d = d.select("doc_id", "key", "n_words", "words", "p", "a.len", "a.hash")
    marker = F.col("p").isNull() | ((F.col("p") == 0) & (F.col("len") == lengths[0]))
    text = F.coalesce(*[F.when(F.col("len") == k, _window(k)[1]) for k in lengths])
    if is_small(windows.select("gram", "len", "hash"), BROADCAST_ROWS):
        w = F.broadcast(windows.select(F.col("hash").alias("bhash"), F.col("len").alias("blen"), "gram"))
        same = (F.col("hash") == F.col("bhash")) & (F.col("len") == F.col("blen")) & (F.col("gram") == text)
        found = d.join(w, same, "left").filter(F.col("gram").isNotNull() | marker)
    else:  # the hashes alone are broadcast, block by block; window texts travel for hits only
        blocks = -(-windows.count() // BLOCK_HASHES)
        found = d.filter(marker).withColumn("gram", F.lit(None).cast("string")).drop("words")
        for block in range(blocks):
            some = windows.filter(F.pmod("hash", F.lit(blocks)) == block)
            hashes = F.broadcast(some.select("hash").distinct())  # 8 bytes for each of about BLOCK_HASHES
            hits = settled(d.join(hashes, "hash", "left_semi").withColumn("gram", text).drop("words"))
            found = found.unionByName(lookup_join(hits, some.select("len", "hash", "gram"), ["len", "hash", "gram"], "inner"))
    return found.groupBy("doc_id", "key", "n_words", "p", "len", "gram").agg(F.count("*").alias("copies"))


def scan(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Per document row: doc_id, key, n_words, n_hit, the sorted ids of the items
    found, and the hit spans as [from, to) word positions, merged."""
    windows = settled(benchmark_windows(items, n))
    lengths = sorted(r["len"] for r in windows.select("len").distinct().collect()) or [n]  # at most n values
    events = settled(_events(docs, windows, lengths))
    end = F.when(F.col("gram").isNull(), F.lit(0)).otherwise(F.col("p") + F.col("len"))
    e = events.withColumn("end", end)
    order = W.partitionBy("doc_id", "key").orderBy("p", "len", "gram")
    e = e.withColumn("reach", F.coalesce(F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    hit = F.col("gram").isNotNull()
    e = e.withColumn("add", F.when(hit, F.greatest(F.lit(0), F.col("end") - F.greatest("p", "reach"))).otherwise(F.lit(0)))
    e = e.withColumn("run", F.sum((hit & (F.col("p") > F.col("reach"))).cast("int")).over(order))
    runs = e.groupBy("doc_id", "key", "n_words", "run").agg(
        F.sum("add").alias("add"), F.max("copies").alias("copies"),
        F.min(F.when(hit, F.col("p"))).alias("from"), F.max(F.when(hit, F.col("end"))).alias("to"))
    per_doc = runs.groupBy("doc_id", "key", "n_words").agg(
        F.sum("add").cast("long").alias("n_hit"), F.max("copies").alias("copies"),
        F.sort_array(F.collect_list(F.when(F.col("to").isNotNull(), F.struct("from", "to")))).alias("spans"))
    grams = events.filter("gram IS NOT NULL").select("key", "gram").distinct()
    found = lookup_join(grams, windows.select("gram", "items"), ["gram"], "inner")
    found = found.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    out = per_doc.join(found, "key", "left")
    no_items = F.array().cast("array<string>")
    return out.select("doc_id", "key", F.col("n_words").cast("long").alias("n_words"), "n_hit", "spans",
                      F.coalesce("items", no_items).alias("items"),
                      F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, remove: str = "documents") -> DataFrame:
    """``docs`` without contaminated documents, or (remove="spans") with the hit
    words cut out of their texts."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    hits = scan(docs, items, n).filter("n_hit > 0")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, row_key("doc_id", "text").alias("key"))
    if remove == "documents":
        return lookup_join(keyed, settled(hits.select("key").distinct()), ["key"], "left_anti").select("row.*")
    spans = settled(hits.select("key", "spans").dropDuplicates(["key"]))
    out = lookup_join(keyed, spans, ["key"], "left")
    pieces = F.regexp_extract_all(F.col("row.text"), F.lit(PIECES), F.lit(0))
    kept = F.filter(pieces, lambda x, i: ~F.exists("spans", lambda s: (s["from"] <= i) & (i < s["to"])))
    tail = F.regexp_extract(F.col("row.text"), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*$", 0)
    cut = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(F.concat(F.array_join(kept, ""), tail))
    return out.select("row.*", cut.alias("__cut")).select(
        *[F.col("__cut").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
