"""Corpus-wide line deduplication with two Bloom filters.

A line's key is the line stripped of ASCII white space with A-Z lower-cased. Keys
of at least ``min_chars`` code points held by at least ``min_docs`` documents lose
their lines everywhere but in the largest doc_id that holds them.

One pass over the texts writes a narrow ledger: two 64-bit hashes per long line.
Tasks fill two Bloom filters from it: ``once`` takes every hash of a document,
``twice`` those that ``once`` already had. Filters of two tasks merge as
``twice = twice | twice' | (once & once')``, slice by slice. No repeated line can be
missed by ``twice``; lines it doesn't hold are never shuffled. The suspects are
confirmed exactly: documents are counted per 128 bits of key hash. The filter grows
with the number of lines up to ``max_bits``; beyond that more suspects are
shuffled, and the result is the same.

Edge cases: a null or empty text is one empty line, which is kept; white-space and
short lines are kept; a null doc_id counts as one document, smaller than all others;
rows with the same doc_id are one document; a key twice in a document counts once,
and all its lines go or stay together; texts and lines of any length are read whole;
equal rows give equal results; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, lookup_join, lower_ascii, row_key, settled, small_batches

SLICE_BYTES = 4096
BITS_PER_LINE = 8
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28
SECOND = np.uint64(0x9E3779B97F4A7C15)
#: Dropped line positions up to which the drop table is broadcast.
BROADCAST_POSITIONS = 2_000_000


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


# ------------------------------------------------------------------------ filters

def positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bit positions of each hash; ``bits`` is a power of two."""
    shift = np.uint64(64 - (bits.bit_length() - 1))
    return h >> shift, (h * SECOND) >> shift


def has(filter_bytes: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    out = np.ones(len(h), dtype=bool)
    for p in positions(h, bits):
        out &= (filter_bytes[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def put(filter_bytes: np.ndarray, h: np.ndarray, bits: int) -> None:
    for p in positions(h, bits):
        p = np.unique(p)
        at, bit = p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.array([], dtype=int)
        if len(first):
            filter_bytes[at[first]] |= np.bitwise_or.reduceat(bit, first)


def _fill(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for b in batches:
        flat = b.column("h").flatten().drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
        h, n = np.unique(flat, return_counts=True)
        put(twice, h[(n > 1) | has(once, h, bits)], bits)
        put(once, h, bits)
    size = min(SLICE_BYTES, bits // 8)
    used = np.flatnonzero(once.reshape(-1, size).any(axis=1))
    for k in range(0, len(used), 256):
        part = used[k:k + 256]
        yield pa.RecordBatch.from_pydict({
            "slice": pa.array(part.astype(np.int32)),
            "once": pa.array([zlib.compress(once[s * size:(s + 1) * size].tobytes(), 1) for s in part], pa.binary()),
            "twice": pa.array([zlib.compress(twice[s * size:(s + 1) * size].tobytes(), 1) for s in part], pa.binary())})


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slice → the merged ``twice`` of each slice; one slice is held at a time."""
    at, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"slice": pa.array([at], pa.int32()), "twice": pa.array([twice.tobytes()], pa.binary())})

    for b in batches:
        for s, o, t in zip(*[b.column(c).to_pylist() for c in ("slice", "once", "twice")]):
            o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
            if s != at:
                if at is not None and twice.any():
                    yield done()
                at, once, twice = s, o.copy(), t.copy()
            else:
                twice |= t | (once & o)
                once |= o
    if at is not None and twice.any():
        yield done()


def twice_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of hashes that more than one row holds; at most ``bits`` / 8 bytes."""
    builders = 4 * hashes.sparkSession.sparkContext.defaultParallelism
    slices = hashes.coalesce(builders).mapInArrow(lambda it: _fill(it, bits), "slice int, once binary, twice binary")
    merged = slices.repartition("slice").sortWithinPartitions("slice").mapInArrow(_merge, "slice int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    size = min(SLICE_BYTES, bits // 8)
    for r in merged.collect():  # bounded by the filter's size
        out[r["slice"] * size:(r["slice"] + 1) * size] = np.frombuffer(r["twice"], np.uint8)
    return out


# ---------------------------------------------------------------------- documents

def _ledger(docs: DataFrame, min_chars: int) -> DataFrame:
    """key, doc_id and two aligned hash arrays (null for lines that never go), written once."""
    d = docs.select("doc_id", row_key("doc_id", "text").alias("key"),
                    F.transform(text_lines(F.col("text")), line_key).alias("keys"))

    def long_lines(h):
        return F.transform("keys", lambda k: F.when(F.char_length(k) >= min_chars, h(k)))

    return settled(d.select("doc_id", "key", long_lines(lambda k: F.xxhash64(k)).alias("h"),
                            long_lines(lambda k: F.xxhash64(F.lit(1), k)).alias("g")))


def drops(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(key, gone): positions of the lines to drop, for documents that lose any."""
    small_batches(docs.sparkSession)
    rows = _ledger(docs, min_chars)
    n_lines = rows.agg(F.sum(F.size(F.array_compact("h")))).first()[0] or 0
    bits = min(max(MIN_BITS, 1 << (BITS_PER_LINE * n_lines).bit_length()), max_bits)
    seen = twice_filter(rows.select(F.array_distinct(F.array_compact("h")).alias("h")), bits)
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, flat = b.column("h"), b.column("h").flatten()
            known = np.asarray(flat.is_valid())
            h = flat.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)
            hit = np.flatnonzero(known & has(shared.value, h, bits))
            offsets = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
            row = np.searchsorted(offsets, hit, "right") - 1
            yield pa.RecordBatch.from_pydict({
                "doc_id": b.column("doc_id").take(pa.array(row)), "key": b.column("key").take(pa.array(row)),
                "p": pa.array((hit - offsets[row]).astype(np.int32)),
                "h": flat.take(pa.array(hit)), "g": b.column("g").flatten().take(pa.array(hit))})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = settled(rows.mapInArrow(probe, f"doc_id {id_type}, key string, p int, h bigint, g bigint"))
    per_doc = found.select("h", "g", "doc_id").distinct()
    repeated = per_doc.groupBy("h", "g").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).filter(F.col("n") >= min_docs)
    lost = lookup_join(found, settled(repeated.select("h", "g", "last")), ["h", "g"], "inner")
    lost = lost.filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    return settled(lost.groupBy("key").agg(F.collect_set("p").alias("gone")))


def _with_drops(docs: DataFrame, row: Column, found: DataFrame) -> DataFrame:
    keyed = docs.select(row, "doc_id", "text", row_key("doc_id", "text").alias("key"))
    few = (found.agg(F.sum(F.size("gone"))).first()[0] or 0) <= BROADCAST_POSITIONS
    joined = lookup_join(keyed, found, ["key"], "left", BROADCAST_ROWS if few else -1)
    joined = joined.withColumn("lines", text_lines(F.col("text")))
    n = F.size("lines")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), "gone")
    kept = F.array_join(F.transform(stay, lambda p: F.get("lines", p)), "\n")
    return joined.withColumn("n_lines", n.cast("long")).withColumn(
        "n_dropped", F.coalesce(F.size("gone"), F.lit(0)).cast("long")).withColumn(
        "kept", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept))


def line_report(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document: doc_id, its number of lines, those dropped, and the kept text."""
    out = _with_drops(docs, F.lit(0).alias("row"), drops(docs, min_chars, min_docs))
    return out.select("doc_id", "n_lines", "n_dropped", "kept")


def deduplicate_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with repeated lines dropped from ``text``; n_chars, if there is one,
    follows the new text. No document is dropped."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    out = _with_drops(docs, row, drops(docs, min_chars, min_docs))
    out = out.select("row", "kept", "n_dropped")

    def column(c: str) -> Column:
        if c == "text":
            return F.col("kept").alias("text")
        if c == "n_chars":
            kind = docs.schema[c].dataType
            changed = F.char_length("kept").cast(kind)
            return F.when(F.col("n_dropped") > 0, changed).otherwise(F.col("row.n_chars")).alias("n_chars")
        return F.col(f"row.`{c}`").alias(c)

    return out.select(*[column(c) for c in docs.columns])
