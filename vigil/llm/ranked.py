"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, no random access.

The terms of a block of items are broadcast (a block holds about ``BLOCK_TERMS``
term occurrences; more items are searched in more blocks). One pass over the texts
writes the index: per document its number of terms and the counts of the items'
terms in it. Corpus statistics come from that table.

Every task turns documents of its partition into shards of bounded size. In a shard
each term has a list of (document, impact), greatest impact first; an impact is what
the term adds to the document's score. For an item the lists are read in rounds, all
down to the same impact, which falls from round to round. A document read so far has
a score interval: what was read, and that plus the next impact of every list it
wasn't seen in. As soon as no unread document can reach the k-th best lower score,
only documents whose upper score reaches it stay; their lists are read on, and
documents drop out, until membership, ties and the scores of those left are settled.
A shard gives its k best per item, and the k best of all shards' are the answer:
scores don't depend on shards, so nothing is lost and no document is shuffled.

Edge cases: a null or empty text, or one without terms, is no document and no
result; an item without terms has no results; equal items (id and text) are one,
items that share only their id are ranked apart; equal scores are ordered by doc_id,
null ids last, rows with equal ids are documents of their own; texts and items of
any length are read whole; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settled, small_batches

#: Term occurrences of the items that are searched in one pass over the documents.
BLOCK_TERMS = 1 << 20
#: Documents and index entries at which a shard is searched.
SHARD_DOCS, SHARD_ENTRIES = 1 << 14, 1 << 22
#: Every round reads down to this share of the last round's impact.
FALL = 0.6
#: Buckets per item in the first of the two final rankings.
SALTS = 32
_PIECE = 1 << 20

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256))


def term_pieces(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text in order, a list for each piece of about a megabyte."""
    b = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    start = 0
    while start < len(b):
        end = b.find(b" ", start + _PIECE) if len(b) - start > _PIECE else -1
        end = len(b) if end < 0 else end
        yield b[start:end].split()
        start = end


def term_counts(text: str | None) -> Counter[bytes]:
    counts: Counter[bytes] = Counter()
    for piece in term_pieces(text):
        counts.update(piece)
    return counts


# -------------------------------------------------------------------------- items

def _items(items: DataFrame) -> DataFrame:
    """(no, item_id, terms): distinct items with their distinct terms, numbered by a hash."""
    @F.arrow_udf("array<binary>")
    def terms(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(term_counts(t)) for t in texts.to_pylist()], pa.list_(pa.binary()))

    distinct = items.select("item_id", "text").distinct()
    return settled(distinct.select("item_id", terms(F.col("text")).alias("terms"), F.xxhash64("item_id", "text").alias("hash"))
                   .filter(F.size("terms") > 0))


def _blocks(items: DataFrame, block_terms: int) -> Iterator[list]:
    """Rows (item_id, terms) of the items, block by block."""
    found = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-found // block_terms)
    for block in range(blocks):
        yield items.filter(F.pmod("hash", F.lit(blocks)) == block).select("item_id", "terms").collect()


# -------------------------------------------------------------------------- index

def index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of the documents with terms: n counts all its terms,
    terms and tfs are numbers and counts of those in the vocabulary. Written once."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("tfs", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for b in batches:
            n, terms, tfs, ends = [], [], [], [0]
            for text in b.column("text").to_pylist():
                counts = term_counts(text)
                for term, tf in counts.items():
                    k = number(term)
                    if k is not None:
                        terms.append(k)
                        tfs.append(tf)
                n.append(counts.total())
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            out = pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], names=["doc_id", "n", "terms", "tfs"])
            yield out.filter(pc.greater(out.column("n"), 0))

    return settled(docs.select("doc_id", "text").mapInArrow(run, schema))


# ------------------------------------------------------------------------- search

def _k_best(scores: np.ndarray, docs: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k greatest positive scores, equal ones by ascending document."""
    at = np.flatnonzero(scores > 0)
    if len(at) > k:
        at = at[scores[at] >= np.partition(scores[at], -k)[-k]]
    return at[np.lexsort((docs[at], -scores[at]))[:k]]


def nra(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best of documents 0 … n_docs-1 as (documents, scores), and the number of
    entries read. A list holds distinct documents and their positive impacts, greatest first."""
    lower = np.zeros(n_docs, np.int64)
    depth = [0] * len(lists)
    bound = np.array([impacts[0] for _, impacts in lists], np.int64)  # the next impact of each list
    falling = [-impacts for _, impacts in lists]
    alive: np.ndarray | None = None  # once set, the only documents that can still be among the k best
    read = 0
    while bound.any():
        level = min(int(bound.max()) - 1, int(bound.max() * FALL))
        for t in np.flatnonzero(bound > level):
            docs, impacts = lists[t]
            start, end = depth[t], int(np.searchsorted(falling[t], -level, "left"))
            part = slice(start, end)
            if alive is None:
                lower[docs[part]] += impacts[part]
            else:
                held = alive[docs[part]]
                lower[docs[part][held]] += impacts[part][held]
            read += end - start
            depth[t], bound[t] = end, impacts[end] if end < len(impacts) else 0
        some = np.flatnonzero(lower > 0 if alive is None else alive)
        kth = int(np.partition(lower[some], -k)[-k]) if len(some) >= k else 0
        if alive is None and int(bound.sum()) >= kth and bound.any():
            continue  # a document not read yet could still come in
        # upper scores: every list adds its next impact unless the document was read in it
        missing = np.full(n_docs, bound.sum(), np.int64)
        for t in np.flatnonzero(bound):
            missing[lists[t][0][:depth[t]]] -= bound[t]
        some = some[lower[some] + missing[some] >= kth]
        alive = np.zeros(n_docs, bool)
        alive[some] = True
        if not missing[some].any():
            break  # every interval is closed
    best = np.flatnonzero(lower > 0 if alive is None else alive)
    best = best[_k_best(lower[best], best, k)]
    return best, lower[best], read


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, docs, entries = [], 0, 0
    for b in batches:
        held.append(b)
        docs, entries = docs + b.num_rows, entries + len(b.column("terms").flatten())
        if docs >= SHARD_DOCS or entries >= SHARD_ENTRIES:
            yield pa.Table.from_batches(held)
            held, docs, entries = [], 0, 0
    if docs:
        yield pa.Table.from_batches(held)


def _lists(shard: pa.Table, weights: np.ndarray, n_all: int, n_terms: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """term -> (documents, impacts) of a shard, greatest impact first."""
    terms = shard.column("terms").combine_chunks()
    sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    term = terms.flatten().to_numpy(zero_copy_only=False)
    tf = shard.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    m = 100 - 90 + 90 * shard.column("n").to_numpy() * n_all // n_terms
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
    keep = impact > 0
    term, doc, impact = term[keep], doc[keep], impact[keep]
    order = np.lexsort((-impact, term))
    term, doc, impact = term[order], doc[order], impact[order]
    starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else []
    return {int(term[a]): (doc[a:b], impact[a:b]) for a, b in zip(starts, [*starts[1:], len(term)])}


def _search_block(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """(no, doc_id, score) of each shard's k best for the items of a block; no is the item's place in ``rows``."""
    vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in rows for t in r["terms"]}))}
    found = index(docs, vocabulary)
    all_docs, all_terms = found.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the block's terms
        df[r["t"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * all_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    items = [[vocabulary[bytes(t)] for t in r["terms"]] for r in rows]
    shared = docs.sparkSession.sparkContext.broadcast((weights, items))
    schema = T.StructType([T.StructField("no", T.IntegerType()), docs.schema["doc_id"], T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = shared.value
        for shard in _shards(batches):
            # number the documents in the order of their ids: ties go to the smaller number
            shard = shard.take(pc.sort_indices(shard, [("doc_id", "ascending")], null_placement="at_end"))
            lists = _lists(shard, weights, all_docs, all_terms)
            for no, terms in enumerate(items):
                at, scores, _ = nra([lists[t] for t in terms if t in lists], shard.num_rows, k)
                if len(at):
                    yield pa.RecordBatch.from_pydict({
                        "no": pa.array(np.full(len(at), no, np.int32)),
                        "doc_id": shard.column("doc_id").combine_chunks().take(pa.array(at)), "score": pa.array(scores)})

    return found.mapInArrow(run, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents (doc_id, text) with a
    positive score for each item (item_id, text)."""
    spark = docs.sparkSession
    schema = T.StructType([items.schema["item_id"], T.StructField("rank", T.IntegerType()),
                           docs.schema["doc_id"], T.StructField("score", T.LongType())])
    out = spark.createDataFrame([], schema)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]

    def ranked(best: DataFrame, *keys) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        return best.withColumn("rank", rank).filter(F.col("rank") <= k)

    for rows in _blocks(_items(items), block_terms):
        if not rows:
            continue
        best = _search_block(docs, rows, k).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        best = ranked(ranked(best, "no", "salt").drop("rank", "salt"), "no")
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)],
                                      T.StructType([T.StructField("no", T.IntegerType()), items.schema["item_id"]]))
        # the block's items: their number is bounded by its terms
        out = out.unionByName(best.join(F.broadcast(names), "no").select(*schema.names))
    return out
