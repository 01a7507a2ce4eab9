"""Hard negatives by segment summary filtering.

Vectors are cut into segments, first few, then more. Of each segment the mean and
the deviation (root of the mean squared distance to it) are stored with the vector.
For two segments of length l the inner product is at least l(m·m' - d·d') and at
most l(m·m' + d·d'), so sums over the segments bound a score. Pairs whose interval
can't matter are dropped at the coarse segments, the rest at the finer ones, and
only what is left is scored exactly.

Anchors are searched in groups of at most ``GROUP`` against all rows. A task holds
the k best of its rows for every anchor; the worst of them is the threshold the
bounds are held against. The first threshold is the exact k-th best among the
anchors' own rows, found before: it keeps what tasks hand on near to what is asked
for, however many tasks there are. Positives come first (the best rows of the
anchor's label), then for each positive the best rows of other labels in the range
of scores it allows. No pair of rows is ever written.

Edge cases: rows with a null vec_id, label or vector, or a null component take no
part (the caller drops other rows by a null vector); components are whole numbers,
held to ±2^24; a shorter vector counts as filled up with zeros, an empty one scores
0 with all; of rows that share a vec_id the one with the smallest (label, vector)
takes part; equal scores go to the smaller vec_id, however many there are; an anchor
without positives, or a positive without negatives, gives no rows; empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import lookup_join, settled, small_batches

#: Numbers of segments, coarse to fine.
SEGMENTS = (4, 16)
#: Anchors that are searched together, and those of them scored as one block.
GROUP, BLOCK = 4096, 512
#: Above this share of pairs left, a block is scored as a whole matrix.
DENSE = 1 / 8
LIMIT = 1 << 24
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


# ---------------------------------------------------------------------- summaries

def summaries(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x, mean, dev): vectors (vec_id, label, vector) as packed numbers,
    with the summaries of all their segments. Written once."""
    small_batches(vectors.sparkSession, rows=2000)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                          F.col("vector").cast("array<long>").alias("vector"))
    rows = rows.dropna().filter(~F.exists("vector", lambda x: x.isNull()))
    twice = settled(rows.groupBy("vec_id").count().filter("count > 1").select("vec_id"))
    if not twice.isEmpty():
        least = F.min(F.struct("label", "vector")).alias("least")
        one = lookup_join(rows, twice, ["vec_id"], "left_semi").groupBy("vec_id").agg(least).select("vec_id", "least.*")
        rows = lookup_join(rows, twice, ["vec_id"], "left_anti").unionByName(one)
    longest = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    width = max(-(-longest // SEGMENTS[-1]), 1) * SEGMENTS[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("vector")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            x = np.zeros((len(sizes), width), np.int32)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            x[np.arange(width) < sizes[:, None]] = np.clip(flat, -LIMIT, LIMIT)
            parts = [x.reshape(len(x), s, width // s) for s in SEGMENTS]
            packed = {"x": x, "mean": np.concatenate([p.mean(axis=2) for p in parts], axis=1),
                      "dev": np.concatenate([p.std(axis=2) for p in parts], axis=1)}
            yield pa.RecordBatch.from_pydict(
                {"vec_id": b.column("vec_id"), "label": b.column("label")}
                | {c: pa.array([r.tobytes() for r in v], pa.binary()) for c, v in packed.items()})

    return settled(rows.mapInArrow(run, "vec_id long, label long, x binary, mean binary, dev binary"))


class Rows:
    """Unpacked rows of a summary table."""

    def __init__(self, table):
        self.ids, self.labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
        self.x, self.mean, self.dev = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), kind).reshape(len(self.ids), -1)
            for c, kind in (("x", np.int32), ("mean", np.float64), ("dev", np.float64)))
        self.top = int(np.abs(self.x).max(initial=0))

    def part(self, start: int, end: int) -> Rows:
        out = object.__new__(Rows)
        for name in ("ids", "labels", "x", "mean", "dev"):
            setattr(out, name, getattr(self, name)[start:end])
        out.top = self.top
        return out


# ------------------------------------------------------------------------- bounds

def _products(a: np.ndarray, b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Inner products of all rows of a and b, or of the given pairs."""
    if pairs is None:
        return a @ b.T
    return np.einsum("ij,ij->i", a[pairs[0]], b[pairs[1]])


def close_pairs(a: Rows, b: Rows, allowed: np.ndarray, useful: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score) of the allowed pairs (a mask) whose interval of scores stays
    useful at all segment lengths. ``useful(i, lower, upper)`` tells it of pairs with
    anchors i, or of a matrix with one row per anchor if i is None."""
    width = a.x.shape[1]
    slack = 1e-9 * width * a.top * b.top + 1e-6  # more than rounding can amount to
    mask, pairs, start = allowed, None, 0
    for s in SEGMENTS:
        seg = slice(start, start + s)
        start += s
        middle = _products(a.mean[:, seg], b.mean[:, seg], pairs) * (width / s)
        spread = _products(a.dev[:, seg], b.dev[:, seg], pairs) * (width / s) + slack
        if pairs is None:
            mask = mask & useful(None, middle - spread, middle + spread)
            if mask.sum() <= DENSE * mask.size:
                pairs = np.nonzero(mask)
        else:
            keep = useful(pairs[0], middle - spread, middle + spread)
            pairs = pairs[0][keep], pairs[1][keep]
    exact = np.float64 if width * a.top * b.top < 1 << 53 else np.int64
    scores = _products(a.x.astype(exact), b.x.astype(exact), pairs)
    if pairs is None:
        pairs = np.nonzero(mask)
        scores = scores[pairs]
    return *pairs, scores.astype(np.int64)


class Best:
    """The k best (score, smaller id first) of each key, none worse than the key's floor."""

    def __init__(self, keys: int, k: int, floor: np.ndarray | None = None, floor_id: np.ndarray | None = None):
        self.k = k
        self.score, self.id = np.full((keys, k), LOWEST), np.full((keys, k), HIGHEST)
        self.floor = np.full(keys, LOWEST) if floor is None else floor
        self.floor_id = np.full(keys, HIGHEST) if floor_id is None else floor_id

    def least(self) -> np.ndarray:
        """The score a row needs at least, by key."""
        return np.maximum(self.floor, self.score[:, -1])

    def offer(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        def within(least: np.ndarray, last: np.ndarray) -> np.ndarray:
            return (score > least[key]) | ((score == least[key]) & (ids <= last[key]))

        keep = within(self.floor, self.floor_id) & within(self.score[:, -1], self.id[:, -1])
        key, score, ids = key[keep], score[keep], ids[keep]
        touched = np.unique(key)
        key = np.r_[key, np.repeat(touched, self.k)]
        score, ids = np.r_[score, self.score[touched].ravel()], np.r_[ids, self.id[touched].ravel()]
        order = np.lexsort((ids, -np.maximum(score, LOWEST + 1), key))
        key, score, ids = key[order], score[order], ids[order]
        place = np.arange(len(key)) - np.searchsorted(key, key)
        first = place < self.k
        self.score[key[first], place[first]], self.id[key[first], place[first]] = score[first], ids[first]

    def rows(self) -> pa.RecordBatch:
        key, place = np.nonzero(self.id != HIGHEST)
        return pa.RecordBatch.from_pydict({"key": pa.array(key.astype(np.int32)),
                                           "score": pa.array(self.score[key, place]), "vec_id": pa.array(self.id[key, place])})


def _pass(rows: DataFrame, shared, k: int, search: Callable) -> DataFrame:
    """(key, score, vec_id, rank): the k best of all rows for every key. ``search(best,
    anchors, at, block)`` offers a block of rows for the anchors from place ``at`` on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, floor, floor_id = shared.value
        best = Best(len(floor), k, floor, floor_id)
        for b in batches:
            block = Rows(b)
            for at in range(0, len(anchors.ids), BLOCK):
                search(best, anchors.part(at, at + BLOCK), at, block)
        yield best.rows()

    found = rows.mapInArrow(run, "key int, score long, vec_id long")
    order = W.partitionBy("key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _floors(found: DataFrame, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k-th best (score, id) of each key as its floor; ``floor`` where there is none."""
    floor, ids = floor.copy(), np.full(len(floor), HIGHEST)
    for r in found.filter(F.col("rank") == k).collect():  # at most one row for each key of the group
        floor[r["key"]], ids[r["key"]] = r["score"], r["vec_id"]
    return floor, ids


# ------------------------------------------------------------------------- search

def _search_positives(best: Best, a: Rows, at: int, b: Rows) -> None:
    least = best.least()[at:at + BLOCK].astype(np.float64)

    def useful(i, lower, upper):
        return upper >= (least[:, None] if i is None else least[i])

    same = (a.labels[:, None] == b.labels) & (a.ids[:, None] != b.ids)
    i, j, score = close_pairs(a, b, same, useful)
    best.offer(i + at, score, b.ids[j])


def _negatives(top: np.ndarray, n_pos: int) -> Callable:
    """``top``: highest score for each positive, n_pos places for each anchor (LOWEST: none)."""
    def search(best: Best, a: Rows, at: int, b: Rows) -> None:
        keys = slice(at * n_pos, (at + len(a.ids)) * n_pos)
        tops = top[keys].reshape(-1, n_pos)
        leasts = np.where(tops > LOWEST, best.least()[keys].reshape(-1, n_pos), HIGHEST)
        high, low = tops.max(axis=1).astype(np.float64), leasts.min(axis=1).astype(np.float64)

        def useful(i, lower, upper):
            at_least, at_most = (low[:, None], high[:, None]) if i is None else (low[i], high[i])
            return (upper >= at_least) & (lower <= at_most)

        i, j, score = close_pairs(a, b, a.labels[:, None] != b.labels, useful)
        for p in range(n_pos):
            fits = score <= tops[i, p]
            best.offer((i[fits] + at) * n_pos + p, score[fits], b.ids[j[fits]])
    return search


def _mine_group(rows: DataFrame, own: DataFrame, anchors: Rows, n_pos: int, n_neg: int, low: int, high: int) -> DataFrame:
    """Negatives of one group of anchors; ``own`` holds all anchors' rows."""
    spark = rows.sparkSession
    share = spark.sparkContext.broadcast

    n = len(anchors.ids)
    none = np.full(n, LOWEST)
    first = _pass(own, share((anchors, none, np.full(n, HIGHEST))), n_pos, _search_positives)
    found = _pass(rows, share((anchors, *_floors(first, n_pos, none))), n_pos, _search_positives)
    top, floor, positives = np.full(n * n_pos, LOWEST), np.full(n * n_pos, LOWEST), []
    for r in found.collect():  # at most n_pos rows for each anchor of the group
        key, score = r["key"] * n_pos + r["rank"] - 1, r["score"]
        positives.append((key, int(anchors.ids[r["key"]]), r["vec_id"], score))
        if score >= 0:  # below 0 the range is empty
            top[key], floor[key] = high * score // 100, -(-low * score // 100)
    search = _negatives(top, n_pos)
    first = _pass(own, share((anchors, floor, np.full(n * n_pos, HIGHEST))), n_neg, search)
    found = _pass(rows, share((anchors, *_floors(first, n_neg, floor))), n_neg, search)
    names = spark.createDataFrame(positives, "key int, anchor_id long, positive_id long, positive_score long")
    # at most n_pos rows for each anchor of the group
    return found.join(F.broadcast(names), "key").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def mine(vectors: DataFrame, is_anchor: Column, n_pos: int = 5, n_neg: int = 10, low: int = 30, high: int = 90,
         group: int = GROUP) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and vector (array of whole numbers); ``is_anchor``
    tells the anchors by vec_id. Positives of an anchor are its ``n_pos`` best rows of
    the same label; for each, the ``n_neg`` best rows of other labels whose score is
    ``low`` to ``high`` percent of the positive's are ranked from 1."""
    rows = summaries(vectors)
    own = settled(rows.filter(is_anchor))
    groups = -(-own.count() // group)
    spark = vectors.sparkSession
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                    "positive_score long, negative_score long")
    for g in range(groups):
        anchors = Rows(own.filter(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).toArrow())
        if len(anchors.ids):
            out = out.unionByName(_mine_group(rows, own, anchors, n_pos, n_neg, low, high))
    return out
