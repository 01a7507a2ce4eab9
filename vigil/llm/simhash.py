"""SimHash near-duplicates through vantage-point trees.

Fingerprints: 64 bits from the XXH64 (seed 42) of all word shingles of the whole
text. Documents link when their fingerprints differ in at most ``distance`` bits;
groups are the connected components of the links.

Search over the distinct fingerprints. Random fingerprints lie 32 ± 4 bits from
any vantage point, so one tree over all 64 bits with a radius of 3 prunes next to
nothing. The bits are therefore cut into ``distance + 1`` blocks with one tree
each: two linked fingerprints agree in all bits of at least one block, and in that
block's tree the search radius is 0, where the triangle bound leaves one branch:
the fingerprints with equal Hamming distances to all vantage points of the block.
These are the shards. A shard above ``shard_rows`` is split further by a vantage
point of its own over all 64 bits: near and far half, both holding the fingerprints
so close to the boundary that a linked pair could straddle it. Inside a shard, a
task goes on the same way in memory down to leaves that are compared pair by pair.
Every shard returns links within itself; no link is lost, and no group of equal or
close fingerprints is spelled out as all its pairs.

A dense shard (near copies of one text), whose halves would overlap too much, is dealt
out anew by trees of more blocks: with b blocks any b - distance of them may be the
unchanged ones, so its fingerprints go to more shards that agree in more bits. Shards
that stay dense at ``MOST_BLOCKS`` agree in 40 of 64 bits.

Edge cases: null and empty texts have fingerprint zero, which links like any other;
texts of any length are read whole, in memory of a few times the text;
a text with fewer words than a shingle is one shingle; equal rows share group and
fingerprint; a null doc_id never names a group that holds another id, and a group
of null ids only has a null component_id; empty tables give no rows; other columns
pass through ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import components
from .common import is_small, lookup_join, row_key, settled, small_batches

LEAF = 64
OVERLAP = 1.45
VANTAGE_POINTS = 10
#: Blocks up to which dense shards are dealt out anew.
MOST_BLOCKS = 8
CHUNK = 1 << 16


# ------------------------------------------------------------------ fingerprints

def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text as an unsigned 64-bit number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    grams = zip(*[words[k:] for k in range(shingle)]) if len(words) >= shingle else iter([words])
    hashes = np.fromiter(map(partial(xxh64_intdigest, seed=42), map(b" ".join, grams)), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), CHUNK):
        part = hashes[k:k + CHUNK]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, key_columns: list[str] | None = None) -> DataFrame:
    """(doc_id, fp[, key]) of every document, written once; key digests the named columns."""
    small_batches(docs.sparkSession)
    keyed = docs.select("doc_id", "text", *([row_key(*key_columns).alias("key")] if key_columns else []))
    schema = T.StructType([*keyed.drop("text").schema.fields, T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], dtype=np.uint64)
            rest = {n: b.column(n) for n in b.schema.names if n != "text"}
            yield pa.RecordBatch.from_pydict(rest | {"fp": pa.array(fps.view(np.int64))})

    return settled(keyed.mapInArrow(run, schema))


# ------------------------------------------------------------------------ shards

def block_masks(distance: int, blocks: int) -> list[int]:
    """Bit masks of the trees: the combinations of blocks that stay unchanged in
    some pair, if ``distance`` bits differ."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    each = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(each, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shards(nodes: DataFrame, distance: int, blocks: int) -> DataFrame:
    """(shard, fp): every fingerprint once in each tree, in the branch of its
    distances to the tree's vantage points."""
    rng = np.random.default_rng(2)
    trees = []
    for t, m in enumerate(block_masks(distance, blocks)):
        points = [_signed(int(v) & m) for v in rng.integers(0, 1 << 64, VANTAGE_POINTS, dtype=np.uint64)]
        inside = F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long"))
        rings = [F.bit_count(inside.bitwiseXOR(F.lit(p).cast("long"))) for p in points]
        trees.append(F.xxhash64(F.lit(t), *rings))
    return nodes.select(F.explode(F.array(*trees)).alias("shard"), "fp")


def split_large(members: DataFrame, distance: int, shard_rows: int, blocks: int) -> DataFrame:
    """Split shards above ``shard_rows`` by a vantage point and the median distance
    to it, with the overlap at the boundary. Shards whose halves would hold more than
    ``OVERLAP`` times their rows (dense clusters) are dealt out by trees of more blocks."""
    finished, dense, todo, level = [], [], members, 0
    while True:
        level += 1
        sizes = todo.groupBy("shard").agg(F.count("*").alias("n"), F.min_by("fp", F.xxhash64("fp", F.lit(level))).alias("point"))
        large = settled(sizes.filter(F.col("n") > shard_rows))
        if large.isEmpty():
            break
        far = F.bit_count(F.col("fp").bitwiseXOR(F.col("point")))
        big = settled(lookup_join(todo, large, ["shard"], "inner").select("shard", "n", "fp", far.alias("d")))
        cut = settled(big.groupBy("shard").agg(F.percentile_approx("d", 0.5).alias("m")))
        big = lookup_join(big, cut, ["shard"], "inner").select(
            "shard", "n", "fp", (F.col("d") <= F.col("m")).alias("near"), (F.col("d") > F.col("m") - distance).alias("far"))
        halves = big.groupBy("shard", "n").agg(F.count_if("near").alias("near"), F.count_if("far").alias("far"))
        split = settled(halves.filter((F.col("near") + F.col("far") <= OVERLAP * F.col("n"))
                                      & (F.greatest("near", "far") < F.col("n"))).select("shard"))
        whole = settled(lookup_join(large.select("shard"), split, ["shard"], "left_anti"))
        if blocks < MOST_BLOCKS:
            dense.append(lookup_join(todo, whole, ["shard"], "left_semi").select("fp"))
            finished.append(lookup_join(todo, settled(large.select("shard")), ["shard"], "left_anti"))
        else:
            finished.append(lookup_join(todo, split, ["shard"], "left_anti"))
        sides = F.array_compact(F.array(F.when(F.col("near"), F.lit(0)), F.when(F.col("far"), F.lit(1))))
        dealt = lookup_join(big, split, ["shard"], "left_semi").select("shard", "fp", F.explode(sides).alias("side"))
        todo = settled(dealt.select(F.xxhash64("shard", "side").alias("shard"), "fp"))
    finished.append(todo)
    close = settled(_union(dense).distinct()) if dense else None
    if close is not None and not close.isEmpty():
        more = min(blocks + 2, MOST_BLOCKS)
        finished.append(split_large(settled(shards(close, distance, more)), distance, shard_rows, more))
    return _union(finished)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------- inside one shard

def _near(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= distance


def _leaf(x: np.ndarray, distance: int) -> list[np.ndarray]:
    i, j = np.nonzero(np.triu(_near(x[:, None], x[None, :], distance), 1))
    return [np.stack([x[i], x[j]])]


def _sweep(x: np.ndarray, distance: int) -> list[np.ndarray]:
    """Links that connect a dense cluster: every point, once reached, reaches the
    points not reached yet whose distance to the vantage point allows a link."""
    d = np.bitwise_count(x ^ x[0]).astype(np.int16)
    order = np.argsort(d, kind="stable")
    x, d = x[order], d[order]
    left = np.ones(len(x), dtype=bool)
    out = []
    for start in range(len(x)):
        if not left[start]:
            continue
        left[start] = False
        queue = [start]
        while queue:
            p = queue.pop()
            a, b = np.searchsorted(d, d[p] - distance, "left"), np.searchsorted(d, d[p] + distance, "right")
            rest = a + np.nonzero(left[a:b])[0]
            got = rest[_near(x[rest], x[p], distance)]
            if len(got):
                left[got] = False
                queue.extend(got.tolist())
                out.append(np.stack([np.full(len(got), x[p]), x[got]]))
    return out


def links_in(x: np.ndarray, distance: int) -> list[np.ndarray]:
    """Links between distinct fingerprints whose components are those of all pairs
    within the distance: a vantage-point tree with overlapping halves."""
    out, todo = [], [x]
    while todo:
        x = todo.pop()
        if len(x) <= LEAF:
            out += _leaf(x, distance)
            continue
        d = np.bitwise_count(x ^ x[len(x) // 2]).astype(np.int16)
        m = int(np.median(d))
        near, far = x[d <= m], x[d > m - distance]
        if len(near) + len(far) > OVERLAP * len(x) or max(len(near), len(far)) == len(x):
            out += _sweep(x, distance)
        else:
            todo += [near, far]
    return [e for e in out if e.shape[1]]


def _links_of_sorted(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard → link rows. Small shards are compared together at
    growing offsets; larger ones each through their tree. Only the shard that may
    go on in the next batch is kept."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def solve(shard: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        sizes = np.diff(np.r_[starts, len(shard)])
        found = []
        for s, n in zip(starts[sizes > LEAF], sizes[sizes > LEAF]):
            found += links_in(np.unique(fp[s:s + n]), distance)
        few = np.repeat(sizes <= LEAF, sizes)
        shard, fp = shard[few], fp[few]
        for k in range(1, min(LEAF, len(fp))):
            same = shard[k:] == shard[:-k]
            if not same.any():
                break
            i = np.flatnonzero(same)
            i = i[_near(fp[i], fp[i + k], distance)]
            found.append(np.stack([fp[i], fp[i + k]]))
        found = [e for e in found if e.shape[1]]
        if found:
            a, b = np.concatenate(found, axis=1).view(np.int64)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    for batch in batches:
        shard = batch.column("shard").to_numpy(zero_copy_only=False)
        fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(shard):
            continue
        cut = int(np.searchsorted(shard, shard[-1], "left"))
        if cut == 0 and (not held or held[0][0][0] == shard[0]):
            held.append((shard, fp))
            continue
        held.append((shard[:cut], fp[:cut]))
        yield from solve(*[np.concatenate(z) for z in zip(*held)])
        held = [(shard[cut:], fp[cut:])]
    if held:
        yield from solve(*[np.concatenate(z) for z in zip(*held)])


def links(nodes: DataFrame, distance: int = 3, blocks: int = 4, shard_rows: int = 200_000) -> DataFrame:
    """(a, b) links between distinct fingerprints that connect all near pairs."""
    members = split_large(settled(shards(nodes.select("fp"), distance, blocks)), distance, shard_rows, blocks)
    dealt = members.repartition("shard").sortWithinPartitions("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _links_of_sorted(batches, distance)

    return dealt.select("shard", "fp").mapInArrow(run, "a bigint, b bigint").distinct()


# ------------------------------------------------------------------- documents

def _groups(fps: DataFrame, distance: int, blocks: int) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint; root is one fingerprint of its group."""
    nodes = settled(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(links(nodes, distance, blocks))
    rooted = lookup_join(nodes, roots.select(F.col("node").alias("fp"), "root"), ["fp"], "left")
    rooted = settled(rooted.select("fp", "low", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return settled(lookup_join(rooted.select("fp", "root"), least, ["root"], "inner").select("fp", "root", "component_id"))


def group(docs: DataFrame, shingle: int = 3, distance: int = 3, blocks: int = 4) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id of the group) of every document."""
    fps = fingerprints(docs, shingle)
    return lookup_join(fps, _groups(fps, distance, blocks), ["fp"], "inner").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, shingle: int = 3, distance: int = 3, blocks: int = 4) -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest doc_id;
    rows that share it are decided by their digest, equal rows are one."""
    fps = fingerprints(docs, shingle, docs.columns)
    grouped = lookup_join(fps, _groups(fps, distance, blocks), ["fp"], "inner")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key"))
    kept = settled(grouped.groupBy("root").agg(best.alias("best")).select("best.key").distinct())
    gone = settled(lookup_join(fps.select("key").distinct(), kept, ["key"], "left_anti"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, row_key(*docs.columns).alias("key"))
    left = lookup_join(keyed, gone, ["key"], "left_anti")
    twice = settled(lookup_join(fps.groupBy("key").count().filter("count > 1").select("key"), kept, ["key"], "left_semi"))
    if is_small(twice, 0):
        return left.select("row.*")
    once = lookup_join(left, twice, ["key"], "left_anti")
    again = lookup_join(left, twice, ["key"], "left_semi").dropDuplicates(["key"])
    return once.unionByName(again).select("row.*")
