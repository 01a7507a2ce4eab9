"""DBSCAN as grid-cell DataFrame joins.

Cell side = eps/√d, so two points in one cell are within eps: a cell with
≥ min_samples points is all core and needs no pair work. Features are
MinMax-scaled to [0, 1], so there are at most ⌈√d/eps⌉ keys per axis and
the cell table is bounded by the domain, not by the data (≤ 6,250 cells for
the six risk features); rows of sparse cells are < min_samples per cell.

Pair work happens only (a) for sparse-cell points against cells their
ε-ball partly overlaps and (b) for core-cell pairs whose core boxes are
neither surely within eps nor surely apart. Such cells are halved again and
again, and only the sub-cells that boxes can't settle are looked at further,
so no dense cell meets another point by point. Components of the core-cell
graph come from star joins, checkpointed each round.

Labels follow user-id order: a cluster is
numbered by the rank of its least core user id; a border point takes the
least cluster number among its core neighbours; noise is −1.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as C
from .bucket_table import BucketTable
from .graph import components
from .joins import lookup_join

TOL = 1e-9


def _sum(terms):
    out = None
    for t in terms:
        out = t if out is None else out + t
    return out


def _sq(e):
    return e * e


def _pt_dist2(d: int, a: str, b: str):
    return _sum(_sq(F.col(f"{a}{i}") - F.col(f"{b}{i}")) for i in range(d))


def _pt_box_min2(d, x, lo, hi):
    return _sum(_sq(F.greatest(F.lit(0.0), F.col(f"{lo}{i}") - F.col(f"{x}{i}"), F.col(f"{x}{i}") - F.col(f"{hi}{i}")))
                for i in range(d))


def _pt_box_max2(d, x, lo, hi):
    return _sum(_sq(F.greatest(F.abs(F.col(f"{x}{i}") - F.col(f"{lo}{i}")), F.abs(F.col(f"{x}{i}") - F.col(f"{hi}{i}"))))
                for i in range(d))


def _box_box_min2(d, alo, ahi, blo, bhi):
    return _sum(_sq(F.greatest(F.lit(0.0), F.col(f"{blo}{i}") - F.col(f"{ahi}{i}"), F.col(f"{alo}{i}") - F.col(f"{bhi}{i}")))
                for i in range(d))


def _box_box_max2(d, alo, ahi, blo, bhi):
    return _sum(_sq(F.greatest(F.col(f"{bhi}{i}") - F.col(f"{alo}{i}"), F.col(f"{ahi}{i}") - F.col(f"{blo}{i}")))
                for i in range(d))


def _log(msg: str) -> None:
    import logging
    logging.getLogger("vigil").info(msg)


def _ren(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])


def _cut(df: DataFrame) -> DataFrame:
    """Cut lineage in iterative steps (reliable checkpoint under spark.checkpoint.dir)."""
    from ..session import checkpoint
    return checkpoint(df)


def grid_points(matrix: DataFrame, cols: list[str], eps: float, id_col: str) -> DataFrame:
    d = len(cols)
    side = eps / math.sqrt(d)
    return matrix.select(F.col(id_col).alias("pid"),
                         *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
                         *[F.floor(F.col(c) / F.lit(side)).cast("int").alias(f"k{i}") for i, c in enumerate(cols)])


def cell_table(pts: DataFrame, d: int) -> DataFrame:
    K = [f"k{i}" for i in range(d)]
    return pts.groupBy(*K).agg(F.count(F.lit(1)).alias("n"),
                               *[F.min(f"x{i}").alias(f"lo{i}") for i in range(d)],
                               *[F.max(f"x{i}").alias(f"hi{i}") for i in range(d)])


def cell_pairs(cells: DataFrame, d: int, eps: float, targets: DataFrame | None = None) -> DataFrame:
    """Ordered pairs (a, b) of occupied cells whose boxes are within eps (incl. a = b);
    b ranges over ``targets`` (default: the same cells).

    Neighbour keys are generated by exploding per-axis offsets with a running
    lower bound on the distance, then equi-joined to the occupied cells.
    """
    targets = cells if targets is None else targets
    side = eps / math.sqrt(d)
    reach = math.ceil(eps / side)
    eps2 = eps * eps + TOL
    a = cells.select(*[F.col(f"k{i}").alias(f"a{i}") for i in range(d)],
                     *[F.col(f"lo{i}").alias(f"alo{i}") for i in range(d)],
                     *[F.col(f"hi{i}").alias(f"ahi{i}") for i in range(d)],
                     F.col("n").alias("na"), F.lit(0.0).alias("_cost"))
    for i in range(d):
        a = a.withColumn("_o", F.explode(F.sequence(F.lit(-reach), F.lit(reach))))
        gap = F.greatest(F.abs(F.col("_o")) - F.lit(1), F.lit(0)).cast("double") * F.lit(side)
        a = (a.withColumn("_cost", F.col("_cost") + gap * gap).filter(F.col("_cost") <= F.lit(eps2))
             .withColumn(f"b{i}", F.col(f"a{i}") + F.col("_o")).drop("_o"))
        # keep only neighbour-key prefixes that some occupied cell has: the
        # candidate set never grows past (cells × occupied prefixes in reach)
        prefix = targets.select(*[F.col(f"k{j}").alias(f"b{j}") for j in range(i + 1)]).distinct()
        a = a.join(prefix, [f"b{j}" for j in range(i + 1)], "left_semi")
    b = targets.select(*[F.col(f"k{i}").alias(f"b{i}") for i in range(d)],
                     *[F.col(f"lo{i}").alias(f"blo{i}") for i in range(d)],
                     *[F.col(f"hi{i}").alias(f"bhi{i}") for i in range(d)], F.col("n").alias("nb"))
    j = a.drop("_cost").join(b, [f"b{i}" for i in range(d)], "inner")
    return j.filter(_box_box_min2(d, "alo", "ahi", "blo", "bhi") <= F.lit(eps2))


#: Pairs of points of two sub-cells up to which they are compared one by one.
PAIR_WORK = 256
#: Halvings after which doubles of one cell can't be told apart any further.
LAST_LEVEL = 50


def _components(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """(cid, label): the least cell id connected to each cell."""
    roots = components(edges.select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b")))
    return _cut(cells.select("cid").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
                .select("cid", F.coalesce("root", "cid").alias("label")))


def _sub_key(d: int, side: float, level: int):
    """Key of the sub-cell (cell side halved ``level`` times) a point lies in."""
    if level == 0:
        return F.lit(0).cast("long")
    step = side / 2 ** level
    return F.xxhash64(*[F.floor(F.col(f"x{i}") / F.lit(step)) for i in range(d)])


def _sub_cells(pts: DataFrame, d: int, side: float, level: int) -> DataFrame:
    """(cid, parent, key, n, lo, hi, one point) of the occupied sub-cells of a level.

    The one point is that with the least hash, a number for each coordinate: a struct in
    the aggregation would have all points sorted."""
    point = F.xxhash64(*[f"x{i}" for i in range(d)])
    return (pts.groupBy("cid", _sub_key(d, side, level - 1).alias("parent"), _sub_key(d, side, level).alias("key"))
            .agg(F.count(F.lit(1)).alias("n"), *[F.min(f"x{i}").alias(f"lo{i}") for i in range(d)],
                 *[F.max(f"x{i}").alias(f"hi{i}") for i in range(d)],
                 *[F.min_by(f"x{i}", point).alias(f"one{i}") for i in range(d)]))


def _side_of(sub: DataFrame, d: int, s: str) -> DataFrame:
    """Sub-cell columns as those of side a or b of a pair."""
    return sub.select(F.col("cid").alias(f"cid_{s}"), F.col("parent").alias(f"key_{s}"), F.col("key").alias(f"next_{s}"),
                      F.col("n").alias(f"n_{s}"), *[F.col(f"{v}{i}").alias(f"{s}{v}{i}") for v in ("lo", "hi", "one") for i in range(d)])


def _near_cells(open_pairs: DataFrame, pts: DataFrame, d: int, side: float, eps2: float) -> DataFrame:
    """Of (cid_a, cid_b), the pairs with two points within eps.

    Both cells are halved again and again. A pair of sub-cells is settled by
    its boxes (all pairs within, or none) or by one point of each; only pairs
    that stay open are halved further, and compared point by point when few.
    A cell pair leaves as soon as one near pair is known.
    """
    cids = open_pairs.select(F.explode(F.array("cid_a", "cid_b")).alias("cid")).distinct()
    # written once: every level reads them
    pts = _cut(pts.join(cids, "cid", "left_semi").select("cid", *[f"x{i}" for i in range(d)]))
    zero = F.lit(0).cast("long")
    todo = _cut(open_pairs.select("cid_a", "cid_b", zero.alias("key_a"), zero.alias("key_b")))
    found, level = [], 0
    while not todo.isEmpty():
        level += 1
        sub = _sub_cells(pts, d, side, level)
        j = todo.join(_side_of(sub, d, "a"), ["cid_a", "key_a"]).join(_side_of(sub, d, "b"), ["cid_b", "key_b"])
        one = _sum(_sq(F.col(f"aone{i}") - F.col(f"bone{i}")) for i in range(d))
        hit = (_box_box_max2(d, "alo", "ahi", "blo", "bhi") <= F.lit(eps2)) | (one <= F.lit(eps2))
        j = _cut(j.filter(_box_box_min2(d, "alo", "ahi", "blo", "bhi") <= F.lit(eps2))
                 .select("cid_a", "cid_b", F.col("next_a").alias("key_a"), F.col("next_b").alias("key_b"),
                         (F.col("n_a") * F.col("n_b")).alias("work"), hit.alias("hit")))
        hits = j.filter("hit").select("cid_a", "cid_b").distinct()
        rest = j.filter("NOT hit").join(hits, ["cid_a", "cid_b"], "left_anti")
        few = F.col("work") <= F.lit(PAIR_WORK if level < LAST_LEVEL else 2 ** 62)
        key = _sub_key(d, side, level)
        pa, pb = (pts.select(F.col("cid").alias(f"cid_{s}"), key.alias(f"key_{s}"),
                             *[F.col(f"x{i}").alias(f"{v}{i}") for i in range(d)]) for s, v in (("a", "p"), ("b", "q")))
        exact = (rest.filter(few).join(pa, ["cid_a", "key_a"]).join(pb, ["cid_b", "key_b"])
                 .filter(_pt_dist2(d, "p", "q") <= F.lit(eps2)).select("cid_a", "cid_b").distinct())
        found += [hits, _cut(exact)]
        _log(f"dbscan: open cell pairs, level {level}")
        if rest.filter(~few).isEmpty():
            break
        todo = _cut(rest.filter(~few).join(found[-1], ["cid_a", "cid_b"], "left_anti")
                    .select("cid_a", "cid_b", "key_a", "key_b"))
    out = open_pairs.select("cid_a", "cid_b").limit(0)
    for f in found:
        out = out.unionByName(f)
    return out.distinct()


def _near_points(cand: DataFrame, pts: DataFrame, d: int, side: float, eps2: float, enough: int) -> DataFrame:
    """(pid, cid_b, hits) for candidates (pid, p…, cid_b): the points of the cell
    within eps, exact below ``enough`` and at least ``enough`` otherwise.

    Sub-cells wholly within eps count without being read; only those that the
    ball cuts are halved further, and only while the point needs more hits.
    """
    P = [f"p{i}" for i in range(d)]
    todo = cand.select("pid", *P, "cid_b", F.lit(0).cast("long").alias("key_b"))
    cells = cand.select(F.col("cid_b").alias("cid")).distinct()
    pts = pts.join(cells, "cid", "left_semi").select("cid", *[f"x{i}" for i in range(d)])
    done, level = None, 0
    while not todo.isEmpty():
        level += 1
        j = todo.join(_side_of(_sub_cells(pts, d, side, level), d, "b"), ["cid_b", "key_b"])
        within = _pt_box_max2(d, "p", "blo", "bhi") <= F.lit(eps2)
        j = _cut(j.filter(_pt_box_min2(d, "p", "blo", "bhi") <= F.lit(eps2))
                 .select("pid", *P, "cid_b", F.col("next_b").alias("key_b"), "n_b", within.alias("within")))
        few = ~F.col("within") & (F.col("n_b") <= F.lit(PAIR_WORK if level < LAST_LEVEL else 2 ** 62))
        q = pts.select(F.col("cid").alias("cid_b"), _sub_key(d, side, level).alias("key_b"),
                       *[F.col(f"x{i}").alias(f"q{i}") for i in range(d)])
        exact = j.filter(few).join(q, ["cid_b", "key_b"]).filter(_pt_dist2(d, "p", "q") <= F.lit(eps2))
        new = j.filter("within").select("pid", "cid_b", F.col("n_b").alias("hits")).unionByName(
            exact.select("pid", "cid_b", F.lit(1).cast("long").alias("hits")))
        new = new if done is None else new.unionByName(done)
        done = _cut(new.groupBy("pid", "cid_b").agg(F.sum("hits").alias("hits")))
        _log(f"dbscan: points against cut cells, level {level}")
        if j.filter(~F.col("within") & ~few).isEmpty():
            break
        full = done.filter(F.col("hits") >= enough).select("pid", "cid_b")
        todo = _cut(j.filter(~F.col("within") & ~few).join(full, ["pid", "cid_b"], "left_anti")
                    .select("pid", *P, "cid_b", "key_b"))
    return done if done is not None else cand.select("pid", "cid_b", F.lit(0).cast("long").alias("hits")).limit(0)


def _as_point(df: DataFrame, d: int) -> DataFrame:
    return df.select("pid", F.col("cid").alias("cid_a"), *[F.col(f"x{i}").alias(f"p{i}") for i in range(d)])


def dbscan(matrix: DataFrame, cols: list[str] | None = None, eps: float = C.DBSCAN_EPS,
           min_samples: int = C.DBSCAN_MIN_SAMPLES, id_col: str = "user_id_raiz",
           labels: bool = True) -> DataFrame:
    """Returns (id, is_core, dbscan_cluster, vote_dbscan); ``labels=False`` skips
    cluster numbering and returns core/noise only (dbscan_cluster = −1 for noise, 0
    otherwise). Ids of any ordered type."""
    cols = cols or C.FEATURE_COLUMNS
    d = len(cols)
    eps2, side = eps * eps, eps / math.sqrt(len(cols))
    K, A, B = ([f"{v}{i}" for i in range(d)] for v in "kab")
    X = [f"x{i}" for i in range(d)]
    boxes = [f"{s}{v}{i}" for s in "ab" for v in ("lo", "hi") for i in range(d)]

    grid = grid_points(matrix, cols, eps, id_col)
    # the occupied cells are bounded by the domain, so is the window that numbers them
    cells = _cut(cell_table(grid, d).withColumn("cid", F.row_number().over(Window.orderBy(*K)).cast("long")))
    pts = _cut(lookup_join(grid, cells.select(*K, "cid", "n"), K, "inner").select("pid", "cid", "n", *X))
    ids = cells.select(*K, "cid")
    pairs = cell_pairs(cells, d, eps)
    pairs = _cut(pairs.join(_ren(ids, {**dict(zip(K, A)), "cid": "cid_a"}), A)
                 .join(_ren(ids, {**dict(zip(K, B)), "cid": "cid_b"}), B)
                 .select("cid_a", "cid_b", "na", "nb", *boxes))
    _log("dbscan: points and cell pairs written")

    # ---- core flags: dense cells are all core, points of sparse cells are counted
    cand = _as_point(pts.filter(F.col("n") < min_samples), d).join(
        pairs.select("cid_a", "cid_b", "nb", *[c for c in boxes if c[0] == "b"]), "cid_a")
    within = _pt_box_max2(d, "p", "blo", "bhi") <= F.lit(eps2)
    cand = _cut(cand.filter(_pt_box_min2(d, "p", "blo", "bhi") <= F.lit(eps2))
                .select("pid", *[f"p{i}" for i in range(d)], "cid_b", "nb", within.alias("within")))
    sure = cand.filter("within").groupBy("pid").agg(F.sum("nb").alias("hits"))
    lacking = cand.filter("NOT within").join(sure.filter(F.col("hits") >= min_samples), "pid", "left_anti")
    counted = _near_points(lacking, pts, d, side, eps2, min_samples)
    sparse_core = (sure.unionByName(counted.select("pid", "hits")).groupBy("pid").agg(F.sum("hits").alias("hits"))
                   .filter(F.col("hits") >= min_samples).select("pid", F.lit(True).alias("sparse_core")))
    flagged = _cut(lookup_join(pts, sparse_core, ["pid"], "left").select(
        "pid", "cid", *X, ((F.col("n") >= min_samples) | F.coalesce("sparse_core", F.lit(False))).alias("is_core")))
    core = flagged.filter("is_core").select("pid", "cid", *X)
    _log("dbscan: core flags written")

    core_cells = _cut(core.groupBy("cid").agg(
        F.min("pid").alias("least"), *[F.min(f"x{i}").alias(f"lo{i}") for i in range(d)],
        *[F.max(f"x{i}").alias(f"hi{i}") for i in range(d)]))

    def end_of(s: str) -> DataFrame:
        return core_cells.select(F.col("cid").alias(f"cid_{s}"),
                                 *[F.col(f"{v}{i}").alias(f"{s}{v}{i}") for v in ("lo", "hi") for i in range(d)])

    if labels:
        # ---- components of the core cells: first over the pairs that boxes settle
        both = pairs.select("cid_a", "cid_b").filter("cid_a < cid_b").join(end_of("a"), "cid_a").join(end_of("b"), "cid_b")
        both = _cut(both.filter(_box_box_min2(d, "alo", "ahi", "blo", "bhi") <= F.lit(eps2)).select(
            "cid_a", "cid_b", (_box_box_max2(d, "alo", "ahi", "blo", "bhi") <= F.lit(eps2)).alias("sure")))
        edges = both.filter("sure").select("cid_a", "cid_b")
        lab = _components(core_cells, edges)
        # only open pairs between two components matter
        open_pairs = both.filter("NOT sure").select("cid_a", "cid_b")
        for s in "ab":
            open_pairs = open_pairs.join(lab.select(F.col("cid").alias(f"cid_{s}"), F.col("label").alias(f"l{s}")), f"cid_{s}")
        open_pairs = _cut(open_pairs.filter("la <> lb").select("cid_a", "cid_b"))
        if not open_pairs.isEmpty():
            lab = _components(core_cells, edges.unionByName(_near_cells(open_pairs, core, d, side, eps2)))
        # cluster number = rank of the component's least core id (components ≤ cells)
        first = lab.join(core_cells.select("cid", "least"), "cid").groupBy("label").agg(F.min("least").alias("least"))
        number = first.select("label", (F.dense_rank().over(Window.orderBy("least")) - 1).cast("int").alias("cluster"))
        cluster = _cut(lab.join(number, "label").select("cid", "cluster"))
        _log("dbscan: clusters numbered")
    else:
        cluster = core_cells.select("cid", F.lit(0).alias("cluster"))

    # ---- border points: least cluster among the cells with a core point within eps
    reach = _as_point(flagged.filter("NOT is_core"), d).join(pairs.select("cid_a", "cid_b"), "cid_a").join(end_of("b"), "cid_b")
    reach = _cut(reach.filter(_pt_box_min2(d, "p", "blo", "bhi") <= F.lit(eps2)).select(
        "pid", *[f"p{i}" for i in range(d)], "cid_b", within.alias("within")))
    near = reach.filter("within").select("pid", "cid_b").unionByName(
        _near_points(reach.filter("NOT within"), core, d, side, eps2, 1).filter("hits > 0").select("pid", "cid_b"))
    border = (near.join(_ren(cluster, {"cid": "cid_b"}), "cid_b").groupBy("pid").agg(F.min("cluster").alias("border")))
    out = lookup_join(flagged.select("pid", "cid", "is_core"), cluster, ["cid"], "left")
    out = lookup_join(out, _cut(border), ["pid"], "left")
    label = F.when(F.col("is_core"), F.col("cluster")).otherwise(F.coalesce("border", F.lit(-1)))
    return (out.select(F.col("pid").alias(id_col), "is_core", label.cast("int").alias("dbscan_cluster"))
            .withColumn("vote_dbscan", (F.col("dbscan_cluster") == -1).cast("int")))


class CorePoints:
    """The core points of a fit by grid cell, to label further rows against.

    ``cells`` has a row for each cell with core points (key, number, box, cluster: core
    points of one cell share it); ``points_of`` gives the points of some cells."""

    def __init__(self, cells: DataFrame, points_of: Callable[[DataFrame], DataFrame], d: int, eps: float):
        self.cells, self.points_of, self.d, self.eps = cells, points_of, d, eps

    @staticmethod
    def _gridded(core: DataFrame, cols: list[str], eps: float, id_col: str) -> tuple[DataFrame, DataFrame]:
        d = len(cols)
        K = [f"k{i}" for i in range(d)]
        pts = grid_points(core.withColumn("_id", F.struct(F.col(id_col), "dbscan_cluster")), cols, eps, "_id")
        pts = pts.withColumn("cell", F.concat_ws(",", *[F.col(k).cast("string") for k in K]))
        cells = pts.groupBy("cell", *K).agg(
            F.count(F.lit(1)).alias("n"), F.min("pid.dbscan_cluster").alias("cl"),
            *[F.min(f"x{i}").alias(f"lo{i}") for i in range(d)], *[F.max(f"x{i}").alias(f"hi{i}") for i in range(d)])
        return cells, pts.select("cell", *[f"x{i}" for i in range(d)])

    @classmethod
    def of(cls, core: DataFrame, cols: list[str], eps: float = C.DBSCAN_EPS, id_col: str = "user_id_raiz") -> CorePoints:
        """From the core rows of a fit (features + dbscan_cluster)."""
        cells, points = cls._gridded(core, cols, eps, id_col)
        return cls(cells, lambda wanted: points.join(wanted, "cell", "left_semi"), len(cols), eps)

    @staticmethod
    def write(core: DataFrame, root: str, cols: list[str], eps: float = C.DBSCAN_EPS, id_col: str = "user_id_raiz") -> None:
        """Store core rows for ``read``: gridded once, points in buckets of cells."""
        cells, points = CorePoints._gridded(core, cols, eps, id_col)
        cells.write.parquet(f"{root}/cells")
        BucketTable(core.sparkSession, f"{root}/points", "cell").reload(points)

    @classmethod
    def read(cls, spark: SparkSession, root: str, d: int, eps: float = C.DBSCAN_EPS) -> CorePoints:
        """Stored core points; of the points only buckets of the cells asked for are read."""
        table = BucketTable(spark, f"{root}/points", "cell")
        empty = "cell string, " + ", ".join(f"x{i} double" for i in range(d))

        def points_of(wanted: DataFrame) -> DataFrame:
            rows = table.read_keys(wanted, "cell")
            return spark.createDataFrame([], empty) if rows is None else rows.select("cell", *[f"x{i}" for i in range(d)])

        return cls(spark.read.parquet(f"{root}/cells"), points_of, d, eps)


def assign_to_fit(points: DataFrame, core: DataFrame | CorePoints, cols: list[str] | None = None,
                  eps: float = C.DBSCAN_EPS, id_col: str = "user_id_raiz") -> DataFrame:
    """Label new rows against a fitted model's core points.

    ``core`` has the fitted core rows (features + dbscan_cluster), or holds them by cell.
    A new row takes the least cluster among fitted core points within eps (a border
    point of that cluster), else −1. Cells whose box is entirely within eps settle it;
    of cells that the ball cuts the points are read and met in halved sub-cells.
    """
    cols = cols or C.FEATURE_COLUMNS
    core = core if isinstance(core, CorePoints) else CorePoints.of(core, cols, eps, id_col)
    d, eps2, side = len(cols), eps * eps, eps / math.sqrt(len(cols))
    K, A, B = ([f"{v}{i}" for i in range(d)] for v in "kab")
    new = grid_points(points, cols, eps, id_col)
    pairs = cell_pairs(cell_table(new, d), d, eps, targets=core.cells)
    pairs = _cut(pairs.join(_ren(core.cells.select(*K, "cell", "cl"), dict(zip(K, B))), B))
    # cells wholly within eps of a new cell settle it for all its rows: of the other cells only
    # those of a lesser cluster matter, so few cells meet rows
    settled = _cut(pairs.filter(_box_box_max2(d, "alo", "ahi", "blo", "bhi") <= F.lit(eps2))
                   .groupBy(*A).agg(F.min("cl").alias("cell_known")))
    pairs = pairs.join(settled, A, "left").filter(F.col("cell_known").isNull() | (F.col("cl") < F.col("cell_known")))
    np_ = _ren(new, {**dict(zip(K, A)), **{f"x{i}": f"p{i}" for i in range(d)}})
    by_cell = np_.join(settled, A).select("pid", F.col("cell_known").alias("cl"))
    cand = np_.join(pairs.select(*A, "cell", "cl", *[f"b{v}{i}" for v in ("lo", "hi") for i in range(d)]), A)
    cand = _cut(cand.filter(_pt_box_min2(d, "p", "blo", "bhi") <= F.lit(eps2)).select(
        "pid", *[f"p{i}" for i in range(d)], F.col("cell").alias("cid_b"), "cl",
        (_pt_box_max2(d, "p", "blo", "bhi") <= F.lit(eps2)).alias("within")))
    sure = cand.filter("within").groupBy("pid").agg(F.min("cl").alias("cl"))
    # a cut cell matters only if its cluster would be less than that of the sure ones
    cut = cand.filter("NOT within").join(sure.withColumnRenamed("cl", "known"), "pid", "left")
    cut = cut.filter(F.col("known").isNull() | (F.col("cl") < F.col("known"))).drop("known", "within")
    cut = _cut(cut)
    held = core.points_of(cut.select(F.col("cid_b").alias("cell")).distinct()).withColumnRenamed("cell", "cid")
    near = _near_points(cut.drop("cl"), held, d, side, eps2, 1).filter("hits > 0")
    checked = near.join(cut.select("pid", "cid_b", "cl"), ["pid", "cid_b"]).select("pid", "cl")
    best = by_cell.unionByName(sure).unionByName(checked).groupBy("pid").agg(F.min("cl").alias("cl"))
    return (new.select("pid").join(best, "pid", "left")
            .select(F.col("pid").alias(id_col), F.coalesce("cl", F.lit(-1)).cast("int").alias("dbscan_cluster"))
            .withColumn("vote_dbscan", (F.col("dbscan_cluster") == -1).cast("int")))
