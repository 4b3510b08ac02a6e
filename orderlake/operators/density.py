"""Exact density-based clustering (DBSCAN, M4) as DataFrame joins.

Same labels as the textbook algorithm with the usual numbering: points are
visited in ``order_col`` order, clusters are numbered 0.. in the order of
their first core point, a border point joins the first cluster (in that
numbering) that reaches it, noise is -1.

Plan (d dimensions, radius eps):

1. Identical points collapse into one weighted row, so a value repeated a
   million times is one row from here on.
2. Grid of side eps / sqrt(d): two points of one cell are always neighbours.
   A cell holding at least ``min_samples`` points is all core, with no
   distance test at all.
3. Points of the other (sparse) cells count neighbours over the cells within
   reach (an offset table derived from d): a whole cell is added by its count
   when its box lies inside the ball, skipped when outside, and compared point
   by point only when the ball cuts it.
4. Two core cells are linked when their core bounding boxes are within eps
   everywhere (certain), never when they are farther than eps, and otherwise
   when some pair of their core points, restricted to points near the other
   box, is within eps.
5. Connected components over core cells (``components``).
6. Border points take the smallest cluster key among the core cells that
   reach them (the same three-way box test).

Every step is an equi-join on cell coordinates plus filters; skewed cells
are split by AQE's skew-join handling, and a dense cell never produces point
pairs. Offsets and directions of cells grow as powers of the number of dimensions, so
it is meant for two to four of them.
"""

from __future__ import annotations

import itertools
import logging
import math
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions.ranking import global_index
from orderlake.operators.components import connected_components
from orderlake.session import stored

_TOL = 1e-9


def _offsets(d: int, side: float, eps: float):
    reach = math.ceil(eps / side)
    out = []
    for o in itertools.product(range(-reach, reach + 1), repeat=d):
        gap = sum(max(abs(x) - 1, 0) ** 2 for x in o) * side * side
        if gap <= eps * eps * (1 + _TOL):
            out.append(o)
    return out


def _offset_col(offs, d):
    return F.explode(F.array(*[F.struct(*[F.lit(o[i]).alias(f"o{i}") for i in range(d)]) for o in offs]))


def _sq(e):
    return e * e


def _point_box(px, lo, hi):
    """(min squared distance, max squared distance) from a point to an axis-aligned box."""
    mn = None
    mx = None
    for p, a, b in zip(px, lo, hi):
        g = F.greatest(a - p, F.lit(0.0), p - b)
        far = F.greatest(F.abs(p - a), F.abs(p - b))
        mn = _sq(g) if mn is None else mn + _sq(g)
        mx = _sq(far) if mx is None else mx + _sq(far)
    return mn, mx


def _box_box(lo1, hi1, lo2, hi2):
    mn = None
    mx = None
    for a1, b1, a2, b2 in zip(lo1, hi1, lo2, hi2):
        g = F.greatest(a2 - b1, a1 - b2, F.lit(0.0))
        far = F.greatest(F.abs(b2 - a1), F.abs(b1 - a2))
        mn = _sq(g) if mn is None else mn + _sq(g)
        mx = _sq(far) if mx is None else mx + _sq(far)
    return mn, mx


def _dist2(a, b):
    out = None
    for x, y in zip(a, b):
        out = _sq(x - y) if out is None else out + _sq(x - y)
    return out


#: Point comparisons a pair of boxes may cost before it is halved again.
_PAIR_WORK = 256


def _linked_by_boxes(pairs: DataFrame, points: DataFrame, cols: list[str], side: float,
                     eps2: float, eps2_in: float, eps2_out: float) -> DataFrame:
    """The cell pairs (v, u) of ``pairs`` that hold two ``points`` (cols, cell) within eps of each other.

    Level by level every cell is halved along each axis. Two boxes far apart are dropped; boxes near
    enough, or with one near enough pair of points, settle their cells; only boxes that
    straddle the distance are halved again, until a pair costs few point comparisons. So
    no pair of cells ever compares all its points.
    """
    open_pairs = pairs.withColumn("sv", F.lit(None).cast("string")).withColumn("su", F.col("sv"))
    found, level = pairs.limit(0), 0
    while not open_pairs.isEmpty():
        level += 1

        def place(k):
            return F.concat_ws(",", *[F.floor(F.col(c) / (side / 2 ** k)).cast("string") for c in cols])

        used = open_pairs.select(F.col("v").alias("cell")).union(open_pairs.select(F.col("u").alias("cell"))).distinct()
        near = points.join(used, "cell", "left_semi").withColumn("sub", place(level)).withColumn(
            "parent", place(level - 1) if level > 1 else F.lit(None).cast("string"))
        boxes = near.groupBy("cell", "parent", "sub").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct(*cols)).alias("rep"),
            *[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols])
        boxes = stored(boxes, "dbscan-boxes")

        def of(tag, cell):
            return boxes.select(F.col("cell").alias(cell), F.col("parent").alias(f"s{cell}"),
                                *[F.col(c).alias(f"{tag}_{c}") for c in boxes.columns if c not in ("cell", "parent")])

        joined = open_pairs
        for tag, cell in (("a", "v"), ("b", "u")):
            box = of(tag, cell)
            same = (joined[cell] == box[cell]) & joined[f"s{cell}"].eqNullSafe(box[f"s{cell}"])
            joined = joined.join(box, same).drop(box[cell]).drop(box[f"s{cell}"])
        mn, mx = _box_box(*[[F.col(f"{t}_{e}_{c}") for c in cols] for t in "ab" for e in ("lo", "hi")])
        hit = (mx <= eps2_in) | (_dist2([F.col(f"a_rep.{c}") for c in cols], [F.col(f"b_rep.{c}") for c in cols]) <= eps2)
        tested = stored(joined.filter(mn <= eps2_out).select(
            "v", "u", F.col("a_sub").alias("sv"), F.col("b_sub").alias("su"), (F.col("a_n") * F.col("b_n")).alias("work"),
            hit.alias("hit")), "dbscan-tested")
        settled = tested.filter("hit").select("v", "u").distinct()
        left = tested.filter("not hit").join(settled, ["v", "u"], "left_anti")
        few = left.filter(F.col("work") <= _PAIR_WORK)

        def members(tag, cell):
            return near.select(F.col("cell").alias(cell), F.col("sub").alias(f"s{cell}"), *[F.col(c).alias(f"{tag}_{c}") for c in cols])

        exact = (few.join(members("a", "v"), ["v", "sv"]).join(members("b", "u"), ["u", "su"])
                    .filter(_dist2([F.col(f"a_{c}") for c in cols], [F.col(f"b_{c}") for c in cols]) <= eps2)
                    .select("v", "u").distinct())
        now = stored(settled.unionByName(exact).distinct(), "dbscan-linked")
        found = found.unionByName(now)
        logging.getLogger(__name__).info("box test: level %d", level)
        open_pairs = stored(left.filter(F.col("work") > _PAIR_WORK).join(now, ["v", "u"], "left_anti")
                                .select("v", "u", "sv", "su"), "dbscan-open")
    return found


def dbscan(points: DataFrame, id_col: str, cols: list[str], eps: float = 0.9, min_samples: int = 10,
           order_col: str | None = None) -> DataFrame:
    """Label every row of ``points``: (id_col, cluster int, is_core boolean)."""
    d = len(cols)
    order_col = order_col or id_col
    side = eps / math.sqrt(d) * (1 - 1e-9)
    eps2_in = eps * eps * (1 - _TOL)     # certainly within eps
    eps2_out = eps * eps * (1 + _TOL)    # certainly farther than eps
    eps2 = eps * eps
    offs = _offsets(d, side, eps)
    cc = [f"c{i}" for i in range(d)]
    oc = [f"o{i}" for i in range(d)]

    log = logging.getLogger(__name__)
    t0 = time.time()

    def mark(what):
        log.info("dbscan %s done at %.2fs", what, time.time() - t0)

    # 1. distinct weighted points with their grid cell
    g = (points.groupBy(*cols)
               .agg(F.count(F.lit(1)).alias("w"), F.min(order_col).alias("rep"))
               .select(*cols, "w", "rep", *[F.floor(F.col(c) / side).alias(k) for c, k in zip(cols, cc)]))
    g = stored(g, "dbscan-points")
    mark("distinct points")

    # 2. cell counts
    cells = g.groupBy(*cc).agg(F.sum("w").alias("n"))
    sparse_cells = cells.filter(F.col("n") < min_samples).select(*cc)

    # 3. neighbour counts for points of sparse cells (skipped when every cell is dense)
    tc = [f"t{i}" for i in range(d)]
    if sparse_cells.isEmpty():
        counts = g.select(*cols, F.lit(None).cast("long").alias("cnt")).limit(0)
    else:
        sp = g.join(sparse_cells, cc, "left_semi")
        spx = sp.select(*cols, "w", *cc, _offset_col(offs, d).alias("o")).select(
            *cols, *[(F.col(c) + F.col(f"o.{o}")).alias(f"t{i}") for i, (c, o) in enumerate(zip(cc, oc))])
        tcells = cells.select(*[F.col(c).alias(t) for c, t in zip(cc, tc)], "n")
        spc = spx.join(tcells, tc)
        lo = [F.col(t) * side for t in tc]
        hi = [(F.col(t) + 1) * side for t in tc]
        mn, mx = _point_box([F.col(c) for c in cols], lo, hi)
        spc = spc.withColumn("_mn", mn).withColumn("_mx", mx).filter(F.col("_mn") <= eps2_out)
        full = spc.filter(F.col("_mx") <= eps2_in).groupBy(*cols).agg(F.sum("n").alias("cnt"))
        part = spc.filter(F.col("_mx") > eps2_in).select(*cols, *tc)
        q = g.select(*[F.col(c).alias(f"q_{c}") for c in cols], F.col("w").alias("qw"),
                     *[F.col(c).alias(t) for c, t in zip(cc, tc)])
        pairs = part.join(q, tc).filter(
            _dist2([F.col(c) for c in cols], [F.col(f"q_{c}") for c in cols]) <= eps2)
        partial = pairs.groupBy(*cols).agg(F.sum("qw").alias("cnt"))
        counts = full.unionByName(partial).groupBy(*cols).agg(F.sum("cnt").alias("cnt"))

    dense_cells = cells.filter(F.col("n") >= min_samples).select(*cc, F.lit(True).alias("_dense"))
    pts = (g.join(dense_cells, cc, "left")
            .join(counts, cols, "left")
            .withColumn("core", F.coalesce(F.col("_dense"), F.lit(False)) |
                        (F.coalesce(F.col("cnt"), F.lit(0)) >= min_samples))
            .drop("_dense", "cnt"))
    pts = stored(pts, "dbscan-core")
    mark("core flags")
    core = pts.filter("core")

    # 4. links between core cells
    kc = core.groupBy(*cc).agg(*[F.min(c).alias(f"lo_{c}") for c in cols],
                               *[F.max(c).alias(f"hi_{c}") for c in cols],
                               F.min("rep").alias("cell_rep"))
    kc = stored(kc.withColumn("v", F.struct(*cc)), "dbscan-cells")
    mark("core cells")
    a = kc.select(*cc, "v", *[F.col(f"lo_{c}").alias(f"alo_{c}") for c in cols],
                  *[F.col(f"hi_{c}").alias(f"ahi_{c}") for c in cols], _offset_col(offs, d).alias("o"))
    a = a.select("*", *[(F.col(c) + F.col(f"o.{o}")).alias(t) for c, o, t in zip(cc, oc, tc)]).drop("o")
    b = kc.select(*[F.col(c).alias(t) for c, t in zip(cc, tc)], F.col("v").alias("u"),
                  *[F.col(f"lo_{c}").alias(f"blo_{c}") for c in cols],
                  *[F.col(f"hi_{c}").alias(f"bhi_{c}") for c in cols])
    ab = a.join(b, tc).filter(F.col("v") < F.col("u"))
    bmn, bmx = _box_box([F.col(f"alo_{c}") for c in cols], [F.col(f"ahi_{c}") for c in cols],
                        [F.col(f"blo_{c}") for c in cols], [F.col(f"bhi_{c}") for c in cols])
    ab = ab.withColumn("_mn", bmn).withColumn("_mx", bmx).filter(F.col("_mn") <= eps2_out)
    sure = ab.filter(F.col("_mx") <= eps2_in).select(F.col("v").alias("src"), F.col("u").alias("dst"))
    maybe = ab.filter(F.col("_mx") > eps2_in)
    core_pts = core.select(*cols, F.struct(*cc).alias("cell"))
    # quick positive: for every grid direction, each core cell's extreme core point along
    # it (one aggregation over core points, combined map-side); a pair of cells is linked
    # when the two facing extreme points are within eps. Cell-level work only.
    dirs = list(itertools.product((-1, 0, 1), repeat=d))
    pt = F.struct(*[F.col(c) for c in cols])

    def dot(dv):
        e = None
        for w, c in zip(dv, cols):
            if w:
                t = F.col(c) * float(w)
                e = t if e is None else e + t
        return e if e is not None else F.lit(0.0)

    ext = core.groupBy(*cc).agg(*[F.max_by(pt, dot(dv)).alias(f"x{k}") for k, dv in enumerate(dirs)])
    ext = ext.select(F.struct(*cc).alias("cell"), F.array(*[F.col(f"x{k}") for k in range(len(dirs))]).alias("ext"))

    def dir_index(sign_cols):
        idx = None
        for sc in sign_cols:
            idx = (sc + 1) if idx is None else idx * 3 + (sc + 1)
        return idx + 1  # element_at is 1-based

    sgn = [F.signum(F.col(f"_u.{c}") - F.col(f"_v.{c}")).cast("int") for c in cc]
    probe = (maybe.select("v", "u")
                  .join(ext.select(F.col("cell").alias("v"), F.col("ext").alias("ea")), "v")
                  .join(ext.select(F.col("cell").alias("u"), F.col("ext").alias("eb")), "u")
                  .withColumn("_v", F.col("v")).withColumn("_u", F.col("u")))
    pa = F.element_at("ea", dir_index(sgn))
    pb = F.element_at("eb", dir_index([-x for x in sgn]))
    quick = probe.filter(_dist2([pa[c] for c in cols], [pb[c] for c in cols]) <= eps2).select("v", "u")
    mark("quick links")
    # Cells that sure and quick links already connect need no test of their own: the answer
    # would change no component. What is left goes to the test on ever smaller boxes.
    known = stored(sure.unionByName(quick.select(F.col("v").alias("src"), F.col("u").alias("dst"))), "dbscan-links")
    so_far = connected_components(kc.select("v"), known)
    rest = stored(maybe.select("v", "u")
                  .join(so_far.withColumnRenamed("label", "_lv"), "v")
                  .join(so_far.select(F.col("v").alias("u"), F.col("label").alias("_lu")), "u")
                  .filter(F.col("_lv") != F.col("_lu")).select("v", "u"), "dbscan-open")
    log.info("dbscan: box test for the open cell pairs")
    linked = _linked_by_boxes(rest, core_pts, cols, side, eps2, eps2_in, eps2_out)
    edges = known.unionByName(linked.select(F.col("v").alias("src"), F.col("u").alias("dst")))

    # 5. components over core cells; cluster key = smallest core point of the component
    comp = connected_components(kc.select("v"), edges)
    mark("components")
    kc2 = kc.join(comp, "v")
    ckey = kc2.groupBy("label").agg(F.min("cell_rep").alias("ckey"))
    kc2 = kc2.join(ckey, "label").select(*cc, *[F.col(f"lo_{c}") for c in cols],
                                         *[F.col(f"hi_{c}") for c in cols], "ckey")
    kc2 = stored(kc2, "dbscan-clusters")

    # 6. border points: smallest cluster key among reaching core cells (none when all points are core)
    nb = pts.filter(~F.col("core")).select(*cols, *cc)
    if nb.isEmpty():
        border = nb.select(*cols, F.lit(None).cast(kc2.schema["ckey"].dataType).alias("ckey")).limit(0)
    else:
        nbx = nb.select(*cols, _offset_col(offs, d).alias("o"), *cc).select(
            *cols, *[(F.col(c) + F.col(f"o.{o}")).alias(t) for c, o, t in zip(cc, oc, tc)])
        kt = kc2.select(*[F.col(c).alias(t) for c, t in zip(cc, tc)], "ckey",
                        *[F.col(f"lo_{c}") for c in cols], *[F.col(f"hi_{c}") for c in cols])
        nbk = nbx.join(kt, tc)
        pmn, pmx = _point_box([F.col(c) for c in cols], [F.col(f"lo_{c}") for c in cols],
                              [F.col(f"hi_{c}") for c in cols])
        nbk = nbk.withColumn("_mn", pmn).withColumn("_mx", pmx).filter(F.col("_mn") <= eps2_out)
        b_sure = nbk.filter(F.col("_mx") <= eps2_in).select(*cols, "ckey")
        b_maybe = nbk.filter(F.col("_mx") > eps2_in).select(*cols, *tc, "ckey")
        cq = core.select(*[F.col(c).alias(f"q_{c}") for c in cols], *[F.col(c).alias(t) for c, t in zip(cc, tc)])
        b_pair = (b_maybe.join(cq, tc)
                         .filter(_dist2([F.col(c) for c in cols], [F.col(f"q_{c}") for c in cols]) <= eps2)
                         .select(*cols, "ckey"))
        border = b_sure.unionByName(b_pair).groupBy(*cols).agg(F.min("ckey").alias("ckey"))

    # cluster numbers: 0.. by cluster key
    keys = ckey.select("ckey").distinct()
    numbered = global_index(keys, ["ckey"], "cluster")
    core_lab = core.join(kc2.select(*cc, "ckey"), cc).select(*cols, "ckey", F.lit(True).alias("is_core"))
    bor_lab = border.select(*cols, "ckey", F.lit(False).alias("is_core"))
    lab = core_lab.unionByName(bor_lab).join(numbered, "ckey").select(*cols, "cluster", "is_core")
    out = points.select(id_col, *cols).join(lab, cols, "left")
    return out.select(id_col, F.coalesce(F.col("cluster").cast("int"), F.lit(-1)).alias("cluster"),
                      F.coalesce("is_core", F.lit(False)).alias("is_core"))
