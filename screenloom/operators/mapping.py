"""Tile layouts, transforms between magnifications, and point matching.

``points`` have well, point, x, y; ``layout`` has well, tile, tile_row, tile_col. y and row run
down, x and column run right.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from screenloom.functions.geometry import affine, distance, scaled_rotation, to_global
from screenloom.operators.quantiles import exact_quantiles


def arrange_tiles(meta: DataFrame) -> DataFrame:
    """Grid place of each tile from its stage position (x, y in micrometres, mpp, w, h, time t).

    The first row's scale holds for a well; of tiles that fall on one place the latest stays.
    """
    well = W.partitionBy("well")
    first = lambda c: F.first(c).over(well.orderBy("t", "tile"))
    out = meta.withColumns({"x0": F.min("x").over(well), "y0": F.min("y").over(well), "scale": first("mpp"), "h0": first("h"), "w0": first("w")})
    out = out.withColumns(
        {
            "tile_row": F.rint((F.col("y") - F.col("y0")) / (F.col("scale") * F.col("h0"))).cast("long"),
            "tile_col": F.rint((F.col("x") - F.col("x0")) / (F.col("scale") * F.col("w0"))).cast("long"),
        }
    )
    last = W.partitionBy("well", "tile_row", "tile_col").orderBy(F.desc("t"), F.desc("tile"))
    return out.withColumn("rn", F.row_number().over(last)).filter("rn = 1").select("well", "tile", "tile_row", "tile_col")


def tiles_in_order(meta: DataFrame) -> DataFrame:
    """Rank of each tile of a well by acquisition time."""
    return meta.select("well", "tile", F.row_number().over(W.partitionBy("well").orderBy("t", "tile")).cast("long").alias("rank"))


def stitch_offsets(files: DataFrame) -> DataFrame:
    """Offset of each file (well, file, seq, extent) on a square grid: slots by seq, as far apart as the first file's extent + 100 (2000 if unknown)."""
    order = W.partitionBy("well").orderBy("seq", "file")
    side = F.ceil(F.sqrt(F.count(F.lit(1)).over(W.partitionBy("well")))).cast("long")
    step = F.coalesce(F.first("extent").over(order), F.lit(1900)) + 100
    out = files.withColumns({"slot": (F.row_number().over(order) - 1).cast("long"), "side": side, "step": step.cast("long")})
    return out.select("well", "file", "slot", (F.floor(F.col("slot") / F.col("side")) * F.col("step")).alias("dy"), (F.col("slot") % F.col("side") * F.col("step")).alias("dx"))


def grid_slot(seq: Column) -> tuple[Column, Column]:
    """Row and column from a sequence number: hundreds modulo ten, tens."""
    return F.floor(seq / 100).cast("long") % 10, F.floor(seq % 100 / 10).cast("long")


def local_to_global(points: DataFrame, layout: DataFrame, height: int, width: int) -> DataFrame:
    """Add y_global and x_global to points with well, tile, y, x; a well has few tiles, its layout travels by well and tile."""
    out = points.join(layout, ["well", "tile"])
    return out.select(*points.columns, to_global(F.col("y"), F.col("tile_row"), height).alias("y_global"), to_global(F.col("x"), F.col("tile_col"), width).alias("x_global"))


def global_to_local(points: DataFrame, layout: DataFrame, height: int, width: int) -> DataFrame:
    """Add tile_at, y_local, x_local to points with well, y_global, x_global; null tile outside the layout."""
    row, col = F.floor(F.col("y_global") / height), F.floor(F.col("x_global") / width)
    placed = points.withColumns({"tile_row": row, "tile_col": col})
    out = placed.join(layout.withColumnRenamed("tile", "tile_at"), ["well", "tile_row", "tile_col"], "left")
    return out.select(*points.columns, "tile_at", (F.col("y_global") - F.col("tile_row") * height).alias("y_local"), (F.col("x_global") - F.col("tile_col") * width).alias("x_local"))


def change_magnification(points: DataFrame, layout: DataFrame, target: DataFrame, scale: float, size: int, target_size: int) -> DataFrame:
    """Tile-local points to the tile and place under the other magnification; tile -1 out of range."""
    moved = local_to_global(points, layout, size, size)
    moved = moved.withColumns({"y_global": (F.col("y_global") * scale).cast("long"), "x_global": (F.col("x_global") * scale).cast("long")})
    return global_to_local(moved, target, target_size, target_size).withColumn("tile_at", F.coalesce("tile_at", F.lit(-1).cast("long")))


def map_cells(points: DataFrame, layout: DataFrame, transforms: DataFrame, target: DataFrame, size: int, target_size: int) -> DataFrame:
    """The full way of a cell: to its well, through the well's fitted transform, to a tile of the other magnification."""
    moved = local_to_global(points, layout, size, size).join(transforms, "well")
    names = ["dx", "dy", "theta", "scale_x", "scale_y"]
    x, y = scaled_rotation(F.col("x_global"), F.col("y_global"), {n: F.col(n) for n in names})
    moved = moved.withColumns({"x_global": x, "y_global": y}).drop(*names)
    return global_to_local(moved, target, target_size, target_size)


#: Points of one square that are compared one by one; squares with more are split.
CROWD = 32
#: How often squares are halved at most: to a millionth of their side.
HALVINGS = 20
#: Side of a block in multiples of the largest distance, and the points that one task looks up in it at once.
BLOCK, PART = 16, 100_000
#: Into how many columns and rows a square is cut at most within a block, as a power of two.
FINEST = 4


def nearest_within(points: DataFrame, others: DataFrame, most: float, crowd: int | None = None) -> DataFrame:
    """Each point with its nearest other point of the well at a distance of at most ``most``: well, point, other, dist.

    Blocks of 16 by 16 squares of side ``most`` are worked on in one task each: a point goes to its block only, an other point also
    to those blocks that it is near to. Blocks with many points are dealt to several tasks. So rows move once, whatever the
    number of neighbours. Near squares with a clump (over ``crowd`` others on a 16th of the side) points look in squares that
    are halved (:func:`_nearest_in_squares`), so no task holds a clump. One other point may serve several. Ties go to
    the smaller id; others at one place are compared once. What isn't a finite place has no neighbour.
    """
    from screenloom.operators.iterate import saved

    crowd, most = CROWD if crowd is None else crowd, float(most)
    finite = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))
    points = points.filter(finite).select("well", "point", "x", "y")
    left = saved(others.filter(finite).groupBy("well", F.col("x").alias("ox"), F.col("y").alias("oy")).agg(F.min("point").alias("other")), "places")
    at = ["well", "bx", "by"]
    square = lambda x, y, side: {"bx": F.floor(F.col(x) / side), "by": F.floor(F.col(y) / side)}
    fine = left.groupBy("well", *[c.alias(k) for k, c in square("ox", "oy", most / 2**FINEST).items()]).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd)
    clumps = saved(fine.select("well", F.floor(F.col("bx") / 2**FINEST).alias("bx"), F.floor(F.col("by") / 2**FINEST).alias("by")).distinct(), "clumps")
    if clumps.isEmpty():
        best = _nearest_in_blocks(points, left, most)
    else:
        ring = lambda c: F.explode(F.transform(F.array(*[F.lit(i) for i in (-1, 0, 1)]), lambda i: F.col(c) + i)).alias(c)
        wider = lambda df: df.select("well", ring("bx"), "by").select("well", "bx", ring("by")).distinct()
        near = saved(wider(clumps), "clumps")
        inside = lambda df, x, y, which, how: df.withColumns(square(x, y, most)).join(which, at, how).drop("bx", "by")
        free = _nearest_in_blocks(inside(points, "x", "y", near, "left_anti"), inside(left, "ox", "oy", clumps, "left_anti"), most)
        best = free.unionByName(_nearest_in_squares(inside(points, "x", "y", near, "left_semi"), inside(left, "ox", "oy", wider(near), "left_semi"), most, crowd))
    best = best.groupBy("well", "point").agg(F.min("m").alias("m"))
    return best.select("well", "point", F.col("m.other").alias("other"), F.col("m.dist").alias("dist"), "m.x", "m.y", "m.ox", "m.oy")


def _nearest_in_blocks(points: DataFrame, left: DataFrame, most: float) -> DataFrame:
    """Well, point and ``m`` (the nearest of ``left`` with its distance and place) for points without a clump near them."""
    side, key = most * BLOCK, ["well", "bx", "by", "part"]
    own = points.withColumns({"bx": F.floor(F.col("x") / side), "by": F.floor(F.col("y") / side)})
    # only blocks with many points are listed: one row for each ``PART`` points at most
    busy = own.groupBy("well", "bx", "by").agg(F.ceil(F.count(F.lit(1)) / PART).cast("long").alias("parts")).filter("parts > 1")
    with_parts = lambda df: df.filter(F.col("well").isNotNull()).join(F.broadcast(busy), ["well", "bx", "by"], "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    dealt = with_parts(own).select("well", "point", "x", "y", "bx", "by", F.pmod(F.xxhash64("point", "x", "y"), F.col("parts")).alias("part"))
    reach = most * (1 + 1e-9)
    among = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / side), F.floor((F.col(c) + reach) / side)))
    around = with_parts(left.select("well", "ox", "oy", "other", among("ox").alias("bx")).select("*", among("oy").alias("by")))
    around = around.select("well", "ox", "oy", "other", "bx", "by", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    types_of_points, types_of_others = ({f.name: f.dataType.simpleString() for f in df.schema} for df in (points, left))
    types = types_of_others | types_of_points
    names = ["well", "point", "dist", "other", "x", "y", "ox", "oy"]
    schema = ", ".join(f"{c} {types.get(c, 'double')}" for c in names)

    def work(mine: pa.Table, near: pa.Table) -> pa.Table:
        near = near.take(pc.sort_indices(near, sort_keys=[("other", "ascending")]))
        found, dist = _nearest_in_grid(*(t[c].to_numpy().astype(float) for t, c in ((mine, "x"), (mine, "y"), (near, "ox"), (near, "oy"))), most)
        has = found >= 0
        mine, near = mine.filter(pa.array(has)), near.take(pa.array(found[has]))
        return pa.table([pa.array(dist[has]) if c == "dist" else (mine if c in types_of_points else near)[c] for c in names], names)

    out = dealt.groupBy(*key).cogroup(around.groupBy(*key)).applyInArrow(work, schema)
    return out.select("well", "point", F.struct("dist", "other", "x", "y", "ox", "oy").alias("m"))


def _nearest_in_grid(x: np.ndarray, y: np.ndarray, ox: np.ndarray, oy: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """The number of each point's nearest other, the first of several (-1: none within ``most``), and its distance.

    Others lie in cells, as small as keeps few in one; a point goes from its cell outwards, ring by ring, until what it has
    met is nearer than the next ring can be.
    """
    dist, found = np.full(len(x), np.inf), np.full(len(x), -1)
    if not len(x) or not len(ox):
        return found, dist
    for halvings in range(FINEST + 1):
        side = most / 2**halvings
        ci, cj = np.floor(ox / side).astype(np.int64), np.floor(oy / side).astype(np.int64)
        low_i, low_j = ci.min(), cj.min()
        height, width = int(ci.max() - low_i) + 1, int(cj.max() - low_j) + 1
        cell = (ci - low_i) * width + cj - low_j
        count = np.bincount(cell, minlength=height * width)
        if count.max() <= 4:
            break
    order = np.argsort(cell, kind="stable")  # the smaller number first within a cell
    ox, oy, start = ox[order], oy[order], np.cumsum(count) - count
    pi, pj = np.floor(x / side).astype(np.int64) - low_i, np.floor(y / side).astype(np.int64) - low_j
    looking = np.arange(len(x))
    for ring in range(2**halvings + 1):
        for di in range(-ring, ring + 1):
            for dj in range(-ring, ring + 1) if abs(di) == ring else {-ring, ring}:
                i, j = pi[looking] + di, pj[looking] + dj
                inside = (i >= 0) & (i < height) & (j >= 0) & (j < width)
                who, where = looking[inside], i[inside] * width + j[inside]
                nth, more = 0, count[where] > 0
                while more.any():
                    who, where = who[more], where[more]
                    other = start[where] + nth
                    dx, dy = x[who] - ox[other], y[who] - oy[other]
                    d, number = np.sqrt(dx * dx + dy * dy), order[other]
                    better = (d <= most) & ((d < dist[who]) | ((d == dist[who]) & (number < found[who])))
                    dist[who[better]], found[who[better]] = d[better], number[better]
                    nth += 1
                    more = count[where] > nth
        looking = looking[dist[looking] >= ring * side * (1 - 1e-9)]
        if not len(looking):
            break
    return found, dist


def _nearest_in_squares(points: DataFrame, left: DataFrame, most: float, crowd: int) -> DataFrame:
    """Well, point and ``m``, as :func:`_nearest_in_blocks`, for points near clumps.

    Others lie in squares of side ``most``; a point meets the nine squares around it, so only near ones
    are compared. A square with more than ``crowd`` others is split in four, and again, and of these a point goes
    on only with those that can be nearer than some other in a square it has met. So in a clump, too, a point is
    compared with few.
    """
    from screenloom.operators.iterate import saved

    at = ["well", "bx", "by"]
    around = lambda c: F.explode(F.transform(F.array(*[F.lit(i) for i in (-1, 0, 1)]), lambda i: F.floor(F.col(c) / most) + i))
    met = points.select("well", "point", "x", "y", F.lit(float("inf")).alias("bound"), around("x").alias("bx")).select("*", around("y").alias("by"))
    side, best = float(most), None
    for halvings in range(HALVINGS + 1):
        placed = left.withColumns({"bx": F.floor(F.col("ox") / side), "by": F.floor(F.col("oy") / side)})
        squares = placed.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("other", "ox", "oy")).alias("one"))
        crowded = squares.filter(F.col("n") > crowd).select(*at)
        last = halvings == HALVINGS or crowded.isEmpty()
        if not last or halvings:
            met = saved(_nearer(met.join(squares, at), side, most), "squares")
        alone = met if last else met.filter(F.col("n") <= crowd)
        pairs = alone.join(placed, at).withColumn("dist", distance(F.col("x"), F.col("y"), F.col("ox"), F.col("oy"))).filter(F.col("dist") <= most)
        found = pairs.groupBy("well", "point").agg(F.min(F.struct("dist", "other", "x", "y", "ox", "oy")).alias("m"))
        best = found if best is None else best.unionByName(found)
        if last:
            break
        # the crowded squares in four, and who still looks there
        half = lambda c: F.explode(F.array(2 * F.col(c), 2 * F.col(c) + 1)).alias(c)
        met = met.filter(F.col("n") > crowd).select("well", "point", "x", "y", "bound", half("bx"), "by").select("well", "point", "x", "y", "bound", "bx", half("by"))
        left = saved(placed.join(crowded, at, "left_semi").select("well", "ox", "oy", "other"), "crowded")
        side /= 2
    return best


def _nearer(met: DataFrame, side: float, most: float) -> DataFrame:
    """The squares that points have met, without those that are farther from them than some other point they have met."""
    gap = lambda c, b: F.greatest(F.col(b) * side - F.col(c), F.col(c) - (F.col(b) + 1) * side, F.lit(0.0))
    near = F.sqrt(gap("x", "bx") ** 2 + gap("y", "by") ** 2) * (1 - 1e-12) - side * 1e-9  # what rounding may add
    one = distance(F.col("x"), F.col("y"), F.col("one.ox"), F.col("one.oy"))
    mine = W.partitionBy("well", "point")
    out = met.withColumns({"near": near, "bound": F.least("bound", F.min(one).over(mine))})
    return out.filter((F.col("near") <= F.col("bound")) & (F.col("near") <= most)).select("well", "point", "x", "y", "bound", "bx", "by", "n")


def transform_error(pairs: DataFrame, *by: str) -> DataFrame:
    """Mean, median, largest and root mean square of ``dist``; the median by counting, so a well may have any number of pairs."""
    from screenloom.operators.iterate import saved

    pairs, d = saved(pairs.select(*by, "dist"), "errors"), F.col("dist")  # read once for each range of the median
    stats = pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(d), 6).alias("mean_error"), F.round(F.max(d), 6).alias("max_error"), F.round(F.sqrt(F.avg(d * d)), 6).alias("rmse")
    )
    medians = exact_quantiles(pairs, list(by), "dist", [0.5]).select(*[F.col(c).alias(f"_{c}") for c in by], F.round(F.col("quantiles")[0], 6).alias("median_error"))
    same = [stats[c].eqNullSafe(medians[f"_{c}"]) for c in by] or [F.lit(True)]
    return stats.join(medians, same, "left").select(*by, "n", "mean_error", "median_error", "max_error", "rmse")


def _moments(pairs: DataFrame) -> DataFrame:
    """Centred sums per well from which transforms are fitted: one row per well, however many pairs."""
    mean = pairs.groupBy("well").agg(*[F.avg(c).alias(f"m_{c}") for c in ("x", "y", "ox", "oy")], F.count(F.lit(1)).alias("n"))
    both = pairs.join(mean, "well")
    c = {k: F.col(k) - F.col(f"m_{k}") for k in ("x", "y", "ox", "oy")}
    sums = [F.sum(c[a] * c[b]).alias(f"s_{a}_{b}") for a, b in (("x", "x"), ("x", "y"), ("y", "y"), ("x", "ox"), ("y", "ox"), ("x", "oy"), ("y", "oy"), ("ox", "ox"), ("oy", "oy"))]
    return both.groupBy("well", "n", *[f"m_{k}" for k in c]).agg(*sums)


def fit_affine(pairs: DataFrame) -> DataFrame:
    """Least squares ox = a x + b y + tx, oy = c x + d y + ty for each well, in closed form, with the root mean square error."""
    m = _moments(pairs)
    s = lambda a, b: F.col(f"s_{a}_{b}")
    det = s("x", "x") * s("y", "y") - s("x", "y") * s("x", "y")
    solve = lambda o: ((s("x", o) * s("y", "y") - s("y", o) * s("x", "y")) / det, (s("y", o) * s("x", "x") - s("x", o) * s("x", "y")) / det)
    (a, b), (c, d) = solve("ox"), solve("oy")
    out = m.withColumns({"a": a, "b": b, "c": c, "d": d})
    out = out.withColumns({"tx": F.col("m_ox") - F.col("a") * F.col("m_x") - F.col("b") * F.col("m_y"), "ty": F.col("m_oy") - F.col("c") * F.col("m_x") - F.col("d") * F.col("m_y")})
    rest = s("ox", "ox") - F.col("a") * s("x", "ox") - F.col("b") * s("y", "ox") + s("oy", "oy") - F.col("c") * s("x", "oy") - F.col("d") * s("y", "oy")
    return out.select("well", "n", "a", "b", "tx", "c", "d", "ty", F.sqrt(F.greatest(rest, F.lit(0.0)) / F.col("n")).alias("rmsd"))


FIVE = "well long, n long, dx double, dy double, theta double, scale_x double, scale_y double, rmse double"


def _gauss_newton(m: dict, steps: int = 60) -> tuple[np.ndarray, float]:
    """Five parameters from the centred sums of one well: rotation and two scales by Gauss-Newton, the shift in closed form.

    Scales stay within 0.5 to 5 and the angle within 45 degrees.
    """
    gram = np.array([[m["s_x_x"], m["s_x_y"]], [m["s_x_y"], m["s_y_y"]]])
    u, v = np.array([m["s_x_ox"], m["s_y_ox"]]), np.array([m["s_x_oy"], m["s_y_oy"]])
    theta, sx, sy = 0.0, 4.0, 4.0
    low, high = np.array([-np.pi / 4, 0.5, 0.5]), np.array([np.pi / 4, 5.0, 5.0])
    for _ in range(steps):
        r, q = np.array([np.cos(theta), -np.sin(theta)]), np.array([np.sin(theta), np.cos(theta)])
        # residuals sx r.p - ox and sy q.p - oy; their derivatives are linear in p, so sums suffice
        jx, jy = np.array([-sx * q, r, 0 * r]), np.array([sy * r, 0 * q, q])
        normal = jx @ gram @ jx.T + jy @ gram @ jy.T
        slope = jx @ (gram @ r * sx - u) + jy @ (gram @ q * sy - v)
        move = np.linalg.lstsq(normal, -slope, rcond=None)[0]
        new = np.clip(np.array([theta, sx, sy]) + move, low, high)
        if np.max(np.abs(new - [theta, sx, sy])) < 1e-13:
            break
        theta, sx, sy = new
    r, q = np.array([np.cos(theta), -np.sin(theta)]), np.array([np.sin(theta), np.cos(theta)])
    rest = sx * sx * r @ gram @ r - 2 * sx * r @ u + m["s_ox_ox"] + sy * sy * q @ gram @ q - 2 * sy * q @ v + m["s_oy_oy"]
    centre = np.array([m["m_x"], m["m_y"]])
    return np.array([m["m_ox"] / sx - r @ centre, m["m_oy"] / sy - q @ centre, theta, sx, sy]), float(np.sqrt(max(0.0, rest) / max(1, m["n"])))


def fit_scaled_rotation(pairs: DataFrame) -> DataFrame:
    """dx, dy, theta, scale_x, scale_y and rmse for each well, from one pass of sums."""

    def work(batches):
        for pdf in batches:
            rows = []
            for m in pdf.to_dict("records"):
                p, rmse = _gauss_newton(m)
                rows.append((m["well"], m["n"], *p, rmse))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in FIVE.split(", ")])

    return _moments(pairs).mapInPandas(work, FIVE)


def apply_scaled_rotation(points: DataFrame, transforms: DataFrame) -> DataFrame:
    """Points moved by their well's transform; the original coordinates stay as x_before, y_before."""
    names = ["dx", "dy", "theta", "scale_x", "scale_y"]
    both = points.join(transforms.select("well", *names), "well")
    x, y = scaled_rotation(F.col("x"), F.col("y"), {n: F.col(n) for n in names})
    return both.select(*[c for c in points.columns if c not in ("x", "y")], x.alias("x"), y.alias("y"), F.col("x").alias("x_before"), F.col("y").alias("y_before"))


def affine_errors(pairs: DataFrame, fits: DataFrame) -> DataFrame:
    both = pairs.join(fits, "well")
    x, y = affine(F.col("x"), F.col("y"), *[F.col(c) for c in ("a", "b", "tx", "c", "d", "ty")])
    return both.select("well", "point", distance(x, y, F.col("ox"), F.col("oy")).alias("dist"))


def ransac_inliers(pairs: DataFrame, most: float, samples: int = 200, size: int = 4, least: float = 0.1, seed: int = 1) -> DataFrame:
    """The pairs within ``most`` of the best of ``samples`` transforms, each fitted to ``size`` pairs of a well.

    Pairs are drawn by a hash of seed, sample and point, so a run can be repeated. Each task keeps only the
    ``samples`` smallest hashes of a well before any are brought together. Every pair is scored under every
    sample of its well, a batch of pairs under all samples at once; a batch hands on a row for each well and sample. A well whose best sample has a share of inliers under ``least`` has no rows. Null distances never occur.
    """
    from screenloom.operators.iterate import saved

    pairs = pairs.select("well", "point", "x", "y", "ox", "oy")
    # samples are drawn from ``samples`` pairs of each well, those with the smallest hashes
    few = W.partitionBy("well").orderBy(F.xxhash64(F.lit(seed), F.col("point")))
    pool = pairs.withColumn("rn", F.row_number().over(few)).filter(F.col("rn") <= samples)
    drawn = pool.select("well", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("sample"), "point", "x", "y", "ox", "oy")
    order = W.partitionBy("well", "sample").orderBy(F.xxhash64(F.lit(seed), F.col("point"), F.col("sample")))
    drawn = drawn.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= size).select("well", "sample", "x", "y", "ox", "oy")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for sample, own in pdf.groupby("sample"):
            c = {k: own[k].to_numpy() - own[k].mean() for k in ("x", "y", "ox", "oy")}
            m = {f"s_{a}_{b}": float(c[a] @ c[b]) for a in c for b in c} | {f"m_{k}": float(own[k].mean()) for k in c} | {"n": len(own)}
            rows.append((pdf["well"].iloc[0], sample, *_gauss_newton(m, 25)[0]))
        return pd.DataFrame(rows, columns=["well", "sample", "dx", "dy", "theta", "scale_x", "scale_y"])

    names = ["dx", "dy", "theta", "scale_x", "scale_y"]
    fits = saved(drawn.groupBy("well").applyInPandas(fit, "well long, sample int, " + ", ".join(f"{n} double" for n in names)), "fits")
    # what a transform does to x and y is linear in them: six numbers for each sample
    cos, sin = F.cos("theta"), F.sin("theta")
    parts = [F.col("scale_x") * cos, -F.col("scale_x") * sin, F.col("scale_x") * F.col("dx"), F.col("scale_y") * sin, F.col("scale_y") * cos, F.col("scale_y") * F.col("dy")]
    each = fits.select("well", "sample", *[p.alias(f"p{i}") for i, p in enumerate(parts)]).toPandas()  # ``samples`` rows for a well
    models = {well: own.sort_values("sample") for well, own in each.groupby("well")}

    def score(batches):
        for pdf in batches:
            for well, own in pdf.groupby("well"):
                model = models[well]
                p = [model[f"p{i}"].to_numpy()[:, None] for i in range(6)]
                x, y, ox, oy = (own[c].to_numpy() for c in ("x", "y", "ox", "oy"))
                dx, dy = p[0] * x + p[1] * y + p[2] - ox, p[3] * x + p[4] * y + p[5] - oy
                yield pd.DataFrame({"well": well, "sample": model["sample"], "inside": (np.sqrt(dx * dx + dy * dy) <= most).sum(1), "n": len(own)})

    scored = pairs.select("well", "x", "y", "ox", "oy").mapInPandas(score, "well long, sample int, inside long, n long")
    counts = scored.groupBy("well", "sample").agg(F.sum("inside").alias("inliers"), F.sum("n").alias("n"))
    best = counts.groupBy("well").agg(F.max(F.struct("inliers", (-F.col("sample")).alias("order"), "n")).alias("b")).filter(F.col("b.inliers") >= least * F.col("b.n"))
    best = best.select("well", (-F.col("b.order")).cast("int").alias("sample")).join(fits, ["well", "sample"])
    kept = pairs.join(best, "well")
    x, y = scaled_rotation(F.col("x"), F.col("y"), {n: F.col(n) for n in names})
    return kept.withColumn("dist", distance(x, y, F.col("ox"), F.col("oy"))).filter(F.col("dist") <= most).select(*pairs.columns, "dist")


def match_iteratively(points: DataFrame, others: DataFrame, most: float, rounds: int = 5, least: int = 5, tolerance: float = 1e-6) -> DataFrame:
    """Transforms of each well by repeated nearest-neighbour matching, outlier rejection and fitting.

    Starts from scale 4 with both centres aligned; every round pairs original coordinates. Rounds
    are written to the shared folder, and end early when no transform moves more than
    ``tolerance``. Wells with fewer than ``least`` inliers keep their last transform.
    """
    from screenloom.operators.iterate import saved

    centre = points.groupBy("well").agg(F.avg("x").alias("x"), F.avg("y").alias("y")).join(others.groupBy("well").agg(F.avg("x").alias("ox"), F.avg("y").alias("oy")), "well")
    start = centre.select("well", (F.col("ox") / 4 - F.col("x")).alias("dx"), (F.col("oy") / 4 - F.col("y")).alias("dy"), F.lit(0.0).alias("theta"), F.lit(4.0).alias("scale_x"), F.lit(4.0).alias("scale_y"))
    transforms = saved(start.withColumns({"n": F.lit(0).cast("long"), "rmse": F.lit(None).cast("double")}), "transforms")
    names = ["dx", "dy", "theta", "scale_x", "scale_y"]
    for turn in range(rounds):
        moved = apply_scaled_rotation(points, transforms)
        near = nearest_within(moved, others, most).select("well", "point", "ox", "oy")
        pairs = saved(near.join(points.select("well", "point", "x", "y"), ["well", "point"]), "pairs")
        fitted = fit_scaled_rotation(ransac_inliers(pairs, most, seed=turn)).filter(F.col("n") >= least)
        new = transforms.select("well", *[F.col(c).alias(f"old_{c}") for c in [*names, "n", "rmse"]]).join(fitted, "well", "left")
        new = saved(new.select("well", *[F.coalesce(c, f"old_{c}").alias(c) for c in [*names, "n", "rmse"]], *[F.abs(F.col(c) - F.col(f"old_{c}")).alias(f"move_{c}") for c in names]), "transforms")
        moves = new.agg(F.max(F.greatest(*[F.coalesce(f"move_{c}", F.lit(0.0)) for c in names])).alias("most")).first()["most"]
        transforms = new.drop(*[f"move_{c}" for c in names])
        if moves is None or moves <= tolerance:
            break
    return transforms
