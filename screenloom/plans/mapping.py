"""Queries: coordinates, layouts, transforms, matching."""

from __future__ import annotations


from pyspark.sql import functions as F

from screenloom.functions import bases as fb
from screenloom.functions import geometry as fg
from screenloom.operators import mapping as om
from screenloom.operators import qc
from screenloom.operators.iterate import saved
from screenloom.plans.registry import query


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


@query("q2_14_tile_text", "SELECT DISTINCT tile, lpad(concat(tile, ''), 4, '0') AS text FROM {reads}")
def tile_text(reads):
    return reads.select("tile").distinct().withColumn("text", fb.tile_text(F.col("tile")))


@query("q2_15_decode_job", "SELECT job, job // 10000 AS well, job % 10000 AS tile FROM (SELECT DISTINCT well * 10000 + tile AS job FROM {reads})")
def decode_job(reads):
    jobs = reads.select((F.col("well") * 10_000 + F.col("tile")).alias("job")).distinct()
    return jobs.select("job", fb.job_well(F.col("job")).alias("well"), fb.job_tile(F.col("job")).alias("tile"))


_GLOBAL = "global AS (SELECT read, r.well, r.tile, i + tile_row * 32 AS y_global, j + tile_col * 32 AS x_global FROM {reads} AS r JOIN {layout} AS l ON r.well = l.well AND r.tile = l.tile)"


@query("q2_19_local_to_global", f"WITH {_GLOBAL} SELECT read, y_global, x_global FROM global")
def local_to_global(reads, layout):
    points = reads.select("read", "well", "tile", F.col("i").alias("y"), F.col("j").alias("x"))
    return om.local_to_global(points, layout, 32, 32).select("read", "y_global", "x_global")


@query(
    "q2_20_global_to_local",
    f"""WITH {_GLOBAL}, shifted AS (SELECT read, well, y_global + 16 AS y_global, x_global - 16 AS x_global FROM global)
SELECT read, l.tile AS tile_at, y_global - floor(y_global / 32)::BIGINT * 32 AS y_local, x_global - floor(x_global / 32)::BIGINT * 32 AS x_local
FROM shifted AS s LEFT JOIN {{layout}} AS l ON s.well = l.well AND floor(y_global / 32) = l.tile_row AND floor(x_global / 32) = l.tile_col""",
)
def global_to_local(reads, layout):
    points = reads.select("read", "well", "tile", F.col("i").alias("y"), F.col("j").alias("x"))
    moved = om.local_to_global(points, layout, 32, 32).select("read", "well", (F.col("y_global") + 16).alias("y_global"), (F.col("x_global") - 16).alias("x_global"))
    return om.global_to_local(moved, layout, 32, 32).select("read", "tile_at", "y_local", "x_local")


_T = {"dx": 25.0, "dy": 37.5, "theta": 0.05, "scale_x": 4.0, "scale_y": 3.9}
_TRS = "4.0 * (cos(0.05) * {x} - sin(0.05) * {y} + 25.0), 3.9 * (sin(0.05) * {x} + cos(0.05) * {y} + 37.5)".split(", ")


@query("q2_21_scaled_rotation", f"SELECT point, round({_TRS[0].format(x='x', y='y')}, 6) AS x2, round({_TRS[1].format(x='x', y='y')}, 6) AS y2 FROM {{points10}}")
def scaled_rotation(points10):
    x, y = fg.scaled_rotation(F.col("x"), F.col("y"), {k: F.lit(v) for k, v in _T.items()})
    return points10.select("point", F.round(x, 6).alias("x2"), F.round(y, 6).alias("y2"))


@query("q2_22_affine", "SELECT point, round(1.5 * x + 0.25 * y + 10, 6) AS x2, round(-0.25 * x + 1.5 * y - 5, 6) AS y2 FROM {points10}")
def affine(points10):
    x, y = fg.affine(F.col("x"), F.col("y"), 1.5, 0.25, 10, -0.25, 1.5, -5)
    return points10.select("point", F.round(x, 6).alias("x2"), F.round(y, 6).alias("y2"))


@query(
    "q2_23_shear_and_perspective",
    """SELECT point, CASE WHEN tile = -1 THEN x ELSE round(4 * (cos(0.1) * (x + 0.02 * y) - sin(0.1) * y) + 3, 6) END AS x6, CASE WHEN tile = -1 THEN y ELSE round(4 * (sin(0.1) * (x + 0.02 * y) + cos(0.1) * y) - 2, 6) END AS y6,
  CASE WHEN tile = -1 THEN x ELSE round((4 * (cos(0.1) * x - sin(0.1) * y) + 3) / (0.00001 * x + 0.00002 * y + 1), 6) END AS x8, CASE WHEN tile = -1 THEN y ELSE round((4 * (sin(0.1) * x + cos(0.1) * y) - 2) / (0.00001 * x + 0.00002 * y + 1), 6) END AS y8
FROM (SELECT *, CASE WHEN point % 10 = 0 THEN -1 ELSE 1 END AS tile FROM {points10})""",
)
def shear_and_perspective(points10):
    x, y, out = F.col("x"), F.col("y"), F.col("point") % 10 == 0
    six, eight = fg.sheared(x, y, 3, -2, 0.1, 4, 4, 0.02), fg.perspective(x, y, 3, -2, 0.1, 4, 4, 0.00001, 0.00002)
    pick = lambda old, new: F.when(out, old).otherwise(F.round(new, 6))
    return points10.select("point", pick(x, six[0]).alias("x6"), pick(y, six[1]).alias("y6"), pick(x, eight[0]).alias("x8"), pick(y, eight[1]).alias("y8"))


@query(
    "q2_24_change_magnification",
    f"""WITH {_GLOBAL}, up AS (SELECT read, well, y_global * 4 AS y, x_global * 4 AS x FROM global)
SELECT read, coalesce(l.tile, -1) AS tile_at, y - y // 128 * 128 AS y_local, x - x // 128 * 128 AS x_local
FROM up LEFT JOIN {{layout}} AS l ON up.well = l.well AND y // 128 = l.tile_row AND x // 128 = l.tile_col AND l.tile < 8""",
)
def change_magnification(reads, layout):
    points = reads.select("read", "well", "tile", F.col("i").alias("y"), F.col("j").alias("x"))
    return om.change_magnification(points, layout, layout.filter("tile < 8"), 4.0, 32, 128).select("read", "tile_at", "y_local", "x_local")


@query(
    "q2_25_map_cells",
    f"""WITH {_GLOBAL}, moved AS (SELECT read, well, {_TRS[0].format(x='x_global', y='y_global')} AS x, {_TRS[1].format(x='x_global', y='y_global')} AS y FROM global)
SELECT read, l.tile AS tile_at, round(y - floor(y / 160) * 160, 5) AS y_local, round(x - floor(x / 160) * 160, 5) AS x_local
FROM moved LEFT JOIN {{layout}} AS l ON moved.well = l.well AND floor(y / 160) = l.tile_row AND floor(x / 160) = l.tile_col""",
)
def map_cells(reads, layout):
    points = reads.select("read", "well", "tile", F.col("i").alias("y"), F.col("j").alias("x"))
    transforms = layout.select("well").distinct().select("well", *[F.lit(v).alias(k) for k, v in _T.items()])
    out = om.map_cells(points, layout, transforms, layout, 32, 160)
    return out.select("read", "tile_at", F.round("y_local", 5).alias("y_local"), F.round("x_local", 5).alias("x_local"))


@query(
    "q2_26_location",
    "SELECT point, round(sqrt((x - 1001.5) * (x - 1001.5) + (y - 999.5) * (y - 999.5)) * 0.65, 6) AS to_centre, least(x, y, 2003 - x, 1999 - y) * 0.65 AS to_edge FROM {points10}",
)
def location(points10):
    x, y = F.col("x"), F.col("y")
    return points10.select("point", F.round(fg.to_centre(x, y, 2003, 1999) * 0.65, 6).alias("to_centre"), (fg.to_edge(x, y, 2003, 1999) * 0.65).alias("to_edge"))


@query("q2_30_grid_slot", "SELECT DISTINCT seq, seq // 100 % 10 AS slot_row, seq % 100 // 10 AS slot_col FROM {files} WHERE seq IS NOT NULL")
def grid_slot(files):
    row, col = om.grid_slot(F.col("seq"))
    return files.filter("seq is not null").select("seq", row.alias("slot_row"), col.alias("slot_col")).distinct()


@query(
    "q5_6_arrange_tiles",
    """SELECT well, tile, round_even((y - y0) / (0.65 * 32), 0)::BIGINT AS tile_row, round_even((x - x0) / (0.65 * 32), 0)::BIGINT AS tile_col
FROM (SELECT *, min(x) OVER (PARTITION BY well) AS x0, min(y) OVER (PARTITION BY well) AS y0 FROM {tile_meta})
QUALIFY row_number() OVER (PARTITION BY well, tile_row, tile_col ORDER BY t DESC, tile DESC) = 1""",
)
def arrange_tiles(tile_meta):
    return om.arrange_tiles(tile_meta)


@query("q5_7_tiles_in_order", "SELECT well, tile, row_number() OVER (PARTITION BY well ORDER BY t, tile) AS rank FROM {tile_meta}")
def tiles_in_order(tile_meta):
    return om.tiles_in_order(tile_meta)


@query(
    "q5_8_stitch_offsets",
    """WITH s AS (SELECT well, path AS file, row_number() OVER w - 1 AS slot, ceil(sqrt(count(*) OVER (PARTITION BY well)))::BIGINT AS side, first_value(seq) OVER w + 100 AS step
  FROM {files} WHERE well IS NOT NULL WINDOW w AS (PARTITION BY well ORDER BY seq, path))
SELECT well, file, slot, slot // side * step AS dy, slot % side * step AS dx FROM s""",
)
def stitch_offsets(files):
    return om.stitch_offsets(files.filter("well is not null").select("well", F.col("path").alias("file"), "seq", F.col("seq").alias("extent")))


_MOVED = "moved AS (SELECT point, well, 4 * x + 100 AS x, 4 * y + 150 AS y FROM {points10})"
_NEAREST = f"""WITH {_MOVED}, pair AS (
  SELECT m.well, m.point, o.point AS other, sqrt((m.x - o.x) ** 2 + (m.y - o.y) ** 2) AS dist
  FROM moved AS m JOIN {{points40}} AS o ON m.well = o.well AND abs(m.x - o.x) <= 40 AND abs(m.y - o.y) <= 40
), best AS (
  SELECT * FROM pair WHERE dist <= 40 QUALIFY row_number() OVER (PARTITION BY well, point ORDER BY dist, other) = 1
)"""


def _nearest(points10, points40):
    moved = points10.select("point", "well", (4 * F.col("x") + 100).alias("x"), (4 * F.col("y") + 150).alias("y"))
    return om.nearest_within(moved, points40, 40.0)


@query("q3_9_nearest_neighbour", f"{_NEAREST} SELECT well, point, other, round(dist, 6) AS dist FROM best")
def nearest_neighbour(points10, points40):
    return _nearest(points10, points40).select("well", "point", "other", F.round("dist", 6).alias("dist"))


_ERROR = "count(*) AS n, round(avg(dist), 6) AS mean_error, round(quantile_cont(dist, 0.5), 6) AS median_error, round(max(dist), 6) AS max_error, round(sqrt(avg(dist * dist)), 6) AS rmse"


@query("q4_26_transform_error", f"{_NEAREST} SELECT well, {_ERROR} FROM best GROUP BY well")
def transform_error(points10, points40):
    return om.transform_error(_nearest(points10, points40), "well")


@query(
    "q9_14_error_histogram",
    f"{_NEAREST} SELECT least(floor((dist - low) / ((high - low) / 10)), 9)::BIGINT AS bin, count(*) AS n FROM (SELECT round(dist, 9) AS dist FROM best), (SELECT min(round(dist, 9)) AS low, max(round(dist, 9)) AS high FROM best) GROUP BY 1",
)
def error_histogram(points10, points40):
    return qc.histogram(saved(_nearest(points10, points40).select(F.round("dist", 9).alias("dist")), "errors"), "dist", 10)


def _pairs(points10, points40):
    return points10.join(points40.select("well", "point", F.col("x").alias("ox"), F.col("y").alias("oy")), ["well", "point"])


@query(
    "q9_11_fit_affine",
    """WITH p AS (SELECT a.well, a.x, a.y, b.x AS ox, b.y AS oy FROM {points10} AS a JOIN {points40} AS b USING (well, point)),
s AS (SELECT well, count(*) AS n, var_pop(x) AS xx, var_pop(y) AS yy, covar_pop(x, y) AS xy, covar_pop(x, ox) AS xo, covar_pop(y, ox) AS yo, covar_pop(x, oy) AS xq, covar_pop(y, oy) AS yq,
  avg(x) AS mx, avg(y) AS my, avg(ox) AS mo, avg(oy) AS mq, var_pop(ox) AS oo, var_pop(oy) AS qq FROM p GROUP BY well),
f AS (SELECT *, (xo * yy - yo * xy) / (xx * yy - xy * xy) AS a, (yo * xx - xo * xy) / (xx * yy - xy * xy) AS b, (xq * yy - yq * xy) / (xx * yy - xy * xy) AS c, (yq * xx - xq * xy) / (xx * yy - xy * xy) AS d FROM s)
SELECT well, n, round(a, 6) AS a, round(b, 6) AS b, round(mo - a * mx - b * my, 4) AS tx, round(c, 6) AS c, round(d, 6) AS d, round(mq - c * mx - d * my, 4) AS ty,
  round(sqrt(oo - a * xo - b * yo + qq - c * xq - d * yq), 3) AS rmsd FROM f""",
)
def fit_affine(points10, points40):
    out = om.fit_affine(_pairs(points10, points40))
    return out.select("well", "n", *[F.round(c, 6).alias(c) for c in "ab"], F.round("tx", 4).alias("tx"), *[F.round(c, 6).alias(c) for c in "cd"], F.round("ty", 4).alias("ty"), F.round("rmsd", 3).alias("rmsd"))


@query("q9_10_fit_scaled_rotation")
def fit_scaled_rotation(points10, points40):
    return om.fit_scaled_rotation(_pairs(points10, points40))


@query("q9_12_ransac_inliers")
def ransac_inliers(points10, points40):
    pairs = _pairs(points10, points40)
    spoilt = F.when(F.col("point") % 7 == 0, F.col("ox") + 500 + F.col("point") % 300).otherwise(F.col("ox"))
    return om.ransac_inliers(pairs.withColumn("ox", spoilt), 10.0)


@query("q9_13_match_iteratively")
def match_iteratively(points10, points40):
    return om.match_iteratively(points10, points40, 60.0)


@query("q7_1_wells_of_both", "SELECT well FROM {points10} INTERSECT SELECT well FROM {points40}")
def wells_of_both(points10, points40):
    return points10.select("well").intersect(points40.select("well")).orderBy("well")


