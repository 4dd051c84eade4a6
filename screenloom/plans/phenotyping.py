"""Queries: masks, shapes, intensities, textures."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenloom.functions.geometry import circularity, ratio
from screenloom.operators import features as of
from screenloom.operators.iterate import spread_out
from screenloom.plans.registry import query

_SHAPES = """SELECT well, tile, {label}, area, i_min, i_max, j_min, j_max, y, x, area::DOUBLE / ((i_max - i_min + 1) * (j_max - j_min + 1)) AS extent,
  sqrt(4 * area / pi()) AS equivalent_diameter, 4 * sqrt(l1) AS major_axis, 4 * sqrt(l2) AS minor_axis, sqrt(1 - l2 / l1) AS eccentricity, 0.5 * atan2(2 * c, a - b) AS orientation
FROM (SELECT *, (a + b) / 2 + sqrt((a - b) ** 2 / 4 + c * c) AS l1, greatest((a + b) / 2 - sqrt((a - b) ** 2 / 4 + c * c), 0) AS l2
  FROM (SELECT well, tile, {label}, count(*) AS area, min(i) AS i_min, max(i) AS i_max, min(j) AS j_min, max(j) AS j_max, avg(i) AS y, avg(j) AS x,
    var_pop(i) + 1 / 12 AS a, var_pop(j) + 1 / 12 AS b, covar_pop(i, j) AS c FROM {{pixels}} WHERE {label} > 0 GROUP BY well, tile, {label}))"""
_ROUND = ["y", "x", "extent", "equivalent_diameter", "major_axis", "minor_axis", "eccentricity"]
_ROUNDED = ", ".join(f"round({c}, 4) AS {c}" for c in _ROUND)


def _rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in _ROUND})


@query("q3_1_spot_to_cell", "SELECT s.read, p.cell FROM {spots} AS s JOIN {pixels} AS p ON s.well = p.well AND s.tile = p.tile AND s.i = p.i AND s.j = p.j WHERE p.cell > 0")
def spot_to_cell(spots, pixels):
    return of.label_at(spots.select("read", "well", "tile", "i", "j", "cell"), pixels).select("read", "cell")


_NUCLEI = """nuclei AS (
  SELECT c.well, c.tile, c.nucleus, p.cell, c.y, c.x FROM (SELECT well, tile, nucleus, avg(i) AS y, avg(j) AS x FROM {pixels} WHERE nucleus > 0 GROUP BY ALL) AS c
  JOIN {pixels} AS p ON c.well = p.well AND c.tile = p.tile AND floor(c.y) = p.i AND floor(c.x) = p.j WHERE p.cell > 0
)"""


@query("q3_2_nucleus_to_cell", f"WITH {_NUCLEI} SELECT well, tile, nucleus, cell, round(y, 6) AS y, round(x, 6) AS x FROM nuclei")
def nucleus_to_cell(pixels):
    return of.nuclei_in_cells(pixels).withColumns({c: F.round(c, 6) for c in "yx"})


@query("q4_20_shapes", f"SELECT well, tile, cell, area, i_min, i_max, j_min, j_max, {_ROUNDED} FROM ({_SHAPES.format(label='cell').replace('{{', '{').replace('}}', '}')})")
def shapes(pixels):
    return _rounded(of.shapes(pixels)).drop("orientation")


_STATS = "round(avg({v}), 6) AS {p}mean, sum({v})::DOUBLE AS {p}total, max({v})::DOUBLE AS {p}max, min({v})::DOUBLE AS {p}min, round(stddev_pop({v}), 6) AS {p}std"


@query("q4_21_region_intensities", f"SELECT well, tile, cell, channel, {_STATS.format(v='value', p='')} FROM {{values}} WHERE cell > 0 GROUP BY ALL")
def region_intensities(values):
    return of.region_intensities(values, F.lit(True))


@query(
    "q4_22_nonzero_intensities",
    "SELECT well, tile, cell, channel, round(coalesce(avg(v), 0), 6) AS mean, coalesce(sum(v), 0)::DOUBLE AS total, coalesce(max(v), 0)::DOUBLE AS max, coalesce(min(v), 0)::DOUBLE AS min, round(coalesce(stddev_pop(v), 0), 6) AS std"
    " FROM (SELECT *, CASE WHEN value > 0 THEN value END AS v FROM {values}) WHERE cell > 0 GROUP BY well, tile, cell, channel",
)
def nonzero_intensities(values):
    return of.region_intensities(values, F.lit(True), nonzero=True)


_WIDE = ", ".join(
    f"max(CASE WHEN channel = {c} THEN {n} END) AS ch{c}_{n}" for c in range(3) for n in ("cell_mean", "cell_max", "cell_std", "cell_total", "nucleus_mean", "nucleus_max")
)
_WIDE_SQL = f"""wide AS (
  SELECT well, tile, cell, {_WIDE} FROM (
    SELECT well, tile, cell, channel, {_STATS.format(v='value', p='cell_')}, round(avg(value) FILTER (nucleus > 0), 6) AS nucleus_mean, (max(value) FILTER (nucleus > 0))::DOUBLE AS nucleus_max
    FROM {{values}} WHERE cell > 0 GROUP BY well, tile, cell, channel) GROUP BY well, tile, cell
)"""


@query("q4_23_wide_intensities", f"WITH {_WIDE_SQL} SELECT * FROM wide")
def wide_intensities(values):
    return of.wide_intensities(values, [0, 1, 2])


_R2 = """SELECT well, tile, cell, round(CASE WHEN n > 5 AND vx > 0 AND vy > 0 THEN c * c / (vx * vy) ELSE 0 END, 6) AS r2
FROM (SELECT well, tile, cell, count(x) AS n, covar_pop(x, y) AS c, var_pop(x) AS vx, var_pop(y) AS vy
  FROM (SELECT *, CASE WHEN ch0 > 0 AND ch1 > 0 AND {where} THEN ch0 END AS x, CASE WHEN ch0 > 0 AND ch1 > 0 AND {where} THEN ch1 END AS y FROM {{pixels}} WHERE cell > 0) GROUP BY well, tile, cell)"""


@query("q4_24_colocalization", _R2.format(where="true").replace("{{", "{").replace("}}", "}"))
def colocalization(pixels):
    return of.colocalization(pixels, "ch0", "ch1", F.lit(True))


@query("q4_24_colocalization_cytoplasm", _R2.format(where="nucleus = 0").replace("{{", "{").replace("}}", "}"))
def colocalization_cytoplasm(pixels):
    return of.colocalization(pixels, "ch0", "ch1", F.col("nucleus") == 0)


_FIRST = "first AS (SELECT well, tile, cell, sgrna FROM {genotypes} QUALIFY row_number() OVER (PARTITION BY well, tile, cell ORDER BY reads DESC, sgrna) = 1)"


@query(
    "q4_25_cell_features",
    f"""WITH shape AS ({_SHAPES.format(label='cell').replace('{{', '{').replace('}}', '}')}), nuclear AS (SELECT well, tile, nucleus AS cell, count(*) AS nucleus_area FROM {{pixels}} WHERE nucleus > 0 GROUP BY ALL),
{_WIDE_SQL}, coloc AS ({_R2.format(where='true').replace('{{', '{').replace('}}', '}')}), {_FIRST}
SELECT well, tile, cell, area, i_min, i_max, j_min, j_max, {_ROUNDED}, coalesce(nucleus_area, 0) AS nucleus_area, round(coalesce(nucleus_area, 0)::DOUBLE / area, 6) AS nucleus_ratio,
  wide.* EXCLUDE (well, tile, cell), r2, sgrna
FROM shape LEFT JOIN nuclear USING (well, tile, cell) LEFT JOIN wide USING (well, tile, cell) LEFT JOIN coloc USING (well, tile, cell) LEFT JOIN first USING (well, tile, cell)""",
)
def cell_features(pixels, values, genotypes):
    out = _rounded(of.cell_features(pixels, values, genotypes, [0, 1, 2])).drop("orientation")
    return out.withColumn("nucleus_ratio", F.round("nucleus_ratio", 6))


_PERIMETER = f"""inside AS (SELECT DISTINCT well, tile, cell, i, j FROM {{pixels}} WHERE cell > 0),
border AS (
  SELECT p.well, p.tile, p.cell, p.i, p.j FROM inside AS p JOIN inside AS o ON p.well = o.well AND p.tile = o.tile AND p.cell = o.cell
  GROUP BY ALL HAVING count(*) FILTER (abs(p.i - o.i) + abs(p.j - o.j) = 1) < 4
), coded AS (
  SELECT p.well, p.tile, p.cell, p.i, p.j, 1 + 2 * count(*) FILTER (abs(p.i - o.i) + abs(p.j - o.j) = 1) + 10 * count(*) FILTER (abs(p.i - o.i) = 1 AND abs(p.j - o.j) = 1) AS code
  FROM border AS p JOIN border AS o ON p.well = o.well AND p.tile = o.tile AND p.cell = o.cell GROUP BY ALL
), outline AS (
  SELECT well, tile, cell, sum(CASE {' '.join(f'WHEN code = {c} THEN {v!r}::DOUBLE' for c, v in of.PERIMETER.items())} ELSE 0 END) AS perimeter FROM coded GROUP BY ALL
)"""


@query("q9_7_perimeter", f"WITH {_PERIMETER} SELECT well, tile, cell, round(perimeter, 6) AS perimeter FROM outline")
def perimeter(pixels):
    return of.perimeters(pixels).withColumn("perimeter", F.round("perimeter", 6))


@query(
    "q2_27_ratios",
    f"""WITH {_PERIMETER}
SELECT well, tile, cell, round(CASE WHEN perimeter = 0 THEN 0 ELSE 4 * pi() * area / (perimeter * perimeter) END, 6) AS circularity, round(coalesce(nucleus_area, 0)::DOUBLE / area, 6) AS nucleus_ratio
FROM (SELECT well, tile, cell, count(*) AS area, count(*) FILTER (nucleus > 0) AS nucleus_area FROM {{pixels}} WHERE cell > 0 GROUP BY ALL) JOIN outline USING (well, tile, cell)""",
)
def ratios(pixels):
    areas = pixels.filter("cell > 0").groupBy("well", "tile", "cell").agg(F.count(F.lit(1)).alias("area"), F.sum((F.col("nucleus") > 0).cast("long")).alias("n"))
    both = areas.join(of.perimeters(pixels), ["well", "tile", "cell"])
    return both.select("well", "tile", "cell", F.round(circularity(F.col("area"), F.col("perimeter")), 6).alias("circularity"), F.round(ratio(F.col("n"), F.col("area")), 6).alias("nucleus_ratio"))


@query("q2_18_size_filters", f"SELECT well, tile, cell, area FROM ({_SHAPES.format(label='cell').replace('{{', '{').replace('}}', '}')}) WHERE i_max - i_min + 1 < 7 AND j_max - j_min + 1 < 8 AND area BETWEEN 10 AND 40")
def size_filters(pixels):
    cells = of.shapes(pixels)
    return of.crop_sized(cells.filter("i_max - i_min + 1 < 7"), 8, 10, 40).select("well", "tile", "cell", "area")


@query("q3_8_with_genotype", f"WITH {_FIRST} SELECT well, tile, cell, ints_avg, area_nuc, sgrna FROM {{phenotypes}} LEFT JOIN first USING (well, tile, cell)")
def with_genotype(phenotypes, genotypes):
    return of.with_genotype(phenotypes, genotypes).select("well", "tile", "cell", "ints_avg", "area_nuc", "sgrna")


@query("q5_3_single_nucleus_cells", f"WITH {_NUCLEI} SELECT well, tile, nucleus, cell FROM nuclei QUALIFY count(*) OVER (PARTITION BY well, tile, cell) = 1")
def single_nucleus_cells(pixels):
    return of.single_nucleus_cells(of.nuclei_in_cells(pixels)).select("well", "tile", "nucleus", "cell")


@query("q5_4_relabel", "SELECT well, tile, cell, dense_rank() OVER (PARTITION BY well, tile ORDER BY cell) AS new_label FROM (SELECT DISTINCT well, tile, cell FROM {pixels} WHERE cell > 0)")
def relabel(pixels):
    return of.relabelled(pixels.filter("cell > 0").select("well", "tile", "cell").distinct())


CLEAN_MASK = f"""WITH {_NUCLEI}, box AS (
  SELECT well, tile, cell FROM {{pixels}} WHERE cell > 0 GROUP BY ALL HAVING min(i) >= 3 AND min(j) >= 3 AND max(i) < 29 AND max(j) < 29
), one AS (SELECT well, tile, cell, nucleus FROM nuclei QUALIFY count(*) OVER (PARTITION BY well, tile, cell) = 1),
kept AS (SELECT well, tile, cell, nucleus AS own, dense_rank() OVER (PARTITION BY well, tile ORDER BY cell) AS new_label FROM one JOIN box USING (well, tile, cell))
SELECT p.well, p.tile, p.i, p.j, new_label AS cell, CASE WHEN p.nucleus = own THEN new_label ELSE 0 END AS nucleus FROM {{pixels}} AS p JOIN kept USING (well, tile, cell)"""


@query("q5_5_clean_mask", CLEAN_MASK)
def clean_mask(pixels):
    return of.clean_mask(pixels, 32, 32)


_AROUND = "FROM {values} AS v JOIN {values} AS o ON v.well = o.well AND v.tile = o.tile AND v.channel = o.channel AND o.i BETWEEN v.i - {h} AND v.i + {h} AND o.j BETWEEN v.j - {h} AND v.j + {h}"


@query("q9_3_max_filter", "SELECT v.well, v.tile, v.channel, v.i, v.j, max(o.value) AS largest " + _AROUND.replace("{h}", "1") + " WHERE v.channel = 0 GROUP BY ALL")
def max_filter(values):
    return of.neighbourhood_max(values.filter("channel = 0"), 3).select("well", "tile", "channel", "i", "j", "largest")


@query(
    "q9_4_cycle_variation",
    """SELECT well, tile, i, j, round(avg(s), 6) AS variation FROM (
  SELECT well, tile, i, j, channel, stddev_pop((value * (1 + k) + k * 17) % 256) AS s FROM {values}, (SELECT unnest(range(0, 4)) AS k) GROUP BY well, tile, i, j, channel) GROUP BY ALL""",
)
def cycle_variation(values):
    values = spread_out(values.select("well", "tile", "i", "j", "channel", "value"), "well", "tile", "i", "j")
    stack = values.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return of.cycle_variation(stack.withColumn("value", (F.col("value") * (1 + F.col("k")) + F.col("k") * 17) % 256))


@query(
    "q9_5_local_maxima",
    "SELECT well, tile, channel, i, j, value, score FROM (SELECT v.well, v.tile, v.channel, v.i, v.j, v.value, max(o.value) AS largest, max(o.value) - min(o.value) AS score "
    + _AROUND.replace("{h}", "2")
    + " WHERE v.channel = 0 GROUP BY ALL) WHERE value = largest AND score > 20",
)
def local_maxima(values):
    return of.local_maxima(values.filter("channel = 0"), 5, 20)


@query("q9_7_outline_measures")
def outline_measures(pixels):
    return of.outline_measures(pixels)


@query(
    "q9_8_texture",
    """WITH p AS (
  SELECT well, tile, cell, i, j, floor(ch0 * 255 / max(ch0) OVER (PARTITION BY well, tile, cell))::BIGINT AS v FROM {pixels} WHERE cell > 0 AND ch0 > 0 QUALIFY v > 0
),
s AS (SELECT d, w, a * d AS di, b * d AS dj FROM (SELECT unnest([1, 2, 4]) AS d), (VALUES (0, 0, 1), (1, 1, 0), (2, 1, 1), (3, 1, -1)) AS t(w, a, b)),
pair AS (SELECT x.well, x.tile, x.cell, d, w, x.v AS a, y.v AS b FROM p AS x, s JOIN p AS y ON x.well = y.well AND x.tile = y.tile AND x.cell = y.cell AND y.i = x.i + di AND y.j = x.j + dj),
c AS (SELECT well, tile, cell, d, w, a, b, count(*) AS n FROM (SELECT * FROM pair UNION ALL SELECT well, tile, cell, d, w, b, a FROM pair) GROUP BY ALL),
q AS (SELECT c.*, n / sum(n) OVER k AS p, sum(n * a) OVER k / sum(n) OVER k AS m FROM c WINDOW k AS (PARTITION BY well, tile, cell, d, w)),
f AS (SELECT well, tile, cell, d, w, sum(p * (a - b) * (a - b)) AS contrast, sum(p * (a - m) * (b - m)) / nullif(sum(p * (a - m) * (a - m)), 0) AS correlation, sum(p * p) AS asm,
  sum(p / (1 + (a - b) * (a - b))) AS idm, -sum(p * log2(p)) AS entropy FROM q GROUP BY well, tile, cell, d, w)
SELECT well, tile, cell, d, round(avg(contrast), 6) AS contrast, round(avg(correlation), 6) AS correlation, round(avg(asm), 6) AS asm, round(avg(idm), 6) AS idm, round(avg(entropy), 6) AS entropy FROM f GROUP BY well, tile, cell, d""",
)
def texture(pixels):
    return of.texture(pixels, "ch0")


@query(
    "q2_29_normalized",
    """SELECT well, tile, cell, channel, i, j, round(CASE WHEN b > a THEN greatest(0, least(1, (value - a) / (b - a))) ELSE 0 END, 6) AS value
FROM {values} JOIN (SELECT well, tile, cell, channel, min(value) AS a, quantile_cont(value, 0.995) AS b FROM {values} WHERE cell > 0 GROUP BY ALL) USING (well, tile, cell, channel)""",
)
def normalized(values):
    return of.normalized(values)
