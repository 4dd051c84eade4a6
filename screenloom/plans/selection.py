"""Queries: selecting, sampling and arranging cells; comparing runs; benchmark tables; sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenloom.operators import albums as oa
from screenloom.operators import compare as oc
from screenloom.operators.barcodes import in_library
from screenloom.plans.registry import query

_NAME = "concat_ws('-', well, tile, cell)"
_CELLS = "cells AS (SELECT p.*, g.sgrna FROM {phenotypes} AS p JOIN {genotypes} AS g ON p.well = g.well AND p.tile = g.tile AND p.cell = g.cell)"
_BRIGHT = f"{_CELLS}, bright AS (SELECT *, row_number() OVER (PARTITION BY sgrna ORDER BY ints_avg DESC, well, tile, cell) - 1 AS slot FROM cells)"


def _cells(phenotypes, genotypes):
    return phenotypes.join(genotypes.select("well", "tile", "cell", "sgrna"), ["well", "tile", "cell"])


@query(
    "q2_16_phenotyped",
    """SELECT well, count(*) AS cells, count(*) FILTER (area_nuc <> -1) AS phenotyped, count(*) FILTER (area_nuc <> -1 AND image <> '-1') AS imaged,
  round(avg(CASE WHEN area_nuc <> -1 AND image <> '-1' THEN 1.0 ELSE 0.0 END), 6) AS fraction FROM {phenotypes} GROUP BY well""",
)
def retained(phenotypes):
    return oa.retained(phenotypes, "well")


@query("q2_17_intensity_range", "SELECT well, tile, cell FROM {phenotypes} WHERE ints_avg BETWEEN 40000 AND 60000")
def intensity_range(phenotypes):
    return oa.intensity_between(phenotypes, 40000, 60000, "ints_avg").select("well", "tile", "cell")


@query("q2_17_log_intensity_range", "SELECT well, tile, cell FROM {phenotypes} WHERE ints_avg BETWEEN power(10, 4.6) AND power(10, 4.75)")
def log_intensity_range(phenotypes):
    return oa.intensity_between(phenotypes, 4.6, 4.75, "ints_avg", log10=True).select("well", "tile", "cell")


@query("q2_28_cell_names", "SELECT well, tile, cell, concat(sgrna, '_W-', well, '_T-', tile, '_C-', cell) AS name FROM {genotypes}")
def cell_names(genotypes):
    return oa.cell_names(genotypes)


@query("q2_31_keep_requested", "SELECT * FROM {genotypes} WHERE well IN (1, 4) AND sgrna IN (SELECT sgrna FROM {library} WHERE lib_idx % 3 = 0)")
def keep_requested(genotypes, library):
    return genotypes.filter(F.col("well").isin(1, 4)).join(library.filter("lib_idx % 3 = 0").select("sgrna"), "sgrna", "left_semi")


@query("q6_1_brightest", f"WITH {_BRIGHT} SELECT well, tile, cell, sgrna, slot FROM bright WHERE slot < 6")
def brightest(phenotypes, genotypes):
    return oa.brightest(_cells(phenotypes, genotypes), "sgrna", "ints_avg", 6).select("well", "tile", "cell", "sgrna", "slot")


_DRAWN = f"{_CELLS}, drawn AS (SELECT *, row_number() OVER (PARTITION BY sgrna ORDER BY md5(concat('7|', {_NAME})), {_NAME}) - 1 AS slot FROM cells)"


@query("q6_2_random_cells", f"WITH {_DRAWN} SELECT well, tile, cell, sgrna, slot FROM drawn WHERE slot < 5")
def random_cells(phenotypes, genotypes):
    return oa.draw(_cells(phenotypes, genotypes), "sgrna", 5, 7, F.concat_ws("-", "well", "tile", "cell")).select("well", "tile", "cell", "sgrna", "slot")


@query("q6_3_guides_with_enough", f"WITH {_BRIGHT} SELECT well, tile, cell, sgrna, slot FROM bright WHERE slot < 4 AND sgrna IN (SELECT sgrna FROM cells GROUP BY sgrna HAVING count(*) >= 5)")
def guides_with_enough(phenotypes, genotypes):
    return oa.guides_with_enough(_cells(phenotypes, genotypes), 5, 4).select("well", "tile", "cell", "sgrna", "slot")


@query("q6_4_sample_per_guide", f"WITH {_DRAWN} SELECT well, tile, cell, sgrna FROM drawn WHERE slot < 3")
def sample_per_guide(phenotypes, genotypes):
    return oa.draw(_cells(phenotypes, genotypes), "sgrna", 3, 7, F.concat_ws("-", "well", "tile", "cell")).select("well", "tile", "cell", "sgrna")


@query("q6_6_album_layout", f"WITH {_BRIGHT} SELECT well, tile, cell, sgrna, slot, slot // 3 AS album_row, slot % 3 AS album_col FROM bright WHERE slot < 6")
def album_layout(phenotypes, genotypes):
    return oa.layout(brightest(phenotypes, genotypes), 3)


@query("q6_7_representative_cells")
def representative_cells(phenotypes, genotypes):
    return oa.representative_cells(_cells(phenotypes, genotypes), 3).select("well", "tile", "cell", "sgrna", "slot")


@query("q9_9_intensity_modes")
def intensity_modes(phenotypes, genotypes):
    return oa.intensity_modes(_cells(phenotypes, genotypes), "sgrna", "ints_avg")


@query("q9_15_thumbnails")
def thumbnails(pixels):
    return oa.thumbnails(pixels, "ch0")


@query("q9_16_albums")
def albums(pixels, phenotypes, genotypes):
    slots = oa.brightest(_cells(phenotypes, genotypes), "sgrna", "ints_avg", 6)
    shown = pixels.join(slots.select("well", "tile", "cell"), ["well", "tile", "cell"], "left_semi")
    return oa.assemble_albums(slots, oa.thumbnails(shown, "ch0"), 2, 3, 16)


@query(
    "q1_11_album_records",
    f"""WITH {_BRIGHT}
SELECT sgrna, concat('{{{{"rows":2,"columns":3,"count":', count(*), ',"cells":["', string_agg({_NAME}, '","' ORDER BY slot), '"]}}}}') AS record FROM bright WHERE slot < 6 GROUP BY sgrna""".replace("{{", "{").replace("}}", "}"),
)
def album_records(phenotypes, genotypes):
    return oa.album_records(brightest(phenotypes, genotypes), 2, 3)


_LOCAL = "SELECT split_part(sgrna, '_', 1) AS gene, CASE WHEN lib_idx % 3 = 0 THEN 'nucleus' ELSE 'cytoplasm' END AS localization FROM {library}"


@query("q3_13_localized_guides", f"SELECT DISTINCT sgrna FROM {{genotypes}} WHERE split_part(sgrna, '_', 1) IN (SELECT gene FROM ({_LOCAL}) WHERE localization = 'nucleus')")
def localized_guides(genotypes, library):
    table = library.select(F.split("sgrna", "_")[0].alias("gene"), F.when(F.col("lib_idx") % 3 == 0, "nucleus").otherwise("cytoplasm").alias("localization"))
    return oa.localized(genotypes, table, "nucleus")


@query(
    "q3_10_mapped_cells",
    """WITH c AS (SELECT DISTINCT well, tile, cell FROM {pixels} WHERE cell > 0), h AS (SELECT well, tile, cell, count(*) FILTER (barcode IN (SELECT sgrna_seq FROM {library})) AS hits FROM {reads} GROUP BY ALL)
SELECT well, tile, cell, coalesce(hits, 0) > 0 AS any_mapped, coalesce(hits, 0) = 1 AS one_mapped FROM c LEFT JOIN h USING (well, tile, cell)""",
)
def mapped_cells(pixels, reads, library):
    return oc.mapped_cells(pixels.filter("cell > 0"), in_library(reads, library))


@query(
    "q3_11_matched_share",
    "SELECT well, tile, count(*) AS cells, avg(CASE WHEN p.cell IS NULL THEN 0.0 ELSE 1.0 END) AS fraction FROM {genotypes} AS g LEFT JOIN (SELECT well, tile, cell FROM {phenotypes} WHERE area_nuc <> -1) AS p USING (well, tile, cell) GROUP BY well, tile",
)
def matched_share(genotypes, phenotypes):
    return oc.matched_share(genotypes, phenotypes.withColumn("distance", F.when(F.col("area_nuc") != -1, F.col("area_nuc"))))


_COMPARED = """compared AS (
  SELECT well, tile, cell, coalesce(a.sgrna, 'None') AS a, coalesce(b.sgrna, 'None') AS b, (a.sgrna IS NOT NULL)::BIGINT + (b.sgrna IS NOT NULL)::BIGINT AS found, coalesce(a.sgrna = b.sgrna, false) AS match
  FROM {genotypes} AS a FULL JOIN {genotypes2} AS b USING (well, tile, cell)
)"""


@query("q3_12_compare_assignments", f"WITH {_COMPARED} SELECT * FROM compared")
def compare_assignments(genotypes, genotypes2):
    return oc.compare_assignments(genotypes, genotypes2)


@query("q3_12_agreement", f"WITH {_COMPARED} SELECT count(*) AS cells, count(*) FILTER (found = 2) AS in_both, round(100 * count(*) FILTER (found = 2 AND match) / count(*) FILTER (found = 2), 4) AS percent FROM compared")
def agreement(genotypes, genotypes2):
    return oc.agreement(oc.compare_assignments(genotypes, genotypes2))


@query(
    "q3_15_run_difference",
    """WITH b AS (SELECT p.sgrna AS s, q.sgrna AS t, p.reads AS x, q.reads AS y FROM {genotypes} AS p JOIN {genotypes2} AS q ON p.well = q.well AND p.tile = q.tile AND p.cell = q.cell)
SELECT count(*) AS common, round(100 * avg(CASE WHEN s <> t THEN 1.0 ELSE 0.0 END), 4) AS percent_other_guide, round(avg(abs(x - y)), 6) AS reads_absolute, round(avg(abs(x - y) / (abs(x) + 1e-10)), 6) AS reads_relative,
  avg(abs(x - y) / (abs(x) + 1e-10)) <= 0.05 AS reads_within,
  (SELECT count(*) FROM {genotypes} AS p ANTI JOIN {genotypes2} AS q ON p.well = q.well AND p.tile = q.tile AND p.cell = q.cell) AS missing,
  (SELECT count(*) FROM {genotypes2} AS p ANTI JOIN {genotypes} AS q ON p.well = q.well AND p.tile = q.tile AND p.cell = q.cell) AS extra FROM b""",
)
def run_difference(genotypes, genotypes2):
    return oc.run_difference(genotypes, genotypes2, ["reads"])


@query(
    "q3_16_segmentation_difference",
    """WITH a AS (SELECT well, tile, count(*) AS n_a, avg(n) AS area_a FROM (SELECT well, tile, cell, count(*) AS n FROM {pixels} WHERE cell > 0 GROUP BY ALL) GROUP BY well, tile),
b AS (SELECT well, tile, count(*) AS n_b, avg(n) AS area_b FROM (SELECT well, tile, cell, count(*) AS n FROM {pixels} WHERE cell > 0 AND cell % 7 <> 0 AND i % 8 <> 1 GROUP BY ALL) GROUP BY well, tile)
SELECT well, tile, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b, round(coalesce(area_a, 0), 4) AS area_a, round(coalesce(area_b, 0), 4) AS area_b,
  abs(coalesce(n_a, 0) - coalesce(n_b, 0)) <= 0.01 * coalesce(n_a, 0) AS counts_agree, abs(coalesce(area_a, 0) - coalesce(area_b, 0)) <= 0.2 * coalesce(area_a, 0) AS areas_agree
FROM a FULL JOIN b USING (well, tile)""",
)
def segmentation_difference(pixels):
    return oc.segmentation_difference(pixels, pixels.filter("cell % 7 <> 0 AND i % 8 <> 1"))


@query(
    "q4_27_size_statistics",
    "SELECT mag, count(n) AS n, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, min(n) AS min, max(n) AS max FROM (SELECT '10X' AS mag, count(*) AS n FROM {points10} GROUP BY well UNION ALL SELECT '40X', count(*) FROM {points40} GROUP BY well) GROUP BY mag",
)
def size_statistics(points10, points40):
    per = lambda df, m: df.groupBy("well").agg(F.count(F.lit(1)).alias("n")).select(F.lit(m).alias("mag"), "n")
    return oc.size_statistics(per(points10, "10X").union(per(points40, "40X")), "mag", "n")


_METRICS = ", ".join(f"round(avg({m}), 4) AS {m}_mean, round(stddev_samp({m}), 4) AS {m}_std" for m in oc.METRICS)


@query(
    "q4_28_benchmark_summary",
    f"SELECT optimization, num_points, noise_level, outlier_fraction, well, count(*) AS trials, {_METRICS} FROM {{trials}}"
    " GROUP BY GROUPING SETS ((optimization, num_points, noise_level, outlier_fraction), (optimization, well), (optimization))",
)
def benchmark_summary(trials):
    return oc.benchmark_summary(trials)


@query(
    "q4_29_optimizer_ratios",
    """WITH w AS (SELECT num_points, """
    + ", ".join(f"avg({c}) FILTER (optimization = '{o}') AS {o}_{m}" for o in ("lbfgs", "lm") for m, c in (("rmsd", "rmsd"), ("time", "time_ms")))
    + """ FROM {trials} GROUP BY num_points)
SELECT num_points, round(lbfgs_rmsd, 4) AS lbfgs_rmsd, round(lbfgs_time, 4) AS lbfgs_time, round(lm_rmsd, 4) AS lm_rmsd, round(lm_time, 4) AS lm_time,
  round(lm_rmsd / lbfgs_rmsd, 6) AS lm_rmsd_ratio, round(lm_time / lbfgs_time, 6) AS lm_time_ratio FROM w""",
)
def optimizer_ratios(trials):
    return oc.optimizer_ratios(trials, ["lbfgs", "lm"], "lbfgs")


@query("q4_30_heat_table", "SELECT noise_level, " + ", ".join(f"round(avg(rmsd) FILTER (outlier_fraction = {c / 100}), 4) AS outliers_{c}" for c in range(9)) + " FROM {trials} GROUP BY noise_level")
def heat_table(trials):
    return oc.heat_table(trials, [c / 100 for c in range(9)])


@query(
    "q4_31_success_rates",
    """WITH q AS (SELECT quantile_cont(rmsd, [0.25, 0.5, 0.75]) AS q FROM {trials})
SELECT optimization, """
    + ", ".join(f"round(avg(CASE WHEN rmsd <= q[{i}] THEN 1.0 ELSE 0.0 END), 6) AS success_q{i}" for i in (1, 2, 3))
    + """, round(stddev_samp(rmsd) / avg(rmsd), 6) AS variation FROM {trials}, q GROUP BY optimization""",
)
def success_rates(trials):
    return oc.success_rates(trials)


@query(
    "q4_32_speedups",
    """WITH p AS (SELECT num_points AS workers, sum(time_ms / num_points) AS seconds, count(*) AS images FROM {trials} GROUP BY 1),
b AS (SELECT seconds AS base FROM p WHERE workers = 1), m AS (SELECT workers AS best FROM p ORDER BY images / seconds DESC, workers LIMIT 1)
SELECT workers, round(seconds, 4) AS seconds, round(images / seconds, 6) AS rate, round(base / seconds, 6) AS speedup, workers = m.best AS best FROM p, b, m""",
)
def speedups(trials):
    return oc.speedups(trials.select(F.col("num_points").alias("workers"), (F.col("time_ms") / F.col("num_points")).alias("seconds")))


@query("q4_33_status_counts", "SELECT well, count(*) AS files, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'error') AS failed FROM {arrivals} GROUP BY well")
def status_counts(arrivals):
    return oc.status_counts(arrivals)


@query(
    "q7_2_missing_and_extra",
    "SELECT *, 'missing' AS side FROM (SELECT well, tile, cell, sgrna FROM {genotypes} EXCEPT ALL SELECT well, tile, cell, sgrna FROM {genotypes2}) UNION ALL SELECT *, 'extra' FROM (SELECT well, tile, cell, sgrna FROM {genotypes2} EXCEPT ALL SELECT well, tile, cell, sgrna FROM {genotypes})",
)
def missing_and_extra(genotypes, genotypes2):
    return oc.missing_and_extra(genotypes.select("well", "tile", "cell", "sgrna"), genotypes2.select("well", "tile", "cell", "sgrna"))


@query("q7_3_all_cells", "SELECT well, tile, cell FROM {genotypes} UNION SELECT well, tile, cell FROM {genotypes2}")
def all_cells(genotypes, genotypes2):
    return oc.all_cells(genotypes, genotypes2)


@query("q7_4_append_batches", "SELECT well, tile, cell, sgrna, reads FROM {genotypes} UNION ALL SELECT well, tile, cell, sgrna, NULL FROM {genotypes2}")
def append_batches(genotypes, genotypes2):
    return genotypes.unionByName(genotypes2.drop("reads"), allowMissingColumns=True)
