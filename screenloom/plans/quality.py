"""Queries: quality reports and ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenloom.functions.bases import gene, intron
from screenloom.operators import qc
from screenloom.operators.barcodes import ambiguity_matches, in_library
from screenloom.operators.features import clean_labels
from screenloom.operators.iterate import saved
from screenloom.plans.genotyping import CELL_REPORT, CODED, code, coded
from screenloom.plans.phenotyping import CLEAN_MASK
from screenloom.plans.registry import query

_GENE = "split_part(sgrna, '_', 1)"
_INTRON = f"CASE WHEN contains(sgrna, '_') THEN concat({_GENE}, '_', split_part(sgrna, '_', 2)) ELSE sgrna END"
_TARGETING = f"try_cast({_GENE} AS int) IS NULL"


@query(
    "q4_6_tile_and_well_summary",
    """WITH t AS (
  SELECT well, tile, count(*) AS cells, sum(reads) AS reads, list_distinct(list(sgrna)) AS guides FROM {genotypes} GROUP BY well, tile
), f AS (
  SELECT well, tile, count(*) AS failures FROM {arrivals} WHERE status = 'error' GROUP BY well, tile
)
SELECT well, tile, sum(cells)::BIGINT AS cells, sum(reads)::BIGINT AS reads, len(list_distinct(flatten(list(guides)))) AS unique_guides,
  count(*) AS tiles, coalesce(sum(failures), 0)::BIGINT AS failures
FROM t LEFT JOIN f USING (well, tile) GROUP BY ROLLUP (well, tile)""",
)
def tile_and_well_summary(genotypes, arrivals):
    return qc.tile_and_well_summary(genotypes, arrivals.filter("status = 'error'"))


@query(
    "q4_7_counts_of_counts",
    """WITH c AS (SELECT count(*) AS reads, count(DISTINCT barcode) AS barcodes FROM {reads} WHERE cell > 0 GROUP BY well, tile, cell)
SELECT 'reads' AS what, reads AS k, count(*) AS cells FROM c GROUP BY reads UNION ALL SELECT 'barcodes', barcodes, count(*) FROM c GROUP BY barcodes""",
)
def counts_of_counts(reads):
    return qc.counts_of_counts(reads)


@query(
    "q4_8_top_and_others",
    """SELECT CASE WHEN rn < 10 THEN sgrna ELSE 'Others' END AS sgrna, sum(n)::BIGINT AS n
FROM (SELECT sgrna, n, row_number() OVER (ORDER BY n DESC, sgrna) AS rn FROM (SELECT sgrna, count(*) AS n FROM {genotypes} GROUP BY sgrna)) GROUP BY 1""",
)
def top_and_others(genotypes):
    return qc.top_and_others(genotypes.groupBy("sgrna").agg(F.count(F.lit(1)).alias("n")), "sgrna", 10)


_TILE_QC = (
    """WITH r AS (
  SELECT well, tile, count(*) AS peaks, count(*) FILTER (cell = 0) AS peaks_outside, count(DISTINCT cell) FILTER (cell > 0) AS cells_with_reads, """
    + ", ".join(f"sum(length(regexp_replace(barcode, '[^{b}]', '', 'g')))::BIGINT AS n_{b.lower()}" for b in "ACGTKMN")
    + ", "
    + ", ".join(f"round(avg(q[{k}]), 3) AS q_{k}" for k in range(1, 13))
    + """ FROM {reads} GROUP BY ALL
), m AS (
  SELECT well, tile, count(DISTINCT cell) FILTER (cell > 0) AS cells, count(DISTINCT nucleus) FILTER (nucleus > 0) AS nuclei FROM {pixels} GROUP BY ALL
), g AS (
  SELECT well, tile, count(DISTINCT sgrna) AS unique_guides, count(*) AS assigned_cells FROM {genotypes} GROUP BY ALL
), o AS (
  SELECT well, tile, sgrna, n, row_number() OVER (PARTITION BY well, tile ORDER BY n DESC, sgrna) AS rank
  FROM (SELECT well, tile, sgrna, count(*) AS n FROM {genotypes} GROUP BY ALL)
), p AS (
  SELECT well, tile, """
    + ", ".join(f"max(sgrna) FILTER (rank = {k}) AS top_{k}, max(n) FILTER (rank = {k}) AS top_{k}_n" for k in (1, 2, 3))
    + """ FROM o GROUP BY ALL
), tiles AS (
  SELECT * FROM r LEFT JOIN m USING (well, tile) LEFT JOIN g USING (well, tile) LEFT JOIN p USING (well, tile)
)"""
)


@query("q4_9_tile_qc", f"{_TILE_QC} SELECT * FROM tiles")
def tile_qc(reads, genotypes, pixels):
    return qc.tile_qc(reads, genotypes, pixels)


_LETTERS_LEFT = ("n_a", "n_c", "n_g", "n_t", "n_k", "n_m", "n_n")
_FULL = f"""{_TILE_QC}, clean AS (
  SELECT well, tile, count(DISTINCT cell) AS cells, count(DISTINCT nucleus) FILTER (nucleus > 0) AS nuclei FROM ({CLEAN_MASK}) GROUP BY ALL
), tried AS (
  SELECT well, tile, count(*) AS cells_tried, count(*) FILTER (assigned) AS cells_matched, count(*) FILTER (unmatched > 0) AS cells_unmatched, count(*) FILTER (too_uncertain > 0) AS cells_uncertain
  FROM ({CELL_REPORT}) GROUP BY ALL
), per AS (SELECT well, tile, count(*) AS reads, count(DISTINCT barcode) AS barcodes FROM {{reads}} WHERE cell > 0 GROUP BY well, tile, cell
), numbers AS (
  SELECT well, tile, {", ".join(f"count(*) FILTER ({w} {'=' if k < 3 else '>='} {k}) AS cells_with_{k}_{w}" for w in ("reads", "barcodes") for k in (1, 2, 3))} FROM per GROUP BY ALL
)
SELECT t.* EXCLUDE (cells, nuclei, unique_guides, assigned_cells, top_1_n, top_2_n, top_3_n), coalesce(t.cells, 0) AS cells_before, coalesce(t.nuclei, 0) AS nuclei_before, coalesce(unique_guides, 0) AS unique_guides,
  coalesce(assigned_cells, 0) AS assigned_cells, {", ".join(f"coalesce(top_{k}_n, 0) AS top_{k}_n" for k in (1, 2, 3))}, {" + ".join(_LETTERS_LEFT)} AS nucleotides, coalesce(clean.cells, 0) AS cells, coalesce(clean.nuclei, 0) AS nuclei,
  {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("cells_tried", "cells_matched", "cells_unmatched", "cells_uncertain", *(f"cells_with_{k}_{w}" for w in ("reads", "barcodes") for k in (1, 2, 3))))}
FROM tiles AS t LEFT JOIN clean USING (well, tile) LEFT JOIN tried USING (well, tile) LEFT JOIN numbers USING (well, tile)"""


@query("q4_9_tile_qc_in_full", _FULL)
def tile_qc_in_full(reads, genotypes, pixels, library):
    # pixels of a tile lie together, so that what is counted of its cells comes down within tasks
    mask = saved(pixels.select("well", "tile", "i", "j", "cell", "nucleus").repartition("well", "tile"), "mask", compression="zstd")
    return qc.tile_qc_in_full(reads, genotypes, mask, clean_labels(mask, 32, 32), library, code(), top=3)


def _recovery(prefix: str, source: str) -> str:
    return f"""SELECT count(DISTINCT {_GENE}) FILTER ({_TARGETING}) AS {prefix}_genes, count(DISTINCT {_INTRON}) FILTER ({_TARGETING}) AS {prefix}_introns,
  count(DISTINCT sgrna) AS {prefix}_guides, count(DISTINCT sgrna) FILTER ({_TARGETING}) AS {prefix}_targeting, count(DISTINCT sgrna) FILTER (NOT ({_TARGETING})) AS {prefix}_controls FROM {source}"""


_RECOVERY = (
    f"SELECT *, {', '.join(f'round(100 * found_{n}::DOUBLE / library_{n}, 1) AS percent_{n}' for n in ('genes', 'introns', 'guides', 'targeting', 'controls'))}"
    f" FROM ({_recovery('library', '{library}')}), ({_recovery('found', '{genotypes}')})"
)


@query("q4_10_recovery", _RECOVERY)
def recovery(genotypes, library):
    return qc.recovery(genotypes, library)


_SECTIONS = [f"{s}_{n}" for s in ("library", "found", "percent") for n in ("genes", "introns", "guides", "targeting", "controls")]
_TOTALS = ("peaks", "peaks_outside", "cells", "nuclei", "cells_with_reads", "assigned_cells")


@query(
    "q4_10_long_report",
    f"{_TILE_QC}, found AS ({_RECOVERY}) "
    + " UNION ALL ".join(f"SELECT '{n.split('_', 1)[0]}' AS section, '{n.split('_', 1)[1]}' AS name, {n}::DOUBLE AS value FROM found" for n in _SECTIONS)
    + "".join(f" UNION ALL SELECT 'total', '{n}', sum({n})::DOUBLE FROM tiles" for n in _TOTALS),
)
def long_report(reads, genotypes, pixels, library):
    return qc.long_report(genotypes, library, qc.tile_qc(reads, genotypes, pixels))


@query(
    "q4_11_read_quality",
    "SELECT read, round(list_min(q), 6) AS q_min, round(list_max(q), 6) AS q_max, round(list_avg(q), 6) AS q_mean, round(list_stddev_pop(q), 6) AS q_std FROM {reads}",
)
def read_quality(reads):
    return qc.read_quality(reads)


@query(
    "q4_12_histogram",
    """SELECT least(floor((peak - low) / ((high - low) / 20)), 19)::BIGINT AS bin, count(*) AS n
FROM {reads}, (SELECT min(peak) AS low, max(peak) AS high FROM {reads}) GROUP BY 1""",
)
def histogram(reads):
    return qc.histogram(reads, "peak", 20)


_SIZES = "SELECT size, count(*) AS groups FROM (SELECT {of} AS o, count(DISTINCT {what}) AS size FROM {{genotypes}} WHERE {targeting} GROUP BY 1) GROUP BY size"


@query("q4_13_guides_per_gene", _SIZES.format(of=_GENE, what="sgrna", targeting=_TARGETING))
def guides_per_gene(genotypes):
    return qc.per_group(genotypes, F.col("sgrna"), gene(F.col("sgrna")))


@query("q4_13_guides_per_intron", _SIZES.format(of=_INTRON, what="sgrna", targeting=_TARGETING))
def guides_per_intron(genotypes):
    return qc.per_group(genotypes, F.col("sgrna"), intron(F.col("sgrna")))


@query("q4_13_introns_per_gene", _SIZES.format(of=_GENE, what=_INTRON, targeting=_TARGETING))
def introns_per_gene(genotypes):
    return qc.per_group(genotypes, intron(F.col("sgrna")), gene(F.col("sgrna")))


@query("q4_14_items_per_tile", "SELECT well, tile, count(*) AS n FROM {reads} GROUP BY well, tile")
def items_per_tile(reads):
    return reads.groupBy("well", "tile").agg(F.count(F.lit(1)).alias("n"))


@query("q4_15_mapped_fraction", "SELECT well, tile, count(*) AS reads, avg(CASE WHEN barcode IN (SELECT sgrna_seq FROM {library}) THEN 1.0 ELSE 0.0 END) AS fraction FROM {reads} GROUP BY well, tile")
def mapped_fraction(reads, library):
    return qc.mapped_fraction(in_library(reads, library))


@query(
    "q4_16_mapping_by_threshold",
    """WITH r AS (SELECT peak, barcode IN (SELECT sgrna_seq FROM {library}) AS m FROM {reads}), s AS (SELECT unnest(range(min(ceil(peak / 10) - 1)::BIGINT, max(ceil(peak / 10))::BIGINT)) * 10.0::DOUBLE AS threshold FROM r)
SELECT threshold, count(*) AS spots, count(*) FILTER (m) AS mapped, count(*) FILTER (m) / count(*) AS rate FROM s JOIN r ON peak > threshold
WHERE threshold < (SELECT min(peak) FROM (SELECT peak, cume_dist() OVER (ORDER BY peak) AS share FROM r) WHERE share >= 0.99) GROUP BY threshold""",
)
def mapping_by_threshold(reads, library):
    return qc.mapping_by_threshold(in_library(reads, library))


@query(
    "q4_17_parameter_sweep",
    f"""WITH {CODED}
SELECT lim AS "limit", threshold, count(DISTINCT (well, tile, cell)) AS cells, count(DISTINCT sgrna) AS guides
FROM matched, (SELECT unnest([0, 1, 2, 3])::INT AS lim), (SELECT unnest([200.0, 500.0, 800.0])::DOUBLE AS threshold) WHERE mismatch <= lim AND peak > threshold GROUP BY ALL""",
)
def parameter_sweep(reads, library):
    return qc.parameter_sweep(ambiguity_matches(coded(reads), library), [0, 1, 2, 3], [200.0, 500.0, 800.0])


@query(
    "q5_1_rank_curve",
    """SELECT sgrna, cells, row_number() OVER (ORDER BY cells DESC, sgrna) AS rank, round(sum(cells) OVER (ORDER BY cells DESC, sgrna ROWS UNBOUNDED PRECEDING) / sum(cells) OVER (), 6) AS cumulative
FROM (SELECT sgrna, count(*) AS cells FROM {genotypes} GROUP BY sgrna)""",
)
def rank_curve(genotypes):
    return qc.rank_curve(genotypes)


@query(
    "q5_9_plate_grid",
    """WITH m AS (SELECT tile, count(*) AS n FROM {reads} WHERE well = 1 GROUP BY tile),
p AS (SELECT id // 3 AS grid_row, id % 3 AS grid_col, (id // 3) * 3 + CASE WHEN (id // 3) % 2 = 1 THEN 2 - id % 3 ELSE id % 3 END AS tile FROM (SELECT unnest(range(0, 9)) AS id))
SELECT tile, grid_row, grid_col, n FROM p LEFT JOIN m USING (tile)""",
)
def plate_grid(reads):
    per = reads.filter("well = 1").groupBy("tile").agg(F.count(F.lit(1)).alias("n"))
    return qc.plate_grid(per, "n", 3, 3)


@query(
    "q6_5_top_guides",
    """SELECT well, tile, sgrna, n, rank FROM (SELECT well, tile, sgrna, n, row_number() OVER (PARTITION BY well, tile ORDER BY n DESC, sgrna) AS rank FROM (SELECT well, tile, sgrna, count(*) AS n FROM {genotypes} GROUP BY well, tile, sgrna)) WHERE rank <= 3""",
)
def top_guides(genotypes):
    return qc.top_guides(genotypes, 3)


@query(
    "q3_14_in_situ_counts",
    """WITH c AS (SELECT sgrna, count(*) AS n FROM {genotypes2} GROUP BY sgrna), k AS (SELECT * FROM c WHERE sgrna IN (SELECT sgrna FROM {library}))
SELECT sgrna, n, round(100 * n / sum(n) OVER (), 6) AS percent, round(log10(n), 6) AS log10_n FROM k""",
)
def in_situ_counts(genotypes2, library):
    return qc.in_situ_counts(genotypes2.groupBy("sgrna").agg(F.count(F.lit(1)).alias("n")), library)
