"""Quality reports by cell, tile, well and plate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from screenloom.functions.bases import gene, intron, quality_stats, targeting
from screenloom.operators.barcodes import CELL, cell_barcodes, report_of_barcodes
from screenloom.operators.iterate import saved

TILE = ["well", "tile"]


def counts_of_counts(reads: DataFrame) -> DataFrame:
    """For each k: cells with k reads, and cells with k distinct barcodes."""
    per = reads.filter("cell > 0").groupBy(*CELL).agg(F.count(F.lit(1)).alias("reads"), F.countDistinct("barcode").alias("barcodes"))
    long = per.select(F.explode(F.array(F.struct(F.lit("reads").alias("what"), F.col("reads").alias("k")), F.struct(F.lit("barcodes").alias("what"), F.col("barcodes").alias("k")))).alias("x"))
    return long.groupBy(F.col("x.what").alias("what"), F.col("x.k").alias("k")).agg(F.count(F.lit(1)).alias("cells"))


def top_and_others(counted: DataFrame, name: str, number: int) -> DataFrame:
    """The ``number - 1`` most frequent values of ``name`` by ``n``, and Others for all further ranks.

    The ranking is one window over the table, which has a row per value (guide), not per cell.
    """
    order = W.orderBy(F.desc("n"), name)
    ranked = counted.withColumn("rn", F.row_number().over(order))
    label = F.when(F.col("rn") < number, F.col(name)).otherwise("Others")
    return ranked.groupBy(label.alias(name)).agg(F.sum("n").alias("n"))


def tile_and_well_summary(cells: DataFrame, failures: DataFrame) -> DataFrame:
    """Cells, reads, guides and tiles by tile, by well and in all (nulls in the keys); ``failures`` has one row per failed tile."""
    failed = failures.groupBy(*TILE).agg(F.count(F.lit(1)).alias("failures"))
    per_tile = cells.groupBy(*TILE).agg(F.count(F.lit(1)).alias("cells"), F.sum("reads").alias("reads"))
    totals = per_tile.join(failed, TILE, "left").rollup(*TILE).agg(
        F.grouping_id().alias("level"),
        F.sum("cells").alias("cells"),
        F.sum("reads").alias("reads"),
        F.count(F.lit(1)).alias("tiles"),
        F.coalesce(F.sum("failures"), F.lit(0)).alias("failures"),
    )
    guides = cells.select(*TILE, "sgrna").distinct().rollup(*TILE).agg(F.grouping_id().alias("level"), F.countDistinct("sgrna").alias("unique_guides"))
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"g.{c}")) for c in (*TILE, "level")]
    return totals.alias("t").join(guides.alias("g"), same).select("t.well", "t.tile", "cells", "reads", "unique_guides", "tiles", "failures")


def tile_qc(reads: DataFrame, genotypes: DataFrame, mask: DataFrame, cycles: int = 12, top: int = 3) -> DataFrame:
    """One row per tile: reads, reads outside cells, cells and nuclei in the mask, cells with reads, guides, letters, mean quality per cycle, the ``top`` guides."""
    letters = {f"n_{b.lower()}": F.sum(F.length(F.regexp_replace("barcode", f"[^{b}]", ""))).cast("long") for b in "ACGTKMN"}
    quality = {f"q_{k + 1}": F.round(F.avg(F.col("q")[k]), 3) for k in range(cycles)}
    own = reads.groupBy(*TILE).agg(
        F.count(F.lit(1)).alias("peaks"),
        F.sum((F.col("cell") == 0).cast("long")).alias("peaks_outside"),
        F.countDistinct(F.when(F.col("cell") > 0, F.col("cell"))).alias("cells_with_reads"),
        *[c.alias(n) for n, c in {**letters, **quality}.items()],
    )
    return _with_mask_and_guides(own, genotypes, mask, top)


def _with_mask_and_guides(own: DataFrame, genotypes: DataFrame, mask: DataFrame, top: int) -> DataFrame:
    """Rows of tiles with cells and nuclei in the mask, and with the number of guides, of cells with a guide and the ``top`` guides."""
    seen = mask.groupBy(*TILE).agg(F.countDistinct(F.when(F.col("cell") > 0, F.col("cell"))).alias("cells"), F.countDistinct(F.when(F.col("nucleus") > 0, F.col("nucleus"))).alias("nuclei"))
    guides = genotypes.groupBy(*TILE).agg(F.countDistinct("sgrna").alias("unique_guides"), F.count(F.lit(1)).alias("assigned_cells"))
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    named = [f for k in range(1, top + 1) for f in (at(k, "sgrna").alias(f"top_{k}"), at(k, "n").alias(f"top_{k}_n"))]
    first = top_guides(genotypes, top).groupBy(*TILE).agg(*named)
    return own.join(seen, TILE, "left").join(guides, TILE, "left").join(first, TILE, "left")


def tile_qc_in_full(
    reads: DataFrame, genotypes: DataFrame, mask: DataFrame, cleaned: DataFrame, library: DataFrame, code: Column, cycles: int = 12, top: int = 5, most: int = 3
) -> DataFrame:
    """The whole quality row of each tile that has reads.

    Besides :func:`tile_qc`: nuclei and cells before (``mask``) and after cleaning (``cleaned``, pixels or labels), letters in all; the
    cells for which a match of their barcodes under ``code`` was tried, those matched, those with reads without a match and those with reads too
    uncertain; and the cells with 1 to ``top`` - 1 reads, and with ``top`` or more; the same of their distinct barcodes. What a tile lacks counts 0, guides it lacks are null.

    Reads are read once and brought down to the barcodes of each cell with the sums of their qualities, which are written.
    """
    quality = {f"{of}_{k + 1}": f(F.col("q")[k]) for of, f in (("q", F.sum), ("held", F.count)) for k in range(cycles)}
    made = {"raw": F.col("barcode"), "barcode": F.when(F.col("cell") > 0, code)}
    # a barcode that is read as several codes counts where it comes first
    new = F.row_number().over(W.partitionBy(*CELL, "raw").orderBy("barcode", "sharer")) == 1
    barcodes = cell_barcodes(reads.select(*CELL, "read", "barcode", "q"), made, ["raw"], quality)
    barcodes = saved(barcodes.withColumn("new", new & F.col("raw").isNotNull()), "cells", compression="zstd")
    letters = {f"n_{b.lower()}": F.sum(F.length(F.regexp_replace("raw", f"[^{b}]", "")) * F.col("rows")) for b in "ACGTKMN"}
    cells = barcodes.groupBy(*CELL).agg(
        F.sum("rows").alias("reads"), F.count_if("new").alias("barcodes"), *[c.alias(n) for n, c in letters.items()], *[F.sum(c).alias(c) for c in quality]
    )
    inside = F.col("cell") > 0
    number = lambda c, k: F.count_if(inside & (F.col(c) == k if k < top else F.col(c) >= k)).alias(f"cells_with_{k}_{c}")
    own = cells.groupBy(*TILE).agg(
        F.sum("reads").alias("peaks"),
        F.sum(F.when(F.col("cell") == 0, F.col("reads")).otherwise(0)).alias("peaks_outside"),
        F.count_if(inside).alias("cells_with_reads"),
        *[F.sum(c).alias(c) for c in letters],
        *[F.round(F.sum(f"q_{k}") / F.sum(f"held_{k}"), 3).alias(f"q_{k}") for k in range(1, cycles + 1)],
        *[number(c, k) for c in ("reads", "barcodes") for k in range(1, top + 1)],
    )
    before = _with_mask_and_guides(own, genotypes, mask, top).withColumnsRenamed({"cells": "cells_before", "nuclei": "nuclei_before"})
    after = cleaned.groupBy(*TILE).agg(
        F.countDistinct(F.when(F.col("cell") > 0, F.col("cell"))).alias("cells"), F.countDistinct(F.when(F.col("nucleus") > 0, F.col("nucleus"))).alias("nuclei")
    )
    tried = report_of_barcodes(barcodes.filter(inside), library, most, cycles).groupBy(*TILE).agg(
        F.count(F.lit(1)).alias("cells_tried"), F.count_if("assigned").alias("cells_matched"), F.count_if(F.col("unmatched") > 0).alias("cells_unmatched"), F.count_if(F.col("too_uncertain") > 0).alias("cells_uncertain")
    )
    nucleotides = F.lit(0).cast("long")
    for b in letters:
        nucleotides += F.col(b)
    out = before.withColumn("nucleotides", nucleotides).join(after, TILE, "left").join(tried, TILE, "left")
    counts = [c for c, kind in out.dtypes if kind == "bigint" and c not in TILE]
    return out.na.fill(0, counts)


def long_report(genotypes: DataFrame, library: DataFrame, tiles: DataFrame) -> DataFrame:
    """The report as section, name, value: what the library holds, what was found, percents, and totals over the rows of ``tile_qc``."""
    found = recovery(genotypes, library)
    totals = tiles.agg(*[F.sum(c).alias(f"total_{c}") for c in ("peaks", "peaks_outside", "cells", "nuclei", "cells_with_reads", "assigned_cells")])
    parts = []
    for row in (found, totals):
        pairs = [F.struct(F.lit(n.split("_", 1)[0]).alias("section"), F.lit(n.split("_", 1)[1]).alias("name"), F.col(n).cast("double").alias("value")) for n in row.columns]
        parts.append(row.select(F.inline(F.array(*pairs))))
    return parts[0].unionByName(parts[1])


def top_guides(genotypes: DataFrame, number: int = 3) -> DataFrame:
    """The most frequent guides of each tile, ties by name."""
    counted = genotypes.groupBy(*TILE, "sgrna").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy(*TILE).orderBy(F.desc("n"), "sgrna")
    return counted.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= number)


def recovery(genotypes: DataFrame, library: DataFrame) -> DataFrame:
    """One row: genes, introns and guides in the library and among the cells, with percents; targeting and control guides apart."""

    def parts(df: DataFrame, prefix: str) -> DataFrame:
        s = F.col("sgrna")
        return df.agg(
            F.countDistinct(F.when(targeting(s), gene(s))).alias(f"{prefix}_genes"),
            F.countDistinct(F.when(targeting(s), intron(s))).alias(f"{prefix}_introns"),
            F.countDistinct(s).alias(f"{prefix}_guides"),
            F.countDistinct(F.when(targeting(s), s)).alias(f"{prefix}_targeting"),
            F.countDistinct(F.when(~targeting(s), s)).alias(f"{prefix}_controls"),
        ).withColumn("one", F.lit(1))

    out = parts(library, "library").join(parts(genotypes, "found"), "one").drop("one")
    percent = lambda n: F.round(100 * F.col(f"found_{n}") / F.col(f"library_{n}"), 1).alias(f"percent_{n}")
    return out.select("*", *[percent(n) for n in ("genes", "introns", "guides", "targeting", "controls")])


def read_quality(reads: DataFrame) -> DataFrame:
    """Smallest, largest and mean quality and its population deviation, for each read."""
    return reads.select("read", *[F.round(c, 6).alias(n) for n, c in quality_stats(F.col("q")).items()])


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal bins from smallest to largest value; the last bin is closed on both sides."""
    ends = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    low, high = ends.first() or (None, None)
    if low is None:
        return df.select(F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (high - low) / bins or 1.0
    bin_ = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("long")
    return df.filter(F.col(value).isNotNull()).groupBy(bin_.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def per_group(genotypes: DataFrame, what: Column, of: Column) -> DataFrame:
    """Distinct ``what`` for each ``of``, as a histogram: size, groups."""
    sizes = genotypes.filter(targeting(F.col("sgrna"))).groupBy(of.alias("of")).agg(F.countDistinct(what).alias("size"))
    return sizes.groupBy("size").agg(F.count(F.lit(1)).alias("groups"))


def mapped_fraction(reads: DataFrame, drop_zero: bool = False) -> DataFrame:
    """Share of mapped reads in each tile; tiles without one stay unless ``drop_zero``."""
    out = reads.groupBy(*TILE).agg(F.count(F.lit(1)).alias("reads"), F.avg(F.col("mapped").cast("double")).alias("fraction"))
    return out.filter("fraction > 0") if drop_zero else out


def threshold_step(reads: DataFrame) -> float:
    """0.001 for peaks that stay under 100, else 10."""
    top = reads.agg(F.max("peak")).first()[0]
    return 0.001 if top is not None and top < 100 else 10.0


def mapping_by_threshold(reads: DataFrame, step: float | None = None) -> DataFrame:
    """For each threshold (multiples of ``step``) under the 99th percentile: reads whose peak is above it, those mapped, and their rate.

    Without ``step`` it follows from the largest peak. Every multiple from the smallest to the largest peak is listed,
    also where no peak lies between two. Reads are counted once per step; a running sum in one window over
    the steps does the rest. A threshold lies under the percentile as long as more than one
    read of a hundred is above it.
    """
    step = step or threshold_step(reads)
    # a peak is above step * s for every s under peak / step
    counted = reads.groupBy((F.ceil(F.col("peak") / step) - 1).cast("long").alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("mapped").cast("long")).alias("m"))
    above = W.orderBy(F.desc("s"))
    out = counted.select("s", F.sum("n").over(above).alias("spots"), F.sum("m").over(above).alias("mapped"), F.sum("n").over(W.partitionBy()).alias("all"), F.lead("s").over(above).alias("lower"))
    # steps without a peak have the reads of the next step above them
    out = out.withColumn("s", F.explode(F.sequence(F.coalesce(F.col("lower") + 1, F.col("s")), F.col("s"))))
    out = out.filter(F.col("spots") * 100 > F.col("all"))
    return out.select((F.col("s") * step).alias("threshold"), "spots", "mapped", (F.col("mapped") / F.col("spots")).alias("rate"))


def parameter_sweep(matched: DataFrame, limits: list[int], thresholds: list[float]) -> DataFrame:
    """Cells and guides that remain for each limit of mismatches and each threshold of peak."""
    passes = F.explode(F.array(*[F.lit(n) for n in limits])).alias("limit")
    each = F.explode(F.array(*[F.lit(t) for t in thresholds])).alias("threshold")

    def remaining(names: list[str], called: str) -> DataFrame:
        # what has a row that passes has one with the highest peak of its mismatches
        tops = matched.dropna(subset=names).groupBy(*names, "mismatch").agg(F.max("peak").alias("peak"))
        tops = tops.select(*names, "mismatch", "peak", passes).filter("mismatch <= limit").groupBy(*names, "limit").agg(F.max("peak").alias("peak"))
        return tops.select("limit", "peak", each).filter("peak > threshold").groupBy("limit", "threshold").agg(F.count(F.lit(1)).alias(called))

    both = remaining(CELL, "cells").join(remaining(["sgrna"], "guides"), ["limit", "threshold"], "full")
    return both.na.fill(0, ["cells", "guides"])


def rank_curve(genotypes: DataFrame) -> DataFrame:
    """Guides by number of cells with the cumulative share. The ranking is one window over a row per guide."""
    counted = genotypes.groupBy("sgrna").agg(F.count(F.lit(1)).alias("cells"))
    order = W.orderBy(F.desc("cells"), "sgrna")
    total = F.sum("cells").over(W.partitionBy())
    return counted.select(
        "sgrna", "cells", F.row_number().over(order).cast("long").alias("rank"), F.round(F.sum("cells").over(order.rowsBetween(W.unboundedPreceding, 0)) / total, 6).alias("cumulative")
    )


def plate_grid(metric: DataFrame, value: str, rows: int, columns: int, snake: bool = True) -> DataFrame:
    """Every place of a plate with the metric of its tile; with ``snake`` odd rows run backwards. Places without a tile have null."""
    places = metric.sparkSession.range(rows * columns).select(
        F.floor(F.col("id") / columns).alias("grid_row"), (F.col("id") % columns).alias("grid_col")
    )
    along = F.when((F.col("grid_row") % 2 == 1) & F.lit(snake), columns - 1 - F.col("grid_col")).otherwise(F.col("grid_col"))
    places = places.withColumn("tile", F.col("grid_row") * columns + along)
    return places.join(metric.select("tile", F.col(value)), "tile", "left")


def in_situ_counts(counts: DataFrame, library: DataFrame) -> DataFrame:
    """Cells per library guide with their percent and log10; the total is one window over a row per guide."""
    known = counts.join(library.select("sgrna").distinct(), "sgrna", "left_semi")
    return known.select("sgrna", "n", F.round(100 * F.col("n") / F.sum("n").over(W.partitionBy()), 6).alias("percent"), F.round(F.log10("n"), 6).alias("log10_n"))
