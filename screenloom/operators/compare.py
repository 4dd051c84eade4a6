"""Comparing runs, assignments and benchmark results; set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.operators.barcodes import CELL
from screenloom.operators.qc import TILE
from screenloom.operators.quantiles import exact_quantiles


def mapped_cells(cells: DataFrame, calls: DataFrame) -> DataFrame:
    """Cells with whether any, and whether exactly one, call of theirs is mapped."""
    per = calls.groupBy(*CELL).agg(F.sum(F.col("mapped").cast("long")).alias("hits"))
    out = cells.select(*CELL).distinct().join(per, CELL, "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    return out.select(*CELL, (F.col("hits") > 0).alias("any_mapped"), (F.col("hits") == 1).alias("one_mapped"))


def matched_share(sbs: DataFrame, phenotype: DataFrame, target: str = "sbs") -> DataFrame:
    """Share of the target side's cells, by tile, that the other side has with a distance."""
    left, right = (sbs, phenotype) if target == "sbs" else (phenotype, sbs)
    flag = right.filter(F.col("distance").isNotNull()).select(*CELL).distinct().withColumn("hit", F.lit(1.0))
    return left.join(flag, CELL, "left").groupBy(*TILE).agg(F.count(F.lit(1)).alias("cells"), F.avg(F.coalesce("hit", F.lit(0.0))).alias("fraction"))


def compare_assignments(one: DataFrame, two: DataFrame) -> DataFrame:
    """Every cell of either run with both guides ('None' where absent), in how many runs it was found, and whether they agree."""
    both = one.select(*CELL, F.col("sgrna").alias("a")).join(two.select(*CELL, F.col("sgrna").alias("b")), CELL, "full_outer")
    found = (F.col("a").isNotNull().cast("long") + F.col("b").isNotNull().cast("long")).alias("found")
    return both.select(*CELL, F.coalesce("a", F.lit("None")).alias("a"), F.coalesce("b", F.lit("None")).alias("b"), found, F.coalesce(F.col("a") == F.col("b"), F.lit(False)).alias("match"))


def agreement(compared: DataFrame) -> DataFrame:
    """Cells found in both runs and the percent of them that agree."""
    twice = F.col("found") == 2
    return compared.agg(
        F.count(F.lit(1)).alias("cells"),
        F.sum(twice.cast("long")).alias("in_both"),
        F.round(100 * F.sum((twice & F.col("match")).cast("long")) / F.sum(twice.cast("long")), 4).alias("percent"),
    )


def run_difference(one: DataFrame, two: DataFrame, numeric: list[str], tolerance: float = 0.05, tiny: float = 1e-10) -> DataFrame:
    """One row: row counts, cells missing from and extra in the second run, percent of other guides, and for each numeric column
    the mean absolute and mean relative difference and whether that is within ``tolerance`` (null for a column of zeros)."""
    both = one.alias("p").join(two.alias("q"), CELL)
    pairs = [(F.col(f"p.{c}").cast("double"), F.col(f"q.{c}").cast("double"), c) for c in numeric]
    columns: list[Column] = [F.count(F.lit(1)).alias("common"), F.round(100 * F.avg((F.col("p.sgrna") != F.col("q.sgrna")).cast("double")), 4).alias("percent_other_guide")]
    for a, b, c in pairs:
        nonzero = F.max(F.abs(a)) > 0
        relative = F.when(nonzero, F.avg(F.abs(a - b) / (F.abs(a) + tiny)))
        columns += [F.round(F.avg(F.abs(a - b)), 6).alias(f"{c}_absolute"), F.round(relative, 6).alias(f"{c}_relative"), (relative <= tolerance).alias(f"{c}_within")]
    missing = one.join(two, CELL, "left_anti").agg(F.count(F.lit(1)).alias("missing")).withColumn("k", F.lit(1))
    extra = two.join(one, CELL, "left_anti").agg(F.count(F.lit(1)).alias("extra")).withColumn("k", F.lit(1))
    return both.agg(*columns).withColumn("k", F.lit(1)).join(missing, "k").join(extra, "k").drop("k")


def segmentation_difference(one: DataFrame, two: DataFrame, counts: float = 0.01, areas: float = 0.2) -> DataFrame:
    """Objects and mean area of each tile in two segmentations, and whether they agree within the tolerances."""

    def per(df: DataFrame, s: str) -> DataFrame:
        area = df.filter("cell > 0").groupBy(*CELL).agg(F.count(F.lit(1)).alias("area"))
        return area.groupBy(*TILE).agg(F.count(F.lit(1)).alias(f"n_{s}"), F.avg("area").alias(f"area_{s}"))

    out = per(one, "a").join(per(two, "b"), TILE, "full_outer").na.fill(0)
    close = lambda a, b, t: F.abs(F.col(a) - F.col(b)) <= t * F.col(a)
    return out.select(*TILE, "n_a", "n_b", F.round("area_a", 4).alias("area_a"), F.round("area_b", 4).alias("area_b"), close("n_a", "n_b", counts).alias("counts_agree"), close("area_a", "area_b", areas).alias("areas_agree"))


def missing_and_extra(one: DataFrame, two: DataFrame) -> DataFrame:
    """Rows only in the first table (missing) and only in the second (extra), as often as they differ."""
    return one.exceptAll(two).withColumn("side", F.lit("missing")).unionByName(two.exceptAll(one).withColumn("side", F.lit("extra")))


def all_cells(one: DataFrame, two: DataFrame) -> DataFrame:
    return one.select(*CELL).union(two.select(*CELL)).distinct()


METRICS = ["rmsd", "time_ms", "memory_kb", "iterations"]


def benchmark_summary(trials: DataFrame) -> DataFrame:
    """Mean and sample deviation of the metrics by optimizer × points × noise × outliers, by optimizer × well, and by optimizer."""
    stats = ", ".join(f"round(avg({m}), 4) AS {m}_mean, round(stddev_samp({m}), 4) AS {m}_std" for m in METRICS)
    keys = "optimization, num_points, noise_level, outlier_fraction, well"
    sets = "(optimization, num_points, noise_level, outlier_fraction), (optimization, well), (optimization)"
    return trials.sparkSession.sql(f"SELECT {keys}, count(*) AS trials, {stats} FROM {{t}} GROUP BY GROUPING SETS ({sets})", t=trials)


def optimizer_ratios(trials: DataFrame, names: list[str], base: str) -> DataFrame:
    """Mean error and time of each optimizer as a column, by number of points, and their ratios to ``base``."""
    wide = trials.groupBy("num_points").pivot("optimization", names).agg(F.avg("rmsd").alias("rmsd"), F.avg("time_ms").alias("time"))
    ratio = lambda n, m: F.round(F.col(f"{n}_{m}") / F.col(f"{base}_{m}"), 6).alias(f"{n}_{m}_ratio")
    return wide.select("num_points", *[F.round(f"{n}_{m}", 4).alias(f"{n}_{m}") for n in names for m in ("rmsd", "time")], *[ratio(n, m) for n in names if n != base for m in ("rmsd", "time")])


def heat_table(trials: DataFrame, columns: list[float]) -> DataFrame:
    """Mean error by noise (rows) and outlier fraction (columns)."""
    wide = trials.groupBy("noise_level").pivot("outlier_fraction", columns).agg(F.round(F.avg("rmsd"), 4))
    return wide.select("noise_level", *[F.col(f"`{c}`").alias(f"outliers_{round(c * 100)}") for c in columns])


def success_rates(trials: DataFrame) -> DataFrame:
    """For each optimizer the share of trials with an error up to each overall quartile, and its coefficient of variation."""
    quartiles = exact_quantiles(trials, [], "rmsd", [0.25, 0.5, 0.75]).select(F.col("quantiles").alias("q"), F.lit(1).alias("k"))
    both = trials.withColumn("k", F.lit(1)).join(F.broadcast(quartiles), "k")  # one row
    shares = [F.round(F.avg((F.col("rmsd") <= F.col("q")[i]).cast("double")), 6).alias(f"success_q{i + 1}") for i in range(3)]
    return both.groupBy("optimization").agg(*shares, F.round(F.stddev_samp("rmsd") / F.avg("rmsd"), 6).alias("variation"))


def speedups(runs: DataFrame) -> DataFrame:
    """For each number of workers: seconds, images per second, speedup over one worker, and whether it is the best."""
    per = runs.groupBy("workers").agg(F.sum("seconds").alias("seconds"), F.count(F.lit(1)).alias("images"))
    base = per.filter("workers = 1").select(F.col("seconds").alias("base"), F.lit(1).alias("k"))
    best = per.agg(F.max_by("workers", F.struct(F.col("images") / F.col("seconds"), -F.col("workers"))).alias("best")).withColumn("k", F.lit(1))
    out = per.withColumn("k", F.lit(1)).join(base, "k").join(best, "k")
    return out.select("workers", F.round("seconds", 4).alias("seconds"), F.round(F.col("images") / F.col("seconds"), 6).alias("rate"), F.round(F.col("base") / F.col("seconds"), 6).alias("speedup"), (F.col("workers") == F.col("best")).alias("best"))


def status_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("well").agg(F.count(F.lit(1)).alias("files"), F.sum((F.col("status") == "success").cast("long")).alias("successful"), F.sum((F.col("status") == "error").cast("long")).alias("failed"))


def size_statistics(sizes: DataFrame, by: str, value: str) -> DataFrame:
    v = F.col(value)
    return sizes.groupBy(by).agg(F.count(v).alias("n"), F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_samp(v), 6).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
