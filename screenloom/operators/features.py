"""Cells from masks and pixels: lookups, clean masks, shapes, intensities, colocalization, texture.

``pixels`` have well, tile, i (down), j (right), cell, nucleus; ``values`` have channel and value besides.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from screenloom.operators.barcodes import CELL
from screenloom.operators.iterate import spread_out

TILE = ["well", "tile"]


def label_at(points: DataFrame, mask: DataFrame) -> DataFrame:
    """Points (well, tile, i, j) with the cell under them; points on no cell are left out."""
    return points.drop("cell").join(mask.filter("cell > 0").select(*TILE, "i", "j", "cell"), [*TILE, "i", "j"])


def shapes(mask: DataFrame, label: str = "cell") -> DataFrame:
    """Area, box, centroid, extent, equivalent diameter, axes, eccentricity and orientation of each label, from sums of coordinates."""
    i, j = F.col("i").cast("double"), F.col("j").cast("double")
    sums = mask.filter(F.col(label) > 0).groupBy(*TILE, label).agg(
        F.count(F.lit(1)).alias("area"),
        F.min("i").alias("i_min"), F.max("i").alias("i_max"), F.min("j").alias("j_min"), F.max("j").alias("j_max"),
        F.avg(i).alias("y"), F.avg(j).alias("x"), F.var_pop(i).alias("vi"), F.var_pop(j).alias("vj"), F.covar_pop(i, j).alias("vij"),
    )
    # a pixel is a unit square, which adds 1/12 to either variance
    a, b, c = F.col("vi") + 1 / 12, F.col("vj") + 1 / 12, F.col("vij")
    root = F.sqrt((a - b) * (a - b) / 4 + c * c)
    out = sums.withColumns({"l1": (a + b) / 2 + root, "l2": F.greatest((a + b) / 2 - root, F.lit(0.0))})
    box = (F.col("i_max") - F.col("i_min") + 1) * (F.col("j_max") - F.col("j_min") + 1)
    return out.select(
        *TILE, label, "area", "i_min", "i_max", "j_min", "j_max", "y", "x",
        (F.col("area") / box).alias("extent"),
        F.sqrt(4 * F.col("area") / math.pi).alias("equivalent_diameter"),
        (4 * F.sqrt("l1")).alias("major_axis"), (4 * F.sqrt("l2")).alias("minor_axis"),
        F.sqrt(1 - F.col("l2") / F.col("l1")).alias("eccentricity"),
        (0.5 * F.atan2(2 * c, a - b)).alias("orientation"),
    )


def nuclei_in_cells(mask: DataFrame) -> DataFrame:
    """Each nucleus with the cell under its truncated centroid; nuclei over background are left out."""
    centre = mask.filter("nucleus > 0").groupBy(*TILE, "nucleus").agg(F.avg("i").alias("y"), F.avg("j").alias("x"))
    at = centre.withColumns({"i": F.floor("y"), "j": F.floor("x")})
    return label_at(at, mask).select(*TILE, "nucleus", "cell", "y", "x")


def single_nucleus_cells(nuclei: DataFrame) -> DataFrame:
    return nuclei.withColumn("n", F.count(F.lit(1)).over(W.partitionBy(*CELL))).filter("n = 1").drop("n")


def relabelled(cells: DataFrame, label: str = "cell") -> DataFrame:
    """Consecutive labels in each tile, in the order of the old ones."""
    return cells.withColumn("new_label", F.dense_rank().over(W.partitionBy(*TILE).orderBy(label)).cast("long"))


def _clean(of: list[str], rows: DataFrame, mask: DataFrame, height: int, width: int, border: int) -> DataFrame:
    """``rows`` of cells of ``mask`` that stay, with columns ``of`` and their new labels."""
    box = mask.filter("cell > 0").groupBy(*CELL).agg(*[f(c).alias(f"{c}_{n}") for c in "ij" for n, f in (("min", F.min), ("max", F.max))])
    inside = box.filter((F.col("i_min") >= border) & (F.col("j_min") >= border) & (F.col("i_max") < height - border) & (F.col("j_max") < width - border))
    kept = single_nucleus_cells(nuclei_in_cells(mask)).join(inside.select(*CELL), CELL)
    kept = relabelled(kept.select(*CELL, F.col("nucleus").alias("own")))
    return rows.join(kept, CELL).select(*of, F.col("new_label").alias("cell"), F.when(F.col("nucleus") == F.col("own"), F.col("new_label")).otherwise(0).alias("nucleus"))


def clean_mask(mask: DataFrame, height: int, width: int, border: int = 3) -> DataFrame:
    """The mask with only cells that have one nucleus and keep ``border`` pixels from the edge; nucleus label = new cell label.

    Touching cells stay apart.
    """
    return _clean([*TILE, "i", "j"], mask.filter("cell > 0"), mask, height, width, border)


def clean_labels(mask: DataFrame, height: int, width: int, border: int = 3) -> DataFrame:
    """The labels of :func:`clean_mask` without its pixels: each cell with the nucleus labels in it."""
    return _clean(TILE, mask.filter("cell > 0").select(*CELL, "nucleus").distinct(), mask, height, width, border)


def region_intensities(values: DataFrame, where: Column, prefix: str = "", nonzero: bool = False) -> DataFrame:
    """Mean, sum, largest, smallest and population deviation by cell and channel over the pixels ``where``; with ``nonzero`` zeros don't count and empty regions give 0."""
    v = F.when(where & ((F.col("value") > 0) if nonzero else F.lit(True)), F.col("value"))
    stats = {"mean": F.avg(v), "total": F.sum(v), "max": F.max(v), "min": F.min(v), "std": F.stddev_pop(v)}
    # background would be one giant group
    return values.filter("cell > 0").groupBy(*CELL, "channel").agg(*[F.round(F.coalesce(c, F.lit(0)) if nonzero else c, 6).cast("double").alias(f"{prefix}{n}") for n, c in stats.items()])


def wide_intensities(values: DataFrame, channels: list[int]) -> DataFrame:
    """One row per cell: mean, max, std and total of the cell and mean and max of its nucleus, for each channel."""
    cell = region_intensities(values, F.lit(True), "cell_")
    nucleus = region_intensities(values, F.col("nucleus") > 0, "nucleus_")
    both = cell.join(nucleus, [*CELL, "channel"])
    names = ["cell_mean", "cell_max", "cell_std", "cell_total", "nucleus_mean", "nucleus_max"]
    return both.groupBy(*CELL).agg(*[F.max(F.when(F.col("channel") == c, F.col(n))).alias(f"ch{c}_{n}") for c in channels for n in names])


def colocalization(pixels: DataFrame, a: str, b: str, where: Column, more_than: int = 5) -> DataFrame:
    """Squared correlation of two channels over pixels where both are positive; 0 for ``more_than`` pixels or fewer, or without variation."""
    both = where & (F.col(a) > 0) & (F.col(b) > 0)
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    sums = pixels.filter("cell > 0").groupBy(*CELL).agg(F.count(x).alias("n"), F.covar_pop(x, y).alias("c"), F.var_pop(x).alias("vx"), F.var_pop(y).alias("vy"))
    usable = (F.col("n") > more_than) & (F.col("vx") > 0) & (F.col("vy") > 0)
    return sums.select(*CELL, F.round(F.when(usable, F.col("c") * F.col("c") / (F.col("vx") * F.col("vy"))).otherwise(0.0), 6).alias("r2"))


def with_genotype(phenotypes: DataFrame, genotypes: DataFrame) -> DataFrame:
    """Phenotypes with the first genotype of their cell (most reads, then name)."""
    first = genotypes.groupBy(*CELL).agg(F.min(F.struct((-F.col("reads")).alias("k"), "sgrna")).alias("g")).select(*CELL, F.col("g.sgrna").alias("sgrna"))
    return phenotypes.drop("sgrna").join(first, CELL, "left")


def cell_features(pixels: DataFrame, values: DataFrame, genotypes: DataFrame, channels: list[int]) -> DataFrame:
    """All features of a cell in one row."""
    nuclear = shapes(pixels, "nucleus").select(*TILE, F.col("nucleus").alias("cell"), F.col("area").alias("nucleus_area"))
    out = shapes(pixels).join(nuclear, CELL, "left").withColumn("nucleus_area", F.coalesce("nucleus_area", F.lit(0)))
    out = out.withColumn("nucleus_ratio", F.when(F.col("area") == 0, 0.0).otherwise(F.col("nucleus_area") / F.col("area")))
    out = out.join(wide_intensities(values, channels), CELL, "left").join(colocalization(pixels, "ch0", "ch1", F.lit(True)), CELL, "left")
    return with_genotype(out, genotypes)


def crop_sized(cells: DataFrame, most: int, least_area: int, most_area: int) -> DataFrame:
    """Cells whose box is under ``most`` on both sides and whose area is within bounds."""
    return cells.filter((F.col("i_max") - F.col("i_min") + 1 < most) & (F.col("j_max") - F.col("j_min") + 1 < most) & F.col("area").between(least_area, most_area))


def _neighbourhood(values: DataFrame, width: int) -> DataFrame:
    """``values`` with the largest and least value within ``width`` rows and columns, over the pixels that exist.

    Values are spread along columns and then along rows, each followed by a grouped aggregate, so
    missing pixels need no grid. Tiles are brought together once; all after that is within tasks.
    """
    half = width // 2
    key = [*TILE, "channel", "i", "j"]
    values = spread_out(values, *TILE)

    def spread(df: DataFrame, axis: str) -> DataFrame:
        reach = F.explode(F.sequence(F.col(axis) - half, F.col(axis) + half)).alias(axis)
        moved = df.select(*[c for c in key if c != axis], "largest", "least", reach)
        return moved.groupBy(*key).agg(F.max("largest").alias("largest"), F.min("least").alias("least"))

    around = spread(spread(values.select(*key, F.col("value").alias("largest"), F.col("value").alias("least")), "j"), "i")
    return values.join(around, key)


def neighbourhood_max(values: DataFrame, width: int = 3) -> DataFrame:
    """Maximum filter: ``values`` with the largest value around each pixel."""
    return _neighbourhood(values, width).drop("least")


def local_maxima(values: DataFrame, width: int = 5, threshold: float = 0) -> DataFrame:
    """Pixels that are the largest of their neighbourhood and above its smallest by more than ``threshold``: the spot score is that difference."""
    score = F.col("largest") - F.col("least")
    out = _neighbourhood(values, width).filter((F.col("value") == F.col("largest")) & (score > threshold))
    return out.select(*TILE, "channel", "i", "j", "value", score.alias("score"))


def cycle_variation(stack: DataFrame) -> DataFrame:
    """Mean over channels of the population deviation over cycles, at each pixel of (well, tile, cycle, channel, i, j, value)."""
    per = stack.groupBy(*TILE, "i", "j", "channel").agg(F.stddev_pop("value").alias("s"))
    return per.groupBy(*TILE, "i", "j").agg(F.round(F.avg("s"), 6).alias("variation"))


# What a border pixel adds to the perimeter, by the code of its 3 x 3 surroundings (1 for
# itself, 2 for each border pixel beside it, 10 for each over a corner). Other codes add nothing.
PERIMETER = {5: 1.0, 7: 1.0, 15: 1.0, 17: 1.0, 25: 1.0, 27: 1.0, 21: math.sqrt(2), 33: math.sqrt(2), 13: (1 + math.sqrt(2)) / 2, 23: (1 + math.sqrt(2)) / 2}


def perimeters(mask: DataFrame, label: str = "cell") -> DataFrame:
    """Perimeter of each label: its border pixels (those without all four neighbours), weighted by the border pixels around them.

    Pixels are spread to their neighbours and counted by place. Tiles are brought together once; all counts after that
    are within tasks, and no region is gathered.
    """
    key = [*TILE, label]
    pixels = spread_out(mask.filter(F.col(label) > 0).select(*key, "i", "j"), *key).distinct()

    def around(df: DataFrame, weights: dict[tuple[int, int], int]) -> DataFrame:
        """For each place near a pixel the sum of what the pixels around add to it, and whether a pixel is there."""
        moves = F.explode(F.array(*[F.struct(F.lit(di).alias("di"), F.lit(dj).alias("dj"), F.lit(w).alias("w")) for (di, dj), w in weights.items()])).alias("m")
        sent = df.select(*key, "i", "j", moves).select(*key, (F.col("i") + F.col("m.di")).alias("i"), (F.col("j") + F.col("m.dj")).alias("j"), "m.w", ((F.col("m.di") == 0) & (F.col("m.dj") == 0)).alias("own"))
        return sent.groupBy(*key, "i", "j").agg(F.sum("w").alias("code"), F.max("own").alias("own")).filter("own")

    straight, corner = [(0, 1), (0, -1), (1, 0), (-1, 0)], [(1, 1), (1, -1), (-1, 1), (-1, -1)]
    border = around(pixels, {(0, 0): 0} | dict.fromkeys(straight, 1)).filter("code < 4")
    coded = around(border, {(0, 0): 1} | dict.fromkeys(straight, 2) | dict.fromkeys(corner, 10))
    weight = F.lit(0.0)
    for value in sorted(set(PERIMETER.values())):
        weight = F.when(F.col("code").isin([c for c, v in PERIMETER.items() if v == value]), value).otherwise(weight)
    return coded.groupBy(*key).agg(F.sum(weight).alias("perimeter"))


def solidities(mask: DataFrame) -> DataFrame:
    """Area by convex hull of pixel corners of each cell. Only the first and last pixel of each row of a cell are gathered."""

    def hull_area(points: np.ndarray) -> float:
        points = np.unique(points, axis=0)

        def chain(rows) -> list:
            out: list = []
            for p in rows:
                while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                    out.pop()
                out.append(p)
            return out[:-1]

        ring = np.array(chain(points) + chain(points[::-1]), float)
        x, y = ring[:, 0], ring[:, 1]
        return 0.5 * abs(float(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))))

    def measure(batches):
        for pdf in batches:
            shares = []
            for ends, area in zip(pdf["ends"], pdf["area"], strict=True):
                i, low, high = (np.array([e[c] for e in ends]) for c in ("i", "low", "high"))
                corners = np.concatenate([np.stack([i + a, j], 1) for a in (0, 1) for j in (low, high + 1)])
                shares.append(area / hull_area(corners))
            yield pdf.assign(solidity=shares)[[*CELL, "solidity"]]

    pixels = spread_out(mask.filter("cell > 0").select(*CELL, "i", "j"), *CELL).distinct()
    rows = pixels.groupBy(*CELL, "i").agg(F.min("j").alias("low"), F.max("j").alias("high"), F.count(F.lit(1)).alias("n"))
    cells = rows.groupBy(*CELL).agg(F.collect_list(F.struct("i", "low", "high")).alias("ends"), F.sum("n").cast("double").alias("area"))
    return cells.mapInPandas(measure, "well long, tile long, cell long, solidity double")


def outline_measures(mask: DataFrame) -> DataFrame:
    """Perimeter and solidity of each cell."""
    return perimeters(mask).join(solidities(mask), CELL)


def _cooccurrence(cell: np.ndarray, i: np.ndarray, j: np.ndarray, v: np.ndarray, distances: tuple[int, ...]) -> pd.DataFrame:
    """Texture of whole cells, numbered by ``cell``: a row for each cell and distance at which it has a pair of pixels."""
    top = np.zeros(cell.max() + 1, v.dtype)
    np.maximum.at(top, cell, v)
    v = np.floor(v * 255.0 / top[cell])
    cell, i, j, v = (x[(v > 0) & ~(np.isnan(i) | np.isnan(j))].astype(np.int64) for x in (cell, i, j, v))
    if not len(cell):
        return pd.DataFrame()
    # one number for each place of each cell; a border keeps what is shifted over an edge from the next row
    far = max(distances)
    for x in (i, j):
        low = np.full(len(top), x.max())
        np.minimum.at(low, cell, x)
        x += far - low[cell]
    height, width = int(i.max()) + far + 1, int(j.max()) + far + 1
    at = (cell * height + i) * width + j
    order = np.argsort(at, kind="stable")
    cell, at, v = cell[order], at[order], v[order]
    out = []
    for d in distances:
        ways = []
        for step in (d, d * width, d * width + d, d * width - d):
            # a place with several pixels meets all of them
            low, high = np.searchsorted(at, at + step), np.searchsorted(at, at + step, side="right")
            n = high - low
            one = np.repeat(np.arange(len(at)), n)
            two = np.arange(len(one)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
            if len(one):
                ways.append(_measures(cell[one], v[one], v[two]))
        if ways:
            out.append(pd.concat(ways).groupby("n", as_index=False).mean().assign(d=d))
    return pd.concat(out) if out else pd.DataFrame()


def _measures(cell: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Measures of the symmetric co-occurrence of values 1 to 255 in pairs of pixels, by cell ``n``; the correlation of equal values is NaN."""
    keys, count = np.unique(np.concatenate([(cell * 256 + a) * 256 + b, (cell * 256 + b) * 256 + a]), return_counts=True)
    a, b = (keys >> 8) & 255, keys & 255
    n, own = np.unique(keys >> 16, return_inverse=True)
    total = lambda x: np.bincount(own, weights=x, minlength=len(n))
    every = total(count)
    p, mean = count / every[own], total(count * a) / every
    gap, da, db = a - b, a - mean[own], b - mean[own]
    spread = total(p * da * da)
    with np.errstate(invalid="ignore"):
        correlation = total(p * da * db) / np.where(spread > 0, spread, np.nan)
    measures = {"contrast": total(p * gap * gap), "correlation": correlation, "asm": total(p * p), "idm": total(p / (1 + gap * gap)), "entropy": -total(p * np.log2(p))}
    return pd.DataFrame({"n": n, **measures})


def texture(pixels: DataFrame, channel: str, distances: tuple[int, ...] = (1, 2, 4)) -> DataFrame:
    """Co-occurrence texture of each cell for each distance, averaged over four directions: contrast, correlation, asm, idm, entropy.

    Values are scaled to 8 bit first, the brightest pixel of a cell to 255; those that become zero
    don't take part. Pixels are brought together by cell once and sorted there; a task reads its part in batches and holds
    the cells of one batch, so pairs of pixels are never rows.
    """
    measures = ("contrast", "correlation", "asm", "idm", "entropy")

    def whole_cells(batches):
        """The batches cut between cells; a cell may go on over many of them."""
        held: list = []
        for pdf in batches:
            if not len(pdf):
                continue
            last = pdf[CELL].iloc[-1]
            start = len(pdf) - int((pdf[CELL] == last).all(axis=1).sum())
            if held and (start or not (held[-1][CELL].iloc[-1] == last).all()):
                yield pd.concat([*held, pdf[:start]])
                held = []
            elif start:
                yield pdf[:start]
            held.append(pdf[start:])
        if held:
            yield pd.concat(held)

    def work(batches):
        for pdf in whole_cells(batches):
            new = (pdf[CELL].to_numpy()[1:] != pdf[CELL].to_numpy()[:-1]).any(axis=1)
            cell = np.concatenate([[0], np.cumsum(new)])
            out = _cooccurrence(cell, *[pdf[c].to_numpy() for c in "ijv"], distances)
            if len(out):
                yield pdf[CELL].iloc[np.searchsorted(cell, out["n"])].assign(**{c: out[c].to_numpy() for c in ("d", *measures)})

    raw = pixels.filter((F.col("cell") > 0) & (F.col(channel) > 0)).select(*CELL, "i", "j", F.col(channel).alias("v")).dropna(subset=TILE)
    placed = raw.repartition(*CELL).sortWithinPartitions(*CELL)
    kinds = ", ".join([f"{c} {raw.schema[c].dataType.simpleString()}" for c in CELL] + ["d int"] + [f"{c} double" for c in measures])
    found = placed.mapInPandas(work, kinds)
    return found.select(*CELL, "d", *[F.round(F.nanvl(c, F.lit(None)), 6).alias(c) for c in measures])


def normalized(values: DataFrame, high: float = 0.995, low: float | None = None, scale: float = 1.0) -> DataFrame:
    """Values of each cell and channel held in 0 to ``scale``: from the smallest (or a low percentile) to a high percentile."""
    v = F.col("value")
    key = [*CELL, "channel"]
    ends = values.filter("cell > 0").groupBy(*key).agg((F.min(v) if low is None else F.percentile(v, F.lit(low))).alias("a"), F.percentile(v, F.lit(high)).alias("b"))
    span = F.col("b") - F.col("a")
    unit = F.when(span > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - F.col("a")) / span))).otherwise(F.lit(0.0))
    return values.join(ends, key).select(*key, "i", "j", F.round(unit * scale, 6).alias("value"))
