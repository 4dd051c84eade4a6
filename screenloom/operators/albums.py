"""Choosing, sampling and arranging representative cells of each guide."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from screenloom.operators.barcodes import CELL
from screenloom.operators.iterate import saved


def phenotyped(cells: DataFrame) -> DataFrame:
    return cells.filter((F.col("area_nuc") != -1) & (F.col("image") != "-1"))


def retained(cells: DataFrame, *by: str) -> DataFrame:
    """Cells, those that were phenotyped, those with an image too, and the share that stays."""
    has, seen = F.col("area_nuc") != -1, F.col("image") != "-1"
    return cells.groupBy(*by).agg(
        F.count(F.lit(1)).alias("cells"), F.sum(has.cast("long")).alias("phenotyped"), F.sum((has & seen).cast("long")).alias("imaged"), F.round(F.avg((has & seen).cast("double")), 6).alias("fraction")
    )


def intensity_between(cells: DataFrame, low: float, high: float, column: str, log10: bool = False) -> DataFrame:
    """Cells within an inclusive range; with ``log10`` the ends are powers of ten."""
    return cells.filter(F.col(column).between(10**low, 10**high) if log10 else F.col(column).between(low, high))


def brightest(cells: DataFrame, group: str, column: str, number: int) -> DataFrame:
    """The first cells of each group by falling ``column`` (missing and NaN last, ties by cell), with their slot; a null group matches nothing."""
    missing = F.col(column).isNull() | F.isnan(F.col(column).cast("double"))
    order = W.partitionBy(group).orderBy(missing, F.desc(column), *CELL)
    return cells.filter(F.col(group).isNotNull()).withColumn("slot", (F.row_number().over(order) - 1).cast("long")).filter(F.col("slot") < number)


def draw(cells: DataFrame, group: str, number: int, seed: int, key: Column) -> DataFrame:
    """``number`` cells of each group by the order of md5(seed, key): the same ones at every run, none twice."""
    order = W.partitionBy(group).orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), key)), key)
    return cells.withColumn("slot", (F.row_number().over(order) - 1).cast("long")).filter(F.col("slot") < number)


def guides_with_enough(cells: DataFrame, least: int, most: int) -> DataFrame:
    """At most ``most`` cells (brightest first) of each guide that has at least ``least``."""
    enough = cells.groupBy("sgrna").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return brightest(cells.join(enough.select("sgrna"), "sgrna", "left_semi"), "sgrna", "ints_avg", most)


def layout(slots: DataFrame, columns: int) -> DataFrame:
    return slots.withColumns({"album_row": F.floor(F.col("slot") / columns), "album_col": F.col("slot") % columns})


def album_records(slots: DataFrame, rows: int, columns: int) -> DataFrame:
    """One JSON record for each guide: its grid and the cells in slot order (at most rows × columns)."""
    cells = slots.groupBy("sgrna").agg(F.sort_array(F.collect_list(F.struct("slot", F.concat_ws("-", *CELL).alias("cell")))).alias("s"))
    return cells.select("sgrna", F.to_json(F.struct(F.lit(rows).alias("rows"), F.lit(columns).alias("columns"), F.size("s").alias("count"), F.transform("s", lambda x: x["cell"]).alias("cells"))).alias("record"))


def localized(guides: DataFrame, localization: DataFrame, where: str) -> DataFrame:
    """Distinct guides whose gene has a localization."""
    own = localization.filter(F.col("localization") == where).select("gene").distinct()
    return guides.withColumn("gene", F.split("sgrna", "_")[0]).join(own, "gene", "left_semi").select("sgrna").distinct()


def cell_names(cells: DataFrame) -> DataFrame:
    from screenloom.functions.bases import cell_name

    return cells.select(*CELL, cell_name(F.col("sgrna"), F.col("well"), F.col("tile"), F.col("cell")).alias("name"))


def _mode_ranges(z: np.ndarray, n: np.ndarray, peak: float = 0.2) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the brightest peak of each of many histograms (a row of centres ``z`` and counts ``n`` each).

    The counts are smoothed; with more than one peak of at least ``peak`` of the highest, a mixture
    of normal densities, its size chosen by BIC, splits them and the brightest part counts. Mixtures of one size
    are fitted together, over the bins that hold something.
    """
    grid = np.arange(-3, 4)
    kernel = np.exp(-(grid**2) / 2)
    kernel /= kernel.sum()
    smooth = np.array([np.convolve(row, kernel, mode="same") for row in n])
    padded = np.pad(smooth, ((0, 0), (1, 1)), constant_values=-1.0)
    tops = ((padded[:, 1:-1] > padded[:, :-2]) & (padded[:, 1:-1] >= padded[:, 2:]) & (smooth >= peak * smooth.max(1, keepdims=True))).sum(1)
    total = n.sum(1)
    share, mean = n.astype(float), (z * n).sum(1) / total
    # bins that hold something come first; groups with about as many of them go together
    held = (n > 0).sum(1)
    many = np.flatnonzero(tops > 1)
    many = many[np.argsort(held[many], kind="stable")]
    for at in np.array_split(many, max(1, -(-len(many) // 256))):
        if not len(at):
            continue
        order = np.argsort(n[at] == 0, axis=1, kind="stable")[:, : held[at].max()]
        own, best = np.take_along_axis(share[at], order, 1), np.full(len(at), np.inf)
        own_z, kept, top = np.take_along_axis(z[at], order, 1), own.copy(), mean[at].copy()
        for k in range(1, 5):
            use = np.flatnonzero(tops[at] >= k)
            if not len(use):
                break
            mu, r, likelihood = _mixture(own_z[use], own[use], z[at[use]], n[at[use]], k)
            bic = (3 * k - 1) * np.log(total[at[use]]) - 2 * likelihood
            better = bic < best[use]
            use, mu, r = use[better], mu[better], r[better]
            best[use] = bic[better]
            kept[use] = np.take_along_axis(r, mu.argmax(1)[:, None, None], 2)[:, :, 0]
            top[use] = (own_z[use] * kept[use]).sum(1) / kept[use].sum(1)
        share[at] = 0
        spread = share[at]
        np.put_along_axis(spread, order, kept, 1)
        share[at], mean[at] = spread, top
    std = np.sqrt((share * (z - mean[:, None]) ** 2).sum(1) / share.sum(1))
    return mean, std * np.maximum(0.0, (total - 1) / total) ** 0.5


def _mode_range(z: np.ndarray, n: np.ndarray, peak: float = 0.2) -> tuple[float, float]:
    """The same of one histogram."""
    mean, std = _mode_ranges(z[None], n[None], peak)
    return float(mean[0]), float(std[0])


def _mixture(z: np.ndarray, n: np.ndarray, every_z: np.ndarray, every_n: np.ndarray, k: int, steps: int = 100) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixtures of ``k`` normal densities fitted to many histograms: means, counts by bin and part, log likelihood.

    ``z`` and ``n`` have the bins that hold something, ``every_z`` and ``every_n`` all of them, from which the parts start.
    """
    total = every_n.sum(1)
    # quantiles of all centres, each as often as its bin has thousandths, once at least
    ends = np.cumsum(np.maximum(1, np.round(every_n / total[:, None] * 1000)).astype(int), axis=1)
    place = (ends[:, -1:] - 1) * ((np.arange(k) + 0.5) / k)
    low = np.floor(place)
    value = lambda x: np.take_along_axis(every_z, np.minimum((ends[:, None, :] <= x[:, :, None]).sum(2), every_z.shape[1] - 1), 1)
    mu = value(low) + (value(low + 1) - value(low)) * (place - low)
    sd = np.repeat(np.maximum(every_z.std(1) / k, 1e-6)[:, None], k, 1)
    w = np.full(mu.shape, 1 / k)
    for _ in range(steps if k > 1 else 3):  # a single part stands still after one step
        d = w[:, None] * np.exp(-0.5 * ((z[:, :, None] - mu[:, None]) / sd[:, None]) ** 2) / (sd[:, None] * np.sqrt(2 * np.pi)) + 1e-300
        r = d / d.sum(2, keepdims=True) * n[:, :, None]
        mass = r.sum(1) + 1e-12
        mu, w = (r * z[:, :, None]).sum(1) / mass, mass / total[:, None]
        sd = np.sqrt((r * (z[:, :, None] - mu[:, None]) ** 2).sum(1) / mass + 1e-8)
    return mu, r, (n * np.log(d.sum(2))).sum(1)


def intensity_modes(cells: DataFrame, group: str, column: str, bins: int = 50) -> DataFrame:
    """``low`` and ``high`` of each group: the modal log10 intensity minus and plus a deviation.

    Groups are first brought down to histograms of ``bins`` counts, so an abundant guide costs no
    more than a rare one. A task fits many of them at a time.
    """
    z = F.log10(F.col(column).cast("double"))
    positive = saved(cells.filter(F.col(column) > 0).select(group, z.alias("z")), "intensities")
    ends = positive.groupBy(group).agg(F.min("z").alias("a"), F.max("z").alias("b"))
    both = positive.join(ends, group)
    bin_ = F.when(F.col("b") > F.col("a"), F.least(F.floor((F.col("z") - F.col("a")) / (F.col("b") - F.col("a")) * bins), F.lit(bins - 1))).otherwise(0)
    counts = both.groupBy(group, "a", "b", bin_.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    histograms = counts.groupBy(group, "a", "b").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    histograms = histograms.select(group, "a", "b", F.map_keys("m").alias("bin"), F.map_values("m").alias("n"))

    def fit(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            a, b = (pdf[c].to_numpy()[:, None] for c in "ab")
            n = np.zeros((len(pdf), bins))
            n[np.repeat(np.arange(len(pdf)), pdf["bin"].map(len)), np.concatenate(pdf["bin"].to_list())] = np.concatenate(pdf["n"].to_list())
            mean, std = _mode_ranges(a + (np.arange(bins) + 0.5) * (b - a) / bins, n)
            yield pd.DataFrame({group: pdf[group], "low": mean - std, "high": mean + std, "cells": n.sum(1).astype(int)})

    return histograms.mapInPandas(fit, f"{group} string, low double, high double, cells long")


def representative_cells(cells: DataFrame, number: int, seed: int = 0) -> DataFrame:
    """``number`` cells of each guide within its modal range; all of a guide whose range has fewer, its full set where the range is empty."""
    cells = saved(cells.select(*CELL, "sgrna", "ints_avg"), "cells")
    modes = intensity_modes(cells, "sgrna", "ints_avg")
    both = cells.join(modes.select("sgrna", "low", "high"), "sgrna")
    inside = F.log10(F.col("ints_avg").cast("double")).between(F.col("low"), F.col("high"))
    flagged = both.withColumn("inside", F.coalesce(inside, F.lit(False)))
    flagged = flagged.withColumn("some", F.max("inside").over(W.partitionBy("sgrna")))
    kept = flagged.filter(F.col("inside") | ~F.col("some")).drop("low", "high", "inside", "some")
    return draw(kept, "sgrna", number, seed, F.concat_ws("-", *CELL))


def thumbnails(pixels: DataFrame, channel: str, size: int = 16, pad: int = 5) -> DataFrame:
    """A square image of each cell: its box with a border, centred, resized linearly to ``size`` × ``size``, as an array of rows."""

    def cut(i: np.ndarray, j: np.ndarray, v: np.ndarray) -> np.ndarray:
        side = max(i.max() - i.min(), j.max() - j.min()) + 1 + 2 * pad
        top, left = (i.min() + i.max() + 1 - side) // 2, (j.min() + j.max() + 1 - side) // 2
        image = np.zeros((side, side), np.float32)
        image[i - top, j - left] = v
        at = np.clip((np.arange(size) + 0.5) * side / size - 0.5, 0, side - 1)
        low = np.minimum(at.astype(int), side - 2)
        f = (at - low).astype(np.float32)
        rows = image[low] * (1 - f)[:, None] + image[low + 1] * f[:, None]
        return (rows[:, low] * (1 - f) + rows[:, low + 1] * f).ravel()

    def work(batches):
        for pdf in batches:
            yield pdf[CELL].assign(image=[cut(*r) for r in zip(pdf["i"], pdf["j"], pdf["v"], strict=True)])

    cells = pixels.filter("cell > 0").groupBy(*CELL).agg(F.collect_list(F.struct("i", "j", F.col(channel).alias("v"))).alias("p"))
    return cells.select(*CELL, "p.i", "p.j", "p.v").mapInPandas(work, "well long, tile long, cell long, image array<float>")


def assemble_albums(slots: DataFrame, images: DataFrame, rows: int, columns: int, size: int) -> DataFrame:
    """One array per guide with its thumbnails in their places (at most rows × columns of them)."""

    def place(batches):
        for pdf in batches:
            albums = []
            for r, c, images in zip(pdf["album_row"], pdf["album_col"], pdf["image"], strict=True):
                album = np.zeros((rows, size, columns, size), np.float32)
                album[r, :, c] = np.stack(images).reshape(-1, size, size)
                albums.append(album.ravel())
            yield pdf[["sgrna"]].assign(cells=pdf["image"].map(len), album=albums)

    both = layout(slots, columns).select(*CELL, "sgrna", "album_row", "album_col").join(images, CELL)
    guides = both.groupBy("sgrna").agg(F.collect_list(F.struct("album_row", "album_col", "image")).alias("p"))
    return guides.select("sgrna", "p.album_row", "p.album_col", "p.image").mapInPandas(place, "sgrna string, cells long, album array<float>")
