"""One-dimensional traces: baselines, peaks, base calls. ``traces`` have trace, channel, k, v."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def long_traces(traces: DataFrame) -> DataFrame:
    """One row per sample of (trace, channel, embedding)."""
    return traces.select("trace", "channel", F.posexplode("embedding").alias("k", "v")).withColumns({"k": F.col("k").cast("long"), "v": F.col("v").cast("double")})


def without_baseline(samples: DataFrame, size: int = 20) -> DataFrame:
    """Samples less a minimum filter of ``size`` (ten before to nine after; clipped at the ends), scaled to 0 to 1 per trace and channel."""
    key = W.partitionBy("trace", "channel")
    around = key.orderBy("k").rowsBetween(-(size // 2), size - size // 2 - 1)
    lifted = samples.withColumn("u", F.col("v") - F.min("v").over(around))
    low, high = F.min("u").over(key), F.max("u").over(key)
    return lifted.withColumns({"low": low, "high": high}).select("trace", "channel", "k", F.when(F.col("high") > F.col("low"), (F.col("u") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0).alias("v"))


PEAKS = "trace long, channel long, k long, height double, width double"


def _reach(signal: list[float]) -> tuple[list[int], list[float]]:
    """For each sample where the stretch left of it without a higher one begins, and the lowest value in it. Each sample is stacked once."""
    begins, lowest, stack = [], [], []
    for k, v in enumerate(signal):
        low = v
        while stack and signal[stack[-1]] <= v:
            low = min(low, lowest[stack.pop()])
        begins.append(stack[-1] + 1 if stack else 0)
        lowest.append(low)
        stack.append(k)
    return begins, lowest


def find_peaks(signal: np.ndarray, height: float = 0.2, apart: int = 3, narrow: float = 2, wide: float = 10) -> list[tuple[int, float, float]]:
    """Maxima of at least ``height``, flat tops at their middle; the tallest wins within ``apart``; the width at half prominence lies within bounds.

    The work is in proportion to the samples, besides sorting the maxima.
    """
    if len(signal) < 3:
        return []
    # runs of equal values; those at either end are no peaks
    last = np.append(np.flatnonzero(np.diff(signal)), len(signal) - 1)
    first = np.append(0, last[:-1] + 1)
    value = signal[first]
    top = np.flatnonzero((value[1:-1] > value[:-2]) & (value[1:-1] > value[2:]) & (value[1:-1] >= height)) + 1
    at = (first[top] + last[top]) // 2
    near, kept = np.zeros(len(signal) + 2 * apart, bool), []
    for k in at[np.lexsort((at, -signal[at]))].tolist():
        if not near[k + apart]:
            kept.append(k)
            near[k + 1 : k + 2 * apart] = True
    if not kept:
        return []
    v = signal.tolist()
    n = len(v)
    lefts, left_low = _reach(v)
    rights, right_low = _reach(v[::-1])
    out = []
    for k in sorted(kept):
        left, right = lefts[k], n - 1 - rights[n - 1 - k]
        base = max(left_low[k], right_low[n - 1 - k])
        level = v[k] - (v[k] - base) / 2
        # a peak that is too wide needn't be followed to its ends
        a = k
        while a > left and v[a - 1] > level and k - a <= wide:
            a -= 1
        b = k
        while b < right and v[b + 1] > level and b - k <= wide:
            b += 1
        if k - a > wide or b - k > wide:
            continue
        start = a - (v[a] - level) / (v[a] - v[a - 1]) if a > left else float(a)
        end = b + (v[b] - level) / (v[b] - v[b + 1]) if b < right else float(b)
        if narrow <= end - start <= wide:
            out.append((k, v[k], end - start))
    return out


def trace_peaks(samples: DataFrame) -> DataFrame:
    """Peaks of every trace and channel. A trace travels as one array, and many traces in a batch."""
    arrays = samples.groupBy("trace", "channel").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]).alias("v"))

    def work(batches):
        for pdf in batches:
            rows = [(trace, channel, *p) for trace, channel, v in zip(pdf["trace"], pdf["channel"], pdf["v"], strict=True) for p in find_peaks(np.asarray(v, float))]
            yield pd.DataFrame(rows, columns=["trace", "channel", "k", "height", "width"])

    return arrays.mapInPandas(work, PEAKS)


def peak_quality(peaks: DataFrame, least: float = 0.8) -> DataFrame:
    """Peaks with quality 0.7 h / h_max + 0.3 (1 - (w - 2) / 8), h_max being the tallest of the trace; those under ``least`` go."""
    top = F.max("height").over(W.partitionBy("trace"))
    quality = 0.7 * F.col("height") / top + 0.3 * (1 - (F.col("width") - 2) / 8)
    return peaks.withColumn("quality", quality).filter(F.col("quality") >= least)


def call_at_peaks(samples: DataFrame, peaks: DataFrame) -> DataFrame:
    """At every peak place of a trace the base of the highest of its four channels (A, C, G, T, the first on ties)."""
    places = peaks.select("trace", "k").distinct()
    best = samples.join(places, ["trace", "k"]).groupBy("trace", "k").agg(F.min(F.struct((-F.col("v")).alias("o"), "channel")).alias("m"))
    return best.select("trace", "k", F.substring(F.lit("ACGT"), (F.col("m.channel") + 1).cast("int"), F.lit(1)).alias("base"), F.round(-F.col("m.o"), 6).alias("height"))
