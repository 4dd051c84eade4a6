"""Perimeters and trace peaks against slow versions."""

import math

import numpy as np
import pytest

from screenloom.operators import features as of
from screenloom.operators import traces as tr


def slow_perimeter(grid):
    """Borders and their surroundings, pixel by pixel on a padded array."""
    g = np.pad(grid, 2)
    border = np.zeros_like(g)
    for i, j in zip(*np.nonzero(g), strict=True):
        border[i, j] = not (g[i - 1, j] and g[i + 1, j] and g[i, j - 1] and g[i, j + 1])
    total = 0.0
    for i, j in zip(*np.nonzero(border), strict=True):
        code = 1 + 2 * (border[i - 1, j] + border[i + 1, j] + border[i, j - 1] + border[i, j + 1]).item()
        code += 10 * sum(int(border[i + a, j + b]) for a in (-1, 1) for b in (-1, 1))
        total += {5: 1, 7: 1, 15: 1, 17: 1, 25: 1, 27: 1, 21: math.sqrt(2), 33: math.sqrt(2), 13: (1 + math.sqrt(2)) / 2, 23: (1 + math.sqrt(2)) / 2}.get(code, 0)
    return total


def test_perimeters_are_those_of_the_slow_version(spark):
    rng = np.random.default_rng(3)
    grids = [np.ones((2, 5), int), np.ones((1, 1), int), np.ones((1, 7), int), np.ones((20, 20), int), np.eye(9, dtype=int)]
    y, x = np.indices((31, 31))
    grids += [((y - 15) ** 2 + (x - 15) ** 2 <= r * r).astype(int) for r in (3, 8, 14)] + [(rng.random((14, 11)) < share).astype(int) for share in (0.2, 0.5, 0.7, 0.95)]
    rows = [(1 + k % 2, 1, k + 1, int(i), int(j)) for k, g in enumerate(grids) for i, j in zip(*np.nonzero(g), strict=True)]
    rows += [(1, 1, 0, 0, 0), (1, 1, 1, 0, 0)]  # background, and a pixel that is there twice
    mask = spark.createDataFrame(rows, "well long, tile long, cell long, i long, j long")
    got = {r.cell: r.perimeter for r in of.perimeters(mask).collect()}
    assert got == {k + 1: pytest.approx(slow_perimeter(g)) for k, g in enumerate(grids)}
    assert got[1] == 10.0  # a region of 2 x 5
    both = {r.cell: r.solidity for r in of.outline_measures(mask).collect()}
    assert both[1] == 1.0 and set(both) == set(got)


def slow_peaks(signal, height=0.2, apart=3, narrow=2, wide=10):
    """Every peak by itself, walking to both sides."""
    n, tops, k = len(signal), [], 0
    while k < n:
        end = k
        while end + 1 < n and signal[end + 1] == signal[k]:
            end += 1
        if k > 0 and end < n - 1 and signal[k - 1] < signal[k] > signal[end + 1] and signal[k] >= height:
            tops.append((k + end) // 2)
        k = end + 1
    kept = []
    for k in sorted(tops, key=lambda k: (-signal[k], k)):
        if all(abs(k - o) >= apart for o in kept):
            kept.append(k)
    out = []
    for k in sorted(kept):
        left = right = k
        while left > 0 and signal[left - 1] <= signal[k]:
            left -= 1
        while right < n - 1 and signal[right + 1] <= signal[k]:
            right += 1
        level = signal[k] - (signal[k] - max(min(signal[left : k + 1]), min(signal[k : right + 1]))) / 2
        a = b = k
        while a > left and signal[a - 1] > level:
            a -= 1
        while b < right and signal[b + 1] > level:
            b += 1
        start = a - (signal[a] - level) / (signal[a] - signal[a - 1]) if a > left else float(a)
        end = b + (signal[b] - level) / (signal[b] - signal[b + 1]) if b < right else float(b)
        if narrow <= end - start <= wide:
            out.append((k, signal[k], end - start))
    return out


def test_peaks_are_those_of_the_slow_version():
    rng = np.random.default_rng(5)
    found = 0
    for k in range(400):
        n = int(rng.integers(0, 120))
        signal = rng.random(n)
        if k % 4 == 1:
            signal = np.round(signal, 1)  # flat tops
        if k % 4 == 2:
            signal = np.convolve(signal, np.ones(7) / 7, "same")  # wide ones
        if k % 4 == 3:
            signal = np.abs(np.cumsum(rng.normal(size=n))) / 5
        for apart, narrow, wide in ((3, 2, 10), (1, 0, 4), (6, 1, 25)):
            want = slow_peaks(signal.tolist(), 0.2, apart, narrow, wide)
            assert tr.find_peaks(signal, 0.2, apart, narrow, wide) == want
            found += len(want)
    assert found > 1000


def test_long_traces_take_time_in_proportion():
    import time

    took = []
    for n in (20_000, 80_000):
        x = np.arange(n)
        signal = np.where(x % 2 == 0, 1.0 + x / n, 0.5 + x / n)  # each peak is higher than all before it
        began = time.perf_counter()
        tr.find_peaks(signal)
        took.append(time.perf_counter() - began)
    assert took[1] < 12 * took[0] + 0.5


def test_peaks_of_many_traces(spark):
    rng = np.random.default_rng(6)
    data = {(t, c): rng.random(64).round(2) for t in range(0, 40, 4) for c in range(4)}
    rows = [(t, c, k, float(v)) for (t, c), s in data.items() for k, v in enumerate(s)]
    rng.shuffle(rows)
    samples = spark.createDataFrame([(int(t), int(c), int(k), float(v)) for t, c, k, v in rows], "trace long, channel long, k long, v double")
    got = sorted((r.trace, r.channel, r.k, r.height, r.width) for r in tr.trace_peaks(samples).collect())
    assert got == sorted((*key, *p) for key, s in data.items() for p in slow_peaks(s.tolist()))
    assert tr.trace_peaks(samples.limit(0)).count() == 0
