import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenloom.operators import features as of
from screenloom.operators import mapping as om
from screenloom.operators import tiles as ot
from screenloom.operators.albums import _mode_range, intensity_modes, thumbnails
from screenloom.operators.traces import find_peaks


def squares(spark):
    """Two squares: label 1 with value 200 over 20..39, label 2 with value 150 over 60..74."""
    rows = [(1, 1, i, j, 1, 1, 200) for i in range(20, 40) for j in range(20, 40)] + [(1, 1, i, j, 2, 2, 150) for i in range(60, 75) for j in range(60, 75)]
    return spark.createDataFrame(rows, "well long, tile long, i long, j long, cell long, nucleus long, v long")


def test_shapes_of_squares(spark):
    got = {r.cell: r for r in of.shapes(squares(spark)).collect()}
    assert (got[1].area, got[2].area) == (400, 225)
    assert (got[1].y, got[1].x) == (29.5, 29.5) and got[1].extent == 1.0
    assert got[1].eccentricity == pytest.approx(0, abs=1e-6)
    assert got[1].major_axis == pytest.approx(4 * math.sqrt(400 / 12))


def test_intensities_and_outline(spark):
    px = squares(spark)
    values = px.select("well", "tile", "i", "j", "cell", "nucleus", F.lit(0).alias("channel"), F.col("v").alias("value"))
    got = {r.cell: r.mean for r in of.region_intensities(values, F.lit(True)).collect()}
    assert got == {1: 200.0, 2: 150.0}
    edge = {r.cell: (r.perimeter, r.solidity) for r in of.outline_measures(px).collect()}
    assert edge == {1: (76.0, 1.0), 2: (56.0, 1.0)}


def test_texture_of_constant_region(spark):
    got = of.texture(squares(spark), "v").filter("cell = 1 and d = 1").first()
    assert (got.contrast, got.asm, got.idm, got.entropy, got.correlation) == (0, 1, 1, 0, None)


def test_texture_of_stripes_in_8_bit(spark):
    # 16-bit columns of 1000, 2000 and 1 become 127, 255 and 0; zeros don't take part
    rows = [(1, 1, i, j, 1, 1, (1000, 2000, 1)[j % 3]) for i in range(6) for j in range(6)]
    px = spark.createDataFrame(rows, "well long, tile long, i long, j long, cell long, nucleus long, v long")
    got = of.texture(px, "v", (1,)).first()
    # along a row and on both diagonals neighbours are 127 and 255, down a column they are equal
    assert got.contrast == pytest.approx(3 / 4 * (255 - 127) ** 2)
    assert got.asm == pytest.approx(1 / 2) and got.entropy == pytest.approx(1)


def test_clean_mask_drops_edges_and_double_nuclei(spark):
    def block(label, top, left, nuclei):
        return [(1, 1, i, j, label, next((n for n, (a, b) in nuclei.items() if (i, j) == (a, b)), 0)) for i in range(top, top + 5) for j in range(left, left + 5)]

    rows = block(7, 0, 5, {1: (2, 7)}) + block(9, 10, 5, {2: (12, 7)}) + block(11, 10, 12, {3: (11, 13), 4: (13, 15)})
    mask = spark.createDataFrame(rows, "well long, tile long, i long, j long, cell long, nucleus long")
    got = of.clean_mask(mask, 32, 32)
    assert got.count() == 25 and got.select("cell").distinct().collect()[0][0] == 1
    assert got.filter("nucleus = 1").count() == 1


def test_components_match_flood_fill():
    rng = np.random.default_rng(0)
    for _ in range(20):
        mask = rng.random((15, 17)) < 0.55
        label, seen, n = ot.components(mask), np.zeros(mask.shape, int), 0
        for i, j in np.argwhere(mask):
            if seen[i, j]:
                continue
            n += 1
            stack = [(i, j)]
            while stack:
                a, b = stack.pop()
                if 0 <= a < 15 and 0 <= b < 17 and mask[a, b] and not seen[a, b]:
                    seen[a, b] = n
                    stack += [(a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)]
        assert np.array_equal(label, seen)


def test_shift_and_laplacian():
    rng = np.random.default_rng(1)
    image = rng.random((32, 40))
    assert ot.shift_between(image, np.roll(image, (3, -5), (0, 1)))[:2] == (-3, 5)
    spot = np.zeros((21, 21))
    spot[10, 10] = 100
    out = ot.inverted_log(spot)
    assert out.argmax() == 10 * 21 + 10 and out.min() == 0


def test_segmenter_reports_errors(spark):
    tiles = spark.createDataFrame([(1, 1, 16, 16, [0.0] * 256), (1, 2, 16, 16, [0.0] * 5)], "well long, tile long, h int, w int, data array<float>")
    got = {r.tile: r.status for r in ot.apply_segmenter(tiles).collect()}
    assert got == {1: "success", 2: "error"}


def test_reads_from_stack_finds_a_spot(spark):
    rng = np.random.default_rng(2)
    base = rng.random((32, 32)) * 5
    rows = []
    for cycle, lit in enumerate("GTG"):
        for channel in ("DAPI", "G", "T"):
            image = np.roll(base, (cycle, cycle), (0, 1)).copy() if channel == "DAPI" else np.zeros((32, 32))
            if channel == lit:
                image[15 + cycle, 12 + cycle] = 500
            rows.append((1, 1, cycle, channel, 32, 32, image.ravel().tolist()))
    tiles = spark.createDataFrame(rows, "well long, tile long, cycle int, channel string, h int, w int, data array<float>")
    got = ot.reads_from_stack(tiles, 5.0)
    assert {(r.i, r.j) for r in got.select("i", "j").distinct().collect()} == {(15, 12)}


def test_nearest_is_brute_force(spark):
    rng = np.random.default_rng(3)
    a, b = rng.random((120, 2)) * 60, rng.random((150, 2)) * 60
    frame = lambda p: spark.createDataFrame([(1, i, float(x), float(y)) for i, (x, y) in enumerate(p)], "well long, point long, x double, y double")
    got = {r.point: r.other for r in om.nearest_within(frame(a), frame(b), 4.0).collect()}
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2))
    assert got == {i: int(d[i].argmin()) for i in range(120) if d[i].min() <= 4.0}


def test_fit_recovers_a_known_transform(spark):
    rng = np.random.default_rng(42)
    p = rng.random((100, 2)) * 512
    t = {"dx": 100.0, "dy": 150.0, "theta": 0.05, "scale_x": 4.0, "scale_y": 4.0}
    x = t["scale_x"] * (np.cos(0.05) * p[:, 0] - np.sin(0.05) * p[:, 1] + 100)
    y = t["scale_y"] * (np.sin(0.05) * p[:, 0] + np.cos(0.05) * p[:, 1] + 150)
    x, y = x + rng.normal(0, 2, 100), y + rng.normal(0, 2, 100)
    bad = np.arange(100) % 5 == 0
    rows = [(1, i, float(p[i, 0]), float(p[i, 1]), float(x[i]), float(y[i])) for i in range(100)]
    schema = "well long, point long, x double, y double, ox double, oy double"
    fit = om.fit_scaled_rotation(spark.createDataFrame(rows, schema)).first()
    assert fit.theta == pytest.approx(0.05, abs=0.003) and fit.dx == pytest.approx(100, abs=0.5) and fit.rmse < 3.2
    spoilt = [(w, i, a, b, c + (900 if bad[i] else 0), d) for w, i, a, b, c, d in rows]
    kept = {r.point for r in om.ransac_inliers(spark.createDataFrame(spoilt, schema), 15.0, samples=60).collect()}
    assert not kept & set(np.flatnonzero(bad).tolist()) and len(kept) >= 70


def test_local_global_identity(spark):
    layout = spark.createDataFrame([(1, t, t // 4, t % 4) for t in range(8)], "well long, tile long, tile_row long, tile_col long")
    points = spark.createDataFrame([(1, t, 3 + t, 5, t) for t in range(8)], "well long, tile long, y long, x long, k long")
    back = om.global_to_local(om.local_to_global(points, layout, 32, 32), layout, 32, 32)
    assert all((r.tile_at, r.y_local, r.x_local) == (r.tile, r.y, r.x) for r in back.collect())
    out = om.global_to_local(spark.createDataFrame([(1, -1.0, 5.0)], "well long, y_global double, x_global double"), layout, 32, 32)
    assert out.first()["tile_at"] is None


def test_peaks_of_a_trace():
    signal = np.zeros(40)
    signal[9:12] = [0.5, 1.0, 0.5]
    signal[20] = 0.1
    signal[30:33] = [0.4, 0.8, 0.4]
    assert [p[0] for p in find_peaks(signal)] == [10, 31]
    assert find_peaks(signal)[0][2] == pytest.approx(2.0)


def test_flat_tops_are_peaks():
    signal = np.array([0, 0.5, 1, 1, 1, 0.5, 0, 0, 0, 0, 0.4, 0.9, 0.9, 0.4, 0, 0, 1, 1], float)
    assert [p[0] for p in find_peaks(signal)] == [3, 11]  # the middle of each top; the run at the end is none
    assert find_peaks(np.ones(5)) == [] and find_peaks(np.ones(2)) == []


def test_modes(spark):
    z = np.linspace(0, 10, 51)
    n = 1000 * np.exp(-((z - 2) ** 2) / 0.5) + 600 * np.exp(-((z - 7) ** 2) / 0.5)
    mean, std = _mode_range(z, n)
    assert mean == pytest.approx(7, abs=0.2) and std == pytest.approx(0.5, abs=0.2)
    cells = spark.createDataFrame([("g", 100.0)] * 5, "sgrna string, ints_avg double")
    assert intensity_modes(cells, "sgrna", "ints_avg").first()["low"] == pytest.approx(2.0)


def test_thumbnail_is_centred(spark):
    image = np.array(thumbnails(squares(spark), "v", 16).filter("cell = 1").first()["image"]).reshape(16, 16)
    assert np.allclose(image, image.T) and np.allclose(image, image[::-1]) and image[8, 8] == 200 and image[0, 0] == 0


def test_iterative_matching_finds_the_transform(spark):
    """Shift (100, 150), rotation 0.05, scale 4 and noise of 2: all points find their partners."""
    rng = np.random.default_rng(11)
    grid = np.stack(np.meshgrid(np.arange(10), np.arange(10)), axis=-1).reshape(-1, 2) * 100.0
    points = grid + rng.uniform(-20, 20, grid.shape)
    c, s = np.cos(0.05), np.sin(0.05)
    others = 4 * (points + (100, 150)) @ np.array([[c, s], [-s, c]]) + rng.normal(0, 2, grid.shape)
    here = spark.createDataFrame([(i, 1, float(x), float(y)) for i, (x, y) in enumerate(points)], "point long, well long, x double, y double")
    there = spark.createDataFrame([(1000 + i, 1, float(x), float(y)) for i, (x, y) in enumerate(others)], "point long, well long, x double, y double")
    found = om.match_iteratively(here, there, 150.0)
    moved = {r.point: (r.x, r.y) for r in om.apply_scaled_rotation(here, found).collect()}
    off = np.array([np.hypot(moved[i][0] - others[i, 0], moved[i][1] - others[i, 1]) for i in range(100)])
    assert np.sqrt((off**2).mean()) < 4 and off.max() < 10
    fit = found.first()
    assert abs(fit.scale_x - 4) < 0.02 and abs(fit.scale_y - 4) < 0.02 and abs(abs(fit.theta) - 0.05) < 0.002


def test_texture_holds_many_cells_of_any_size_without_a_row_for_each_pair(spark):
    rng = np.random.default_rng(2)
    # cells over one another's border and of very different size, two pixels in one place, one cell over many batches
    rows = [(w, 1, int(i), int(j), 1 + int(i) // 7 % 3, int(v)) for w in (1, 2) for i, j, v in zip(*np.nonzero(rng.random((40, 41)) < 0.7), rng.integers(0, 256, 2000), strict=False)]
    rows += [(3, 1, i, j, 5, int(v)) for (i, j), v in zip(np.ndindex(60, 60), rng.integers(1, 4, 3600), strict=True)] + [(3, 2, 0, 0, 1, 9), (3, 2, 0, 1, 1, 9), (3, 2, 0, 1, 1, 4)]
    px = spark.createDataFrame([(*r[:5], 0, r[5]) for r in rows], "well long, tile long, i long, j long, cell long, nucleus long, v long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        plan = of.texture(px, "v")
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        got = {(r.well, r.tile, r.cell, r.d): (r.contrast, r.correlation, r.asm, r.idm, r.entropy) for r in plan.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert "Generate" not in text and "Join" not in text

    cells, want = {}, {}
    for w, t, i, j, c, v in rows:
        cells.setdefault((w, t, c), []).append((i, j, v))
    for key, own in cells.items():
        top, places = max(v for *_, v in own), {}
        for i, j, v in own:
            if v and v * 255 // top:
                places.setdefault((i, j), []).append(v * 255 // top)
        for d in (1, 2, 4):
            ways = []
            for di, dj in ((0, d), (d, 0), (d, d), (d, -d)):
                pairs = [(a, b) for (i, j), vs in places.items() for a in vs for b in places.get((i + di, j + dj), [])]
                if not pairs:
                    continue
                both, n = np.unique(np.array(pairs + [(b, a) for a, b in pairs], float), axis=0, return_counts=True)
                (a, b), p = both.T, n / n.sum()
                m = (p * a).sum()
                spread = (p * (a - m) ** 2).sum()
                ways.append([(p * (a - b) ** 2).sum(), (p * (a - m) * (b - m)).sum() / spread if spread else np.nan, (p * p).sum(), (p / (1 + (a - b) ** 2)).sum(), -(p * np.log2(p)).sum()])
            if ways:
                want[*key, d] = [None if np.isnan(x).all() else np.nanmean(x) for x in np.array(ways).T]
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], abs=1.01e-6)
