"""Albums, representative cells and mapping records against values worked out by hand or by slow versions."""

import json
import math

import numpy as np
import pytest

from screenloom.operators import albums as oa
from screenloom.operators import mapping as om
from screenloom.sources import files as sf

CELL = "well long, tile long, cell long"


def slow_thumbnail(pixels, size, pad):
    """Each target pixel from the four source pixels around its centre."""
    i0, i1 = min(p[0] for p in pixels), max(p[0] for p in pixels)
    j0, j1 = min(p[1] for p in pixels), max(p[1] for p in pixels)
    side = max(i1 - i0, j1 - j0) + 1 + 2 * pad
    top, left = (i0 + i1 + 1 - side) // 2, (j0 + j1 + 1 - side) // 2
    source = {(i - top, j - left): v for i, j, v in pixels}
    out = np.zeros((size, size))
    for a in range(size):
        for b in range(size):
            y, x = ((k + 0.5) * side / size - 0.5 for k in (a, b))
            y, x = (min(max(k, 0.0), side - 1.0) for k in (y, x))
            ly, lx = (min(int(k), side - 2) for k in (y, x))
            fy, fx = y - ly, x - lx
            out[a, b] = sum(source.get((ly + p, lx + q), 0.0) * (fy if p else 1 - fy) * (fx if q else 1 - fx) for p in (0, 1) for q in (0, 1))
    return out


def test_albums_hold_the_thumbnails_of_their_slots(spark):
    rng = np.random.default_rng(2)
    cells = {(1, 1, c): [(int(i), int(j), float(rng.integers(1, 255))) for i in range(3 * c, 3 * c + 2 + c % 4) for j in range(2, 5 + c % 3)] for c in range(1, 9)}
    pixels = spark.createDataFrame([(*key, i, j, v) for key, ps in cells.items() for i, j, v in ps], f"{CELL}, i long, j long, ch0 double")
    images = oa.thumbnails(pixels, "ch0", 8, 2)
    thumbs = {(r.well, r.tile, r.cell): np.reshape(r.image, (8, 8)) for r in images.collect()}
    assert set(thumbs) == set(cells)
    for key, ps in cells.items():
        assert np.allclose(thumbs[key], slow_thumbnail(ps, 8, 2), atol=1e-3)
    slots = spark.createDataFrame([(1, 1, c, "A" if c <= 5 else "B", (c - 1) % 5) for c in range(1, 9)], f"{CELL}, sgrna string, slot long")
    albums = {r.sgrna: (r.cells, np.reshape(r.album, (16, 24))) for r in oa.assemble_albums(slots, images, 2, 3, 8).collect()}
    assert {k: n for k, (n, _) in albums.items()} == {"A": 5, "B": 3}
    for guide, own in (("A", range(1, 6)), ("B", range(6, 9))):
        want = np.zeros((16, 24))
        for slot, c in enumerate(own):
            want[slot // 3 * 8 : slot // 3 * 8 + 8, slot % 3 * 8 : slot % 3 * 8 + 8] = thumbs[1, 1, c]
        assert np.array_equal(albums[guide][1], want.astype(np.float32))


def test_representative_cells_lie_within_their_mode(spark):
    rng = np.random.default_rng(4)
    rows = [(1, 1 + k % 7, k, "two", 10 ** float(rng.normal(2.0 if k % 3 else 4.0, 0.05))) for k in range(600)]
    rows += [(2, 1, k, "one", 10 ** float(rng.normal(3.0, 0.1))) for k in range(200)] + [(3, 1, k, "few", 50.0) for k in range(2)]
    cells = spark.createDataFrame(rows, f"{CELL}, sgrna string, ints_avg double")
    modes = {r.sgrna: (r.low, r.high, r.cells) for r in oa.intensity_modes(cells, "sgrna", "ints_avg").collect()}
    # of two kinds of cells the brighter one counts
    assert modes["two"][:2] == (pytest.approx(3.95, abs=0.04), pytest.approx(4.05, abs=0.04)) and modes["two"][2] == 600
    assert modes["one"][:2] == (pytest.approx(2.9, abs=0.05), pytest.approx(3.1, abs=0.05))
    got = [r.asDict() for r in oa.representative_cells(cells, 5).collect()]
    assert {g: sum(r["sgrna"] == g for r in got) for g in modes} == {"two": 5, "one": 5, "few": 2}
    for r in got:
        low, high, _ = modes[r["sgrna"]]
        assert r["sgrna"] == "few" or low <= math.log10(r["ints_avg"]) <= high
    again = oa.representative_cells(cells.repartition(5), 5).collect()
    assert sorted(map(str, again)) == sorted(str(r) for r in oa.representative_cells(cells, 5).collect())


def test_mapping_records(spark):
    theta, dx, dy, sx, sy = 0.05, 100.0, 150.0, 4.0, 3.9
    rng = np.random.default_rng(5)
    rows = []
    for k in range(100):
        x, y = rng.uniform(0, 512, 2).tolist()
        rows.append((7, k, x, y, sx * (math.cos(theta) * x - math.sin(theta) * y + dx), sy * (math.sin(theta) * x + math.cos(theta) * y + dy)))
    pairs = spark.createDataFrame(rows, "well long, point long, x double, y double, ox double, oy double")
    fits = om.fit_scaled_rotation(pairs)
    moved = om.apply_scaled_rotation(pairs, fits).selectExpr("*", "sqrt((x - ox) * (x - ox) + (y - oy) * (y - oy)) AS dist")
    (record,) = sf.mapping_json(fits.drop("n", "rmse"), om.transform_error(moved, "well")).collect()
    got = json.loads(record.record)
    assert got["transform"] == {k: pytest.approx(v, abs=1e-6) for k, v in {"dx": dx, "dy": dy, "theta": theta, "scale_x": sx, "scale_y": sy}.items()}
    assert got["error_metrics"] == {k: 0.0 for k in ("mean_error", "median_error", "max_error", "rmse")} and got["num_matched_points"] == 100
