"""Nearest neighbours against brute force, in crowds too."""

import math
import random

import pytest

from screenloom.operators import mapping as om

POINT = "well long, point long, x double, y double"


def brute(points, others, most):
    out = {}
    for w, p, x, y in points:
        found = [(math.dist((x, y), (ox, oy)), o) for v, o, ox, oy in others if v == w]
        dist, other = min(((d, o) for d, o in found if d <= most), default=(None, None))
        if other is not None:
            out[w, p] = (other, dist)
    return out


def clumps(rng, n, centres, width):
    return [(1 + k % 2, k, cx + rng.gauss(0, width), cy + rng.gauss(0, width)) for k, (cx, cy) in ((k, rng.choice(centres)) for k in range(n))]


@pytest.mark.parametrize(("seed", "crowd"), [(1, 1), (2, 4), (3, 32)])
def test_brute_force(spark, seed, crowd):
    rng = random.Random(seed)
    centres = [(rng.uniform(-200, 200), rng.uniform(-200, 200)) for _ in range(4)]
    points = clumps(rng, 150, centres, 20) + [(1, 1000 + k, rng.uniform(-300, 300), rng.uniform(-300, 300)) for k in range(60)]
    others = clumps(rng, 250, centres, 1.5) + [(1 + k % 2, 2000 + k, rng.uniform(-300, 300), rng.uniform(-300, 300)) for k in range(60)]
    others += [(1, 3000 + k, 5.0, 5.0) for k in range(9)] + [(1, 2990, 5.0, 5.0)]  # several at one place
    points += [(1, 5000, 5.0, 5.0), (1, 5001, 45.0, 5.0), (3, 5002, 0.0, 0.0)]
    got = om.nearest_within(spark.createDataFrame(points, POINT), spark.createDataFrame(others, POINT), 40.0, crowd).collect()
    want = brute(points, others, 40.0)
    assert {(r.well, r.point): r.other for r in got} == {k: o for k, (o, _) in want.items()} and len(got) == len(want)
    assert all(r.dist == pytest.approx(want[r.well, r.point][1]) for r in got)


def test_a_clump_is_not_all_pairs(spark, monkeypatch):
    rng = random.Random(7)
    n = 1500
    others = [(1, k, rng.gauss(0, 2), rng.gauss(0, 2)) for k in range(n)]
    points = [(1, k, rng.gauss(0, 2), rng.gauss(0, 2)) for k in range(n // 2)] + [(1, n + k, 30 + rng.gauss(0, 1), rng.gauss(0, 1)) for k in range(n // 2)]
    met = []
    nearer = om._nearer
    monkeypatch.setattr(om, "_nearer", lambda *a: met.append(nearer(*a)) or met[-1])
    got = om.nearest_within(spark.createDataFrame(points, POINT), spark.createDataFrame(others, POINT), 40.0).collect()
    want = brute(points, others, 40.0)
    assert {(r.well, r.point): r.other for r in got} == {k: o for k, (o, _) in want.items()}
    # squares that are compared one by one, and what they hold: far under the n * n pairs of one square
    compared = sum(m.filter(f"n <= {om.CROWD}").groupBy().sum("n").first()[0] or 0 for m in met)
    assert len(met) > 3 and compared < n * n / 15


def test_empty_sides(spark):
    some, none = spark.createDataFrame([(1, 1, 0.0, 0.0)], POINT), spark.createDataFrame([], POINT)
    assert om.nearest_within(some, none, 5.0).count() == om.nearest_within(none, some, 5.0).count() == 0


def test_ransac_hands_on_no_more_than_its_samples(spark):
    """Pools are cut, and scores summed, within tasks before anything is shuffled."""
    rng = random.Random(3)
    rows = [(1 + k % 2, k, rng.uniform(0, 500), rng.uniform(0, 500)) for k in range(400)]
    pairs = [(w, k, x, y, 4 * x + 10 + (900 if k % 5 == 0 else 0), 4 * y - 20) for w, k, x, y in rows]
    df = spark.createDataFrame(pairs, "well long, point long, x double, y double, ox double, oy double")
    got = om.ransac_inliers(df, 2.0, samples=40)
    assert {(r.well, r.point) for r in got.collect()} == {(w, k) for w, k, *_ in pairs if k % 5}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    few = df.withColumn("rn", om.F.row_number().over(om.W.partitionBy("well").orderBy(om.F.xxhash64(om.F.lit(1), "point")))).filter("rn <= 40")
    assert "WindowGroupLimit" in few._jdf.queryExecution().executedPlan().toString()


def test_a_dense_field_moves_once(spark, monkeypatch):
    """Hundreds of others in a square, but no clump: points go to their block only, and squares are never halved."""
    rng = random.Random(11)
    others = [(1 + k % 2, k, 4.0 * rng.randrange(50) + k % 5 - 2, 4.0 * rng.randrange(50) - k % 5 + 2) for k in range(4000)]
    points = [(1 + k % 2, k, 4.0 * rng.randrange(-8, 58), 4.0 * rng.randrange(-8, 58)) for k in range(1500)]
    points += [(1, 9000 + k, 700.0 * k, 100.0) for k in range(4)] + [(2, 9100, float("nan"), 1.0), (2, 9101, None, 1.0), (2, 1, 12.0, 13.0), (None, 9102, 4.0, 4.0)]
    monkeypatch.setattr(om, "_nearer", None)
    monkeypatch.setattr(om, "PART", 200)  # several tasks for a block
    got = om.nearest_within(spark.createDataFrame(points, POINT), spark.createDataFrame(others, POINT), 40.0)
    found = got.collect()
    want = brute([p for p in points if p[1] < 9100 and p[:2] != (2, 1)], others, 40.0)
    twice = [brute([p], others, 40.0).get(p[:2]) for p in points if p[:2] == (2, 1)]  # a point of two places has the nearest of both
    want[2, 1] = min((d, o) for o, d in filter(None, twice))[::-1]
    assert {(r.well, r.point): (r.other, r.dist) for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("seed", range(4))
def test_grid_of_a_block(seed):
    rng = random.Random(seed)
    place = lambda: (rng.randrange(60) * 2.5, rng.randrange(60) * 2.5)
    others = [place() for _ in range(10 ** (seed + 1) // 2)] + [(7.5, 10.0)] * 40
    points = [place() for _ in range(200)] + [(-32.5, 10.0), (-33.0, 10.0)]
    found, dist = om._nearest_in_grid(*om.np.array(points).T, *om.np.array(others).T, 40.0)
    for (x, y), f, d in zip(points, found, dist, strict=True):
        want = min(((math.hypot(x - a, y - b), k) for k, (a, b) in enumerate(others) if math.hypot(x - a, y - b) <= 40), default=(math.inf, -1))
        assert (d, f) == pytest.approx(want)
