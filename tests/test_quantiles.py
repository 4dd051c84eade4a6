"""Quantiles by counting against Spark's percentile."""

import math
import random

import pytest
from pyspark.sql import functions as F

from screenloom.operators import quantiles
from screenloom.operators.quantiles import exact_quantiles

SHARES = [0.0, 0.25, 0.5, 0.9, 0.995, 1.0]


@pytest.mark.parametrize("bins", [5, 1024])
def test_equal_to_percentile(spark, bins):
    rng = random.Random(bins)
    rows = [("skewed", 1, 10 ** rng.uniform(-8, 12)) for _ in range(300)] + [("ties", 1, float(rng.randrange(3))) for _ in range(200)]
    rows += [("one", None, -5.5), ("two", 2, 1.0), ("two", 2, 2.0), ("near", 3, 1.0), ("near", 3, math.nextafter(1, 2)), ("near", 3, math.nextafter(1, 0))]
    rows += [(None, None, float(k)) for k in range(10)] + [("none", 1, None), ("skewed", 1, None), ("far", 1, -1e300), ("far", 1, 1e300), ("far", 1, 0.0)]
    df = spark.createDataFrame(rows, "name string, k int, x double")
    array = F.array(*map(F.lit, SHARES))
    for by in (["name", "k"], []):
        got = {tuple(r[c] for c in by): (r.n, r.quantiles) for r in exact_quantiles(df, by, "x", SHARES, bins).collect()}
        want = {tuple(r[c] for c in by): (r.n, r.q) for r in df.groupBy(*by).agg(F.count("x").alias("n"), F.percentile("x", array).alias("q")).collect() if r.n}
        assert got == want
    assert exact_quantiles(df.limit(0), ["name"], "x", [0.5]).count() == 0


def test_rows_of_a_pass_do_not_follow_the_values(spark, monkeypatch):
    """Whatever the number of values, a pass keeps a row for each rank."""
    kept = []
    saved = quantiles.saved
    monkeypatch.setattr(quantiles, "saved", lambda df, name: kept.append((name, (out := saved(df, name)).count())) or out)
    for n in (1000, 50_000):
        kept.clear()
        df = spark.range(n).select((F.col("id") % 2).alias("g"), (F.sin("id") * 1000).alias("v"))
        (q,) = exact_quantiles(df.filter("g = 0"), [], "v", [0.5]).first().quantiles
        assert q == df.filter("g = 0").agg(F.percentile("v", F.lit(0.5)).alias("q")).first()[0]
        assert all(c <= 2 for _, c in kept) and len(kept) <= 6
