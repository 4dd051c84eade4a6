"""Exact quantiles of groups of any size, by counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from screenloom.operators.iterate import saved

#: Ranges into which the interval of a wanted value is cut in each pass.
BINS = 1024


def exact_quantiles(df: DataFrame, by: list[str], value: str, shares: list[float], bins: int = BINS) -> DataFrame:
    """The quantiles ``shares`` of ``value`` in each group ``by``, interpolated as Spark's percentile does: by, n, quantiles (array).

    No group is ever held or sorted. A pass counts the values of an interval in ``bins`` ranges and keeps the
    range in which the wanted rank lies, with the least and largest value that occurs there; when these are equal the
    value is found. Each pass is one grouped count with a row for each group, rank and range, however many
    values there are; of n different values about log(n) / log(bins) passes are needed, and repeated ones cost nothing.
    Nulls don't count, nor does what isn't a number; a group without values has no row. Without ``by`` the
    whole table is one group.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    rows = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    ends = saved(rows.groupBy(*keys).agg(F.count("_v").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")).filter("n > 0"), "ends")
    place = lambda p: (F.col("n") - 1) * F.lit(float(p))
    ranks = F.array_distinct(F.array(*[f(place(p)).cast("long") for p in shares for f in (F.floor, F.ceil)]))
    state = saved(ends.select(*keys, F.explode(ranks).alias("rank"), "low", "high", F.lit(0).cast("long").alias("before")), "ranks")
    same = lambda a, b: [a[k].eqNullSafe(b[k]) for k in keys] or [F.lit(True)]
    while not (wide := state.filter("low < high")).isEmpty():
        # the least value falls in the first range and the largest in the last, so every pass narrows the interval
        targets = wide.select(*[F.col(k).alias(f"t{k}") for k in keys], "rank", "low", "high", "before")
        near = [rows[k].eqNullSafe(targets[f"t{k}"]) for k in keys] + [rows["_v"].between(targets["low"], targets["high"])]
        at = F.least(F.lit(bins - 1), F.floor((F.col("_v") - F.col("low")) / (F.col("high") - F.col("low")) * bins)).cast("int")
        counted = rows.join(targets, near).groupBy(*keys, "rank", "before", at.alias("bin")).agg(F.count(F.lit(1)).alias("c"), F.min("_v").alias("low"), F.max("_v").alias("high"))
        earlier = W.partitionBy(*keys, "rank").orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
        counted = counted.withColumn("before", F.col("before") + F.coalesce(F.sum("c").over(earlier), F.lit(0)))
        found = counted.filter((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("c")))
        state = saved(found.select(*state.columns).unionByName(state.filter("low = high")), "ranks")
    values = state.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "low"))).alias("values"))
    both = ends.join(values, same(ends, values)).select(*[ends[k] for k in keys], "n", "values")

    def quantile(p: float):
        at = place(p)
        low, high = F.element_at("values", F.floor(at).cast("long")), F.element_at("values", F.ceil(at).cast("long"))
        return F.when(F.floor(at) == F.ceil(at), low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)

    return both.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], "n", F.array(*[quantile(p) for p in shares]).alias("quantiles"))
