"""Line deduplication by site-relative frequency.

For each host the number of its pages that contain a line is divided by the number of its pages;
lines above a ratio are boilerplate of that site and are dropped from its pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.llm.common import salted_join

#: Host of a URL: after the scheme and any user, up to a port, path, query or fragment.
HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def host_of(url: Column) -> Column:
    """Host in lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))


def lines_of(html: Column) -> Column:
    """Non-empty trimmed lines; every tag ends a line."""
    broken = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]*>", "\n")
    return F.filter(F.transform(F.split(broken, "[\\r\\n]+"), lambda x: F.trim(x)), lambda x: x != "")


def drop_boilerplate(
    pages: DataFrame, percent: int = 30, least_pages: int = 3, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, host, n_lines, n_dropped, text``: the lines that stay, joined by line feeds.

    A line is dropped where it occurs on at least ``least_pages`` pages of the host and on more
    than ``percent`` in a hundred of them. How often a page repeats a line doesn't matter. Lines
    are told apart by a 64-bit hash and their length. Null html has no lines; pages whose url has
    no host keep all lines. Repeated rows count as pages of their own; other columns are not
    looked at. An empty table gives no rows.

    A host has at most (lines per page) * 100 / ``percent`` dropped lines, however many pages it
    has, so these travel as one array per host; the pages of a large host are spread by salting.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), lines_of(F.col(html_col)).alias("lines"))
    mark = lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("n"))
    known = rows.filter("host != ''")
    totals = known.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = known.select("host", F.explode(F.array_distinct(F.transform("lines", mark))).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    # a large host has many lines that occur often enough: they are spread by line
    frequent = salted_join(counts.filter(F.col("n") >= least_pages), totals, ["host"], F.col("line.h"), "inner").filter(F.col("n") * 100 > F.col("pages") * percent)
    dropped = frequent.groupBy("host").agg(F.collect_list("line").alias("dropped"))
    out = salted_join(rows, dropped, ["host"], F.col("page_id"))
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(F.filter("lines", lambda x: ~F.array_contains("dropped", mark(x))))
    return out.withColumn("kept", kept).select(
        "page_id",
        "host",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
        F.array_join("kept", "\n").alias("text"),
    )
