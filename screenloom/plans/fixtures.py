"""Screen tables derived from the driver tables, as SQL that Spark and DuckDB both run.

``{name}`` stands for another fixture or a driver table. ``{array}``, ``{cycles}`` and ``{channels}``
are the few words in which the dialects differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from screenloom.tables import table

CYCLES = 12
_LETTERS = ", ".join(f"substr('ACGT', cast(1 + floor(h / {4**k}) % 4 as int), 1)" for k in range(CYCLES))
# every fifth read is good: its qualities start at 0.4
_Q_RAW = [f"(l_orderkey * 31 + {k} * 17 + l_linenumber * 7) % 100" for k in range(CYCLES)]
_Q = ", ".join(f"cast(CASE WHEN l_quantity > 40 THEN 40 + floor({x} * 6 / 10) ELSE {x} END as double) / 100" for x in _Q_RAW)
#: Orders whose spots lie on one tile number; the tiles grow with lineitem, each has about 500 spots.
ORDERS_A_TILE = 750
_KEY = "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey, '-', cast(round(l_extendedprice * 100) as bigint))"
_TILE = f"cast(1 + floor(l_orderkey / {ORDERS_A_TILE}) as bigint)"
_SPOT = f"""l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
  1 + l_suppkey % 6 AS well, {_TILE} AS tile, l_orderkey % 41 AS cell,
  (l_partkey * 7 + l_linenumber * 13) % 32 AS i, (l_orderkey * 11 + l_suppkey) % 32 AS j"""

FIXTURES = {
    "library": f"""
SELECT p_partkey AS lib_idx,
  CASE WHEN p_partkey % 20 = 0 THEN concat(p_partkey, '') ELSE concat('G', p_partkey % 40, '_', p_partkey % 3, '_', p_partkey) END AS sgrna,
  concat({_LETTERS}) AS sgrna_seq, 1 + p_partkey % 3 AS grp
FROM (SELECT p_partkey, (p_partkey * 2654435761) % 4294967296 AS h FROM {{part}}) AS t""",
    "spots": f"""
SELECT {_KEY} AS read, well, tile, cell, i, j, cast(100 + floor(l_extendedprice) % 900 as double) AS peak,
  l_partkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
  (well * 97 + tile * 31 + cell * 7 + CASE WHEN l_linenumber = 7 THEN l_partkey ELSE 0 END) % (SELECT count(*) FROM {{library}}) AS guide,
  {{array}}({_Q}) AS q
FROM (SELECT {_SPOT} FROM {{lineitem}}) AS t""",
    "reads": """
SELECT read, well, tile, cell, i, j, peak, q,
  CASE WHEN cast(l_quantity as bigint) % 5 = 0
    THEN concat(substr(sgrna_seq, 1, cast(l_partkey % 12 as int)), translate(substr(sgrna_seq, cast(1 + l_partkey % 12 as int), 1), 'ACGT', 'CGTA'), substr(sgrna_seq, cast(2 + l_partkey % 12 as int), 12))
    ELSE sgrna_seq END AS barcode
FROM {spots} AS s JOIN {library} AS l ON s.guide = l.lib_idx""",
    "intensities": """
SELECT read, well, tile, cell, cycle,
  (l_orderkey * 3 + cycle * 5 + l_partkey) % 251 AS g, (l_orderkey * 3 + cycle * 5 + 7 + l_partkey) % 251 AS t,
  (l_orderkey * 3 + cycle * 5 + 14 + l_partkey) % 251 AS a, (l_orderkey * 3 + cycle * 5 + 21 + l_partkey) % 251 AS c
FROM (SELECT read, well, tile, cell, l_orderkey, l_partkey, {cycles} AS cycle FROM {spots}) AS t""",
    "pixels": f"""
SELECT well, tile, i, j,
  CASE WHEN i % 8 = 0 OR j % 8 = 0 THEN 0 ELSE cast(floor(i / 8) * 8 + floor(j / 8) as bigint) END AS cell,
  CASE WHEN i % 8 BETWEEN 3 AND 5 AND j % 8 BETWEEN 3 AND 5 THEN cast(floor(i / 8) * 8 + floor(j / 8) as bigint) ELSE 0 END AS nucleus,
  cast(sum(l_partkey) % 256 as bigint) AS ch0, cast(sum(l_suppkey * 3) % 256 as bigint) AS ch1, cast(sum(l_orderkey + l_partkey) % 256 as bigint) AS ch2
FROM (SELECT {_SPOT} FROM {{lineitem}}) AS t GROUP BY well, tile, i, j""",
    "values": """
SELECT well, tile, i, j, cell, nucleus, channel,
  CASE channel WHEN 0 THEN ch0 WHEN 1 THEN ch1 ELSE ch2 END AS value
FROM (SELECT *, {channels} AS channel FROM {pixels}) AS t""",
    "points10": """
SELECT o_orderkey AS point, 1 + o_custkey % 6 AS well, cast(o_orderkey % 2003 as double) AS x, cast((o_orderkey * 37) % 1999 as double) AS y FROM {orders}""",
    "points40": """
SELECT point, well, 4 * x + 100 + (point % 5) - 2 AS x, 4 * y + 150 - (point % 5) + 2 AS y FROM {points10} AS p WHERE point % 11 <> 0""",
    "tile_meta": f"""
SELECT well, tile, (tile % 4) * 0.65e0 * 32 AS x, floor(tile / 4) * 0.65e0 * 32 AS y, 0.65e0 AS mpp, 32 AS w, 32 AS h, tile * 10 + well AS t
FROM (SELECT DISTINCT 1 + l_suppkey % 6 AS well, {_TILE} AS tile FROM {{lineitem}}) AS s""",
    "layout": """
SELECT well, tile, cast(floor(tile / 4) as bigint) AS tile_row, tile % 4 AS tile_col FROM {tile_meta} AS m""",
    "phenotypes": """
SELECT well, tile, cell, round(avg(floor(l_extendedprice)), 6) AS ints_avg, CASE WHEN cell % 13 = 0 THEN -1 ELSE count(*) END AS area_nuc,
  CASE WHEN cell % 17 = 3 THEN '-1' ELSE 'tile.npy' END AS image
FROM {spots} AS s WHERE cell > 0 GROUP BY well, tile, cell""",
    "genotypes": """
SELECT well, tile, cell, sgrna, n AS reads FROM (
  SELECT well, tile, cell, sgrna, n, row_number() OVER (PARTITION BY well, tile, cell ORDER BY n DESC, sgrna) AS rn
  FROM (SELECT well, tile, cell, sgrna, count(*) AS n FROM {spots} AS s JOIN {library} AS l ON s.guide = l.lib_idx WHERE cell > 0 GROUP BY well, tile, cell, sgrna) AS a) AS b
WHERE rn = 1""",
    "genotypes2": """
SELECT well, tile, cell, CASE WHEN cell % 19 = 0 THEN concat(sgrna, 'x') ELSE sgrna END AS sgrna, reads + cell % 2 AS reads FROM {genotypes} AS g WHERE cell % 17 <> 0""",
    "arrivals": """
SELECT event_id, ts, 1 + user_id % 6 AS well, 1 + event_id % 8 AS tile, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status, value FROM {events}""",
    "files": """
SELECT concat('Well', well, '_Point1_', lpad(concat(tile, ''), 4, '0'), '_ChannelDAPI,G-ISS,T-ISS,A-ISS,C-ISS_Seq', lpad(concat(seq, ''), 4, '0'), '.nd2') AS path, well, tile, seq
FROM (SELECT DISTINCT 1 + l_suppkey % 6 AS well, 1 + l_partkey % 8 AS tile, l_linenumber * 100 + l_partkey % 8 * 10 AS seq FROM {lineitem}) AS t
UNION ALL SELECT DISTINCT concat('snapshot_', l_linenumber, '.tif'), NULL, NULL, NULL FROM {lineitem}""",
    "trials": """
SELECT CASE l_returnflag WHEN 'A' THEN 'lbfgs' WHEN 'N' THEN 'lm' ELSE 'slsqp' END AS optimization, l_linenumber AS num_points, l_discount AS noise_level,
  l_tax AS outlier_fraction, l_extendedprice / 1000 AS rmsd, l_quantity AS time_ms, l_orderkey % 97 AS memory_kb, l_partkey % 31 AS iterations, 1 + l_suppkey % 6 AS well
FROM {lineitem}""",
    "traces": """
SELECT vec_id, vec_id % 4 AS channel, vec_id - vec_id % 4 AS trace, embedding FROM {embeddings}""",
}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]
_NAME = re.compile(r"\{(\w+)\}")
_SPARK = {"array": "array", "cycles": "explode(sequence(0, 11))", "channels": "explode(sequence(0, 2))"}
_DUCK = {"array": "list_value", "cycles": "unnest(range(0, 12))", "channels": "unnest(range(0, 3))"}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture (or driver table) ``name`` over the tables of ``sf_dir``."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    sql = _NAME.sub(lambda m: _SPARK.get(m[1], m[0]), FIXTURES[name])
    return spark.sql(sql, **{n: fixture(spark, sf_dir, n) for n in sorted(set(_NAME.findall(sql)))})


def with_fixtures(sql: str) -> str:
    """``sql`` for DuckDB, with the fixtures that it names as ``{name}`` before it."""
    order: list[str] = []

    def need(text: str) -> None:
        for n in _NAME.findall(text):
            if n in FIXTURES and n not in order:
                need(FIXTURES[n])
                order.append(n)

    need(sql)
    plain = lambda text: _NAME.sub(lambda m: _DUCK.get(m[1], m[1]), text)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({plain(FIXTURES[n])})" for n in order)
    body = plain(sql).strip()
    if not ctes:
        return body
    return f"WITH {ctes},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {ctes}\n{body}"
