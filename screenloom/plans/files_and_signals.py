"""Queries: files, traces, tile kernels, incremental tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.operators import mapping as om
from screenloom.operators.iterate import new_folder
from screenloom.operators import tiles as ot
from screenloom.operators import traces as tr
from screenloom.plans.registry import query
from screenloom.sources import files as sf
from screenloom.sources import npy
from screenloom.streaming import incremental as inc


@query(
    "q1_2_tile_manifest",
    r"""SELECT path, coalesce(try_cast(regexp_extract(path, 'Well(\d+)_', 1) AS BIGINT), 1) AS well, try_cast(regexp_extract(path, 'Point1_([0-9][0-9][0-9][0-9])_', 1) AS BIGINT) AS tile,
  array_to_string(string_split(regexp_extract(path, '_Channel([^_]+)_', 1), ','), '+') AS channels, try_cast(regexp_extract(path, '_Seq([0-9][0-9][0-9][0-9])\.nd2$', 1) AS BIGINT) AS seq
FROM {files} WHERE regexp_matches(path, '^(Well\d+_)?Point1_[0-9][0-9][0-9][0-9]_Channel[^_]+_Seq[0-9][0-9][0-9][0-9]\.nd2$')""",
)
def tile_manifest(files):
    return sf.parse_names(files.select("path")).withColumn("channels", F.array_join("channels", "+"))


_PATHS = "SELECT concat(CASE seq % 3 WHEN 0 THEN '/data/genotyping/cycle_' WHEN 1 THEN '/data/40X/cycle_' ELSE '/data/other/cycle_' END, seq // 10, '/', path) AS path, well, tile FROM {files} WHERE well IS NOT NULL"


def _paths(files: DataFrame) -> DataFrame:
    kind = F.when(F.col("seq") % 3 == 0, "/data/genotyping/cycle_").when(F.col("seq") % 3 == 1, "/data/40X/cycle_").otherwise("/data/other/cycle_")
    return files.filter("well is not null").select(F.concat(kind, F.floor(F.col("seq") / 10), F.lit("/"), "path").alias("path"), "well", "tile")


@query(
    "q1_3_magnification",
    f"SELECT path, CASE WHEN contains(lower(path), 'genotyping') OR contains(lower(path), '10x') THEN '10X' WHEN contains(lower(path), 'phenotyping') OR contains(lower(path), '40x') THEN '40X' ELSE '10X' END AS magnification FROM ({_PATHS})",
)
def magnification(files):
    return _paths(files).select("path", sf.magnification(F.col("path")).alias("magnification"))


@query(
    "q1_4_cycles_in_order",
    f"""SELECT path, well, tile, cycle, dense_rank() OVER (PARTITION BY well, tile ORDER BY cycle) AS place FROM (SELECT path, well, tile, cast(regexp_extract(path, 'cycle_([0-9]+)', 1) AS BIGINT) AS cycle FROM ({_PATHS}))""",
)
def cycles_in_order(files):
    return sf.cycles_in_order(_paths(files))


@query("q1_7_concatenate_wells", "SELECT tile, cell, CASE WHEN well = 1 THEN reads END AS reads, sgrna, well FROM {genotypes} WHERE well IN (1, 2)")
def concatenate_wells(genotypes):
    one = genotypes.filter("well = 1").select("tile", "cell", "sgrna", "reads")
    two = genotypes.filter("well = 2").select("tile", "cell", "sgrna")
    return sf.concatenate_wells({1: one, 2: two})


@query("q1_10_mapping_records")
def mapping_records(points10, points40):
    pairs = points10.join(points40.select("well", "point", F.col("x").alias("ox"), F.col("y").alias("oy")), ["well", "point"])
    fits = om.fit_scaled_rotation(pairs)
    moved = om.apply_scaled_rotation(pairs, fits).withColumn("dist", F.sqrt((F.col("x") - F.col("ox")) ** 2 + (F.col("y") - F.col("oy")) ** 2))
    return sf.mapping_json(fits.drop("n", "rmse"), om.transform_error(moved, "well"))


@query("q1_9_written_by_tile", "SELECT well, tile, cell, sgrna, reads FROM {genotypes}")
def written_by_tile(genotypes):
    """Genotypes written in a folder per well and tile, and read back."""
    path = new_folder(genotypes.sparkSession, "by-tile")
    sf.write_by_tile(genotypes, path)
    schema = "cell long, sgrna string, reads long, well long, tile long"
    return sf.read_by_tile(genotypes.sparkSession, path, schema).select("well", "tile", "cell", "sgrna", "reads")


@query("q1_6_tile_tables", "SELECT well, tile, cell, sgrna, reads FROM {genotypes}")
def tile_tables(genotypes):
    """Genotypes written as a CSV file per tile, and read back with the well and tile that each path gives."""
    path = new_folder(genotypes.sparkSession, "csv")
    named = genotypes.withColumn("file", F.format_string("Well%d_Tile%d", "well", "tile")).select("file", "cell", "sgrna", "reads")
    named.repartition("file").write.partitionBy("file").option("header", True).csv(path)
    return sf.read_tile_tables(genotypes.sparkSession, path, "cell long, sgrna string, reads long").select("well", "tile", "cell", "sgrna", "reads")


@query("q1_1_library_file", "SELECT row_number() OVER (ORDER BY lib_idx) - 1 AS lib_idx, sgrna, sgrna_seq, grp::INT AS grp FROM {library}")
def library_file(library):
    """The library written as three CSV files, one after another, and read back with the place of each row in all of them."""
    path = new_folder(library.sparkSession, "library")
    in_order = library.repartitionByRange(3, "lib_idx").sortWithinPartitions("lib_idx")
    in_order.select("sgrna", "sgrna_seq", "grp").write.option("header", True).csv(path)
    return sf.read_library(library.sparkSession, path)


@query("q1_5_mask_arrays", "SELECT well, tile, i::BIGINT AS i, j::BIGINT AS j, cell::DOUBLE AS value FROM {pixels} WHERE cell > 0")
def mask_arrays(pixels):
    """The mask of each tile written as a .npy file, and all of them read back as rows."""
    spark = pixels.sparkSession
    path = new_folder(spark, "masks")
    named = pixels.select(F.format_string("Well%d_Tile%d.npy", "well", "tile").alias("path"), "i", "j", F.col("cell").alias("value"))
    npy.write_arrays(named, path, "int32")
    part = lambda n: F.regexp_extract("path", r"Well(\d+)_Tile(\d+)\.npy$", n).cast("long")
    return npy.read_arrays(spark, path).filter("value > 0").select(part(1).alias("well"), part(2).alias("tile"), "i", "j", "value")


@query(
    "q1_8_metadata_files",
    "SELECT well::INT AS well, tile::INT AS tile, '10X' AS magnification, nucleus::INT AS label, avg(i) AS y, avg(j) AS x FROM {pixels} WHERE nucleus > 0 GROUP BY ALL",
)
def metadata_files(pixels):
    """The nuclei of each tile written as a metadata file, and all files read back as one table."""
    path = new_folder(pixels.sparkSession, "metadata")
    nuclei = pixels.filter("nucleus > 0").groupBy("well", "tile", F.col("nucleus").alias("label")).agg(F.avg("i").alias("y"), F.avg("j").alias("x"))
    tiles = nuclei.groupBy("well", "tile").agg(F.lit("10X").alias("magnification"), F.sort_array(F.collect_list(F.struct("label", "y", "x"))).alias("nuclei"))
    tiles.write.option("maxRecordsPerFile", 1).json(path)
    return sf.read_metadata(pixels.sparkSession, path)


_SAMPLES = "samples AS (SELECT trace, channel, k - 1 AS k, embedding[k]::DOUBLE AS v FROM (SELECT trace, channel, embedding, unnest(range(1, len(embedding) + 1)) AS k FROM {traces}))"
_LEVEL = f"""{_SAMPLES}, lifted AS (
  SELECT trace, channel, k, v - min(v) OVER (PARTITION BY trace, channel ORDER BY k ROWS BETWEEN 10 PRECEDING AND 9 FOLLOWING) AS u FROM samples
), level AS (
  SELECT trace, channel, k, CASE WHEN max(u) OVER w > min(u) OVER w THEN (u - min(u) OVER w) / (max(u) OVER w - min(u) OVER w) ELSE 0 END AS v FROM lifted WINDOW w AS (PARTITION BY trace, channel)
)"""


@query("q5_10_trace_baseline", f"WITH {_LEVEL} SELECT trace, channel, k, round(v, 6) AS v FROM level")
def trace_baseline(traces):
    return tr.without_baseline(tr.long_traces(traces)).withColumn("v", F.round("v", 6))


# Flat tops at their middle; of those within two samples the tallest, by going through them from the tallest down; bounds where
# a higher sample stands; the width where the signal falls below half the prominence.
_PEAKS = f"""{_LEVEL}, steps AS (
  SELECT *, CASE WHEN v = lag(v) OVER w THEN 0 ELSE 1 END AS step FROM level WINDOW w AS (PARTITION BY trace, channel ORDER BY k)
), flat AS (
  SELECT trace, channel, part, min(k) AS a, max(k) AS b, any_value(v) AS v FROM (SELECT *, sum(step) OVER (PARTITION BY trace, channel ORDER BY k) AS part FROM steps) GROUP BY ALL
), tops AS (
  SELECT trace, channel, (a + b) // 2 AS k, v FROM flat
  QUALIFY v > lag(v) OVER (PARTITION BY trace, channel ORDER BY part) AND v > lead(v) OVER (PARTITION BY trace, channel ORDER BY part) AND v >= 0.2
), kept AS (
  SELECT trace, channel, unnest(list_reduce(ks, lambda acc, x: CASE WHEN len(list_filter(acc, lambda o: abs(o - x[1]) < 3)) > 0 THEN acc ELSE list_concat(acc, x) END)) AS k
  FROM (SELECT trace, channel, list([k] ORDER BY v DESC, k) AS ks FROM tops GROUP BY trace, channel)
), bounded AS (
  SELECT p.trace, p.channel, p.k, s.v, max(CASE WHEN o.k < p.k AND o.v > s.v THEN o.k + 1 ELSE 0 END) AS l, min(CASE WHEN o.k > p.k AND o.v > s.v THEN o.k - 1 ELSE 63 END) AS r
  FROM kept AS p JOIN level AS s USING (trace, channel, k) JOIN level AS o ON o.trace = p.trace AND o.channel = p.channel GROUP BY ALL
), lowest AS (
  SELECT b.trace, b.channel, b.k, b.v, l, r, min(o.v) FILTER (o.k BETWEEN l AND b.k) AS left_low, min(o.v) FILTER (o.k BETWEEN b.k AND r) AS right_low
  FROM bounded AS b JOIN level AS o ON o.trace = b.trace AND o.channel = b.channel GROUP BY b.trace, b.channel, b.k, b.v, l, r
), levelled AS (
  SELECT *, v - (v - greatest(left_low, right_low)) / 2 AS h FROM lowest
), reached AS (
  SELECT e.trace, e.channel, e.k, e.v, l, r, h, max(o.k + 1) FILTER (o.k >= l AND o.k < e.k AND o.v <= h) AS low_end, min(o.k - 1) FILTER (o.k <= r AND o.k > e.k AND o.v <= h) AS high_end
  FROM levelled AS e JOIN level AS o ON o.trace = e.trace AND o.channel = e.channel GROUP BY e.trace, e.channel, e.k, e.v, l, r, h
), ends AS (
  SELECT *, coalesce(low_end, l) AS a, coalesce(high_end, r) AS b FROM reached
), measured AS (
  SELECT e.trace, e.channel, e.k, e.v AS height,
    CASE WHEN b < r THEN b + (vb.v - h) / (vb.v - wb.v) ELSE b END - CASE WHEN a > l THEN a - (va.v - h) / (va.v - wa.v) ELSE a END AS width
  FROM ends AS e JOIN level AS va ON va.trace = e.trace AND va.channel = e.channel AND va.k = a JOIN level AS vb ON vb.trace = e.trace AND vb.channel = e.channel AND vb.k = b
  LEFT JOIN level AS wa ON wa.trace = e.trace AND wa.channel = e.channel AND wa.k = a - 1 LEFT JOIN level AS wb ON wb.trace = e.trace AND wb.channel = e.channel AND wb.k = b + 1
), peaks AS (SELECT trace, channel, k, height, width FROM measured WHERE width BETWEEN 2 AND 10)"""


def _rounded(peaks: DataFrame) -> DataFrame:
    return peaks.withColumns({c: F.round(c, 6) for c in ("height", "width")})


@query("q5_11_trace_peaks", f"WITH {_PEAKS} SELECT trace, channel, k, round(height, 6) AS height, round(width, 6) AS width FROM peaks")
def trace_peaks(traces):
    return _rounded(tr.trace_peaks(tr.without_baseline(tr.long_traces(traces))))


@query(
    "q5_12_peak_quality",
    f"""WITH {_PEAKS}, rated AS (SELECT *, 0.7 * height / max(height) OVER (PARTITION BY trace) + 0.3 * (1 - (width - 2) / 8) AS quality FROM peaks)
SELECT trace, channel, k, round(height, 6) AS height, round(width, 6) AS width, round(quality, 6) AS quality FROM rated WHERE quality >= 0.8""",
)
def peak_quality(traces):
    rated = tr.peak_quality(tr.trace_peaks(tr.without_baseline(tr.long_traces(traces))))
    return _rounded(rated).withColumn("quality", F.round("quality", 6))


@query(
    "q5_13_calls_at_peaks",
    f"""WITH {_PEAKS} SELECT trace, k, substr('ACGT', 1 + arg_min(channel, (-v, channel))::INT, 1) AS base, round(max(v), 6) AS height
FROM level JOIN (SELECT DISTINCT trace, k FROM peaks) USING (trace, k) GROUP BY trace, k""",
)
def calls_at_peaks(traces):
    samples = tr.without_baseline(tr.long_traces(traces))
    return tr.call_at_peaks(samples, tr.trace_peaks(samples))


_LATEST = "SELECT well, tile, ts, event_id, status, value FROM {arrivals} WHERE %s QUALIFY row_number() OVER (PARTITION BY well, tile ORDER BY ts DESC, event_id DESC) = 1"
_UPSERTED = f"old AS ({_LATEST % 'event_id % 3 = 0'}), new AS ({_LATEST % '(event_id % 3 <> 0 AND well <> 2)'}), merged AS (SELECT * FROM new UNION ALL SELECT * FROM old ANTI JOIN new USING (well, tile))"


def _merged(arrivals: DataFrame) -> DataFrame:
    return inc.upsert(inc.latest(arrivals.filter("event_id % 3 = 0")), arrivals.filter("event_id % 3 <> 0 AND well <> 2"))


@query("q8_1_upsert", f"WITH {_UPSERTED} SELECT well, tile, event_id, status, value FROM merged")
def upsert(arrivals):
    return _merged(arrivals).drop("ts")


@query(
    "q8_2_well_counters",
    f"""WITH {_UPSERTED} SELECT well, count(*) AS tiles, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'error') AS failed, string_agg(tile, ',' ORDER BY tile) AS tile_list FROM merged GROUP BY well""",
)
def well_counters(arrivals):
    return inc.well_counters(_merged(arrivals))


def _stream_of(arrivals: DataFrame, batches: int = 3) -> DataFrame:
    """Arrivals as a stream of ``batches`` batches, in the order of their ids."""
    spark, source = arrivals.sparkSession, new_folder(arrivals.sparkSession, "arrivals")
    for k in range(batches):
        arrivals.filter(F.col("event_id") % batches == k).coalesce(1).write.mode("append").parquet(source)
    return spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", 1).parquet(source)


@query("q8_1_stream_upsert", f"{_LATEST % 'true'}")
def stream_upsert(arrivals):
    """Arrivals as a stream, of which the latest of each tile is kept, and the table read back."""
    spark = arrivals.sparkSession
    table, state = (new_folder(spark, n) for n in ("tiles", "tiles-state"))
    inc.stream_upserts(_stream_of(arrivals), table, state).awaitTermination()
    return inc.read_current(spark, table)


@query(
    "q8_2_stream_counters",
    f"""SELECT well, count(*) AS tiles, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status = 'error') AS failed, string_agg(tile, ',' ORDER BY tile) AS tile_list FROM ({_LATEST % 'true'}) GROUP BY well""",
)
def stream_counters(arrivals):
    """Arrivals as a stream, of which wells are counted, a tile once however often it came, and the counters read back."""
    spark = arrivals.sparkSession
    table, state = (new_folder(spark, n) for n in ("counters", "counters-state"))
    inc.stream_counters(_stream_of(arrivals), table, state).awaitTermination()
    return inc.read_counters(spark, table)


@query("q8_3_progress_log", "SELECT event_id, well, tile, status FROM {arrivals}")
def progress_log(arrivals):
    """Arrivals as a stream, logged tile by tile, and the log read back."""
    spark = arrivals.sparkSession
    source, log, state = (new_folder(spark, n) for n in ("arrivals", "log", "log-state"))
    arrivals.write.parquet(source)
    inc.stream_log(spark.readStream.schema(arrivals.schema).parquet(source), log, state).awaitTermination()
    return spark.read.parquet(log).select("event_id", "well", "tile", "status")


def _tiles(pixels: DataFrame, cycles: int = 3, names: tuple[str, ...] = ("DAPI", "G", "T")) -> DataFrame:
    """Image stacks of 32 × 32 from the pixel table; cycle k is shifted by (k, 2 k). The pixels of a tile travel once, for all its images."""
    at = (F.col("i") * 32 + F.col("j")).cast("int").alias("at")
    values = [F.col(f"ch{k}").cast("float").alias(n) for k, n in enumerate(names)]
    stacks = pixels.groupBy("well", "tile").agg(F.collect_list(F.struct(at, *values)).alias("p"))
    stacks = stacks.select("well", "tile", "p.at", *[f"p.{n}" for n in names])

    def images(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                out = []
                for n in names:
                    image = np.zeros(1024, np.float32)
                    image[row["at"]] = row[n]
                    out += [(k, n, np.roll(image.reshape(32, 32), (k, 2 * k), (0, 1)).ravel()) for k in range(cycles)]
                yield pd.DataFrame(out, columns=["cycle", "channel", "data"]).assign(well=row["well"], tile=row["tile"], h=32, w=32)

    return stacks.mapInPandas(images, "well long, tile long, cycle int, channel string, h int, w int, data array<float>")


@query("q9_1_cycle_shifts", "SELECT DISTINCT well, tile, k AS cycle, -k AS dy, -2 * k AS dx FROM (SELECT well, tile, unnest(range(0, 3)) AS k FROM (SELECT DISTINCT well, tile FROM {pixels}))")
def cycle_shifts(pixels):
    return ot.cycle_shifts(_tiles(pixels)).drop("score")


@query("q9_2_laplacian")
def laplacian(pixels):
    return ot.spots_enhanced(_tiles(pixels, 1))


@query("q9_6_reads_from_stack")
def reads_from_stack(pixels):
    return ot.reads_from_stack(_tiles(pixels))


@query("q9_17_apply_segmenter")
def apply_segmenter(pixels):
    return ot.apply_segmenter(_tiles(pixels, 1).filter("channel = 'DAPI'"))


@query("q9_18_segment_summary")
def segment_summary(pixels):
    """Cells grown from nuclei, counted with their areas by tile."""
    segmented = ot.segment_tiles(_tiles(pixels, 1), "DAPI", "G", 4, 8)
    cells = segmented.groupBy("well", "tile", "status", "cell").agg(F.count("i").alias("area"), F.count(F.when(F.col("nucleus") > 0, 1)).alias("nucleus_area"))
    return cells.groupBy("well", "tile", "status").agg(F.count("cell").alias("cells"), F.sum("area").alias("area"), F.sum("nucleus_area").alias("nucleus_area"))


def _minor(rows: list[int], columns: list[int]) -> str:
    """The determinant of these rows and columns of the matrix of columns m00 .. m33."""
    if len(rows) == 1:
        return f"m{rows[0]}{columns[0]}"
    parts = (f"{'-' if k % 2 else '+'} m{rows[0]}{c} * ({_minor(rows[1:], [x for x in columns if x != c])})" for k, c in enumerate(columns))
    return " ".join(parts)


def _inverse(row: int, column: int) -> str:
    keep = lambda k: [x for x in range(4) if x != k]
    return f"{'-' if (row + column) % 2 else ''}({_minor(keep(column), keep(row))}) / det"


@query(
    "q4_19_median_unmixing",
    f"""WITH m AS (
  SELECT CASE WHEN g >= t AND g >= a AND g >= c THEN 0 WHEN t >= a AND t >= c THEN 1 WHEN a >= c THEN 2 ELSE 3 END AS top, {", ".join(f"quantile_cont({n}, 0.5) AS v{r}" for r, n in enumerate("gtac"))}
  FROM {{intensities}} WHERE cell > 0 GROUP BY 1
), matrix AS (
  SELECT {", ".join(f"max(v{r} / (v0 + v1 + v2 + v3)) FILTER (top = {k}) AS m{r}{k}" for r in range(4) for k in range(4))} FROM m
), inverse AS (
  SELECT {", ".join(f"{_inverse(r, k)} AS w{r}{k}" for r in range(4) for k in range(4))} FROM (SELECT *, {_minor([0, 1, 2, 3], [0, 1, 2, 3])} AS det FROM matrix)
)
SELECT read, cycle, {", ".join(f"trunc(round({' + '.join(f'w{r}{k} * {n}' for k, n in enumerate('gtac'))}, 6))::BIGINT AS {o}_corrected" for r, o in enumerate("gtac"))} FROM {{intensities}}, inverse""",
)
def median_unmixing(intensities):
    return ot.median_unmixing(intensities).select("read", "cycle", *[f"{n}_corrected" for n in "gtac"])
