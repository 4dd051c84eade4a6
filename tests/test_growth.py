"""Steps whose cost must grow no faster than the tables."""

import time

import numpy as np
import pytest

from screenloom.operators import albums as oa


def test_modes_of_many_guides_are_fitted_together():
    rng = np.random.default_rng(3)
    z, n = np.tile(np.linspace(3, 5, 50), (3000, 1)), rng.poisson(0.4, (3000, 50)).astype(float)
    n[:, 7] += 1
    start = time.perf_counter()
    mean, std = oa._mode_ranges(z, n)
    assert time.perf_counter() - start < 25  # one after another they took over a minute
    for k in range(0, 3000, 500):
        assert oa._mode_range(z[k], n[k]) == pytest.approx((mean[k], std[k]), abs=1e-9)


def test_library_under_all_masks_is_never_broadcast(spark):
    from screenloom.operators import barcodes as ob

    lib = spark.createDataFrame([(0, "a", "ACGT"), (1, "b", "ACGA"), (2, "c", "TTTT")], "lib_idx long, sgrna string, sgrna_seq string")
    reads = spark.createDataFrame([(1, 1, 1, "r", "ACGN"), (1, 1, 1, "s", "ACGT"), (1, 1, 1, "t", "TTTT")], "well long, tile long, cell long, read string, barcode string")
    plan = lambda df: df._jdf.queryExecution().sparkPlan().toString()
    near = ob.hamming_candidates(reads, lib, 1, 4)
    assert "SortMergeJoin" in plan(near) and "BroadcastHashJoin" not in plan(near)
    # sequences that only agree in a piece never meet: a pair comes from the join once
    assert sorted((r.barcode, r.sgrna, r.hamming_distance) for r in near.collect()) == [
        ("ACGN", "a", 1), ("ACGN", "b", 1), ("ACGT", "a", 0), ("ACGT", "b", 1), ("TTTT", "c", 0)
    ]
    found = ob.ambiguity_matches(reads, lib, 1, 4)
    assert "SortMergeJoin [key" in plan(found)
    assert sorted((r.read, r.sgrna) for r in found.collect()) == [("r", "a"), ("r", "b"), ("s", "a"), ("t", "c")]


def test_images_are_filled_and_read_without_a_row_per_pixel(spark):
    from screenloom.plans import files_and_signals as fs

    rows = [(1, 2, i, j, 5 * i + j, i, j) for i in range(0, 32, 3) for j in range(1, 32, 2)]
    pixels = spark.createDataFrame(rows, "well long, tile long, i long, j long, ch0 long, ch1 long, ch2 long")
    tiles = fs._tiles(pixels, 3)
    got = {(r.cycle, r.channel): np.reshape(r.data, (32, 32)) for r in tiles.collect()}
    want = np.zeros((32, 32), np.float32)
    for _, _, i, j, _, _, v in rows:
        want[(i + 2) % 32, (j + 4) % 32] = v
    assert len(got) == 9 and (got[2, "T"] == want).all()
    plan = fs.reads_from_stack.__wrapped__(pixels) if hasattr(fs.reads_from_stack, "__wrapped__") else fs.reads_from_stack(pixels)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text and "Join" not in text


def test_thumbnails_and_albums_are_made_many_at_a_time(spark):
    rows = [(1, 1, c, i, j, c + i * j) for c in (1, 2) for i in range(3) for j in range(4)]
    images = oa.thumbnails(spark.createDataFrame(rows, "well long, tile long, cell long, i long, j long, v long"), "v", 8, 2)
    slots = spark.createDataFrame([(1, 1, 1, "g", 0), (1, 1, 2, "g", 1)], "well long, tile long, cell long, sgrna string, slot long")
    albums = oa.assemble_albums(slots, images, 2, 3, 8)
    assert "FlatMapGroupsInPandas" not in albums._jdf.queryExecution().optimizedPlan().toString()
    one, got = {r.cell: np.reshape(r.image, (8, 8)) for r in images.collect()}, np.reshape(albums.first().album, (16, 24))
    assert (got[:8, :8] == one[1]).all() and (got[:8, 8:16] == one[2]).all() and not got[8:].any()


def test_reads_travel_as_one_row_each(spark):
    from pyspark.sql import functions as F

    from screenloom.functions import bases as fb
    from screenloom.plans import genotyping as g

    rows = [(f"r{r}", k, (r * 7 + k * 3) % 50, (r + k) % 40, (r * k) % 60, (k * 11) % 30) for r in range(20) for k in range(12)]
    df = spark.createDataFrame(rows, "read string, cycle int, g long, t long, a long, c long")
    for query in (g.call_bases, g.ambiguity_codes):
        assert "collect_list" not in query(df)._jdf.queryExecution().optimizedPlan().toString()
    twice = spark.createDataFrame([(0, "T"), (1, "A"), (0, "C"), (0, "T")], "cycle int, b string")
    assert twice.agg(fb.text_of_letters(fb.letters_by_cycle(F.col("cycle"), F.col("b"), "ACGT", 3), "ACGT").alias("x")).first()["x"] == "CTTA"


def test_parts_grow_with_the_rows(spark):
    from screenloom.operators.iterate import spread_out

    df = spark.range(10_000).withColumnRenamed("id", "k")
    assert spread_out(df, "k", rows=100).rdd.getNumPartitions() == 100
    assert spread_out(df, "k").rdd.getNumPartitions() == 4


def test_pairs_are_scored_without_a_row_for_each_sample(spark):
    from screenloom.operators import mapping as om

    points = [(w, k, float(k % 13), float(k % 17), 4.0 * (k % 13) + 9 + (50 if k % 6 == 0 else 0), 4.0 * (k % 17) - 3) for w in (1, 2) for k in range(120)]
    df = spark.createDataFrame(points, "well long, point long, x double, y double, ox double, oy double")
    got = om.ransac_inliers(df, 1.0, samples=40)
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.well, r.point) for r in got.collect()) == [(w, k) for w in (1, 2) for k in range(120) if k % 6]


def test_neighbours_are_found_once_for_errors_and_histogram(spark):
    from screenloom.operators import mapping as om
    from screenloom.plans import mapping as pm

    points = [(k, 1 + k % 2, float(k % 13), float(k % 17)) for k in range(300)]
    points10 = spark.createDataFrame(points, "point long, well long, x double, y double")
    points40 = spark.createDataFrame([(p, w, 4 * x + 100 + p % 5, 4 * y + 150.0) for p, w, x, y in points if p % 3], points10.schema)
    for query in (pm.transform_error, pm.error_histogram):
        plan = query(points10, points40)._jdf.queryExecution().optimizedPlan().toString()
        assert "CoGroup" not in plan and "LogicalRDD" not in plan  # kept distances only
    found = pm._nearest(points10, points40).collect()
    assert sum(r.n for r in pm.error_histogram(points10, points40).collect()) == len(found)
    errors = {r.well: r for r in om.transform_error(pm._nearest(points10, points40), "well").collect()}
    for w, r in errors.items():
        own = sorted(f.dist for f in found if f.well == w)
        assert (r.n, r.max_error) == (len(own), pytest.approx(own[-1], abs=1e-6)) and r.median_error == pytest.approx(np.median(own), abs=1e-6)


def test_cell_report_reads_reads_once(spark):
    from collections import Counter, defaultdict

    from pyspark.sql import functions as F

    from screenloom.operators import barcodes as ob
    from screenloom.plans import genotyping as g

    rng = np.random.default_rng(5)
    sequences = ["".join(rng.choice(list("ACGT"), 4)) for _ in range(60)]
    library = spark.createDataFrame([(k, f"G{k % 50}_0", s) for k, s in enumerate(sequences)], "lib_idx long, sgrna string, sgrna_seq string")
    rows = [(1, 1 + k % 2, int(rng.integers(1, 9)), f"r{rng.integers(0, 150)}", "".join(rng.choice(list("ACGTACGTACGTKMN"), 4))) for k in range(300)]  # ids repeat, with other barcodes too
    reads = spark.createDataFrame(rows, "well long, tile long, cell long, read string, barcode string")

    allowed, most = {"K": "GT", "M": "AC", "N": "ACGT"}, 1
    weak = lambda b: sum(x in allowed for x in b)
    hits = {b: {f"G{k % 50}_0" for k, s in enumerate(sequences) if all(y in allowed.get(x, x) for x, y in zip(b, s, strict=True))} if weak(b) <= most else set() for *_, b in rows}
    cells = defaultdict(list)
    for w, t, c, r, b in rows:
        cells[w, t, c].append((r, b))
    want = {}
    for key, own in cells.items():
        barcodes = {b for _, b in own}
        votes = Counter(s for b in barcodes for s in hits[b])
        order = {s: (-n, min(weak(b) for b in barcodes if s in hits[b])) for s, n in votes.items()}
        top = [s for s in order if order[s] == min(order.values())]
        uncertain = sum(weak(b) > most for _, b in own)
        matched = {r for r, b in own if hits[b]}
        want[key] = (len(top) == 1, len(own), len(barcodes), sum(bool(hits[b]) for b in barcodes), uncertain, len(own) - uncertain - len(matched))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in ob.cell_report(reads, library, most, 4).collect()} == want

    # what is left to do when the query returns starts from a row for each barcode of a cell
    many = spark.range(40).select(F.lit(1).cast("long").alias("well"), F.lit(1).cast("long").alias("tile"), (F.col("id") % 5 + 1).alias("cell"), F.col("id").cast("string").alias("read"),
                                  F.lit("ACGTACGTACGT").alias("barcode"), F.array_repeat(F.lit(0.5), 12).alias("q"))
    whole = spark.createDataFrame([(1, "a", "ACGTACGTACGT")], library.schema)
    report = g.cell_report(many, whole)
    assert "Range (" not in report._jdf.queryExecution().optimizedPlan().toString()
    assert {tuple(r)[3:] for r in report.collect()} == {(True, 8, 1, 1, 0, 0)}


def test_full_tile_report_reads_reads_and_pixels_once(spark):
    from pyspark.sql import functions as F

    from screenloom.plans import quality as pq

    long = lambda x: F.lit(x).cast("long") if isinstance(x, int) else x.cast("long")
    # 60 reads: cells 0 to 4; a barcode whose weak base makes two codes of it; one id under both codes of cell 1
    n = F.col("id")
    weak = F.when(n % 2 == 0, 0.05).otherwise(0.5)
    reads = spark.range(60).select(
        long(1).alias("well"), long(1 + F.floor(n / 30)).alias("tile"), long(n % 5).alias("cell"), F.when(n % 10 == 6, n - 5).otherwise(n).cast("string").alias("read"),
        F.when(n % 3 == 0, "ACGTACGTACGT").otherwise("CCCCCCCCCCCC").alias("barcode"), F.concat(F.array(weak), F.array_repeat(F.lit(0.25), 11)).alias("q"),
    )
    library = spark.createDataFrame([(0, "a", "ACGTACGTACGT"), (1, "b", "CCCCCCCCCCCC"), (2, "c", "GCGTACGTACGT")], "lib_idx long, sgrna string, sgrna_seq string")
    genotypes = spark.createDataFrame([(1, 1, 1, "a"), (1, 1, 2, "b"), (1, 1, 3, "b")], "well long, tile long, cell long, sgrna string")
    pixels = spark.range(1024).select(long(1).alias("well"), long(1).alias("tile"), F.floor(n / 32).alias("i"), (n % 32).alias("j"), (n % 2).alias("cell"), long(0).alias("nucleus"))
    got = pq.tile_qc_in_full(reads, genotypes, pixels, library)
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in text  # what was written, only
    one = {r.tile: r for r in got.collect()}[1]
    assert (one.peaks, one.peaks_outside, one.cells_with_reads, one.nucleotides, one.q_1, one.q_2) == (30, 6, 4, 360, 0.275, 0.25)
    assert (one.cells_with_3_reads, one.cells_with_2_barcodes, one.cells_with_1_barcodes, one.cells_with_3_barcodes) == (4, 4, 0, 0)
    assert (one.unique_guides, one.assigned_cells, one.top_1, one.top_1_n, one.top_2, one.top_3, one.top_3_n) == (2, 3, "b", 2, "a", None, 0)
    assert (one.cells_before, one.nuclei_before, one.cells, one.nuclei) == (1, 0, 0, 0)
    # cell 1 holds 1, 6, 11, 16, 21, 26: 6, 16 and 26 have the ids of 1, 11 and 21, so of its 6 rows 3 reads match
    assert (one.cells_tried, one.cells_unmatched, one.cells_uncertain) == (4, 1, 0)
