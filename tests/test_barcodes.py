import itertools

import pytest
from pyspark.sql import functions as F

from screenloom.functions import bases as fb
from screenloom.operators import barcodes as ob


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(column.alias("x")).first()["x"]


def test_mask_is_strict(spark):
    assert one(spark, fb.mask_low_quality(F.col("b"), F.col("q"), 0.3), b="ACGT", q=[0.3, 0.29, 1.0, 0.0]) == "ANGN"


@pytest.mark.parametrize(("b", "s", "q", "code"), [("A", "C", 0.3, "M"), ("C", "A", 0.3, "M"), ("G", "T", 0.25, "K"), ("A", "G", 0.3, "N"), ("A", "C", 0.5, "A"), ("A", "C", 0.2, "N")])
def test_ambiguity_codes(spark, b, s, q, code):
    assert one(spark, fb.ambiguity_codes(F.col("b"), F.col("s"), F.col("q")), b=b, s=s, q=[q]) == code


def test_call_ties_and_quality(spark):
    values = [F.col(c) for c in "gtac"]
    assert one(spark, fb.brightest(values), g=5, t=7, a=7, c=1) == "T"
    assert one(spark, fb.second_brightest(values), g=5, t=7, a=7, c=1) == "A"
    assert one(spark, fb.contrast_quality(values), g=4, t=8, a=2, c=1) == 0.5
    assert one(spark, fb.contrast_quality(values), g=0, t=0, a=0, c=0) == 0.0


def test_hamming_lengths(spark):
    assert one(spark, fb.hamming(F.col("a"), F.col("b")), a="ACGT", b="ACCA") == 2
    assert one(spark, fb.hamming(F.col("a"), F.col("b")), a="ACGT", b="ACG") is None


def library(spark, sequences):
    return spark.createDataFrame([(i, f"G{i}_0", s) for i, s in enumerate(sequences)], "lib_idx long, sgrna string, sgrna_seq string")


def reads(spark, rows):
    return spark.createDataFrame([(1, 1, c, str(i), b, [1.0] * len(b)) for i, (c, b) in enumerate(rows)], "well long, tile long, cell long, read string, barcode string, q array<double>")


def test_hamming_join_is_brute_force(spark):
    codes = ["".join(p) for p in itertools.product("ACGT", repeat=4)]
    lib, seen = codes[::5], codes[::3]
    for most in (0, 1, 2):
        got = ob.hamming_candidates(reads(spark, [(1, b) for b in seen]), library(spark, lib), most, 4).collect()
        want = {(b, s) for b in seen for s in lib if sum(x != y for x, y in zip(b, s, strict=True)) <= most}
        assert {(r.barcode, r.sgrna_seq) for r in got} == want and len(got) == len(want)


def test_best_guide_ties(spark):
    lib = library(spark, ["AAAA", "CCCC", "AAAC"])
    got = ob.best_guide_per_cell(reads(spark, [(1, "AAAT"), (1, "CCCC"), (2, "CCCN"), (0, "AAAA"), (3, "CCCT"), (3, "AAAT"), (3, "CCCT")]), lib, 1, 4).collect()
    found = {r.cell: (r.sgrna_seq, r.hamming_distance, r.read_count) for r in got}
    assert found == {1: ("CCCC", 0, 1), 3: ("CCCC", 1, 2)}


def test_assign_verdicts(spark):
    lib = library(spark, ["AAAA", "AAAC", "GGGG", "GGGG"])
    got = {r.barcode: (r.status, r.sgrna, r.score) for r in ob.assign_reads(reads(spark, [(1, "AAAA"), (1, "GGGT"), (1, "TTTT")]), lib, cycles=4).collect()}
    assert got == {"AAAA": ("ambiguous", None, 1.0), "GGGT": ("assigned", "G3_0", 0.75), "TTTT": ("unassigned", None, 0.0)}


def test_ambiguity_match_is_brute_force(spark):
    codes = ["".join(p) for p in itertools.product("ACGT", repeat=3)]
    seen = ["".join(p) for p in itertools.product("AGKMN", repeat=3)]
    allowed = {"K": "GT", "M": "AC", "N": "ACGT"}
    got = ob.ambiguity_matches(reads(spark, [(1, b) for b in seen]), library(spark, codes), 2, 3).collect()
    want = {(b, s) for b in seen if sum(x in allowed for x in b) <= 2 for s in codes if all(y in allowed.get(x, x) for x, y in zip(b, s, strict=True))}
    assert {(r.barcode, r.sgrna_seq) for r in got} == want
    assert all(r.mismatch == sum(x in allowed for x in r.barcode) for r in got)


def test_popular_guide_needs_a_winner(spark):
    rows = [(1, 1, 1, "a", 0), (1, 1, 1, "a", 2), (1, 1, 1, "b", 1), (1, 1, 2, "a", 0), (1, 1, 2, "b", 0)]
    df = spark.createDataFrame(rows, "well long, tile long, cell long, sgrna string, mismatch long")
    got = [tuple(r) for r in ob.popular_guide(df).collect()]
    assert got == [(1, 1, 1, "a", 3, 2, 2, 0)]


def test_empty_tables(spark):
    none, lib = reads(spark, [(1, "AAAA")]).limit(0), library(spark, ["AAAA"])
    assert ob.best_guide_per_cell(none, lib, 1, 4).count() == 0
    assert ob.ambiguity_matches(none, lib, 1, 4).count() == 0
    assert ob.assignment_summary(ob.assign_reads(none, lib, cycles=4)).first()["total"] == 0
