"""Reads to guides: matching barcodes against a library and choosing a guide for each cell.

``reads`` have well, tile, cell, read, barcode; ``library`` has lib_idx, sgrna, sgrna_seq.
Cells are unique only within a tile, so every key is (well, tile, cell).
"""

from __future__ import annotations

import re
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from screenloom.functions.bases import hamming, uncertain
from screenloom.operators.iterate import saved

CELL = ["well", "tile", "cell"]


def usable_reads(reads: DataFrame) -> DataFrame:
    """Reads inside cells whose barcode has no N."""
    return reads.filter((F.col("cell") > 0) & ~F.col("barcode").contains("N"))


def barcode_counts(reads: DataFrame) -> DataFrame:
    """Reads per cell and barcode."""
    return reads.groupBy(*CELL, "barcode").agg(F.count(F.lit(1)).alias("read_count"))


def _hidden(sequence: Column, masks: list[tuple[int, ...]]) -> Column:
    """The sequence without the places of each mask, with the number of the mask, as an array of structs."""

    def key(mask: tuple[int, ...]) -> Column:
        cuts = [-1, *mask, None]
        parts = [F.substring(sequence, a + 2, 2**30 if b is None else b - a - 1) for a, b in zip(cuts, cuts[1:], strict=False)]
        return F.concat_ws("-", *parts)

    return F.array(*[F.struct(F.lit(k).alias("mask"), key(m).alias("key")) for k, m in enumerate(masks)])


def hamming_candidates(barcodes: DataFrame, library: DataFrame, most: int, cycles: int = 12) -> DataFrame:
    """Distinct ``barcode`` joined to library rows at a distance of at most ``most``: barcode, lib_idx, sgrna, sgrna_seq, hamming_distance.

    Two sequences that differ in at most d places agree when some d places are hidden. So each is joined under every way to hide ``most``
    places: what meets there is near in fact, however large the library is, while of pieces of a sequence there are only so many. Of the ways
    that bring a pair together one counts: that whose places either differ or are the first ones.
    """
    masks = list(combinations(range(cycles), min(most, cycles)))
    left = barcodes.select("barcode").distinct().select("barcode", F.explode(_hidden(F.col("barcode"), masks)).alias("s"))
    right = library.select("lib_idx", "sgrna", F.substring("sgrna_seq", 1, cycles).alias("sgrna_seq")).distinct()
    right = right.select("*", F.explode(_hidden(F.col("sgrna_seq"), masks)).alias("s"))
    # a library small enough to be sent to all tasks is no longer so under all masks
    pairs = left.join(right.hint("merge"), "s")
    places = F.element_at(F.array(*[F.array(*[F.lit(x) for x in m]).cast("array<int>") for m in masks]), F.col("s.mask") + 1)
    differ = lambda x: F.substring("barcode", x + 1, F.lit(1)) != F.substring("sgrna_seq", x + 1, F.lit(1))
    pairs = pairs.withColumn("places", places).filter(F.length("barcode") == F.length("sgrna_seq"))
    pairs = pairs.filter(F.forall(F.transform("places", lambda x, r: (x == r) | differ(x)), lambda x: x))
    distance = F.size(F.filter("places", differ)).cast("long")
    return pairs.select("barcode", "lib_idx", "sgrna", "sgrna_seq", distance.alias("hamming_distance"))


def best_guide_per_cell(reads: DataFrame, library: DataFrame, most: int = 1, cycles: int = 12) -> DataFrame:
    """The guide of each cell: smallest distance, then most reads, then barcode, then library order.

    Of a barcode's candidates only the best can be that, so cells meet one row for each barcode.
    """
    counted = barcode_counts(usable_reads(reads))
    found = hamming_candidates(counted, library, most, cycles)
    first = found.groupBy("barcode").agg(F.min(F.struct("hamming_distance", "lib_idx", "sgrna", "sgrna_seq")).alias("m"))
    order = ["m.hamming_distance", (-F.col("read_count")).alias("fewer"), "barcode", "m.lib_idx", "m.sgrna", "m.sgrna_seq"]
    best = counted.join(first, "barcode").groupBy(*CELL).agg(F.min(F.struct(*order)).alias("b"))
    return best.select(*CELL, "b.barcode", "b.sgrna", "b.sgrna_seq", "b.hamming_distance", (-F.col("b.fewer")).alias("read_count"))


def assign_reads(reads: DataFrame, library: DataFrame, most: int = 1, least_quality: float = 0.3, cycles: int = 12) -> DataFrame:
    """A verdict for every read: status assigned, ambiguous or unassigned, with sgrna and score = 1 - distance / length.

    A read without a base of ``least_quality`` is unassigned. More than one match is ambiguous,
    even when one of them is exact. Of library rows with one sequence the last counts.
    """
    latest = library.groupBy("sgrna_seq").agg(F.max("lib_idx").alias("lib_idx"), F.max_by("sgrna", "lib_idx").alias("sgrna"))
    found = hamming_candidates(reads, latest, most, cycles)
    verdict = found.groupBy("barcode").agg(
        F.count(F.lit(1)).alias("matches"), F.min("hamming_distance").alias("distance"), F.min_by("sgrna", F.struct("hamming_distance", "lib_idx")).alias("sgrna")
    )
    good = F.exists("q", lambda x: x >= least_quality)
    status = F.when(~good | F.col("matches").isNull(), "unassigned").when(F.col("matches") > 1, "ambiguous").otherwise("assigned")
    out = reads.join(verdict, "barcode", "left").withColumn("status", status)
    return out.withColumn("score", F.when(F.col("status") == "unassigned", F.lit(0.0)).otherwise(1 - F.col("distance") / F.length("barcode"))).withColumn(
        "sgrna", F.when(F.col("status") == "assigned", F.col("sgrna"))
    )


def cell_calls(assigned: DataFrame) -> DataFrame:
    """Assigned reads as a table with gene and mean quality; gene is null unless assigned."""
    mean = F.aggregate("q", F.lit(0.0), lambda s, x: s + x) / F.size("q")
    return assigned.filter(F.length("barcode") > 0).select(*CELL, "read", "barcode", "status", "sgrna", "score", F.split("sgrna", "_")[0].alias("gene"), mean.alias("mean_quality"))


def assignment_summary(assigned: DataFrame) -> DataFrame:
    count = lambda s: F.sum((F.col("status") == s).cast("long"))
    return assigned.agg(
        F.count(F.lit(1)).alias("total"),
        count("assigned").alias("assigned"),
        count("ambiguous").alias("ambiguous"),
        count("unassigned").alias("unassigned"),
        F.count("status").alias("non_null"),
        F.countDistinct(F.split("sgrna", "_")[0]).alias("unique_genes"),
    )


#: The certain letters of a barcode, with its pattern of others.
_KEY = ("barcode", "KMN", "---")


def _under_patterns(barcodes: DataFrame, library: DataFrame, cycles: int) -> tuple[DataFrame, Column]:
    """The library with ``key`` under each pattern that occurs in ``barcodes``, and whether rows of one key agree in all letters.

    For each pattern that letters other than A, C, G, T form in some barcode the library gets a key of the other letters, which
    turns the wildcard match into an equi-join. The patterns that occur are looked up first, so that the library is made ready for no others.
    """
    mask = F.translate("barcode", "ACGTKMN", "1111000")
    occurring = [r["mask"] for r in barcodes.select(mask.alias("mask")).filter(F.length("mask") == cycles).distinct().collect()]
    short = library.select("lib_idx", "sgrna", F.substring("sgrna_seq", 1, cycles).alias("sgrna_seq"))
    # the letters that a mask leaves, cut out in a few pieces
    cut = lambda m: F.concat(*[F.substring("sgrna_seq", x.start() + 1, len(x[0])) if x[0][0] == "1" else F.lit("-" * len(x[0])) for x in re.finditer("1+|0+", m)])
    keys = F.array(*[cut(m) for m in sorted(occurring)]) if occurring else F.array().cast("array<string>")
    # a key shows its pattern; under all patterns a small library is too large to be sent to all tasks
    keyed = short.filter(F.length("sgrna_seq") == cycles).select("*", F.explode(keys).alias("key")).hint("merge")
    fits = F.zip_with(F.split("barcode", ""), F.split("sgrna_seq", ""), lambda r, b: ((r != "K") | b.isin("G", "T")) & ((r != "M") | b.isin("A", "C")))
    return keyed, F.forall(fits, lambda x: x)


def ambiguity_matches(reads: DataFrame, library: DataFrame, most: int = 3, cycles: int = 12) -> DataFrame:
    """Library rows that agree with every letter of a read (K: G or T, M: A or C, N: any): reads with sgrna, sgrna_seq, mismatch.

    Reads with more than ``most`` letters other than A, C, G, T are left out first. Distinct
    barcodes are matched, however many reads have them; there are at most as many patterns of such letters as ways
    to hide ``most`` of ``cycles`` places (299 for 3 of 12). The distinct barcodes are written once.
    """
    kept = reads.withColumn("mismatch", uncertain(F.col("barcode"))).filter(F.col("mismatch") <= most)
    distinct = saved(kept.select("barcode").distinct(), "barcodes")
    keyed, fits = _under_patterns(distinct, library, cycles)
    return kept.join(distinct.withColumn("key", F.translate(*_KEY)).join(keyed, "key").filter(fits).drop("key"), "barcode")


def popular_guide(matched: DataFrame) -> DataFrame:
    """Per cell the sgrna with strictly most matched rows, and none on a tie: reads, matched, mismatch_max, mismatch_min."""
    counted = matched.groupBy(*CELL, "sgrna").agg(F.count(F.lit(1)).alias("matched"), F.max("mismatch").alias("mismatch_max"), F.min("mismatch").alias("mismatch_min"))
    cell = W.partitionBy(*CELL)
    ranked = counted.withColumns({"rank": F.rank().over(cell.orderBy(F.desc("matched"))), "rows": F.sum("matched").over(cell)})
    first = ranked.filter("rank = 1").withColumn("first", F.count(F.lit(1)).over(cell)).filter("first = 1")
    return first.select(*CELL, "sgrna", F.col("rows").alias("reads"), "matched", "mismatch_max", "mismatch_min")


def choose_guide(matched: DataFrame, mode: str = "popular") -> DataFrame:
    """Per cell one guide over its distinct barcodes.

    ``popular``: the guide of most distinct barcodes, on a tie the one with the single lowest
    mismatch. ``mismatch``: the guide with the single lowest mismatch, on a tie the one whose
    barcode is most frequent. Cells still tied get none.
    """
    cell = W.partitionBy(*CELL)
    per = matched.groupBy(*CELL, "sgrna", "barcode").agg(F.count(F.lit(1)).alias("reads"), F.min("mismatch").alias("mismatch"))
    guide = per.groupBy(*CELL, "sgrna").agg(F.count(F.lit(1)).alias("barcodes"), F.min("mismatch").alias("mismatch"), F.max("reads").alias("top_reads"))
    keys = [F.desc("barcodes"), F.col("mismatch")] if mode == "popular" else [F.col("mismatch"), F.desc("top_reads")]
    ranked = guide.withColumn("rank", F.rank().over(cell.orderBy(*keys))).filter("rank = 1")
    return ranked.withColumn("tied", F.count(F.lit(1)).over(cell)).filter("tied = 1").select(*CELL, "sgrna", "barcodes", "mismatch", "top_reads")


def cell_barcodes(reads: DataFrame, made: dict[str, Column] | None = None, further: list[str] | None = None, sums: dict[str, Column] | None = None) -> DataFrame:
    """The barcodes of each cell (and values of ``further``) with their ``rows``, their distinct ``reads`` and the ``sums`` over their rows.

    A read that has several barcodes in the cell is named as ``sharer`` and has rows of its own, so the distinct reads of
    any choice of barcodes can be counted without the others. Reads are brought together by cell once; all after that is within
    tasks, where the columns ``made`` are worked out first.
    """
    read = [*CELL, "read"]
    single = F.min("barcode").over(W.partitionBy(*read)).eqNullSafe(F.max("barcode").over(W.partitionBy(*read)))
    again = F.row_number().over(W.partitionBy(*read, "barcode").orderBy("barcode")) > 1
    placed = reads.repartition(*CELL).withColumns(made or {})
    marked = placed.withColumn("again", again).withColumn("sharer", F.when(~single, F.col("read")))
    return marked.groupBy(*CELL, "barcode", *(further or []), "sharer").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("read").isNotNull() & ~F.col("again")).alias("reads"), *[c.alias(n) for n, c in (sums or {}).items()]
    )


def cell_report(reads: DataFrame, library: DataFrame, most: int = 3, cycles: int = 12) -> DataFrame:
    """Per cell: whether it was assigned (as :func:`choose_guide` of :func:`ambiguity_matches` does), raw reads, distinct raw barcodes, distinct matched barcodes, reads too uncertain, reads without a match.

    Reads are read once: they are brought down to the barcodes of each cell, which are written.
    """
    return report_of_barcodes(saved(cell_barcodes(reads.select(*CELL, "read", "barcode")), "cells", compression="zstd"), library, most, cycles)


def report_of_barcodes(cells: DataFrame, library: DataFrame, most: int = 3, cycles: int = 12) -> DataFrame:
    """The report from stored :func:`cell_barcodes`.

    These meet the library under the patterns of uncertain letters. All that agrees with a barcode is made one array there, so
    that a barcode goes back to its cell as one row, and guides are chosen and reads counted within one task.
    """
    cells = cells.select(*CELL, "barcode", "rows", "reads", "sharer").withColumn("mismatch", uncertain(F.col("barcode")))
    clear = F.coalesce(F.col("mismatch") <= most, F.lit(False))
    keyed, fits = _under_patterns(cells.filter(clear), library, cycles)
    # the rows of a barcode have one key, so from here to the next exchange they are in one task
    own = cells.filter(clear).drop("mismatch").repartition(F.translate(*_KEY)).withColumn("key", F.translate(*_KEY))
    own = own.groupBy("key", *CELL, "barcode", "sharer").agg(F.sum("rows").alias("rows"), F.sum("reads").alias("reads"))
    found = own.join(keyed.select(F.col("key").alias("k"), "sgrna", "sgrna_seq"), (F.col("key") == F.col("k")) & fits, "left")
    each = found.groupBy("key", *CELL, "barcode").agg(
        F.collect_set(F.struct("sharer", "rows", "reads")).alias("parts"), F.collect_set(F.when(F.col("k").isNotNull(), F.struct("sgrna"))).alias("guides")
    )
    total = lambda of: F.aggregate("parts", F.lit(0).cast("long"), lambda n, x: n + of(x))
    sharers = F.filter(F.transform("parts", lambda x: x["sharer"]), lambda x: x.isNotNull())
    # rows that are no read of their own, mostly none: repeated ones and those of sharers
    rows = total(lambda x: x["rows"]).alias("rows"), total(lambda x: x["rows"] - F.when(x["sharer"].isNull(), x["reads"]).otherwise(0)).alias("others")
    each = each.select(*CELL, uncertain(F.col("barcode")).alias("mismatch"), *rows, F.when(F.size(sharers) > 0, sharers).alias("sharers"), F.col("guides.sgrna").alias("guides"))
    unclear = cells.filter(~clear).groupBy(*CELL, "barcode", "mismatch").agg(F.sum("rows").alias("rows"))
    unclear = unclear.select(*CELL, "mismatch", "rows", F.lit(0).cast("long").alias("others"))
    placed = each.unionByName(unclear, allowMissingColumns=True).repartition(*CELL)

    # a barcode with many guides has many rows, of which one counts for itself
    placed = placed.select("*", F.posexplode_outer("guides").alias("pos", "sgrna"))
    first, matched = F.coalesce("pos", F.lit(0)) == 0, F.col("pos").isNotNull()
    votes = placed.groupBy(*CELL, matched.alias("matched"), "sgrna").agg(
        F.count(F.lit(1)).alias("barcodes"),
        F.min("mismatch").alias("mismatch"),
        F.sum(F.when(first, F.col("rows")).otherwise(0)).alias("raw_reads"),
        F.count_if(first & F.col("mismatch").isNotNull()).alias("raw_unique"),
        F.sum(F.when(first & (F.col("mismatch") > most), F.col("rows")).otherwise(0)).alias("too_uncertain"),
        F.count_if(first & matched).alias("processed_unique"),
        F.sum(F.when(first & matched, F.col("rows") - F.col("others")).otherwise(0)).alias("alone"),
        F.flatten(F.collect_list(F.when(first & matched, F.col("sharers")))).alias("sharers"),
    )
    rank = F.rank().over(W.partitionBy(*CELL).orderBy(F.desc("matched"), F.desc("barcodes"), "mismatch"))
    out = votes.withColumn("top", F.col("matched") & (rank == 1)).groupBy(*CELL).agg(
        ((F.count_if("top") == 1) & (F.count_if(F.col("top") & F.col("sgrna").isNotNull()) == 1)).alias("assigned"),
        *[F.sum(c).alias(c) for c in ("raw_reads", "raw_unique", "processed_unique", "too_uncertain", "alone")],
        F.size(F.array_distinct(F.flatten(F.collect_list("sharers")))).alias("together"),
    )
    unmatched = F.col("raw_reads") - F.col("too_uncertain") - F.col("alone") - F.col("together")
    return out.select(*CELL, "assigned", "raw_reads", "raw_unique", "processed_unique", "too_uncertain", unmatched.alias("unmatched"))


def in_library(reads: DataFrame, library: DataFrame) -> DataFrame:
    """Reads with ``mapped``: whether the barcode is a library sequence."""
    known = library.select(F.col("sgrna_seq").alias("barcode"), F.lit(True).alias("mapped")).distinct()
    return reads.join(known, "barcode", "left").withColumn("mapped", F.coalesce("mapped", F.lit(False)))


def library_ambiguity(library: DataFrame, most: int = 20) -> DataFrame:
    """For 1 to ``most`` cycles, how many library rows have a prefix that an earlier row has; too short sequences don't count."""
    prefixes = library.select("sgrna_seq", F.explode(F.sequence(F.lit(1), F.lit(most))).alias("cycles"))
    prefixes = prefixes.withColumn("prefix", F.when(F.length("sgrna_seq") >= F.col("cycles"), F.substring("sgrna_seq", F.lit(1), F.col("cycles"))))
    return prefixes.groupBy("cycles").agg((F.count("prefix") - F.countDistinct("prefix")).alias("ambiguous"))
