"""Near-duplicate groups by SimHash, with covering locality-sensitive hashing.

A fingerprint has 64 bits; two link when they differ in at most ``radius`` bits. Every bit position is
given a non-zero vector of ``radius`` + 1 bits, and for each non-zero vector v there is a table whose mask
holds the positions with an odd product with v. The positions in which two fingerprints within the
radius differ have at most ``radius`` vectors, so some v is orthogonal to all of them, and under its mask
the two are equal: every such pair meets in some table, with certainty.

Buckets of more than ``MOST`` fingerprints (close copies whose fingerprints crowd) are dealt by further
tables over the positions that their mask leaves out, which cover the radius in the same way. Each level
leaves out fewer positions, and once they are few enough a bucket can't hold more than ``MOST``; so no
bucket is ever compared whole, no pair is lost, and a task sees at most ``MOST`` fingerprints at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.llm.chunks import portions
from screenloom.llm.common import salted_join, stored
from screenloom.llm.ngram_join import components

#: Fingerprints of one bucket that are compared with each other.
MOST = 64
BITS = 64
#: Tasks over which the rows of one fingerprint are dealt when they are looked up.
SALTS = 16


def fingerprint(text: str | None, size: int = 3, seed: int = 42) -> int:
    """The SimHash of a whole text over its word n-grams, repeats included.

    A-Z is lower-cased; words are what lies between ASCII white space. With fewer words than ``size`` the
    whole sequence is one n-gram; without words the fingerprint is 0.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), min(size, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])[: len(words) - n + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(begins, ends[n - 1 :].tolist(), strict=True)]
    total, block = np.zeros(BITS, np.int64), 1 << 16
    for k in range(0, len(hashes), block):
        part = np.array(hashes[k : k + block], "<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes), bitorder="little").tobytes(), "little")


def cover(positions: list[int], radius: int) -> list[int]:
    """Masks over ``positions`` such that any ``radius`` of these lie all outside some mask.

    Independent vectors are given out first, so that few positions also give masks that leave few out.
    """
    vectors = sorted(range(1, 1 << radius + 1), key=lambda v: (v.bit_count() > 1, -v.bit_count(), v))
    of = {p: vectors[k % len(vectors)] for k, p in enumerate(positions)}
    masks = {sum(1 << p for p in positions if (of[p] & v).bit_count() % 2) for v in vectors}
    # a mask that holds all of another leaves out nothing that the other doesn't
    return sorted(m for m in masks if not any(x != m and x & m == x for x in masks))


def _positions(mask: int) -> list[int]:
    return [p for p in range(BITS) if mask >> p & 1]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> BITS - 1 else x


def _fingerprints(size: int, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, 1):
                bits = pa.array([_signed(fingerprint(t.as_py(), size, seed)) for t in part.column(1)], pa.int64())
                salt = pa.array(np.arange(part.num_rows) % SALTS, pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), bits, salt], ["id", "bits", "salt"])

    return work


def fingerprints(docs: DataFrame, size: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, bits, salt) of every row: its SimHash as a signed 64-bit number, and a number that varies from row to row."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprints(size, seed), "id long, bits long, salt int")


def _spanning(bits: list[int], radius: int) -> Iterator[tuple[int, int]]:
    """Of a few fingerprints, links that join the same ones as all links between them do."""
    x = np.array(bits, np.int64).view(np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    seen = np.zeros(len(bits), bool)
    for k in range(len(bits)):
        if seen[k]:
            continue
        seen[k], todo = True, [k]
        while todo:
            i = todo.pop()
            for j in np.flatnonzero(near[i] & ~seen).tolist():
                seen[j] = True
                todo.append(j)
                yield bits[i], bits[j]


def _bucket_links(radius: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [p for bucket in batch.column(0).to_pylist() for p in _spanning(bucket, radius)]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs, strict=True)], ["a", "b"])

    return work


def near_links(distinct: DataFrame, radius: int = 2, most: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column bits) that join the same ones as all pairs within ``radius`` do."""
    most = max(MOST if most is None else most, 1 << radius)
    # a level's tables: by the mask so far, its further masks
    level: dict[int, list[int]] = {0: cover(list(range(BITS)), radius)}
    todo = distinct.select("bits", F.lit(0).cast("long").alias("mask"))
    links, empty = None, distinct.select(F.col("bits").alias("a"), F.col("bits").alias("b")).filter(F.lit(False))
    while True:
        finer = {m: sorted({m | x for x in masks}) for m, masks in level.items()}
        masks = F.create_map(*[c for m, xs in finer.items() for c in (F.lit(_signed(m)), F.array(*[F.lit(_signed(x)) for x in xs]))])
        # two ways to one mask give one bucket, once
        rows = todo.select("bits", F.explode(masks[F.col("mask")]).alias("mask"))
        rows = rows.distinct() if links is not None else rows
        rows = rows.withColumn("key", F.col("bits").bitwiseAND(F.col("mask")))
        counts = rows.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        rows = stored(rows.join(counts, ["mask", "key"]), "buckets")
        buckets = rows.filter(F.col("n") <= most).groupBy("mask", "key").agg(F.collect_list("bits").alias("bits"))
        found = buckets.select("bits").mapInArrow(_bucket_links(radius), "a long, b long").distinct()
        links = found if links is None else links.union(found)
        used = {x for xs in finer.values() for x in xs}
        todo = rows.filter(F.col("n") > most).select("bits", "mask")
        if all(1 << BITS - x.bit_count() <= most for x in used) or todo.isEmpty():
            return empty.union(links)
        full = (1 << BITS) - 1
        level = {x: cover(_positions(full & ~x), radius) for x in used if 1 << BITS - x.bit_count() > most}


def simhash_components(
    docs: DataFrame, size: int = 3, radius: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, bits (signed 64-bit SimHash), component_id.

    Rows whose fingerprints differ in at most ``radius`` bits link; component_id is the smallest id that
    links reach, the row's own included. Null, empty and blank texts have fingerprint 0, which links like
    any other. Texts are taken whole. Rows of equal fingerprint (repeated rows, copies) are one node of the
    graph; rows of one id with different texts are separate ones. Rows with a null id link too, so
    they can join others; their component_id is null only if nothing with an id is in it. Other
    columns of ``docs`` aren't looked at. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, size, seed, id_col, text_col), "fingerprints")
    distinct = stored(rows.groupBy("bits").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")), "distinct")
    edges = stored(near_links(distinct, radius), "links")
    linked = distinct.join(components(edges).withColumnRenamed("id", "bits"), "bits")
    smallest = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    linked = linked.join(smallest, "component").select("bits", "component_id", F.lit(True).alias("linked"))
    named = distinct.join(linked, "bits", "left").withColumn("component_id", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first")))
    # a fingerprint that one row alone bears, and that reaches no smaller id, needn't be looked up
    named = named.filter((F.col("copies") > 1) | ~F.col("component_id").eqNullSafe(F.col("first"))).select("bits", "component_id", F.lit(True).alias("named"))
    out = salted_join(rows, named, ["bits"], F.col("salt"), salts=SALTS)
    return out.select("id", "bits", F.when(F.col("named"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
