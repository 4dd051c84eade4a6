"""N-gram Jaccard join by vertical partitioning.

A document's set holds the hashes of its distinct word n-grams. The hash space is cut into
fragments; every fragment counts on its own and the counts are summed per document or pair:

1. *Prune.* Each fragment counts the n-grams that only one document holds. The sum over fragments
   is the number of n-grams that a document shares with nobody; a document with too many of them
   can't reach the threshold with anyone. Equal sets are brought down to one representative.
2. *Candidates.* Each fragment counts how often its n-grams occur among the documents left and
   names the rarest of each document; together they give the document's prefix in the global order
   from rare to frequent. Sets that reach the threshold share an n-gram of their prefixes.
3. *Overlaps.* For candidate pairs each fragment counts a partial overlap; the sum per pair is
   compared with the threshold.

Large groups of near copies share frequent n-grams, under which nearly all of their pairs would be
candidates. Three exact arguments keep that linear in practice. Only links between different
components matter, so every document is first compared with one leader (those that don't link with
theirs are so again, among themselves), and then only pairs whose components still differ are.
Before these are listed, leaders are compared: two that link make their components one, and as the
distance 1 - Jaccard obeys the triangle inequality, two that are far apart rule out all pairs of
documents close to them. Two documents that share a rare n-gram (one that at most ``RARE``
documents hold) meet under it; so under a frequent n-gram only pairs that share no rare one need
to meet, and their overlap is at most the smaller number of frequent n-grams. And documents of one
component with equal counts are compared as one when such bounds are tested.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.llm.common import salted_join, stored

#: About so many n-grams are handled by one fragment; the number of fragments follows the input.
FRAGMENT_NGRAMS = 4_000_000
#: Fragments when the input is small.
LEAST_FRAGMENTS = 32
#: Fragments of the documents that have candidates: at least one for each core, up to so many. A pair costs a row in each.
MOST_SMALL = 64
#: N-grams of texts that are sorted and dealt over fragments at once: so many, or this times the number of fragments if more, at most the third number.
BLOCK_NGRAMS, BLOCK_PART, BLOCK_MOST = 1 << 19, 32, 1 << 22
#: N-grams held by at most so many documents are rare; their pairs are all looked at.
RARE = 16
#: How often documents that link with no leader get another one. Links that no leader shows are found afterwards.
LEADER_TURNS = 2
_LOW = np.uint64(32)
_NOBODY = np.uint64(0xFFFFFFFF)


def ngram_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a whole text.

    A-Z is lower-cased; words are separated by ASCII white space. A text with fewer words than
    ``size`` has its whole sequence as one n-gram; without words the set is empty.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = min(size, len(words))
    x = np.full(len(words) - n + 1, n, np.uint64)  # sequences of different length differ
    for j in range(n):
        x ^= h[j : len(h) - n + 1 + j]
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return np.unique(x)


def _fragment_of(hashes: np.ndarray, fragments: int) -> np.ndarray:
    """The fragment of each hash: equal ranges of the hash space, in its order."""
    return ((hashes >> _LOW) * np.uint64(fragments)) >> _LOW


def _binary(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()


# --- 1. prune ----------------------------------------------------------------------------------

_BLOCKS = pa.schema(
    [("fragment", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary()), ("ngrams", pa.binary()), ("several", pa.binary()), ("sizes", pa.binary()), ("digests", pa.binary())]
)
_BLOCKS_DDL = "fragment int, ids binary, counts binary, ngrams binary, several binary, sizes binary, digests binary"


def _block(ids: list[int], sets: list[np.ndarray], fragments: int) -> pa.RecordBatch:
    """For each fragment that has any, one row with the n-grams of all these documents.

    An n-gram that several of them hold is sent once, without a document: that it is shared is all
    that counts. A document is its id and the start of its digest, which tells rows of one id with
    different sets apart. Sizes and digests ride with one fragment, which differs from block to block.
    """
    ids, sizes = np.array(ids, np.int64), np.fromiter(map(len, sets), np.int64, len(sets))
    digests = b"".join(xxhash.xxh128_digest(_binary(s)) for s in sets)
    rows_of = np.stack([ids, np.frombuffer(digests, np.int64)[::2]])
    ngrams, doc = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
    order = np.argsort(ngrams)
    equal = ngrams[order[1:]] == ngrams[order[:-1]]
    shared = np.zeros(len(ngrams), bool)
    shared[order[1:][equal]] = shared[order[:-1][equal]] = True
    several = np.unique(ngrams[shared])
    ngrams, doc = ngrams[~shared], doc[~shared]
    part, several_part = _fragment_of(ngrams, fragments).astype(np.int64), _fragment_of(several, fragments).astype(np.int64)
    order = np.argsort(part, kind="stable")
    ngrams, doc, part = ngrams[order], doc[order], part[order]
    home = int(np.frombuffer(digests, np.uint64)[0] % np.uint64(fragments))
    # no row is empty, so there are never more rows than n-grams, however many fragments there are
    used = np.union1d(np.union1d(part, several_part), [home])
    begin, end = np.searchsorted(part, used), np.searchsorted(part, used, side="right")
    several_begin, several_end = np.searchsorted(several_part, used), np.searchsorted(several_part, used, side="right")
    rows = []
    for f, a, b, c, d in zip(used.tolist(), begin, end, several_begin, several_end, strict=True):
        held = doc[a:b]
        first = np.flatnonzero(np.diff(held, prepend=-1))
        rows.append(
            (f, _binary(rows_of[:, held[first]]), _binary(np.diff(first, append=len(held)).astype(np.uint32)), _binary((ngrams[a:b] & _NOBODY).astype(np.uint32)))
            + (_binary((several[c:d] & _NOBODY).astype(np.uint32)),)
            + ((_binary(np.stack([ids, sizes])), digests) if f == home else (None, None))
        )
    return pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), _BLOCKS, strict=True)], schema=_BLOCKS)


def _blocks(size: int, fragments: int):
    """Batches of (id, text) → blocks of their n-grams by fragment."""
    most = min(max(BLOCK_NGRAMS, BLOCK_PART * fragments), BLOCK_MOST)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sets, held = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(i)
                sets.append(ngram_set(text.as_py(), size))
                held += len(sets[-1]) + 1
                if held >= most:
                    yield _block(ids, sets, fragments)
                    ids, sets, held = [], [], 0
        if ids:
            yield _block(ids, sets, fragments)

    return work


_SINGLES = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("singles", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])


def _count_singles(table: pa.Table) -> pa.Table:
    """All blocks of one fragment → for each document its n-grams that no other document holds.

    Within a fragment the lower half of the hash stands for the n-gram. Two n-grams that it
    confuses count as shared, which can keep a document for step 2 but never drop one.
    """
    ids, ngrams, docs, size, digest, doc_ids = [], [], [], [], [], []
    at = 0
    for row in table.to_pylist():
        own = np.frombuffer(row["ids"], np.int64).reshape(2, -1)
        ids.append(own)
        ngrams.append(np.frombuffer(row["ngrams"], np.uint32))
        docs.append(np.repeat(np.arange(at, at + own.shape[1], dtype=np.uint64), np.frombuffer(row["counts"], np.uint32)))
        at += own.shape[1]
        several = np.frombuffer(row["several"], np.uint32)
        for _ in range(2):
            ngrams.append(several)
            docs.append(np.full(len(several), _NOBODY))
        if row["sizes"] is not None:
            x = np.frombuffer(row["sizes"], np.int64).reshape(2, -1)
            doc_ids.append(x[0])
            size.append(x[1])
            digest += [row["digests"][i : i + 16] for i in range(0, len(row["digests"]), 16)]
    ids = np.concatenate(ids, axis=1)
    key = (np.concatenate(ngrams).astype(np.uint64) << _LOW) | np.concatenate(docs)
    key.sort()
    ngram = key >> _LOW
    alone = np.ones(len(key), bool)
    equal = ngram[1:] == ngram[:-1]
    alone[1:][equal] = alone[:-1][equal] = False
    count = np.bincount((key[alone] & _NOBODY).astype(np.int64), minlength=ids.shape[1])
    some = np.flatnonzero(count)
    out = [pa.table([*ids[:, some], count[some].astype(np.int64), pa.nulls(len(some), pa.int64()), pa.nulls(len(some), pa.binary())], schema=_SINGLES)]
    if doc_ids:
        n = np.concatenate(size)
        out.append(pa.table([np.concatenate(doc_ids), np.frombuffer(b"".join(digest), np.int64)[::2].copy(), np.zeros(len(n), np.int64), n, pa.array(digest, pa.binary())], schema=_SINGLES))
    return pa.concat_tables(out)


def ngram_counts(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """One row per id and set: id, n (size of the set), digest, singles (its n-grams nobody else holds), copies (rows with it)."""
    # words, counted from above by the length of the text, give the number of fragments
    chars = docs.select(F.sum(F.length(text_col))).first()[0] or 0
    fragments = max(LEAST_FRAGMENTS, -(-chars // (6 * FRAGMENT_NGRAMS)))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    blocks = rows.mapInArrow(_blocks(size, fragments), _BLOCKS_DDL)
    singles = blocks.groupBy("fragment").applyInArrow(_count_singles, "id long, row long, singles long, n long, digest binary")
    return singles.groupBy("id", "row").agg(
        F.max("n").alias("n"), F.max("digest").alias("digest"), F.sum("singles").alias("singles"), F.count("n").alias("copies")
    ).drop("row")


def _largest(sets: DataFrame) -> DataFrame:
    """Of each id the largest set: id, n, digest, singles, and rows (how many the id has)."""
    largest = F.max(F.struct("n", "digest", "singles")).alias("largest")
    return sets.groupBy("id").agg(largest, F.sum("copies").alias("rows")).select("id", "largest.n", "largest.digest", "largest.singles", "rows")


def _sizes(size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array((len(ngram_set(t.as_py(), size)) for t in batch.column(0)), pa.int64())], ["n_shingles"])

    return work


# --- 2. candidates -----------------------------------------------------------------------------

_SEGMENTS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("fragment", pa.int32()), ("ngrams", pa.list_(pa.int64()))])


def _segments(size: int, fragments: int):
    """(id, text, n, digest) → the part of each set that lies in each fragment."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, n, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = ngram_set(text, size)
                if xxhash.xxh128_digest(_binary(s)) != digest:
                    continue  # another row of this id, with a smaller set
                ends = np.searchsorted(_fragment_of(s, fragments), np.arange(fragments + 1, dtype=np.uint64))
                rows += [(i, n, f, s[ends[f] : ends[f + 1]].view(np.int64)) for f in range(fragments) if ends[f] < ends[f + 1]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), _SEGMENTS, strict=True)], schema=_SEGMENTS)

    return work


_RAREST = pa.schema(
    [("id", pa.int64()), ("n", pa.int64()), ("rare", pa.int64()), ("rarest", pa.list_(pa.struct([("often", pa.int32()), ("ngram", pa.int64())])))]
)
_RAREST_DDL = "id long, n long, rare long, rarest array<struct<often:int,ngram:long>>"


def _rarest(least: int, of: int):
    """All segments of one fragment → for each document the rarest n-grams that its prefix may need, and how many are rare."""

    def work(table: pa.Table) -> pa.Table:
        lists = table.column("ngrams").combine_chunks()
        ngrams = lists.flatten().to_numpy(zero_copy_only=False)
        length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        n = table.column("n").to_numpy()
        row = np.repeat(np.arange(len(length)), length)
        _, which, count = np.unique(ngrams, return_inverse=True, return_counts=True)
        often = count[which]
        order = np.lexsort((ngrams, often, row))
        place = np.arange(len(order)) - np.repeat(np.cumsum(length) - length, length)
        taken = np.minimum(length, n - -(-n * least // of) + 1)
        pick = order[place < np.repeat(taken, length)]
        items = pa.StructArray.from_arrays([pa.array(often[pick].astype(np.int32)), pa.array(ngrams[pick])], fields=list(_RAREST.field("rarest").type.value_type))
        rarest = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(taken)]).astype(np.int32), items)
        rare = np.bincount(row[often <= RARE], minlength=len(length))
        return pa.table([table.column("id"), table.column("n"), pa.array(rare, pa.int64()), rarest], schema=_RAREST)

    return work


def _postings(segments: DataFrame, least: int, of: int) -> DataFrame:
    """(ngram, often, id, n, rare) for every n-gram of every prefix that more than one document holds."""
    parts = segments.select("id", "n", "fragment", "ngrams").groupBy("fragment").applyInArrow(_rarest(least, of), _RAREST_DDL)
    prefix = (F.col("n") - F.ceil(F.col("n") * least / of) + 1).cast("int")
    whole = parts.groupBy("id", "n").agg(F.sum("rare").alias("rare"), F.array_sort(F.flatten(F.collect_list("rarest"))).alias("rarest"))
    return whole.select("id", "n", "rare", F.explode(F.slice("rarest", F.lit(1), prefix)).alias("x")).filter("x.often > 1").select(
        F.col("x.ngram").alias("ngram"), F.col("x.often").alias("often"), "id", "n", "rare"
    )


# --- 3. overlaps -------------------------------------------------------------------------------


def _overlaps(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """(a, b, both, n_a, n_b) of pairs that share an n-gram: partial overlaps by fragment, summed per pair."""
    left = segments.select(F.col("id").alias("a"), F.col("n").alias("n_a"), "fragment", F.col("ngrams").alias("x"))
    right = segments.select(F.col("id").alias("b"), F.col("n").alias("n_b"), "fragment", F.col("ngrams").alias("y"))
    parts = pairs.join(left, "a").join(right, ["b", "fragment"])
    overlap = parts.withColumn("part", F.size(F.array_intersect("x", "y")))
    return overlap.groupBy("a", "b").agg(F.sum("part").alias("both"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))


def _linked(overlaps: DataFrame, least: int, of: int) -> DataFrame:
    """The pairs (a, b) that reach the threshold."""
    return overlaps.filter(F.col("both") * of >= least * (F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b")


def _distance() -> Column:
    return 1 - F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both"))


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b): the smallest id that links reach.

    Alternates large-star and small-star; every round is written to the shared folder.
    """
    both = lambda e: e.union(e.select("b", "a"))
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    before = None
    for _ in range(rounds):
        # large star: everyone larger than a node is tied to the smallest node near it
        near = both(edges)
        low = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = near.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        # small star: all smaller neighbours of a node, and itself, are tied to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        tied = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
        edges = stored(tied.filter("a > b").distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(edges.select(F.col("b"), F.col("b")).distinct())


def _document_pairs(cross: DataFrame, own: DataFrame, alike: list[str]) -> DataFrame:
    """(a, b): the documents of pairs of classes that meet under n-grams (``cross``), a superset of those that meet themselves.

    For each pair of classes the shorter of two lists is made: that of documents under each common n-gram, in
    which two that share many stand as often, or that of all their documents, once.
    """
    other = [f"{c}_b" for c in alike]
    renamed = lambda df, **more: df.withColumnsRenamed({c: f"{c}_b" for c in alike} | more)
    members = own.select(*alike, "id").distinct()
    sizes = members.groupBy(*alike).agg(F.count(F.lit(1)).alias("size"))
    held = own.groupBy("ngram", *alike).agg(F.count(F.lit(1)).alias("held"))
    both = cross.join(held, ["ngram", *alike]).join(renamed(held, held="held_b"), ["ngram", *other])
    both = both.groupBy(*alike, *other).agg(F.sum(F.col("held") * F.col("held_b")).alias("listed"))
    both = both.join(sizes, alike).join(renamed(sizes, size="size_b"), other).withColumn("whole", F.col("size") * F.col("size_b") <= F.col("listed"))
    both = stored(both.select(*alike, *other, "whole"), "class pairs")
    whole = both.filter("whole").join(members.withColumnRenamed("id", "a"), alike).join(renamed(members, id="b"), other)
    listed = cross.join(both.filter("not whole"), [*alike, *other])
    docs = own.select("ngram", *alike, "id")
    listed = listed.join(docs.withColumnRenamed("id", "a"), ["ngram", *alike]).join(renamed(docs, id="b"), ["ngram", *other])
    return whole.select("a", "b").union(listed.select("a", "b")).distinct()


def near_components(counts: DataFrame, docs: DataFrame, size: int, least: int, of: int, id_col: str, text_col: str) -> DataFrame:
    """(id, component) of the documents that link with a document whose set differs from theirs.

    ``counts`` has one row per id; of equal sets only the smallest id appears.
    """
    n, m = F.col("n"), F.col("n_b")
    chosen = counts.filter((n - F.col("singles")) * of >= n * least).filter(n * of >= (n + 1) * least)
    chosen = stored(chosen.groupBy("digest").agg(F.min("id").alias("id"), F.first("n").alias("n")), "chosen")
    total = chosen.agg(F.sum("n")).first()[0] or 0
    fragments = max(min(MOST_SMALL, docs.sparkSession.sparkContext.defaultParallelism), -(-total // FRAGMENT_NGRAMS))
    # the ids chosen grow with the input: they are never broadcast
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(chosen.hint("merge"), "id").select("id", "text", "n", "digest")
    segments = texts.mapInArrow(_segments(size, fragments), "id long, n long, fragment int, ngrams array<long>").dropDuplicates(["id", "fragment"])
    segments = stored(segments, "segments")
    postings = stored(_postings(segments, least, of), "postings")
    near = F.least(n, m) * of >= F.greatest(n, m) * least

    led, edges, todo = None, None, postings
    for turn in range(LEADER_TURNS):
        # each document with one leader: among the leaders of its postings the one with the fewest rare n-grams
        leaders = todo.groupBy("ngram").agg(F.min(F.struct("rare", "id", "n")).alias("leader"))
        pairs = todo.join(leaders, "ngram").withColumn("n_b", F.col("leader.n")).filter((F.col("leader.id") != F.col("id")) & near)
        pairs = pairs.groupBy("id").agg(F.min("leader").alias("leader")).select(F.col("id").alias("a"), F.col("leader.id").alias("b"))
        now = stored(_overlaps(pairs, segments), "led")
        linked = _linked(now, least, of)
        led, edges = (now, linked) if turn == 0 else (led.union(now), edges.union(linked))
        if turn + 1 < LEADER_TURNS:
            settled = linked.select(F.explode(F.array("a", "b")).alias("id")).distinct()
            # the ids settled grow with the input: they are never broadcast
            todo = stored(todo.join(settled.hint("merge"), "id", "left_anti"), "todo")
    known = stored(components(edges), "known")

    # what is left: pairs that meet under an n-gram, may reach the threshold and are in different components
    group, leader = F.coalesce("component", "id"), F.coalesce("leader", "id")
    # distances from the leader, rounded up to twentieths, so that few classes arise
    far = F.coalesce(F.ceil("far"), F.lit(0)).cast("int")
    nearest = led.groupBy(F.col("a").alias("id")).agg(F.min(F.struct((_distance() * 20).alias("far"), F.col("b").alias("leader"))).alias("x"))
    near_leader = nearest.select("id", "x.leader", "x.far")
    own = postings.join(known, "id", "left").join(near_leader, "id", "left")
    own = own.select(
        "ngram", "id", "n", (n - F.col("rare")).alias("frequent"), (F.col("often") <= RARE).alias("is_rare"), group.alias("component"), leader.alias("leader"), far.alias("far")
    )
    own = stored(own.filter(F.col("is_rare") | (F.col("frequent") * of >= n * least)), "own")
    mixed = own.groupBy("ngram").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("ngram")
    alike = ["component", "n", "frequent", "leader", "far"]
    groups = own.join(mixed, "ngram").select("ngram", *alike, "is_rare").distinct()
    other = groups.select("ngram", *[F.col(c).alias(f"{c}_b") for c in alike])
    most = F.least("frequent", "frequent_b")
    may = near & (F.col("is_rare") | (most * (of + least) >= (n + m) * least))
    cross = groups.join(other, "ngram").filter((F.col("component") < F.col("component_b")) & may).drop("is_rare")
    cross = stored(cross, "cross")
    between = _overlaps(cross.filter("leader != leader_b").select(F.col("leader").alias("a"), F.col("leader_b").alias("b")).distinct(), segments)
    between = stored(between, "between")
    joined = _linked(between, least, of)
    if not joined.isEmpty():
        # leaders that link join their components, whose documents needn't be paired any more
        edges = edges.union(joined)
        known = stored(components(edges), "known")
        roots = known.select("id", F.col("component").alias("root"))
        for c in ("component", "component_b"):
            cross = cross.join(roots.withColumnsRenamed({"id": c, "root": f"{c}_root"}), c, "left")
        cross = cross.filter(F.coalesce("component_root", "component") != F.coalesce("component_b_root", "component_b"))
    # triangle inequality: leaders so far apart that no pair of their documents is near
    apart = between.select(F.col("a").alias("leader"), F.col("b").alias("leader_b"), _distance().alias("apart"))
    # leaders without a common n-gram have distance 1
    least_apart = F.when(F.col("leader") == F.col("leader_b"), 0.0).otherwise(F.coalesce("apart", F.lit(1.0)))
    may = least_apart - (F.col("far") + F.col("far_b")) / 20 <= 1 - least / of + 1e-9
    cross = cross.join(apart, ["leader", "leader_b"], "left").filter(may).select("ngram", *alike, *[f"{c}_b" for c in alike])
    pairs = _document_pairs(stored(cross, "pairs"), own, alike)
    rest = stored(_linked(_overlaps(pairs, segments), least, of), "rest")
    return known if rest.isEmpty() else stored(components(edges.union(rest)), "known")


def ngram_jaccard_components(
    docs: DataFrame, size: int = 5, least: int = 80, of: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Group documents whose sets of word n-grams have a Jaccard similarity of ``least / of`` or more.

    One row per row of ``docs``: id, n_shingles (size of its set), component_id (smallest id that
    links reach, the document itself included). Texts that are null, empty or without words have an
    empty set and link with nothing. Very long texts are taken whole. Of repeated rows of one id the
    one with the largest set links for that id, and all bear its component. Rows without an id can't
    be named in a link: they link with nothing and have no component. Other columns of ``docs`` are
    not looked at. An empty table gives no rows.
    """
    sets = stored(ngram_counts(docs, size, id_col, text_col), "sets")
    counts = stored(_largest(sets), "counts")
    near = near_components(counts, docs, size, least, of, id_col, text_col).select(F.col("id").alias("first"), "component")
    # equal sets always link: those that occur more than once are looked up by their digest
    filled = counts.filter("n > 0")
    equal = filled.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    out = counts.withColumn("digest", F.when(F.col("n") > 0, F.col("digest")))
    out = salted_join(out, equal, ["digest"], F.col("id")).withColumn("first", F.coalesce("first", "id"))
    out = salted_join(out, near, ["first"], F.col("id")).withColumn("component_id", F.coalesce("component", "first"))
    one = out.filter("rows = 1").select("id", F.col("n").alias("n_shingles"), "component_id")
    # repeated ids: every row has the size of its own set
    many = sets.join(out.filter("rows > 1").select("id", "component_id"), "id")
    many = many.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("id", F.col("n").alias("n_shingles"), "component_id")
    nameless = docs.filter(F.col(id_col).cast("long").isNull()).select(text_col).mapInArrow(_sizes(size), "n_shingles long")
    nameless = nameless.select(F.lit(None).cast("long").alias("id"), "n_shingles", F.lit(None).cast("long").alias("component_id"))
    return one.unionByName(many).unionByName(nameless)
