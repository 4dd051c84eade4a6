"""The prefix trie of conversations, by composable fingerprints.

A rebuilt conversation is the head of a base conversation followed by what its own has after as many
turns. A prefix is fingerprinted by a sum over its turns, x(i) * B**i modulo a prime, in four lanes. With
the number of turns such a sum is an element of a monoid: (m, S) followed by (n, T) is (m + n, S + B**m * T),
and since B has an inverse a head can also be taken off. So one scan over the stored turns gives the sums
of all their prefixes, and those of a rebuilt conversation follow from two of them by arithmetic:

    S(base, first k) + B**(k - h) * (S(own, first j) - S(own, first h))

No rebuilt text, and no list of turns, is ever made. The scan itself goes over ranges of the sorted turns
and combines what the ranges of one long conversation give.

Prefixes of equal length and fingerprint form a node. Equality is verified, not assumed: every member
refers to its last stored turn and to the fingerprint before it, and all members of a node must agree in
both; and turns of one reference must have one role and text. By induction over the length each
node then stands for one sequence. Should a check ever fail, all is done again with other hashes.

Sums over subtrees need no walk down the trie. Along a conversation its own nodes (those of which it is
the smallest member) are the last ones, and every node of a subtree is an own node of some member of
the subtree's top; so sums over subtrees are sums over members of sums along conversations.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenloom.llm.common import stored

PRIME = (1 << 31) - 1
LANES = range(4)
#: Own nodes of a conversation that are summed in one window.
STRETCH = 4096
#: Characters of a list of members that are hashed at once.
PIECE = 1 << 16
_REF = ["r0", "r1"]
_SUM, _BEFORE = [f"s{i}" for i in LANES], [f"b{i}" for i in LANES]
_NODE = ["depth", *_SUM]
_INTS = ", ".join(f"{c} int" for c in (*_SUM, *_BEFORE))


def _bases(attempt: int) -> list[int]:
    """The base of each lane."""
    return [int.from_bytes(hashlib.sha256(f"{attempt}/{i}".encode()).digest()[:8], "big") % (PRIME - 2) + 2 for i in LANES]


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n, or some more, modulo the prime."""
    out = np.ones(1, np.int64)
    while len(out) <= n:
        out = np.concatenate([out, out * pow(base, len(out), PRIME) % PRIME])
    return out


def _scan(bases: list[int]):
    """Turns (conv_id, bytes, r0, r1) in order → with the range's number, place and sums within the range."""
    names = ["block", "conv_id", "pos", "bytes", *_REF, *_SUM, *_BEFORE]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, last, place, sums = TaskContext.get().partitionId(), None, 0, [0 for _ in LANES]
        for batch in batches:
            conv, size, r0, r1 = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(conv):
                continue
            new = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            of = np.repeat(np.arange(len(new)), np.diff(new, append=len(conv)))
            goes_on = int(conv[0]) == last
            pos = np.arange(1, len(conv) + 1) - new[of]
            pos[of == 0] += place if goes_on else 0
            columns, top = [], int(pos.max())
            turns = [r0 & PRIME, (r0 >> 32) & PRIME, r1 & PRIME, (r1 >> 32) & PRIME]
            for lane, x in enumerate(turns):
                terms = x * _powers(bases[lane], top)[pos] % PRIME
                total = np.cumsum(terms)
                start = (total - terms)[new] - np.where(goes_on & (np.arange(len(new)) == 0), sums[lane], 0)
                s = (total - start[of]) % PRIME
                columns.append((s, (s - terms) % PRIME))
                sums[lane] = int(s[-1])
            last, place = int(conv[-1]), int(pos[-1])
            out = [np.full(len(conv), block, np.int32), conv, pos, size, r0, r1, *[s.astype(np.int32) for s, _ in columns], *[b.astype(np.int32) for _, b in columns]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)

    return work


def _offsets(bases: list[int]):
    """Ranges of one conversation (block, conv_id, n, sums) → what comes before each: turns, sums and powers."""

    def work(table: pa.Table) -> pa.Table:
        rows, n, sums, out = sorted(table.to_pylist(), key=lambda r: r["block"]), 0, [0 for _ in LANES], []
        for r in rows:
            power = [pow(b, n, PRIME) for b in bases]
            out.append((r["block"], r["conv_id"], n, *sums, *power))
            sums = [(s + m * r[c]) % PRIME for s, m, c in zip(sums, power, _SUM, strict=True)]
            n += r["n"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.int64()] * 8]
        names = ["block", "conv_id", "_n", *[f"_o{i}" for i in LANES], *[f"_m{i}" for i in LANES]]
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return work


def _placed_turns(turns: DataFrame, bases: list[int]) -> DataFrame:
    """(conv_id, pos, bytes, reference, sums up to and before each turn), pos from 1."""
    ordered = turns.repartitionByRange("conv_id", "turn", *_REF).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), *_REF)
    scanned = ordered.select("conv_id", "bytes", *_REF).mapInArrow(
        _scan(bases), f"block int, conv_id long, pos long, bytes long, r0 long, r1 long, {_INTS}"
    )
    scanned = stored(scanned, "turns")
    last = F.max(F.struct("pos", *_SUM)).alias("x")
    parts = scanned.groupBy("conv_id", "block").agg(last).select("conv_id", "block", F.col("x.pos").alias("n"), *[f"x.{c}" for c in _SUM])
    several = parts.groupBy("conv_id").agg(F.count(F.lit(1)).alias("blocks")).filter("blocks > 1").drop("blocks")
    lanes = ", ".join(f"{c}{i} long" for c in ("_o", "_m") for i in LANES)
    offsets = parts.join(several, "conv_id").groupBy("conv_id").applyInArrow(_offsets(bases), f"block int, conv_id long, _n long, {lanes}")
    # a range cuts at most two conversations, so there are at most two rows for each range
    rows = scanned.join(F.broadcast(offsets), ["block", "conv_id"], "left")
    moved = lambda c, i: F.when(F.col("_n").isNull(), F.col(c)).otherwise((F.col(f"_o{i}") + F.col(f"_m{i}") * F.col(c)) % PRIME).cast("int").alias(c)
    return rows.select(
        "conv_id", (F.col("pos") + F.coalesce("_n", F.lit(0))).alias("pos"), "bytes", *_REF, *[moved(f"{c}{i}", i) for c in "sb" for i in LANES]
    )


def _members(placed: DataFrame, base: Column, head: Column, most_head: int, bases: list[int]) -> DataFrame:
    """A row for each rebuilt conversation and prefix: conv_id, is_end, bytes, reference, node and the node before."""
    first = F.struct("pos", "bytes", *_REF, *_SUM, *_BEFORE)
    convs = placed.groupBy("conv_id").agg(F.max("pos").alias("n"), F.sort_array(F.collect_list(F.when(F.col("pos") <= most_head, first))).alias("heads"))
    convs = convs.withColumn("base", base).withColumn("h", F.least(F.coalesce(head, F.lit(0)), F.lit(most_head)).cast("int"))
    bases_of = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"), F.col("heads").alias("base_heads"))
    joined = convs.join(bases_of, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int"))
    length = F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    lane = lambda array, at, i: F.coalesce(F.get(array, F.col(at) - 1)[f"s{i}"], F.lit(0)).cast("long")
    # B ** (k - h): the head that is taken off may be longer than the one put on
    back = [F.array(*[F.lit(pow(b, -d, PRIME)).cast("long") for d in range(most_head + 1)]) for b in bases]
    times = [F.get(back[i], F.col("h") - F.col("k")) for i in LANES]
    plus = [F.pmod(lane("base_heads", "k", i) - lane("heads", "h", i) * times[i], F.lit(PRIME)) for i in LANES]
    joined = joined.select(
        "conv_id", "h", "k", length.alias("length"), "base_heads", *[t.alias(f"t{i}") for i, t in enumerate(times)], *[p.alias(f"p{i}") for i, p in enumerate(plus)]
    )
    root = joined.select("conv_id", F.lit(0).cast("long").alias("depth"), "length", F.lit(0).cast("long").alias("bytes"), *[F.lit(0).cast("long").alias(c) for c in _REF], *[F.lit(0).alias(c) for c in (*_SUM, *_BEFORE)])
    heads = joined.filter("k > 0").select("conv_id", "length", F.explode(F.slice("base_heads", F.lit(1), F.col("k"))).alias("x"))
    heads = heads.select("conv_id", F.col("x.pos").alias("depth"), "length", *[f"x.{c}" for c in ("bytes", *_REF, *_SUM, *_BEFORE)])
    own = placed.join(joined.filter("length > k").drop("base_heads"), "conv_id").filter("pos > h")
    moved = lambda c, i: ((F.col(f"p{i}") + F.col(f"t{i}") * F.col(c)) % PRIME).cast("int").alias(c)
    own = own.select("conv_id", (F.col("k") + F.col("pos") - F.col("h")).alias("depth"), "length", "bytes", *_REF, *[moved(f"{c}{i}", i) for c in "sb" for i in LANES])
    every = root.unionByName(heads).unionByName(own)
    return every.select("conv_id", "depth", (F.col("depth") == F.col("length")).alias("is_end"), "bytes", *_REF, *_SUM, *_BEFORE)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members in order of node and id → comma-joined pieces of each node's list, with their first id."""
    node, first, ids, held = None, 0, [], 0
    for batch in batches:
        out = []
        *keys, conv = (c.to_pylist() for c in batch.columns)
        for *key, c in zip(*keys, conv, strict=True):
            if key != node or held > PIECE:
                if ids:
                    out.append((*node, first, ",".join(ids)))
                node, first, ids, held = key, c, [], 0
            ids.append(str(c))
            held += len(ids[-1]) + 1
        if out:
            yield _piece_rows(out)
    if ids:
        yield _piece_rows([(*node, first, ",".join(ids))])


_PIECES = [("depth", pa.int64()), *[(c, pa.int32()) for c in _SUM], ("first", pa.int64()), ("ids", pa.string())]


def _piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, (_, t) in zip(zip(*rows, strict=True), _PIECES, strict=True)], [n for n, _ in _PIECES])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order of node and first id → the SHA-256 of each node's whole list."""
    names, kinds = [*_NODE, "ends_sha256"], [pa.int64(), *[pa.int32()] * 4, pa.string()]
    rows = lambda out: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)
    node, digest = None, None
    for batch in batches:
        out = []
        for *key, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield rows(out)
    if node is not None:
        yield rows([(*node, digest.hexdigest())])


def _ends(members: DataFrame) -> DataFrame:
    """Of each node at which conversations end, the digest of their ids.

    A list that may hold a third of all ids is cut into pieces made by many tasks; one task
    then hashes the pieces as they stream past it.
    """
    order = [*_NODE, "conv_id"]
    ends = members.filter("is_end").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ends.mapInArrow(_pieces, ", ".join(["depth long", *[f"{c} int" for c in _SUM], "first long, ids string"]))
    pieces = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
    return pieces.mapInArrow(_hashed, ", ".join(["depth long", *[f"{c} int" for c in _SUM], "ends_sha256 string"]))


def _verified(members: DataFrame) -> DataFrame | None:
    """The nodes, or None if members of one differ in their last turn or in what comes before."""
    same = [*_REF, *_BEFORE]
    checks = [f(c).alias(f"{n}_{c}") for c in same for n, f in (("low", F.min), ("high", F.max))]
    grouped = members.groupBy(*_NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"), *checks)
    agree = F.lit(True)
    for c in same:
        agree &= F.col(f"low_{c}") == F.col(f"high_{c}")
    nodes = stored(grouped.select(*_NODE, "conv_id", "n_convs", "bytes", *[F.col(f"low_{c}").alias(c) for c in _BEFORE], agree.alias("agree")), "nodes")
    return None if not nodes.filter("not agree").isEmpty() else nodes.drop("agree")


def prefix_trie(turns: DataFrame, base: Column | None = None, head: Column | None = None, most_head: int = 8) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, one row each.

    ``turns`` has conv_id, turn, role and text. ``base`` and ``head`` are expressions over conv_id: a
    rebuilt conversation is the first ``head`` turns (at most ``most_head``) of conversation ``base``, all if it has fewer, none if
    there is no such conversation, then its own turns after its first ``head``. Without them
    conversations are taken as they are.

    Result: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (over the subtree, bytes of a node's last text times its members but one), ends_sha256 (of the
    comma-joined ids of the members that end here, ascending).

    Turns are in order of ``turn``, null first; turns of one number are ordered by a hash of role and text.
    Null roles and texts count as empty. Rows without a conv_id belong to no conversation and take no
    part. Repeated rows are turns of their own. Other columns are not looked at. Texts are taken whole,
    conversations may be of any length. An empty table gives no rows, not even a root.
    """
    turns = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    own = F.col("conv_id")
    for attempt in itertools.count():
        bases = _bases(attempt)
        named = turns.select("*", *[F.xxhash64(F.lit(2 * attempt + i), "role", "text").alias(c) for i, c in enumerate(_REF)])
        contents = named.select(*_REF, "role", "text").distinct().groupBy(*_REF).agg(F.count(F.lit(1)).alias("n"))
        if not contents.filter("n > 1").isEmpty():
            continue
        placed = _placed_turns(named.select("conv_id", "turn", F.octet_length("text").cast("long").alias("bytes"), *_REF), bases)
        members = stored(_members(placed, own if base is None else base, F.lit(0) if head is None else head, most_head, bases), "members")
        nodes = _verified(members)
        if nodes is not None:
            return _trie(members, nodes)


def _trie(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """The result from the members of all nodes and the nodes."""
    # along a conversation its own nodes are a chain that ends with it; sums run over stretches of the chain
    nodes = nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("bytes")).withColumn("stretch", F.floor(F.col("depth") / STRETCH))
    sums = nodes.groupBy("conv_id", "stretch").agg(F.sum("weight").alias("sum"), F.min("depth").alias("low"), F.max("depth").alias("high"))
    along = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id")
    sums = sums.select(
        "conv_id", "stretch", F.coalesce(F.sum("sum").over(along), F.lit(0)).alias("earlier"), F.min("low").over(whole).alias("start"), F.max("high").over(whole).alias("end")
    )
    within = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    chained = nodes.withColumn("near", F.coalesce(F.sum("weight").over(within), F.lit(0))).join(sums, ["conv_id", "stretch"])
    chained = chained.withColumn("shallower", F.col("earlier") + F.col("near")).drop("earlier", "near", "stretch")
    # a chain hangs under a node of another conversation; how many hang there are its further children
    hung = chained.filter((F.col("depth") == F.col("start")) & (F.col("depth") > 0))
    up = hung.select((F.col("depth") - 1).alias("depth"), *[F.col(b).alias(s) for b, s in zip(_BEFORE, _SUM, strict=True)], F.col("conv_id").alias("below"))
    many = up.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("hanging"))
    nodes = stored(chained.join(many, _NODE, "left").withColumn("hanging", F.coalesce("hanging", F.lit(0))).drop(*_BEFORE), "chains")
    above = stored(up, "hung").join(nodes.filter("hanging > 0").select(*_NODE, F.col("conv_id").alias("above")), _NODE)
    above = above.select(F.col("below").alias("conv_id"), (F.col("depth") + 1).alias("depth"), "above")
    # sums over subtrees: over the members of a node, sums along these
    along_each = nodes.groupBy("conv_id").agg(F.sum("weight").alias("total"), F.max(F.struct("depth", (F.col("hanging") == 0).cast("long").alias("leaf"))).alias("x"))
    along_each = along_each.select("conv_id", "total", F.col("x.leaf").alias("leaf")).filter("total > 0 or leaf > 0")
    below = members.select("conv_id", *_NODE).join(along_each, "conv_id").groupBy(*_NODE).agg(F.sum("total").alias("total"), F.sum("leaf").alias("n_leaves"))
    out = nodes.join(below, _NODE, "left").join(_ends(members), _NODE, "left").join(above, ["conv_id", "depth"], "left")
    return out.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > F.col("start"), F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs",
        (F.col("hanging") + F.when(F.col("depth") < F.col("end"), 1).otherwise(0)).cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(0)).cast("long").alias("n_leaves"),
        (F.coalesce("total", F.lit(0)) - F.col("shallower")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
