"""The prefix trie against brute force, which makes every rebuilt conversation."""

import collections
import hashlib
import random
import zlib

import duckdb
import pytest

from screenloom.llm import prefix_trie as pt
from screenloom.llm.prefix_trie import prefix_trie
from screenloom.llm.queries import OP11_SQL, op11_prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            own[c].append((role or "", text or ""))
    members = collections.defaultdict(list)
    ends = collections.defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        turns = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = collections.Counter(), collections.Counter(), collections.Counter()
    for key in members:
        children[key[:-1]] += bool(key)
    for key, m in members.items():
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(m) - 1) * len(key[-1][1].encode()) if key else 0
    digest = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted((m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k], digest(ends[k])) for k, m in members.items())


def sample(seed, convs=70):
    rng = random.Random(seed)
    texts = ["hi", "", None, "grüß dich", "what now?", "ok " * 50]
    rows = []
    for c in rng.sample(range(3 * convs), convs):
        n = rng.choice([1, 1, 2, 3, 5, 8, 9, 12, 20])
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(texts[: 2 + c % 5])) for _ in range(n)]
        numbers = rng.sample(range(-5, 100), n)
        rows += [(c, t, *x) for t, x in zip([None, *numbers[1:]] if c % 4 == 0 else numbers, turns, strict=True)]
    for c in (500, 501, 502, 503, 900, 904):  # copies, one of them longer than a stretch of the chain
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(60 + c % 3)]
    rng.shuffle(rows)
    return rows


def got(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0], r[1]))


@pytest.mark.parametrize("seed", [1, 2])
def test_query_is_brute_force(spark, tmp_path, monkeypatch, seed):
    monkeypatch.setattr(pt, "STRETCH", 7)
    rows = sample(seed) + [(None, 0, "user", "of no conversation")]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    out = got(op11_prefix_trie(spark, str(tmp_path)))
    assert out == brute(rows)
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = duck.sql(OP11_SQL)
    assert want.columns == COLUMNS and sorted(want.fetchall(), key=lambda r: (r[0], r[1])) == out


def test_one_conversation_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(pt, "STRETCH", 50)
    monkeypatch.setattr(pt, "PIECE", 30)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(c, t, "user", f"{t % 7}") for c in (10, 11, 12) for t in range(400)]
        rows += [(c, 0, "user", "the same") for c in range(1000, 1100)]
        docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
        assert got(prefix_trie(docs, base=pt.F.col("conv_id") - pt.F.col("conv_id") % 5, head=pt.F.crc32(pt.F.col("conv_id").cast("string").cast("binary")) % 9)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_collisions_are_noticed(spark, monkeypatch):
    tried = []
    bases = pt._bases
    monkeypatch.setattr(pt, "_bases", lambda k: tried.append(k) or ([1] * 4 if k == 0 else bases(k)))
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "b"), (2, 1, "user", "a"), (3, 0, "user", "a")]
    out = got(prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    # with base 1 the sums of "ab" and "ba" are equal
    assert tried == [0, 1]
    assert [(r[:6]) for r in out] == [(1, 0, None, 3, 2, 2), (1, 1, 1, 2, 1, 1), (1, 2, 1, 1, 0, 1), (2, 1, 1, 1, 1, 1), (2, 2, 2, 1, 0, 1)]


def test_edge_cases(spark):
    docs = spark.createDataFrame([(7, None, None, None), (7, None, None, None), (8, 1, "user", "x")], SCHEMA)
    more = docs.selectExpr("*", "1 AS s0", "2 AS depth", "'n' AS pos", "3 AS bytes")
    out = got(prefix_trie(more))
    assert [r[:7] for r in out] == [(7, 0, None, 2, 2, 2, 0), (7, 1, 7, 1, 1, 1, 0), (7, 2, 7, 1, 0, 1, 0), (8, 1, 7, 1, 0, 1, 0)]
    assert prefix_trie(docs.limit(0)).count() == 0
    long = spark.createDataFrame([(1, 0, "user", "é" * 3_000_000), (2, 0, "user", "é" * 3_000_000), (3, 5, "user", "é" * 3_000_000 + "x")], SCHEMA)
    assert [r[:7] for r in got(prefix_trie(long))] == [(1, 0, None, 3, 2, 2, 6_000_000), (1, 1, 1, 2, 0, 1, 6_000_000), (3, 1, 1, 1, 0, 1, 0)]
    # a head that isn't there, or is shorter than what is taken off
    rows = [(5, 0, "user", "h"), (6, 0, "user", "p"), (6, 1, "user", "q"), (6, 2, "user", "r"), (21, 0, "a", "b"), (21, 1, "c", "d")]
    out = got(prefix_trie(spark.createDataFrame(rows, SCHEMA), base=pt.F.lit(5), head=pt.F.when(pt.F.col("conv_id") == 6, 2).otherwise(None)))
    assert [r[:2] for r in out] == [(5, 0), (5, 1), (6, 2), (21, 1), (21, 2)]
