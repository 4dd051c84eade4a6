"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from screenloom.llm import periodic
from screenloom.llm.periodic import find_runs, periodic_runs, with_planted_runs
from screenloom.llm.queries import op13_periodic_runs


def brute(words, least=12):
    """Every lag at every place; a stretch that several lags share has the smallest as its period."""
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def numbers(texts):
    return [np.array(t, np.int64) for t in texts]


letters = st.integers(0, 2)
block = st.lists(letters, min_size=1, max_size=45)
repetitive = st.lists(st.tuples(block, st.integers(1, 9)), max_size=5).map(lambda parts: [x for b, k in parts for x in b * k][:400])


@settings(max_examples=250, deadline=None)
@given(st.lists(repetitive, max_size=5))
def test_runs_of_repetitive_texts(texts):
    assert find_runs(numbers(texts)) == [brute(t) for t in texts]


@pytest.mark.parametrize("short", [4, 8, 16, 32])
def test_runs_of_every_scale(monkeypatch, short):
    monkeypatch.setattr(periodic, "SHORT", short)
    rng = random.Random(short)
    fib, nxt = [0], [0, 1]
    while len(fib) < 500:
        fib, nxt = nxt, nxt + fib
    texts = [fib, [0] * 300, [0, 1] * 70 + [0] + [0, 1] * 60, [], [1], list(range(300)) * 2, list(range(299)) * 2 + [0]]
    for _ in range(60):
        unit = [rng.randrange(3) for _ in range(rng.randint(1, 90))]
        texts.append([rng.randrange(2) for _ in range(rng.randint(0, 40))] + (unit * 9)[: rng.randint(1, 400)] + unit[:5])
    got = find_runs(numbers(texts))
    assert got == [brute(t) for t in texts]
    # texts beside each other never share a run
    assert [find_runs(numbers([t]))[0] for t in texts] == got


def test_seeds_stay_few():
    rng = np.random.default_rng(3)
    for words in (np.zeros(40_000, np.int64), np.tile([0, 1], 20_000), np.tile(rng.integers(0, 9, 700), 60), np.repeat(rng.integers(0, 3, 800), 50)):
        hashes, span, scale, doc = periodic._mixed(words.astype(np.uint64)), 1, periodic.SHORT, np.zeros(len(words), np.int64)
        while scale * 2 <= len(words):
            while span < scale // 2:
                hashes = periodic._mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + np.roll(hashes, -span))
                span *= 2
            assert len(periodic._seeds(hashes, doc, scale)[0]) <= 16 * len(words)
            scale *= 2


def expected(doc_id, text):
    """The contract, word by word."""
    words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_query_is_brute_force(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "a", "x " * 40, "one two\x0bthree " * 9 + "é é " * 15, "a b c d e f " * 2, "A a " * 12]
    texts += [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(1, 260))) + rng.choice(["", "\n"]) for _ in range(160)]
    texts += [" ".join(f"w{rng.randrange(4000)}" for _ in range(6000))]
    rows = [(k * 7, t) for k, t in enumerate(texts)] + [(None, "u v w " * 6), (None, None), (7, ""), (7, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(expected(i, t)) for i, t in rows)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and r.n_runs for i, r in ((r.doc_id, r) for r in got.collect()) if i is not None)


def test_columns_pass_through(spark):
    rows = [(1, "a b c " * 8, "mine", 5, "x"), (2, None, "mine", 6, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Runs string, n int, __text string")
    out = periodic_runs(docs)
    assert out.columns == ["doc_id", "n", "__text", "n_words", "runs", "collapsed"]
    got = {r.doc_id: r for r in out.collect()}
    assert (got[1]["n"], got[1]["__text"], got[1].n_words, [tuple(r) for r in got[1].runs], got[1].collapsed) == (5, "x", 24, [(0, 24, 3)], "a b c")
    assert (got[2].n_words, got[2].runs, got[2].collapsed) == (0, [], "")
    assert periodic_runs(docs.limit(0)).count() == 0 and with_planted_runs(docs).columns == docs.columns
    named = periodic_runs(docs.select("doc_id", docs.text.alias("collapsed")), text_col="collapsed")
    assert named.columns == ["doc_id", "n_words", "runs", "collapsed"] and named.count() == 2
