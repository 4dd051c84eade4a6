"""SimHash groups against brute force."""

import itertools
import random
import re

import pytest
import xxhash

from screenloom.llm import simhash
from screenloom.llm.queries import op12_simhash_near_dedup
from screenloom.llm.simhash import cover, fingerprint, near_links, simhash_components


def slow_fingerprint(text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """The smallest node that each reaches."""
    up = {x: {x} for x in nodes}
    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b) and up[a] is not up[b]:
            up[a] |= up[b]
            for x in up[b]:
                up[x] = up[a]
    return {x: min(g) for x, g in up.items()}


@pytest.mark.parametrize(("positions", "radius"), [(64, 2), (27, 2), (11, 2), (5, 2), (2, 2), (1, 2), (64, 1), (20, 3)])
def test_every_pair_within_the_radius_meets(positions, radius):
    places = random.Random(positions).sample(range(64), positions)
    masks = cover(places, radius)
    for differ in itertools.combinations(places, min(radius, positions)):
        bits = sum(1 << p for p in differ)
        assert any(not m & bits for m in masks)


@pytest.mark.parametrize("most", [1, 4, 64])
def test_links_join_what_all_pairs_join(spark, most):
    rng = random.Random(most)
    bits = {0, (1 << 64) - 1}
    for _ in range(6):  # crowds around a few fingerprints, one of them dense
        base = rng.getrandbits(64)
        bits |= {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(60)}
    base = rng.getrandbits(64)
    bits |= {base ^ x for x in rng.sample(range(1 << 9), 150)} | {rng.getrandbits(64) for _ in range(100)}
    signed = [simhash._signed(b) for b in bits]
    table = spark.createDataFrame([(b,) for b in signed], "bits long")
    links = [(r.a, r.b) for r in near_links(table, 2, most).collect()]
    close = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    assert all(close(a, b) for a, b in links)
    both = {frozenset(x) for x in links}
    assert groups(signed, lambda a, b: frozenset((a, b)) in both) == groups(signed, close)


def corpus():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(900)] + ["É", "ẞ", "x\x85y", "a\xa0b"]
    docs = [None, "", " \t", "Zero", "zero", "one TWO", "One two", "a b c d", "b " * 30_000]
    for _ in range(40):
        docs.append(" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))))
    for _ in range(160):  # copies, near and exact, and copies of those
        text = rng.choice(docs[9:]).split(" ")
        for _ in range(rng.choice([0, 1, 1, 2])):
            text[rng.randrange(len(text))] = rng.choice(words)
        docs.append(" ".join(text))
    return docs


def test_query_is_brute_force(spark, tmp_path):
    docs = [(3 * k + 1, t) for k, t in enumerate(corpus())]
    random.Random(1).shuffle(docs)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = {i: slow_fingerprint(t) for i, t in docs}
    component = groups(sorted(want), lambda a, b: (want[a] ^ want[b]).bit_count() <= 2)
    got = op12_simhash_near_dedup(spark, str(tmp_path))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect())) == sorted((i, f"{want[i]:016x}", component[i]) for i, _ in docs)
    assert len(set(component.values())) < len(set(want.values())) < len(want)


def test_edge_cases(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(4, text), (9, text), (None, text), (4, "other words here"), (None, "alone"), (None, "alone"), (5, None), (6, ""), (5, None)]
    docs = spark.createDataFrame([(i, t, 1, 2, True) for i, t in rows], "doc_id long, text string, bits int, salt int, named boolean")
    got = simhash_components(docs).collect()
    assert sorted((repr(r.id), r.component_id or -1) for r in got) == sorted([("4", 4), ("9", 4), ("None", 4), ("4", 4), ("None", -1), ("None", -1), ("5", 5), ("6", 5), ("5", 5)])
    assert {r.bits for r in got if r.id in (5, 6)} == {0} and fingerprint("A b\nC") == fingerprint("a B c")
    assert simhash_components(docs.limit(0)).count() == 0
    everything = spark.createDataFrame([(k, text) for k in range(500)], "doc_id long, text string")
    assert {r.component_id for r in simhash_components(everything).collect()} == {0}
