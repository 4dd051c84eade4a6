import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from screenloom.llm import ngram_join
from screenloom.llm.exact_dedup import drop_exact_copies, exact_dedup
from screenloom.llm.line_dedup import drop_boilerplate
from screenloom.llm.ngram_join import ngram_jaccard_components, ngram_set

SCHEMA = "doc_id long, text string, _keep string, kept string"


def test_exact_dedup_rules(spark):
    rows = [(5, "a  b"), (3, "a b"), (4, "a\t\nb"), (7, None), (6, ""), (8, " "), (9, "x" * 200_000), (10, "x" * 200_000), (None, "a b"), (None, "alone"), (3, "a b")]
    docs = spark.createDataFrame([(i, t, "k", "mine") for i, t in rows], SCHEMA)
    got = exact_dedup(docs).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(set)
    for r in got:
        by[r.keep_id, r.group_size].add((r.doc_id, r.kept))
    assert by == {
        (3, 5): {(5, False), (3, True), (4, False), (None, False)},
        (6, 2): {(7, False), (6, True)},
        (8, 1): {(8, True)},
        (9, 2): {(9, True), (10, False)},
        (None, 1): {(None, True)},
    }
    digest = {r.doc_id: r.text_sha256 for r in got}
    assert digest[4] == hashlib.sha256(b"a b").hexdigest()
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns and {r.kept for r in kept.collect()} == {"mine"}
    assert exact_dedup(docs.limit(0)).count() == 0


def brute(docs, size, least, of):
    sets = {i: set(ngram_set(t, size).tolist()) for i, t in docs}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            both = len(sets[i] & sets[j])
            if both and both * of >= least * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    base = [rng.choice(vocabulary) for _ in range(150)]
    docs = []
    for _ in range(70):  # near copies of one text, with a few words changed, and copies of those
        words = list(rng.choice(docs)[1].split()) if docs and rng.random() < 0.3 else list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary) + "x" * rng.randint(0, 2)
        docs.append((len(docs), " ".join(words)))
    for _ in range(60):  # unrelated texts, half of them with the common passage
        words = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        docs.append((len(docs), " ".join(words + passage * rng.randint(0, 1))))
    docs += [(len(docs) + k, docs[k * 3][1].upper()) for k in range(20)]
    docs += [(len(docs) + k, t) for k, t in enumerate(["", None, " \n", "one", "One", "one two", "one two"])]
    return docs


@pytest.mark.parametrize(("seed", "size", "least", "rare"), [(1, 3, 90, 16), (2, 5, 80, 16), (3, 3, 90, 2), (4, 2, 70, 3)])
def test_join_is_brute_force(spark, monkeypatch, seed, size, least, rare):
    monkeypatch.setattr(ngram_join, "RARE", rare)
    docs = corpus(seed)
    got = ngram_jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), size, least, 100).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute(docs, size, least, 100) and len(got) == len(docs)


def test_join_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k l"), (1, "short"), (None, "a b c d e f g h i j k l"), (2, "A b c d e f g h i j k l")], "doc_id long, text string")
    got = sorted((r.id or 0, r.n_shingles, r.component_id) for r in ngram_jaccard_components(docs, 3, 90, 100).collect())
    assert got == [(0, 10, None), (1, 1, 1), (1, 10, 1), (2, 10, 1)]
    assert ngram_jaccard_components(docs.limit(0), 3, 90, 100).count() == 0


def test_lines_is_brute_force(spark):
    rng = random.Random(5)
    pages = []
    for i in range(200):
        host = "big.example.com" if i % 3 else f"h{i % 7}.example.org"
        lines = [rng.choice(["nav", "menu", "about"]) for _ in range(2)] + [f"text {rng.randint(0, 300)}" for _ in range(4)]
        pages.append((i, f"https://u@{host.upper()}:80/p?{i}" if i % 11 else None, "<p>" + "</p>\r\n<p> ".join(lines) + "</p>" if i % 13 else None))
    got = {r.page_id: r for r in drop_boilerplate(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    parts = {i: (u.split("@")[1].split(":")[0].lower() if u else "", [x.strip(" ") for x in re.split("[\r\n]+", re.sub("<[^>]*>", "\n", h or "")) if x.strip(" ")]) for i, u, h in pages}
    total = collections.Counter(h for h, _ in parts.values())
    seen = collections.Counter((h, x) for h, lines in parts.values() for x in set(lines))
    for i, (host, lines) in parts.items():
        kept = [x for x in lines if not host or seen[host, x] < 3 or seen[host, x] * 100 <= 30 * total[host]]
        assert (got[i].host, got[i].n_lines, got[i].n_dropped, got[i].text) == (host, len(lines), len(lines) - len(kept), "\n".join(kept))
    assert sum(r.n_dropped for r in got.values())
    assert drop_boilerplate(spark.createDataFrame(pages[:1], "page_id long, url string, html string").filter(F.lit(False))).count() == 0


def test_singles_of_a_smaller_row_do_not_count(spark):
    from screenloom.llm.ngram_join import ngram_jaccard_components

    shared, own = [f"w{i}" for i in range(102)], [f"x{i}" for i in range(92)]
    rows = [(5, " ".join(shared)), (6, " ".join([*shared[:-1], "y"])), (5, " ".join(own)), (7, "a b c d")]
    out = ngram_jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), size=3, least=90).collect()
    assert {(r.id, r.n_shingles, r.component_id) for r in out} == {(5, 100, 5), (5, 90, 5), (6, 100, 5), (7, 2, 7)}


def shingles(text, size):
    """Sets by another way: tuples of words, without hashes."""
    words = re.findall("[^\\x20\\x09-\\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def test_join_of_repeated_and_nameless_rows_by_word_tuples(spark):
    rng = random.Random(8)
    marks = ["É", "\x85", "\xa0", "ß", "İ", "\x1c"]
    docs = [(i, t if i % 9 else " \t".join([t, *marks[: i % 6], "Z"])) for i, t in corpus(6)]
    docs += [(500, None), (501, "a " * 60_000), (502, "A " * 60_000), (503, " ".join(f"v{i}" for i in range(40_000)))]
    docs += [(503, " ".join(f"v{i}" for i in range(40_000))), (503, "x y z"), (None, docs[3][1]), (None, ""), (None, None)]
    rng.shuffle(docs)
    table = spark.createDataFrame([(i, t, 1, 2, "n") for i, t in docs], "doc_id long, text string, n int, rows int, digest string")
    got = ngram_jaccard_components(table, 3, 90, 100).collect()
    sets = [(i, shingles(t, 3)) for i, t in docs]
    assert collections.Counter((r.id, r.n_shingles) for r in got) == collections.Counter((i, len(s)) for i, s in sets)
    largest = {}
    for i, s in sets:
        if i is not None and len(s) >= len(largest.get(i, ())):
            largest[i] = s
    up = {i: {i} for i in largest}
    for i in largest:
        for j in largest:
            both = len(largest[i] & largest[j])
            if i < j and 100 * both >= 90 * len(largest[i] | largest[j]) > 0 and up[i] is not up[j]:
                up[i] |= up[j]
                for k in up[j]:
                    up[k] = up[i]
    assert {(r.id, r.component_id) for r in got} == {(i, min(g)) for i, g in up.items()} | {(None, None)}


def test_far_leaders_leave_no_pairs(spark, monkeypatch):
    """Two large groups of near copies with one common passage aren't paired, document by document."""
    seen = []
    whole = ngram_join._overlaps
    monkeypatch.setattr(ngram_join, "_overlaps", lambda pairs, segments: seen.append(pairs.count()) or whole(pairs, segments))
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(90)]
    docs = []
    for group in range(2):
        base = [f"g{group}w{i}" for i in range(400)]
        for copy in range(60):
            words = list(base)
            words[rng.randrange(400)] = f"x{rng.randrange(1000)}"
            # the passage is rarer than the texts of the groups, so their documents meet under it
            docs.append((len(docs), " ".join(words + passage * (copy < 20))))
    got = {r.id: r.component_id for r in ngram_jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), 3, 90, 100).collect()}
    assert got == {i: 60 * (i // 60) + 20 * (i % 60 >= 20) for i in range(120)}
    # of the documents with the passage alone there are 20 * 20 pairs
    assert seen[-1] < 40
