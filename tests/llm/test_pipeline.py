"""The pipeline against a brute-force version of each stage."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from screenloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    nulls = spark.createDataFrame([(-1, None, None, None, None), (-2, "42 ...", "en", "s", 6)], docs.schema)
    docs = docs.unionByName(nulls)
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], SF).cache())
    return out


def test_stages(stages):
    from tests.llm.test_dedup_and_join import brute

    docs, known, exact, near, clean, packed = stages
    assert [d.columns for d in stages[1:5]] == [docs.columns] * 4
    ids = lambda d: sorted(r.doc_id for r in d.select("doc_id").collect())
    assert ids(known) == [i for i in ids(docs) if i >= 0]
    first = {}
    for r in sorted(known.collect(), key=lambda r: r.doc_id):
        first.setdefault(" ".join(r.text.replace("\n", " ").split(" ")), r.doc_id)
    assert set(ids(exact)) <= set(ids(known)) and len(ids(exact)) == len(first)
    groups = brute([(r.doc_id, r.text) for r in exact.collect()], 5, 80, 100)
    assert ids(near) == sorted(i for i, (_, c) in groups.items() if i == c)
    assert ids(clean) == ids(near) and "@mail" not in " ".join(r.text for r in clean.collect() if "example.com" in r.text)
    assert sorted({r.doc_id for r in packed.collect()}) == ids(clean)


def test_queries_have_their_columns(spark):
    q = queries.QUERIES
    assert len(q) == 13 and set(queries.ORACLE_SQL) <= set(q)
    assert q["op1_ngram_jaccard_join"](spark, SF).columns[:3] == ["doc_id", "n_shingles", "component_id"]
    assert q["op2_language_id"](spark, SF).columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]


def test_language_stage_rejects_junk(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rng = random.Random(2)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    junk = [draw("abcdefghijklmnopqrstuvwxyz ", 600), draw("#$%&*()_+=-{}[]|;:<>?/~ 0123456789x", 600), " ".join(draw("xqzkjvw", 6) for _ in range(80))]
    junk += ["政府昨天宣布了一项关于公共交通的新法律,议会将在下周审议该法律。工会已经表示反对。", "Η κυβέρνηση ανακοίνωσε χθες έναν νέο νόμο για τις δημόσιες συγκοινωνίες, ο οποίος θα εξεταστεί από το κοινοβούλιο."]
    junk += ["Rząd ogłosił wczoraj nową ustawę o transporcie publicznym, która zostanie rozpatrzona przez parlament w przyszłym tygodniu."]
    planted = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(junk)], docs.schema)
    kept = corpus_pipeline.keep_known_languages(spark, docs.unionByName(planted), SF)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_stages_on_empty_and_repeated_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    few, repeats = docs.filter("doc_id < 12"), docs.filter("doc_id < 3")
    rows = few.unionByName(few.filter("doc_id < 3")).unionByName(few.filter("doc_id = 4").withColumn("doc_id", F.lit(None).cast("long")))
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0 and (name == "best_fit_packing" or empty.columns == docs.columns)
        own = docs.unionByName(repeats) if name == "language_id" else rows  # a network needs texts to learn from
        got = collections.Counter(r.doc_id for r in stage(spark, own, SF).select("doc_id").collect())
        if name == "exact_dedup":
            first = {}
            for r in few.orderBy("doc_id").collect():
                first.setdefault(" ".join(re.split(r"[\x20\x09-\x0D]+", r.text)), r.doc_id)
            assert got == {i: 1 + (i < 3) for i in first.values()}
        elif name in ("language_id", "pii_surrogates"):
            assert got == collections.Counter(r.doc_id for r in own.select("doc_id").collect())
        elif name == "best_fit_packing":
            assert set(got) == {None, *range(12)} and got[0] % 2 == 0


def test_surrogates_stage_leaves_the_rest_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    # another way to see what looks like personal data, wide on purpose
    hint = re.compile(r"@|\d{7}|\d[-. ()]+\d{3}|\d+\.\d+\.\d+\.\d+|[0-9a-f]{32}|(?i:token|secret|password|api_?key)|[A-Z]{4}\d|Mr|Mrs|Ms|[A-ZÄÖÜ]\w+ [A-ZÄÖÜ]\w+|\w+:\w+:")
    changed = [r for r in corpus_pipeline.replace_personal_data(spark, docs, SF).collect() if r.text != before[r.doc_id].text]
    assert all(hint.search(before[r.doc_id].text) and r.n_chars == len(r.text) for r in changed)
