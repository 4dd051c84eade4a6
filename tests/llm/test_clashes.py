"""Columns of the caller that bear names the operators use inside."""

import pytest
from pyspark.sql import functions as F

from screenloom.llm.exact_dedup import drop_exact_copies, exact_dedup
from screenloom.llm.langid import identify_languages
from screenloom.llm.licenses import scan_licenses
from screenloom.llm.line_dedup import drop_boilerplate
from screenloom.llm.ngram_join import ngram_jaccard_components
from screenloom.llm.packing import pack_documents
from screenloom.llm.pii import replace_entities

NAMES = ["_salt", "__salt", "_check", "_length", "_id", "_n", "_keep_id", "_kept", "_group_size", "_text_sha256", "_k0", "_k1", "_k2", "_k3", "_new", "_lettered", "_Share", "_lang", "found", "place", "entity", "Kind", "n", "digest", "rows", "lines", "dropped", "host", "part", "bin", "draw"]
TEXTS = ["mail a.b@example.com twice", "mail a.b@example.com twice", "Das ist ein kleiner Text", "This is a small text", "Das ist ein kleiner Text", None, ""]
RESULTS = {exact_dedup: ["KEEP_ID", "kept"], drop_exact_copies: [], replace_entities: ["N_entities"], identify_languages: ["Score", "lang_pred"]}


@pytest.fixture(scope="module")
def tables(spark):
    plain = spark.createDataFrame([(i, t, "de" if t and "Das" in t else "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    return plain, plain.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in NAMES})


@pytest.mark.parametrize("operator", list(RESULTS), ids=lambda f: f.__name__)
def test_callers_columns_pass_through(tables, operator):
    plain, more = tables
    more = more.withColumns({c: F.lit("mine") for c in RESULTS[operator]})
    args = {"key": "k"} if operator is replace_entities else {}
    want = {r.doc_id: r.asDict() for r in operator(plain, **args).collect()}
    out = operator(more, **args)
    got = {r.doc_id: r.asDict() for r in out.collect()}
    assert len({c.lower() for c in out.columns}) == len(out.columns) and set(got) == set(want)
    for i, row in got.items():
        assert {c: row[c] for c in want[i]} == want[i]
        assert all(row[c] == f"{c} {i}" for c in NAMES)


def test_operators_that_look_at_two_columns(tables):
    import public_tokenizers

    plain, more = tables
    path = public_tokenizers.path("byte_bpe_50k.json")
    for operator in (ngram_jaccard_components, lambda d: pack_documents(d, path), scan_licenses):
        assert sorted(map(str, operator(plain).collect())) == sorted(map(str, operator(more).collect()))
    pages = [d.withColumnsRenamed({"doc_id": "page_id", "text": "html"}).withColumn("url", F.lit("http://a/")) for d in (plain, more.drop("host"))]
    assert sorted(map(str, drop_boilerplate(pages[0]).collect())) == sorted(map(str, drop_boilerplate(pages[1]).collect()))
