"""The queries of this package, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.llm.bpe import encode_bpe
from screenloom.llm.exact_dedup import exact_dedup
from screenloom.llm.gif_media import gif_media, gif_payloads
from screenloom.llm.langid import held_out, identify_languages
from screenloom.llm.licenses import TEMPLATES, scan_licenses
from screenloom.llm.line_dedup import drop_boilerplate
from screenloom.llm.ngram_join import ngram_jaccard_components
from screenloom.llm.packing import pack_documents
from screenloom.llm.periodic import periodic_runs, with_planted_runs
from screenloom.llm.pii import replace_entities, surrogate_key
from screenloom.llm.prefix_trie import prefix_trie
from screenloom.llm.simhash import simhash_components
from screenloom.llm.warc import archived_pages, write_archives


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_jaccard_components(docs, size=3, least=90, of=100).withColumnRenamed("id", "doc_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by a network trained on those that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify_languages(docs)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a GIF and read back, with digests of both."""
    return gif_payloads(gif_media(table(spark, sf_dir, "documents")))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0, special=True)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again; digests of the ids and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = encode_bpe(docs, path, public_tokenizers.PATTERN, decoded_col="decoded")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page without the boilerplate lines of its host."""
    out = drop_boilerplate(table(spark, sf_dir, "pages").select("page_id", "url", "html"), percent=30, least_pages=3)
    return out.select("page_id", "host", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, key=surrogate_key(spark)).select("doc_id", "n_entities", "text")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return archived_pages(spark, write_archives(pages))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all documents that are close to a licence notice."""
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=80)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the id of the copy that stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, rebuilt with the head of another of their group of five."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv = F.col("conv_id")
    return prefix_trie(turns, base=conv - conv % 5, head=F.crc32(conv.cast("string").cast("binary")) % 9, most_head=8)


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 64-bit SimHash fingerprints differ in at most two bits."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash_components(docs, size=3, radius=2, seed=42)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of periodic words of every document, about a tenth of them made periodic beforehand."""
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    out = periodic_runs(docs, least=12)
    # the longest; on ties the one that starts first, then of the shortest period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return out.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.less")).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


OP6_SQL = r"""
WITH rows AS (
  SELECT page_id,
         lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         list_filter(list_transform(string_split_regex(regexp_replace(coalesce(html, ''), '<[^>]*>', chr(10), 'g'), '[\r\n]+'),
                                    lambda x: trim(x, ' ')), lambda x: x <> '') AS lines
  FROM pages
), line AS (
  SELECT host, unnest(list_distinct(lines)) AS line FROM rows WHERE host <> ''
), total AS (
  SELECT host, count(*) AS pages FROM rows WHERE host <> '' GROUP BY host
), dropped AS (
  SELECT host, list(line) AS dropped
  FROM (SELECT host, line, count(*) AS n FROM line GROUP BY host, line) JOIN total USING (host)
  WHERE n >= 3 AND n * 100 > pages * 30
  GROUP BY host
), kept AS (
  SELECT page_id, host, lines,
         CASE WHEN dropped IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(dropped, x)) END AS kept
  FROM rows LEFT JOIN dropped USING (host)
)
SELECT page_id, host, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped,
       sha256(coalesce(array_to_string(kept, chr(10)), '')) AS text_sha256
FROM kept
"""

OP8_SQL = """
WITH t AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM t
"""

_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
_BIGRAMS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
_WORDS = "list_filter(string_split(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')"
_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP9_SQL = f"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), units AS (
  SELECT doc_id, unnest(range(0, len(l))) AS unit, unnest(l) AS text FROM lines
  UNION ALL
  SELECT doc_id, -1, array_to_string(l, ' ') FROM lines WHERE len(l) > 1
), unit AS (
  SELECT doc_id, unit, {_BIGRAMS} AS b
  FROM (SELECT doc_id, unit, {_WORDS.format("x").replace("lower(x)", "x")} AS w FROM (SELECT doc_id, unit, {_ASCII_LOWER.format("text")} AS x FROM units))
), template AS (
  SELECT license, {_BIGRAMS} AS t
  FROM (SELECT license, {_WORDS.format("text")} AS w FROM (VALUES {_TEMPLATE_ROWS}) AS v(license, text))
), pair AS (
  SELECT doc_id, unit, license, len(list_intersect(b, t)) AS overlap, len(b) AS unit_size, len(t) AS template_size
  FROM unit, template
  WHERE 200 * least(len(b), len(t)) >= 80 * (len(b) + len(t)) AND len(b) > 0
)
SELECT doc_id, unit, license, overlap, unit_size, template_size
FROM pair
WHERE 200 * overlap >= 80 * (unit_size + template_size)
QUALIFY row_number() OVER (PARTITION BY doc_id, unit ORDER BY overlap::DOUBLE / (unit_size + template_size) DESC, license) = 1
"""

OP10_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""

# CRC-32, bit by bit, of the decimal number c
_CRC32 = """xor(list_reduce(list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda crc, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)), 4294967295), 4294967295)"""
OP11_SQL = f"""
WITH own AS (
  SELECT conv_id AS c, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), planned AS (
  SELECT c, turns, {_CRC32} % 9 AS h FROM own
), rebuilt AS (
  SELECT p.c, list_concat(coalesce(b.turns[1:p.h], p.turns[1:0]), p.turns[p.h + 1:]) AS turns FROM planned AS p LEFT JOIN own AS b ON b.c = p.c - p.c % 5
), member AS (
  SELECT c, depth, turns[1:depth] AS prefix, depth = len(turns) AS is_end FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
), node AS (
  SELECT depth, prefix, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * CASE WHEN depth > 0 THEN strlen(prefix[depth].text) ELSE 0 END AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256
  FROM member GROUP BY depth, prefix
), child AS (
  SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL
), full_node AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (depth, prefix)
), subtree AS (
  SELECT up AS depth, prefix[1:up] AS prefix, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM full_node) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_node AS n JOIN subtree AS s USING (depth, prefix) LEFT JOIN node AS p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_language_id": op2_language_id,
    "op3_gif_media": op3_gif_media,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_bpe": op5_bpe,
    "op6_line_dedup": op6_line_dedup,
    "op7_pii_surrogates": op7_pii_surrogates,
    "op8_warc": op8_warc,
    "op9_license_scan": op9_license_scan,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_simhash_near_dedup": op12_simhash_near_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op6_line_dedup": OP6_SQL,
    "op8_warc": OP8_SQL,
    "op9_license_scan": OP9_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_prefix_trie": OP11_SQL,
}
