"""A corpus pipeline over ``documents``: STAGES, run() and ORACLE_SQL.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet in the shared
folder and read again as the documents of the next one. All but the last stage return the columns
of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.llm.common import stored
from screenloom.llm.exact_dedup import drop_exact_copies
from screenloom.llm.langid import UNKNOWN, identify_languages
from screenloom.llm.ngram_join import ngram_jaccard_components
from screenloom.llm.packing import pack_documents
from screenloom.llm.pii import replace_entities, surrogate_key


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in none of the labelled languages, as the network sees it, and those without a letter.

    Null and empty texts have no letter and go. Repeated rows stay or go together, whatever their id;
    long texts are judged whole; without labels every document goes. An empty table gives no rows.
    """
    return identify_languages(docs, reject=True).filter(F.col("lang_pred") != UNKNOWN).select(*docs.columns)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the one with the smallest doc_id.

    Null counts as empty. Repeated rows of the smallest id all stay, since no value tells them apart;
    null ids stay only in groups without another id. An empty table gives no rows.
    """
    return drop_exact_copies(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (5-word shingles, Jaccard 0.8 or more) keep the smallest doc_id.

    Documents without an id can't be in a component and stay, as do null texts and texts without
    words. Rows of one id stay or go together. An empty table gives no rows.
    """
    groups = ngram_jaccard_components(docs, size=5, least=80, of=100)
    gone = groups.filter(F.col("component_id") != F.col("id")).select(F.col("id").alias("doc_id"))
    # the ids that go grow with the input: they are never broadcast
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*docs.columns)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates; n_chars follows the new text.

    Null texts stay null and keep n_chars. Equal texts get equal surrogates, repeated rows and null
    ids stay as many as they are. The key is that of spark.screenloom.surrogateKey. An empty table
    gives no rows.
    """
    out = replace_entities(docs, key=surrogate_key(spark)).drop("n_entities")
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens.

    Null text counts as empty; longer documents are cut; repeated rows are packed as often as they
    occur and a null id stays null. An empty table gives no rows.
    """
    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0, special=True)


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", keep_first_copies),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("pii_surrogates", replace_personal_data),
    ("best_fit_packing", pack),
]

#: No SQL can express the trained classifier of the first stage; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
