"""Exact deduplication by skew-safe combining, with DataFrame functions only.

Texts are equal when they are identical after every run of ASCII white space is made one space.
Groups are combined in three stages, and every stage groups by the full normalised text beside
its digest, so a digest collision can never merge different texts:

1. within each task (Spark's partial aggregation) rows of equal text become one;
2. these are merged in (digest, salt) groups, so a text that a third of all rows share is dealt
   over ``salts`` tasks;
3. the at most ``salts`` winners of each text are merged globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.llm.common import salted_join, unused_prefix, without

#: ASCII white space, as a Java regular expression.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def normalised(text: Column) -> Column:
    """Runs of ASCII white space as one space each; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per distinct text: text_sha256, check (xxhash64), length, keep_id, group_size.

    Null ids take part in the counts; keep_id is the smallest id that isn't null.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"),
        normalised(F.col(text_col)).alias("_text"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).cast("int").alias("_salt"),
    ).withColumn("text_sha256", F.sha2("_text", 256))
    salted = rows.groupBy("text_sha256", "_salt", "_text").agg(F.min("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    whole = salted.groupBy("text_sha256", "_text").agg(F.min("_id").alias("keep_id"), F.sum("_n").alias("group_size"))
    return whole.select(
        "text_sha256", F.xxhash64("_text").alias("_check"), F.length("_text").alias("_length"), "keep_id", "group_size"
    )


def _labelled(docs: DataFrame, id_col: str, text_col: str, salts: int) -> tuple[DataFrame, str]:
    """All columns of ``docs`` with keep_id, group_size, kept and text_sha256, and the prefix that these names bear."""
    m, text = unused_prefix(docs), normalised(F.col(text_col))
    rows = docs.withColumns({f"{m}text_sha256": F.sha2(text, 256), f"{m}check": F.xxhash64(text), f"{m}length": F.length(text)})
    # only texts that occur more than once need to be looked up
    copies = exact_groups(docs, id_col, text_col, salts).filter("group_size > 1").select(
        F.col("text_sha256").alias(f"{m}text_sha256"),
        F.col("_check").alias(f"{m}check"),
        F.col("_length").alias(f"{m}length"),
        F.col("keep_id").alias(f"{m}keep_id"),
        F.col("group_size").alias(f"{m}group_size"),
    )
    out = salted_join(rows, copies, [f"{m}text_sha256", f"{m}check", f"{m}length"], F.col(id_col), "left", salts)
    own = F.when(F.col(f"{m}group_size").isNull(), F.col(id_col)).otherwise(F.col(f"{m}keep_id"))
    out = out.withColumn(f"{m}keep_id", own).withColumn(f"{m}group_size", F.coalesce(f"{m}group_size", F.lit(1).cast("long")))
    return out.withColumn(f"{m}kept", F.col(id_col).eqNullSafe(F.col(f"{m}keep_id"))), m


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """Label every row: all columns of ``docs``, then keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id stays. Null text counts as empty; very long texts
    are compared whole. Repeated rows of the smallest id are all labelled kept, since no value
    tells them apart. Rows with a null id stay only where a group has no other id. Columns of
    ``docs`` that bear the names of the four results are replaced, all others pass through. An empty
    table gives no rows. Groups are formed by full content; a row then finds its group by SHA-256,
    a second hash of 64 bits and the length.
    """
    names = ["keep_id", "group_size", "kept", "text_sha256"]
    out, m = _labelled(docs, id_col, text_col, salts)
    return out.select(*without(docs, names).columns, *[F.col(f"{m}{c}").alias(c) for c in names])


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` labels kept, with the columns of ``docs``."""
    out, m = _labelled(docs, id_col, text_col, salts)
    return out.filter(f"{m}kept").select(*docs.columns)
