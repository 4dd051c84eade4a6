"""Helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.operators.iterate import new_folder, saved


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    return new_folder(spark, "").split("/screenloom/")[0]


#: Write a result as Parquet in the shared folder and read it back; this cuts the lineage.
stored = saved


def unused_prefix(df: DataFrame) -> str:
    """Underscores with which no column of ``df`` begins, so that no name with them is taken."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in df.columns), default=0))


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without the columns of these names, in any letter case."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


def salted_join(
    large: DataFrame, small: DataFrame, keys: list[str], spread: Column, how: str = "left", salts: int = 16
) -> DataFrame:
    """Join in which the rows of one key on the large side are spread over ``salts`` tasks.

    ``small`` has at most one row for a key; each of its rows is sent ``salts`` times.
    ``spread`` is an expression over ``large`` that varies within a key (an id).
    """
    salt = unused_prefix(large) + unused_prefix(small) + "salt"
    left = large.withColumn(salt, F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = small.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, salt], how).drop(salt)
