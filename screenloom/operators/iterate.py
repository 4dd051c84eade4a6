"""Writing intermediate results of iterations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder of spark.checkpoint.dir, which all machines share.

    A local session without that setting gets a temporary folder.
    """
    sc = spark.sparkContext
    where = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if where is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(where)
    return f"{where.rstrip('/')}/screenloom/{uuid.uuid4().hex}-{name}"


def saved(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to a new folder, with options of the Parquet writer, and read back."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_out(df: DataFrame, *by: str, rows: int = 200_000) -> DataFrame:
    """``df`` written and brought together by columns ``by`` in as many parts as its rows need, so that what a task holds doesn't grow with the table."""
    kept = saved(df, "spread")
    return kept.repartition(max(1, -(-kept.count() // rows), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *by)
