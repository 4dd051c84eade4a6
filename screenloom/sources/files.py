"""Reading and writing the files of a screen."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from screenloom.sources import by_tile

LIBRARY = "sgrna string, sgrna_seq string, grp int"
METADATA = "well int, tile int, magnification string, nuclei array<struct<label:int,y:double,x:double>>"


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows just read from text files with their place, from 0, in all files one after another, in the order of their paths.

    Two passes: rows are counted by file and block, and a row's place is what lies before its block and its place in
    it. No row is moved for that. Blocks are ordered within their file; only the totals of files, of which the
    driver has a list anyway, are summed in one window.
    """
    tagged = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"))
    blocks = tagged.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    within = F.coalesce(F.sum("_rows").over(W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    files = blocks.groupBy("_file").agg(F.sum("_rows").alias("_all"))
    files = files.select("_file", F.coalesce(F.sum("_all").over(W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_earlier"))
    offsets = blocks.withColumn("_within", within).join(files, "_file").select("_file", "_block", (F.col("_earlier") + F.col("_within") - F.col("_first")).alias("_offset"))
    return tagged.join(offsets, ["_file", "_block"]).withColumn(name, F.col("_id") + F.col("_offset")).drop("_file", "_block", "_id", "_offset")


def read_library(spark: SparkSession, path: str) -> DataFrame:
    """Barcode library CSV files with headers; lib_idx is the place of a row in all of them, in the order of their paths."""
    return numbered(spark.read.schema(LIBRARY).option("header", True).csv(path), "lib_idx")


def parse_names(files: DataFrame, path: str = "path") -> DataFrame:
    """Well, tile, channels and sequence number of image files; other names are left out. A name without a well belongs to Well1."""
    name = F.substring_index(path, "/", -1)
    part = lambda n: F.regexp_extract(name, r"^(?:Well(\d+)_)?Point1_(\d{4})_Channel([^_]+)_Seq(\d{4})\.nd2$", n)
    out = files.select(
        F.col(path).alias("path"), F.coalesce(part(1).try_cast("long"), F.lit(1).cast("long")).alias("well"), part(2).try_cast("long").alias("tile"), F.split(part(3), ",").alias("channels"), part(4).try_cast("long").alias("seq")
    )
    return out.filter(F.col("tile").isNotNull())


def magnification(path: Column) -> Column:
    low = F.lower(path)
    return F.when(low.contains("genotyping") | low.contains("10x"), "10X").when(low.contains("phenotyping") | low.contains("40x"), "40X").otherwise("10X")


def cycles_in_order(files: DataFrame, path: str = "path") -> DataFrame:
    """The number of each file's cycle folder, and its place among the cycles of a tile."""
    number = F.regexp_extract(path, r"cycle_(\d+)", 1).try_cast("long")
    out = files.withColumn("cycle", number).filter(F.col("cycle").isNotNull())
    return out.withColumn("place", F.dense_rank().over(W.partitionBy("well", "tile").orderBy("cycle")).cast("long"))


def read_tile_tables(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The CSV files of all tiles under ``path``, with the well and tile that the last matching part of each file's path gives."""
    rows = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(path).withColumn("_file", F.col("_metadata.file_path"))
    part = lambda n: F.regexp_extract("_file", r".*Well(\d+)_(?:Tile|Point1_)(\d+)", n).try_cast("long")
    return rows.withColumns({"well": part(1), "tile": part(2)}).drop("_file")


def concatenate_wells(wells: dict[int, DataFrame]) -> DataFrame:
    """Tables of several wells one below the other, tagged with ``well``; columns that one lacks are null."""
    out = None
    for well, df in wells.items():
        tagged = df.withColumn("well", F.lit(well).cast("long"))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Segmentation metadata JSON files, one row per nucleus."""
    files = spark.read.schema(METADATA).option("multiLine", True).json(path)
    return files.select("well", "tile", "magnification", F.explode("nuclei").alias("n")).select("well", "tile", "magnification", "n.label", "n.y", "n.x")


def write_by_tile(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """One folder per well and tile; the rows of a tile are written by one task. Parquet by a writer that is made for many small files."""
    if file_format == "parquet":
        by_tile.write(df, path)
        return
    df.repartition("well", "tile").write.mode("overwrite").partitionBy("well", "tile").format(file_format).option("header", True).save(path)


def read_by_tile(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet files that :func:`write_by_tile` wrote; ``schema`` names well and tile too."""
    return by_tile.read(spark, path, schema)


def mapping_json(transforms: DataFrame, errors: DataFrame) -> DataFrame:
    """One JSON text per well: its transform, its error metrics and the number of matched points."""
    both = transforms.join(errors, "well")
    return both.select(
        "well",
        F.to_json(
            F.struct(
                F.struct("dx", "dy", "theta", "scale_x", "scale_y").alias("transform"), F.struct("mean_error", "median_error", "max_error", "rmse").alias("error_metrics"), F.col("n").alias("num_matched_points")
            )
        ).alias("record"),
    )


def write_json_lines(records: DataFrame, path: str) -> None:
    records.select("record").write.mode("overwrite").text(path)


WELL_NAME = re.compile(r"^([A-H])(\d{1,2})$")


def well_number(name: str, columns: int = 3) -> int:
    """Number of a plate well such as A1 on a plate with ``columns`` columns, from 1."""
    m = WELL_NAME.match(name)
    if not m:
        raise ValueError(f"not a well: {name}")
    return (ord(m[1]) - 65) * columns + int(m[2])
