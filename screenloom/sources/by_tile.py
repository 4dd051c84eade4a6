"""Tables with a folder per well and tile as a Spark data source: Parquet files under ``well=…/tile=…``.

The layout is the one of ``partitionBy("well", "tile")``, which Spark's own reader reads too. A screen has hundreds of thousands
of tiles with few rows each, and what counts is the work for each file: here a task opens many, none is planned by itself,
and folders are listed in one go. Files appear under their names only when the whole job commits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter
from pyspark.sql.types import StructType

from screenloom.sources.npy import BATCH, RANGE_BYTES, Files, Written, move_all, opened, qualified, small_files

KEYS = ("well", "tile")
_NULL = "__HIVE_DEFAULT_PARTITION__"


def _folder(values) -> str:
    return "/".join(f"{k}={_NULL if v is None or v == '' else quote(str(v), safe=' ')}" for k, v in zip(KEYS, values, strict=True))


def _values(path: str) -> list[str | None]:
    parts = dict(p.split("=", 1) for p in path.split("/")[:-1] if "=" in p)
    return [None if parts[k] == _NULL else unquote(parts[k]) for k in KEYS]


class ByTileWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool) -> None:
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = opened(self.path)
        folder, written, key, writer = f"{root}/_temporary-{self.job}", [], None, None
        fs.create_dir(folder, recursive=True)
        for batch in iterator:
            rest = batch.select([c for c in batch.schema.names if c not in KEYS])
            codes = [batch.column(k).dictionary_encode(null_encoding="encode") for k in KEYS]
            change = np.any([np.diff(c.indices.to_numpy()) != 0 for c in codes], axis=0)
            ends = [*(np.flatnonzero(change) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for first, end in zip([0, *ends], ends, strict=False):
                own = [batch.column(k)[first].as_py() for k in KEYS]
                if own != key:  # the rows of a tile come together
                    if writer is not None:
                        writer.close()
                    name = f"{uuid.uuid4().hex}.parquet"  # another for each attempt of a task
                    key, writer = own, pq.ParquetWriter(f"{folder}/{name}", rest.schema, filesystem=fs)
                    written.append((f"{folder}/{name}", f"{root}/{_folder(own)}/part-{name}"))
                writer.write_batch(rest.slice(first, end - first))
        if writer is not None:
            writer.close()
        return Written(written)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = opened(self.path)
        fs.create_dir(root, recursive=True)
        if self.overwrite:
            for old in fs.get_file_info(pafs.FileSelector(root)):
                if old.base_name != f"_temporary-{self.job}":
                    (fs.delete_dir if old.type == pafs.FileType.Directory else fs.delete_file)(old.path)
        move_all(fs, root, messages)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, root = opened(self.path)
        folder = f"{root}/_temporary-{self.job}"
        if fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)


class ByTileReader(DataSourceReader):
    def __init__(self, options, schema: StructType) -> None:
        self.path, self.schema, self.only = options["path"], schema, {}

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute in (("well",), ("tile",)):
                self.only[f.attribute[0]] = str(f.value)
            yield f

    def partitions(self) -> list[Files]:
        fs, root = opened(self.path)
        found = []
        for f in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
            below = f.path.removeprefix(root).strip("/")
            if f.type == pafs.FileType.File and f.path.endswith(".parquet") and not any(x.startswith(("_", ".")) for x in below.split("/")):
                if all(self.only.get(k, v) == v for k, v in zip(KEYS, _values(below), strict=True)):
                    found.append((f.path, f.size))
        return small_files(sorted(found), RANGE_BYTES)

    def read(self, partition: Files | None) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:
            return
        fs, root = opened(self.path)
        schema = to_arrow_schema(self.schema)
        names = [n for n in schema.names if n not in KEYS]
        held, rows = [], 0
        for path, _ in partition.files:
            place = dict(zip(KEYS, _values(path.removeprefix(root)), strict=True))
            with fs.open_input_file(path) as file:
                for batch in pq.ParquetFile(file).iter_batches(BATCH, columns=names):
                    same = lambda k: pa.array([place[k]], pa.string()).cast(schema.field(k).type).take(pa.array(np.zeros(batch.num_rows, np.int32)))  # noqa: B023, E731
                    held.append(pa.RecordBatch.from_arrays([same(n) if n in KEYS else batch.column(n).cast(schema.field(n).type) for n in schema.names], schema=schema))
                    rows += batch.num_rows
                    if rows >= BATCH // 4:
                        yield pa.concat_batches(held)
                        held, rows = [], 0
        if held:
            yield pa.concat_batches(held)


class ByTileDataSource(DataSource):
    """Option: path. A schema is given for reading, with well and tile in it."""

    @classmethod
    def name(cls) -> str:
        return "by_tile"

    def reader(self, schema: StructType) -> ByTileReader:
        return ByTileReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> ByTileWriter:
        return ByTileWriter(self.options, overwrite)


def _ready(spark: SparkSession) -> None:
    spark.dataSource.register(ByTileDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    _ready(spark)
    return spark.read.format("by_tile").schema(schema).load(qualified(spark, path))


def write(df: DataFrame, path: str) -> None:
    _ready(df.sparkSession)
    together = df.repartition(*KEYS).sortWithinPartitions(*KEYS)
    together.write.format("by_tile").mode("overwrite").save(qualified(df.sparkSession, path))
