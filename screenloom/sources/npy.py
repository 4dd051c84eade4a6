"""NumPy array files as a Spark data source: ``spark.read.format("npy")`` and ``df.write.format("npy")``.

Reading plans large files from headers: a file's dtype, shape and order stand in its first bytes, so it is cut into ranges
of rows without being read, and a task seeks to its range. Small files are only listed; a task opens many of them. Comparisons
of the row number with constants leave out ranges (and rows of small files) that can't fit, lower bounds of the value
elements. Columns that the ``columns`` option doesn't name are never made.

Writing takes one row per element; the rows of a file must come together (:func:`write_arrays` sees to that).
Files appear under their names only when the whole job commits, which moves many at a time.
"""

from __future__ import annotations

import ast
import io
import struct
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

COLUMNS = {"path": (pa.string(), "string"), "i": (pa.int64(), "long"), "j": (pa.int64(), "long"), "value": (pa.float64(), "double")}
#: Bytes of a file that one task reads, and elements that it hands on at once.
RANGE_BYTES, BATCH = 64 << 20, 1 << 18
#: Small files that one task opens, and files that are moved at once.
FILES, MOVES = 256, 16


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of Hadoop's default file system if it has none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path with a scheme, and the path in it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" not in path:
        raise ValueError(f"{path} has no scheme; see qualified()")
    return pafs.FileSystem.from_uri(path)


@dataclass
class Header:
    """What stands before the elements of a file. Arrays of one dimension count as one row, those of more as rows of what follows the first."""

    dtype: np.dtype
    rows: int
    columns: int
    by_column: bool
    offset: int


def read_header(file) -> Header:
    """The header at the start of an open file, which is read no further."""
    magic = file.read(8)
    if magic[:6] != b"\x93NUMPY":
        raise ValueError("not an array file")
    wide = magic[6] > 1
    (length,) = struct.unpack("<I" if wide else "<H", size := file.read(4 if wide else 2))
    text = file.read(length)
    fields = ast.literal_eval(text.decode("latin-1"))
    shape, fortran, dtype = fields["shape"], fields["fortran_order"], np.lib.format.descr_to_dtype(fields["descr"])
    if dtype.hasobject or dtype.fields:
        raise ValueError(f"elements of {dtype} aren't numbers")
    rows = shape[0] if len(shape) > 1 else 1
    columns = int(np.prod(shape[1:], dtype=np.int64)) if len(shape) > 1 else int(np.prod(shape, dtype=np.int64))
    if fortran and len(shape) > 2:
        raise ValueError("column order is read for two dimensions only")
    return Header(dtype, rows, columns, fortran and len(shape) == 2, 8 + len(size) + length)


@dataclass
class Range(InputPartition):
    path: str
    header: Header
    first: int
    count: int


@dataclass
class Files(InputPartition):
    """Whole small files, with their sizes; their headers are read by the task."""

    files: list[tuple[str, int]]


def small_files(files: list[tuple[str, int]], most: int) -> list[Files]:
    """Files (path, size) in their order, as many to a task as come to ``most`` bytes."""
    out, held = [], 0
    for path, size in files:
        if not out or len(out[-1].files) == FILES or held + size > most:
            out.append(Files([]))
            held = 0
        out[-1].files.append((path, size))
        held += size
    return out


def checked_header(fs: pafs.FileSystem, path: str, size: int) -> Header:
    with fs.open_input_file(path) as file:
        head = read_header(file)
    if head.offset + head.rows * head.columns * head.dtype.itemsize > size:
        raise ValueError(f"{path} is cut short")
    return head


class NpyReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.columns = options["path"], options.get("columns", ",".join(COLUMNS)).split(",")
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.low, self.high, self.paths, self.least = 0, None, None, None

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            name, v = getattr(f, "attribute", ()), getattr(f, "value", None)
            if name == ("i",):
                if isinstance(f, EqualTo | GreaterThanOrEqual | GreaterThan):
                    self.low = max(self.low, v + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo | LessThanOrEqual | LessThan):
                    high = v - isinstance(f, LessThan)
                    self.high = high if self.high is None else min(self.high, high)
            elif name == ("path",) and isinstance(f, EqualTo | In):
                own = {v} if isinstance(f, EqualTo) else set(v)
                self.paths = own if self.paths is None else self.paths & own
            elif name == ("value",) and isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.least = v if self.least is None else max(self.least, v)
            yield f  # ranges hold other rows as well, so Spark filters again

    def partitions(self) -> list[Range | Files]:
        fs, root = opened(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        hidden = lambda p: any(x.startswith(("_", ".")) for x in p.removeprefix(root).split("/"))
        out, small = [], []
        for f in sorted((f for f in found if f.type == pafs.FileType.File and f.path.endswith(".npy") and not hidden(f.path)), key=lambda f: f.path):
            if self.paths is not None and f.path not in self.paths:
                continue
            if f.size > self.range_bytes:
                out += self._ranges(f.path, checked_header(fs, f.path, f.size))
                continue
            small.append((f.path, f.size))
        return out + small_files(small, self.range_bytes)

    def _ranges(self, path: str, head: Header) -> list[Range]:
        low, high = self.low, head.rows - 1 if self.high is None else min(self.high, head.rows - 1)
        step = max(1, self.range_bytes // max(1, head.columns * head.dtype.itemsize))
        return [Range(path, head, a, min(step, high + 1 - a)) for a in range(low, high + 1, step)]

    def read(self, partition: Range | Files | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no range is left
            return
        fs, _ = opened(self.path)
        if isinstance(partition, Range):
            yield from self._elements(fs, partition)
            return
        held, rows = [], 0
        for path, size in partition.files:
            for part in self._ranges(path, checked_header(fs, path, size)):
                for batch in self._elements(fs, part):
                    held.append(batch)
                    rows += batch.num_rows
                    if rows >= BATCH // 4:
                        yield pa.concat_batches(held)
                        held, rows = [], 0
        if held:
            yield pa.concat_batches(held)

    def _elements(self, fs: pafs.FileSystem, partition: Range) -> Iterator[pa.RecordBatch]:
        head = partition.header
        width, size = head.columns, head.dtype.itemsize
        step = max(1, BATCH // max(1, width))
        with fs.open_input_file(partition.path) as file:
            for first in range(partition.first, partition.first + partition.count, step):
                n = min(step, partition.first + partition.count - first)
                if head.by_column:  # the rows of a column lie together
                    parts = []
                    for j in range(width):
                        file.seek(head.offset + (j * head.rows + first) * size)
                        parts.append(np.frombuffer(file.read(n * size), head.dtype))
                    block = np.stack(parts, axis=1) if parts else np.empty((n, 0), head.dtype)
                else:
                    file.seek(head.offset + first * width * size)
                    block = np.frombuffer(file.read(n * width * size), head.dtype).reshape(n, width)
                value = block.astype(np.float64).ravel()
                # what isn't a number is above every number in Spark
                at = np.arange(len(value)) if self.least is None else np.flatnonzero(~(value < self.least))
                make = {
                    "path": lambda: pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(at), np.int32)), pa.array([partition.path])).cast(pa.string()),  # noqa: B023
                    "i": lambda: pa.array(first + at // max(1, width)),  # noqa: B023
                    "j": lambda: pa.array(at % max(1, width)),  # noqa: B023
                    "value": lambda: pa.array(value[at]),  # noqa: B023
                }
                yield pa.RecordBatch.from_arrays([make[c]() for c in self.columns], self.columns)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


def move_all(fs: pafs.FileSystem, root: str, messages: list[Written | None]) -> None:
    """What all tasks have written, to its places below ``root``; many files are moved at once."""
    moves = [move for m in messages if m for move in m.files]
    folders = sorted({root} | {final.rpartition("/")[0] for _, final in moves})
    with ThreadPoolExecutor(MOVES) as pool:
        for step in (lambda: pool.map(fs.create_dir, folders), lambda: pool.map(lambda move: fs.move(*move), moves)):
            for _ in step():
                pass


class NpyWriter(DataSourceArrowWriter):
    def __init__(self, options) -> None:
        self.path, self.dtype, self.job = options["path"], np.dtype(options.get("dtype", "float64")), uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = opened(self.path)
        held: dict[str, list[pa.RecordBatch]] = {}
        written = []
        fs.create_dir(f"{root}/_temporary-{self.job}", recursive=True)
        for batch in iterator:
            names, elements = batch.column("path").dictionary_encode(), batch.select(["i", "j", "value"])
            codes = names.indices.to_numpy()
            ends = [*(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)] if len(codes) else []
            for first, end in zip([0, *ends], ends, strict=False):
                name = names.dictionary[int(codes[first])].as_py()
                if name not in held:
                    for other in list(held):  # the rows of a file come together
                        written.append(self._save(fs, root, other, held.pop(other)))
                held.setdefault(name, []).append(elements.slice(first, end - first))
        written += [self._save(fs, root, name, parts) for name, parts in held.items()]
        return Written(written)

    def _save(self, fs: pafs.FileSystem, root: str, name: str, parts: list[pa.RecordBatch]) -> tuple[str, str]:
        i, j, value = (c.to_numpy() for c in pa.Table.from_batches(parts).columns)
        array = np.zeros((int(i.max()) + 1, int(j.max()) + 1), self.dtype)
        array[i, j] = value
        out = io.BytesIO()
        np.save(out, array)
        folder = f"{root}/_temporary-{self.job}"
        hidden = f"{folder}/{uuid.uuid4().hex}.npy"  # another for each attempt of a task
        with fs.open_output_stream(hidden) as file:
            file.write(out.getbuffer())
        return hidden, f"{root}/{name}"

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = opened(self.path)
        move_all(fs, root, messages)
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, root = opened(self.path)
        folder = f"{root}/_temporary-{self.job}"
        if fs.get_file_info(folder).type != pafs.FileType.NotFound:
            fs.delete_dir(folder)


class NpyDataSource(DataSource):
    """Options: path, columns (those to make, in this order), rangeBytes; for writing path and dtype."""

    @classmethod
    def name(cls) -> str:
        return "npy"

    def schema(self) -> str:
        return ", ".join(f"{c} {COLUMNS[c][1]}" for c in self.options.get("columns", ",".join(COLUMNS)).split(","))

    def reader(self, schema) -> NpyReader:
        return NpyReader(self.options)

    def writer(self, schema, overwrite: bool) -> NpyWriter:
        return NpyWriter(self.options)


def _ready(spark: SparkSession) -> None:
    spark.dataSource.register(NpyDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_arrays(spark: SparkSession, path: str, columns: tuple[str, ...] = tuple(COLUMNS), range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All .npy files under ``path`` as long rows (path, i, j, value), large ones in several tasks.

    Two-dimensional masks and N × 2 centroids alike; a vector is one row. With more dimensions j runs over all that
    follow the first. Numbers become doubles. An empty array gives no rows, an object array or a file that is cut short fails.
    """
    _ready(spark)
    reader = spark.read.format("npy").option("columns", ",".join(columns)).option("rangeBytes", range_bytes)
    return reader.load(qualified(spark, path))


def write_arrays(rows: DataFrame, path: str, dtype: str = "float64") -> None:
    """Rows (path, i, j, value) as one .npy file per ``path``, a name below ``path``; places without a row are 0, of a place's rows one stays.

    The elements of a file come to one task, file after file, so it holds one array at a time.
    """
    spark = rows.sparkSession
    _ready(spark)
    long = rows.select("path", F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("value").cast("double").alias("value"))
    together = long.repartition("path").sortWithinPartitions("path")
    together.write.format("npy").mode("append").option("dtype", dtype).save(qualified(spark, path))
