"""WARC archives as a PySpark Python data source.

Writing. Each task rolls files of about ``fileBytes`` bytes. A file counts only once the job has
committed, by a manifest that lists the files of the tasks that succeeded; files of tasks that ran
twice are never read. Headers are plain; the payload is an HTTP entity with Content-Encoding gzip.

Reading. Files (plain, or with one gzip member per record) become partitions, also those in
subfolders. With option splitBytes a larger plain file becomes several, each reading the records
that begin in its range; where they do is seen from an empty line and a record's headers, so leave
it off (the default) if payloads may quote whole records uncompressed. Predicates on record type and on header columns are pushed down and tested as
soon as a record's headers are parsed; the payload of a record that fails, and all payloads with
option payload=false, are skipped over without being decoded. Bytes that aren't a whole record give
a row with a status, and reading goes on at the next record.
"""

from __future__ import annotations

import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from screenloom.llm.common import salted_join, shared_dir
from screenloom.sources.npy import qualified

#: Columns from headers, in schema order, with the header that holds each (fixed by the format).
HEADERS = {
    "warc_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_length long, payload binary, status string"
ARROW = pa.schema([*((c, pa.string()) for c in HEADERS), ("payload_length", pa.int64()), ("payload", pa.binary()), ("status", pa.string())])
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_UNSAFE = re.compile("[\x00-\x20\x7f%]")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as a URI; a path without a scheme is local (the functions below give it that of Hadoop's default first)."""
    if re.match(r"file:/(?!/)", path):
        path = path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _escaped(value: str) -> str:
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", value)


def _unescaped(value: str) -> str:
    return re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record_bytes(row: dict) -> bytes:
    """One WARC record. ``payload`` is left out of a revisit; ``payload_length`` is its full length."""
    payload = row["payload"] or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
    if row["warc_type"] == "revisit":
        body = http + b"X-Payload-Length: %d\r\n\r\n" % row["payload_length"]
    else:
        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        coded = packer.compress(payload) + packer.flush()
        body = http + b"X-Payload-Length: %d\r\nContent-Encoding: gzip\r\nContent-Length: %d\r\n\r\n" % (len(payload), len(coded)) + coded
    lines = ["WARC/1.1", *(f"{h}: {_escaped(row[c])}" for c, h in HEADERS.items() if row[c] is not None)]
    if row["warc_type"] == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines)}


def _block(stream) -> list[bytes] | None:
    """Header lines up to an empty line; None at the end of the file."""
    lines = []
    while True:
        line = stream.readline()
        if not line:
            return None
        line = line.rstrip(b"\r\n")
        if line:
            lines.append(line)
        elif lines:
            return lines


_BEGIN = b"WARC/1."


def _row(head: dict[str, str]) -> dict:
    return {c: _unescaped(head[h.lower()]) if h.lower() in head else None for c, h in HEADERS.items()}


def read_records(stream, wanted, with_payload: bool, stop: int | None = None, strict: bool = True) -> Iterator[dict]:
    """The records of one archive for which ``wanted(row)`` holds; ``row`` has the header columns.

    Only records that begin before ``stop`` are read. ``status`` is null for a whole record, and else
    says what is wrong: "length" (no valid Content-Length; the next line that begins a record is
    looked for), "cut" (the file ends first), "payload" (its coding is broken; an error if ``strict``) or "coding" (one
    that isn't known: the payload is as it was sent). Bodies in gzip, deflate and chunks are decoded.
    """
    while stop is None or stream.tell() < stop:
        begin = stream.tell()
        if (lines := _block(stream)) is None:
            if stream.tell() - begin > 4:
                yield dict.fromkeys(ARROW.names) | {"status": "cut"}
            return
        head = _headers(lines[1:])
        row = dict.fromkeys(ARROW.names) | {c: _unescaped(head[h.lower()]) if h.lower() in head else None for c, h in HEADERS.items()}
        length = _number(head.get("content-length"))
        if length is None or not lines[0].startswith(_BEGIN):
            if wanted(row):
                yield row | {"status": "length"}
            _next_record(stream)
            continue
        if not wanted(row):
            stream.seek(length, 1)
            continue
        row["payload_length"], first, codings = length, b"", []
        if head.get("content-type", "").startswith("application/http"):
            first, rest = _http_head(stream, length)
            block, _, body = first.partition(b"\r\n\r\n")
            http = _headers(block.split(b"\r\n")[1:])
            first, length = body, len(body) + rest
            codings = [c.strip().lower() for h in ("content-encoding", "transfer-encoding") for c in http.get(h, "").split(",") if c.strip().lower() not in ("", "identity")]
            said = _number(http.get("x-payload-length"))
            row["payload_length"] = said if said is not None else length if not codings and row["warc_type"] != "revisit" else _number(http.get("content-length")) or 0
        if with_payload and row["warc_type"] != "revisit":
            data = first + stream.read(length - len(first))
            if len(data) < length:
                row["status"] = "cut"
            else:
                row["payload"], row["status"] = _decoded(data, codings, strict)
                if codings and row["status"] is None:
                    row["payload_length"] = len(row["payload"])
        elif not _skipped(stream, length - len(first)):
            row["status"] = "cut"
        yield row


def _http_head(stream, length: int) -> tuple[bytes, int]:
    """The first of ``length`` bytes up to the empty line after HTTP headers, or a little further, and how many follow. However long the headers are."""
    read, step = b"", 1 << 16
    while b"\r\n\r\n" not in read and len(read) < length:
        more = stream.read(min(step, length - len(read)))
        if not more:
            break
        read, step = read + more, step * 2
    return read, length - len(read)


def _skipped(stream, n: int) -> bool:
    """Move ``n`` bytes on; whether the stream has so many."""
    to = stream.tell() + n
    stream.seek(n, 1)
    size = stream.getbuffer().nbytes if isinstance(stream, io.BytesIO) else getattr(stream, "size", None)
    return stream.tell() == to and (size is None or to <= size)


def _number(value: str | None) -> int | None:
    return int(value) if value is not None and value.isascii() and value.isdigit() else None


def _unchunked(data: bytes) -> bytes:
    """The body that was sent in chunks, each after its size in hexadecimal."""
    out, at = [], 0
    while True:
        end = data.index(b"\r\n", at)
        size = int(data[at:end].split(b";")[0].strip(), 16)
        if size < 0 or end + 2 + size > len(data):
            raise ValueError("chunk")
        if size == 0:
            return b"".join(out)
        out.append(data[end + 2 : end + 2 + size])
        at = end + 4 + size


def _inflated(data: bytes) -> bytes:
    """What deflate packed, with the zlib header that the format asks for or without."""
    try:
        return zlib.decompress(data)
    except zlib.error:
        return zlib.decompress(data, -15)


_CODINGS = {"gzip": lambda d: zlib.decompress(d, 31), "x-gzip": lambda d: zlib.decompress(d, 31), "deflate": _inflated, "chunked": _unchunked}


def _decoded(data: bytes, codings: list[str], strict: bool) -> tuple[bytes | None, str | None]:
    """A body without its codings, the last of which was applied last, and a status: of one that isn't known the bytes as they are."""
    if not all(c in _CODINGS for c in codings):
        return data, "coding"
    try:
        for coding in reversed(codings):
            data = _CODINGS[coding](data)
    except (zlib.error, ValueError):
        if strict:
            raise
        return None, "payload"
    return data, None


def _next_record(stream) -> None:
    """Move to the next line that begins a record, or to the end."""
    while True:
        at = stream.tell()
        line = stream.readline()
        if not line:
            return
        if line.startswith(_BEGIN):
            stream.seek(at)
            return


def read_members(stream, wanted, with_payload: bool) -> Iterator[dict]:
    """Like :func:`read_records` for an archive in gzip, usually with a member for each record."""
    plain = _Unpacked(stream)
    yield from read_records(plain, wanted, with_payload, strict=False)
    if plain.broken:
        yield dict.fromkeys(ARROW.names) | {"status": "cut"}


class _Unpacked:
    """The plain bytes of a stream of gzip members, forward only; little is held at a time."""

    def __init__(self, raw, step: int = 1 << 18) -> None:
        self.raw, self.step, self.packer = raw, step, zlib.decompressobj(31)
        self.fresh = self.packer  # a member of which nothing was read yet
        self.begin, self.data, self.at, self.ended, self.broken = 0, b"", 0, False, False

    def tell(self) -> int:
        return self.begin + self.at

    def _more(self) -> bool:
        """Unpack another portion; whether there was one. Broken bytes end the stream."""
        while not self.ended:
            packed = self.packer.unconsumed_tail or (self.packer.unused_data if self.packer.eof else b"") or self.raw.read(self.step)
            if self.packer.eof:
                packed = packed.lstrip(b"\0")
                self.packer = self.fresh = zlib.decompressobj(31)
            if not packed:
                self.ended, self.broken = True, not self.packer.eof and self.begin + len(self.data) > 0 and self.packer is not self.fresh
                break
            self.fresh = None
            try:
                out = self.packer.decompress(packed, 1 << 20)
            except zlib.error:
                self.ended = self.broken = True
                break
            if out:
                self.begin += self.at
                self.data, self.at = self.data[self.at :] + out, 0
                return True
        return False

    def seek(self, offset: int, whence: int = 0) -> None:
        left = offset - (0 if whence else self.tell())
        while left > len(self.data) - self.at:
            left -= len(self.data) - self.at
            self.at = len(self.data)
            if not self._more():
                return
        self.at += left

    def read(self, n: int) -> bytes:
        parts = [self.data[self.at : self.at + n]]
        self.at += len(parts[0])
        left = n - len(parts[0])
        while left > 0 and self._more():
            parts.append(self.data[self.at : self.at + left])
            self.at += len(parts[-1])
            left -= len(parts[-1])
        return b"".join(parts)

    def readline(self) -> bytes:
        end = self.data.find(b"\n", self.at)
        while end < 0 and self._more():
            end = self.data.find(b"\n", self.at)
        end = len(self.data) if end < 0 else end + 1
        line, self.at = self.data[self.at : end], end
        return line


class _Committed(WriterCommitMessage):
    def __init__(self, files: list[str]) -> None:
        self.files = files


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, size: int) -> None:
        self.path, self.size = path, size

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Committed:
        store, folder = _open(self.path)
        store.create_dir(folder, recursive=True)
        files, stream, written = [], None, 0
        for batch in iterator:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                for row in part.to_pylist():
                    if stream is None:
                        files.append(f"{uuid.uuid4().hex}.warc")
                        stream, written = store.open_output_stream(f"{folder}/{files[-1]}"), 0
                    data = record_bytes(row)
                    stream.write(data)
                    written += len(data)
                    if written >= self.size:
                        stream.close()
                        stream = None
        if stream is not None:
            stream.close()
        return _Committed(files)

    def commit(self, messages: list[_Committed | None]) -> None:
        store, folder = _open(self.path)
        store.create_dir(folder, recursive=True)
        names = [f for m in messages if m is not None for f in m.files]
        with store.open_output_stream(f"{folder}/_manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list[_Committed | None]) -> None:
        store, folder = _open(self.path)
        for name in (f for m in messages if m is not None for f in m.files):
            store.delete_file(f"{folder}/{name}")


class _File(InputPartition):
    """The records of a file that begin in [begin, stop); all of them where stop is None."""

    def __init__(self, path: str, begin: int = 0, stop: int | None = None) -> None:
        super().__init__(path)
        self.begin, self.stop = begin, stop


def _counts(committed: set[str] | None, name: str) -> bool:
    return committed is None or name in committed or not re.fullmatch("[0-9a-f]{32}\\.warc", name)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, with_payload: bool, split: int = 0) -> None:
        self.path, self.with_payload, self.split, self.tests = path, with_payload, split, []

    def pushFilters(self, filters: list) -> Iterator:
        """Keep the predicates on header columns; Spark tests the others."""
        for f in filters:
            column = f.attribute[0]
            if column in HEADERS and isinstance(f, EqualTo | EqualNullSafe | In | IsNull | IsNotNull | StringStartsWith | StringEndsWith | StringContains):
                self.tests.append((type(f).__name__, column, getattr(f, "value", None)))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        for kind, column, value in self.tests:
            own = row[column]
            if kind == "IsNull":
                ok = own is None
            elif kind == "EqualNullSafe":
                ok = own == value
            else:
                ok = own is not None and (
                    kind == "IsNotNull"
                    or kind == "EqualTo" and own == value
                    or kind == "In" and own in value
                    or kind == "StringStartsWith" and own.startswith(value)
                    or kind == "StringEndsWith" and own.endswith(value)
                    or kind == "StringContains" and value in own
                )
            if not ok:
                return False
        return True

    def partitions(self) -> list[_File]:
        store, folder = _open(self.path)
        found = {i.path: i.size for i in store.get_file_info(fs.FileSelector(folder, recursive=True)) if i.is_file}
        names = sorted(n for n in found if n.endswith((".warc", ".warc.gz")))
        committed: dict[str, set[str]] = {}  # by folder, what this writer's jobs have committed there
        for manifest in sorted(n for n in found if n.rsplit("/", 1)[-1].startswith("_manifest-")):
            with store.open_input_stream(manifest) as f:
                committed.setdefault(manifest.rsplit("/", 1)[0], set()).update(json.loads(f.read()))
        # archives named as this writer names them count in such a folder only if committed; all others are read
        names = [n for n in names if _counts(committed.get(n.rsplit("/", 1)[0]), n.rsplit("/", 1)[-1])]
        out = []
        for name in names:
            if name.endswith(".gz") or not 0 < self.split < found[name]:
                out.append(_File(name))
            else:
                out += [_File(name, at, at + self.split) for at in range(0, found[name], self.split)]
        return out

    def _records(self, partition: _File, stream) -> Iterator[dict]:
        if partition.value.endswith(".gz"):
            return read_members(stream, self.wanted, self.with_payload)
        lines = _Buffered(stream)
        if partition.begin:
            back = min(4, partition.begin)
            lines.seek(partition.begin - back)
            _next_after_gap(lines, lines.read(back).endswith((b"\n\n", b"\n\r\n")))
        return read_records(lines, self.wanted, self.with_payload, partition.stop, strict=False)

    def read(self, partition: _File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        store, _ = _open(self.path)
        rows, size = [], 0
        with store.open_input_file(partition.value) as stream:
            for row in self._records(partition, stream):
                rows.append(row)
                size += len(row["payload"] or b"")
                if len(rows) >= 1000 or size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema=ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)


def _is_record(lines: list[bytes]) -> bool:
    """Whether header lines can be those of a record, and not of a payload that quotes one."""
    head = _headers(lines[1:])
    return lines[0].startswith(_BEGIN) and head.get("content-length", "").isdigit() and "warc-type" in head


def _next_after_gap(stream, empty: bool) -> None:
    """Move to the next record that follows an empty line and has a record's headers, or to the end.

    ``empty`` says whether the line before is empty.
    """
    while True:
        at = stream.tell()
        line = stream.readline()
        if not line:
            return
        if empty and line.startswith(_BEGIN):
            stream.seek(at)
            lines = _block(stream)
            stream.seek(at)
            if lines and _is_record(lines):
                return
            stream.readline()
        empty = line in (b"\r\n", b"\n")


class _Buffered:
    """Line reading and seeking over a file of any file system, a megabyte at a time."""

    def __init__(self, raw, step: int = 1 << 20) -> None:
        self.raw, self.step, self.begin, self.data, self.at, self.size = raw, step, 0, b"", 0, raw.size()

    def tell(self) -> int:
        return self.begin + self.at

    def seek(self, offset: int, whence: int = 0) -> None:
        to = offset + (self.tell() if whence else 0)
        if self.begin <= to <= self.begin + len(self.data):
            self.at = to - self.begin
        else:
            self.begin, self.data, self.at = to, b"", 0

    def _fill(self, n: int) -> None:
        if len(self.data) - self.at < n:
            self.begin += self.at
            rest = self.data[self.at :]
            self.raw.seek(self.begin + len(rest))
            self.data, self.at = rest + self.raw.read(max(self.step, n - len(rest))), 0

    def read(self, n: int) -> bytes:
        self._fill(n)
        out = self.data[self.at : self.at + n]
        self.at += len(out)
        return out

    def readline(self) -> bytes:
        n = 4096
        while True:
            self._fill(n)
            end = self.data.find(b"\n", self.at)
            if end >= 0:
                out = self.data[self.at : end + 1]
            elif self.begin + len(self.data) >= self.size:
                out = self.data[self.at :]
            else:
                n *= 4
                continue
            self.at += len(out)
            return out


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(folder)`` and ``df.write.format("warc").mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "true").lower() == "true", int(self.options.get("splitbytes", 0)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], int(self.options.get("filebytes", 32 << 20)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def page_records(pages: DataFrame, least: int = 100, date: str | None = None, salts: int = 16) -> DataFrame:
    """A record for each page (page_id, url, html), in the schema of the data source.

    Null html counts as empty. Of equal payloads of at least ``least`` bytes the one with the
    smallest page_id is the response and the others are revisits of it; shorter ones are all
    responses, as are repeated rows of that smallest id. Null urls give no target header; a null
    page_id is written as ``null`` and is a response unless another page has its payload.
    """
    when = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "payload_length": F.length("payload").cast("long")})
    copies = rows.filter(F.col("payload_length") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    rows = salted_join(rows, copies.drop("copies"), ["digest"], F.col("page_id"), "left", salts)
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    name = lambda c: F.format_string("<urn:page:%s>", F.coalesce(F.col(c).cast("string"), F.lit("null")))
    return rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        name("page_id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(when).alias("warc_date"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(revisit, name("first")).alias("refers_to"),
        "payload_length",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archives(pages: DataFrame, path: str | None = None) -> str:
    """Write :func:`page_records` and return the folder (a new one in the shared folder by default)."""
    spark = pages.sparkSession
    register(spark)
    path = qualified(spark, path or f"{shared_dir(spark)}/screenloom/{uuid.uuid4().hex}-warc")
    page_records(pages).write.format("warc").mode("append").save(path)
    return path


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """All records of a folder and its subfolders, in the schema of the data source; no files give no rows.

    Repeated records give repeated rows. Without ``payload`` no payload is decoded. Records that
    can't be read whole have a status.
    """
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(qualified(spark, path))


def page_table(records: DataFrame) -> DataFrame:
    """Records read back, as page_id, payload_bytes, payload_digest, record_type, refers_to.

    Length and digest of a response come from its payload, those of a revisit from its headers.
    Repeated records give repeated rows; a record without a page's name has a null page_id.
    """
    number = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1).try_cast("long")
    response = F.col("warc_type") == "response"
    return records.select(
        number("record_id").alias("page_id"),
        F.when(response, F.length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        F.col("warc_type").alias("record_type"),
        F.when(~response, number("refers_to")).alias("refers_to"),
    )


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """:func:`page_table` of all responses and revisits of a folder.

    Each record type is a read of its own whose predicate the reader tests: responses are decoded,
    of revisits only headers are parsed.
    """
    responses = read_archives(spark, path).filter("warc_type = 'response'")
    revisits = read_archives(spark, path, payload=False).filter("warc_type = 'revisit'")
    return page_table(responses).unionByName(page_table(revisits))
