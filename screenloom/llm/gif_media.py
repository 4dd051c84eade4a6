"""GIF columns: LZW, palettes, disposal, transparency, timed frames and colour histograms.

:func:`write_gif` stores 8-bit samples as the pixels of a grey GIF, losslessly; :func:`read_gif`
reads any GIF into composited frames. Both work on one file inside a task; :func:`gif_media`,
:func:`gif_frames` and :func:`gif_payloads` apply them to a column.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Samples in a row of a stored payload, and rows in a frame.
WIDTH, ROWS = 64, 256
#: A GIF with a larger canvas is not decoded.
MOST_PIXELS = 1 << 26
#: A grey palette: sample v has the colour (v, v, v).
GREY = np.repeat(np.arange(256, dtype=np.uint8), 3).tobytes()
#: First rows and steps of the four passes of an interlaced image (fixed by the format).
PASSES = ((0, 8), (4, 8), (2, 4), (1, 2))
MOST_CODES = 4096


def _widths(least: int, number: int) -> np.ndarray:
    """Bits of each code after a clear code: as many as the codes defined by then need, 12 at most."""
    defined = np.arange((1 << least) + 1, (1 << least) + 1 + number)
    bits = np.floor(np.log2(defined)).astype(np.int64) + 1
    return np.clip(bits, least + 1, 12)


def lzw_encode(data: bytes, least: int = 8) -> bytes:
    """LZW codes of ``data``, with a clear code first and whenever the table is full."""
    clear = 1 << least
    codes, widths = [clear], [np.array([least + 1])]
    table: dict[int, int] = {}
    find, put = table.get, codes.append
    free, begun = clear + 2, 1
    so_far = -1
    for b in data:
        if so_far < 0:
            so_far = b
            continue
        key = so_far << 8 | b
        code = find(key)
        if code is not None:
            so_far = code
            continue
        put(so_far)
        so_far = b
        if free < MOST_CODES:
            table[key] = free
            free += 1
        else:
            put(clear)
            widths.append(_widths(least, len(codes) - begun))
            begun, free = len(codes), clear + 2
            table.clear()
    if so_far >= 0:
        put(so_far)
    put(clear + 1)
    widths.append(_widths(least, len(codes) - begun))
    width = np.concatenate(widths)
    bits = (np.array(codes, np.int64)[:, None] >> np.arange(12)) & 1
    return np.packbits(bits[np.arange(12) < width[:, None]].astype(np.uint8), bitorder="little").tobytes()


def lzw_decode(stream: bytes, least: int, number: int) -> np.ndarray:
    """The first ``number`` samples of an LZW stream (fewer if it ends before).

    Between two clear codes the places of all codes are known, so a block is read at once. A code
    that isn't a literal repeats the output of an earlier code with one more sample; lengths and
    samples follow those references, in doubling steps, to literals.
    """
    clear, end = 1 << least, (1 << least) + 1
    data = np.frombuffer(stream + b"\0\0\0", np.uint8).astype(np.int64)
    bits = len(stream) * 8
    width = _widths(least, 2 * MOST_CODES)
    place = np.cumsum(width) - width
    out: list[np.ndarray] = []
    got, at = 0, 0
    while got < number and at < bits:
        fits = int(np.searchsorted(place + width, bits - at, side="right"))
        if not fits:
            break
        bit = place[:fits] + at
        byte = bit >> 3
        codes = ((data[byte] | data[byte + 1] << 8 | data[byte + 2] << 16) >> (bit & 7)) & ((1 << width[:fits]) - 1)
        stops = np.flatnonzero((codes == clear) | (codes == end))
        stop = int(stops[0]) if len(stops) else fits
        if stop:
            block = _block(codes[:stop], end + 1)
            out.append(block)
            got += len(block)
        if not len(stops) or codes[stop] == end:
            break
        at += int(place[stop] + width[stop])
    return np.concatenate(out)[:number] if out else np.empty(0, np.uint8)


def _block(codes: np.ndarray, first: int) -> np.ndarray:
    """Samples of the codes between two clear codes; code first + k repeats the output of code k and one sample more."""
    n = len(codes)
    repeats = codes >= first
    source = np.where(repeats, codes - first, np.arange(n))
    if np.any(source > np.arange(n) - repeats):
        raise ValueError("an LZW code that isn't defined yet")
    length, up = repeats.astype(np.int64), source.copy()
    while True:
        more = length[up]
        if not more.any():
            break
        length += more
        up = up[up]
    length += 1
    begin = np.cumsum(length) - length
    inside = np.arange(int(length.sum())) - np.repeat(begin, length)
    origin = np.repeat(np.where(repeats, begin[source], begin), length) + inside
    while True:
        nearer = origin[origin]
        if np.array_equal(nearer, origin):
            break
        origin = nearer
    literal = np.zeros(len(origin), np.uint8)
    literal[begin[~repeats]] = codes[~repeats]
    return literal[origin]


def _sub_blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[i : i + 255])]) + data[i : i + 255] for i in range(0, len(data), 255)) + b"\0"


def write_gif(payload: bytes, delay: int = 4) -> bytes:
    """A grey GIF of a payload that is a positive multiple of 64 bytes: frames of up to 256 rows, ``delay`` hundredths of a second each."""
    rows = len(payload) // WIDTH
    out = [b"GIF89a", struct.pack("<HHBBB", WIDTH, min(rows, ROWS), 0xF7, 0, 0), GREY]
    for top in range(0, rows, ROWS):
        pixels = payload[top * WIDTH : (top + ROWS) * WIDTH]
        out.append(b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, delay, 0) + b"\0")  # disposal 1: leave in place
        out.append(b"\x2c" + struct.pack("<HHHHB", 0, 0, WIDTH, len(pixels) // WIDTH, 0) + b"\x08")
        out.append(_sub_blocks(lzw_encode(pixels)))
    return b"".join(out) + b"\x3b"


@dataclass
class Frame:
    """One composited frame: the whole canvas as RGBA, and where its own image lies."""

    canvas: np.ndarray
    left: int
    top: int
    width: int
    height: int
    delay_ms: int
    disposal: int
    transparent: int | None

    def own(self) -> np.ndarray:
        return self.canvas[self.top : self.top + self.height, self.left : self.left + self.width]

    def histogram(self) -> np.ndarray:
        """Pixels of the canvas by the two high bits of red, green and blue; pixels without colour are left out."""
        r, g, b, a = (self.canvas[..., i] for i in range(4))
        return np.bincount(((r >> 6) << 4 | (g >> 6) << 2 | b >> 6)[a > 0], minlength=64)


def _palette(data: bytes) -> np.ndarray:
    colours = np.full((256, 4), (0, 0, 0, 255), np.uint8)
    given = np.frombuffer(data, np.uint8).reshape(-1, 3)
    colours[: len(given), :3] = given
    return colours


def read_gif(data: bytes) -> Iterator[Frame]:
    """The frames of a GIF, in order, each composited over what earlier ones leave."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags = struct.unpack("<HHB", data[6:11])
    at = 13
    shared = None
    if flags & 0x80:
        size = 3 << (flags & 7) + 1
        shared, at = _palette(data[at : at + size]), at + size
    if width * height > MOST_PIXELS:
        raise ValueError("a canvas of too many pixels")
    canvas = np.zeros((height, width, 4), np.uint8)
    delay, disposal, transparent = 0, 0, None

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while data[at]:
            parts.append(data[at + 1 : at + 1 + data[at]])
            at += 1 + data[at]
        return b"".join(parts), at + 1

    while at < len(data) and data[at] != 0x3B:
        if data[at] == 0x21:
            kind = data[at + 1]
            body, at = blocks(at + 2)
            if kind == 0xF9:
                packed, delay, index = struct.unpack("<BHB", body[:4])
                disposal, transparent = packed >> 2 & 7, index if packed & 1 else None
            continue
        if data[at] != 0x2C:
            raise ValueError(f"unknown block {data[at]:#x}")
        left, top, w, h, flags = struct.unpack("<HHHHB", data[at + 1 : at + 10])
        at += 10
        colours = shared
        if flags & 0x80:
            size = 3 << (flags & 7) + 1
            colours, at = _palette(data[at : at + size]), at + size
        least = data[at]
        stream, at = blocks(at + 1)
        index = lzw_decode(stream, least, w * h)
        if len(index) < w * h:
            raise ValueError("an image ends before its last pixel")
        index = index.reshape(h, w)
        if flags & 0x40:
            order = np.concatenate([np.arange(first, h, step) for first, step in PASSES])
            index = index[np.argsort(order)]
        before = canvas.copy() if disposal == 3 else None
        area = canvas[top : top + h, left : left + w]
        index = index[: area.shape[0], : area.shape[1]]
        if colours is None:
            raise ValueError("an image without a palette")
        if transparent is None:
            area[:] = colours[index]
        else:
            seen = index != transparent
            area[seen] = colours[index[seen]]
        yield Frame(canvas.copy(), left, top, w, h, delay * 10, disposal, transparent)
        if disposal == 2:
            area[:] = 0
        elif disposal == 3:
            canvas = before
        delay, disposal, transparent = 0, 0, None
    if at >= len(data):
        raise ValueError("the file ends without its trailer")


def frames_or_status(data: bytes | None) -> Iterator[Frame | str]:
    """The frames of a GIF; where it is broken, the whole frames before that and then what is wrong."""
    try:
        yield from read_gif(data) if data is not None else ()
    except (IndexError, struct.error):
        yield "the file ends inside a block"
    except ValueError as error:
        yield str(error)


def padded(text: str | None) -> bytes:
    """UTF-8 with zero bytes up to a positive multiple of 64."""
    data = (text or "").encode()
    return data + b"\0" * (-len(data) % 64 if data else 64)


def gif_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text stored as a GIF: id, n_bytes (before padding), media (binary).

    Null text counts as empty and is stored as 64 zero samples; very long texts take more frames.
    Repeated rows give repeated rows; a null id stays null. An empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = part.column(1).to_pylist()
                sizes = [len((t or "").encode()) for t in texts]
                media = [write_gif(padded(t)) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(work, "doc_id long, n_bytes long, media binary")


_FRAMES = "doc_id long, frame int, delay_ms int, left int, top int, width int, height int, disposal int, transparent int, rgba binary, histogram array<long>, status string"


def _table(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    names, kinds = zip(*(c.split(" ") for c in ddl.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def gif_frames(media: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """One row per frame of each GIF: its time, place, rules, the composited RGBA canvas and a 64-bin colour histogram.

    Null media have no frames. A broken GIF has rows for its whole frames and then one row whose
    status says what is wrong, with no other values but id and number; status is null elsewhere.
    Repeated rows give repeated frames and a null id stays null; other columns are not looked at. An
    empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for n, f in enumerate(frames_or_status(data)):
                    row = (*[None] * 9, f) if isinstance(f, str) else (f.delay_ms, f.left, f.top, f.width, f.height, f.disposal, f.transparent, f.canvas.tobytes(), f.histogram(), None)
                    yield _table([(name, n, *row)], _FRAMES)

    return media.select(F.col(id_col).cast("long"), F.col(media_col)).mapInArrow(work, _FRAMES)


def gif_payloads(media: DataFrame) -> DataFrame:
    """What :func:`gif_media` stored, read back: digests of payload and media, feature, frames, duration and status.

    ``feature`` is the colour histogram of the frames' own images summed, its 64 counts joined by
    commas. n_frames and duration_ms are those of the whole frames. Null media have no payload and
    zero frames; of a broken GIF the whole frames count, and status says what is wrong (else null).
    Repeated rows give repeated rows and a null id stays null. An empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, size, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts, histogram, duration, status = [], np.zeros(64, np.int64), 0, None
                for frame in frames_or_status(data):
                    if isinstance(frame, str):
                        status = frame
                        break
                    own = frame.own()
                    parts.append(own[..., 0].tobytes())
                    duration += frame.delay_ms
                    histogram += np.bincount((own[..., :3] >> 6).astype(np.int64).reshape(-1, 3) @ (16, 4, 1), minlength=64)
                payload, data = b"".join(parts), data or b""
                digests = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(data), hashlib.sha256(data).hexdigest())
                rows.append((name, size, *digests, ",".join(map(str, histogram.tolist())), len(parts), duration, status))
            if rows:
                yield _table(rows, _PAYLOADS)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(work, _PAYLOADS)


_PAYLOADS = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "feature string, n_frames int, duration_ms long, status string"
)
