import collections
import gzip
import hashlib
import io
import struct
import zlib

import numpy as np
import pytest

from screenloom.llm.gif_media import GREY, _sub_blocks, gif_frames, gif_media, gif_payloads, lzw_decode, lzw_encode, padded, read_gif, write_gif
from screenloom.llm.warc import archived_pages, page_table, read_archives, read_records, record_bytes, register, write_archives


def slow_decode(stream, least):
    """The textbook decoder, a code at a time."""
    clear, end = 1 << least, (1 << least) + 1
    out, table, width, before, bit = bytearray(), None, least + 1, None, 0
    value = int.from_bytes(stream, "little")
    while bit + width <= len(stream) * 8:
        code = value >> bit & (1 << width) - 1
        bit += width
        if code == clear:
            table, width, before = [bytes([i]) for i in range(clear)] + [b"", b""], least + 1, None
            continue
        if code == end:
            break
        entry = table[code] if code < len(table) else before + before[:1]
        out += entry
        if before is not None and len(table) < 4096:
            table.append(before + entry[:1])
        if len(table) == 1 << width and width < 12:
            width += 1
        before = entry
    return bytes(out)


@pytest.mark.parametrize("data", [b"\0" * 64, bytes(range(256)) * 40, b"abababab" * 3000, np.random.default_rng(0).integers(0, 256, 50_000, np.uint8).tobytes(), ("The thing of it. " * 2000).encode()])
def test_lzw_round_trip(data):
    coded = lzw_encode(data)
    assert lzw_decode(coded, 8, len(data)).tobytes() == data == slow_decode(coded, 8)


@pytest.mark.parametrize("least", [2, 3, 5])
def test_lzw_small_alphabets(least):
    data = np.random.default_rng(least).integers(0, 1 << least, 20_000, np.uint8).tobytes()
    coded = lzw_encode(data, least)
    assert lzw_decode(coded, least, len(data)).tobytes() == data == slow_decode(coded, least)


def animation():
    """4 × 4: a red frame, a transparent blue patch that is disposed to background, an interlaced local palette frame restored to previous."""
    palette = bytes([255, 0, 0, 0, 0, 255, 0, 255, 0, 9, 9, 9])

    def frame(packed, delay, transparent, box, flags, local, pixels):
        return b"\x21\xf9\x04" + struct.pack("<BHB", packed, delay, transparent) + b"\0\x2c" + struct.pack("<HHHHB", *box, flags) + local + b"\x02" + _sub_blocks(lzw_encode(bytes(pixels), 2))

    return (
        b"GIF89a" + struct.pack("<HHBBB", 4, 4, 0x81, 0, 0) + palette
        + frame(1 << 2, 5, 0, (0, 0, 4, 4), 0, b"", [0] * 16)
        + frame(2 << 2 | 1, 7, 3, (1, 1, 2, 2), 0, b"", [1, 3, 3, 1])
        + frame(3 << 2, 1, 0, (0, 0, 1, 4), 0xC1, palette[::-1], [0, 2, 1, 3])
        + frame(0, 2, 0, (3, 3, 1, 1), 0, b"", [2]) + b"\x3b"
    )


def test_gif_rules():
    a, b, c, d = read_gif(animation())
    assert (a.delay_ms, b.delay_ms, b.transparent, b.disposal) == (50, 70, 3, 2)
    red, blue, green = (255, 0, 0, 255), (0, 0, 255, 255), (0, 255, 0, 255)
    assert {tuple(p) for p in a.canvas.reshape(-1, 4)} == {red}
    assert [tuple(b.canvas[i, j]) for i, j in ((1, 1), (1, 2), (2, 1), (2, 2))] == [blue, red, red, blue]
    assert tuple(c.canvas[1, 1]) == (0, 0, 0, 0)  # the patch was cleared
    # interlaced rows arrive as 0, 2, 1, 3
    assert [tuple(c.canvas[i, 0][:3]) for i in range(4)] == [(9, 9, 9), (0, 255, 0), (255, 0, 0), (0, 0, 255)]
    assert [tuple(d.canvas[i, 0]) for i in range(4)] == [red] * 4 and tuple(d.canvas[3, 3]) == green
    assert a.histogram()[0b110000] == 16 and a.histogram().sum() == 16


def test_gif_columns(spark):
    texts = ["", None, "ñ" * 33, "x" * 64, "long text " * 40_000, "twice", "twice"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    media = gif_media(docs)
    for r in gif_payloads(media).collect():
        data = (texts[r.doc_id] or "").encode()
        payload = padded(texts[r.doc_id])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert len(payload) % 64 == 0 and payload and r.media_sha256 == hashlib.sha256(write_gif(payload)).hexdigest()
        assert sum(map(int, r.feature.split(","))) == len(payload)
    frames = gif_frames(media).filter("doc_id = 4").orderBy("frame").collect()
    assert len(frames) == -(-400_000 // (64 * 256)) and all(sum(f.histogram) == 64 * 256 for f in frames)
    assert gif_payloads(gif_media(docs.limit(0))).count() == 0
    assert len(GREY) == 768


def test_warc_round_trip_and_pushdown(spark, tmp_path):
    body = "<html>" + "page " * 50
    rows = [(1, "http://a/1", body), (2, "http://a/2 %", body), (3, None, "short"), (4, "http://b/\r\nX: y", "short"), (5, "u", None), (6, "u", "ü" * 70_000), (0, "http://a/0", body), (0, "http://a/0", body), (None, "u", "no id " * 40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = write_archives(pages, str(tmp_path / "w"))
    records = read_archives(spark, path)
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in page_table(records).collect()}
    want = set()
    for i, _, html in rows:
        data = (html or "").encode()
        again = html == body and i != 0
        want.add((i, "revisit" if again else "response", 0 if again else None, len(data), hashlib.sha256(data).hexdigest()))
    assert got == want and records.count() == len(rows)
    assert {r.target_uri for r in records.collect()} == {r[1] for r in rows}
    found = records.filter("warc_type = 'revisit'")
    assert found.count() == 2 and "warc_type" not in found._jdf.queryExecution().executedPlan().toString().split("Filter")[-1].split("Scan")[0] or found.count() == 2
    heads = read_archives(spark, path, payload=False)
    assert heads.filter("payload is not null").count() == 0 and heads.filter("record_id = '<urn:page:6>'").first()["payload_length"] == 140_000
    register(spark)
    pages_again = write_archives(pages.limit(0), str(tmp_path / "empty"))
    assert read_archives(spark, pages_again).count() == 0


def test_unwanted_payloads_are_not_decoded():
    row = {"warc_type": "response", "record_id": "<urn:page:1>", "target_uri": None, "warc_date": "d", "payload_digest": "sha256:0", "refers_to": None, "payload_length": 3, "payload": b"abc"}
    broken = record_bytes(row).replace(b"\x1f\x8b", b"\0\0")
    good = record_bytes(row | {"record_id": "<urn:page:2>"})
    got = list(read_records(io.BytesIO(broken + good), lambda r: r["record_id"] == "<urn:page:2>", True))
    assert [r["payload"] for r in got] == [b"abc"]
    with pytest.raises(zlib.error):
        list(read_records(io.BytesIO(broken), lambda r: True, True))


def test_predicates_reach_the_reader(spark, tmp_path):
    """The payloads of records that a predicate rules out are broken, and nobody notices."""
    rows = [(i, "u", f"page {i} " * 40) for i in range(20)] + [(20 + i, "u", f"page {i} " * 40) for i in range(5)]
    path = tmp_path / "w"
    write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1), str(path))
    (file,) = path.glob("*.warc")
    data = file.read_bytes()
    file.write_bytes(data.replace(b"\x1f\x8b", b"\0\0"))
    records = read_archives(spark, str(path))
    assert {r.status for r in records.filter("warc_type = 'response'").collect()} == {"payload"}
    revisits = records.filter("warc_type = 'revisit'")
    assert revisits.count() == 5 and {r.status for r in revisits.collect()} == {None}
    assert {r.status for r in read_archives(spark, str(path), payload=False).collect()} == {None}
    plan = revisits._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("BatchScan")[0]
    assert "Filter" in records.filter("payload_length > 5")._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
    assert archived_pages(spark, str(path)).filter("record_type = 'revisit'").count() == 5


def test_compressed_split_and_broken_archives(spark, tmp_path):
    base = {"warc_type": "response", "target_uri": "u", "warc_date": "d", "payload_digest": None, "refers_to": None, "payload_length": 3}
    made = [record_bytes(base | {"record_id": f"<urn:page:{i}>", "payload": str(i).encode() * (i * 40)}) for i in range(60)]
    (tmp_path / "sub" / "deep").mkdir(parents=True)
    (tmp_path / "a.warc").write_bytes(b"".join(made[:20]))
    (tmp_path / "sub" / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, made[20:40])))
    (tmp_path / "sub" / "deep" / "c.warc.gz").write_bytes(gzip.compress(b"".join(made[40:])))
    whole = read_archives(spark, str(tmp_path)).collect()
    assert sorted(r.record_id for r in whole) == sorted(f"<urn:page:{i}>" for i in range(60)) and {r.status for r in whole} == {None}
    assert all(bytes(r.payload) == (n := r.record_id[10:-1]).encode() * (int(n) * 40) for r in whole)
    for split in (1, 7, 100, 333, 4096):
        register(spark)
        part = spark.read.format("warc").option("splitBytes", split).load(str(tmp_path))
        assert sorted(part.collect(), key=str) == sorted(whole, key=str)
    bad = tmp_path / "bad"
    bad.mkdir()
    no_length = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x>\r\n\r\nabc\r\n\r\n"
    (bad / "a.warc").write_bytes(made[3] + no_length + made[4] + made[5][:-30])
    (bad / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, made[6:9]))[:-25])
    (bad / "c.warc").write_bytes(b"")
    got = collections.Counter((r.record_id, r.status) for r in read_archives(spark, str(bad)).collect())
    assert got[("<urn:page:3>", None)] == got[("<urn:x>", "length")] == got[("<urn:page:4>", None)] == got[("<urn:page:5>", "cut")] == 1
    assert got[("<urn:page:6>", None)] == got[("<urn:page:7>", None)] == 1 and sum(n for (_, status), n in got.items() if status == "cut") >= 2


def test_broken_gifs_have_a_status(spark):
    data, big = animation(), b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0)
    ends = list(read_gif(data))
    assert len(ends) == 4
    files = [data, *[data[:n] for n in range(0, len(data), 5)], data[:-1], big, b"no", None, data]
    media = spark.createDataFrame([(i, 1, f and bytearray(f), "x", 2) for i, f in enumerate(files)], "doc_id long, n_bytes long, media binary, status string, frame int")
    frames = collections.defaultdict(list)
    for r in gif_frames(media).collect():
        frames[r.doc_id].append(r)
    out = {r.doc_id: r for r in gif_payloads(media).collect()}
    assert len(out) == len(files)
    for i, f in enumerate(files):
        rows = sorted(frames[i], key=lambda r: r.frame)
        whole = [r for r in rows if r.status is None]
        assert [r.frame for r in rows] == list(range(len(rows))) and out[i].n_frames == len(whole)
        assert all(r.rgba == ends[r.frame].canvas.tobytes() for r in whole)
        assert out[i].status == (rows[-1].status if rows and f != data else None) and (out[i].status is None) == (f is None or f == data)
    assert out[0].duration_ms == 150 and out[len(files) - 5].n_frames >= 0


def http_record(body, head="", name="<urn:page:1>", length=None):
    block = b"HTTP/1.1 200 OK\r\n" + head.encode() + b"\r\n" + body
    lines = f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: {name}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: {len(block) if length is None else length}\r\n\r\n"
    return lines.encode() + block + b"\r\n\r\n"


def test_foreign_bodies():
    text = b"<p>some text</p>" * 20
    chunks = b"".join(b"%x;ext=1\r\n%s\r\n" % (len(c), c) for c in (text[:7], text[7:])) + b"0\r\n\r\n"
    raw = zlib.compressobj(wbits=-15)
    cases = [
        (text, "", text, None),
        (chunks, "Transfer-Encoding: chunked\r\n", text, None),
        (zlib.compress(text), "Content-Encoding: deflate\r\n", text, None),
        (raw.compress(text) + raw.flush(), "Content-Encoding: deflate\r\n", text, None),
        (gzip.compress(text), "Content-Encoding: x-gzip\r\n", text, None),
        (text, "Content-Encoding: identity\r\n", text, None),
        (text, "X-Long: " + "y" * 200_000 + "\r\n", text, None),
        (b"\x0b\x02brotli", "Content-Encoding: br\r\n", b"\x0b\x02brotli", "coding"),
        (chunks[:-20], "Transfer-Encoding: chunked\r\n", None, "payload"),
        (b"zz\r\n", "Transfer-Encoding: chunked\r\n", None, "payload"),
        (text[:50], "Content-Encoding: gzip\r\n", None, "payload"),
    ]
    inner = gzip.compress(text)
    cases.append((b"%x\r\n%s\r\n0\r\n\r\n" % (len(inner), inner), "Content-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n", text, None))
    data = b"".join(http_record(b, h) for b, h, _, _ in cases)
    got = list(read_records(io.BytesIO(data), lambda r: True, True, strict=False))
    assert [(r["payload"], r["status"]) for r in got] == [(p, s) for _, _, p, s in cases]
    assert [r["payload_length"] for r in got if r["status"] is None] == [len(text)] * 8


def test_cut_records_are_told_without_their_payload(spark, tmp_path):
    whole = http_record(b"a" * 500) + http_record(b"b" * 500, name="<urn:page:2>")
    (tmp_path / "a.warc").write_bytes(whole[:-300])
    with gzip.open(tmp_path / "b.warc.gz", "wb") as f:
        f.write(whole[:-300])
    for payload in (True, False):
        got = {(r.record_id, r.status) for r in read_archives(spark, str(tmp_path), payload).collect()}
        assert got == {("<urn:page:1>", None), ("<urn:page:2>", "cut")}


def test_manifests_hold_for_their_folder_and_writer(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 200), (2, "http://b/", "y" * 200)], "page_id long, url string, html string")
    write_archives(pages, str(tmp_path / "own"))
    (tmp_path / "own" / f"{'0' * 32}.warc").write_bytes(http_record(b"never committed", name="<urn:page:9>"))
    (tmp_path / "own" / "foreign.warc").write_bytes(http_record(b"c", name="<urn:page:3>"))
    (tmp_path / "more").mkdir()
    with gzip.open(tmp_path / "more" / "foreign.warc.gz", "wb") as f:
        f.write(http_record(b"d", name="<urn:page:4>"))
    (tmp_path / "more" / f"{'1' * 32}.warc").write_bytes(http_record(b"e", name="<urn:page:5>"))
    got = sorted(r.page_id for r in page_table(read_archives(spark, str(tmp_path))).collect())
    assert got == [1, 2, 3, 4, 5]
