"""Best-fit packing with certified bounds.

Documents are cut only where they are longer than a sequence. The pieces are dealt over partitions
by a hash, and each partition packs its own by best-fit decreasing. Dual-feasible functions then
give a lower bound for the sequences that a partition needs. A partition that uses no more is
certified and closed for good. A partition with a gap keeps its fullest sequences and opens the
others, the emptiest first, until what it keeps meets the bound of what it keeps and what it opens
can gain a sequence; the opened pieces of all partitions with gaps are exchanged by another hash
and packed by best-fit decreasing again, round after round, as long as that saves sequences. If
all partitions then still use more than the bound of the whole corpus (a histogram with one entry
for each length gives it), they exchange their emptiest sequences, one or a few each; all others
stay as they are.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.llm.common import stored

#: About so many pieces are packed by one task.
PARTITION_PIECES = 50_000

def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def byte_level_encoding(path: str, special: bool = False) -> tiktoken.Encoding:
    """The encoder of a byte-level BPE vocabulary file of the tokenizers library.

    Its ids are in the order of its merges, so they serve as ranks. Unless ``special``, special
    tokens are left out: their strings in a text are ordinary text.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    letters = byte_of_letter()
    ranks = {bytes(map(letters.__getitem__, token)): i for token, i in spec["model"]["vocab"].items() if token not in added}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added if special else {})


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, special: bool = False
) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32 (and ids if ``keep_ids``).

    A document is the ids of its whole text and then ``end_id``. One with more than ``capacity``
    ids is cut into pieces of ``capacity``, of which the first may be shorter. With ``special`` the
    string of a special token is that token, as by default in the tokenizers library.
    """
    columns = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(columns + [("ids", pa.list_(pa.int32()))] * keep_ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = byte_level_encoding(path, special)
        encode = partial(encoding.encode, allowed_special="all") if special else encoding.encode_ordinary
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                names, texts = (c.slice(at, 256).to_pylist() for c in batch.columns)
                rows = []
                for name, text in zip(names, texts, strict=True):
                    ids = np.array([*encode(text or ""), end_id], np.dtype("<u4"))
                    first = (len(ids) - 1) % capacity + 1
                    for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                        start = max(0, end - capacity)
                        own = ids[start:end]
                        rows.append((name, piece, start, len(own), zlib.crc32(own.tobytes()), *[own.astype(np.int32)] * keep_ids))
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    ddl = _PIECES + ", ids array<int>" * keep_ids
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(work, ddl)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and how full each bin is. Longest items first, each into the fullest bin that takes it."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, fill = 0, []  # bit r of rooms: some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
        else:
            room, own = capacity, len(fill)
            fill.append(0)
        bins[i], offsets[i] = own, fill[own]
        fill[own] += size
        room -= size
        if room:
            with_room[room].append(own)
            rooms |= 1 << room
    return bins, offsets, np.array(fill, np.int64)


def bins_needed(counts: np.ndarray) -> int:
    """A lower bound for the bins of items, ``counts[s]`` of each size s up to the capacity.

    The largest bound over two families of dual-feasible functions: sizes over C - t count as C and
    sizes under t as 0 (t up to C / 2); and sizes rounded down to multiples of C / (k + 1) scaled up
    to multiples of C / k, multiples of C / (k + 1) themselves staying as they are.
    """
    capacity = len(counts) - 1
    size = np.arange(capacity + 1, dtype=np.int64)
    number, total = np.cumsum(counts), np.cumsum(counts * size)
    t = np.arange(1, capacity // 2 + 1)
    large = number[capacity] - number[capacity - t]
    middle = total[capacity - t] - total[t - 1]
    best = int(np.max(-(-(large * capacity + middle) // capacity), initial=-(-int(total[capacity]) // capacity)))
    for k in range(1, 51):
        scaled = size * (k + 1)
        # in units of C * k
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, int(-(-int((counts * value).sum()) // (capacity * k))))
    return best


_PACKED = f"{_PIECES}, part long, bin long, offset long, room long, room_before long, bins long, bound long"


def _pack(capacity: int):
    def work(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "doc_id", "piece", "start"], ascending=[False, True, True, True], ignore_index=True)
        lengths = pieces["length"].to_numpy(np.int64)
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        bound = bins_needed(np.bincount(lengths, minlength=capacity + 1))
        emptiest = np.argsort(fill, kind="stable")
        before = np.empty(len(fill), np.int64)
        before[emptiest] = np.cumsum(capacity - fill[emptiest]) - (capacity - fill[emptiest])
        return pieces.assign(bin=bins, offset=offsets, room=capacity - fill[bins], room_before=before[bins], bins=len(fill), bound=bound)

    return work


def _dealt(pieces: DataFrame, turn: int, number: int, capacity: int) -> DataFrame:
    """Deal ``number`` pieces over partitions by a hash of their own and pack each partition.

    Each piece also gets its partition's sequences and bound, and how much room all emptier
    sequences of the partition have together.
    """
    parts = max(1, -(-number // PARTITION_PIECES))
    part = F.pmod(F.xxhash64("doc_id", "piece", F.lit(turn)), F.lit(parts))
    return pieces.withColumn("part", part).groupBy("part").applyInPandas(_pack(capacity), _PACKED)


def pack_pieces(pieces: DataFrame, capacity: int, rounds: int = 8) -> tuple[DataFrame, dict]:
    """``pieces`` with sequence_id, offset, partition_bins and partition_bound, and the certificate: sequences, lower bound, rounds, gaps.

    A sequence_id names round, partition and bin. partition_bins and partition_bound are those of the
    partition that packed the sequence; where they are equal, it was certified. The order
    of equal pieces is by id, so that a task that runs again packs the same way.
    """
    lengths = pieces.groupBy("length").count().collect()  # one row for each length up to the capacity
    counts = np.zeros(capacity + 1, np.int64)
    for row in lengths:
        counts[row["length"]] = row["count"]
    bound, number = bins_needed(counts), int(counts.sum())
    gap = F.col("bins") - F.col("bound")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def closed(packed: DataFrame, turn: int) -> DataFrame:
        key = F.col("part") * (1 << 28) + F.col("bin") + turn * (1 << 56)
        return packed.select(*names, key.alias("sequence_id"), "offset", F.col("bins").alias("partition_bins"), F.col("bound").alias("partition_bound"))

    packed, last, turn, wide, kept, used = stored(_dealt(pieces, 0, number, capacity), "packed"), 0, 0, 1, [], 0
    corpus = False  # whether the gap of the corpus is looked at, once those of partitions are closed or can't be
    while True:
        parts = packed.groupBy("part").agg(F.first("bins").alias("bins"), F.first("bound").alias("bound"))
        bins, gaps = parts.agg(F.coalesce(F.sum("bins"), F.lit(0)), F.coalesce(F.sum(gap), F.lit(0))).first()
        if not corpus and (gaps == 0 or wide > 2):
            corpus, wide = True, 1
        if used + bins <= bound or turn + 1 >= rounds or corpus and wide > 2:
            break
        turn += 1
        if corpus:
            opens = (F.col("room") > 0) & (F.col("room_before") <= capacity * (wide - 1))
        else:
            # what a partition opens has room for the sequences of its gap; twice as much after an exchange in vain
            opens = (gap > 0) & (F.col("room_before") < gap * capacity * wide)
        inside = packed.filter(opens)
        open_bins, open_pieces = inside.agg(F.count_distinct("part", "bin"), F.count(F.lit(1))).first()
        again = stored(_dealt(inside.select(*names), turn, open_pieces, capacity), "packed")
        fewer = again.select("part", "bin").distinct().count()
        if fewer >= open_bins:
            wide *= 2
            continue
        kept.append(closed(packed.filter(~opens), last))
        used += bins - open_bins
        packed, last, wide = again, turn, 1
    out = closed(packed, last)
    for other in kept:
        out = out.unionByName(other)
    return out, {"sequences": used + bins, "bound": bound, "rounds": turn + 1, "gaps": gaps}


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", special: bool = False) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the certificate
    partition_bins, partition_bound (see :func:`pack_pieces`). Null text
    counts as empty and is ``end_id`` alone. Very long texts are cut, others never. Repeated rows
    are packed as often as they occur; a null id is kept as null. Other columns of ``docs`` are not
    looked at. An empty table gives no rows. ``special`` as for :func:`token_pieces`.
    """
    pieces = stored(token_pieces(docs, path, capacity, end_id, id_col, text_col, special=special), "pieces")
    return pack_pieces(pieces, capacity)[0]


def fill_sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The token ids of each sequence: sequence_id, ids. ``pieces`` from :func:`token_pieces` with its ids, ``placed`` from :func:`pack_pieces`.

    A piece is known by its document, number, start, length and CRC-32, nulls included, so rows of one id with
    different texts stay apart, and repeated rows, whose pieces are equal, fill each of their places. Other columns are not
    looked at. Empty tables give no rows.
    """
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    known = pieces.groupBy(*key).agg(F.first("ids").alias("ids")).withColumnsRenamed({c: f"_{c}" for c in key})
    joined = placed.join(known, [placed[c].eqNullSafe(known[f"_{c}"]) for c in key])
    rows = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("rows"))
    return rows.select("sequence_id", F.flatten(F.transform("rows", lambda r: r["ids"])).alias("ids"))
