"""Splitting text where byte-level BPE can never merge, so that results can be kept per chunk."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


class Recent(dict):
    """A bounded memory in two generations: when the young one is full it becomes the old one."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most, self.old = most, {}

    def find(self, key):
        """The value, or None."""
        got = self.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self[key] = got
        return got

    def turn(self) -> None:
        """To be called now and then: makes room."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


class ChunkEncoder:
    """Encodes texts by chunks, recent chunks from memory.

    A single space between two characters that aren't white space always begins a new match of the
    splitting pattern, and nothing left of it changes what follows. So a text may be cut there and
    every chunk (with its leading space) encoded alone; other spaces stay inside a chunk. Each
    distinct chunk of a batch is looked up once, and texts are put together from them as arrays.

    ``encode`` takes a list of strings and returns the ids of each, encoded as a text of its own, as
    the bytes of 32-bit numbers.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = 200_000) -> None:
        self.encode_new, self.known = encode, Recent(most)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has. Null counts as empty."""
        texts = pc.fill_null(texts, "")
        cut = pc.split_pattern(texts, " ")
        ends = cut.offsets.to_numpy().astype(np.int64)
        ends -= ends[0]
        coded = cut.flatten().dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        begins, last = ends[:-1], ends[1:] - 1
        # a word that touches white space may only be the first and only one
        loose = np.array([not w or w[0].isspace() or w[-1].isspace() for w in words], bool)
        odd = np.logical_or.reduceat(loose[codes], begins) & (last > begins) if len(begins) else np.zeros(0, bool)
        chunks: dict[str, int] = {}
        number = lambda c: chunks.setdefault(c, len(chunks))
        own = {int(i): np.array([number(c) for c in _cut(texts[int(i)].as_py())], np.int64) for i in np.flatnonzero(odd)}
        first = np.array([number(words[c]) for c in codes[begins]], np.int64)
        inner = np.ones(len(codes), bool)
        inner[begins] = False
        inner &= np.repeat(~odd, np.diff(ends))
        used = np.unique(codes[inner])
        as_chunk = np.zeros(len(words), np.int64)
        as_chunk[used] = [number(f" {words[c]}") for c in used]
        codes = as_chunk[codes]
        codes[begins] = first
        if own:
            parts = [own.get(i, codes[a:b]) for i, (a, b) in enumerate(zip(begins.tolist(), ends[1:].tolist(), strict=True))]
            codes, begins = np.concatenate(parts), np.cumsum([0, *map(len, parts)])[:-1]
        found = self._find(list(chunks))
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, at = np.frombuffer(b"".join(found), np.int32), np.cumsum(length) - length
        each = length[codes]
        total = np.add.reduceat(each, begins) if len(begins) else np.zeros(0, np.int64)
        place = np.repeat(at[codes] - np.cumsum(each) + each, each)
        place += np.arange(len(place))
        return flat[place], total

    def _find(self, chunks: list[str]) -> list[bytes]:
        self.known.turn()
        found = list(map(self.known.find, chunks))
        missing = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(missing, self.encode_new([chunks[i] for i in missing]), strict=True):
            found[i] = ids
            if len(chunks[i]) < 64:
                self.known[chunks[i]] = ids
        return found


_CUT = re.compile(r"(?<=\S) (?=\S)")


def _cut(text: str) -> list[str]:
    first, *rest = _CUT.split(text)
    return [first, *(f" {c}" for c in rest)]


def portions(batch: pa.RecordBatch, at: int, rows: int = 1024, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``rows`` rows and about ``size`` bytes in column ``at``."""
    end = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < batch.num_rows:
        done = end[begin - 1] if begin else 0
        stop = min(begin + rows, max(begin + 1, int(np.searchsorted(end, done + size, side="right"))))
        yield batch.slice(begin, stop - begin)
        begin = stop
