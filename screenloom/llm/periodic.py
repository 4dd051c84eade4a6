"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least ``least`` words and two periods long,
that no neighbouring word extends keeping period q. Two ways find all of them:

* *Direct lag scans.* Periods below ``SHORT`` are found by comparing the text with itself moved by q.
* *Minimizers.* A scale w (a power of two) is for periods of w to 2w - 1. Each window of w words is
  stood for by its smallest hash of w/2 consecutive words, leftmost on ties. The first w words of a
  run with such a period q and the w words q further on are equal, so their minima are equal and lie
  q apart: every run has a pair of equal minimizers at the distance of its period. Such pairs are
  seeds; comparing word by word extends them to the whole stretch.

Equal minimizers less than w/4 apart overlap so far that the text between them has that period, so
they form a cluster inside one run of a short period. Two of one cluster are never the seed of a run
of this scale, and pairs of two clusters can be moved left, staying inside the same run, until one of
the two is the first of its cluster. So only pairs with such a first one are seeds, which keeps their
number within a constant of the minimizers' however repetitive a text is.

All texts of a batch are laid end to end with separators, so scans are over one long array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenloom.llm.chunks import portions
from screenloom.llm.common import unused_prefix, without

#: Periods below this are found by direct scans; the smallest scale of the minimizers. A power of two.
SHORT = 16
#: Words or bytes of texts that are looked at together.
PORTION_ROWS, PORTION_BYTES = 4096, 4 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
_OUT_DDL = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _by_lag(words: np.ndarray, lag: int, least: int) -> list[tuple[int, int, int]]:
    """(start, end, lag) of all stretches that agree with themselves ``lag`` further on."""
    same = np.flatnonzero(words[lag:] == words[:-lag])
    if not len(same):
        return []
    first = np.flatnonzero(np.diff(same, prepend=-2) > 1)
    length = np.diff(first, append=len(same))
    enough = length >= max(least - lag, lag)
    return [(s, s + n + lag, lag) for s, n in zip(same[first[enough]].tolist(), length[enough].tolist(), strict=True)]


def _minimizers(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions that are the leftmost smallest of some ``width`` + 1 consecutive hashes; width is a power of two."""
    at = np.uint64((1 << int(len(hashes)).bit_length()) - 1)
    key = (hashes & ~at) | np.arange(len(hashes), dtype=np.uint64)  # ties in the upper bits: the leftmost
    step = 1
    while step < width:
        key = np.minimum(key, np.roll(key, -step))
        step *= 2
    key = np.minimum(key, np.roll(key, -1))
    found = np.zeros(len(hashes), bool)
    found[(key & at).astype(np.int64)] = True
    return np.flatnonzero(found)


def _seeds(hashes: np.ndarray, doc: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of pairs of equal minimizers of one text, ``scale`` to 2 * ``scale`` - 1 apart."""
    at = _minimizers(hashes, scale // 2)
    key = _mixed(hashes[at] + _mixed(doc[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    new = np.ones(len(at), bool)
    new[1:] = key[1:] != key[:-1]
    heads = new.copy()
    heads[1:] |= np.diff(at) > scale // 4
    cluster = np.cumsum(heads)
    place = np.cumsum(new) * (len(hashes) + 2 * scale + 1) + at
    of = np.flatnonzero(heads)
    pairs = []
    for low, high, ahead in ((scale, 2 * scale - 1, True), (1 - 2 * scale, -scale, False)):
        begin, end = np.searchsorted(place, place[of] + low), np.searchsorted(place, place[of] + high, side="right")
        count = end - begin
        one = np.repeat(of, count)
        two = np.arange(len(one)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
        pairs.append((one, two) if ahead else (two, one))
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    apart = cluster[a] != cluster[b]
    a, b = at[a[apart]], at[b[apart]]
    return a, b - a


def _agreeing(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The stretch around ``at`` whose words equal those ``lag`` further on: begin and end (not included)."""
    end, step = at, 64
    while True:
        x, y = words[end : end + step], words[end + lag : end + lag + step]
        differs = np.flatnonzero(x[: len(y)] != y)
        if len(differs):
            end += int(differs[0])
            break
        end += len(y)
        if len(y) < step:
            break
        step *= 2
    begin, step = at, 64
    while begin > 0:
        step = min(step, begin)
        differs = np.flatnonzero(words[begin - step : begin] != words[begin + lag - step : begin + lag])
        if len(differs):
            begin += int(differs[-1]) + 1 - step
            break
        begin -= step
        step *= 2
    return begin, end


def _extended(words: np.ndarray, at: np.ndarray, lags: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(start, end, lag) of the stretches of two periods or more around these seeds."""
    out, last, done = [], 0, 0
    order = np.lexsort((at, lags))
    for x, lag in zip(at[order].tolist(), lags[order].tolist(), strict=True):
        if lag == last and x < done:
            continue  # a seed inside the stretch just found
        begin, end = _agreeing(words, x, lag)
        last, done = lag, end
        if end - begin >= max(lag, least - lag):
            out.append((begin, end + lag, lag))
    return out


def find_runs(texts: list[np.ndarray], least: int = 12) -> list[list[tuple[int, int, int]]]:
    """Of each text, given as whole numbers (equal words, equal numbers, none negative), its runs.

    A run is (start, length, period); they are ordered by start, then period.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    # every text is followed by a separator that occurs nowhere else
    words = np.concatenate([x for i, t in enumerate(texts) for x in (t, [-1 - i])]).astype(np.int64) if len(texts) else np.empty(0, np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes + 1)
    begins = np.cumsum(sizes + 1) - sizes - 1
    found = [r for lag in range(1, min(SHORT, len(words))) for r in _by_lag(words, lag, least)]
    hashes, span, of, at = _mixed(words.astype(np.uint64)), 1, doc, np.arange(len(words))
    scale = SHORT
    while scale * 2 <= sizes.max(initial=0):
        keep = sizes[of] >= 2 * scale  # texts too short for this scale go
        hashes, of, at = hashes[keep], of[keep], at[keep]
        while span < scale // 2:  # hashes of twice as many words
            hashes = _mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + np.roll(hashes, -span))
            span *= 2
        seeds, lags = _seeds(hashes, of, scale)
        found += _extended(words, at[seeds], lags, least)
        scale *= 2
    # a stretch that has a shorter period too was found with that as well
    shortest: dict[tuple[int, int], int] = {}
    for start, end, lag in found:
        shortest[start, end] = min(lag, shortest.get((start, end), lag))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (start, end), lag in shortest.items():
        d = int(doc[start])
        out[d].append((start - int(begins[d]), end - start, lag))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def repeated_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """For each of ``n`` words whether a run holds it after the run's first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:-1]) > 0


def _scan(least: int, text_at: int):
    """Batches of columns with a text at ``text_at`` → the other columns, then those of ``_OUT``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in portions(batch, text_at, PORTION_ROWS, PORTION_BYTES):
                split = [(t or "").encode("utf-8", "replace").split() for t in part.column(text_at).to_pylist()]
                codes = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                ends = np.cumsum([len(s) for s in split])
                all_runs = find_runs(np.split(codes, ends[:-1]), least)
                collapsed = []
                for s, runs in zip(split, all_runs, strict=True):
                    if runs:
                        gone = repeated_words(len(s), runs)
                        s = [w for w, g in zip(s, gone.tolist(), strict=True) if not g]
                    collapsed.append(b" ".join(s).decode("utf-8"))
                runs = pa.array([[{"start": a, "length": n, "period": p} for a, n, p in r] for r in all_runs], _OUT.field("runs").type)
                others = [part.column(i) for i in range(part.num_columns) if i != text_at]
                names = [part.schema.names[i] for i in range(part.num_columns) if i != text_at]
                columns = [*others, pa.array([len(s) for s in split], pa.int64()), runs, pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, [*names, *_OUT.names])

    return work


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = 12) -> DataFrame:
    """All columns of ``docs`` but the text, then n_words, runs and collapsed.

    Words are what lies between ASCII white space, compared as they are. ``runs`` is an array of
    (start, length, period), counted in words from 0, ordered by start, then period. ``collapsed`` has
    the words that no run holds after its first period, joined by single spaces.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``. Every text is taken
    whole, however long, in one task. Repeated rows and null ids stay as they are. Columns of ``docs``
    that bear the names of the three results are replaced, all others pass through. An empty table
    gives no rows.
    """
    rows = without(docs, [c for c in _OUT.names if c != text_col.lower()])
    m = unused_prefix(rows)
    # a text column that bears the name of a result makes room for it
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() != text_col.lower()], F.col(f"`{text_col}`").cast("string").alias(f"{m}text"))
    kept = rows.schema[:-1]
    ddl = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    return rows.mapInArrow(_scan(least, len(kept)), ", ".join([*ddl, _OUT_DDL]))


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` in which about every tenth text becomes periodic from some word on.

    With h the CRC-32 of the decimal id, g = h / 10 and n words, a text with h divisible by 10 gets, in
    place of each word i from a = g % n on, word a + (i - a) % p, where p = 1 + (n - a) / (3 + g % 8).
    Its words are then joined by single spaces. All other rows, null ids and texts without words included,
    stay as they are; other columns pass through.
    """
    m = unused_prefix(docs)
    words = F.filter(F.split(F.coalesce(text_col, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.withColumn(f"{m}h", h).withColumn(f"{m}words", F.when(F.col(f"{m}h") % 10 == 0, words))
    g, n = F.floor(F.col(f"{m}h") / 10), F.size(f"{m}words")
    rows = rows.withColumn(f"{m}a", F.when(n > 0, F.pmod(g, n)))
    rows = rows.withColumn(f"{m}p", 1 + F.floor((n - F.col(f"{m}a")) / (3 + g % 8)))
    a, p, w = F.col(f"{m}a"), F.col(f"{m}p"), F.col(f"{m}words")
    planted = F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int"))))
    text = F.when(a.isNotNull(), F.array_join(planted, " ")).otherwise(F.col(text_col))
    return rows.withColumn(text_col, text).select(*docs.columns)
