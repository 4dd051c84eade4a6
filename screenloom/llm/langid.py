"""Language identification by a byte convolutional network.

Every text is cut into windows of a fixed number of bytes. Bytes are embedded, filters of several
widths slide over the window, each filter's largest response feeds a softmax over the languages.
The network is trained in numpy on a bounded sample of labelled texts; it is then applied inside
tasks to batches of windows that cover whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenloom.llm.common import unused_prefix, without

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
UNKNOWN = "und"
#: A text is in no language if the class of made-up texts has more than this share of its probability.
LEAST_KNOWN = 0.5
#: Ranges of characters from which made-up texts are drawn: ASCII letters, symbols, digits, and other scripts.
_ASCII = ((97, 123), (33, 127), (32, 65), (48, 58))
_SCRIPTS = ((0x100, 0x180), (0x370, 0x400), (0x400, 0x500), (0x590, 0x600), (0x600, 0x700), (0x900, 0x980), (0xE00, 0xE80), (0x3040, 0x3100), (0x4E00, 0xA000), (0xAC00, 0xD7A4))
#: Byte → symbol: A-Z as a-z; 0 fills windows up.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def windows(text: str) -> np.ndarray:
    """All bytes of a text in rows of ``WINDOW``, the last filled up with zeros."""
    data = FOLD[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    out = np.zeros(max(1, -(-len(data) // WINDOW)) * WINDOW, np.uint8)
    out[: len(data)] = data
    return out.reshape(-1, WINDOW)


@dataclass
class ByteNet:
    """Weights: embedding (256, E), filters (widest * E, widths * FILTERS), bias, output (features, languages), bias."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    output: np.ndarray
    shift: np.ndarray

    def columns(self, batch: np.ndarray) -> np.ndarray:
        """For each place of each window the embedded bytes under the widest filter."""
        wide = max(WIDTHS)
        padded = np.zeros((len(batch), WINDOW + wide - 1), np.uint8)
        padded[:, :WINDOW] = batch
        spread = np.lib.stride_tricks.sliding_window_view(self.embedding[padded].reshape(len(batch), -1), wide * EMBEDDING, axis=1)
        return np.ascontiguousarray(spread[:, ::EMBEDDING])

    def pooled(self, columns: np.ndarray) -> np.ndarray:
        return columns.reshape(-1, columns.shape[2]) @ self.filters

    def probabilities(self, batch: np.ndarray) -> np.ndarray:
        """Softmax over languages for each window."""
        response = self.pooled(self.columns(batch)).reshape(len(batch), WINDOW, -1).max(axis=1) + self.bias
        return softmax(np.maximum(response, 0) @ self.output + self.shift)


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(examples: np.ndarray, targets: np.ndarray, languages: list[str], epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7) -> ByteNet:
    """Adam on cross-entropy. Half of the examples are cut to a random part, so that short texts are learned too."""
    rng = np.random.default_rng(seed)
    wide, n = max(WIDTHS), len(WIDTHS) * FILTERS
    # a narrower filter is a widest one whose further rows stay zero
    mask = np.concatenate([np.repeat((np.arange(wide) < w).astype(np.float32), EMBEDDING)[:, None].repeat(FILTERS, 1) for w in WIDTHS], axis=1)
    net = ByteNet(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        (rng.normal(0, 0.2, (wide * EMBEDDING, n)) * mask).astype(np.float32),
        np.zeros(n, np.float32),
        rng.normal(0, 0.1, (n, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    net.embedding[0] = 0
    weights = [net.embedding, net.filters, net.bias, net.output, net.shift]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step, steps = 0, epochs * -(-len(examples) // batch)
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(examples)), -(-len(examples) // batch)):
            x, y = examples[at].copy(), targets[at]
            for row in x[: len(x) // 2]:
                used = max(1, int(np.count_nonzero(row)))
                size = min(used, int(2 ** rng.uniform(2, 8)))
                begin = int(rng.integers(0, used - size + 1))
                part = row[begin : begin + size].copy()
                row[:] = 0
                row[:size] = part
            columns = net.columns(x)
            response = net.pooled(columns).reshape(len(x), WINDOW, n)
            place = response.argmax(axis=1)
            top = np.take_along_axis(response, place[:, None], 1)[:, 0] + net.bias
            hidden = np.maximum(top, 0)
            error = softmax(hidden @ net.output + net.shift)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            d_top = (error @ net.output.T) * (top > 0)
            seen = columns[np.arange(len(x))[:, None], place]  # (batch, filters, widest * EMBEDDING)
            d_filters = np.einsum("bf,bfc->cf", d_top, seen) * mask
            d_seen = (d_top[:, :, None] * net.filters.T[None]).reshape(-1, EMBEDDING)
            padded = np.zeros((len(x), WINDOW + wide - 1), np.uint8)
            padded[:, :WINDOW] = x
            symbols = padded[np.arange(len(x))[:, None, None], place[:, :, None] + np.arange(wide)].ravel()
            d_embedding = np.stack([np.bincount(symbols, d_seen[:, e], 256) for e in range(EMBEDDING)], axis=1)
            d_embedding[0] = 0
            step += 1
            pace = rate * (1 - 0.9 * step / steps)
            for w, g, m, v in zip(weights, (d_embedding, d_filters, d_top.sum(0), hidden.T @ error, error.sum(0)), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def made_up(examples: np.ndarray, seed: int = 5) -> np.ndarray:
    """As many windows in no language as there are examples, and as long.

    Half are examples whose letters a-z are exchanged for others; the rest is drawn from a range
    of ASCII, drawn from another script, or one to three characters over and over.
    """
    rng, out = np.random.default_rng(seed), np.zeros_like(examples)
    for row, made in zip(examples, out, strict=True):
        kind, used = rng.integers(0, 6), max(1, int(np.count_nonzero(row)))
        if kind < 3:
            letters = np.arange(256, dtype=np.uint8)
            letters[97:123] = 97 + rng.permutation(26) if kind else rng.integers(97, 123, 26)
            made[:] = letters[row]
            continue
        ranges = _ASCII if kind == 3 else _SCRIPTS
        low, high = ranges[rng.integers(0, len(ranges))] if kind < 5 else _ASCII[1]
        codes = rng.integers(low, high, used if kind < 5 else rng.integers(1, 4))
        if kind < 5:
            codes[rng.random(used) < rng.choice([0, 0.15])] = 32
        data = FOLD[np.frombuffer("".join(map(chr, codes)).encode(), np.uint8)]
        made[:used] = np.resize(data, used)
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0 (or the id is null)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(True))


def labelled_windows(docs: DataFrame, per_language: int = 400, per_text: int = 4, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A bounded training sample: of each language about ``per_language`` texts, of each at most ``per_text`` windows.

    Texts are chosen by a hash of the id among those that aren't held out; with many languages
    fewer texts of each are taken, so that the sample stays under 64,000 windows.
    """
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike("\\p{L}"))
    counts = {r[lang_col]: r["count"] for r in docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull()).groupBy(lang_col).count().collect()}
    if not counts:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), []
    each = max(1, min(per_language, 16_000 // len(counts)))
    # one flat map, however many labels there are, instead of a case inside a case
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 1.5 * each / n))])
    draw = F.pmod(F.xxhash64(F.col(id_col), F.lit(11)), F.lit(1 << 30)) / float(1 << 30)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [windows(t) for t in batch.column(2).to_pylist()]
            picked = [np.unique(np.linspace(0, len(p) - 1, min(per_text, len(p))).astype(int)) for p in parts]
            data = pa.array([p[i].tobytes() for p, i in zip(parts, picked, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), data], ["draw", "lang", "data"])

    sample = rows.filter(draw < shares[F.col(lang_col)]).select(draw.alias("draw"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    got = sorted((r["draw"], r["lang"], bytes(r["data"])) for r in sample.mapInArrow(cut, "draw double, lang string, data binary").collect())
    taken, languages = dict.fromkeys(sorted(counts), 0), sorted(counts)
    examples, targets = [], []
    for _, lang, data in got:
        if taken[lang] < each:
            taken[lang] += 1
            rows_ = np.frombuffer(data, np.uint8).reshape(-1, WINDOW)
            examples.append(rows_)
            targets += [languages.index(lang)] * len(rows_)
    if not examples:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, np.int64), []
    return np.concatenate(examples), np.array(targets), languages


def predict(docs: DataFrame, net: ByteNet | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the mean probability of that language over the text's windows).

    A text that is null or has no letter is ``und`` with score 0, as is every text when there is
    no network. Where the network knows the class ``und`` and gives it more than ``1 - LEAST_KNOWN``
    of a text, the text is ``und`` with that score. Very long texts have more windows; all bytes are looked at. Existing columns named
    lang_pred and score are replaced.
    """
    docs = without(docs, ["lang_pred", "score"])
    if net is None:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    at = docs.columns.index(text_col)
    # the class of made-up texts comes last
    known = len(net.languages) - (net.languages[-1] == UNKNOWN)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    # no window of a text without letters is looked at
    lettered = docs.withColumn(unused_prefix(docs) + "lettered", F.coalesce(F.col(text_col).rlike("\\p{L}"), F.lit(False)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                texts = [t if ok else None for t, ok in zip(part.column(at).to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True)]
                cut = [windows(t) for t in texts if t is not None]
                best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if cut:
                    rows = np.concatenate(cut)
                    p = np.concatenate([net.probabilities(rows[i : i + 128]) for i in range(0, len(rows), 128)])
                    used = np.count_nonzero(rows, axis=1).astype(np.float64) + 1e-9
                    begin = np.cumsum([0, *map(len, cut)])[:-1]
                    mean = np.add.reduceat(p * used[:, None], begin) / np.add.reduceat(used, begin)[:, None]
                    for i, m in zip((i for i, t in enumerate(texts) if t is not None), mean, strict=True):
                        top = int(m[:known].argmax()) if m[:known].sum() >= LEAST_KNOWN else known
                        best[i], score[i] = net.languages[top], min(1.0, float(m[top]))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(best, pa.string()), pa.array(score, pa.float64())], [*part.schema.names[:-1], "lang_pred", "score"])

    return lettered.mapInArrow(work, f"{fields}, lang_pred string, score double")


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", reject: bool = False) -> DataFrame:
    """Train on the labelled documents that aren't held out, predict all: ``docs`` with lang_pred and score.

    Labels, sources and ids are never inputs of a prediction. Repeated rows and ties get equal
    results; an empty table gives no rows; without labels everything is ``und``. With ``reject``
    the network learns made-up texts as a further class, and texts that it counts among them are ``und``.
    """
    examples, targets, languages = labelled_windows(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    if reject and languages:
        examples, targets = np.concatenate([examples, made_up(examples)]), np.append(targets, np.full(len(examples), len(languages)))
        languages = [*languages, UNKNOWN]
    return predict(docs, train(examples, targets, languages) if languages else None, text_col)
