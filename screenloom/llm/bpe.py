"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

Encoding. A sequence of tokens is the BPE encoding of its bytes exactly when every neighbouring
pair is: merging the bytes of the two tokens gives these two tokens again. So for each prefix of
the input the last token is determined by the tokens before it, and a left-to-right machine needs
to remember only the places where a token may still be under way. A state holds those places: for
each, the bytes read since then (a node of the token trie) and the tokens up to it that aren't yet
certain. Reading a byte moves every place on, adds the place after the byte, and emits the tokens
that all places agree on; a place lives no longer than the longest token, so the lookahead is
bounded. States and transitions are made when first needed and then only looked up. All unseen
matches of a batch are stepped together: one look-up of a whole array of (state, byte), and Python
only for transitions that are new.

Decoding. Tokens are parts of characters, so a streaming decoder must hold back the bytes of an
unfinished one. A machine over the byte classes of UTF-8 does this; its moves over whole tokens
are composed when a token is first seen in a state.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from screenloom.llm.chunks import ChunkEncoder, Recent, portions


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes → rank, from a file with a base64 token and a rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The definition: again and again join the neighbouring pair of lowest rank, the first on ties."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Numbers:
    """A map from whole numbers (0 or more) to whole numbers, in numpy arrays by open addressing."""

    def __init__(self) -> None:
        self.keys, self.values, self.used = np.full(1 << 12, -1, np.int64), np.empty(1 << 12, np.int64), 0

    def _first(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, or -1."""
        out, left, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._first(keys)
        while len(left):
            held = self.keys[at]
            hit = held == keys[left]
            out[left[hit]] = self.values[at[hit]]
            on = ~hit & (held >= 0)
            left, at = left[on], (at[on] + 1) & (len(self.keys) - 1)
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys that are distinct and not yet in the map."""
        self.used += len(keys)
        if 2 * self.used > len(self.keys):
            held = self.keys >= 0
            keys, values = np.append(self.keys[held], keys), np.append(self.values[held], values)
            room = 1 << (4 * self.used - 1).bit_length()
            self.keys, self.values = np.full(room, -1, np.int64), np.empty(room, np.int64)
        left, at = np.arange(len(keys)), self._first(keys)
        while len(left):
            free = np.flatnonzero(self.keys[at] < 0)
            slots, who = np.unique(at[free], return_index=True)
            chosen = free[who]
            self.keys[slots], self.values[slots] = keys[left[chosen]], values[left[chosen]]
            on = np.ones(len(left), bool)
            on[chosen] = False
            left, at = left[on], (at[on] + 1) & (len(self.keys) - 1)


class Transducer:
    """Encodes the bytes of matches of the splitting pattern.

    Matches are stepped together, a byte at a time. A move is (next state, number of an output);
    a state is kept as the bytes of its numbers: the last certain token, then for each place its
    node, how many uncertain tokens lead to it, and these.
    """

    def __init__(self, ranks: dict[bytes, int], most_states: int = 400_000) -> None:
        self.ranks, self.most = ranks, most_states
        self.bytes_of = {i: t for t, i in ranks.items()}
        # tokens that merging never makes of their own bytes can only stand for a whole match
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                nxt = self.children[node].get(b)
                if nxt is None:
                    nxt = self.children[node][b] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = nxt
            self.token_at[node] = rank
        self._split: dict[int, tuple[int, int] | None] = {}
        self._edges: dict[int, list[int]] = {}
        self._pairs: dict[int, bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.states: dict[bytes, int] = {}
        self.of: list[bytes] = []
        self.moves = Numbers()  # state * 256 + byte → next state * 2**32 + output
        self.ends: list[int] = []  # output at the end of a match, by state
        self.outputs: dict[tuple[int, ...], int] = {(): 0}
        self.emitted: list[tuple[int, ...]] = [()]
        self.start = self._state([-1, 0, 0], ())

    def _output(self, tokens: tuple[int, ...]) -> int:
        n = self.outputs.get(tokens)
        if n is None:
            n = self.outputs[tokens] = len(self.emitted)
            self.emitted.append(tokens)
        return n

    def _state(self, numbers: list[int], ends: tuple[int, ...]) -> int:
        key = array("i", numbers).tobytes()
        n = self.states.get(key)
        if n is None:
            n = self.states[key] = len(self.of)
            self.of.append(key)
            self.ends.append(self._output(ends))
        return n

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a byte and for tokens that merging never makes."""
        found = self._split.get(token, 0)
        if found == 0:
            data = self.bytes_of[token]
            rest = {t: r for t, r in ((data[i:j], self.ranks.get(data[i:j])) for i in range(len(data)) for j in range(i + 1, len(data) + 1)) if r is not None and t != data}
            parts = merge_bytes(data, rest) if len(data) > 1 else []
            found = self._split[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return found

    def _edge(self, token: int, side: int) -> list[int]:
        """The tokens that stand at one edge (0: left, 1: right) while ``token`` is being made, first to last."""
        found = self._edges.get(token << 1 | side)
        if found is None:
            halves = self._halves(token)
            found = self._edges[token << 1 | side] = [*self._edge(halves[side], side), token] if halves else [token]
        return found

    def _fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: nothing) in an encoding.

        It may unless some merge across the boundary comes before the next merge at either edge.
        Of equal ranks the leftmost comes first.
        """
        key = (before + 1) << 32 | token
        ok = self._pairs.get(key)
        if ok is None:
            if len(self._pairs) > 500_000:
                self._pairs.clear()
            if before == -1:
                ok = len(self.bytes_of[token]) == 1 or self._halves(token) is not None
            else:
                ok = self._meet(self._edge(before, 1), self._edge(token, 0))
            self._pairs[key] = ok
        return ok

    def _meet(self, left: list[int], right: list[int]) -> bool:
        i = j = 0
        while True:
            across = self.ranks.get(self.bytes_of[left[i]] + self.bytes_of[right[j]])
            next_left = left[i + 1] if i + 1 < len(left) else 1 << 60
            next_right = right[j + 1] if j + 1 < len(right) else 1 << 60
            if across is not None and across < next_left and across <= next_right:
                return False
            if next_left == next_right == 1 << 60:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def _move(self, state: int, byte: int) -> int:
        numbers = array("i", self.of[state])
        last, at, moved, ended = numbers[0], 1, [], None
        while at < len(numbers):
            node, path = self.children[numbers[at]].get(byte), numbers[at + 2 : at + 2 + numbers[at + 1]]
            at += 2 + len(path)
            if node is None:
                continue
            # the longest that fits: places are in order of their beginning
            if ended is None and (token := self.token_at[node]) >= 0 and self._fits(path[-1] if path else last, token):
                ended = [*path, token]
            if self.children[node]:
                moved.append((node, path))
        agreed = shortest = len(ended)
        for _, path in moved:
            shortest = min(shortest, len(path))
            n = 0
            for a, b in zip(ended[:agreed], path, strict=False):
                if a != b:
                    break
                n += 1
            agreed = n
        moved.append((0, ended))
        if agreed:
            last = ended[agreed - 1]
        # no place is left that begins after the last certain token
        after = [-2 if shortest > agreed else last]
        for node, path in moved:
            after += (node, len(path) - agreed, *path[agreed:])
        return self._state(after, tuple(ended[agreed:])) << 32 | self._output(tuple(ended[:agreed]))

    def encode_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all matches, one after another, and how many each has."""
        if len(self.of) > self.most:
            self._restart()
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data, begin = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        longer = np.searchsorted(-lengths[order], -np.arange(int(lengths.max(initial=0)) + 1), side="left")
        states = np.full(len(pieces), self.start, np.int64)
        whose, outputs, at = [], [], 0
        # a few long ones are stepped alone
        while at < len(longer) and longer[at] > 8:
            own = order[: longer[at]]
            keys = states[own] << 8 | data[begin[own] + at]
            found = self.moves.find(keys)
            new = np.unique(keys[found < 0])
            if len(new):
                made = np.array([self._move(k >> 8, k & 255) for k in new.tolist()], np.int64)
                self.moves.put(new, made)
                missing = np.flatnonzero(found < 0)
                found[missing] = made[np.searchsorted(new, keys[missing])]
            states[own] = found >> 32
            output = found & 0xFFFFFFFF
            some = np.flatnonzero(output)
            whose.append(own[some])
            outputs.append(output[some])
            at += 1
        alone = order[: longer[at]] if at < len(longer) else order[:0]
        rest = np.setdiff1d(np.arange(len(pieces)), alone)
        whose.append(rest)
        outputs.append(np.array(self.ends, np.int64)[states[rest]])
        for i in alone.tolist():
            emitted = self._alone(int(states[i]), pieces[i][at:])
            whose.append(np.full(len(emitted), i))
            outputs.append(np.array(emitted, np.int64))
        whose, outputs = np.concatenate(whose), np.concatenate(outputs)
        outputs = outputs[np.argsort(whose, kind="stable")]
        number = np.fromiter(map(len, self.emitted), np.int64, len(self.emitted))
        ids = np.fromiter(chain.from_iterable(map(self.emitted.__getitem__, outputs.tolist())), np.int32)
        return ids, np.bincount(np.sort(whose), number[outputs], len(pieces)).astype(np.int64)

    def _alone(self, state: int, piece: bytes) -> list[int]:
        """Outputs of the rest of one match."""
        out, seen = [], {}
        for byte in piece:
            key = state << 8 | byte
            found = seen.get(key)
            if found is None:
                found = int(self.moves.find(np.array([key]))[0])
                if found < 0:
                    found = self._move(state, byte)
                    self.moves.put(np.array([key]), np.array([found]))
                if len(seen) > 100_000:
                    seen.clear()
                seen[key] = found
            state = found >> 32
            if found & 0xFFFFFFFF:
                out.append(found & 0xFFFFFFFF)
        return [*out, self.ends[state]]

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one match."""
        whole = self.ranks.get(piece)
        return tuple(self.encode_all([piece])[0].tolist()) if whole is None else (whole,)


# Letters and numbers of Unicode 17 (first-last code points), which tiktoken does not
# count among them; other versions of its tables would need other ranges.
NEWER_LETTERS = (
    "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA "
    "18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 "
    "1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E "
    "2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NEWER_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"


def _char_class(ranges: str) -> str:
    return "[" + "".join("-".join(f"\\U{int(c, 16):08X}" for c in r.split("-")) for r in ranges.split()) + "]"


class Splitter:
    """The matches of a pattern, as tiktoken finds them."""

    def __init__(self, pattern: str) -> None:
        letters, numbers = _char_class(NEWER_LETTERS), _char_class(NEWER_NUMBERS)
        self.newer = regex.compile(letters[:-1] + numbers[1:])
        self.usual = regex.compile(pattern)
        exact = pattern.replace(r"\p{L}", rf"[\p{{L}}--{letters}]").replace(r"\p{N}", rf"[\p{{N}}--{numbers}]")
        self.exact = regex.compile(exact, regex.V1)

    def __call__(self, text: str) -> list[str]:
        return (self.usual if text.isascii() or not self.newer.search(text) else self.exact).findall(text)


class Encoder:
    """Text → ids, each match of ``pattern`` separately; recent chunks and matches are kept."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.split, self.machine = Splitter(pattern), Transducer(ranks)
        self.matches = Recent(50_000)
        self.chunks = ChunkEncoder(self._texts)

    def _texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as the bytes of 32-bit numbers."""
        self.matches.turn()
        # words of ASCII letters are one match
        cut = [[t] if t.isascii() and (t[1:] if t[:1] == " " else t).isalpha() else self.split(t) for t in texts]
        distinct: dict[str, bytes] = {}
        new, ranks, find = [], self.machine.ranks, self.matches.find
        for match in dict.fromkeys(chain.from_iterable(cut)):
            got = find(match)
            if got is None:
                piece = match.encode()
                whole = ranks.get(piece)
                if whole is None:
                    new.append((match, piece))
                    continue
                got = array("i", (whole,)).tobytes()
            distinct[match] = got
        for some in (new[i : i + 20_000] for i in range(0, len(new), 20_000)):
            ids, number = self.machine.encode_all([piece for _, piece in some])
            data, end = ids.tobytes(), (np.cumsum(number) * 4).tolist()
            for (match, _), a, b in zip(some, [0, *end], end, strict=False):
                distinct[match] = data[a:b]
        # the others are kept with their chunks
        self.matches.update((m, distinct[m]) for matches in cut if len(matches) > 1 for m in matches if len(m) < 32)
        return [distinct[m[0]] if len(m) == 1 else b"".join(map(distinct.__getitem__, m)) for m in cut]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each has. Null counts as empty."""
        return self.chunks.encode(texts)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, number = self.encode_array(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(number)[:-1]) if texts else []


@cache
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def encode_bpe(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """Add ``ids_col`` (array<int>): the ids of each whole text, without special tokens.

    ``path`` names the file of ranks, on every machine. With ``decoded_col`` the ids are decoded
    again by the streaming machine in the same task and their bytes added under that name. Null text counts as empty and
    has no ids. Rows are independent, so ties and repeated rows need no rule; columns already
    named so are replaced. An empty table gives no rows.
    """
    df = df.drop(ids_col, *[decoded_col] * (decoded_col is not None))
    at = df.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tokens = _encoder(path, pattern), _tokens(path)
        decoder = StreamDecoder(tokens)
        for part in (p for batch in batches for p in portions(batch, at)):
            ids, number = encoder.encode_array(part.column(at))
            ends = np.concatenate([[0], np.cumsum(number)]).astype(np.int32)
            columns, names = [pa.ListArray.from_arrays(ends, ids)], [ids_col]
            if decoded_col is not None:
                decoded = ((decoder.feed(ids[a:b]) + decoder.finish()).encode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
                columns.append(pa.array(decoded, pa.binary()))
                names.append(decoded_col)
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], [*part.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    more = f", `{decoded_col}` binary" if decoded_col is not None else ""
    return df.mapInArrow(work, f"{fields}, `{ids_col}` array<int>{more}")


# --- decoding ----------------------------------------------------------------------------------


def _utf8_moves() -> list[list[int]]:
    """For each state and byte the next state. 0: between characters; 1-3: so many bytes missing;
    4-7: after a first byte that narrows the second one (E0, ED, F0, F4); 8: not UTF-8.
    """
    moves = [[8] * 256 for _ in range(9)]

    def put(state: int, first: int, last: int, to: int) -> None:
        moves[state][first : last + 1] = [to] * (last + 1 - first)

    put(0, 0x00, 0x7F, 0)
    put(0, 0xC2, 0xDF, 1)
    put(0, 0xE0, 0xEF, 2)
    put(0, 0xF0, 0xF4, 3)
    for byte, state in ((0xE0, 4), (0xED, 5), (0xF0, 6), (0xF4, 7)):
        moves[0][byte] = state
    for state in (1, 2, 3):
        put(state, 0x80, 0xBF, state - 1)
    put(4, 0xA0, 0xBF, 1)
    put(5, 0x80, 0x9F, 1)
    put(6, 0x90, 0xBF, 2)
    put(7, 0x80, 0x8F, 2)
    return moves


class StreamDecoder:
    """Ids, fed in any portions, to text: only whole characters are given out.

    Bytes that aren't UTF-8 are given out as U+FFFD.
    """

    MOVES = _utf8_moves()

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens, self.state, self.held = tokens, 0, b""
        #: the tokens that lead from between characters back there
        self.whole = np.array([self._token(0, i) == (0, len(t)) for i, t in enumerate(tokens)])
        self._over: dict[tuple[int, int], tuple[int, int]] = {}

    def _token(self, state: int, token: int) -> tuple[int, int]:
        """State after the token, and how many of its bytes end with the last whole character (-1: none)."""
        done = -1
        for n, byte in enumerate(self.tokens[token], 1):
            state = self.MOVES[state][byte]
            if state == 8:
                return 8, -1
            if state == 0:
                done = n
        return state, done

    def feed(self, ids: Iterable[int]) -> str:
        """Characters that these ids complete.

        Between characters, tokens of whole characters leave the machine where it is, so a run of
        them is taken at once; the others are stepped.
        """
        ids = np.asarray(ids, np.int64)
        odd = np.flatnonzero(~self.whole[ids])
        out, at, ids, tokens = [], 0, ids.tolist(), self.tokens
        for stop in [*odd.tolist(), len(ids)]:
            if stop < at:
                continue  # stepped already
            if self.state == 0 and stop > at:
                out.append(b"".join(map(tokens.__getitem__, ids[at:stop])).decode())
                at = stop
            while at < len(ids) and (at == stop or self.state):
                out.append(self._step(ids[at]))
                at += 1
        return "".join(out)

    def _step(self, token: int) -> str:
        key = (self.state, token)
        found = self._over.get(key)
        if found is None:
            found = self._over[key] = self._token(*key)
        state, done = found
        if state == 8:  # let the standard error handler find the bytes at fault
            data = self.held + self.tokens[token]
            for n in range(len(data), max(-1, len(data) - 4), -1):
                s = 0
                for byte in data[n:]:
                    s = self.MOVES[s][byte]
                if s not in (0, 8) or n == len(data):
                    keep, self.state = n, s
            self.held = data[keep:]
            return data[:keep].decode("utf-8", "replace")
        self.state = state
        if done < 0:
            self.held += self.tokens[token]
            return ""
        text = (self.held + self.tokens[token][:done]).decode()
        self.held = self.tokens[token][done:]
        return text

    def finish(self) -> str:
        """What is left of an unfinished character."""
        held, self.held, self.state = self.held, b"", 0
        return held.decode("utf-8", "replace")


@cache
def _tokens(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    out = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


def decode_bpe(df: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add ``bytes_col`` (binary): the bytes of the ids. Null and empty ids give no bytes."""

    @F.pandas_udf(BinaryType())
    def decode(ids: pd.Series) -> pd.Series:
        tokens = _tokens(path)
        return ids.map(lambda x: b"" if x is None else b"".join(map(tokens.__getitem__, x.tolist())))

    return df.withColumn(bytes_col, decode(ids_col))


def decode_bpe_stream(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded_text") -> DataFrame:
    """Add ``text_col`` (string): the ids decoded by the incremental machine."""

    @F.pandas_udf("string")
    def decode(ids: pd.Series) -> pd.Series:
        decoder = StreamDecoder(_tokens(path))
        return ids.map(lambda x: "" if x is None else decoder.feed(x.tolist()) + decoder.finish())

    return df.withColumn(text_col, decode(ids_col))
