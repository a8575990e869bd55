"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decode by a UTF-8 state machine.

The merge table is compiled into a deterministic transducer over the bytes of a piece (a piece is one match of the
tokenizer's split pattern). A token sequence is the BPE encoding exactly if every two neighbours are (Berglund, van der
Merwe: "Formalizing BPE tokenization"; neighbours are checked with the merge table and remembered), so which token ends
a prefix depends only on the token before it. A state is what the future depends on: the suffixes of the bytes read that
may still become a token, each with the token before it, and the last token of the prefix. Prefixes that agree in this
are one state. States are created on first use; when there are ``max_states`` of them all but the present one are
dropped and built anew, as lazy automata are, which changes no result.

Every state that the rest of a piece may go back to is the present place or the start of one of these suffixes. The
tokens before the place where the back pointers of all of these meet are final: they are emitted there, so that memory
is bounded by this lookahead and time grows with the length, however long a piece is.

Defined results: NULL and empty texts give the empty list; special tokens are ordinary text; texts of any length.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from albaran.session import ship

# Fixed value: the split pattern of the public byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Where the vocabulary is unless the session's setting VOCABULARY_SETTING or the argument `path` says otherwise.
VOCABULARY, VOCABULARY_SETTING = "/opt/tokenizers/byte_bpe_50k.tiktoken", "spark.albaran.vocabulary"


def read_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """token bytes -> id, from a file of lines `base64 rank`."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    """Encodes pieces of bytes; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 100_000, max_pieces: int = 400_000, room: int = 512):
        self.ranks = ranks
        self.max_states, self.max_pieces, self.room = max_states, max_pieces, room
        self.sorted = sorted(ranks)
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.pieces: dict[str, list[int]] = {}
        self._reset()

    def _reset(self) -> None:
        self.step: list[dict[int, int]] = []
        self.live: list[tuple[tuple[bytes, bytes], ...]] = []
        self.last: list[bytes] = []
        self.index: dict[tuple, int] = {}
        self._state((), b"")

    def _state(self, live: tuple[tuple[bytes, bytes], ...], last: bytes) -> int:
        known = self.index.get((live, last))
        if known is None:
            known = self.index[(live, last)] = len(self.step)
            self.step.append({})
            self.live.append(live)
            self.last.append(last)
        return known

    def _merge(self, word: bytes) -> list[bytes]:
        """BPE by the definition: merge the pair of lowest rank, first place first."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, a: bytes, b: bytes) -> bool:
        """Is [a, b] the encoding of a + b? With an empty a: is b its own encoding?"""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > self.max_pieces:
                self.pairs.clear()
            known = self.pairs[(a, b)] = self._merge(a + b) == ([a, b] if a else [b])
        return known

    def _starts(self, s: bytes) -> bool:
        """Is s the beginning of a longer token?"""
        i = bisect_right(self.sorted, s)
        return i < len(self.sorted) and self.sorted[i].startswith(s)

    def _grow(self, state: int, byte: int) -> int:
        """The state after `byte`: the longest suffix that is a token and fits the token before it ends the prefix."""
        if len(self.step) > self.max_states:
            kept = self.live[state], self.last[state]
            self._reset()
            state = self._state(*kept)
        more, token, live = bytes((byte,)), None, []
        for suffix, before in (*self.live[state], (b"", self.last[state])):  # longest first
            s = suffix + more
            if token is None and s in self.ranks and self._fit(before, s):
                token = s
            if self._starts(s):
                live.append((s, before))
        if token is None:
            raise ValueError("the vocabulary does not have every byte")
        to = self.step[state][byte] = self._state(tuple(live), token)
        return to

    def _final(self, state: int, ends: list[bytes]) -> int:
        """The last place before which nothing can change. ends: the token that ends at each place not emitted yet."""
        n = len(ends)
        places = {n, *(n - len(s) for s, _ in self.live[state])}
        while len(places) > 1:
            at = max(places)
            if at <= 0:
                return 0
            places.remove(at)
            places.add(at - len(ends[at - 1]))
        return max(0, places.pop())

    def _read(self, ends: list[bytes], upto: int) -> list[int]:
        out = []
        while upto > 0:
            out.append(self.ranks[ends[upto - 1]])
            upto -= len(ends[upto - 1])
        out.reverse()
        return out

    def run(self, data: bytes) -> Iterator[list[int]]:
        """The token ids of one piece, in parts that come as soon as they are final."""
        state, ends, room = 0, [], self.room
        for byte in data:
            to = self.step[state].get(byte)
            state = self._grow(state, byte) if to is None else to
            ends.append(self.last[state])
            if len(ends) >= room:
                upto = self._final(state, ends)
                if upto:
                    yield self._read(ends, upto)
                    del ends[:upto]
                room = max(self.room, 2 * len(ends))
        yield self._read(ends, len(ends))

    def piece(self, text: str) -> list[int]:
        """Token ids of one piece."""
        known = self.pieces.get(text)
        if known is not None:
            return known
        if len(self.pieces) > self.max_pieces:
            self.pieces.clear()
        out: list[int] = []
        for part in self.run(text.encode("utf-8")):
            out += part
        if len(text) <= 64:
            self.pieces[text] = out
        return out


class Tokenizer:
    def __init__(self, ranks: dict[bytes, int]):
        import regex

        self.find = regex.compile(PATTERN).finditer
        self.transducer = Transducer(ranks)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if text:
            known, piece = self.transducer.pieces, self.transducer.piece
            for m in self.find(text):
                w = m.group()
                got = known.get(w)
                out += got if got is not None else piece(w)
        return out

    def count(self, text: str | None) -> int:
        n = 0
        if text:
            known, piece = self.transducer.pieces, self.transducer.piece
            for m in self.find(text):
                w = m.group()
                got = known.get(w)
                n += len(got) if got is not None else len(piece(w))
        return n


class Utf8Stream:
    """Incremental UTF-8 decoder: bytes come in pieces of any cut, characters come out as soon as they are whole.

    A malformed byte becomes U+FFFD, one for each maximal prefix of a sequence that can't be finished.
    """

    def __init__(self) -> None:
        self.need, self.code, self.low, self.high = 0, 0, 0x80, 0xBF

    def feed(self, data: bytes) -> str:
        out: list[str] = []
        for b in data:
            again = True
            while again:
                again = False
                if self.need:
                    if self.low <= b <= self.high:
                        self.code, self.need, self.low, self.high = self.code << 6 | b & 0x3F, self.need - 1, 0x80, 0xBF
                        if not self.need:
                            out.append(chr(self.code))
                    else:
                        out.append("�")
                        self.need, self.low, self.high, again = 0, 0x80, 0xBF, True
                elif b < 0x80:
                    out.append(chr(b))
                elif 0xC2 <= b <= 0xDF:
                    self.need, self.code = 1, b & 0x1F
                elif 0xE0 <= b <= 0xEF:
                    self.need, self.code = 2, b & 0x0F
                    self.low, self.high = (0xA0 if b == 0xE0 else 0x80), (0x9F if b == 0xED else 0xBF)
                elif 0xF0 <= b <= 0xF4:
                    self.need, self.code = 3, b & 0x07
                    self.low, self.high = (0x90 if b == 0xF0 else 0x80), (0x8F if b == 0xF4 else 0xBF)
                else:
                    out.append("�")
        return "".join(out)

    def end(self) -> str:
        """What is left over: one U+FFFD if a character is unfinished."""
        left = "�" if self.need else ""
        self.need, self.low, self.high = 0, 0x80, 0xBF
        return left


def decode_stream(ids: Iterable[int], tokens: list[bytes]) -> Iterator[str]:
    """The text of ids, piece by piece."""
    machine = Utf8Stream()
    for i in ids:
        if piece := machine.feed(tokens[i]):
            yield piece
    if rest := machine.end():
        yield rest


def _shared(df: DataFrame, path: str | None):
    """The vocabulary for the executors: a file of fixed size (under 1 MB), read once on the driver."""
    ship(df.sparkSession)
    with open(path or df.sparkSession.conf.get(VOCABULARY_SETTING, VOCABULARY), "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


_OWN: dict[int, Tokenizer] = {}


def _tokenizer(raw: bytes) -> Tokenizer:
    """One tokenizer for each Python worker, kept between tasks."""
    key = hash(raw)
    if key not in _OWN:
        _OWN[key] = Tokenizer({base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x.strip())})
    return _OWN[key]


def _blocks(batches: Iterable[pa.RecordBatch], text: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into blocks of about `most` bytes of text, so that long texts don't pile up."""
    for batch in batches:
        size = batch.column(text).nbytes
        rows = max(1, int(batch.num_rows * min(1.0, most / max(1, size))))
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def encode(docs: DataFrame, key: str, text: str, path: str | None = None, out: str = "ids") -> DataFrame:
    """(key, ids ARRAY<INT>) of every row: one pass, no shuffle, only the two columns are read."""
    raw = _shared(docs, path)
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(raw.value)
        for b in _blocks(batches, text):
            ends, flat = np.zeros(b.num_rows + 1, np.int32), []
            for i, x in enumerate(b.column(text).to_pylist()):
                flat += tok.encode(x)
                ends[i + 1] = len(flat)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(key), lists], [key, out])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind.simpleString()}, `{out}` array<int>")


def token_counts(docs: DataFrame, keep: list[str], text: str, path: str | None = None, out: str = "tokens") -> DataFrame:
    """The columns keep and the number of tokens of text (0 for NULL and empty)."""
    raw = _shared(docs, path)
    schema = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(raw.value)
        for b in _blocks(batches, text):
            n = pa.array([tok.count(x) for x in b.column(text).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), n], [*keep, out])

    return docs.select(*keep, text).mapInArrow(run, f"{schema}, `{out}` bigint")


def decode(encoded: DataFrame, key: str, ids: str = "ids", path: str | None = None, out: str = "text") -> DataFrame:
    """(key, text) of the token lists; NULL lists give the empty text."""
    raw = _shared(encoded, path)
    kind = encoded.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _tokenizer(raw.value).transducer.ranks
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            tokens[i] = t
        for b in batches:
            texts = ["".join(decode_stream(x or [], tokens)) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(texts, pa.string())], [key, out])

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {kind.simpleString()}, `{out}` string")
