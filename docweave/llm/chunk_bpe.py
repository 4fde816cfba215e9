"""BPE encoding and decoding with content-defined chunks that documents share."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docweave.llm.common import slices, with_text_columns

# The split of the byte-level vocabulary.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Bytes of the rolling hash, and the bits of it that are zero at a cut: about 512 bytes per chunk.
_ROLL, _BITS = 8, 9

# Bytes of chunks and ids that a worker keeps for reuse before it starts over.
CACHE_BYTES = 32 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Ids, token bytes and special strings of a byte-level BPE file."""

    def __init__(self, content: str) -> None:
        loaded = json.loads(content)
        back = {letter: b for b, letter in enumerate(byte_letters())}
        self.special = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        ranks = {bytes(back[c] for c in token): i for token, i in loaded["model"]["vocab"].items() if token not in self.special}
        self.coder = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        table = {**{i: t for t, i in ranks.items()}, **{i: s.encode() for s, i in self.special.items()}}
        self.tokens = pa.array([table.get(i, b"") for i in range(max(table) + 1)], pa.large_binary())

    def decoded(self, rows: list[bytes]) -> pa.Array:
        """Texts of rows of ids: the bytes of the tokens as UTF-8, malformed bytes replaced."""
        numbers = np.frombuffer(b"".join(rows), "<u4").astype(np.int64)
        known = numbers < len(self.tokens)
        taken = self.tokens.take(pa.array(np.where(known, numbers, 0)))
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in rows])]).astype(np.int64)
        if known.all():
            offsets = np.frombuffer(taken.buffers()[1], np.int64)[: len(numbers) + 1]
            data = memoryview(taken.buffers()[2]) if taken.buffers()[2] is not None else memoryview(b"")
            texts = [bytes(data[offsets[a] : offsets[b]]) for a, b in zip(ends[:-1], ends[1:])]
        else:
            single = [t if k else b"" for t, k in zip(taken.to_pylist(), known.tolist())]
            texts = [b"".join(single[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        return pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())


def _safe(chunk: bytes, at: int) -> bool:
    """A space between a visible ASCII character and an ASCII letter: the split puts a boundary here in any context."""
    return 0 < at < len(chunk) - 1 and 0x21 <= chunk[at - 1] <= 0x7E and chr(chunk[at + 1]).isalpha() and chunk[at + 1] < 0x80


def _safe_ends(chunk: bytes) -> tuple[int, int]:
    """First and last safe space of a chunk; (-1, -1) with fewer than two."""
    first = chunk.find(b" ")
    while first >= 0 and not _safe(chunk, first):
        first = chunk.find(b" ", first + 1)
    last = chunk.rfind(b" ")
    while last > first >= 0 and not _safe(chunk, last):
        last = chunk.rfind(b" ", 0, last)
    return (first, last) if last > first >= 0 else (-1, -1)


def cuts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the chunks in the joined texts, the text of each chunk): a chunk ends where the hash of the last
    eight bytes has zero bits on top, so equal passages are cut alike wherever they stand."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    raw = np.frombuffer(b"".join(texts), np.uint8)
    inner = np.zeros(0, np.int64)
    if len(raw) > _ROLL:
        word = np.zeros(len(raw) - _ROLL, np.uint64)
        for shift in range(_ROLL):
            word = word << np.uint64(8) | raw[shift : shift + len(word)]
        word *= np.uint64(0x9E3779B97F4A7C15)
        inner = np.flatnonzero(word >> np.uint64(64 - _BITS) == 0) + _ROLL
        inner = inner[raw[inner] & 0xC0 != 0x80]  # between characters
        inner = inner[inner - starts[np.searchsorted(starts, inner, "right") - 1] >= _ROLL]
    filled = np.flatnonzero(sizes)
    begin = np.union1d(starts[filled], inner)
    return begin, filled[np.searchsorted(starts[filled], begin, "right") - 1] if len(filled) else begin


class ChunkCoder:
    """Encodes texts chunk by chunk. The inside of a chunk, from its first to its last safe space, has the same ids in
    any context and is encoded once. Around a join the ids of two chunks encoded apart may disagree with those of the
    whole; the stretch from the last safe space before it to the first one behind it is encoded again, over
    several chunks if need be, until both its ends are boundaries for certain."""

    def __init__(self, vocabulary: Vocabulary, room: int = CACHE_BYTES) -> None:
        self.vocabulary, self.room = vocabulary, room
        self.known: dict[bytes, tuple[bytes, bytes, bytes]] = {}
        self.kept = self.reused = self.encoded = 0

    def _ids(self, piece: bytes) -> bytes:
        return np.asarray(self.vocabulary.coder.encode_to_numpy(piece.decode()), "<u4").tobytes()

    def _chunk(self, chunk: bytes) -> tuple[bytes, bytes, bytes]:
        """(bytes before the first safe space, ids of the inside, bytes from the last one on)."""
        if (known := self.known.get(chunk)) is not None:
            self.reused += 1
            return known
        self.encoded += 1
        first, last = _safe_ends(chunk)
        parts = (chunk, b"", b"") if first < 0 else (chunk[:first], self._ids(chunk[first:last]), chunk[last:])
        size = 2 * len(chunk) + len(parts[1]) + 300
        if self.kept + size > self.room:
            self.known.clear()
            self.kept = 0
        self.known[chunk] = parts
        self.kept += size
        return parts

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        begin, owner = cuts(texts)
        joined = b"".join(texts)
        ends = [*begin[1:].tolist(), len(joined)]
        open_, current = b"", -1
        for start, end, text in zip(begin.tolist(), ends, owner.tolist()):
            if text != current:
                if open_:
                    out[current].append(self._ids(open_))
                open_, current = b"", text
            head, ids, tail = self._chunk(joined[start:end])
            open_ += head
            if ids:
                if open_:
                    out[text].append(self._ids(open_))
                out[text].append(ids)
                open_ = tail
        if open_:
            out[current].append(self._ids(open_))
        return [b"".join(parts) for parts in out]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """As ``encode``; special strings inside a text become their ids, as is the library's default."""
        special = self.vocabulary.special
        pieces: list[bytes] = []
        plan: list[list[int | bytes]] = []
        for text in texts:
            rest: list[str | bytes] = [text or ""]
            for name, number in special.items():
                if text and name in text:
                    mark = int(number).to_bytes(4, "little")
                    parts: list[str | bytes] = []
                    for part in rest:
                        split = part.split(name) if isinstance(part, str) else [part]
                        for k, one in enumerate(split):
                            parts += [mark, one] if k else [one]
                    rest = parts
            row: list[int | bytes] = []
            for part in rest:
                if isinstance(part, bytes):
                    row.append(part)
                else:
                    row.append(len(pieces))
                    pieces.append(part.encode())
            plan.append(row)
        ids = self.encode(pieces)
        return [b"".join(p if isinstance(p, bytes) else ids[p] for p in row) for row in plan]


def encode_texts(docs: DataFrame, content: str, text: str = "text", cache_bytes: int = CACHE_BYTES, decode: bool = False) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit integers), and with ``decode`` also
    ``decoded``, the text of these ids; in the same pass, since two passes in a row keep two workers per task busy.

    ``content``: the vocabulary file as a string. One pass without a shuffle; a worker keeps at most ``cache_bytes`` of
    chunks. Null or empty text: no ids. Repeated rows: one result each. Empty table: no rows. Columns of ``docs`` with
    these names are replaced.
    """
    fields: dict[str, T.DataType] = {"n_tokens": T.LongType(), "ids": T.BinaryType()}
    if decode:
        fields["decoded"] = T.StringType()

    def make() -> Callable:
        vocabulary = _vocabulary(content)
        coder = ChunkCoder(vocabulary, cache_bytes)

        def compute(texts: pa.Array) -> list[pa.Array]:
            ids = coder.encode_all(texts.to_pylist())
            found = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            return [*found, vocabulary.decoded(ids)] if decode else found

        return compute

    return with_text_columns(docs, text, fields, make)


_LOADED: dict[int, Vocabulary] = {}


def _vocabulary(content: str) -> Vocabulary:
    """The vocabulary, built once per worker."""
    key = hash(content)
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(content)
    return _LOADED[key]


def decode_ids(encoded: DataFrame, content: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the ids as UTF-8, malformed bytes replaced. A null or empty column of
    ids gives an empty text; an id outside the vocabulary gives nothing. A column ``decoded`` is replaced."""
    kept = [f for f in encoded.schema.fields if f.name != "decoded"]
    schema = T.StructType([*kept, T.StructField("decoded", T.StringType())])
    place = [f.name for f in kept].index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(content)
        for batch in batches:
            for offset, length in slices(batch.column(place)):
                part = batch.slice(offset, length)
                decoded = vocabulary.decoded([x or b"" for x in part.column(place).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=schema.names)

    return encoded.select(*(f"`{f.name}`" for f in kept)).mapInArrow(run, schema)
