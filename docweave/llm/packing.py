"""Best-fit packing of tokenised documents into sequences of one length, by sums of squares."""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.chunk_bpe import byte_letters
from docweave.llm.common import longs, slices, stored, words_of

CAPACITY = 2048

# Pieces that one task packs. More of them per task would waste a little less of the last sequences.
SHARD_PIECES = 8192

# Words whose ids a worker remembers before it starts over; longer words aren't remembered.
CACHE_WORDS, CACHE_LENGTH = 1_000_000, 64


# ASCII signs that start a token of their own behind a letter, whatever follows: all but the apostrophe, which may start
# an ending, and the signs of special strings.
SIGNS = b'!"#$%&()*+,-./:;=?@[\\]^_`{}~'


def apart(texts: pa.Array) -> pa.Array:
    """``texts`` with a space between a letter and a sign of ``SIGNS`` behind it, and in lower case where no special string
    can arise by that: the same tokens from far fewer distinct words. Letters are those of ASCII and Latin-1."""
    whole = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, values = whole.buffers()
    offsets = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if len(whole) and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind = _KIND[data]
    letter = kind == 1
    # The second byte of a two-byte letter; 0x97 and 0xB7 are the signs for multiplication and division.
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut = np.flatnonzero(letter[:-1] & (kind[1:] == 2)) + 1
    if b"<|" not in data.tobytes():
        data = _LOWER[data]
    spaced = np.insert(data, cut, ord(" "))
    # A sign at the start of a text may get its space at the end of the text before; no word changes by that.
    moved = offsets + np.searchsorted(cut, offsets, side="left")
    return pa.Array.from_buffers(pa.large_string(), len(whole), [None, pa.py_buffer(moved.astype(np.int64)), pa.py_buffer(spaced)])


_KIND = np.zeros(256, np.uint8)  # 1: letter, 2: sign
_KIND[[c for c in range(128) if chr(c).isalpha()]] = 1
_KIND[list(SIGNS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class WordEncoder:
    """Ids of texts by the tokenizers library, each distinct word once: no token of a word-end vocabulary crosses ASCII
    white space, and neither do its special strings."""

    def __init__(self, content: str, room: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_str(content)
        self.coder.no_truncation()
        self.coder.no_padding()
        self.merges, self.letters = self.coder.model, byte_letters()
        self.room = room
        self.known: dict[str, bytes] = {}

    def _parts(self, words: list[str]) -> list[bytes]:
        parts = list(map(self.known.get, words))
        new = [i for i, part in enumerate(parts) if part is None]
        if len(self.known) + len(new) > self.room:
            self.known.clear()
        # Small letters of Latin-1 are their own normal form and one piece of the split, so the merges alone decide.
        plain = [i for i in new if words[i].isalpha() and words[i].islower() and max(words[i]) <= "ÿ"]
        for i in plain:
            word = words[i] if words[i].isascii() else "".join(map(self.letters.__getitem__, words[i].encode()))
            parts[i] = array("I", [token.id for token in self.merges.tokenize(word)]).tobytes()
        rest = [i for i in new if parts[i] is None]
        for i, encoded in zip(rest, self.coder.encode_batch_fast([words[i] for i in rest], add_special_tokens=False)):
            parts[i] = array("I", encoded.ids).tobytes()
        self.known.update((words[i], parts[i]) for i in new if len(words[i]) <= CACHE_LENGTH)
        return parts

    def encode(self, texts: pa.Array, end: int) -> list[bytes]:
        """The ids of every text, followed by ``end``, as little-endian unsigned 32-bit integers."""
        words, vocabulary, first = words_of(apart(texts))
        parts = self._parts(vocabulary.to_pylist())
        each = list(map(parts.__getitem__, words.tolist()))
        last = end.to_bytes(4, "little")
        bounds = first.tolist()
        return [b"".join(each[a:z]) + last for a, z in zip(bounds, bounds[1:])]


_LOADED: dict[int, WordEncoder] = {}


def _encoder(content: str) -> WordEncoder:
    key = hash(content)
    if key not in _LOADED:
        _LOADED[key] = WordEncoder(content)
    return _LOADED[key]


def token_pieces(
    docs: DataFrame, content: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end: int = 0, keep_ids: bool = False
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: the ids of every text and the id ``end``, cut into pieces of
    ``capacity`` ids, the last one shorter; with ``keep_ids`` also ``ids`` (binary, little-endian unsigned 32-bit).

    ``content``: the vocabulary file as a string. One pass without a shuffle. Null or empty text: one piece that holds
    ``end``. Null ids stay null, repeated rows give their pieces again, an empty table gives no rows. Other columns
    of ``docs`` are ignored.
    """
    key = docs.schema[doc_id].dataType
    fields = [T.StructField("doc_id", key), T.StructField("piece", T.IntegerType())]
    fields += [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
    schema = T.StructType([*fields, *([T.StructField("ids", T.BinaryType())] if keep_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content)
        for batch in batches:
            for offset, length in slices(batch.column(1)):
                part = batch.slice(offset, length)
                ids = encoder.encode(part.column(1), end)
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                held = np.minimum(capacity, sizes[row] - start)
                step = 4 * capacity
                cut = [x[a : a + step] for x in ids for a in range(0, len(x), step)]
                columns = [part.column(0).take(pa.array(row)), pa.array(number.astype(np.int32)), longs(start), longs(held)]
                columns.append(longs(np.fromiter(map(zlib.crc32, cut), np.int64, len(cut))))
                if keep_ids:
                    columns.append(pa.array(cut, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).mapInArrow(run, schema)


class SquareSums:
    """Open bins by residual gap. An item goes where the sum of the squared numbers of open bins per gap becomes
    smallest: into a bin of some gap, which then has a smaller gap or is closed, or into a new bin. Of equal sums the
    tightest bin is taken, and a new one last."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.open = np.zeros(capacity + 1, np.int64)
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.held: list[list[int]] = []

    def place(self, item: int, size: int) -> None:
        full = self.capacity
        counts = self.open[size:full]
        # Leaving gap g takes 2 * open[g] - 1 from the sum, entering gap h adds 2 * open[h] + 1; a closed bin enters none.
        change = 2 * (self.open[: full - size] - counts) + 2
        if full > size:
            change[0] = 1 - 2 * counts[0]
            change[counts == 0] = np.iinfo(np.int64).max
            best = int(change.argmin())
            if change[best] <= 2 * self.open[full - size] + 1:
                self._into(self.at[size + best].pop(), item, size + best, size)
                return
        self.held.append([])
        self._into(len(self.held) - 1, item, full, size)

    def tightest(self, item: int, size: int) -> None:
        fits = np.flatnonzero(self.open[size : self.capacity])
        if len(fits):
            gap = size + int(fits[0])
            self._into(self.at[gap].pop(), item, gap, size)
        else:
            self.held.append([])
            self._into(len(self.held) - 1, item, self.capacity, size)

    def _into(self, bin_: int, item: int, gap: int, size: int) -> None:
        self.held[bin_].append(item)
        if gap < self.capacity:
            self.open[gap] -= 1
        if gap > size:
            self.open[gap - size] += 1
            self.at[gap - size].append(bin_)

    def unfinished(self) -> list[int]:
        return [b for gap in range(1, self.capacity) for b in self.at[gap]]


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers. Items come largest first. Sums of squares keep bins of many gaps open for what may still
    come; at the end nothing comes, so the items of unfinished bins are placed again, each into the tightest bin,
    if that takes fewer bins."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    packer = SquareSums(capacity)
    for item in order:
        packer.place(item, sizes[item])
    unfinished = set(packer.unfinished())
    last = SquareSums(capacity)
    for item in sorted((i for b in unfinished for i in packer.held[b]), key=lambda i: (-sizes[i], i)):
        last.tightest(item, sizes[item])
    if len(last.held) >= len(unfinished):
        return packer.held
    return [held for b, held in enumerate(packer.held) if b not in unfinished] + last.held


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: the sequence of at most ``capacity`` ids that holds the piece, and
    its place there, without gaps from 0.

    Pieces are dealt in turn to tasks of about ``shard_pieces``, whatever their keys, and every task packs its own.
    ``pieces`` must be a table that gives the same rows when it is read again. It needs ``doc_id``, ``piece`` and
    ``length`` (1 to ``capacity``); other columns stay. Repeated rows: each has a place. Empty table: no rows. Columns
    ``sequence_id`` and ``offset`` are replaced.
    """
    rows = pieces.drop("sequence_id", "offset")
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    shards = max(1, -(-rows.count() // shard_pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, None) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        # A repeated task may read its rows in another order.
        keys = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")]
        table = table.sort_by([*keys, *((n, "ascending") for n in ("ids_crc32",) if n in table.column_names)])
        sizes = table["length"].to_pylist()
        shard = TaskContext.get().partitionId() << 32
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for number, held in enumerate(pack(sizes, capacity)):
            sequence[held] = shard | number
            offset[held] = np.cumsum([0, *(sizes[i] for i in held[:-1])])
        placed = table.append_column("sequence_id", longs(sequence)).append_column("offset", longs(offset))
        yield from placed.to_batches(max_chunksize=10_000)

    return rows.repartition(shards).mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    content: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end: int = 0,
    keep_ids: bool = False,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """The pieces of ``token_pieces`` (same rules for nulls and repeats) in sequences of at most ``capacity`` ids:
    ``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset)``. The pieces are written to the shared
    checkpoint folder, with their ids only if ``keep_ids``."""
    return pack_pieces(stored(token_pieces(docs, content, doc_id, text, capacity, end, keep_ids)), capacity, shard_pieces)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, ids)`` of packed pieces that carry ``ids``; a sequence is one bounded group."""
    held = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(held, F.lit(b"").cast("binary"), lambda out, x: F.concat(out, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
