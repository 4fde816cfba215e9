"""Substring dedup over words: super-k-mers of equal minimisers are packed, sent to a bucket and sorted there."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.common import ids_back, ids_of, longs, mix, slices, sliding_min, words_of

# Words of the hashed grams whose least hash names a window's bucket.
GRAM = 2

# Words of the grams that split the windows of a minimiser too large for a bucket; windows of one that is still too
# large are dealt by the window itself.
LONG_GRAM = 8

# Text bytes that one step of a map task packs; copies inside a step are resolved before the shuffle.
PACK_BYTES = 8 << 20

# Bytes of packed words that a bucket should hold; super-k-mers overlap, so about three times the text travels.
BUCKET_BYTES = 16 << 20

_PRIME = np.uint64(0x9E3779B185EBCA87)

MARKS = "doc_id long, text_hash long, start int, windows int"


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64."""
    inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
    up, down = np.full(count, _PRIME, np.uint64), np.full(count, inverse, np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up), np.cumprod(down)


def _window_keys(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit polynomial of every ``width`` neighbouring word hashes."""
    up, down = _powers(len(hashes))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up)])
    return mix((sums[width:] - sums[:-width]) * down[: len(hashes) - width + 1])


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Flags of the keys that are among the sorted ``known`` ones."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _minimisers(hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every window by its least short gram, and by that and its least long gram."""
    least = lambda size: sliding_min(_window_keys(hashes, size), width - size + 1)
    low = least(GRAM)
    return low, mix(low ^ mix(least(min(width, LONG_GRAM))))


def _deal(hashes: np.ndarray, width: int, large: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The key of every window, equal for equal windows: the first one that isn't ``large``."""
    if not len(large[0]):
        return sliding_min(_window_keys(hashes, GRAM), width - GRAM + 1)
    key, finer = _minimisers(hashes, width)
    split = _among(key, large[0])
    key = np.where(split, finer, key)
    split &= _among(finer, large[1])
    return np.where(split, _window_keys(hashes, width), key)


def _runs_of(keys: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, begin, stop) of the runs of windows with one key inside one row; ``first``: first word of each row and the end."""
    row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = row_of[: len(keys)] == row_of[width - 1 :]
    begins = inside.copy()
    begins[1:] &= ~(inside[:-1] & (keys[1:] == keys[:-1]))
    begin = np.flatnonzero(begins)
    # A run ends where the next begins or its row has no more window.
    stops = np.append(begin[1:], len(keys))[: len(begin)]
    return row_of[begin], begin, np.minimum(stops, first[row_of[begin] + 1] - width + 1)


def _hashed(rows: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """(word numbers, distinct words, hashes of the words in order, first word of each row and the end)."""
    words, vocabulary, first = words_of(rows)
    distinct = vocabulary.cast(pa.large_binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    return words, distinct, hashes[words], first


NONE_LARGE = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def super_kmers(
    rows: pa.Array, width: int, large: tuple[np.ndarray, np.ndarray] = NONE_LARGE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(row, start word, words, key, packed string) of the runs of windows that share a key, see ``_deal``."""
    words, distinct, hashes, first = _hashed(rows)
    empty = np.zeros(0, np.int64)
    if len(words) < width:
        return empty, empty, empty, empty.view(np.uint64), []
    keys = _deal(hashes, width, large)
    row, begin, stops = _runs_of(keys, first, width)
    if not len(begin):
        return empty, empty, empty, empty.view(np.uint64), []
    spaced = pa.array([w + b" " for w in distinct], pa.large_binary()).take(pa.array(words))
    text = spaced.buffers()[2].to_pybytes() if len(spaced) else b""
    lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))[words] + 1
    ends = np.cumsum(lengths)
    left = (ends - lengths)[begin].tolist()
    right = (ends[stops + width - 2] - 1).tolist()
    strings = [text[a:b] for a, b in zip(left, right)]
    return row, begin - first[row], stops - begin + width - 1, keys[begin], strings


def _count_keys(width: int, share: float) -> Callable:
    """Packed bytes per key of both levels, equal super-k-mers of a step once; keys with less than ``share`` of the
    step's text are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offset, length in slices(batch.column(0), PACK_BYTES):
                part = batch.column(0).slice(offset, length)
                words, distinct, hashes, first = _hashed(part)
                if len(words) < width:
                    continue
                least = share * pc.sum(pc.binary_length(part)).as_py()
                lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))[words] + 1
                before = np.concatenate([[0], np.cumsum(lengths)])
                up, down = _powers(len(hashes))
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up)])
                for level, keys in enumerate(_minimisers(hashes, width)):
                    _, begin, stops = _runs_of(keys, first, width)
                    ends = stops + width - 1
                    _, once = np.unique(mix((sums[ends] - sums[begin]) * down[begin]), return_index=True)
                    values, group = np.unique(keys[begin[once]], return_inverse=True)
                    size = np.bincount(group, before[ends[once]] - before[begin[once]], len(values)).astype(np.int64)
                    many = size >= least
                    yield pa.RecordBatch.from_arrays(
                        [longs(np.full(int(many.sum()), level)), longs(values[many].view(np.int64)), longs(size[many])],
                        names=["level", "key", "bytes"],
                    )

    return run


def large_keys(rows: DataFrame, width: int, total: int, bucket_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of both levels that hold more packed bytes than a bucket should.

    What a step leaves out is in sum at most half a bucket per key, so with half a bucket as the bound no key above
    ``bucket_bytes`` is missed. There are at most about ``12 * total / bucket_bytes`` keys.
    """
    counted = rows.select("text").mapInArrow(_count_keys(width, bucket_bytes / (2 * total)), "level long, key long, bytes long")
    summed = counted.groupBy("level", "key").agg(F.sum("bytes").alias("bytes")).filter(F.col("bytes") >= bucket_bytes / 2)
    found = summed.select("level", "key").collect()
    return tuple(np.sort(np.array([r.key for r in found if r.level == level], np.int64).view(np.uint64)) for level in (0, 1))


def _places(ids: np.ndarray, texts: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> bytes:
    """Where super-k-mers come from; ids as differences, since neighbours are close."""
    return np.diff(ids, prepend=0).tobytes() + b"".join(x.astype(np.int32).tobytes() for x in (texts, starts, counts))


def _unplaced(raw: bytes) -> list[np.ndarray]:
    size = len(raw) // 20
    numbers = np.frombuffer(raw, np.int32, offset=8 * size).reshape(3, size).astype(np.int64)
    return [np.cumsum(np.frombuffer(raw, np.int64, size)), *numbers]


def _pack(width: int, buckets: int, large: tuple[np.ndarray, np.ndarray]) -> Callable:
    """Map side: one row per bucket and step, and the windows that an equal super-k-mer of the step already covers."""
    types = {"bucket": pa.int64(), "places": pa.binary(), "packed": pa.binary(), "marks": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for offset, length in slices(batch.column(2), PACK_BYTES):
                part = batch.slice(offset, length)
                part = part.take(pa.array(np.argsort(ids_of(part.column(0)), kind="stable")))
                ids, hashes = ids_of(part.column(0)), part.column(1).to_numpy()
                row, start, count, low, strings = super_kmers(part.column(2), width, large)
                bucket = (low % np.uint64(buckets)).astype(np.int64)
                known: dict[bytes, int] = {}
                send = np.ones(len(strings), bool)
                covered = []
                for k, string in enumerate(strings):
                    other = known.setdefault(string, k)
                    if other != k:
                        same_place = ids[row[k]] == ids[row[other]] and start[k] == start[other]
                        if same_place:  # repeated rows, or equal ids with other texts
                            send[k] = hashes[row[k]] != hashes[row[other]]
                        elif (ids[row[other]], start[other]) < (ids[row[k]], start[k]):
                            send[k] = False
                            covered.append(k)
                out: dict[str, list] = {name: [] for name in types}
                marks = np.array(covered, np.int64)
                mark_bucket = bucket[marks]
                order = np.flatnonzero(send)
                order = order[np.argsort(bucket[order], kind="stable")]
                for b in np.unique(np.concatenate([bucket[order], mark_bucket])).tolist():
                    mine = order[np.searchsorted(bucket[order], b) : np.searchsorted(bucket[order], b, "right")]
                    done = marks[mark_bucket == b]
                    out["bucket"].append(b)
                    out["places"].append(squeeze.compress(_places(ids[row[mine]], hashes[row[mine]], start[mine], count[mine])))
                    out["packed"].append(squeeze.compress(b"\n".join([strings[k] for k in mine.tolist()])))
                    out["marks"].append(np.stack([ids[row[done]], hashes[row[done]], start[done], count[done] - width + 1]).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in types.items()], names=list(types))

    return run


def later_windows(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, words: np.ndarray, hashes: np.ndarray, width: int) -> np.ndarray:
    """For every window of the super-k-mers, in order: does an equal window start earlier?

    Windows are sorted by a 64-bit key; those with equal keys are compared word by word, and a group that holds
    more than one word sequence is sorted by the words themselves.
    """
    base = np.concatenate([[0], np.cumsum(counts)])[:-1]
    windows = counts - width + 1
    owner = np.repeat(np.arange(len(counts)), windows)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = base[owner] + inner
    keys = _window_keys(hashes[words], width)[place]
    order = np.argsort(keys, kind="stable")
    equal = np.zeros(len(keys) + 1, bool)
    equal[1:-1] = keys[order][1:] == keys[order][:-1]
    twice = order[equal[1:] | equal[:-1]]
    later = np.zeros(len(keys), bool)
    if not len(twice):
        return later
    start = starts[owner[twice]] + inner[twice]
    doc = ids[owner[twice]]
    fresh = np.ones(len(twice), bool)
    fresh[1:] = keys[twice][1:] != keys[twice][:-1]
    group = np.cumsum(fresh) - 1
    lead = twice[np.flatnonzero(fresh)][group]
    unlike = np.zeros(len(twice), bool)
    for shift in range(width):
        unlike |= words[place[twice] + shift] != words[place[lead] + shift]
    if unlike.any():  # equal keys of different windows
        mixed = np.isin(group, group[unlike])
        rows = np.stack([words[place[twice[mixed]] + s] for s in range(width)], axis=1)
        group = group.copy()
        group[mixed] = group.max() + 1 + np.unique(rows, axis=0, return_inverse=True)[1].ravel()
    by = np.lexsort((start, doc, group))
    fresh = np.ones(len(by), bool)
    fresh[1:] = group[by][1:] != group[by][:-1]
    lead = by[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    later[twice[by]] = (doc[by] > doc[lead]) | ((doc[by] == doc[lead]) & (start[by] > start[lead]))
    return later


def _runs(flags: np.ndarray, owner: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of runs of set flags inside one owner."""
    flags = np.concatenate([[False], flags, [False]])
    own = np.concatenate([[-1], owner, [-1]])
    follows = flags[1:] & flags[:-1] & (own[1:] == own[:-1])
    first = np.flatnonzero(flags[1:-1] & ~follows[:-1])
    last = np.flatnonzero(flags[1:-1] & ~follows[1:])
    return first, last - first + 1


def _sort_bucket(width: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor()
        marks = [np.frombuffer(x, np.int64).reshape(4, -1) for x in table.column("marks").to_pylist()]
        places = [_unplaced(expand.decompress(x)) for x in table.column("places").to_pylist()]
        ids, texts, starts, counts = (np.concatenate(x) for x in zip(*places))
        if len(ids):
            packed = pa.array([expand.decompress(x).decode() for x in table.column("packed").to_pylist()], pa.large_string())
            words, vocabulary, _ = words_of(packed)
            distinct = vocabulary.cast(pa.large_binary()).to_pylist()
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
            later = later_windows(ids, starts, counts, words, hashes, width)
            windows = counts - width + 1
            owner = np.repeat(np.arange(len(counts)), windows)
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            first, size = _runs(later, owner, inner)
            marks.append(np.stack([ids[owner[first]], texts[owner[first]], starts[owner[first]] + inner[first], size]))
        doc, text, start, size = np.concatenate(marks, axis=1)
        return pa.table({"doc_id": ids_back(doc), "text_hash": longs(text), "start": start.astype(np.int32), "windows": size.astype(np.int32)})

    return run


def repeated_windows(rows: DataFrame, width: int, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``MARKS`` of ``rows`` (doc_id, text_hash, text): runs of windows whose words also start earlier.

    Every map step sends each distinct super-k-mer once, whatever the number of its copies, so a passage that a
    third of all documents share gives one packed string per step. Equal windows have equal keys and meet
    in one bucket; the number of buckets follows the bytes of text. Windows of a minimiser that alone would fill a bucket
    (a frequent pair of words with a small hash) are dealt by longer grams, at last by the window itself.
    """
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-3 * total // bucket_bytes))
    large = large_keys(rows, width, total, bucket_bytes) if buckets > 1 else NONE_LARGE
    packed = rows.mapInArrow(_pack(width, buckets, large), "bucket long, places binary, packed binary, marks binary")
    return packed.groupBy("bucket").applyInArrow(_sort_bucket(width), MARKS)


def covered(starts: np.ndarray, windows: np.ndarray, width: int, size: int) -> np.ndarray:
    """Flags of the ``size`` units that runs of windows cover."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + windows - 1 + width, -1)
    return np.cumsum(change)[:size] > 0


def with_marks(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` with ``runs``, their marks as a list; a list isn't longer than its text."""
    of_row = marks.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    of_row = of_row.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    return rows.join(of_row, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left").drop("d", "h")


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_hash, text): a row is known by its id and a 32-bit hash of its text, so that repeated ids stay apart."""
    return docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.hash(F.coalesce(F.col(text), F.lit(""))).cast("bigint").alias("text_hash"),
        F.col(text).alias("text"),
    )


def run_columns(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(starts, windows) of every row of a ``runs`` column."""
    for runs in column:
        values = runs.values if runs.is_valid else None
        if values is None:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            yield tuple(values.field(i).to_numpy().astype(np.int64) for i in (0, 1))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 20, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_text)``: texts without the words of windows that start earlier elsewhere.

    A window is ``width`` words; earlier means a smaller doc_id, or the same document and an earlier start.
    Kept words are joined by one space. Texts travel twice: packed to the buckets and once to meet their marks.

    Null, empty or short text: no window. A null doc_id is the smallest id. Repeated rows (same id, same text) are
    one document and get the same result each; the same id with other texts: neither is earlier at equal starts.
    Empty table: no rows. Other columns of ``docs`` are ignored.
    """
    rows = keyed(docs, doc_id, text)
    marked = with_marks(rows, repeated_windows(rows, width, bucket_bytes))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, (starts, windows) in zip(batch.column("text"), run_columns(batch.column("runs"))):
                words = (text.as_py() or "").encode().split()
                n_words.append(len(words))
                if len(starts):
                    gone = covered(starts, windows, width, len(words))
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_text"],
            )

    schema = T.StructType.fromDDL("doc_id long, n_words long, n_removed long, kept_text string")
    return marked.select("doc_id", "text", "runs").mapInArrow(cut, schema)
