"""Suffix-array dedup over bytes: longest previous and next factors of the passages that can repeat."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.common import ids_back, ids_of, longs, mix, slices, sliding_min
from docweave.llm.word_repeats import MARKS, covered, keyed, run_columns, with_marks
from docweave.session import cut_lineage

# Bytes of the hashed grams whose least hash names a passage's bucket.
GRAM = 128

# Bytes of passages that one suffix array should hold.
BUCKET_BYTES = 4 << 20

# Bytes of a bucket's passages that are sorted at a time; equal strings are in passages of one gram, which stay together.
SORT_BYTES = 1 << 20

# Different passages around one gram up to which a suffix array compares them; beyond, their windows are grouped by hash.
HOT_PASSAGES = 4_000

_PRIME = np.uint64(0x9E3779B185EBCA87)
_TABLE = mix(np.arange(1, 257, dtype=np.uint64))


class _Hasher:
    """Polynomial hashes of all grams of a byte array; the powers are kept for the next array."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def grams(self, raw: np.ndarray, size: int) -> np.ndarray:
        if len(raw) > len(self.up):
            inverse = np.uint64(pow(int(_PRIME), -1, 1 << 64))
            self.up, self.down = (np.full(len(raw), p, np.uint64) for p in (_PRIME, inverse))
            self.up[:1] = self.down[:1] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_TABLE[raw] * self.up[: len(raw)])])
        return mix((sums[size:] - sums[:-size]) * self.down[: len(raw) - size + 1])


def passages(hasher: _Hasher, texts: list[bytes], width: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, start, windows, minimiser, two halves of a 128-bit content hash, inner) of the runs of windows with one
    minimiser; ``inner``: the minimiser stands at several places of the run, so that windows of it may be equal."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = b"".join(texts)
    raw = np.frombuffer(joined, np.uint8)
    if len(raw) < width:
        return (*(np.zeros(0, np.int64) for _ in range(6)), np.zeros(0, bool))
    grams = hasher.grams(raw, gram)
    low = sliding_min(grams, width - gram + 1)
    ends = np.cumsum(sizes)
    row_of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    inside = row_of[: len(low)] == row_of[width - 1 :]
    begins = inside.copy()
    begins[1:] &= ~(inside[:-1] & (low[1:] == low[:-1]))
    begin = np.flatnonzero(begins)
    row = row_of[begin].astype(np.int64)
    stop = np.append(begin[1:], len(low))
    stop = np.minimum(stop, ends[row] - width + 1)
    digest = b"".join(xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(begin.tolist(), (stop + width - 1).tolist()))
    content = np.frombuffer(digest, np.int64).reshape(-1, 2)
    inner = (stop - begin > 1) & (_occurrences(grams, low, begin, stop + (width - gram)) > 1)
    return row, begin - (ends - sizes)[row], stop - begin, low[begin].view(np.int64), content[:, 0], content[:, 1], inner


def _occurrences(grams: np.ndarray, low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How often the minimiser ``low[begin]`` stands in ``grams[begin:end]``, for every run of windows."""
    # A gram is the least of some window around it exactly if it equals the greatest minimum of these windows.
    pad = np.zeros(len(grams) - len(low), np.uint64)
    at = np.flatnonzero(~sliding_min(~np.concatenate([pad, low, pad]), len(pad) + 1) == grams)
    values, rank = np.unique(grams[at], return_inverse=True)
    keys = np.sort(rank * (len(grams) + 1) + at)
    mine = np.searchsorted(values, low[begin]) * (len(grams) + 1)
    return np.searchsorted(keys, mine + end) - np.searchsorted(keys, mine + begin)


def _texts(column: pa.Array) -> list[bytes]:
    return [(t or "").encode() for t in column.to_pylist()]


def _list_passages(width: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _Hasher()
        for batch in batches:
            for offset, length in slices(batch.column(2)):
                part = batch.slice(offset, length)
                row, start, windows, low, c1, c2, inner = passages(hasher, _texts(part.column(2)), width, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        longs(low),
                        longs(c1),
                        longs(c2),
                        ids_back(ids_of(part.column(0))[row]),
                        longs(part.column(1).to_numpy()[row]),
                        pa.array(start.astype(np.int32)),
                        pa.array(windows.astype(np.int32)),
                        pa.array(inner),
                    ],
                    names=["gram", "c1", "c2", "doc_id", "text_hash", "start", "windows", "inner"],
                )

    return run


def _ranks(values: np.ndarray) -> np.ndarray:
    """Ranks of ``values`` from 1 on, equal ones alike; ``values`` are overwritten. Arrays are few and narrow, since a
    worker's memory is a small part of its executor's."""
    order = np.argsort(values)
    values[:] = values[order]
    opens = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=opens[1:])
    ranks = np.empty(len(values), np.int32)
    ranks[order] = np.cumsum(opens, dtype=np.int32)
    return ranks


def suffix_order(raw: np.ndarray, starts: np.ndarray, room: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``raw`` at ``starts`` in the order of their first ``depth`` bytes, ties by position, and whether
    each has its first ``depth`` bytes in common with the one before it.

    ``room``: bytes from every position to the end of its passage. Prefix doubling: ranks of 2h bytes come from two
    ranks of h bytes. After each doubling only starts whose first bytes occur elsewhere, and the positions that they
    still need, go on; a suffix that differs from all others is in its place.
    """
    size = len(raw)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    head = np.zeros(size, np.uint64)
    for shift in range(8):
        head <<= np.uint64(8)
        head |= padded[shift : shift + size]
    # Ranks of the first h bytes; 0 where fewer are left.
    ranks = np.zeros(size, np.int32)
    alive = room >= 8
    head = head[alive]
    ranks[alive] = _ranks(head)
    del head
    reach = 8
    while reach < depth:
        step = min(reach, depth - reach)
        # A start that is alone on its first bytes stays alone.
        seen = np.bincount(ranks)
        starts = starts[seen[ranks[starts]] > 1]
        del seen
        # Only positions that some remaining start reaches are ranked further.
        need = np.zeros(size + 1, np.int32)
        np.add.at(need, starts, 1)
        np.add.at(need, np.minimum(starts + depth - reach - step + 1, size), -1)
        alive = np.flatnonzero((np.cumsum(need, dtype=np.int32)[:size] > 0) & (room >= reach + step)).astype(np.int32)
        del need
        pair = ranks[alive].astype(np.int64)
        pair <<= 32
        pair |= ranks[alive + np.int32(step)]
        ranks = np.zeros(size, np.int32)
        ranks[alive] = _ranks(pair)
        del pair, alive
        reach += step
    order = starts[np.argsort(ranks[starts], kind="stable")]
    tied = np.zeros(len(order), bool)
    tied[1:] = ranks[order][1:] == ranks[order][:-1]
    return order, tied


def long_factors(raw: np.ndarray, starts: np.ndarray, room: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Flags of ``starts``: does a factor of ``depth`` bytes have a previous, a next occurrence?

    The longest previous factor of a suffix is its common prefix with the previous or the next smaller position in
    suffix order; the longest next factor is that with the larger ones. Only common prefixes of ``depth`` bytes are asked
    for, and suffixes that have them form a run of ties in which positions ascend. So inside a run the previous smaller
    position is the left neighbour and the next larger one is the right neighbour, and the two others lie outside the
    run, where the common prefix is shorter.
    """
    order, tied = suffix_order(raw, starts, room, depth)
    earlier, later = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    earlier[order] = tied
    later[order] = np.append(tied[1:], False)[: len(order)]
    return earlier[starts], later[starts]


def _send_passages(width: int, buckets: int) -> Callable:
    """Rows of documents with ``wanted`` passages -> packed passages per bucket."""
    names = ("bucket", "grams", "ids", "texts", "starts", "sizes", "packed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for offset, length in slices(batch.column(2)):
                part = batch.slice(offset, length)
                ids, hashes, raw = ids_of(part.column(0)), part.column(1).to_numpy(), _texts(part.column(2))
                row, gram, start, size = [], [], [], []
                for k, wanted in enumerate(part.column(3)):
                    values = wanted.values
                    row.append(np.full(len(values), k))
                    gram.append(np.asarray(values.field(0)))
                    start.append(np.asarray(values.field(1)).astype(np.int64))
                    size.append(np.asarray(values.field(2)).astype(np.int64) + width - 1)
                row, gram, start, size = (np.concatenate(x) for x in (row, gram, start, size))
                bucket = gram.view(np.uint64) % np.uint64(buckets)
                out: dict[str, list] = {n: [] for n in names}
                order = np.argsort(bucket, kind="stable")
                for mine in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
                    out["bucket"].append(int(bucket[mine[0]]))
                    out["grams"].append(gram[mine].tobytes())
                    out["ids"].append(ids[row[mine]].tobytes())
                    out["texts"].append(hashes[row[mine]].tobytes())
                    out["starts"].append(start[mine].tobytes())
                    out["sizes"].append(size[mine].tobytes())
                    joined = b"".join(raw[r][a : a + n] for r, a, n in zip(row[mine].tolist(), start[mine].tolist(), size[mine].tolist()))
                    out["packed"].append(squeeze.compress(joined))
                types = [pa.int64(), *[pa.binary()] * 6]
                yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(names, types)], names=list(names))

    return run


def _sort_passages(width: int, keep_first: bool, sort_bytes: int) -> Callable[[pa.Table], pa.Table]:
    def sort(raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """(passage, place in it, windows) of the runs of repeated windows of some passages, one behind the other in ``raw``."""
        base = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        inner = np.arange(len(raw), dtype=np.int32)
        inner -= base.astype(np.int32)[owner]
        room = sizes.astype(np.int32)[owner]
        room -= inner
        windows = np.flatnonzero(room >= width).astype(np.int32)
        owner, inner = owner[windows], inner[windows]
        earlier, later = long_factors(raw, windows, room, width)
        flags = earlier if keep_first else earlier | later
        same = owner[1:] == owner[:-1]
        follows = np.zeros(len(flags) + 1, bool)
        follows[1:-1] = flags[1:] & flags[:-1] & same
        first = np.flatnonzero(flags & ~follows[:-1])
        count = np.flatnonzero(flags & ~follows[1:]) - first + 1
        return owner[first], inner[first], count

    def run(table: pa.Table) -> pa.Table:
        column = lambda name: np.concatenate([np.frombuffer(x, np.int64) for x in table.column(name).to_pylist()])
        expand = zstandard.ZstdDecompressor()
        raw = np.frombuffer(b"".join(expand.decompress(x) for x in table.column("packed").to_pylist()), np.uint8)
        grams, ids, texts, starts, sizes = (column(n) for n in ("grams", "ids", "texts", "starts", "sizes"))
        # Passages once each (repeated rows send theirs again), by gram and in the order of the corpus: inside a gram, a
        # smaller position is earlier.
        place = np.cumsum(sizes) - sizes
        order = np.lexsort((texts, starts, ids, grams))
        once = np.ones(len(order), bool)
        once[1:] = (ids[order][1:] != ids[order][:-1]) | (starts[order][1:] != starts[order][:-1]) | (texts[order][1:] != texts[order][:-1])
        order = order[once]
        grams, ids, texts, starts, sizes, place = (x[order] for x in (grams, ids, texts, starts, sizes, place))
        # Whole grams are sorted together, up to ``sort_bytes``; a gram with more is sorted alone.
        heads = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
        total = np.append(0, np.cumsum(sizes))
        ends = np.append(heads[1:], len(grams))
        found: list[tuple[np.ndarray, ...]] = []
        low = 0
        while low < len(grams):
            fits = ends[(ends > low) & (total[ends] <= total[low] + sort_bytes)]
            high = int(fits[-1]) if len(fits) else int(ends[ends > low][0])
            part = np.concatenate([raw[a : a + n] for a, n in zip(place[low:high].tolist(), sizes[low:high].tolist())])
            owner, inner, count = sort(part, sizes[low:high])
            found.append((owner + low, inner, count))
            low = high
        owner, inner, count = (np.concatenate(x) for x in zip(*found))
        return pa.table(
            {
                "doc_id": ids_back(ids[owner]),
                "text_hash": longs(texts[owner]),
                "start": (starts[owner] + inner).astype(np.int32),
                "windows": count.astype(np.int32),
            }
        )

    return run


def _hash_windows(width: int) -> Callable:
    """Rows of documents with ``wanted`` passages -> a 128-bit hash of each of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offset in range(batch.num_rows):
                part = batch.slice(offset, 1)
                raw = _texts(part.column(2))[0]
                values = part.column(3)[0].values
                at = np.concatenate([np.arange(a, a + n) for a, n in zip(values.field(1).to_pylist(), values.field(2).to_pylist())])
                for low in range(0, len(at), 1 << 16):
                    block = at[low : low + (1 << 16)]
                    digest = b"".join(xxhash.xxh3_128_digest(raw[a : a + width]) for a in block.tolist())
                    content = np.frombuffer(digest, np.int64).reshape(-1, 2)
                    one = lambda i: part.column(i).take(pa.array(np.zeros(len(block), np.int64)))  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays(
                        [longs(content[:, 0]), longs(content[:, 1]), one(0), one(1), pa.array(block.astype(np.int32))],
                        names=["c1", "c2", "doc_id", "text_hash", "start"],
                    )

    return run


def repeated_windows(
    rows: DataFrame,
    width: int,
    keep_first: bool,
    gram: int = GRAM,
    bucket_bytes: int = BUCKET_BYTES,
    hot_passages: int = HOT_PASSAGES,
    sort_bytes: int = SORT_BYTES,
) -> DataFrame:
    """``MARKS`` of ``rows`` (doc_id, text_hash, text): runs of windows of ``width`` bytes that also start elsewhere
    (``keep_first``: earlier).

    1. A passage is a run of windows that share the least hash of their grams. Equal windows have equal least grams,
       so a passage whose gram occurs once, in other passages and in itself, holds no repeat. A gram that stands at
       several places of one passage (text with a short period) makes it ``inner``. Only small rows are shuffled for this.
    2. Passages with equal content are one class. Other copies of a class are settled at once; its first stands for it.
    3. First passages of grams with several classes, or with an inner one, are cut from the texts, packed and sorted in
       suffix arrays, some grams of a bucket at a time.
    A gram with more than ``hot_passages`` classes, or whose classes hold more than ``bucket_bytes``, would fill one
    array; its windows are grouped by a 128-bit hash instead, which Spark combines and spreads.
    """
    fields = "gram long, c1 long, c2 long, doc_id long, text_hash long, start int, windows int, inner boolean"
    # A repeated row gives the same passages again; they are one.
    listed = cut_lineage(rows.mapInArrow(_list_passages(width, gram), fields))
    several = listed.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.max("inner").alias("inner"))
    several = several.filter("n > 1 or inner").select("gram")
    known = cut_lineage(listed.join(several, "gram", "left_semi").distinct())
    at = F.struct("doc_id", "start", "text_hash", "windows")
    classes = known.groupBy("gram", "c1", "c2").agg(
        F.count(F.lit(1)).alias("copies"), F.min(at).alias("lead"), F.max("inner").alias("inner")
    )
    of_gram = classes.groupBy("gram").agg(
        F.count(F.lit(1)).alias("classes"),
        F.sum(F.col("lead.windows") + F.lit(width - 1).cast("bigint")).alias("bytes"),
        F.max("inner").alias("any_inner"),
    )
    classes = cut_lineage(classes.join(of_gram, "gram"))

    copies = known.join(classes.filter("copies > 1").select("gram", "c1", "c2", "lead"), ["gram", "c1", "c2"])
    if keep_first:
        place = lambda x: F.struct(F.col(f"{x}doc_id"), F.col(f"{x}start"))
        copies = copies.filter(place("") > place("lead."))
    marks = copies.select("doc_id", "text_hash", "start", "windows")

    hot = (F.col("classes") > hot_passages) | (F.col("bytes") > bucket_bytes)
    wanted = classes.filter("classes > 1 or any_inner").select("gram", hot.alias("hot"), "lead.*")
    packed_bytes = wanted.agg(F.sum(F.col("windows") + (width - 1)).alias("n"), F.max("hot").alias("hot")).first()
    buckets = max(1, -(-(packed_bytes["n"] or 0) // bucket_bytes))

    def cut(passages: DataFrame) -> DataFrame:
        of_row = passages.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("gram", "start", "windows")).alias("wanted"))
        of_row = of_row.withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
        same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
        return rows.join(of_row, same).drop("d", "h")

    sent = cut(wanted.filter("not hot")).mapInArrow(
        _send_passages(width, buckets), "bucket long, grams binary, ids binary, texts binary, starts binary, sizes binary, packed binary"
    )
    marks = marks.unionByName(sent.groupBy("bucket").applyInArrow(_sort_passages(width, keep_first, sort_bytes), MARKS))
    if packed_bytes["hot"]:
        listed_windows = cut(wanted.filter("hot")).mapInArrow(_hash_windows(width), "c1 long, c2 long, doc_id long, text_hash long, start int")
        windows = cut_lineage(listed_windows.distinct())
        groups = windows.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "start")).alias("lead"))
        again = windows.join(groups.filter("n > 1"), ["c1", "c2"])
        if keep_first:
            again = again.filter(F.struct("doc_id", "start") > F.col("lead"))
        marks = marks.unionByName(again.select("doc_id", "text_hash", "start", F.lit(1).alias("windows")))
    return marks


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 400, keep_first: bool = True, **sizes: int
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``: UTF-8 bytes without those of repeated ``width``-byte strings.

    ``keep_first`` leaves the first occurrence (least doc_id, then start) in place; otherwise every occurrence goes.
    ``kept`` is binary, since a cut may fall inside a character. Strings are judged on the input and may overlap.

    Null, empty or short text: nothing to remove. A null doc_id is the smallest id. Repeated rows (same id, same text)
    are one document and get the same result each; the same id with other texts are different documents, of which
    neither is earlier at equal starts. Empty table: no rows. Other columns of ``docs`` are ignored.
    """
    rows = keyed(docs, doc_id, text)
    marked = with_marks(rows, repeated_windows(rows, width, keep_first, **sizes))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, spans, kept = [], [], [], []
            for text, (starts, windows) in zip(_texts(batch.column("text")), run_columns(batch.column("runs"))):
                totals.append(len(text))
                if not len(starts):
                    removed.append(0)
                    spans.append(0)
                    kept.append(text)
                    continue
                gone = covered(starts, windows, width, len(text))
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            numbers = [pa.array(x, pa.int64()) for x in (totals, removed, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *numbers, pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = T.StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return marked.select("doc_id", "text", "runs").mapInArrow(cut, schema)
