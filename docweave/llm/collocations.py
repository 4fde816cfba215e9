"""Phrase collocations: counts of the longest windows, summed by ROLLUP to those of all shorter phrases."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.common import mix, stored

# Words of the longest phrase.
ORDER = 5

# Occurrences from which a phrase is a candidate.
LEAST = 100

# What ends a piece, and the language of texts without one. Fixed values.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
NO_LANGUAGE = "und"

# Bits of the table of frequent pairs that travels to every task: 16 MiB, whatever the size of the corpus.
TABLE_BITS = 27

# Blocks that pair counts are dealt in; one block of one task's counts is one row.
BLOCKS_PER_TASK = 64

# Bytes of text that one step of a task works on.
PART_BYTES = 2 << 20

# Pairs whose counts a task gathers before it hands them over.
PAIR_STEP = 1 << 21

_KIND = np.zeros(256, np.uint8)  # 0: part of a word, 1: blank, 2: ends a piece
_KIND[list(b" \t")] = 1
_KIND[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def parts_of(texts: pa.Array, langs: pa.Array, limit: int = PART_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, list[str], np.ndarray]]:
    """(bytes, first byte of each text, languages, language number of each text), ``limit`` bytes of text or little more at
    a time. A longer text is cut where a piece ends, so no phrase is torn."""
    names = pc.fill_null(langs, NO_LANGUAGE).dictionary_encode()
    numbers = names.indices.to_numpy(zero_copy_only=False)
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    held: list[bytes] = []
    owners: list[int] = []
    room = limit

    def flush() -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        begin = np.concatenate([[0], np.cumsum([len(x) for x in held])])[:-1].astype(np.int64)
        return np.frombuffer(b"".join(held), np.uint8), begin, names.dictionary.to_pylist(), np.array(owners)

    for number, value in zip(numbers.tolist(), texts):
        whole = memoryview(value.as_buffer())
        start = 0
        while start < len(whole):
            end = len(whole)
            if end - start > room:
                ends = np.flatnonzero(_KIND[np.frombuffer(whole[start:], np.uint8)] == 2) if end - start > limit else np.zeros(0, np.int64)
                if len(ends):
                    end = start + int(ends[min(np.searchsorted(ends, room), len(ends) - 1)]) + 1
            held.append(bytes(whole[start:end]))
            owners.append(number)
            room -= end - start
            start = end
            if room <= 0:
                yield flush()
                held, owners, room = [], [], limit
    if held:
        yield flush()


class Words:
    """The words of some texts in order: ``number`` into ``vocabulary``, ``lang``, and ``next``, which is true where the word
    behind stands in the same piece."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, langs: np.ndarray) -> None:
        kind = _KIND[data]
        inside = kind == 0
        first = np.zeros(len(data) + 1, bool)
        first[begin] = True  # a text never goes on in the next one
        first = first[: len(data)]
        start = inside & (first | ~np.concatenate([[False], inside[:-1]]))
        starts = np.flatnonzero(start)
        self.count = len(starts)
        # Word bytes side by side; where each word begins among them.
        kept = np.flatnonzero(inside)
        offsets = np.append(np.searchsorted(kept, starts), len(kept)).astype(np.int64)
        joined = pa.py_buffer(_LOWER[data[kept]])
        words = pa.Array.from_buffers(pa.large_string(), self.count, [None, pa.py_buffer(offsets), joined])
        encoded = words.dictionary_encode()
        self.number = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocabulary = encoded.dictionary
        # Pieces are numbered by what ends them, texts included.
        piece = np.cumsum((kind == 2).astype(np.int32) + first)[starts]
        self.next = np.append(piece[1:] == piece[:-1], False) if self.count else np.zeros(0, bool)
        self.lang = langs[np.searchsorted(begin, starts, side="right") - 1] if self.count else np.zeros(0, np.int64)

    def pair_hashes(self, names: list[str]) -> np.ndarray:
        """A 64-bit hash of language and words for every word and the one behind it; meaningless where ``next`` is false."""
        words = np.array([xxhash.xxh64_intdigest(w) for w in self.vocabulary.to_pylist()], np.uint64)
        langs = np.array([xxhash.xxh64_intdigest(n, 1) for n in names], np.uint64)
        left = words[self.number] ^ langs[self.lang]
        right = np.append(words[self.number[1:]], np.uint64(0))
        return mix(mix(left) + right)


def _hash_counts(hashes: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and their counts, up to 255."""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    edge = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
    if counts is None:
        total = np.diff(np.append(edge, len(hashes)))
    else:
        total = np.add.reduceat(counts[order].astype(np.int64), edge) if len(edge) else np.zeros(0, np.int64)
    return hashes[edge], np.minimum(total, 255).astype(np.uint8)


def frequent_pairs(rows: DataFrame, least: int, table_bits: int = TABLE_BITS, blocks: int | None = None) -> bytes:
    """A bit table of hashes: the bit of every pair of neighbouring words with ``least`` occurrences or more is set.

    Other bits may be set too, so a pair without its bit is surely rarer. Tasks count the hashes of their pairs and
    send them packed, a block of the hash range per row; counts above 255 aren't told apart, and ``least`` must not be
    above 255. What comes to the driver is the table, ``2 ** table_bits`` bits, however many pairs there are.
    """
    spark = rows.sparkSession
    blocks = blocks or BLOCKS_PER_TASK * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)
    # A block is a range of table places, so that its bits are a slice of the table.
    blocks = 1 << max(0, min(table_bits - 13, blocks.bit_length() - 1))
    low_bits = table_bits - (blocks.bit_length() - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            hashes, counts = _hash_counts(np.concatenate(gathered), None)
            cut = np.searchsorted(hashes >> np.uint64(64 - (blocks.bit_length() - 1)), np.arange(blocks + 1)) if blocks > 1 else np.array([0, len(hashes)])
            used = np.flatnonzero(np.diff(cut))
            spans = [(int(cut[b]), int(cut[b + 1])) for b in used]
            return pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), pa.array([hashes[a:z].tobytes() for a, z in spans], pa.binary()), pa.array([counts[a:z].tobytes() for a, z in spans], pa.binary())],
                names=["block", "hashes", "counts"],
            )

        for batch in batches:
            for data, begin, names, langs in parts_of(batch.column(1), batch.column(0)):
                words = Words(data, begin, langs)
                gathered.append(words.pair_hashes(names)[words.next])
                if sum(map(len, gathered)) >= PAIR_STEP:
                    yield packed()
                    gathered = []
        if gathered:
            yield packed()

    def merge(table: pa.Table) -> pa.Table:
        whole = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
        hashes, counts = _hash_counts(whole("hashes", np.uint64), whole("counts", np.uint8))
        place = (hashes[counts >= least] >> np.uint64(64 - table_bits)) & np.uint64((1 << low_bits) - 1)
        bits = np.zeros(1 << low_bits, np.uint8)
        bits[place.astype(np.int64)] = 1
        return pa.table({"block": table["block"][:1], "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    counted = rows.mapInArrow(count, "block int, hashes binary, counts binary")
    merged = counted.groupBy("block").applyInArrow(merge, "block int, bits binary")
    table = bytearray(1 << max(0, table_bits - 3))
    step = 1 << (low_bits - 3)
    for row in merged.toLocalIterator():
        table[row.block * step : (row.block + 1) * step] = row.bits
    return bytes(table)


def longest_windows(rows: DataFrame, table: bytes, table_bits: int = TABLE_BITS, order: int = ORDER) -> DataFrame:
    """``(lang, w1 .. w<order>, n)``: how often a window starts at a word; columns behind its end are ''.

    A window goes on while the next word stands in the same piece and ``table`` doesn't rule the pair out: a phrase
    that holds a rare pair is as rare, so its count isn't asked for. One window per word, whatever the order.
    """
    columns = [f"w{i + 1}" for i in range(order)]
    schema = "lang string, " + "".join(f"{c} string, " for c in columns) + "n long"
    sent = rows.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(sent.value, np.uint8)
        for batch in batches:
            for data, begin, names, langs in parts_of(batch.column(1), batch.column(0)):
                words = Words(data, begin, langs)
                if not words.count:
                    continue
                place = (words.pair_hashes(names) >> np.uint64(64 - table_bits)).astype(np.int64)
                goes_on = words.next & ((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).astype(bool)
                # Windows of this part become numbers, one more word at a time, and are counted.
                pad = len(words.vocabulary)
                number = np.append(words.number, np.full(order, pad))
                on = np.append(goes_on, np.zeros(order, bool))
                key = words.lang * (pad + 1) + words.number
                alive = np.ones(words.count, bool)
                for k in range(1, order):
                    alive = alive & on[k - 1 : k - 1 + words.count]
                    if not alive.any():
                        break
                    # Only windows that go on need a new number; they keep distinct from all others.
                    longer = np.unique(key[alive] * (pad + 1) + number[k : k + words.count][alive], return_inverse=True)[1]
                    short = np.unique(key[~alive], return_inverse=True)[1]
                    key = key.copy()
                    key[~alive] = short
                    key[alive] = longer + (int(short.max()) + 1 if len(short) else 0)
                _, at, n = np.unique(key, return_index=True, return_counts=True)
                length = np.ones(len(at), np.int64)
                running = np.ones(len(at), bool)
                vocabulary = pa.concat_arrays([words.vocabulary, pa.array([""], pa.large_string())])
                out = [pa.array(names).take(pa.array(words.lang[at]))]
                for k in range(order):
                    if k:
                        running = running & on[at + k - 1]
                        length += running
                    out.append(vocabulary.take(pa.array(np.where(running, number[at + k], pad))).cast(pa.string()))
                made = pa.RecordBatch.from_arrays([*out, pa.array(n)], names=["lang", *columns, "n"])
                for offset in range(0, made.num_rows, 10_000):
                    yield made.slice(offset, 10_000)

    return rows.mapInArrow(run, schema).groupBy("lang", *columns).agg(F.sum("n").alias("n"))


def phrase_counts(windows: DataFrame, least: int, order: int = ORDER) -> DataFrame:
    """``(lang, size, phrase, n)`` of all phrases of up to ``order`` words with ``least`` occurrences or more, and of all words
    of a language together (size 0, phrase null): every phrase is the beginning of the windows that start where it
    does, so ROLLUP over the columns of a window sums to all of them."""
    columns = [f"w{i + 1}" for i in range(order)]
    size = F.lit(order) - F.bit_count(F.grouping_id().cast("long"))
    summed = windows.rollup("lang", *columns).agg(F.sum("n").alias("n"), size.alias("size"))
    last = F.get(F.array(*columns), (F.col("size") - 1).cast("int"))
    # The grand total of all languages has a size of -1.
    wanted = (F.col("size") == 0) | ((F.col("size") > 0) & (last != "") & (F.col("n") >= least))
    return summed.filter(wanted).select("lang", "size", F.when(F.col("size") > 0, F.concat_ws(" ", *columns)).alias("phrase"), "n")


def _exact(value: Column, digits: int = 18) -> Column:
    return value.cast(T.DecimalType(digits, 0))


def scored_phrases(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, phrase, a, l, r, n, score)`` of the phrases of two words or more that no longer phrase makes needless.

    The lowest score of all cuts counts, of equal ones that of the first cut. Products are decimals of 38 digits:
    counts up to 10^18 are exact. A phrase goes if a longer one holds it and occurs as often.
    """
    known = counts.filter("size > 0").select("lang", "phrase", "n", "size")
    words = F.split("phrase", " ")
    candidates = known.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), words.alias("w"))
    joined = lambda start, length: F.concat_ws(" ", F.slice("w", start, length))
    spans = F.expr("flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), s -> struct(s, k))))")
    inner = (
        candidates.filter("size > 2")
        .select("lang", "a", "w", F.explode(spans).alias("x"))
        .select("lang", joined(F.col("x.s"), F.col("x.k")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("within"))
    )
    left = candidates.join(inner, ["lang", "phrase"], "left").filter("within IS NULL OR within < a").drop("within")
    cuts = left.select("lang", "phrase", "a", "size", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    side = lambda name, count: known.select("lang", F.col("phrase").alias(name), F.col("n").alias(count))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"])
    totals = counts.filter("size = 0").select("lang", F.col("n").alias("total"))
    cuts = cuts.join(totals, "lang").select("lang", "phrase", "a", "k", "l", "r", F.col("total").alias("n"))
    over = cuts.withColumns({"_p": _exact(_exact(F.col("a")) * 1000, 19) * _exact(F.col("n")), "_q": _exact(F.col("l")) * _exact(F.col("r"))})
    cut = over.withColumn("score", F.expr("_p div _q"))
    best = cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")


def top_phrases(scored: DataFrame, top: int, shards: int = 32) -> DataFrame:
    """The first ``top`` phrases of every language with their ``rank``: by score, count, phrase. A language is dealt in
    ``shards``, each of which passes on ``top`` at most, so the last step holds a bounded list per language."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    dealt = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shards))).orderBy(*order)
    few = scored.withColumn("_at", F.row_number().over(dealt)).filter(F.col("_at") <= top)
    entry = F.struct((-F.col("score")).alias("score"), (-F.col("a")).alias("a"), "phrase", "l", "r", "n")
    best = few.groupBy("lang").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, top).alias("x"))
    ranked = best.select("lang", F.posexplode("x").alias("at", "e"))
    return ranked.select(
        "lang", (F.col("at") + 1).cast("long").alias("rank"), "e.phrase", (-F.col("e.a")).alias("a"), "e.l", "e.r", "e.n", (-F.col("e.score")).alias("score")
    )


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = 2000, order: int = ORDER, table_bits: int = TABLE_BITS
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` collocations of every language.

    Texts are read twice. The first pass finds where no frequent phrase can go on, the second counts one padded
    window per word; neither shuffles a text or an occurrence, only counts. Null text: empty. Null language: ``und``.
    Repeated rows count again. Equal scores and counts: by the bytes of the phrase. Very long texts are cut between
    pieces. Empty table, or no frequent phrase: no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    table = frequent_pairs(rows, least, table_bits)
    counts = stored(phrase_counts(longest_windows(rows, table, table_bits, order), least, order))
    return top_phrases(scored_phrases(counts, order), top)
