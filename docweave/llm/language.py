"""Language identification: known words first, then shorter and shorter character n-grams."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.common import SLICE_BYTES, slices, with_text_columns, words_of

UNKNOWN = "und"

LETTERS = regex.compile(r"[\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")

# Bounds of the model, whatever the corpus: languages, rows learned from per language (on average), entries.
MAX_LANGUAGES, ROWS_PER_LANGUAGE, MAX_ENTRIES = 500, 3_000, 250_000
MAX_GRAM = 4

# Words that count as evidence for the score; more words don't make it surer.
EVIDENCE = 20


def pieces(word: str) -> list[str]:
    """Lower-case runs of letters in a word."""
    return [p for p in LETTERS.findall(word.lower()) if LETTER.search(p)]


def grams(piece: str, size: int) -> Iterator[str]:
    marked = f"^{piece}$"
    return (marked[i : i + size] for i in range(len(marked) - size + 1))


@dataclass(frozen=True)
class Model:
    """Log frequencies: one row per known word or n-gram (keys ``word`` and ``n:gram``), one column per language."""

    languages: list[str]
    rows: dict[str, int]
    logs: np.ndarray

    def evidence(self, word: str) -> list[int]:
        """Rows that speak for a word: its own for every known piece, else the longest known n-gram at each place."""
        found = []
        for piece in pieces(word):
            if (known := self.rows.get(piece)) is not None:
                found.append(known)
                continue
            marked = f"^{piece}$"
            for i in range(len(marked) - 1):
                for size in range(min(MAX_GRAM, len(marked) - i), 0, -1):
                    if (row := self.rows.get(f"{size}:{marked[i : i + size]}")) is not None:
                        found.append(row)
                        break
        return found

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        words, vocabulary, first = words_of(texts)
        distinct = vocabulary.to_pylist()
        count = len(self.languages)
        best, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        lettered = np.fromiter((LETTER.search(w) is not None for w in distinct), bool, len(distinct))
        if not count or not len(words):
            return best, score
        lists = [self.evidence(w) for w in distinct]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((r for rows in lists for r in rows), np.int64, int(sizes.sum()))
        row_of = np.repeat(np.arange(len(texts)), np.diff(first))
        seen = np.bincount(row_of, lettered[words], len(texts))
        known = sizes > 0
        starts = (np.cumsum(sizes) - sizes)[known]
        total = np.zeros((count, len(texts)))
        for column in range(count):
            value = np.zeros(len(distinct))
            if len(flat):
                # The mean over the n-grams of a word, so that a long unseen word weighs as one word.
                value[known] = np.add.reduceat(self.logs[flat, column], starts) / sizes[known]
            total[column] = np.bincount(row_of, value[words], len(texts))
        words_known = np.maximum(np.bincount(row_of, known[words], len(texts)), 1)
        sharp = total * (np.minimum(words_known, EVIDENCE) / words_known)
        odds = np.exp(sharp - sharp.max(axis=0))
        odds /= odds.sum(axis=0)
        top = odds.argmax(axis=0)
        for row in np.flatnonzero(seen > 0).tolist():
            best[row] = self.languages[top[row]]
            score[row] = min(1.0, float(odds[top[row], row]))
        return best, score


def held_out(doc_id: str) -> Column:
    """Every fourth document by a hash of its id isn't learned from; a null id isn't held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for offset, length in slices(batch.column(1)):
            part = batch.slice(offset, length)
            counts: dict[tuple[str, int], Counter] = {}
            langs = part.column(0).to_pylist()
            for lang in set(langs):
                mine = part.column(1).filter(pa.array([x == lang for x in langs]))
                words, vocabulary, _ = words_of(mine)
                times = np.bincount(words, minlength=len(vocabulary)).tolist()
                for word, n in zip(vocabulary.to_pylist(), times):
                    for piece in pieces(word):
                        counts.setdefault((lang, 0), Counter())[piece] += n
                        for size in range(1, MAX_GRAM + 1):
                            counts.setdefault((lang, size), Counter()).update(dict.fromkeys(grams(piece, size), n))
            for (lang, size), counter in counts.items():
                keys = [k if size == 0 else f"{size}:{k}" for k in counter]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array([size] * len(keys), pa.int32()), pa.array(keys), pa.array(list(counter.values()), pa.int64())],
                    names=["lang", "size", "key", "n"],
                )


def learn(
    labelled: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    max_languages: int = MAX_LANGUAGES,
    max_entries: int = MAX_ENTRIES,
) -> Model:
    """A model of the labelled rows (null texts and labels are left out).

    Learns from a sample bounded by ``rows_per_language``, drawn by a hash of the id, so the same rows are drawn in
    every run. Words and n-grams are counted by Spark; of each language and length the most frequent ones are kept,
    and only these (``max_entries`` at most) reach the driver.
    """
    rows = labelled.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()
    languages = sorted(r["lang"] for r in sizes)
    if not languages:
        return Model([], {}, np.zeros((0, 0), np.float32))
    grain = 1 << 30
    share = {r["lang"]: min(grain, rows_per_language * grain // r["n"]) for r in sizes}
    shares = F.create_map(*(F.lit(x) for pair in share.items() for x in pair))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(grain)) < F.coalesce(F.try_element_at(shares, F.col("lang")), F.lit(0))
    counts = rows.filter(drawn).select("lang", "text").mapInArrow(_count, "lang string, size int, key string, n long")
    counts = counts.groupBy("lang", "size", "key").agg(F.sum("n").alias("n"))
    total = Window.partitionBy("lang", "size")
    room = max(1, max_entries // (len(languages) * (MAX_GRAM + 1)))
    kept = (
        counts.select("*", F.sum("n").over(total).alias("total"), F.row_number().over(total.orderBy(F.desc("n"), "key")).alias("place"))
        .filter((F.col("place") <= room) & ((F.col("size") > 0) | (F.col("n") > 1)))
        .select("lang", "size", "key", "n", "total")
        .toArrow()
    )
    column = {name: k for k, name in enumerate(languages)}
    keys = kept.column("key").to_pylist()
    numbers = {key: k for k, key in enumerate(sorted(set(keys)))}
    row = np.array([numbers[k] for k in keys], np.int64)
    lang_of = np.array([column[x] for x in kept.column("lang").to_pylist()], np.int64)
    size_of, n = kept.column("size").to_numpy(), kept.column("n").to_numpy()
    totals = np.ones((MAX_GRAM + 1, len(languages)))
    totals[size_of, lang_of] = kept.column("total").to_numpy()
    length = np.zeros(len(numbers), np.int64)
    length[row] = size_of
    seen = np.zeros((len(numbers), len(languages)))
    seen[row, lang_of] = n
    kinds = np.maximum(np.bincount(length, minlength=MAX_GRAM + 1), 1)
    logs = np.log((seen + 0.5) / (totals[length] + 0.5 * kinds[length, None]))
    return Model(languages, numbers, logs.astype(np.float32))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the text alone.

    One pass without a shuffle; the model is broadcast, and ``learn`` bounds its size. Null text, or one without a
    letter: ``und`` and 0, as is everything if the model has no language. Equal scores: the first language in
    alphabetical order. Repeated rows: one result each. Empty table: no rows. Columns with these names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    limit = max(64 << 10, SLICE_BYTES * 8 // max(8, len(model.languages)))

    def make() -> Callable:
        known = shared.value

        def compute(texts: pa.Array) -> list[pa.Array]:
            names, scores = [], []
            for offset, length in slices(texts, limit):
                best, score = known.predict(texts.slice(offset, length))
                names += best
                scores.append(score)
            return [pa.array(names, pa.string()), pa.array(np.concatenate([*scores, np.zeros(0)]), pa.float64())]

        return compute

    return with_text_columns(docs, text, {"lang_pred": T.StringType(), "score": T.DoubleType()}, make)
