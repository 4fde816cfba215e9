"""Quality rules: adaptive bounds from mergeable quantile sketches per language and source."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.common import longs, with_text_columns, words_of
from docweave.session import cut_lineage

SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


@dataclass(frozen=True)
class Rule:
    """A metric in whole units; ``spread`` is the least distance of its quartiles that counts."""

    metric: str
    numerator: str
    denominator: str
    scale: int
    spread: int
    two_sided: bool = False


RULES = (
    Rule("word_length", "word_chars", "n_words", 100, 100, two_sided=True),
    Rule("symbol_share", "n_symbols", "word_chars", 10_000, 400),
    Rule("dup_line_share", "n_dup_lines", "n_lines", 10_000, 1_500),
    Rule("repeat_share", "n_repeat_words", "n_words", 10_000, 1_000),
)


def _repeated(words: np.ndarray) -> int:
    """Words inside three-word windows that occur twice or more; windows are compared as numbers of distinct pairs."""
    if len(words) < 4:
        return 0
    words = words.astype(np.int64)
    pairs = np.unique(words[:-1] << 32 | words[1:], return_inverse=True)[1].astype(np.int64)
    _, group, size = np.unique(pairs[:-1] << 32 | words[2:], return_inverse=True, return_counts=True)
    twice = size[group] > 1
    if not twice.any():
        return 0
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def _counter() -> Callable[[pa.Array], list[pa.Array]]:
    def count(texts: pa.Array) -> list[pa.Array]:
        words, vocabulary, first = words_of(texts)
        lengths = np.array([len(w) for w in vocabulary.to_pylist()], np.int64)
        chars = np.concatenate([[0], np.cumsum(lengths[words])]) if len(words) else np.zeros(1, np.int64)
        out = np.zeros((len(COUNTS), len(texts)), np.int64)
        out[0] = np.diff(first)
        out[1] = np.diff(chars[first])
        for row, text in enumerate(texts.to_pylist()):
            if not text:
                continue
            raw = text.encode()
            lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
            out[2, row] = len(raw) - len(raw.translate(None, SYMBOLS))
            out[3, row] = len(lines) - len(set(lines))
            out[4, row] = _repeated(words[first[row] : first[row + 1]])
            out[5, row] = len(lines)
        return [longs(x) for x in out]

    return count


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of ``COUNTS``; a null or empty text has zero of everything."""
    return with_text_columns(docs, text, dict.fromkeys(COUNTS, T.LongType()), _counter)


def metric(rule: Rule) -> Column:
    """Whole-number value of a rule; null where it has no base."""
    whole = F.col(rule.numerator) * rule.scale
    return F.when(F.col(rule.denominator) > 0, (whole - whole % F.col(rule.denominator)) / F.col(rule.denominator)).cast("bigint")


def bucket(value: Column, bits: int) -> Column:
    """Lower end of a value's sketch bucket: exact below ``2 ** (bits + 1)``, then ``2 ** bits`` buckets per power of two."""
    drop = F.greatest(F.length(F.bin(value)) - (bits + 1), F.lit(0))
    step = F.pow(F.lit(2.0), drop).cast("bigint")
    return value - value % step


def sketches(counted: DataFrame, groups: list[str], bits: int = 6) -> DataFrame:
    """Quantile sketches ``(groups, metric, bucket, n)``: one row per used bucket.

    Sketches merge by adding the rows of equal buckets, so Spark combines them on the map side
    and a coarser group is the sum of finer ones. The relative error is ``2 ** -bits``; the size of
    one sketch doesn't depend on the number of rows.
    """
    values = F.explode(F.array(*(F.struct(F.lit(r.metric).alias("metric"), metric(r).alias("value")) for r in RULES)))
    return (
        counted.select(*groups, values.alias("m"))
        .filter("m.value IS NOT NULL")
        .groupBy(*groups, "m.metric", bucket(F.col("m.value"), bits).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quartiles(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """``(groups, metric, n, q1, q3)`` of sketches; the window runs over the buckets of one sketch."""
    from pyspark.sql import Window

    keys = [*groups, "metric"]
    by = Window.partitionBy(*keys)
    running = by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sketch.select(*keys, "bucket", F.sum("n").over(running).alias("upto"), F.sum("n").over(by).alias("total"))
    at = lambda quarter: F.min(F.when(F.col("upto") * 4 >= F.col("total") * quarter, F.col("bucket")))
    return ranked.groupBy(*keys).agg(F.first("total").alias("n"), at(1).alias("q1"), at(3).alias("q3"))


def bounds(sketch: DataFrame, least_rows: int, fence: int) -> DataFrame:
    """``(lang, source, low_<metric>, high_<metric>)`` for every language and source.

    A sketch of fewer than ``least_rows`` rows is replaced by that of the language, and one of these by
    the sketch of everything. Bounds are the quartiles, moved outwards by ``fence`` times their distance.
    """
    merged = lambda keys: sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    own = quartiles(sketch, ["lang", "source"])
    lang = quartiles(merged(["lang"]), ["lang"]).select(F.col("lang").alias("l"), F.col("metric").alias("m"), F.struct("n", "q1", "q3").alias("by_lang"))
    everything = quartiles(merged([]), []).select(F.col("metric").alias("m"), F.struct("n", "q1", "q3").alias("by_all"))
    # One row per rule.
    joined = (
        own.join(lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("metric") == F.col("m")))
        .drop("l", "m")
        .join(F.broadcast(everything), F.col("metric") == F.col("m"))
    )
    enough = lambda x: F.when(F.col(f"{x}.n") >= least_rows, F.col(x))
    chosen = joined.select(
        "lang",
        "source",
        "metric",
        F.coalesce(F.when(F.col("n") >= least_rows, F.struct("n", "q1", "q3")), enough("by_lang"), F.col("by_all")).alias("q"),
    )
    columns = []
    for rule in RULES:
        reach = F.greatest(F.col("q.q3") - F.col("q.q1"), F.lit(rule.spread)) * fence
        mine = F.col("metric") == rule.metric
        columns.append(F.max(F.when(mine, F.col("q.q3") + reach)).alias(f"high_{rule.metric}"))
        if rule.two_sided:
            columns.append(F.max(F.when(mine, F.col("q.q1") - reach)).alias(f"low_{rule.metric}"))
    return chosen.groupBy("lang", "source").agg(*columns)


def quality_verdicts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_rows: int = 200,
    fence: int = 3,
) -> DataFrame:
    """One row per document: its counts, ``base_failed`` and ``kept``.

    Texts are read once; the counts (a few numbers per document) are checkpointed, since sketches and
    filter both use them. The bounds are joined back by language and source as small rows; a source
    with a third of all documents is split by the adaptive skew join.

    Null or empty text: no word, base failed. Null language or source: a group of its own. Repeated rows
    and ids: judged each by itself. Empty table: no rows. Other columns of ``docs`` are ignored.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")
    )
    counted = cut_lineage(text_counts(rows).drop("text"))
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    # Documents that fail the base rules don't move the bounds.
    limits = bounds(sketches(counted.filter(~failed), ["lang", "source"]), least_rows, fence)
    limits = limits.withColumnsRenamed({"lang": "l", "source": "s"})
    inside = F.lit(True)
    for rule in RULES:
        value = metric(rule)
        inside &= F.coalesce(value <= F.col(f"high_{rule.metric}"), F.lit(True))
        if rule.two_sided:
            inside &= F.coalesce(value >= F.col(f"low_{rule.metric}"), F.lit(True))
    judged = counted.join(limits, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    return judged.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & inside).alias("kept"))
