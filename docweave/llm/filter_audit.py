"""Interaction audit of document filters: a Gray-code walk over all subsets of filters."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.common import longs, stored

FILTERS = "ABCDE"

# The bit of each filter in a mask of failures.
BIT = {name: 1 << i for i, name in enumerate(FILTERS)}

# What is counted in every mask cell.
COUNTED = ("n", "good", "toxic")

_BLANK = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> Column:
    """Mask of the failures of A to D, which a text shows by itself; a null text is empty."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, _BLANK), lambda w: w != "")
    # The list of words is made once, as the only element of an array.
    few = lambda w: F.when(F.size(w) < 200, BIT["A"]).otherwise(0)
    repeated = lambda w: F.when(F.size(F.array_distinct(w)) * 100 < F.size(w) * 50, BIT["B"]).otherwise(0)
    by_words = F.get(F.transform(F.array(words), lambda w: few(w) + repeated(w)), F.lit(0))
    capitals = F.octet_length(whole) - F.octet_length(F.regexp_replace(whole, "[A-Z]+", ""))
    shouted = F.when(capitals.cast("long") * 100 > F.length(whole).cast("long") * 2, BIT["C"]).otherwise(0)
    marked = F.when(whole.rlike("[#$%&*|]"), BIT["D"]).otherwise(0)
    return (by_words + shouted + marked).cast("int")


def mask_cells(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents per source and set of failed filters, and how many of them are labelled
    quality 1 and toxic 1.

    Texts are read once; then a document is its id, source, mask and the SHA-256 of its text. Filter E is settled by one
    minimum per text, combined before the shuffle, so a text that a third of all documents share is no hot group: all
    its documents are counted as failing E, and those of its least id are counted back.

    Null text: empty. Null source: the part of the empty string. Null id: has no label and no smaller id, so it never
    fails E and makes no other fail. Repeated ids: with the same text none is smaller than the other. Several labels
    of one id: 1 if any is. Empty table: no rows. Other columns are ignored.
    """
    digest = F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.coalesce(F.col(f"`{source}`"), F.lit("")).alias("part"),
        text_failures(F.col(f"`{text}`")).alias("mask"),
        F.unhex(digest).alias("digest"),
    )
    rows = stored(rows)
    told = labels.filter("doc_id IS NOT NULL").groupBy("doc_id")
    told = told.agg(*(F.max(F.coalesce((F.col(c) == 1).cast("long"), F.lit(0))).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))))
    known = rows.filter("doc_id IS NOT NULL").join(told, "doc_id", "left")
    # The rows of an id are together already. Its sources become a list, one entry for almost every id.
    one = known.groupBy("doc_id", "digest", "mask", "part").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.coalesce("good", F.lit(0))).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    one = one.select("doc_id", "digest", "mask", F.struct("part", "n", (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("toxic")).alias("toxic")).alias("counts"))
    ids = stored(one.groupBy("doc_id", "digest", "mask").agg(F.array_sort(F.collect_list("counts")).alias("counts")))
    first = ids.groupBy("digest").agg(F.min(F.struct("doc_id", "mask", "counts")).alias("f"))
    each = lambda sign: [F.col("c.part").alias("part"), *((F.col(f"c.{x}") * sign).alias(x) for x in COUNTED)]
    failing = ids.select((F.col("mask") + BIT["E"]).alias("mask"), F.explode("counts").alias("c")).select("mask", *each(1))
    less = first.select((F.col("f.mask") + BIT["E"]).alias("mask"), F.explode("f.counts").alias("c")).select("mask", *each(-1))
    passing = first.select(F.col("f.mask").alias("mask"), F.explode("f.counts").alias("c")).select("mask", *each(1))
    nameless = rows.filter("doc_id IS NULL").select("mask", "part", F.lit(1).cast("long").alias("n"), *(F.lit(0).cast("long").alias(x) for x in COUNTED[1:]))
    every = failing.unionByName(less).unionByName(passing).unionByName(nameless)
    return every.groupBy("part", "mask").agg(*(F.sum(x).alias(x) for x in COUNTED)).filter("n > 0")


def walk(cells: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every set of active filters: ``cells`` is (mask, ...), the result (active set, ...).

    A Gray code visits all sets and toggles one filter from each to the next. Every mask cell has a counter of its
    active failures; the running survivors change only by the cells whose counter leaves or reaches zero.
    """
    masks = np.arange(1 << filters)
    failures = np.zeros(len(masks), np.int64)
    alive = cells.sum(axis=0)
    states = np.zeros_like(cells)
    active = 0
    states[0] = alive
    for step in range(1, len(masks)):
        bit = step & -step  # the ruler sequence gives the filter to toggle
        active ^= bit
        touched = masks[(masks & bit) != 0]
        if active & bit:
            leaving = touched[failures[touched] == 0]
            failures[touched] += 1
            alive = alive - cells[leaving].sum(axis=0)
        else:
            failures[touched] -= 1
            alive = alive + cells[touched[failures[touched] == 0]].sum(axis=0)
        states[active] = alive
    return states


def order_steps(filters: str = FILTERS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(all orders, the active set before every step, the set after it), as (order, step)."""
    orders = ["".join(p) for p in permutations(filters)]
    bits = np.array([[1 << filters.index(x) for x in order] for order in orders])
    after = np.cumsum(bits, axis=1)
    return orders, after - bits, after


def audit(cells: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, from ``mask_cells``:
    ``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``.

    A part becomes one row of counts per mask, so whatever its number of documents it is a row among others. The states
    of all subsets are walked once per part; steps are differences of states. Empty cells: no rows.
    """
    size = 1 << len(filters)
    at = lambda x: [F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(x))), F.lit(0)) for m in range(size)]
    wide = cells.groupBy("part").agg(F.array(*(c for x in COUNTED for c in at(x))).alias("cells"))
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    schema = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType())])
    for name in names:
        schema = schema.add(name, T.LongType())
    orders, before, after = order_steps(filters)
    bit = after - before
    which = np.log2(bit).astype(int)
    masks = np.arange(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in zip(batch.column(0), batch.column(1).to_pylist()):
                states = walk(np.array(values, np.int64).reshape(len(COUNTED), size).T, len(filters))
                single = np.array(values[:size], np.int64)
                failing = np.array([single[(masks & 1 << f) != 0].sum() for f in range(len(filters))])
                gone = states[before] - states[after]
                removed = gone[..., 0]
                total = np.array([removed[which == f].sum() for f in range(len(filters))])
                found = [states[after][..., 0], removed, failing[which] - removed, single[bit], gone[..., 1], gone[..., 2], total[which]]
                n = removed.size
                columns = [pa.array([part.as_py()] * n), pa.array(np.repeat(orders, len(filters))), pa.array(np.tile(np.arange(1, len(filters) + 1, dtype=np.int32), len(orders)))]
                yield pa.RecordBatch.from_arrays([*columns, *(longs(x.ravel()) for x in found)], names=schema.names)

    return wide.mapInArrow(run, schema)


def audit_filters(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The audit of the five filters over all documents; see ``mask_cells`` for nulls, ties and repeated rows."""
    return audit(mask_cells(docs, labels, doc_id, text, source))
