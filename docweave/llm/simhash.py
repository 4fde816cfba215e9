"""SimHash near-duplicates: tiled exact comparison of fingerprints with numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.llm.common import longs, with_text_columns
from docweave.operators.components import connected_components
from docweave.session import cut_lineage

# Shingles whose bits are counted at a time.
_BLOCK = 1 << 16

# Comparisons (left rows x right rows) of one numpy step.
_STEP = 1 << 22


def fingerprint(text: str | None, size: int, seed: int) -> int:
    """64-bit SimHash of the ``size``-word shingles; bit ``b`` is set where over half of the hashes have it."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(size, len(words))
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    hashed = xxhash.xxh64_intdigest
    count = len(words) - size + 1
    bits = np.zeros(64, np.int64)
    for low in range(0, count, _BLOCK):
        high = min(count, low + _BLOCK)
        hashes = np.array(
            [hashed(joined[a:b], seed) for a, b in zip(starts[low:high], ends[low + size - 1 : high + size - 1])], np.uint64
        )
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", size: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` with ``fingerprint`` (the unsigned value in a signed long)."""

    def make() -> Callable:
        def compute(texts: pa.Array) -> list[pa.Array]:
            return [longs(np.array([fingerprint(t, size, seed) for t in texts.to_pylist()], np.uint64).view(np.int64))]

        return compute

    return with_text_columns(docs, text, {"fingerprint": T.LongType()}, make)


def _lanes(values: np.ndarray) -> np.ndarray:
    """Population counts of the four 16-bit lanes."""
    return np.bitwise_count(values.view(np.uint16).reshape(-1, 4)).astype(np.int16)


class _Tiles:
    """Fingerprints ordered so that a tile holds those with equal lane counts."""

    def __init__(self, values: np.ndarray, numbers: np.ndarray) -> None:
        lanes = _lanes(values)
        code = lanes.astype(np.int64) @ np.array([17**3, 17**2, 17, 1])
        order = np.argsort(code, kind="stable")
        self.values, self.numbers = values[order], numbers[order]
        _, first = np.unique(code[order], return_index=True)
        self.bounds = np.append(first, len(values))
        self.lanes = lanes[order][first]


def _forest(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``roots`` (least member per node) after joining the edges (a, b)."""
    while True:
        x, y = roots[a], roots[b]
        open_ = x != y
        if not open_.any():
            return roots
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = roots[roots]
            if np.array_equal(up, roots):
                break
            roots = up


def close_forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) links that connect all pairs of ``left`` x ``right`` within ``radius`` bits.

    ``right`` None: pairs within ``left``. A pair of tiles is skipped when its lane population counts
    differ by more than the radius in sum: each differing bit changes one of them by one. The pairs found
    are folded into a spanning forest at once, so a dense group gives one link per fingerprint.
    """
    values = left if right is None else np.concatenate([left, right])
    a = _Tiles(left, np.arange(len(left)))
    b = a if right is None else _Tiles(right, np.arange(len(left), len(values)))
    roots = np.arange(len(values))
    for tile in range(len(a.lanes)):
        near = np.flatnonzero(np.abs(b.lanes - a.lanes[tile]).sum(axis=1) <= radius)
        if right is None:
            near = near[near >= tile]
        if not len(near):
            continue
        rows = np.concatenate([np.arange(b.bounds[t], b.bounds[t + 1]) for t in near])
        others, numbers = b.values[rows], b.numbers[rows]
        low, high = a.bounds[tile], a.bounds[tile + 1]
        step = max(1, _STEP // len(rows))
        for start in range(low, high, step):
            mine = slice(start, min(high, start + step))
            i, j = np.nonzero(np.bitwise_count(a.values[mine, None] ^ others[None, :]) <= radius)
            roots = _forest(roots, a.numbers[mine][i], numbers[j])
    linked = np.flatnonzero(roots != np.arange(len(values)))
    return values[linked], values[roots[linked]]


def close_links(values: DataFrame, radius: int = 4, group_rows: int = 32_768) -> DataFrame:
    """``(a, b)`` edges that connect the distinct ``fingerprint`` of ``values`` within ``radius`` bits.

    Fingerprints are grouped by population count; a count with more than ``group_rows`` of them is cut by
    hash, so a group is bounded. One task compares one pair of groups, and pairs of groups whose counts
    differ by more than the radius don't exist. The driver sees 65 numbers: how many groups each count has.
    """
    counted = values.select("fingerprint", F.bit_count("fingerprint").alias("ones"))
    sizes = {r["ones"]: r["n"] for r in counted.groupBy("ones").agg(F.count(F.lit(1)).alias("n")).collect()}
    cuts = [-(-sizes.get(ones, 0) // group_rows) for ones in range(65)]
    table = F.lit(cuts)
    mine = counted.select(
        "fingerprint",
        "ones",
        F.pmod(F.xxhash64("fingerprint"), F.greatest(F.get(table, F.col("ones")), F.lit(1))).cast("int").alias("cut"),
    )
    others = F.explode(F.sequence(F.greatest(F.col("ones") - radius, F.lit(0)), F.least(F.col("ones") + radius, F.lit(64))))
    spread = mine.select("*", others.alias("ones2")).filter(F.get(table, F.col("ones2")) > 0)
    spread = spread.select("*", F.explode(F.sequence(F.lit(0), F.get(table, F.col("ones2")) - 1)).alias("cut2"))
    own, other = F.struct("ones", "cut"), F.struct(F.col("ones2").alias("ones"), F.col("cut2").alias("cut"))
    dealt = spread.select(
        F.least(own, other).alias("low"), F.greatest(own, other).alias("high"), (own <= other).alias("is_low"), "fingerprint"
    )

    def compare(table: pa.Table) -> pa.Table:
        fp = table.column("fingerprint").to_numpy().view(np.uint64)
        low = table.column("is_low").to_numpy()
        same = table.column("low")[0].as_py() == table.column("high")[0].as_py()
        a, b = close_forest(fp[low], None if same else fp[~low], radius)
        return pa.table({"a": longs(a.view(np.int64)), "b": longs(b.view(np.int64))})

    return dealt.groupBy("low", "high").applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 4, radius: int = 4, group_rows: int = 32_768
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``; the component is the least doc_id reachable.

    Copies collapse to one fingerprint before anything is compared, so a group of equal texts costs one row.
    Fingerprints and links are small rows and are checkpointed; texts are read once and never shuffled.

    Null or empty text: fingerprint zero, linked like any other. Null ids: they take part; the component is
    the least id that isn't null, or null. Repeated rows: one result row each. Empty table: no rows.
    Other columns of ``docs`` are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = cut_lineage(fingerprints(rows, "text", size).select("doc_id", "fingerprint"))
    classes = cut_lineage(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    links = close_links(classes.select("fingerprint"), radius, group_rows)
    groups = connected_components(links.select(F.lit(0).alias("scope"), "a", "b")).select(
        F.col("node").alias("fingerprint"), F.col("component").alias("root")
    )
    grouped = classes.join(groups, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = grouped.join(least, "root").select("fingerprint", "component_id")
    return marked.join(of_class, "fingerprint").select("doc_id", "fingerprint", "component_id")


def as_hex(value: str = "fingerprint"):
    """16 lower-case hex digits of a long."""
    return F.lower(F.lpad(F.hex(F.col(value)), 16, "0"))
