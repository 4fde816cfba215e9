"""Image triage before captioning: every image keeps a reason or is kept.

Images: ``document_id, idx, filename, page, x, y, w, h, category, sha, phash, found,
photographic``. ``idx`` is the position in the parser's list, ``phash`` a BIGINT.
Adds ``reason`` (NULL when kept), ``duplicate_of`` and ``group_id``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import vectors as vx
from docweave.operators.components import near_groups
from docweave.operators.ordered import running
from docweave.session import stage_table as cut_lineage
from docweave.settings import DEFAULTS


@dataclass(frozen=True)
class TriageParams:
    boilerplate_pages: int = DEFAULTS.boilerplate_pages
    min_dimension: float = DEFAULTS.min_dimension
    max_aspect: float = DEFAULTS.max_aspect
    phash_bits: int = DEFAULTS.phash_bits
    overlap_iou: float = DEFAULTS.overlap_iou
    prefer_category: str = "embedded"
    detect_photographic: bool = True
    collapse_near_dups: bool = True
    bucket_rows: int = DEFAULTS.bucket_rows
    block_rows: int = DEFAULTS.block_rows


def is_decorative(w: Column, h: Column, params: TriageParams) -> Column:
    small, large = F.least(w, h), F.greatest(w, h)
    measured = (w != 0) & (h != 0)
    return measured & ((small < params.min_dimension) | (F.try_divide(large, small) > params.max_aspect))


def is_photographic(pixels: Column, colorful_min: float = 30.0, unique_min: float = 0.04, white_max: float = 0.22) -> Column:
    """Photo test over an ``array<struct<r,g,b>>`` of a scaled-down image; NULL or empty is no photo."""
    n = F.size(pixels).cast("double")
    mean = lambda f: F.aggregate(F.transform(pixels, f), F.lit(0.0), lambda a, v: a + v) / n
    rg = lambda p: (p["r"] - p["g"]).cast("double")
    yb = lambda p: 0.5 * (p["r"] + p["g"]) - p["b"]
    means = {"rg": mean(rg), "yb": mean(yb)}
    squares = {"rg": mean(lambda p: rg(p) * rg(p)), "yb": mean(lambda p: yb(p) * yb(p))}
    spread = sum((squares[k] - means[k] * means[k] for k in means), F.lit(0.0))
    colorful = F.sqrt(F.greatest(spread, F.lit(0.0))) + 0.3 * F.sqrt(means["rg"] * means["rg"] + means["yb"] * means["yb"])
    white = F.size(F.filter(pixels, lambda p: (p["r"] > 235) & (p["g"] > 235) & (p["b"] > 235))) / n
    shades = F.array_distinct(
        F.transform(pixels, lambda p: F.shiftright(p["r"], 4) * 256 + F.shiftright(p["g"], 4) * 16 + F.shiftright(p["b"], 4))
    )
    photo = (colorful > colorful_min) & (F.size(shades) / 4096 > unique_min) & (white < white_max)
    return F.when(pixels.isNotNull() & (F.size(pixels) > 0), photo).otherwise(F.lit(False))


def first_stage(images: DataFrame, params: TriageParams) -> DataFrame:
    """Missing, boilerplate, decorative, photographic and exact duplicates.

    Everything that depends on copies of a content hash comes from one small row per hash.
    """
    decorative = is_decorative(F.col("w"), F.col("h"), params)
    photo = F.lit(params.detect_photographic) & F.coalesce("photographic", F.lit(False))
    rows = images.withColumn(
        "reason",
        F.when(~F.col("found"), "missing_on_disk").when(decorative, "decorative_dimensions").when(photo, "photographic_content"),
    )
    present = rows.filter("found")
    usable = F.when(F.col("reason").isNull(), F.struct("idx", "filename"))
    by_page = present.groupBy("document_id", "sha", "page").agg(F.min(usable).alias("first"))
    copies = by_page.groupBy("document_id", "sha").agg(F.count(F.lit(1)).alias("page_count"), F.min("first").alias("first"))
    joined = rows.join(copies, ["document_id", "sha"], "left")
    is_copy = F.col("reason").isNull() & (F.col("idx") > F.col("first.idx"))
    repeated = F.col("found") & (F.col("page_count") >= params.boilerplate_pages)
    return joined.select(
        *images.columns,
        F.when(repeated, "boilerplate_repeated").when(F.col("reason").isNotNull(), F.col("reason"))
        .when(is_copy, "exact_duplicate").alias("reason"),
        F.when(is_copy & ~repeated, F.col("first.filename")).alias("duplicate_of"),
        F.when(repeated, F.col("page_count")).alias("page_count"),
    )


# ---------------------------------------------------------------- overlap on a page


def _cells(low: Column, size: Column, threshold: float, own: bool) -> Column:
    """Grid cells of one axis: the box's own cell, or all cells a partner's corner may be in.

    Boxes with the given overlap have sizes within the factor 1/threshold, hence
    neighbouring size classes, and corners closer than (1 - threshold) times the larger size.
    """
    base = 1 / threshold
    level = F.floor(F.log(size) / math.log(base))
    unit = lambda c: F.pow(F.lit(base), c + 1)
    if own:
        return F.array(F.struct(level.alias("c"), F.floor(low / unit(level)).alias("p")))
    reach = size * base * (1 - threshold)

    def level_cells(step: int) -> Column:
        at = level + step
        span = F.sequence(F.floor((low - reach) / unit(at)), F.floor((low + reach) / unit(at)))
        return F.transform(span, lambda p: F.struct(at.alias("c"), p.alias("p")))

    per_level = [level_cells(step) for step in (-1, 0, 1)]
    return F.concat(*per_level)


def overlap_edges(boxes: DataFrame, params: TriageParams) -> DataFrame:
    """``(document_id, a, b, keep_a)`` for boxes a before b on one page with enough overlap.

    A page with few boxes is one bucket; a page with many is cut into grid cells by
    position and size, which still meet for every overlapping pair.
    """
    page = ["document_id", "page"]
    solid = boxes.filter("w > 0 AND h > 0")
    sized = solid.join(solid.groupBy(*page).agg(F.count(F.lit(1)).alias("n")), page)
    many = F.col("n") > params.bucket_rows
    t = params.overlap_iou
    nothing = F.array(F.struct(F.lit(0).cast("bigint").alias("c"), F.lit(0).cast("bigint").alias("p")))

    def keyed(own: bool) -> DataFrame:
        axis = lambda low, size: F.when(many, _cells(F.col(low), F.col(size), t, own)).otherwise(nothing)
        cols = sized.select(*page, "idx", "x", "y", "w", "h", "category", axis("x", "w").alias("cx"), axis("y", "h").alias("cy"))
        return cols.withColumn("cx", F.explode_outer("cx")).withColumn("cy", F.explode_outer("cy"))

    join_keys = [*page, "cx", "cy"]
    side = lambda df, p: df.select(*join_keys, *[F.col(c).alias(p + c) for c in ("idx", "x", "y", "w", "h", "category")])
    pairs = side(keyed(True), "a_").join(side(keyed(False), "b_"), join_keys).filter("a_idx < b_idx")
    box = lambda p: [F.col(f"{p}_{c}") for c in "xywh"]
    close = pairs.filter(vx.iou(*box("a"), *box("b")) >= t)
    prefers = lambda p: F.coalesce(F.col(f"{p}_category") == params.prefer_category, F.lit(False))
    keep_a = (
        F.when(prefers("a") & ~prefers("b"), True)
        .when(prefers("b") & ~prefers("a"), False)
        .otherwise(F.col("a_w") * F.col("a_h") >= F.col("b_w") * F.col("b_h"))
    )
    return close.select("document_id", F.col("a_idx").alias("a"), F.col("b_idx").alias("b"), keep_a.alias("keep_a")).distinct()


def _acting(edges: DataFrame) -> DataFrame:
    """``(document_id, idx)`` of boxes dropped before their turn comes.

    A box acts unless an earlier acting box drops it. A round settles every box with an acting dropper, or whose droppers
    are all settled. A box with one open dropper left does the opposite of it, so it points there; pointers are followed
    twice as far in every round, so a chain of n such boxes takes about log2(n) rounds.
    """
    drops = edges.filter("keep_a").select("document_id", "a", "b")
    state = drops.select("document_id", F.col("b").alias("idx")).distinct()
    state = cut_lineage(state.select("*", F.lit(None).cast("boolean").alias("acts"), F.lit(None).cast("bigint").alias("to"), F.lit(False).alias("flip")))
    while not state.filter("acts IS NULL").isEmpty():
        open_ = state.filter("acts IS NULL")
        # A dropper outside the state table has no dropper itself, so it acts.
        sources = state.select("document_id", F.col("idx").alias("a"), F.col("acts").alias("src"), F.lit(True).alias("listed"))
        droppers = drops.join(open_.select("document_id", F.col("idx").alias("b")), ["document_id", "b"], "left_semi").join(sources, ["document_id", "a"], "left")
        droppers = droppers.withColumn("src", F.when(F.col("listed").isNull(), True).otherwise(F.col("src")))
        unknown = F.col("src").isNull()
        seen = droppers.groupBy("document_id", F.col("b").alias("idx")).agg(
            F.max(F.coalesce("src", F.lit(False))).alias("hit"), F.count_if(unknown).alias("left"), F.min(F.when(unknown, F.col("a"))).alias("one")
        )
        told = open_.join(seen, ["document_id", "idx"])
        acts = F.when(F.col("hit"), False).when(F.col("left") == 0, True)
        fresh = F.col("to").isNull() & (F.col("left") == 1)
        told = told.select(
            "document_id", "idx", acts.alias("acts"), F.when(fresh, F.col("one")).otherwise(F.col("to")).alias("to"), (F.col("flip") != fresh).alias("flip")
        )
        told = cut_lineage(state.filter("acts IS NOT NULL").unionByName(told))
        # One step along every pointer: to the answer, or twice as far.
        ahead = told.select("document_id", F.col("idx").alias("to"), F.col("acts").alias("_acts"), F.col("to").alias("_to"), F.col("flip").alias("_flip"))
        first = F.lit(True)  # a target that no one drops acts
        found = told.filter("acts IS NULL AND to IS NOT NULL").join(ahead.withColumn("_in", F.lit(True)), ["document_id", "to"], "left")
        target = F.when(F.col("_in").isNull(), first).otherwise(F.col("_acts"))
        moved = found.select(
            "document_id", "idx", (F.col("flip") != target).alias("acts"), F.coalesce("_to", "to").alias("to"),
            F.when(F.col("_to").isNotNull(), F.col("flip") != F.col("_flip")).otherwise(F.col("flip")).alias("flip"),
        )
        rest = told.filter("acts IS NOT NULL OR to IS NULL")
        state = cut_lineage(rest.unionByName(moved))
    return state.filter("NOT acts").select("document_id", "idx")


def _spread_drops(boxes: DataFrame, params: TriageParams) -> DataFrame:
    """:func:`overlap_drops` by joins over boxes and edges, whatever the size of a document."""
    shape = ["document_id", "page", "x", "y", "w", "h", "category"]
    firsts = cut_lineage(boxes.filter("w > 0 AND h > 0").groupBy(*shape).agg(F.min("idx").alias("idx")))
    edges = cut_lineage(overlap_edges(firsts, params))
    idle = _acting(edges).withColumn("idle", F.lit(True))
    live = edges.join(idle.withColumnRenamed("idx", "a"), ["document_id", "a"], "left").filter("idle IS NULL").drop("idle")
    lost = live.filter("keep_a").groupBy("document_id", F.col("b").alias("idx")).agg(F.min("a").alias("keeper"))
    # An acting box falls to the first later box that beats it and was still present.
    beaten = (
        live.filter("NOT keep_a")
        .join(lost.select("document_id", F.col("idx").alias("b"), F.col("keeper").alias("gone")), ["document_id", "b"], "left")
        .filter("gone IS NULL OR gone > a")
        .groupBy("document_id", F.col("a").alias("idx"))
        .agg(F.min("b").alias("keeper"))
    )
    dropped = lost.unionByName(beaten.join(lost.select("document_id", "idx"), ["document_id", "idx"], "left_anti"))
    before = lost.select("document_id", F.col("idx").alias("first"), F.col("keeper").alias("earlier"))
    copies = (
        boxes.join(firsts.withColumnRenamed("idx", "first"), shape)
        .filter("idx > first")
        .join(before, ["document_id", "first"], "left")
        .select("document_id", "idx", F.coalesce("earlier", "first").alias("keeper"))
    )
    return dropped.select("document_id", "idx", "keeper").unionByName(copies)


# Boxes that a page compares by pairs; more are sorted by their left edge first. Pairs that are arrays at a time.
SMALL_PAGE, PAIRS = 64, 1 << 18
# Ids of large documents that are broadcast, else they meet the boxes in a shuffle.
BROADCAST_DOCUMENTS = 100_000
BOX = ["document_id", "page", "x", "y", "w", "h", "category", "idx"]


def _not_less(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a >= b`` as Spark has it: NaN is above all numbers."""
    return (a >= b) | np.isnan(a)


def _shared(a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray, unknown: np.ndarray) -> np.ndarray:
    """Length that two boxes share along an axis, as Spark's least and greatest have it: an unknown end is left out."""
    only_a, only_b = unknown[b], unknown[a]
    least = np.where(only_a, high[a], np.where(only_b, high[b], np.fmin(high[a], high[b])))
    greatest = np.where(only_a, low[a], np.where(only_b, low[b], np.maximum(low[a], low[b])))
    return np.where(only_a & only_b, 0.0, np.maximum(0.0, least - greatest))


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before; NaN equals NaN."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= (c[1:] != c[:-1]) & ~((c[1:] != c[1:]) & (c[:-1] != c[:-1]))
    return new


def _page_pairs(page: np.ndarray, x: np.ndarray, w: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of two boxes of one page, for every pair that may overlap enough; rows come by page and ``x``.

    Boxes with the given overlap share this part of both widths, so the second starts before the rest of the first.
    """
    n = len(page)
    starts = np.flatnonzero(_runs(page))
    ends = np.r_[starts[1:], n]
    upto = np.repeat(ends, ends - starts)
    many = ends - starts > SMALL_PAGE
    for lo, hi in zip(starts[many], ends[many]):
        if np.isfinite(x[lo:hi]).all():
            slack = 1e-9 * (np.abs(x[lo:hi]) + w[lo:hi])
            upto[lo:hi] = lo + np.searchsorted(x[lo:hi], x[lo:hi] + w[lo:hi] * (1 - threshold) + slack, side="right")
    counts = np.maximum(upto - np.arange(n) - 1, 0)
    before = np.r_[0, np.cumsum(counts)]
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, side="right")) - 1)
        first = np.repeat(np.arange(at, to), counts[at:to])
        yield first, first + 1 + np.arange(before[at], before[to]) - np.repeat(before[at:to], counts[at:to])
        at = to


def _early_acts(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of n boxes act, where ``a`` drops the later ``b`` if it acts itself."""
    acts, known = np.ones(n, bool), np.ones(n, bool)
    known[b] = False
    for _ in range(16):
        if not len(a):
            return acts
        lost = b[known[a] & acts[a]]
        acts[lost], known[lost] = False, True
        left = ~known[a] & ~known[b]
        a, b = a[left], b[left]
        waits = np.zeros(n, bool)
        waits[b] = True
        known |= ~waits
    # Long chains: box by box in list order.
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    starts = np.flatnonzero(_runs(a))
    for lo, hi in zip(starts, np.r_[starts[1:], len(a)]):
        if acts[a[lo]]:
            acts[b[lo:hi]] = False
    return acts


def _document_drops(rows: pa.Table, threshold: float, prefer: str) -> pa.Table:
    """:func:`overlap_drops` of whole documents."""
    code = lambda name: pc.dictionary_encode(rows.column(name)).combine_chunks().indices.to_numpy()
    document, page, kind = code("document_id"), code("page"), code("category")
    w, h, idx = (rows.column(c).to_numpy() for c in ("w", "h", "idx"))
    (x, no_x), (y, no_y) = ((pc.fill_null(rows.column(c), 0.0).to_numpy(), pc.is_null(rows.column(c)).to_numpy()) for c in ("x", "y"))
    liked = pc.equal(rows.column("category"), prefer).to_numpy()
    # Copies follow their first, the one with the least idx.
    order = np.lexsort((idx, kind, h, w, y, no_y, x, no_x, page, document))
    document, page, kind, x, no_x, y, no_y, w, h, idx, liked = (c[order] for c in (document, page, kind, x, no_x, y, no_y, w, h, idx, liked))
    heads = _runs(document, page, x, no_x, y, no_y, w, h, kind)
    first = np.flatnonzero(heads)[np.cumsum(heads) - 1]
    # A box goes by document and idx: nodes are numbered in list order.
    by_idx = np.lexsort((idx, document))
    node = np.empty(len(idx), np.int64)
    node[by_idx] = np.cumsum(_runs(document[by_idx], idx[by_idx])) - 1
    n = int(node.max()) + 1 if len(node) else 0
    named = np.empty(n, np.int64)
    named[node] = np.arange(len(node))

    f = np.flatnonzero(heads)
    area, likes, nodes = w[f] * h[f], liked[f], node[f]
    wide, high = (x[f], x[f] + w[f], no_x[f]), (y[f], y[f] + h[f], no_y[f])
    found = [np.empty((3, 0), np.int32)]
    with np.errstate(all="ignore"):
        for p, q in _page_pairs(np.cumsum(_runs(document[f], page[f])), np.where(no_x[f], np.nan, x[f]), w[f], threshold):
            swap = nodes[p] > nodes[q]
            a, b = np.where(swap, q, p), np.where(swap, p, q)
            inter = _shared(a, b, *wide) * _shared(a, b, *high)
            union = area[a] + area[b] - inter
            share = np.where((union > 0) | np.isnan(union), inter / union, 0.0)
            close = _not_less(share, np.float64(threshold)) & (nodes[a] != nodes[b])
            a, b = a[close], b[close]
            keep = np.where(likes[a] != likes[b], likes[a], _not_less(area[a], area[b]))
            found.append(np.stack([nodes[a], nodes[b], keep]).astype(np.int32))
    a, b, keep = np.concatenate(found, axis=1)
    keep = keep.astype(bool)
    live = _early_acts(n, a[keep], b[keep])[a]
    a, b, keep = a[live], b[live], keep[live]
    never = np.iinfo(np.int32).max
    lost, beaten = np.full(n, never, np.int32), np.full(n, never, np.int32)
    np.minimum.at(lost, b[keep], a[keep])
    # An acting box falls to the first later box that beats it and was still present.
    present = ~keep & (lost[b] > a)
    np.minimum.at(beaten, a[present], b[present])
    keeper = np.where(lost != never, lost, beaten)
    gone = np.flatnonzero(keeper != never)
    copies = np.flatnonzero((idx > idx[first]) & ~no_x & ~no_y)
    origin = node[first[copies]]
    origin = np.where(lost[origin] != never, lost[origin], origin)
    at = np.r_[named[gone], copies]
    return pa.table({
        "document_id": rows.column("document_id").take(pa.array(order[at])), "idx": pa.array(idx[at], pa.int64()),
        "keeper": pa.array(idx[named[np.r_[keeper[gone], origin]]], pa.int64()),
    })


def _whole_documents(threshold: float, prefer: str):
    """Batches of boxes sorted by document -> drops; a document that a batch leaves open waits for its other rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("document_id")
            other = pc.not_equal(ids, ids[-1]).to_numpy(zero_copy_only=False)
            done = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if held and (done or held[-1].column("document_id")[-1] != ids[0]):
                held.append(batch.slice(0, done))
                yield from _document_drops(pa.Table.from_batches(held), threshold, prefer).to_batches()
                held = []
            elif done:
                yield from _document_drops(pa.Table.from_batches([batch.slice(0, done)]), threshold, prefer).to_batches()
            held.append(batch.slice(done))
        if held:
            yield from _document_drops(pa.Table.from_batches(held), threshold, prefer).to_batches()

    return run


def overlap_drops(boxes: DataFrame, params: TriageParams) -> DataFrame:
    """``(document_id, idx, keeper)``: boxes dropped because of an overlapping box on their page.

    Boxes are visited in list order; each still present box is compared with all later
    ones of its page and the preferred category, then the larger box, wins. A box that
    lost still finishes its own comparisons. Copies with equal box and category fare like
    their first copy, or fall to it, so only first copies are compared.

    Documents of up to ``16 * bucket_rows`` boxes are settled one by one after a single shuffle of the boxes, larger ones by joins.
    """
    boxes = boxes.withColumn("category", F.coalesce("category", F.lit("embedded"))).select(*BOX)
    large = boxes.groupBy("document_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 16 * params.bucket_rows).select("document_id")
    large = cut_lineage(large.filter("document_id IS NOT NULL"))
    many_large = large.count()
    few = F.broadcast(large) if many_large <= BROADCAST_DOCUMENTS else large
    small = boxes.join(few, "document_id", "left_anti") if many_large else boxes
    double = lambda c: F.col(c).cast("double").alias(c)
    solid = small.filter("w > 0 AND h > 0 AND document_id IS NOT NULL AND page IS NOT NULL AND idx IS NOT NULL").select("document_id", "page", *map(double, "xywh"), "category", F.col("idx").cast("bigint").alias("idx"))
    kind = boxes.schema["document_id"].dataType.simpleString()
    schema = f"document_id {kind}, idx bigint, keeper bigint"
    drops = solid.repartition("document_id").sortWithinPartitions("document_id").mapInArrow(_whole_documents(params.overlap_iou, params.prefer_category), schema)
    if not many_large:
        return drops
    return drops.unionByName(_spread_drops(boxes.join(few, "document_id", "left_semi"), params))


# ---------------------------------------------------------------- whole triage


def triage(images: DataFrame, params: TriageParams = TriageParams()) -> DataFrame:
    staged = cut_lineage(first_stage(images, params))
    names = staged.select("document_id", F.col("idx").alias("keeper"), F.col("filename").alias("keeper_name"))

    left = staged.filter("reason IS NULL")
    # Used three times below.
    drops = cut_lineage(overlap_drops(left, params).join(names, ["document_id", "keeper"]).select(
        "document_id", "idx", F.lit("overlap_duplicate").alias("why"), F.col("keeper_name").alias("of")
    ))
    left = cut_lineage(left.join(drops.select("document_id", "idx"), ["document_id", "idx"], "left_anti"))

    groups = near_groups(left.select(F.col("document_id").alias("scope"), F.col("phash").alias("hash")), params.phash_bits, params.bucket_rows)
    grouped = left.join(
        groups.select(F.col("scope").alias("document_id"), F.col("hash").alias("phash"), "component"), ["document_id", "phash"], "left"
    )
    # An image without a perceptual hash is a group of its own.
    key = F.struct(F.col("component"), F.when(F.col("component").isNull(), F.col("idx")).alias("alone"))
    grouped = grouped.withColumn("group_key", key)
    first = grouped.groupBy("document_id", "group_key").agg(F.min(F.struct("idx", "filename")).alias("first"))
    numbered = running(
        first.withColumn("at", F.col("first.idx")), ["document_id"], F.floor(F.col("at") / params.block_rows), ["at"],
        {"group_id": ("sum", F.lit(1).cast("bigint"))},
    ).withColumn("group_id", F.col("group_id") - 1)
    settled = grouped.join(numbered, ["document_id", "group_key"]).select(
        "document_id", "idx", "group_id",
        F.when(F.lit(params.collapse_near_dups) & (F.col("idx") > F.col("first.idx")), F.col("first.filename")).alias("near_of"),
    )
    return (
        staged.join(drops, ["document_id", "idx"], "left")
        .join(settled, ["document_id", "idx"], "left")
        .select(
            *images.columns,
            F.coalesce("reason", "why", F.when(F.col("near_of").isNotNull(), "near_duplicate")).alias("reason"),
            F.coalesce("duplicate_of", "of", "near_of").alias("duplicate_of"),
            "group_id",
        )
    )


def flag_manifest(triaged: DataFrame) -> DataFrame:
    """Kept and flagged counts and caption groups per document."""
    kept = F.col("reason").isNull()
    return triaged.groupBy("document_id").agg(
        F.count_if(kept).alias("kept_count"), F.count_if(~kept).alias("flagged_count"),
        F.count_distinct(F.when(kept, F.col("group_id"))).alias("caption_group_count"),
    )


def reason_counts(triaged: DataFrame) -> DataFrame:
    return triaged.groupBy("reason").agg(F.count(F.lit(1)).alias("images"))
