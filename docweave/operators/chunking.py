"""Hierarchical chunking: elements -> parent sections -> child chunks.

Input elements: ``document_id, element_id, element_type, text, page_number, order``
plus the document attributes ``domain, source_type, file_name``; ``order`` counts from 0.

Which part an element belongs to depends on all elements before it. The greedy fold
runs on blocks of token counts (never on text): every block of a long document is
first turned into a table "open tokens on entry -> open tokens on exit", the tables of
a document are chained, and then all blocks are folded independently.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.functions.ids import uuid5
from docweave.operators.ordered import running
from docweave.session import stage_table
from docweave.settings import DEFAULTS

# Token count that stands for a heading in a fold: it closes the open part.
HEADING = -1
# State of a fold without an open part.
CLOSED = -1


@dataclass(frozen=True)
class ChunkParams:
    target: int = DEFAULTS.chunk_target
    overlap: int = DEFAULTS.chunk_overlap
    max_tokens: int = DEFAULTS.chunk_max
    parent_max: int = DEFAULTS.parent_max
    block_rows: int = DEFAULTS.block_rows


# ---------------------------------------------------------------- pieces of one element


# Fixed value: the pattern of the line below a markdown table's header.
TABLE_RULE = r"^\s*\|?[\s:|-]+\|?\s*$"
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def with_table_pieces(df: DataFrame, text: Column, size: int, name: str) -> DataFrame:
    """Adds ``name``: runs of whole table rows, each under the repeated header; NULL for a text without table rows.

    One running sum over the token counts of the rows gives the rows that open a piece, and the pieces are slices
    between them. The steps are columns of their own, since an expression inside a lambda runs once per element.
    """
    lines = F.split(F.regexp_replace(text, rf"(?:{LINE_BREAKS})$", ""), LINE_BREAKS)
    head = (
        F.when(F.coalesce(F.get("_lines", F.lit(1)).rlike(TABLE_RULE), F.lit(False)), F.lit(2))
        .when(F.get("_lines", F.lit(0)).rlike(r"^\s*\|"), F.lit(1))
    )
    body = F.slice("_lines", F.col("_head") + 1, F.greatest(F.size("_lines") - F.col("_head"), F.lit(0)))
    header = F.array_join(F.slice("_lines", 1, F.col("_head")), "\n")

    def step(state: Column, count: Column) -> Column:
        opens = (state["row"] == 0) | (state["open"] + count > F.col("_room"))
        return F.struct(
            F.when(opens, F.array_append(state["starts"], state["row"])).otherwise(state["starts"]).alias("starts"),
            (state["row"] + 1).alias("row"),
            F.when(opens, count).otherwise(state["open"] + count).alias("open"),
        )

    begin = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("row"), F.lit(0).alias("open"))
    following = lambda i: F.coalesce(F.get("_starts", i + 1), F.size("_body"))
    piece = lambda start, i: F.concat("_header", F.lit("\n"), F.array_join(F.slice("_body", start + 1, following(i) - start), "\n"))
    return (
        df.withColumn("_lines", lines)
        .withColumn("_head", head)
        .withColumns({"_body": body, "_header": header})
        .withColumn("_room", F.lit(size) - tx.token_count(F.col("_header")))
        .withColumn("_starts", F.aggregate(F.transform("_body", tx.token_count), begin, step, lambda state: state["starts"]))
        .withColumn(name, F.when(F.col("_head").isNotNull() & (F.size("_body") > 0), F.transform("_starts", piece)))
        .drop("_lines", "_head", "_body", "_header", "_room", "_starts")
    )


def with_pieces(df: DataFrame, size: int, overlap: int, index: str) -> DataFrame:
    """One row per piece of ``text``; adds its position and the piece count, renews ``tokens``."""
    is_long_table = (F.col("element_type") == "table") & (F.col("tokens") > size)
    words = df.withColumn("_words", F.when(F.col("tokens") > size, tx.words(F.col("text"))))
    # A row fitting the size keeps its text as it is; outer generators keep the
    # array expressions from being copied into a filter below.
    windows = F.when(F.col("tokens") <= size, F.array("text")).otherwise(tx.token_windows(F.col("_words"), size, overlap))
    pieces = with_table_pieces(words, F.when(is_long_table, F.col("text")), size, "_rows").withColumn("_pieces", F.coalesce("_rows", windows))
    kept = [c for c in df.columns if c != "text"]
    exploded = pieces.select(*kept, F.size("_pieces").alias("_n"), F.posexplode_outer("_pieces").alias(index, "text"))
    # Only a real split needs a new count.
    return exploded.withColumn("tokens", F.when(F.col("_n") == 1, F.col("tokens")).otherwise(tx.token_count(F.col("text"))))


def expand_elements(elements: DataFrame, params: ChunkParams) -> DataFrame:
    """Elements above the parent budget become pieces with ids ``id#p0, id#p1, ...``."""
    counted = elements.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("tokens", tx.token_count(F.col("text")))
    pieces = with_pieces(counted, params.parent_max, params.overlap, "piece")
    name = F.when(F.col("_n") > 1, F.concat("element_id", F.lit("#p"), F.col("piece").cast("string"))).otherwise(F.col("element_id"))
    return pieces.withColumn("element_id", name).drop("_n")


# ---------------------------------------------------------------- greedy fold over blocks


def fold(counts: np.ndarray, entry: int, budget: int) -> tuple[list[int], int]:
    """Start positions of the parts in one block, and the open tokens after it."""
    starts, total = [], entry
    for i, n in enumerate(counts):
        if n == HEADING:
            total = CLOSED
        elif total == CLOSED or total + n > budget:
            starts.append(i)
            total = int(n)
        else:
            total += int(n)
    return starts, total


def exit_table(counts: np.ndarray, budget: int) -> list[int]:
    """Exit state of a block for every entry state CLOSED, 0, 1, ..., budget + 1.

    One value when the entry does not matter, as after any heading. Otherwise the exits
    for a part starting at each position are chained backwards, and an entry state is
    looked up by where it overflows.
    """
    headings = np.flatnonzero(counts == HEADING)
    if len(headings):
        return [min(fold(counts[headings[-1] :], CLOSED, budget)[1], budget + 1)]
    n = len(counts)
    before = np.r_[0, np.cumsum(counts)]
    # First element that no longer fits a part started at i.
    following = np.maximum(np.searchsorted(before, before[:-1] + budget, side="right") - 1, np.arange(n) + 1)
    leaves = np.empty(n, dtype=np.int64)
    for i in range(n - 1, -1, -1):
        leaves[i] = leaves[following[i]] if following[i] < n else before[n] - before[i]
    entries = np.arange(0, budget + 2)
    overflow = np.maximum(np.searchsorted(before, budget - entries, side="right") - 1, 0)
    exits = np.where(overflow < n, leaves[np.minimum(overflow, n - 1)], before[n] + entries)
    table = np.minimum(np.r_[leaves[0], exits], budget + 1)
    return [int(table[0])] if (table == table[0]).all() else table.tolist()


# Exit tables that one row holds; a group of them is composed into one.
FAN = 1000


def after(table: np.ndarray, states: np.ndarray) -> np.ndarray:
    """Exit states of a block for these entry states; a table of one value has it for every entry."""
    return np.full_like(states, table[0]) if len(table) == 1 else np.asarray(table)[states + 1]


def compose(tables: list[np.ndarray], budget: int) -> list[int]:
    """The exit table of some neighbouring blocks as if they were one."""
    states = np.arange(CLOSED, budget + 2)
    for table in tables:
        states = after(table, states)
    return [int(states[0])] if (states == states[0]).all() else states.tolist()


def _composed(budget: int):
    @F.pandas_udf("array<int>")
    def run(tables: pd.Series) -> pd.Series:
        return tables.map(lambda blocks: compose(blocks, budget))

    return run


def _chain():
    """Entry state of each of some neighbouring blocks from that of the first one."""

    @F.pandas_udf("array<int>")
    def run(tables: pd.Series, start: pd.Series) -> pd.Series:
        def entries(blocks, state: int) -> list[int]:
            found = []
            for table in blocks:
                found.append(state)
                state = int(table[0] if len(table) == 1 else table[state + 1])
            return found

        return pd.Series([entries(blocks, int(state)) for blocks, state in zip(tables, start)])

    return run


def block_entries(tables: DataFrame, budget: int, fan: int = FAN) -> DataFrame:
    """``(document_id, block, entry)``: the state that every block is entered with, from ``(document_id, block, exits)``.

    Tables compose, so they form a tree: ``fan`` blocks make a group, whose table tells what it does as a whole. The groups
    of a document are chained first, then the blocks inside each group, so no row holds more than ``fan`` tables
    below ``fan * fan`` blocks, some billion elements.
    """

    def grouped(level: DataFrame, by: Column) -> DataFrame:
        listed = F.sort_array(F.collect_list(F.struct("block", "exits")))
        return level.groupBy("document_id", by.alias("above")).agg(listed.alias("t"))

    def chained(groups: DataFrame, start: Column) -> DataFrame:
        told = groups.select("document_id", F.col("t.block").alias("blocks"), _chain()(F.col("t.exits"), start).alias("entries"))
        return told.select("document_id", F.inline_outer(F.arrays_zip("blocks", "entries")).alias("block", "entry"))

    low = grouped(tables, F.floor(F.col("block") / fan))
    high = low.select("document_id", F.col("above").alias("block"), _composed(budget)(F.col("t.exits")).alias("exits"))
    first = chained(grouped(high, F.lit(0)), F.lit(CLOSED))
    entered = low.join(first.withColumnRenamed("block", "above"), ["document_id", "above"])
    return chained(entered, F.col("entry"))


def _exit_tables(budget: int):
    @F.pandas_udf("array<int>")
    def run(counts: pd.Series) -> pd.Series:
        return counts.map(lambda c: exit_table(np.asarray(c), budget))

    return run


def _part_starts(budget: int):
    @F.pandas_udf("array<int>")
    def run(counts: pd.Series, entry: pd.Series) -> pd.Series:
        return pd.Series([fold(np.asarray(c), e, budget)[0] for c, e in zip(counts, entry)])

    return run


def _skeleton(elements: DataFrame) -> DataFrame:
    """One row per (document, block): positions and token counts in order, no text."""
    size = F.when(F.col("element_type") == "heading", F.lit(HEADING)).otherwise(F.col("tokens"))
    item = F.struct("order", "piece", size.alias("size"))
    return elements.groupBy("document_id", "block").agg(F.sort_array(F.collect_list(item)).alias("items"))


def sections(elements: DataFrame, block_rows: int = DEFAULTS.block_rows) -> DataFrame:
    """Content elements with ``section``, the position of the last heading before them, whatever a section's size."""
    at = F.when(F.col("element_type") == "heading", F.col("order").cast("bigint"))
    rows = elements.select("document_id", "order", "element_type", "text", at.alias("heading"))
    seen = running(rows, ["document_id"], F.floor(F.col("order") / block_rows), ["order"], {"section": ("max", F.col("heading"))})
    return seen.filter(F.col("element_type") != "heading").select("document_id", "order", "text", "section")


def assign_parents(elements: DataFrame, params: ChunkParams = ChunkParams()) -> DataFrame:
    """Content elements with ``parent_index`` and ``section`` (position of their heading)."""
    # Texts are counted and split once; the steps below without text read only the other columns.
    rows = stage_table(expand_elements(elements, params).withColumn("block", F.floor(F.col("order") / params.block_rows)))
    blocks = _skeleton(rows)

    long = rows.filter(F.col("order") >= params.block_rows).select("document_id").distinct()
    tables = _skeleton(rows.join(long, "document_id", "left_semi")).select(
        "document_id", "block", _exit_tables(params.parent_max)(F.col("items.size")).alias("exits")
    )
    entries = block_entries(tables, params.parent_max)

    folded = (
        blocks.join(entries, ["document_id", "block"], "left")
        .withColumn("starts", _part_starts(params.parent_max)(F.col("items.size"), F.coalesce("entry", F.lit(CLOSED))))
        .withColumn("heading", F.expr(f"array_max(transform(filter(items, x -> x.size = {HEADING}), x -> struct(x.`order`, x.piece)))"))
    )
    before = Window.partitionBy("document_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    based = folded.select(
        "document_id", "block", "items", "starts",
        F.coalesce(F.sum(F.size("starts")).over(before), F.lit(0)).alias("base"),
        F.max("heading").over(before).alias("section"),
    )
    # A row at the head of each block carries the state in; a row at each start opens a part.
    heads = based.select(
        "document_id", "block", F.lit(-1).cast("bigint").alias("order"), F.lit(0).alias("piece"),
        (F.col("base") - 1).alias("parent_index"), "section",
    )
    opened = based.select("document_id", "block", "items", "base", F.posexplode_outer("starts").alias("nth", "at")).filter("at is not null").select(
        "document_id", "block", F.get("items", F.col("at"))["order"].cast("bigint").alias("order"),
        F.get("items", F.col("at"))["piece"].alias("piece"), (F.col("base") + F.col("nth")).alias("parent_index"),
    )
    marks = heads.unionByName(opened, allowMissingColumns=True).withColumn("kind", F.lit(0))

    heading_at = F.when(F.col("element_type") == "heading", F.struct("order", "piece"))
    marked = rows.withColumn("order", F.col("order").cast("bigint")).withColumn("kind", F.lit(1)).withColumn(
        "section", heading_at
    )
    upto = (
        Window.partitionBy("document_id", "block").orderBy("order", "piece", "kind").rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = (
        marked.unionByName(marks.withColumn("section", F.col("section").cast("struct<order:bigint,piece:int>")), allowMissingColumns=True)
        .withColumn("parent_index", F.max("parent_index").over(upto))
        .withColumn("section", F.max("section").over(upto))
    )
    return placed.filter((F.col("kind") == 1) & (F.col("element_type") != "heading")).drop("kind", "block")


def headings(elements: DataFrame, params: ChunkParams = ChunkParams()) -> DataFrame:
    """Every heading with its ``level``, ``title`` and breadcrumb ``path``.

    Per level the last heading so far is kept; it belongs to the path when no heading of
    a smaller level came after it.
    """
    rows = expand_elements(elements.filter(F.col("element_type") == "heading"), params).select(
        "document_id", F.col("order").cast("bigint").alias("order"), "piece",
        tx.heading_level(F.col("text")).alias("level"), tx.clean_title(F.col("text")).alias("title"),
    )
    last = {
        f"h{n}": ("max", F.when(F.col("level") == n, F.struct("order", "piece", "title"))) for n in range(1, 7)
    }
    seen = running(rows, ["document_id"], F.floor(F.col("order") / params.block_rows), ["order", "piece"], last)
    at = lambda n: F.struct(F.col(f"h{n}.order").alias("order"), F.col(f"h{n}.piece").alias("piece"))
    steps = []
    for n in range(1, 7):
        later = F.col(f"h{n}").isNotNull()
        for m in range(1, n):
            later = later & (F.col(f"h{m}").isNull() | (at(n) > at(m)))
        steps.append(F.when(later, F.col(f"h{n}.title")))
    path = F.filter(F.array(*steps), lambda t: t.isNotNull())
    return seen.select("document_id", "order", "piece", "level", "title", path.alias("path"))


def parent_id(document_id: Column, index: Column) -> Column:
    return uuid5(document_id, F.lit("parent"), index.cast("string"))


def parent_sections(assigned: DataFrame, heads: DataFrame) -> DataFrame:
    """One row per parent. A parent holds about the parent budget of tokens, so it fits an array."""
    item = F.struct("order", "piece", "text")
    grouped = assigned.groupBy("document_id", "parent_index").agg(
        F.first("domain").alias("domain"), F.first("source_type").alias("source_type"), F.first("file_name").alias("file_name"),
        F.max("section").alias("_heading"),
        F.sort_array(F.collect_set("page_number")).alias("page_numbers"),
        F.array_join(F.filter(F.sort_array(F.collect_list(item))["text"], lambda t: t != ""), "\n\n").alias("parent_text"),
    )
    titles = heads.select("document_id", F.struct("order", "piece").alias("_heading"), "title", "path")
    return grouped.join(titles, ["document_id", "_heading"], "left").select(
        parent_id(F.col("document_id"), F.col("parent_index")).alias("parent_id"),
        "document_id", "domain", "source_type", F.col("title").alias("section_title"),
        F.coalesce("path", F.array().cast("array<string>")).alias("section_path"),
        "page_numbers", "parent_text",
        F.struct("file_name", F.col("parent_index").alias("section_index")).alias("metadata"),
    )


# ---------------------------------------------------------------- children

TEXT, TABLE, BREAK = 0, 1, 2


def pack(tokens: np.ndarray, kinds: np.ndarray, target: int, overlap: int) -> list[tuple[int, int]]:
    """Ranges ``[lo, hi)`` of the units of each child of one parent.

    A table unit is a child of its own and ends the text run before it. A text child is
    closed when the next unit would pass ``target``; the next child then repeats as many
    whole trailing units as are needed to reach ``overlap`` tokens.
    """
    ranges: list[tuple[int, int]] = []
    lo = None
    total = 0
    for i, (n, kind) in enumerate(zip(tokens, kinds)):
        if kind != TEXT:
            if lo is not None:
                ranges.append((lo, i))
            if kind == TABLE:
                ranges.append((i, i + 1))
            lo, total = None, 0
            continue
        if lo is not None and total + n > target:
            ranges.append((lo, i))
            start, total = i, 0
            while overlap > 0 and start > lo and total < overlap:
                start -= 1
                total += int(tokens[start])
            lo = start
        elif lo is None:
            lo = i
        total += int(n)
    if lo is not None:
        ranges.append((lo, len(tokens)))
    return ranges


def _pack(target: int, overlap: int):
    @F.pandas_udf("array<struct<lo:int,hi:int>>")
    def run(tokens: pd.Series, kinds: pd.Series) -> pd.Series:
        return pd.Series(
            [[{"lo": a, "hi": b} for a, b in pack(t, k, target, overlap)] for t, k in zip(tokens, kinds)]
        )

    return run


def child_chunks(assigned: DataFrame, heads: DataFrame, params: ChunkParams = ChunkParams()) -> DataFrame:
    """Token-bounded children of every parent, with overlap between text children."""
    blank = tx.strip(F.col("text")) == ""
    is_table = F.col("element_type") == "table"
    units = with_pieces(assigned.filter(~blank | is_table), params.max_tokens, params.overlap, "window")
    kind = F.when(is_table & (tx.strip(F.col("text")) == ""), BREAK).when(is_table, TABLE).otherwise(TEXT)
    is_image = F.col("element_type") == "image"
    modality = F.when(is_table, "table").when(is_image, "image").otherwise("text")
    item = F.struct(
        "order", "piece", "window", "tokens", kind.alias("kind"), "text", "page_number", modality.alias("modality"),
        F.when(is_image, F.col("element_id")).alias("ref"),
    )
    packed = (
        units.groupBy("document_id", "parent_index")
        .agg(
            F.first("domain").alias("domain"), F.first("source_type").alias("source_type"),
            F.first("file_name").alias("file_name"), F.max("section").alias("_heading"),
            F.sort_array(F.collect_list(item)).alias("units"),
        )
        .withColumn("ranges", _pack(params.target, params.overlap)(F.col("units.tokens"), F.col("units.kind")))
    )
    rows = packed.select("*", F.posexplode_outer("ranges").alias("chunk_index", "range")).filter("range is not null").withColumn(
        "u", F.slice("units", F.col("range.lo") + 1, F.col("range.hi") - F.col("range.lo"))
    )
    whole = F.array_join("u.text", "\n\n")
    only_table = F.get("u.kind", F.lit(0)) == TABLE
    titles = heads.select("document_id", F.struct("order", "piece").alias("_heading"), F.col("title").alias("section_title"))
    parent = parent_id(F.col("document_id"), F.col("parent_index"))
    return (
        rows.select(
            "document_id", "domain", "source_type", "file_name", "_heading", "chunk_index", parent.alias("parent_id"),
            F.sort_array(F.array_compact(F.array_distinct("u.page_number"))).alias("page_numbers"),
            F.sort_array(F.array_distinct("u.modality")).alias("modalities"),
            F.when(only_table, whole).otherwise(tx.strip(whole)).alias("text_content"),
            F.when(only_table, whole).alias("table_markdown"),
            F.array_compact("u.ref").alias("image_refs"),
        )
        .join(titles, ["document_id", "_heading"], "left")
        .withColumn("chunk_id", uuid5(F.col("parent_id"), F.lit("child"), F.col("chunk_index").cast("string")))
        .drop("_heading")
    )


def resolve_images(children: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``image_paths``: per image reference the first file with that stem, in reference order.

    ``files``: ``domain, slug, path``, one row per image file of a document.
    """
    stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    first = files.withColumn("stem", stem).groupBy("domain", "slug", "stem").agg(F.min("path").alias("path"))
    slug = F.regexp_replace("file_name", r"\.[^./]*$", "")
    refs = children.select("chunk_id", "domain", slug.alias("slug"), F.posexplode("image_refs").alias("at", "ref")).withColumn(
        "stem", F.element_at(F.split("ref", ":"), -1)
    )
    paths = (
        refs.join(first, ["domain", "slug", "stem"])
        .groupBy("chunk_id")
        .agg(F.sort_array(F.collect_list(F.struct("at", "path"))).alias("p"))
        .select("chunk_id", F.col("p.path").alias("image_paths"))
    )
    return children.join(paths, "chunk_id", "left").withColumn(
        "image_paths", F.coalesce("image_paths", F.array().cast("array<string>"))
    )
