"""Normalization: parsed sources -> one ordered element stream per document.

Elements: ``element_id, document_id, domain, element_type, text, source_type,
page_number, order``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.functions.ids import serial
from docweave.operators.ordered import running
from docweave.session import stage_table
from docweave.settings import DEFAULTS

# Item types with retrievable content, and those that count as running text.
CONTENT_TYPES = ("heading", "text", "list", "table", "code")
TEXT_TYPES = ("text", "list", "code")
# The domains and source types a document may have.
DOMAINS = ("legal", "finance", "medical")
SOURCE_TYPES = ("pdf", "html", "csv")


def item_text(item: Column) -> Column:
    """Markdown of an item, else its value, with collapsed whitespace."""
    return tx.clean(F.coalesce(F.nullif(item["md"], F.lit("")), item["value"]))


def item_y(item: Column) -> Column:
    return F.coalesce(F.get(item["bbox"], F.lit(0))["y"].cast("double"), F.lit(0.0))


def pdf_content(documents: DataFrame) -> DataFrame:
    """Content items of ``pages: array<struct<page_number, items: array<...>>>``, in item order.

    Gives ``document_id, domain, page, page_number, idx, element_type, text, y``; ``idx`` counts the kept
    items of a page.
    """
    pages = documents.select("document_id", "domain", F.posexplode_outer("pages").alias("page", "p"))
    return page_content(pages.select("document_id", "domain", "page", "p.page_number", "p.items"))


def page_content(pages: DataFrame) -> DataFrame:
    """As :func:`pdf_content`, from one row per page: ``document_id, domain, page, page_number, items``."""
    kept = F.filter("items", lambda i: i["type"].isin(*CONTENT_TYPES) & (item_text(i) != ""))
    items = pages.select("document_id", "domain", "page", "page_number", F.posexplode_outer(kept).alias("idx", "item"))
    return items.filter("item IS NOT NULL").select(
        "document_id", "domain", "page", "page_number", "idx", F.col("item.type").alias("element_type"),
        item_text(F.col("item")).alias("text"), item_y(F.col("item")).alias("y"),
    )


def image_context(content: DataFrame, images: DataFrame) -> DataFrame:
    """Images with ``below`` (content items above them) and their textual surroundings.

    Section title and text before come from the last such item at or above the image, text
    after from the first item below it, both in item order. A table counts only when it is
    the very last item above, else the very first below. The items of a page come from one
    row of its document, so a page is sorted as a whole: items and images go through one
    shuffle, and all of this is a running maximum or minimum over their heights.
    """
    keys = ["document_id", "page"]
    picture = F.struct(*(F.col(c) for c in images.columns))
    is_text = F.col("element_type").isin(*TEXT_TYPES)
    item, typed = F.struct("idx", "text"), F.struct("idx", "element_type", "text")
    items = content.select(*keys, "y", F.lit(None).cast(images.select(picture.alias("i")).schema["i"].dataType).alias("_i"), "idx", "element_type", "text")
    spots = images.select(
        *keys, "y", picture.alias("_i"),
        *(F.lit(None).cast(content.schema[c].dataType).alias(c) for c in ("idx", "element_type", "text")),
    )
    rows = items.unionByName(spots).repartition(*keys)
    is_item = F.col("_i").isNull()
    # Rows of one height are peers of this frame; at one height, images come before items in the other.
    above = Window.partitionBy(*keys).orderBy("y").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    level = Window.partitionBy(*keys, "y")
    under = Window.partitionBy(*keys).orderBy(F.col("y").desc(), is_item).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select(
        *keys, "y", "_i", "idx", "element_type", "text",
        (F.count_if(is_item).over(above) - F.count_if(is_item).over(level)).alias("below"),
        F.max(F.when(F.col("element_type") == "heading", item)).over(above).alias("_h"),
        F.max(F.when(is_text, item)).over(above).alias("_b"),
        F.max(F.when(is_item, typed)).over(above).alias("_l"),
    )
    seen = placed.select(
        "*", F.min(F.when(is_text, item)).over(under).alias("_a"), F.min(F.when(is_item, typed)).over(under).alias("_f")
    ).filter(~is_item)
    known = F.col("_i.document_id").isNotNull() & F.col("_i.page").isNotNull() & F.col("_i.y").isNotNull()
    text = lambda c: F.coalesce(F.when(known, F.col(f"{c}.text")), F.lit(""))
    table = F.when(F.col("_l.element_type") == "table", F.col("_l.text")).when(F.col("_f.element_type") == "table", F.col("_f.text"))
    return seen.select(
        "_i.*", F.when(known, F.col("below")).otherwise(F.lit(0)).cast("bigint").alias("below"),
        text("_h").alias("section_title"), text("_b").alias("nearby_text_before"),
        text("_a").alias("nearby_text_after"), F.when(known, table).alias("nearby_table_markdown"),
    )


def on_pages(images: DataFrame, pages: DataFrame) -> DataFrame:
    """``images`` (``document_id``, ``page`` as the number in their name) with ``domain``, ``page_number`` and ``page``, the place
    of their page in the document. The page list drives: a page without any content keeps its images, and an image whose
    number no page has is left out."""
    places = pages.select("document_id", "domain", "page", "page_number")
    return images.withColumnRenamed("page", "page_number").join(places, ["document_id", "page_number"])


def context_fields() -> dict[str, Column]:
    return {c: F.col(c) for c in ("section_title", "nearby_text_before", "nearby_text_after", "nearby_table_markdown")}


def page_order(content: DataFrame, images: DataFrame, block_rows: int = DEFAULTS.block_rows) -> DataFrame:
    """Content and images of every document in reading order, with ``order`` from 0.

    An image stands before the content item whose index equals its ``below``; images at the
    same place go by (y, x) and then by ``idx``, their place in the parser's list. ``images`` need ``document_id, domain,
    page, page_number, below, x, y, idx, filename, text``; a page of theirs may have no content.
    """
    items = content.select(
        "document_id", "domain", "page", "page_number", F.col("idx").cast("bigint").alias("slot"), F.lit(1).alias("kind"),
        F.lit(0.0).alias("y"), F.lit(0.0).alias("x"), F.lit(0).cast("bigint").alias("listed"), F.lit("").alias("filename"), "element_type", "text",
    )
    pictures = images.select(
        "document_id", "domain", "page", "page_number", F.col("below").cast("bigint").alias("slot"), F.lit(0).alias("kind"),
        "y", "x", F.col("idx").cast("bigint").alias("listed"), "filename", F.lit("image").alias("element_type"), "text",
    )
    rows = items.unionByName(pictures)
    # The items of a page come from one row of its document, so a page is one group.
    on_page = Window.partitionBy("document_id", "page").orderBy("slot", "kind", "y", "x", "listed")
    placed = rows.withColumn("at", F.row_number().over(on_page).cast("bigint"))
    sizes = rows.groupBy("document_id", "page").agg(F.count(F.lit(1)).alias("n"))
    starts = running(
        sizes, ["document_id"], F.floor(F.col("page") / block_rows), ["page"], {"start": ("sum", F.col("n"))}, inclusive=False
    ).select("document_id", "page", "start")
    ordered = placed.join(starts, ["document_id", "page"])
    return ordered.withColumn("order", F.col("start") + F.col("at") - 1).drop("at", "start")


def normalize_pdf(content: DataFrame, images: DataFrame, block_rows: int = DEFAULTS.block_rows) -> DataFrame:
    ordered = page_order(content, stage_table(images), block_rows)
    stem = F.regexp_replace("filename", r"\.[^./]*$", "")
    name = F.when(F.col("element_type") == "image", stem).otherwise(serial(F.col("order")))
    element_id = F.concat("document_id", F.lit(":p"), F.col("page_number").cast("string"), F.lit(":"), name)
    return ordered.select(
        element_id.alias("element_id"), "document_id", "domain", "element_type", "text", F.lit("pdf").alias("source_type"),
        F.col("page_number").cast("int").alias("page_number"), "order",
    )


def normalize_html(pages: DataFrame, block_rows: int = DEFAULTS.block_rows) -> DataFrame:
    """Flatten page rows ``document_id, domain, page_number, sections: array<struct<heading, heading_level, elements>>``.

    A page's stream is built inside its row. A section heading of level 1 or more comes
    before its elements, which are sorted by ``sequence``; elements without text are left
    out. The order continues over the pages of a document.
    """
    entry = lambda kind, text: F.struct(kind.alias("element_type"), text.alias("text"))

    def section(s: Column) -> Column:
        heading = tx.clean(s["heading"])
        shown = (heading != "") & (F.coalesce(s["heading_level"], F.lit(0)) >= 1)
        elements = F.transform(
            s["elements"], lambda e, i: F.struct(F.coalesce(e["sequence"], F.lit(0)).alias("q"), i.alias("i"), e["type"].alias("t"), tx.clean(e["text"]).alias("x"))
        )
        kept = F.filter(F.sort_array(elements), lambda e: e["x"] != "")
        listed = F.transform(kept, lambda e: entry(F.coalesce(e["t"], F.lit("text")), e["x"]))
        return F.when(shown, F.concat(F.array(entry(F.lit("heading"), heading)), listed)).otherwise(listed)

    number = F.coalesce(F.col("page_number").cast("int"), F.lit(1))
    streams = pages.select("document_id", "domain", number.alias("page_number"), F.flatten(F.transform("sections", section)).alias("stream"))
    sizes = streams.select("document_id", "page_number", F.size("stream").alias("n"))
    starts = running(
        sizes, ["document_id"], F.floor(F.col("page_number") / block_rows), ["page_number"], {"start": ("sum", F.col("n"))}, inclusive=False
    ).select("document_id", "page_number", "start")
    rows = streams.select("document_id", "domain", "page_number", F.posexplode_outer("stream").alias("at", "e")).filter("e IS NOT NULL")
    order = F.col("start") + F.col("at")
    element_id = F.concat("document_id", F.lit(":p"), F.col("page_number").cast("string"), F.lit(":"), serial(order))
    return rows.join(starts, ["document_id", "page_number"]).select(
        element_id.alias("element_id"), "document_id", "domain", "e.element_type", "e.text", F.lit("html").alias("source_type"),
        "page_number", order.cast("bigint").alias("order"),
    )


def normalize_records(records: DataFrame, block_rows: int = DEFAULTS.block_rows) -> DataFrame:
    """Rollup records as elements; order by file name, then position in the file.

    ``records``: ``document_id, domain, file_name, line, retrieval_text``. Files per document
    are few; a file is cut into blocks of lines.
    """
    kept = records.withColumn("text", tx.clean(F.col("retrieval_text"))).filter("text <> ''")
    block = F.struct(F.col("file_name"), F.floor(F.col("line") / block_rows).alias("n"))
    counted = running(kept, ["document_id"], block, ["file_name", "line"], {"at": ("sum", F.lit(1).cast("bigint"))})
    order = F.col("at") - 1
    return counted.select(
        F.concat("document_id", F.lit(":"), serial(order)).alias("element_id"), "document_id", "domain",
        F.lit("record").alias("element_type"), "text", F.lit("csv").alias("source_type"),
        F.lit(None).cast("int").alias("page_number"), order.alias("order"),
    )


def check_values(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """``df`` unchanged; a value outside ``allowed`` raises when the row is read."""
    message = F.raise_error(F.concat(F.lit(f"Unsupported {column}: "), F.coalesce(F.col(column), F.lit("NULL"))))
    return df.withColumn(column, F.when(F.col(column).isin(*allowed), F.col(column)).otherwise(message.cast("string")))


def element_counts(elements: DataFrame) -> DataFrame:
    return elements.groupBy("domain", "source_type", "document_id").agg(F.count(F.lit(1)).alias("elements"))
