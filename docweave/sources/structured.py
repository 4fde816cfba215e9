"""Scan of nested parser outputs: page JSON of PDF and HTML documents, image lists, raw crawls.

A file is one document. It is read with a schema, level by level: the file, its pages, their items stay JSON texts
until their own level is reached, so a bad record is named with its place and nothing else is lost with it. The
readers take ``(path, text)`` rows and give DataFrames; no record ends a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.text import page_of_image
from docweave.sources.discovery import files_match

# What the parsed tree calls its files.
STRUCTURED, IMAGES, RAW_CRAWL = ".structured.json", ".images.json", ".raw.json"

ITEM = "struct<type:string,md:string,value:string,bbox:string>"
IMAGE = "struct<filename:string,category:string,bbox:struct<x:double,y:double,w:double,h:double>>"
ELEMENT = (
    "struct<sequence:int,element_id:string,type:string,text:string,heading_level:int,tag:string,table_html:string,"
    "table_markdown:string,image_url:string,alt_text:string,title:string>"
)
SECTION = f"struct<heading:string,heading_level:int,section_id:string,section_path:array<string>,elements:array<{ELEMENT}>>"
PAGE_FIELDS = "description:string,status_code:string,language:string,links:array<string>,images:array<string>"
HTML_PAGE = f"struct<page_number:int,page_id:string,source_url:string,title:string,{PAGE_FIELDS},sections:array<{SECTION}>>"
METADATA = (
    "struct<sourceURL:string,source_url:string,url:string,title:string,description:string,statusCode:string,"
    "status_code:string,language:string>"
)
CRAWLED = f"struct<html:string,raw_html:string,markdown:string,metadata:{METADATA},links:array<string>,images:array<string>>"

REJECTED = ("path", "page", "item", "error")


def read_files(spark: SparkSession, pattern: str) -> DataFrame:
    """``(path, text)`` of every file of the pattern, without a byte order mark; no file: no rows."""
    if not files_match(spark, pattern):
        return spark.createDataFrame([], "path string, text string")
    files = spark.read.option("wholetext", True).text(pattern)
    return files.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("text"))


def file_key(path: Column, suffix: str) -> tuple[Column, Column]:
    """(domain, name without ``suffix``) of ``.../<domain>/<source type>/<name><suffix>``."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_extract(path, r"([^/]+)/[^/]+/[^/]+$", 1), F.left(name, F.length(name) - len(suffix))


def _object(text: Column, kind: str) -> Column:
    """``text`` as an object of this kind; NULL if it is anything else. Fields of another type are NULL."""
    return F.when(F.ltrim(text).startswith("{"), F.from_json(text, kind))


def _is_object(text: Column) -> Column:
    """Whether :func:`_object` gives an object, if need be without any field; not NULL."""
    return F.coalesce(F.ltrim(text).startswith("{"), F.lit(False))


def _listed(files: DataFrame, field: str) -> DataFrame:
    """``path, json, list, error``: the list ``field`` of every file as texts, or why it has none.

    A file is parsed once: its list is a column of its own, and nothing below it is filtered.
    """
    told = files.select("path", "text", (F.col("text").isNotNull() & F.try_parse_json("text").isNotNull()).alias("json"))
    listed = told.select("path", "json", F.when(F.col("json"), _object(F.col("text"), f"struct<{field}:array<string>>")[field]).alias("list"))
    why = F.when(F.col("json"), F.lit(f"no list of {field}")).otherwise(F.lit("not JSON"))
    return listed.select("path", "list", F.when(F.col("list").isNull(), why).alias("error"))


def _split(files: DataFrame, field: str) -> tuple[DataFrame, DataFrame]:
    """(``path, page, raw`` per entry of the list ``field``, rejected files)."""
    listed = _listed(files, field)
    none = F.lit(None).cast("int")
    bad = listed.filter("error IS NOT NULL").select("path", none.alias("page"), none.alias("item"), "error")
    # An inner generator would filter by the list, and so read it a second time.
    return listed.select("path", F.posexplode_outer("list").alias("page", "raw")).filter("page IS NOT NULL"), bad


def pdf_pages(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Structured PDF outputs -> (``path, page, page_number, items``, rejected).

    ``page`` is the place in the file, from 0; ``items`` are ``struct<type, md, value, bbox>``. ``rejected``: ``path,
    page, item, error``, the levels below a bad file or page NULL. A page needs a whole number; a page without items is
    a page. A first box counts only in a list of boxes. What stands behind the object of a file is ignored.

    A text is parsed once on every level: lists of parsed entries go through outer generators, below which no filter
    is moved, and all bad records of a file come from one pass over it.
    """
    parsed = lambda raw: F.struct(raw.alias("raw"), _object(raw, "struct<page_number:int,items:array<string>>").alias("p"))
    read = _listed(files, "pages").select("path", "error", F.posexplode_outer(F.transform("list", parsed)).alias("page", "e"))
    torn = F.col("e.p.items").isNull() & F.get_json_object("e.raw", "$.items").isNotNull()
    why = F.when(F.col("e.p.page_number").isNull(), "page without page_number").when(torn, "items is no list")
    read = read.select("path", "page", F.col("e.p").alias("p"), F.when(F.col("page").isNull(), F.col("error")).otherwise(why).alias("why"))

    # One list of errors for every file without pages, bad page, and page with bad items.
    loose = F.filter(F.transform("p.items", lambda i, n: F.when(~_is_object(i), n)), lambda n: n.isNotNull())
    none = F.lit(None).cast("int")
    error = lambda item, text: F.struct(item.alias("item"), text.alias("error"))
    items_of = F.transform(loose, lambda n: error(n, F.lit("item is no object")))
    errors = F.when(F.col("why").isNotNull(), F.array(error(none, F.col("why")))).otherwise(items_of)
    bad = read.select("path", "page", F.explode_outer(errors).alias("x")).filter("x IS NOT NULL").select("path", "page", "x.item", "x.error")

    items = F.filter("p.items", _is_object)
    heights = lambda b: F.from_json(b, "array<struct<y:string>>")
    boxes = lambda b: F.when(F.ltrim(b).startswith("["), F.transform(heights(b), lambda x: F.struct(x["y"].try_cast("double").alias("y"))))
    typed = F.transform(
        F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda i: F.from_json(i, ITEM)),
        lambda i: F.struct(i["type"].alias("type"), i["md"].alias("md"), i["value"].alias("value"), boxes(i["bbox"]).alias("bbox")),
    )
    fine = read.filter("page IS NOT NULL AND why IS NULL")
    return fine.select("path", "page", F.col("p.page_number").alias("page_number"), typed.alias("items")), bad


def pdf_images(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Image lists of PDF documents -> (``path, idx, filename, page, x, y, w, h, category``, rejected).

    ``idx`` is the place in the list and goes with an image through every later step. Entries without a file name are
    left out; missing sides of a box are 0, a missing category is ``embedded``.
    """
    top = files.select("path", F.col("text").isNotNull() & F.try_parse_json("text").isNotNull(), F.get_json_object("text", "$.images_content_metadata.images")).toDF("path", "json", "list")
    bad = top.filter("NOT json").select("path", F.lit(None).cast("int").alias("page"), F.lit(None).cast("int").alias("item"), F.lit("not JSON").alias("error"))
    entries = top.filter("json AND list IS NOT NULL").select("path", F.posexplode(F.from_json("list", "array<string>")).alias("idx", "raw"))
    read = entries.select("path", "idx", _object(F.col("raw"), IMAGE).alias("i"))
    loose = read.filter("i IS NULL").select("path", F.lit(None).cast("int").alias("page"), F.col("idx").alias("item"), F.lit("image is no object").alias("error"))
    side = lambda c: F.coalesce(F.col(f"i.bbox.{c}"), F.lit(0.0)).alias(c)
    named = read.filter("i.filename <> ''")
    rows = named.select(
        "path", F.col("idx").cast("bigint").alias("idx"), "i.filename", page_of_image(F.col("i.filename")).alias("page"),
        side("x"), side("y"), side("w"), side("h"), F.coalesce("i.category", F.lit("embedded")).alias("category"),
    )
    return rows, bad.unionByName(loose)


def html_pages(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Structured HTML outputs -> (``path, page_number, page_id, source_url, title, <page fields>, sections``, rejected)."""
    pages, bad_files = _split(files, "pages")
    read = pages.withColumn("p", _object(F.col("raw"), HTML_PAGE))
    bad_pages = read.filter("p IS NULL").select("path", "page", F.lit(None).cast("int").alias("item"), F.lit("page is no object").alias("error"))
    good = read.filter("p IS NOT NULL").select("path", "p.*")
    good = good.withColumn("page_number", F.coalesce("page_number", F.lit(1)))
    return good.withColumn("sections", F.coalesce("sections", F.array().cast(f"array<{SECTION}>"))), bad_files.unionByName(bad_pages)


def crawl_pages(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw crawls (an object with a list ``data``) -> (pages as :func:`docweave.sources.html.extract_pages` takes them, with
    their other fields, rejected). Pages are numbered from 1; the first filled name of a field counts."""
    pages, bad_files = _split(files, "data")
    read = pages.withColumn("p", _object(F.col("raw"), CRAWLED))
    bad_pages = read.filter("p IS NULL").select("path", "page", F.lit(None).cast("int").alias("item"), F.lit("page is no object").alias("error"))
    filled = lambda *names: F.coalesce(*(F.nullif(F.col(f"p.{n}"), F.lit("")) for n in names))
    listed = lambda name: F.coalesce(F.col(f"p.{name}"), F.array().cast("array<string>")).alias(name)
    good = read.filter("p IS NOT NULL").select(
        "path", (F.col("page") + 1).alias("page_number"), F.coalesce(filled("html", "raw_html"), F.lit("")).alias("html"),
        F.coalesce(filled("metadata.sourceURL", "metadata.source_url", "metadata.url"), F.lit("")).alias("url"), filled("metadata.title").alias("title"),
        F.coalesce("p.markdown", F.lit("")).alias("markdown"), F.col("p.metadata.description").alias("description"),
        filled("metadata.statusCode", "metadata.status_code").alias("status_code"), F.col("p.metadata.language").alias("language"),
        listed("links"), listed("images"),
    )
    empty = files.join(pages.select("path").distinct(), "path", "left_anti").join(bad_files.select("path"), "path", "left_anti")
    none = empty.select("path", F.lit(None).cast("int").alias("page"), F.lit(None).cast("int").alias("item"), F.lit("the crawl returned no pages").alias("error"))
    return good, bad_files.unionByName(bad_pages).unionByName(none)


def first_errors(rejected: DataFrame, key: str = "path") -> DataFrame:
    """``(key, error, records)``: the first bad record of every document, with its place, and how many there are."""
    at = F.struct(F.coalesce("page", F.lit(-1)).alias("page"), F.coalesce("item", F.lit(-1)).alias("item"), "error")
    found = rejected.groupBy(key).agg(F.min(at).alias("e"), F.count(F.lit(1)).alias("records"))
    place = F.concat_ws(
        ", ", F.when(F.col("e.page") >= 0, F.concat(F.lit("page "), (F.col("e.page") + 1).cast("string"))),
        F.when(F.col("e.item") >= 0, F.concat(F.lit("item "), (F.col("e.item") + 1).cast("string"))),
    )
    return found.select(key, F.concat(F.when(place != "", F.concat(place, F.lit(": "))).otherwise(""), F.col("e.error")).alias("error"), "records")
