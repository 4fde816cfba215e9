"""HTML pages -> ordered content elements.

The parser only turns one page's markup into a flat element list; identifiers, sections,
filters and ordering are Spark expressions on that list.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.ids import uuid5
from docweave.operators.ordered import running

# The tags that carry content, and those whose inner tags are not told apart.
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
CONTENT = (*HEADINGS, "p", "ul", "ol", "table", "img", "blockquote", "pre")
NESTING = ("table", "ul", "ol", "blockquote", "pre")
DROPPED = ("script", "style", "noscript", "template")
# Fixed values of HTML: tags without an end tag, tags that end a paragraph, implied end tags.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
ENDS_P = (*HEADINGS, "p", "ul", "ol", "table", "blockquote", "pre", "div", "section", "article", "header", "footer", "nav", "form", "hr", "dl")
IMPLIED = {"li": ("li",), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
SCOPES = ("table", "ul", "ol", "dl")

# What a crawl tells about a page besides its markup; a missing column is NULL, a missing list is empty.
PAGE_FIELDS = {"description": "string", "status_code": "string", "language": "string", "links": "array<string>", "images": "array<string>"}

# Sections of one page that are scanned together.
BLOCK_SECTIONS = 512

ELEMENT = (
    "array<struct<sequence:int,tag:string,text:string,table_html:string,table_markdown:string,"
    "image_url:string,alt_text:string,title:string>>"
)


class _Tokens(HTMLParser):
    """Markup as ``parts``: text, tag, text, tag, ..., text, and ``marks``, a mark for every tag (see :func:`_mark`)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.marks, self.attrs = [""], [], {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "img":
            self.attrs[len(self.parts)] = dict(attrs)
        self._tag(tag if tag in _RAW else f"<{tag}>", self.get_starttag_text() or "")

    def handle_endtag(self, tag: str) -> None:
        self._tag(f"</{tag}>", f"</{tag}>")

    def handle_data(self, data: str) -> None:
        if self.parts[-1]:
            self._tag("", "")  # two texts in a row stay two
        self.parts[-1] = data

    def _tag(self, mark: str, markup: str) -> None:
        self.marks.append(mark)
        self.parts += (markup, "")


_SPACE, _QUOTED = r"[ \t\n\r\f]", r"[a-zA-Z][-a-zA-Z0-9]*=(?:\"[^\"<>]*\"|'[^'<>]*')"
_TAG, _PLAIN_TAG = re.compile("(<[^<>]*>)"), re.compile(rf"</([a-zA-Z][a-zA-Z0-9]*)>|<([a-zA-Z][a-zA-Z0-9]*)(?:{_SPACE}+{_QUOTED})*{_SPACE}*(/?)>")
_ATTRIBUTE = re.compile(r"([a-zA-Z][-a-zA-Z0-9]*)=(\"[^\"]*\"|'[^']*')")
# Tags that the library may read text after, not markup, in this version or a later one; their start has no ``<`` in its mark.
_RAW = {*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "noscript", "plaintext"}


def _plain_parts(html: str) -> list[str] | None:
    """``parts`` of a page if every ``<`` has its ``>``, else None. They hold if all tags are plain (:func:`_plain_mark`)."""
    parts = _TAG.split(html)
    if html.count("<") != len(parts) // 2:
        return None
    if "&" in html:
        for at in range(0, len(parts), 2):
            if "&" in parts[at]:
                parts[at] = unescape(parts[at])
    return parts


def _plain_mark(markup: str) -> str | None:
    """The mark of a plain tag: ``<tag>``, ``</tag>``, or ``tag/`` if it starts and ends; None if the library has to read it.

    A plain tag has a name of letters and digits and quoted attributes without angle brackets, so its first ``>`` ends it.
    """
    plain = _PLAIN_TAG.fullmatch(markup)
    if plain is None:
        return None
    if plain[1]:
        return f"</{plain[1].lower()}>"
    name = plain[2].lower()
    if name in _RAW or name == "img" and "&" in markup or plain[3] and name in DROPPED:
        return None
    return f"{name}/" if plain[3] else f"<{name}>"


class _Open(dict):
    """The tags open at a place of a page, as a tree: equal ones are one object, which keeps what each tag does there.

    Mark of a tag -> ``(what is open after it, None or (how many texts end with it, what begins, what is muted))``. What
    begins is an ``_ELEMENT``, ``_ROW`` or ``_CELL``, negative if it also ends there.
    """

    __slots__ = ("tag", "up", "muted", "nested", "table", "has_p", "text", "down")
    learned = 0

    def __init__(self, tag: str, up: _Open | None, muted: bool = False, text: bool = False):
        self.tag, self.up, self.muted, self.text, self.down = tag, up, muted, text, {}
        self.nested = up is not None and (up.nested or tag in NESTING)
        # Tables nest, so no more than one is an element.
        self.table = up is not None and (up.table or tag == "table" and not up.nested)
        self.has_p = up is not None and (up.has_p or tag == "p")

    def __missing__(self, mark: str) -> tuple:
        return self, _UNKNOWN

    def learn(self, mark: str) -> tuple:
        if mark not in self:
            _Open.learned += 1
            then, ended, begins = self._step(mark)
            muted = _MUTED if then.muted else _TAG_MUTED if self.muted else 0
            self[mark] = then, (ended, begins, muted) if ended or begins or muted else None
        return self[mark]

    def _step(self, mark: str) -> tuple[_Open, int, int]:
        if not mark:
            return self, 0, 0
        if mark.startswith("</"):
            return *self._ended(mark[2:-1]), 0
        tag = mark[1:-1] if mark[0] == "<" else mark.removesuffix("/")
        now, ended, begins = self._started(tag)
        if mark[-1] == "/" and not self.muted and tag not in VOID:
            return now.up, ended, begins if begins == _ROW else -begins
        return now, ended, -begins if tag in VOID else begins

    def _started(self, tag: str) -> tuple[_Open, int, int]:
        if tag in DROPPED:
            return self._with(tag, muted=True), 0, 0
        if self.muted:
            return self, 0, 0
        now, ended = self, 0
        if tag in ENDS_P and self.has_p:
            now, ended = now._closed("p")
        for name in IMPLIED.get(tag, ()):
            now, more = now._closed(name, SCOPES)
            ended += more
        begins = 0
        if tag in HEADINGS or tag in CONTENT and not now.nested:
            begins = _ELEMENT
        elif tag == "tr" and now.table:
            begins = _ROW
        elif tag in ("td", "th") and now.table and now.tag == "tr":
            begins = _CELL
        return now if tag in VOID else now._with(tag, text=begins in (_ELEMENT, _CELL)), ended, begins

    def _ended(self, tag: str) -> tuple[_Open, int]:
        if self.muted:
            return self.up if tag == self.tag else self, 0
        return self._closed(tag)

    def _with(self, tag: str, muted: bool = False, text: bool = False) -> _Open:
        if tag not in self.down:
            self.down[tag] = _Open(tag, self, muted, text)
        return self.down[tag]

    def _closed(self, tag: str, scopes: tuple[str, ...] = ()) -> tuple[_Open, int]:
        at, ended = self, 0
        while at.up is not None:
            ended += at.text
            if at.tag == tag:
                return at.up, ended
            if at.tag in scopes:
                break
            at = at.up
        return self, 0


_UNKNOWN, _ELEMENT, _ROW, _CELL, _TAG_MUTED, _MUTED = (0, 0, 0), 1, 2, 3, 1, 2
_NOTHING_OPEN = _Open("", None)
# Steps that a worker keeps; it starts anew with a page when it has more.
MOST_STEPS = 20_000


def _nothing_open() -> _Open:
    global _NOTHING_OPEN
    if _Open.learned > MOST_STEPS:
        _NOTHING_OPEN, _Open.learned = _Open("", None), 0
    return _NOTHING_OPEN


def _read(html: str) -> tuple[list[str], dict[int, dict], list[list]]:
    """``parts``, the attributes of images that the library read, and the elements (see :func:`_walk`)."""
    parts = _plain_parts(html)
    elements = None if parts is None else _walk(parts, parts[1::2], plain=True)
    if elements is not None:
        return parts, {}, elements
    tokens = _Tokens()
    tokens.feed(html)
    tokens.close()
    return tokens.parts, tokens.attrs, _walk(tokens.parts, tokens.marks)


def _walk(parts: list[str], marks: list[str], plain: bool = False) -> list[list] | None:
    """Elements ``[place of the tag, place where its texts end, tag, rows of cells]``, a cell being two places as well.

    What is muted becomes empty. With ``plain`` the marks are the tags as written; None if one calls for the library.
    """
    elements, live, rows = [], [], []
    now = _nothing_open()
    for at, mark in zip(range(1, len(parts), 2), marks):
        now, does = now[mark]
        if does is None:
            continue
        if does is _UNKNOWN:
            if plain:
                markup, mark = mark, _plain_mark(mark)
                if mark is None:
                    return None
                if mark[-1] == "/":
                    parts[at] = f"{markup}</{mark[:-1]}>"
                elif mark[1] == "/":
                    parts[at] = mark
            now, does = now.learn(mark)
            if does is None:
                continue
        ended, begins, muted = does
        while ended:
            live.pop()[1] = at
            ended -= 1
        if begins:
            if begins == _ROW:
                rows.append([])
            else:
                span = [at, at]
                if begins == _CELL or begins == -_CELL:
                    rows[-1].append(span)
                else:
                    tag = mark.strip("</>")
                    if tag == "table":
                        rows = []
                    span += (tag, rows)
                    elements.append(span)
                if begins > 0:
                    live.append(span)
        if muted:
            parts[at] = ""
            if muted == _MUTED:
                parts[at + 1] = ""
    for span in live:
        span[1] = len(parts)
    return elements


def _markdown(rows: list[list[str]]) -> str:
    width = max(map(len, rows), default=0)
    lines = [" | ".join(r if len(r) == width else r + [""] * (width - len(r))) for r in rows]
    if lines:
        lines.insert(1, " | ".join(["---"] * width))
    return "| " + " |\n| ".join(lines) + " |" if lines else ""


def parse_elements(html: str | None, url: str | None) -> list[tuple]:
    """Content elements of a page in document order, with the fields of ``ELEMENT``; text goes to every open one."""
    parts, attrs, elements = _read(html or "")
    found = []
    for number, (start, end, tag, rows) in enumerate(elements, 1):
        text = " ".join(" ".join(parts[start + 1 : end : 2]).split())
        if tag == "table":
            # Most cells are a single text.
            cells = [
                [" ".join((parts[a + 1] if z == a + 2 else " ".join(parts[a + 1 : z : 2])).split()).replace("|", r"\|") for a, z in row]
                for row in rows if row
            ]
            found.append((number, tag, text, "".join(parts[start : end + 1]), _markdown(cells), None, None, None))
        elif tag == "img":
            own = attrs[start] if start in attrs else {name.lower(): value[1:-1] for name, value in _ATTRIBUTE.findall(parts[start])}
            source = own.get("src")
            alt, title = (" ".join((own.get(name) or "").split()) for name in ("alt", "title"))
            found.append((number, tag, text, None, None, urljoin(url or "", source) if source else None, alt, title))
        else:
            found.append((number, tag, text, None, None, None, None, None))
    return found


PARSED = f"struct<found:{ELEMENT},error:string>"
_FIELDS = [("sequence", pa.int32()), *((name, pa.string()) for name in ("tag", "text", "table_html", "table_markdown", "image_url", "alt_text", "title"))]
PARSED_ARROW = pa.struct([("found", pa.list_(pa.struct(_FIELDS))), ("error", pa.string())])
# Pages whose elements are Python objects at a time.
PARSE_PAGES = 64


def _parsed(html: str | None, url: str | None) -> tuple[list[tuple], str | None]:
    """Elements of a page, or why it has none; a page that the parser can't take doesn't end the job."""
    try:
        return parse_elements(html, url), None
    except Exception as error:  # noqa: BLE001 - whatever the markup makes the parser raise
        return [], f"{type(error).__name__}: {error}"


def _parsed_array(pages: list[tuple[list[tuple], str | None]]) -> pa.Array:
    """Parsed pages as ``PARSED_ARROW``, column by column: nothing is looked up by name."""
    nothing = [()] * len(_FIELDS)
    columns = zip(*(zip(*found) if found else nothing for found, _ in pages))
    lists = [pa.array(values, pa.list_(kind)) for values, (_, kind) in zip(columns, _FIELDS)]
    elements = pa.StructArray.from_arrays([column.values for column in lists], fields=[pa.field(*field) for field in _FIELDS])
    found = pa.ListArray.from_arrays(lists[0].offsets, elements, type=PARSED_ARROW.field("found").type)
    return pa.StructArray.from_arrays([found, pa.array([error for _, error in pages], pa.string())], fields=list(PARSED_ARROW))


def _parse():
    @F.arrow_udf(PARSED)
    def run(html: pa.Array, url: pa.Array) -> pa.Array:
        parts = [pa.array([], PARSED_ARROW)]
        for at in range(0, len(html), PARSE_PAGES):
            pairs = zip(html.slice(at, PARSE_PAGES).to_pylist(), url.slice(at, PARSE_PAGES).to_pylist())
            parts.append(_parsed_array([_parsed(h, u) for h, u in pairs]))
        return pa.concat_arrays(parts)

    # Keeps a filter on the result from calling the parser a second time.
    return run.asNondeterministic()


def page_rows(pages: DataFrame) -> DataFrame:
    """Crawled pages with their ``page_id``, source url and title; other columns stay."""
    url, title = F.coalesce("url", F.lit("")), F.coalesce(F.nullif(F.col("title"), F.lit("")), F.concat(F.lit("Crawled page "), F.col("page_number").cast("string")))
    return pages.select(
        "*", url.alias("source_url"), title.alias("page_title"),
        uuid5(F.coalesce(F.nullif(url, F.lit("")), title), F.col("page_number").cast("string")).alias("page_id"),
    )


def parsed_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with ``page_id``, ``found`` (their content elements) and ``error`` (NULL unless the parser gave up)."""
    return page_rows(pages).withColumn("_p", _parse()(F.col("html"), F.col("url"))).select("*", "_p.found", "_p.error").drop("_p")


def extract_pages(pages: DataFrame) -> DataFrame:
    """``document_id, page_number, html, url, title`` -> one row per content element with its section."""
    return page_elements(parsed_pages(pages))


def page_elements(parsed: DataFrame) -> DataFrame:
    """Content elements of :func:`parsed_pages`, one row each.

    Elements without text (and images without source) are dropped but keep their sequence number.
    A heading opens a section; what comes before belongs to the page's root section.
    """
    named = parsed.select("document_id", "page_number", "source_url", "page_title", "page_id", "found")
    rows = named.select("document_id", "page_number", "source_url", "page_title", "page_id", F.explode_outer("found").alias("e"))
    kept = rows.filter((F.col("e.text") != "") | F.col("e.image_url").isNotNull())
    is_heading = F.col("tag").isin(*HEADINGS)
    kind = F.when(is_heading, "heading").when(F.col("tag") == "table", "table").when(F.col("tag") == "img", "image").otherwise("text")
    return kept.select("document_id", "page_number", "source_url", "page_title", "page_id", "e.*").select(
        "*", uuid5(F.col("page_id"), F.col("sequence").cast("string"), F.col("tag")).alias("element_id"), kind.alias("type"),
        F.when(is_heading, F.substring("tag", 2, 1).cast("int")).alias("heading_level"),
    )


def structured_pages(elements: DataFrame) -> DataFrame:
    """Elements of :func:`extract_pages` nested as sections -> elements, one row per page.

    A page is one row of input, so its elements fit an array again. Pages of a document
    stay separate rows, because a crawl can hold any number of them.
    """
    item = F.struct("sequence", "element_id", "type", "text", "heading_level", "tag", "table_html", "table_markdown", "image_url", "alt_text", "title")
    by_page = elements.groupBy("document_id", "page_number", "page_id", "source_url", "page_title").agg(
        F.sort_array(F.collect_list(item)).alias("elements")
    )
    # Positions where sections start: the page head and every heading.
    starts = F.expr("filter(sequence(0, size(elements) - 1), i -> i = 0 OR elements[i].type = 'heading')")
    cut = by_page.withColumn("starts", starts).select("*", F.posexplode_outer("starts").alias("nth", "at"))
    until = F.coalesce(F.get("starts", F.col("nth") + 1), F.size("elements"))
    sections = cut.select(
        "document_id", "page_number", "page_id", "source_url", "page_title", "nth",
        F.slice("elements", F.col("at") + 1, until - F.col("at")).alias("elements"),
    ).withColumn("head", F.when(F.get("elements", F.lit(0))["type"] == "heading", F.get("elements", F.lit(0))))
    named = sections.select(
        "document_id", "page_number", "page_id", "source_url", "page_title", "nth", "elements",
        F.coalesce("head.text", "page_title").alias("heading"), F.coalesce("head.heading_level", F.lit(0)).alias("heading_level"),
        F.when(F.col("head").isNull(), uuid5(F.col("page_id"), F.lit("root")))
        .otherwise(uuid5(F.col("page_id"), F.col("head.sequence").cast("string"), F.col("head.text"))).alias("section_id"),
    )
    section = F.struct("nth", "heading", "heading_level", "section_id", "section_path", "elements")
    return section_paths(named).groupBy("document_id", "page_number", "page_id", "source_url", F.col("page_title").alias("title")).agg(
        F.sort_array(F.collect_list(section)).alias("sections")
    )


def section_paths(sections: DataFrame, keys: tuple[str, ...] = ("document_id", "page_number", "page_id"), block: int = BLOCK_SECTIONS) -> DataFrame:
    """``sections`` (``keys, nth, heading, heading_level``) with ``section_path``: the headings a section stands under, and its own.

    A heading ends all earlier ones of its level or below, whatever levels are skipped. So the one of a level that still
    holds is the last of that level, if none of a higher level came after it. The last heading per level is a running
    maximum, which joins over blocks of sections; no page is walked heading by heading. A section of level 0 is the
    page itself and stands under nothing.
    """
    levels = range(1, len(HEADINGS) + 1)
    here = F.struct("nth", "heading")
    last = {f"_h{n}": ("max", F.when(F.col("heading_level") == n, here)) for n in levels}
    seen = running(sections, list(keys), F.floor(F.col("nth") / block), ["nth"], last)
    place = lambda n: F.coalesce(F.col(f"_h{n}.nth"), F.lit(-1))
    holds = lambda n: F.greatest(F.lit(-1), *(place(m) for m in range(1, n)), F.lit(-1)) < place(n)
    path = F.array(*(F.when((F.col("heading_level") >= n) & holds(n), F.col(f"_h{n}.heading")) for n in levels))
    path = F.when(F.col("heading_level") == 0, F.array("heading")).otherwise(F.array_compact(path))
    return seen.withColumn("section_path", path).drop(*last)


def all_pages(pages: DataFrame, structured: DataFrame) -> DataFrame:
    """``structured`` with ``PAGE_FIELDS``, and a row, without sections, for every crawled page that has no content element."""
    key = ["document_id", "page_number", "page_id", "source_url", "title"]
    field = lambda c, kind: F.col(c).cast(kind) if c in pages.columns else F.lit(None).cast(kind)
    filled = lambda c, kind: F.coalesce(field(c, kind), F.array().cast(kind)) if kind.startswith("array") else field(c, kind)
    named = (pages if "page_id" in pages.columns else page_rows(pages)).withColumn("title", F.col("page_title"))
    fields = F.struct(*(filled(c, kind).alias(c) for c, kind in PAGE_FIELDS.items()))
    # A page listed twice is one page.
    every = named.select(*key, fields.alias("_f")).groupBy(*key).agg(F.max("_f").alias("_f")).select(*key, "_f.*")
    kind = structured.schema["sections"].dataType
    return every.join(structured, key, "left").withColumn("sections", F.coalesce("sections", F.array().cast(kind)))


def combined_markdown(pages: DataFrame) -> DataFrame:
    """All pages of a document as one markdown text, in page order."""
    block = F.concat(
        F.lit("# Crawled Page "), F.col("page_number").cast("string"), F.lit("\nSource URL: "), F.coalesce("url", F.lit("")),
        F.lit("\n\n"), F.coalesce("markdown", F.lit("")),
    )
    return joined_pages(pages.select("document_id", "page_number", block.alias("block")))


def pdf_markdown(pages: DataFrame) -> DataFrame:
    """Non-empty pages of a parsed document as one markdown text."""
    block = F.concat(F.lit("<!-- Page "), F.col("page_number").cast("string"), F.lit(" -->\n\n"), F.col("markdown"))
    kept = pages.filter(F.coalesce("markdown", F.lit("")) != "")
    return joined_pages(kept.select("document_id", "page_number", block.alias("block")))


def joined_pages(blocks: DataFrame, block_pages: int = 1000) -> DataFrame:
    """Page texts of a document in page order; runs of pages are joined first, by many tasks."""
    rule = "\n\n---\n\n"
    run = F.floor(F.col("page_number") / block_pages)
    page = F.sort_array(F.collect_list(F.struct("page_number", "block")))
    runs = blocks.groupBy("document_id", run.alias("run")).agg(F.array_join(page["block"], rule).alias("block"))
    ordered = F.sort_array(F.collect_list(F.struct("run", "block")))
    return runs.groupBy("document_id").agg(F.array_join(ordered["block"], rule).alias("markdown"))


def crawl_counts(structured: DataFrame) -> DataFrame:
    return structured.groupBy("document_id").agg(
        F.count(F.lit(1)).alias("page_count"), F.sum(F.size("sections")).alias("section_count")
    )
