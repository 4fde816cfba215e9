"""Text expressions: whitespace, headings, tokens, windows, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python treats as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java pattern.
SPACE = r"(?U)[\s\x1c-\x1f]"


def clean(col: Column) -> Column:
    """Collapse whitespace runs to one blank and trim; NULL becomes ''."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), SPACE + "+", " "))


def strip(col: Column) -> Column:
    """Drop whitespace at both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def clean_value(col: Column) -> Column:
    """Stripped value, NULL when nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def heading_level(text: Column) -> Column:
    """Number of leading # marks (1 to 6) before a blank, else 1."""
    return F.greatest(F.length(F.regexp_extract(text, rf"^(#{{1,6}}){SPACE}", 1)), F.lit(1))


def clean_title(text: Column) -> Column:
    return strip(F.regexp_replace(text, "^#+", ""))


def words(text: Column) -> Column:
    """Offline tokenizer: the whitespace-separated words of the text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def token_count(text: Column) -> Column:
    return F.size(words(text))


def token_windows(tokens: Column, size: int, overlap: int) -> Column:
    """Overlapping windows over a token array, each joined by blanks.

    ``tokens`` must be a stored column, because the lambda reads it once per window.
    """
    step = max(size - overlap, 1)
    starts = F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)), F.lit(step))
    return F.transform(starts, lambda s: F.array_join(F.slice(tokens, s, F.lit(size)), " "))


def text_pieces(text: Column, tokens: Column, size: int, overlap: int) -> Column:
    """The text itself when it fits, else its token windows."""
    return F.when(F.size(tokens) <= size, F.array(text)).otherwise(token_windows(tokens, size, overlap))


def strip_citations(answer: Column) -> Column:
    """Remove inline [n] markers with the blanks before them."""
    return strip(F.regexp_replace(answer, rf"{SPACE}*\[\d+\]", ""))


def markdown_cell(col: Column) -> Column:
    escaped = F.replace(F.coalesce(clean_value(col), F.lit("")), F.lit("|"), F.lit("\\|"))
    return F.translate(escaped, "\r\n", "  ")


def markdown_row(*cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))


def source_label(section_title: Column, file_name: Column, domain: Column) -> Column:
    """Header of a context block: section or file name, then the domain."""
    name = F.coalesce(F.nullif(section_title, F.lit("")), F.nullif(file_name, F.lit("")))
    scope = F.when(F.coalesce(domain, F.lit("")) != "", F.concat(F.lit("domain="), domain))
    return F.concat_ws(" | ", name, scope)


def url_name(url: Column) -> Column:
    """Path stem of a url, or its host with underscores when the stem says nothing."""
    stem = F.regexp_extract(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), r"([^/]+?)(?:\.[^./]*)?/*$", 1)
    host = F.replace(F.coalesce(F.parse_url(url, F.lit("AUTHORITY")), F.lit("")), F.lit("."), F.lit("_"))
    # Page names that do not identify the page.
    return F.when((stem != "") & ~stem.isin("drugInfo", "lookup"), stem).otherwise(host)


def safe_image_name(name: Column, index: Column) -> Column:
    base = F.regexp_replace(F.regexp_extract(name, r"([^/]*)/*$", 1), r"[^A-Za-z0-9._-]", "_")
    return F.coalesce(F.nullif(base, F.lit("")), F.format_string("image_%04d.png", index))


def page_of_image(name: Column) -> Column:
    """Page number written into an image file name, else 0."""
    digits = F.regexp_extract(F.coalesce(name, F.lit("")), r"(?i)(?:img_p|page_)(\d+)", 1)
    return F.coalesce(F.nullif(digits, F.lit("")).cast("int"), F.lit(0))


# Caption context fields, their labels and their order.
CAPTION_FIELDS = {
    "section_title": "Section",
    "alt_text": "Alt text",
    "title": "Image title",
    "nearby_text_before": "Nearby text before",
    "nearby_text_after": "Nearby text after",
    "nearby_table_markdown": "Nearby table",
}
# Fixed value: caption when nothing is known about the image.
NO_CAPTION = "Image element without an available generated caption."


def caption_context(fields: dict[str, Column], separator: str = " ") -> Column:
    """Labelled context fields of an image, each cut to 1200 characters."""
    lines = []
    for key, label in CAPTION_FIELDS.items():
        if key in fields:
            value = clean(fields[key])
            lines.append(F.when(value != "", F.concat(F.lit(label + ": "), F.substring(value, 1, 1200))))
    return F.concat_ws(separator, *lines) if lines else F.lit("")


def fallback_caption(fields: dict[str, Column]) -> Column:
    context = caption_context(fields)
    return F.when(context != "", F.concat(F.lit("Image context: "), context)).otherwise(F.lit(NO_CAPTION))


# Fixed value: instruction sent with an image to a caption model.
CAPTION_PROMPT = (
    "Create a concise, factual caption for this document image.\n"
    "Focus on visible labels, chart/table meaning, forms, diagrams, and domain-specific facts.\n"
    "If text is visible in the image, summarize the important text instead of transcribing everything.\n"
    "Do not invent facts that are not visible. Keep the caption to 1-3 sentences."
)


def caption_prompt(fields: dict[str, Column]) -> Column:
    lines = caption_context(fields, "\n")
    return F.when(
        lines != "", F.concat(F.lit(CAPTION_PROMPT + "\n\nDocument context:\n"), lines)
    ).otherwise(F.lit(CAPTION_PROMPT))
