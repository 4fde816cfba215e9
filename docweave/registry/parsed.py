"""Registered queries of parser outputs: nested JSON, raw crawls, failures, section paths, markup, image names and pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators import normalize as nm
from docweave.operators import triage as tr
from docweave.plans import catalog as ca
from docweave.registry.base import table
from docweave.registry.catalog import document_table
from docweave.registry.normalize import _PDF, pdf_documents
from docweave.session import stage_table
from docweave.sources import html as ht
from docweave.sources import structured as st


def structured_files(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of ``pdf_flatten`` as JSON files, some torn, some with a bad page or bad items."""
    # A column of its own: the cases below use it several times.
    docs = pdf_documents(spark, sf).withColumn("whole", F.to_json(F.struct("pages")))
    whole = F.col("whole")
    turn = F.col("document_id").cast("bigint") % 7
    text = (
        F.when(turn == 3, F.left(whole, F.length(whole) - 5)).when(turn == 5, F.regexp_replace(whole, r'"page_number":\d*7,', '"number":7,'))
        .when(turn == 1, F.replace(whole, F.lit('"type":"footer"'), F.lit('"type":7')))
        .when(turn == 2, F.regexp_replace(whole, r'"items":\[\{"n":1,', '"items":["loose",{"n":1,')).otherwise(whole)
    )
    return docs.select("document_id", "domain", F.concat(F.lit("parsed/finance/pdf/"), "document_id", F.lit(st.STRUCTURED)).alias("path"), text.alias("text"))


def structured_pdf(spark: SparkSession, sf: str) -> DataFrame:
    """Content items of all pages that can be read."""
    files = structured_files(spark, sf)
    pages, _ = st.pdf_pages(files)
    _, name = st.file_key(F.col("path"), st.STRUCTURED)
    rows = pages.select(name.alias("document_id"), F.lit("finance").alias("domain"), "page", "page_number", "items")
    return nm.page_content(rows).select("document_id", "page", "page_number", "idx", "element_type", "text", "y")


def structured_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Bad records with their place."""
    _, rejected = st.pdf_pages(structured_files(spark, sf))
    _, name = st.file_key(F.col("path"), st.STRUCTURED)
    return rejected.select(name.alias("document_id"), "page", "item", "error")


def parse_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What becomes of catalogued documents whose outputs are read: failed with the first error, or parsed and recoverable."""
    files = stage_table(structured_files(spark, sf))
    _, rejected = st.pdf_pages(files)
    errors = st.first_errors(rejected.join(files.select("path", "document_id"), "path"), "document_id").select("document_id", "error")
    outcomes = stage_table(files.select("document_id", F.create_map(F.lit("structured_json_path"), F.col("path")).alias("outputs")).join(errors, "document_id", "left"))
    known = document_table(spark, sf).withColumn("document_id", F.col("document_id").cast("string"))
    done, bad = outcomes.filter("error IS NULL"), outcomes.filter("error IS NOT NULL")
    changed = ca.mark_failed(ca.mark_parsed(known, done.select("document_id", "outputs")), bad.select("document_id", "error"))
    again = ca.recoverable_documents(changed).select("document_id", F.element_at("metadata.parse_outputs", "structured_json_path").alias("recoverable_from"))
    return changed.join(again, "document_id", "left").select("document_id", "status", "metadata.parse_error", "recoverable_from")


def crawl_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Raw crawls of four pages each, some torn, to pages with their fields and numbers of sections."""
    pages = table(spark, sf, "pages")
    page = F.struct(
        (F.col("page_id") % 4).alias("n"),
        F.when(F.col("page_id") % 3 != 1, F.col("html")).alias("html"), F.when(F.col("page_id") % 3 == 1, F.col("html")).alias("raw_html"),
        F.struct(
            F.when(F.col("page_id") % 5 != 0, F.col("url")).alias("sourceURL"), F.when(F.col("page_id") % 5 == 0, F.col("url")).alias("url"),
            F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("Page "), F.col("page_id").cast("string"))).alias("title"),
            F.when(F.col("page_id") % 2 == 1, F.lit(200)).alias("statusCode"), F.lit("404").alias("status_code"), F.lit("en").alias("language"),
        ).alias("metadata"),
        F.when(F.col("page_id") % 2 == 0, F.array("url", F.lit("/next"))).alias("links"),
    )
    docs = pages.groupBy(F.floor(F.col("page_id") / 4).cast("string").alias("document_id")).agg(F.sort_array(F.collect_list(page)).alias("data"))
    whole = F.to_json(F.struct("data"))
    files = docs.select(F.concat(F.lit("parsed/legal/html/"), "document_id", F.lit(st.RAW_CRAWL)).alias("path"), F.when(F.col("document_id").cast("bigint") % 9 == 4, F.concat(F.lit("x"), whole)).otherwise(whole).alias("text"))
    crawled, _ = st.crawl_pages(files)
    _, name = st.file_key(F.col("path"), st.RAW_CRAWL)
    rows = crawled.withColumn("document_id", name)
    # The parser runs once per page.
    parsed = stage_table(ht.parsed_pages(rows))
    full = ht.all_pages(parsed, ht.structured_pages(ht.page_elements(parsed)))
    return full.select(
        "document_id", "page_number", "source_url", "title", "status_code", "language", F.array_join("links", " ").alias("links"), F.size("sections").alias("sections")
    )


def section_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of documents as headings of changing levels and paragraphs; the path of every section."""
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "line"))
    tag = F.get(F.lit(["h1", "p", "h3", "p", "h2", "h6", "p", "h4", "h5", "p", "h2"]), ((F.col("doc_id") + F.col("i") * 5) % 11).cast("int"))
    marked = F.concat(F.lit("<"), tag, F.lit(">L"), F.col("i").cast("string"), F.lit(" "), F.substring(F.md5("line"), 1, 6), F.lit("</"), tag, F.lit(">"))
    # The pages of a document hold 40 lines each, so headings of one page don't reach into the next.
    pages = lines.groupBy("doc_id", F.floor(F.col("i") / 40).cast("int").alias("p")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", marked.alias("m")))), lambda x: x["m"]), "").alias("html"))
    rows = pages.select(F.col("doc_id").cast("string").alias("document_id"), (F.col("p") + 1).alias("page_number"), "html", F.lit("").alias("url"), F.lit(None).cast("string").alias("title"))
    nested = ht.structured_pages(ht.extract_pages(rows)).select("document_id", "page_number", F.explode("sections").alias("s"))
    return nested.select("document_id", "page_number", "s.nth", "s.heading_level", F.array_join("s.section_path", " > ").alias("section_path"), F.size("s.elements").alias("elements"))


def html_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as pages with a table of their lines, a list that nests other content, a heading in it, and an image."""
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    orders = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    cell = lambda c: F.concat(F.lit("<td>"), c, F.lit("</td>"))
    row = lambda x: F.concat(
        F.lit("<tr>"), cell(x["l_linenumber"].cast("string")), cell(F.concat(x["l_returnflag"], F.lit("| "), x["l_partkey"].cast("string"))),
        F.when(x["l_suppkey"] % 2 == 0, cell(F.concat(F.lit("<b>s</b> "), x["l_suppkey"].cast("string")))).otherwise(""), F.lit("</tr>\n"),
    )
    key = F.col("l_orderkey").cast("string")
    html = F.concat(
        F.lit("<p>Order "), key, F.lit("</p><table><tr><th>line<th>part</tr>"), F.array_join(F.transform("lines", row), ""), F.lit("</table>"),
        F.lit("<ul><li>one<p>two</p></li><li><h2>In "), key, F.lit("</h2></li></ul>"),
        F.when(F.col("l_orderkey") % 2 == 0, F.concat(F.lit('<img src="../i/'), key, F.lit('.png" alt=" a \n b ">'))).otherwise('<img alt="none">'),
    )
    pages = orders.select(key.alias("document_id"), F.lit(1).alias("page_number"), html.alias("html"), F.lit("http://h.org/x/y").alias("url"), F.lit(None).cast("string").alias("title"))
    return ht.extract_pages(pages).select("document_id", "sequence", "tag", "type", "heading_level", "text", "table_markdown", "image_url", "alt_text")


def image_names(spark: SparkSession, sf: str) -> DataFrame:
    """Page numbers in image file names, and names that are safe on disk."""
    events = table(spark, sf, "events")
    names = F.get(F.lit(["img_p", "PAGE_", "scan ", "a/b/page_"]), (F.col("event_id") % 4).cast("int"))
    name = F.concat(names, F.col("user_id").cast("string"), F.lit("_é"), F.col("event_id").cast("string"), F.lit(".png"))
    named = events.select("event_id", F.when(F.col("event_id") % 9 != 8, name).otherwise("x/").alias("name"))
    return named.select("event_id", tx.page_of_image(F.col("name")).alias("page"), tx.safe_image_name(F.col("name"), (F.col("event_id") % 100).cast("int")).alias("safe"))


def photographic(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors as small images of 21 pixels, in three strengths of colour."""
    rows = table(spark, sf, "embeddings")
    strength = F.get(F.lit([40.0, 2000.0, 100000.0]), (F.col("vec_id") % 3).cast("int"))
    byte = lambda i: (F.floor(F.abs(F.get("embedding", i)).cast("double") * strength) % 256).cast("int")
    pixels = F.transform(F.sequence(F.lit(0), F.lit(20)), lambda k: F.struct(byte(k * 3).alias("r"), byte(k * 3 + 1).alias("g"), byte(k * 3 + 2).alias("b")))
    shown = rows.select("vec_id", F.when(F.col("vec_id") % 17 != 0, pixels).alias("pixels"))
    return shown.select("vec_id", tr.is_photographic(F.col("pixels"), 30.0, 0.004, 0.22).alias("photo"))


QUERIES = {
    "structured_pdf": structured_pdf,
    "structured_rejects": structured_rejects,
    "parse_outcomes": parse_outcomes,
    "crawl_pages": crawl_pages,
    "section_paths": section_paths,
    "html_tables": html_tables,
    "image_names": image_names,
    "photographic": photographic,
}

_PAGES = f"""{_PDF},
turn AS (SELECT *, document_id::BIGINT % 7 AS turn FROM item),
pages AS (SELECT DISTINCT document_id, page, page_number, turn FROM turn WHERE turn <> 3),
bad_item AS (SELECT document_id, page, min(l_linenumber) AS first_line FROM turn WHERE turn = 2 GROUP BY ALL HAVING min(l_linenumber) = 1),
bad AS (SELECT DISTINCT document_id, NULL::INT AS page, NULL::INT AS item, 'not JSON' AS error FROM turn WHERE turn = 3
  UNION ALL SELECT document_id, page::INT, NULL, 'page without page_number' FROM pages WHERE turn = 5 AND page_number % 10 = 7
  UNION ALL SELECT document_id, page::INT, 0, 'item is no object' FROM bad_item)"""

ORACLES = {
    "structured_pdf": f"""WITH {_PAGES} SELECT document_id, page::INT AS page, page_number::INT AS page_number, idx::INT AS idx, element_type, text, y FROM content
WHERE document_id::BIGINT % 7 <> 3 AND NOT (document_id::BIGINT % 7 = 5 AND page_number % 10 = 7)""",
    "structured_rejects": f"WITH {_PAGES} SELECT document_id, page, item, error FROM bad",
    "parse_outcomes": f"""WITH {_PAGES},
e AS (SELECT document_id, arg_min(CASE WHEN page IS NULL THEN error ELSE 'page ' || (page + 1) || CASE WHEN item IS NULL THEN '' ELSE ', item ' || (item + 1) END || ': ' || error END, coalesce(page, -1)) AS error FROM bad GROUP BY 1),
o AS (SELECT d.document_id, error FROM (SELECT DISTINCT document_id FROM turn) d LEFT JOIN e USING (document_id)),
k AS (SELECT doc_id::VARCHAR AS document_id, quality FROM documents LEFT JOIN labels USING (doc_id))
SELECT k.document_id, CASE WHEN o.document_id IS NULL THEN CASE quality WHEN 1 THEN 'parsed' WHEN 0 THEN 'failed' ELSE 'discovered' END WHEN error IS NULL THEN 'parsed' ELSE 'failed' END AS status,
  error AS parse_error, CASE WHEN o.document_id IS NOT NULL AND error IS NULL THEN 'parsed/finance/pdf/' || k.document_id || '.structured.json' END AS recoverable_from
FROM k LEFT JOIN o ON o.document_id = k.document_id""",
    "crawl_pages": r"""
WITH s AS (SELECT page_id, len(regexp_extract_all(regexp_replace(regexp_replace(html, '(?s)<script[^>]*>.*?</script>', '', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<h1>')) AS heads,
    regexp_matches(split_part(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '<h1>', 1), '<(p|ul)>') AS lead FROM pages)
SELECT (page_id // 4)::VARCHAR AS document_id, (page_id % 4 + 1)::INT AS page_number, url AS source_url, CASE WHEN page_id % 2 = 0 THEN 'Page ' || page_id ELSE 'Crawled page ' || (page_id % 4 + 1) END AS title,
  CASE WHEN page_id % 2 = 1 THEN '200' ELSE '404' END AS status_code, 'en' AS language, CASE WHEN page_id % 2 = 0 THEN url || ' /next' ELSE '' END AS links,
  (heads + lead::INT)::INT AS sections FROM pages JOIN s USING (page_id) WHERE (page_id // 4) % 9 <> 4""",
    "section_paths": """
WITH l AS (SELECT doc_id, unnest(t) AS line, generate_subscripts(t, 1) - 1 AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS t FROM documents)),
g AS (SELECT doc_id, i // 40 AS p, i, ['h1', 'p', 'h3', 'p', 'h2', 'h6', 'p', 'h4', 'h5', 'p', 'h2'][((doc_id + i * 5) % 11 + 1)::INT] AS tag, 'L' || i || ' ' || md5(line)[1:6] AS title FROM l),
h AS (SELECT *, CASE WHEN tag = 'p' THEN 0 ELSE tag[2:2]::INT END AS level, sum(CASE WHEN tag = 'p' THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, p ORDER BY i) AS sec,
  min(CASE WHEN tag = 'p' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, p ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS x,
  first_value(tag) OVER (PARTITION BY doc_id, p ORDER BY i) AS head FROM g),
heads AS (SELECT * FROM h WHERE level > 0),
up AS (SELECT a.doc_id, a.p, a.i, b.i AS j, b.title FROM heads a JOIN heads b ON a.doc_id = b.doc_id AND a.p = b.p AND b.i <= a.i
  WHERE b.i = a.i OR b.level < (SELECT min(c.level) FROM heads c WHERE c.doc_id = a.doc_id AND c.p = a.p AND c.i > b.i AND c.i <= a.i)),
path AS (SELECT doc_id, p, i, string_agg(title, ' > ' ORDER BY j) AS section_path FROM up GROUP BY ALL),
size AS (SELECT doc_id, p, sec, count(*) AS n, min(i) AS i, any_value(head) AS head, max(level) AS level FROM h GROUP BY ALL)
SELECT doc_id::VARCHAR AS document_id, (p + 1)::INT AS page_number, (CASE WHEN head = 'p' THEN sec ELSE sec - 1 END)::INT AS nth, level::INT AS heading_level,
  CASE WHEN sec = 0 THEN 'Crawled page ' || (p + 1) ELSE section_path END AS section_path, n::INT AS elements FROM size LEFT JOIN path USING (doc_id, p, i)""",
    "html_tables": """
WITH l AS (SELECT * FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag),
o AS (SELECT l_orderkey AS k, string_agg(l_linenumber || ' ' || l_returnflag || '| ' || l_partkey || CASE WHEN l_suppkey % 2 = 0 THEN ' s ' || l_suppkey ELSE '' END, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey) AS t,
    max(CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE 0 END) AS wide,
    list(struct_pack(n := l_linenumber, p := l_partkey, s := l_suppkey, f := l_returnflag) ORDER BY l_linenumber, l_partkey, l_suppkey) AS rows FROM lineitem GROUP BY l_orderkey),
m AS (SELECT k, t, CASE WHEN wide = 1 THEN '| line | part |  |' || chr(10) || '| --- | --- | --- |' ELSE '| line | part |' || chr(10) || '| --- | --- |' END || chr(10) || array_to_string([
    '| ' || r.n || ' | ' || r.f || '\\| ' || r.p || CASE WHEN wide = 0 THEN ' |' WHEN r.s % 2 = 0 THEN ' | s ' || r.s || ' |' ELSE ' |  |' END FOR r IN rows], chr(10)) AS md FROM o)
SELECT k::VARCHAR AS document_id, 1 AS sequence, 'p' AS tag, 'text' AS type, NULL::INT AS heading_level, 'Order ' || k AS text, NULL AS table_markdown, NULL AS image_url, NULL AS alt_text FROM m
UNION ALL SELECT k::VARCHAR, 2, 'table', 'table', NULL, 'line part ' || t, md, NULL, NULL FROM m
UNION ALL SELECT k::VARCHAR, 3, 'ul', 'text', NULL, 'one two In ' || k, NULL, NULL, NULL FROM m
UNION ALL SELECT k::VARCHAR, 4, 'h2', 'heading', 2, 'In ' || k, NULL, NULL, NULL FROM m
UNION ALL SELECT k::VARCHAR, 5, 'img', 'image', NULL, '', NULL, 'http://h.org/i/' || k || '.png', 'a b' FROM m WHERE k % 2 = 0""",
    "image_names": r"""
WITH n AS (SELECT event_id, CASE WHEN event_id % 9 <> 8 THEN ['img_p', 'PAGE_', 'scan ', 'a/b/page_'][event_id % 4 + 1] || user_id || '_é' || event_id || '.png' ELSE 'x/' END AS name, user_id FROM events)
SELECT event_id, CASE WHEN event_id % 9 = 8 OR event_id % 4 = 2 THEN 0 ELSE user_id END::INT AS page,
  CASE WHEN event_id % 9 = 8 THEN 'x' ELSE ['img_p', 'PAGE_', 'scan_', 'page_'][event_id % 4 + 1] || user_id || '__' || event_id || '.png' END AS safe FROM n""",
    "photographic": """
WITH v AS (SELECT vec_id, [(floor(abs(x::DOUBLE) * [40.0::DOUBLE, 2000.0::DOUBLE, 100000.0::DOUBLE][vec_id % 3 + 1])::BIGINT % 256)::INT FOR x IN embedding] AS b FROM embeddings),
p AS (SELECT vec_id, unnest(range(0, 21)) AS k, b FROM v WHERE vec_id % 17 <> 0),
c AS (SELECT vec_id, b[k * 3 + 1] AS r, b[k * 3 + 2] AS g, b[k * 3 + 3] AS bl FROM p),
m AS (SELECT vec_id, avg(r - g) AS rg, avg(0.5::DOUBLE * (r + g) - bl) AS yb, avg((r - g)::DOUBLE * (r - g)) AS rg2, avg((0.5::DOUBLE * (r + g) - bl) * (0.5::DOUBLE * (r + g) - bl)) AS yb2,
  count(DISTINCT (r // 16) * 256 + (g // 16) * 16 + bl // 16) / 4096.0::DOUBLE AS shades, avg(CASE WHEN r > 235 AND g > 235 AND bl > 235 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS white FROM c GROUP BY vec_id)
SELECT vec_id, coalesce(sqrt(greatest(rg2 - rg * rg + yb2 - yb * yb, 0)) + 0.3::DOUBLE * sqrt(rg * rg + yb * yb) > 30 AND shades > 0.004 AND white < 0.22, false) AS photo FROM v LEFT JOIN m USING (vec_id)""",
}
