"""Registered queries of the chunking side: windows, sections, parents, children."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators import chunking as ch
from docweave.registry.base import sql_uuid5, table
from docweave.session import stage_table

# Small budgets, so that the given texts exercise every split.
PARAMS = ch.ChunkParams(target=64, overlap=8, max_tokens=100, parent_max=250)


def line_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Every non-empty document line as an element; very short lines are headings."""
    docs = table(spark, sf, "documents")
    lines = docs.select("doc_id", "lang", "source", F.posexplode_outer(F.split("text", "\n")).alias("order", "line"))
    cleaned = lines.withColumn("line", tx.clean(F.col("line"))).filter("line != ''")
    kind = (
        F.when(tx.token_count(F.col("line")) <= 3, "heading")
        .when(F.contains(F.col("line"), F.lit("|")), "table")
        .when(F.contains(F.col("line"), F.lit("@")), "image")
        .otherwise("text")
    )
    marks = F.concat(F.repeat(F.lit("#"), F.col("order") % 3 + 1), F.lit(" "), F.col("line"))
    return cleaned.withColumn("element_type", kind).select(
        F.col("doc_id").cast("string").alias("document_id"),
        F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("order").cast("string")).alias("element_id"),
        "element_type",
        F.when(F.col("element_type") == "heading", marks).otherwise(F.col("line")).alias("text"),
        F.when(F.col("order") % 7 != 6, F.floor(F.col("order") / 5).cast("int")).alias("page_number"),
        "order",
        F.col("lang").alias("domain"),
        F.lit("pdf").alias("source_type"),
        F.col("source").alias("file_name"),
    )


def turn_elements(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns as elements: system and user turns are headings of level 1 and 2."""
    turns = table(spark, sf, "conversations")
    level = F.when(F.col("role") == "system", "# ").otherwise("## ")
    text = tx.clean(F.col("text"))
    return turns.select(
        F.col("conv_id").cast("string").alias("document_id"),
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("element_id"),
        F.when(F.col("role") == "assistant", "text").otherwise("heading").alias("element_type"),
        F.when(F.col("role") == "assistant", text).otherwise(F.concat(level, text)).alias("text"),
        F.col("turn").cast("int").alias("page_number"),
        F.col("turn").alias("order"),
        F.lit("chat").alias("domain"),
        F.lit("html").alias("source_type"),
        F.lit("chat").alias("file_name"),
    )


def token_windows(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(
        "doc_id", F.lit("text").alias("element_type"), tx.clean(F.col("text")).alias("text")
    )
    counted = docs.withColumn("tokens", tx.token_count(F.col("text")))
    return ch.with_pieces(counted, 800, 64, "piece").select("doc_id", "piece", "tokens", F.md5("text").alias("md5"))


def table_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a table: a header row, then one row per line; split on row boundaries."""
    docs = table(spark, sf, "documents")
    cells = F.transform(
        F.split("text", "\n"), lambda l: F.concat(F.lit("| "), F.translate(l, "|\r\x0b\x0c\x1c\x1d\x1e\x85  ", " "), F.lit(" |"))
    )
    text = F.concat(F.lit("| Line |\n|---|\n"), F.array_join(cells, "\n"))
    rows = docs.select("doc_id", F.lit("table").alias("element_type"), text.alias("text"))
    counted = rows.withColumn("tokens", tx.token_count(F.col("text")))
    return ch.with_pieces(counted, 100, 8, "piece").select("doc_id", "piece", "tokens", F.md5("text").alias("md5"))


def breadcrumb(spark: SparkSession, sf: str) -> DataFrame:
    found = ch.headings(line_elements(spark, sf), PARAMS)
    return found.select("document_id", "order", F.col("level").cast("int").alias("level"), "title", F.array_join("path", " > ").alias("path"))


def sections(spark: SparkSession, sf: str) -> DataFrame:
    """Sections of conversations with their title, breadcrumb and element count."""
    elements = turn_elements(spark, sf)
    placed = ch.sections(elements)
    counted = placed.groupBy("document_id", F.col("section").alias("order")).agg(
        F.count(F.lit(1)).alias("elements"), F.sum(tx.token_count(F.col("text"))).alias("tokens")
    )
    # One row per section of a document.
    index = F.row_number().over(Window.partitionBy("document_id").orderBy(F.asc_nulls_first("order"))) - 1
    counted = counted.withColumn("parent_index", index.cast("bigint"))
    return counted.join(ch.headings(elements), ["document_id", "order"], "left").select(
        "document_id", "parent_index", "title", F.array_join("path", " > ").alias("path"), "elements", "tokens"
    )


def section_split(spark: SparkSession, sf: str) -> DataFrame:
    elements = stage_table(line_elements(spark, sf))
    parents = ch.parent_sections(ch.assign_parents(elements, PARAMS), ch.headings(elements, PARAMS))
    return parents.select(
        "parent_id", "document_id", "section_title", F.array_join("section_path", " > ").alias("section_path"),
        F.concat_ws(",", F.transform("page_numbers", lambda p: p.cast("string"))).alias("pages"),
        F.md5("parent_text").alias("text_md5"), F.col("metadata.section_index").alias("section_index"),
    )


def child_chunks(spark: SparkSession, sf: str) -> DataFrame:
    elements = stage_table(line_elements(spark, sf))
    children = ch.child_chunks(ch.assign_parents(elements, PARAMS), ch.headings(elements, PARAMS), PARAMS)
    return children.select(
        "chunk_id", "parent_id", "document_id", "section_title", "chunk_index",
        F.concat_ws(",", F.transform("page_numbers", lambda p: p.cast("string"))).alias("pages"),
        F.concat_ws(",", "modalities").alias("modalities"), F.concat_ws(",", "image_refs").alias("image_refs"),
        F.md5("text_content").alias("text_md5"), F.md5("table_markdown").alias("table_md5"),
    )


QUERIES = {
    "token_windows": token_windows,
    "table_split": table_split,
    "breadcrumb": breadcrumb,
    "sections": sections,
    "section_split": section_split,
    "child_chunks": child_chunks,
}

_LINES = r"""
lines AS (SELECT doc_id, lang, source, unnest(l) AS line, generate_subscripts(l, 1) - 1 AS ord
  FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents)),
el AS (SELECT doc_id::VARCHAR AS document_id, ord, c, w, len(w) AS n,
    CASE WHEN len(w) <= 3 THEN 'heading' WHEN contains(c, '|') THEN 'table' WHEN contains(c, '@') THEN 'image' ELSE 'text' END AS kind,
    CASE WHEN ord % 7 <> 6 THEN ord // 5 END AS page
  FROM (SELECT *, string_split(c, ' ') AS w FROM (SELECT *, trim(regexp_replace(line, '\s+', ' ', 'g')) AS c FROM lines) WHERE c <> '')),
head AS (SELECT document_id, ord, 1 + ord % 3 AS level, c AS title FROM el WHERE kind = 'heading'),
lasts AS (SELECT *,
    max(CASE WHEN level = 1 THEN struct_pack(o := ord, t := title) END) OVER s AS h1,
    max(CASE WHEN level = 2 THEN struct_pack(o := ord, t := title) END) OVER s AS h2,
    max(CASE WHEN level = 3 THEN struct_pack(o := ord, t := title) END) OVER s AS h3
  FROM head WINDOW s AS (PARTITION BY document_id ORDER BY ord ROWS UNBOUNDED PRECEDING)),
crumbs AS (SELECT document_id, ord, level, title, concat_ws(' > ', h1.t,
    CASE WHEN h2.o > coalesce(h1.o, -1) THEN h2.t END,
    CASE WHEN h3.o > greatest(coalesce(h1.o, -1), coalesce(h2.o, -1)) THEN h3.t END) AS path FROM lasts)"""

# Lines starting with # would carry their own marks into the title; strip them as the title rule does.
_LINES = _LINES.replace("c AS title", r"trim(regexp_replace(repeat('#', (1 + ord % 3)::INT) || ' ' || c, '^#+', '')) AS title")


def _pieces(name: str, source: str, size: int, step: int, keep: str) -> str:
    return f"""
{name} AS (SELECT {keep}, 0 AS {name}_no, c, w, n FROM {source} WHERE n <= {size}
  UNION ALL SELECT {keep}, (s // {step}) AS {name}_no, array_to_string(p, ' ') AS c, p AS w, len(p) AS n FROM (
    SELECT *, list_slice(w, s + 1, s + {size}) AS p FROM (SELECT *, unnest(generate_series(0, n - 1, {step})) AS s FROM {source} WHERE n > {size})))"""


_PARTS = (
    _LINES + "," + _pieces("pe", "el", 250, 242, "document_id, ord, kind, page")
    + """,
pos AS (SELECT *, max(CASE WHEN kind = 'heading' THEN ord END) OVER (PARTITION BY document_id ORDER BY ord, pe_no ROWS UNBOUNDED PRECEDING) AS sec FROM pe),
content AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY ord, pe_no) AS j FROM pos WHERE kind <> 'heading'),
walk AS (SELECT document_id, j, sec, n::BIGINT AS acc, 0::BIGINT AS part FROM content WHERE j = 1
  UNION ALL SELECT c.document_id, c.j, c.sec,
    CASE WHEN c.sec IS DISTINCT FROM r.sec OR r.acc + c.n > 250 THEN c.n ELSE r.acc + c.n END,
    CASE WHEN c.sec IS DISTINCT FROM r.sec OR r.acc + c.n > 250 THEN r.part + 1 ELSE r.part END
  FROM walk r JOIN content c ON c.document_id = r.document_id AND c.j = r.j + 1),
placed AS (SELECT c.*, w.part FROM content c JOIN walk w USING (document_id, j))"""
)

_CHILDREN = (
    _pieces("un", "placed", 100, 92, "document_id, part, sec, j, ord, pe_no, kind, page")
    + """,
seg AS (SELECT *, row_number() OVER (PARTITION BY document_id, part ORDER BY j, un_no) AS i,
    sum(CASE WHEN kind = 'table' THEN 1 ELSE 0 END) OVER (PARTITION BY document_id, part ORDER BY j, un_no) AS run FROM un),
tu AS (SELECT *, sum(n) OVER (PARTITION BY document_id, part, run ORDER BY i ROWS UNBOUNDED PRECEDING) - n AS cum,
    row_number() OVER (PARTITION BY document_id, part, run ORDER BY i) AS k,
    count(*) OVER (PARTITION BY document_id, part, run) AS last FROM seg WHERE kind <> 'table'),
tail AS (SELECT a.document_id, a.part, a.run, a.k, max(b.k) AS t FROM tu a JOIN tu b
    ON a.document_id = b.document_id AND a.part = b.part AND a.run = b.run AND b.k < a.k AND a.cum - b.cum >= 8 GROUP BY ALL),
unit AS (SELECT u.*, t.t FROM tu u LEFT JOIN tail t USING (document_id, part, run, k)),
pack AS (SELECT document_id, part, run, k, 1::BIGINT AS s, NULL::BIGINT AS lo FROM unit WHERE k = 1
  UNION ALL SELECT u.document_id, u.part, u.run, u.k,
    CASE WHEN u.cum - b.cum + u.n > 64 THEN greatest(p.s, coalesce(u.t, p.s)) ELSE p.s END,
    CASE WHEN u.cum - b.cum + u.n > 64 THEN p.s END
  FROM pack p JOIN unit u ON u.document_id = p.document_id AND u.part = p.part AND u.run = p.run AND u.k = p.k + 1
  JOIN unit b ON b.document_id = p.document_id AND b.part = p.part AND b.run = p.run AND b.k = p.s),
ranges AS (SELECT document_id, part, run, lo, k - 1 AS hi FROM pack WHERE lo IS NOT NULL
  UNION ALL SELECT p.document_id, p.part, p.run, p.s, p.k FROM pack p JOIN unit u USING (document_id, part, run, k) WHERE u.k = u.last),
made AS (
  SELECT document_id, part, any_value(sec) AS sec, min(i) AS first_i, string_agg(c, chr(10) || chr(10) ORDER BY i) AS text, NULL::VARCHAR AS tab,
    string_agg(DISTINCT page::VARCHAR, ',') AS pages0, list_sort(list_distinct(list(page))) AS pages,
    array_to_string(list_sort(list_distinct(list(CASE WHEN kind = 'image' THEN 'image' ELSE 'text' END))), ',') AS modalities,
    coalesce(string_agg(CASE WHEN kind = 'image' THEN document_id || ':' || ord || CASE WHEN long THEN '#p' || pe_no ELSE '' END END, ',' ORDER BY i), '') AS refs, hi
  FROM (SELECT r.lo, r.hi, u.*, EXISTS (SELECT 1 FROM pe x WHERE x.document_id = u.document_id AND x.ord = u.ord AND x.pe_no > 0) AS long
        FROM ranges r JOIN unit u ON u.document_id = r.document_id AND u.part = r.part AND u.run = r.run AND u.k BETWEEN r.lo AND r.hi)
  GROUP BY document_id, part, run, lo, hi
  UNION ALL SELECT document_id, part, sec, i, c, c, NULL, CASE WHEN page IS NULL THEN [] ELSE [page] END, 'table', '', 0 FROM seg WHERE kind = 'table'),
child AS (SELECT *, row_number() OVER (PARTITION BY document_id, part ORDER BY first_i, hi) - 1 AS idx FROM made),
named AS (SELECT c.*, """
    + sql_uuid5("c.document_id || ':parent:' || c.part")
    + """ AS parent_id, h.title FROM child c LEFT JOIN crumbs h ON h.document_id = c.document_id AND h.ord = c.sec)"""
)

ORACLES = {
    "token_windows": "WITH d AS (SELECT doc_id, c, string_split(c, ' ') AS w, len(string_split(c, ' ')) AS n FROM "
    + r"(SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS c FROM documents)),"
    + _pieces("p", "d", 800, 736, "doc_id")
    + " SELECT doc_id, p_no::INT AS piece, n::INT AS tokens, md5(c) AS md5 FROM p",
    "table_split": r"""
WITH RECURSIVE rows0 AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (
    SELECT doc_id, string_split(translate(text, '|' || chr(13) || chr(11) || chr(12) || chr(28) || chr(29) || chr(30) || chr(133) || chr(8232) || chr(8233), ' '), chr(10)) AS l FROM documents)),
r AS (SELECT doc_id, i, '| ' || line || ' |' AS row, len(list_filter(string_split_regex('| ' || line || ' |', '\s+'), lambda w: w <> '')) AS n FROM rows0),
size AS (SELECT doc_id, sum(n) + 4 AS total FROM r GROUP BY 1),
walk AS (SELECT doc_id, i, n::BIGINT AS acc, 0::BIGINT AS part FROM r WHERE i = 1
  UNION ALL SELECT r.doc_id, r.i, CASE WHEN 4 + w.acc + r.n > 100 THEN r.n ELSE w.acc + r.n END,
    CASE WHEN 4 + w.acc + r.n > 100 THEN w.part + 1 ELSE w.part END
  FROM walk w JOIN r ON r.doc_id = w.doc_id AND r.i = w.i + 1)
SELECT doc_id, (CASE WHEN total <= 100 THEN 0 ELSE part END)::INT AS piece, (4 + sum(n))::INT AS tokens,
  md5('| Line |' || chr(10) || '|---|' || chr(10) || string_agg(row, chr(10) ORDER BY i)) AS md5
FROM walk JOIN r USING (doc_id, i) JOIN size USING (doc_id) GROUP BY doc_id, CASE WHEN total <= 100 THEN 0 ELSE part END""",
    "breadcrumb": "WITH " + _LINES + ' SELECT document_id, ord::INT AS "order", level::INT AS level, title, path FROM crumbs',
    "sections": r"""
WITH t AS (SELECT conv_id::VARCHAR AS document_id, turn, role, trim(regexp_replace(text, '\s+', ' ', 'g')) AS c FROM conversations),
h AS (SELECT document_id, turn, c AS title, CASE WHEN role = 'system' THEN 1 ELSE 2 END AS level FROM t WHERE role <> 'assistant'),
l AS (SELECT *, max(CASE WHEN level = 1 THEN struct_pack(o := turn, t := title) END) OVER (PARTITION BY document_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS h1 FROM h),
p AS (SELECT *, CASE WHEN level = 1 THEN title ELSE concat_ws(' > ', h1.t, title) END AS path FROM l),
s AS (SELECT *, max(CASE WHEN role <> 'assistant' THEN turn END) OVER (PARTITION BY document_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS sec FROM t),
g AS (SELECT document_id, sec, count(*) AS elements, sum(len(list_filter(string_split(c, ' '), lambda w: w <> '')))::BIGINT AS tokens FROM s WHERE role = 'assistant' GROUP BY 1, 2)
SELECT g.document_id, row_number() OVER (PARTITION BY g.document_id ORDER BY g.sec NULLS FIRST) - 1 AS parent_index,
  p.title, p.path, g.elements, g.tokens FROM g LEFT JOIN p ON p.document_id = g.document_id AND p.turn = g.sec""",
    "section_split": "WITH RECURSIVE " + _PARTS + ", grouped AS (SELECT document_id, part, any_value(sec) AS sec,"
    " array_to_string(list_sort(list_distinct(list(page))), ',') AS pages, md5(string_agg(c, chr(10) || chr(10) ORDER BY j)) AS text_md5"
    " FROM placed GROUP BY 1, 2) SELECT " + sql_uuid5("g.document_id || ':parent:' || g.part")
    + " AS parent_id, g.document_id, h.title AS section_title, coalesce(h.path, '') AS section_path, g.pages, g.text_md5,"
    " g.part AS section_index FROM grouped g LEFT JOIN crumbs h ON h.document_id = g.document_id AND h.ord = g.sec",
    "child_chunks": "WITH RECURSIVE " + _PARTS + "," + _CHILDREN + " SELECT " + sql_uuid5("parent_id || ':child:' || idx")
    + """ AS chunk_id, parent_id, document_id, title AS section_title, idx::INT AS chunk_index,
    array_to_string(pages, ',') AS pages, modalities, refs AS image_refs, md5(text) AS text_md5, md5(tab) AS table_md5 FROM named""",
}
