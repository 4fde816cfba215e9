"""Registered queries of the document table, scalar expressions, discovery and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import ids
from docweave.functions import text as tx
from docweave.operators import chunking as ch
from docweave.operators.embedding import unembedded
from docweave.plans import catalog as ca
from docweave.plans import evaluation as ev
from docweave.registry.base import sql_uuid5, table
from docweave.sources import discovery as di

METADATA = (
    "struct<file_size_bytes:bigint,job:struct<job_id:string,api_key_alias:string,tier:string,version:string>,"
    "parse_outputs:map<string,string>,parse_error:string>"
)


def document_table(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as catalogue rows; their labels tell how far they were processed."""
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    status = F.when(F.col("quality") == 1, "parsed").when(F.col("quality") == 0, "failed").otherwise("discovered")
    outputs = F.when(F.col("quality") == 1, F.create_map(F.lit("markdown_path"), F.concat(F.lit("out/"), F.col("doc_id").cast("string"))))
    job = F.lit(None).cast("struct<job_id:string,api_key_alias:string,tier:string,version:string>")
    meta = F.struct(
        F.col("n_chars").alias("file_size_bytes"), job.alias("job"), outputs.alias("parse_outputs"), F.lit(None).cast("string").alias("parse_error")
    )
    return docs.select(
        F.col("doc_id").alias("document_id"), F.col("lang").alias("domain"), F.col("source").alias("file_name"),
        F.when(F.col("doc_id") % 3 == 0, "csv").when(F.col("doc_id") % 3 == 1, "pdf").otherwise("html").alias("source_type"),
        status.alias("status"), meta.alias("metadata"), F.col("n_chars").alias("updated_at"),
    )


def document_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Pages found again overwrite the documents of their number, others are new."""
    pages = table(spark, sf, "pages").select(
        (F.col("page_id") * 5).alias("document_id"), F.lit("web").alias("domain"), F.col("url").alias("file_name"), F.lit("html").alias("source_type"),
        F.struct(F.length("html").cast("bigint").alias("file_size_bytes")).alias("m"), F.lit(0).cast("bigint").alias("updated_at"),
    )
    empty = F.struct(
        F.col("m.file_size_bytes"), F.lit(None).cast("struct<job_id:string,api_key_alias:string,tier:string,version:string>").alias("job"),
        F.lit(None).cast("map<string,string>").alias("parse_outputs"), F.lit(None).cast("string").alias("parse_error"),
    )
    merged = ca.upsert_documents(document_table(spark, sf), pages.withColumn("metadata", empty).drop("m"))
    return merged.select(
        "document_id", "domain", "file_name", "source_type", "status", "metadata.file_size_bytes",
        F.col("metadata.parse_outputs").isNotNull().alias("has_outputs"),
    )


def status_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs, successes and failures recorded from the event log, the last event of a document first applied."""
    docs = document_table(spark, sf)
    log = ca.latest(table(spark, sf, "events").select(F.col("user_id").alias("document_id"), "event_id", "event_type", "props"), ["document_id"], "event_id")
    jobs = log.select("document_id", F.concat(F.lit("job"), F.col("event_id").cast("string")).alias("job_id"), F.lit("key_1").alias("api_key_alias"))
    done = log.filter("event_type = 'purchase'").select("document_id", F.create_map(F.lit("event"), F.col("event_type")).alias("outputs"))
    failed = log.filter("event_type = 'error'").select("document_id", F.repeat("props", 500).alias("error"))
    changed = ca.mark_failed(ca.mark_parsed(ca.save_jobs(docs, jobs), done), failed)
    return changed.select(
        "document_id", "status", "metadata.job.job_id", F.element_at("metadata.parse_outputs", "event").alias("event"),
        F.length("metadata.parse_error").alias("error_chars"),
    )


def pending_documents(spark: SparkSession, sf: str) -> DataFrame:
    return ca.pending_documents(document_table(spark, sf), "pdf").select("document_id", "domain", "file_name", "status")


def chunkable_documents(spark: SparkSession, sf: str) -> DataFrame:
    return ca.chunkable_documents(document_table(spark, sf)).select("document_id", "domain", "file_name", "source_type")


def recoverable_documents(spark: SparkSession, sf: str) -> DataFrame:
    return ca.recoverable_documents(document_table(spark, sf)).select(
        "document_id", "file_name", F.element_at("metadata.parse_outputs", "markdown_path").alias("markdown_path")
    )


def unembedded_units(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("unit_id"), "text")
    done = table(spark, sf, "embeddings").select(F.col("vec_id").alias("unit_id"))
    return unembedded(docs, done).select("unit_id", F.length("text").alias("chars"))


def replaced_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Turns of relabelled conversations replace the stored ones."""
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("document_id"), "turn", F.md5("text").alias("text"))
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("document_id"), F.lit(-1).cast("bigint").alias("turn"), F.col("quality").cast("string").alias("text")
    )
    return ca.replace_documents(turns, labels)


def json_domain(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return events.groupBy("k").agg(F.count(F.lit(1)).alias("events"), F.round(F.sum("value"), 2).alias("value"))


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id", F.md5(tx.clean(F.col("text"))).alias("clean_md5"), F.md5(tx.markdown_cell(F.col("text"))).alias("cell_md5"),
        tx.token_count(F.col("text")).alias("tokens"), tx.clean_title(F.concat(F.lit("## "), F.col("source"))).alias("title"),
    )


def strip_citations(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    cited = F.concat(F.lit(" "), F.replace("text", F.lit("."), F.concat(F.lit(". ["), F.col("doc_id").cast("string"), F.lit("]"))), F.lit(" "))
    return docs.select("doc_id", F.md5(tx.strip_citations(cited)).alias("answer_md5"))


def uuid5_ids(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id", ids.uuid5(F.col("lang"), F.col("source"), F.col("text")).alias("id"),
        ids.document_id(F.col("lang"), F.lit("pdf"), F.concat(F.lit("Data/"), F.col("source"), F.lit(".PDF"))).alias("location_id"),
    )


def url_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", tx.url_name(F.col("url")).alias("name"))


def discover_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a file listing, a language per domain folder and mixed suffixes."""
    suffix = F.get(F.lit([".PDF", ".csv", ".txt", ".pdf"]), (F.col("doc_id") % 4).cast("int"))
    listed = table(spark, sf, "documents").select(
        F.concat(F.lit("file:/corpus/data/raw/"), F.col("lang"), F.lit("/Doc_"), F.col("doc_id").cast("string"), suffix).alias("path"), F.col("n_chars").alias("length")
    )
    return di.describe_files(listed, "/corpus")


def discover_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as crawl manifest entries, some bare, some with a nested configuration, some without url."""
    pages = table(spark, sf, "pages")
    nested = F.struct("url", F.lit(5).alias("limit"), F.array(F.lit("markdown")).alias("formats"))
    entry = F.to_json(
        F.struct(
            F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("page "), F.col("page_id").cast("string"))).alias("name"),
            F.when(F.col("page_id") % 5 != 4, F.col("url")).alias("url"), F.when(F.col("page_id") % 3 == 0, nested).alias("firecrawl_config"),
        )
    )
    path = F.concat(F.lit("file:/corpus/data/raw/legal/list_"), F.col("page_id").cast("string"), F.lit(".json"))
    rows = pages.select(path.alias("path"), entry.alias("entry"), F.lit(0).alias("position"))
    return di.describe_sources(rows, "/corpus").select("document_id", "domain", "file_name", "file_path", "parser_used")


def image_paths(spark: SparkSession, sf: str) -> DataFrame:
    """Turns as children of a conversation that refer to image files by stem."""
    turns = table(spark, sf, "conversations")
    refs = F.array(
        F.concat(F.lit("d:p1:img_"), (F.col("turn") % 5).cast("string")), F.concat(F.lit("d:p1:img_"), F.col("conv_id").cast("string")),
        F.concat(F.lit("d:p1:img_"), (F.col("turn") % 5).cast("string")),
    )
    children = turns.select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("chunk_id"), F.col("role").alias("domain"),
        F.concat(F.lit("talk"), (F.col("conv_id") % 10).cast("string"), F.lit(".pdf")).alias("file_name"), refs.alias("image_refs"),
    )
    files = turns.select(
        F.col("role").alias("domain"), F.concat(F.lit("talk"), (F.col("conv_id") % 10).cast("string")).alias("slug"),
        F.explode(F.array(F.lit("jpg"), F.lit("png"))).alias("kind"), F.col("turn"),
    ).select("domain", "slug", F.concat(F.lit("images/"), "domain", F.lit("/"), "slug", F.lit("/img_"), F.col("turn").cast("string"), F.lit("."), "kind").alias("path"))
    return ch.resolve_images(children, files).select("chunk_id", F.array_join("image_paths", ",").alias("image_paths"))


def eval_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents as scored questions; toxic ones could not be scored for one metric."""
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id")
    nan = F.lit(float("nan"))
    return rows.select(
        F.when(F.col("lang") == "es", "out_of_scope").otherwise(F.col("lang")).alias("domain"), F.col("quality").cast("double").alias("faithfulness"),
        (F.lit(1.0) / (F.col("n_chars") % 10 + 1)).alias("answer_relevancy"),
        F.when((F.col("toxic") == 1) | (F.col("lang") == "es"), nan).otherwise(F.col("quality") / 2).alias("context_precision"),
        F.when(F.col("quality") == 0, F.lit(None).cast("double")).otherwise(F.col("n_chars") % 7 / F.lit(7.0)).alias("context_recall"),
    )


def eval_slices(spark: SparkSession, sf: str) -> DataFrame:
    return ev.slice_scores(eval_scores(spark, sf))


def eval_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return ev.coverage(eval_scores(spark, sf))


QUERIES = {
    "document_upsert": document_upsert,
    "status_changes": status_changes,
    "pending_documents": pending_documents,
    "chunkable_documents": chunkable_documents,
    "recoverable_documents": recoverable_documents,
    "unembedded_units": unembedded_units,
    "replaced_rows": replaced_rows,
    "json_domain": json_domain,
    "clean_text": clean_text,
    "strip_citations": strip_citations,
    "uuid5_ids": uuid5_ids,
    "url_names": url_names,
    "discover_files": discover_files,
    "discover_sources": discover_sources,
    "image_paths": image_paths,
    "eval_slices": eval_slices,
    "eval_coverage": eval_coverage,
}

_DOCS = """
dt AS (SELECT doc_id AS document_id, lang AS domain, source AS file_name, ['csv', 'pdf', 'html'][doc_id % 3 + 1] AS source_type,
    CASE quality WHEN 1 THEN 'parsed' WHEN 0 THEN 'failed' ELSE 'discovered' END AS status, n_chars, quality FROM documents LEFT JOIN labels USING (doc_id))"""
_METRIC = lambda c: f"round_even(avg(CASE WHEN NOT isnan({c}) THEN {c} END), 4) AS {c}, count(CASE WHEN NOT isnan({c}) THEN {c} END) AS {c}_scored"
_SCORES = """
s AS (SELECT CASE WHEN lang = 'es' THEN 'out_of_scope' ELSE lang END AS domain, quality::DOUBLE AS faithfulness, 1.0::DOUBLE / (n_chars % 10 + 1) AS answer_relevancy,
    CASE WHEN toxic = 1 OR lang = 'es' THEN 'nan'::DOUBLE ELSE quality / 2.0::DOUBLE END AS context_precision,
    CASE WHEN quality <> 0 THEN (n_chars % 7) / 7.0::DOUBLE END AS context_recall FROM labels JOIN documents USING (doc_id))"""

ORACLES = {
    "document_upsert": f"""WITH {_DOCS}, n AS (SELECT page_id * 5 AS document_id, url, length(html) AS size FROM pages)
SELECT coalesce(n.document_id, dt.document_id) AS document_id, CASE WHEN n.document_id IS NULL THEN domain ELSE 'web' END AS domain,
  coalesce(url, file_name) AS file_name, CASE WHEN n.document_id IS NULL THEN source_type ELSE 'html' END AS source_type, coalesce(status, 'discovered') AS status,
  coalesce(size, n_chars) AS file_size_bytes, (n.document_id IS NULL AND coalesce(quality, 0) = 1) AS has_outputs FROM dt FULL JOIN n ON n.document_id = dt.document_id""",
    "status_changes": f"""WITH {_DOCS}, l AS (SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS e, arg_max(props, event_id) AS props FROM events GROUP BY 1)
SELECT document_id, CASE e WHEN 'purchase' THEN 'parsed' WHEN 'error' THEN 'failed' ELSE status END AS status, 'job' || event_id AS job_id,
  CASE WHEN e = 'purchase' THEN e END AS event, CASE WHEN e = 'error' THEN least(2000, length(props) * 500) END::INT AS error_chars
FROM dt LEFT JOIN l ON user_id = document_id""",
    "pending_documents": f"WITH {_DOCS} SELECT document_id, domain, file_name, status FROM dt WHERE status <> 'parsed' AND source_type = 'pdf'",
    "chunkable_documents": f"WITH {_DOCS} SELECT document_id, domain, file_name, source_type FROM dt WHERE source_type IN ('pdf', 'html')",
    "recoverable_documents": f"WITH {_DOCS} SELECT document_id, file_name, 'out/' || document_id AS markdown_path FROM dt WHERE status = 'parsed'",
    "unembedded_units": """SELECT doc_id AS unit_id, length(text)::INT AS chars FROM documents
WHERE length(trim(text, ' ')) > 0 AND NOT EXISTS (SELECT 1 FROM embeddings WHERE vec_id = doc_id)""",
    "replaced_rows": """SELECT conv_id AS document_id, turn, md5(text) AS text FROM conversations WHERE NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = conv_id)
UNION ALL SELECT doc_id, -1, quality::VARCHAR FROM labels""",
    "json_domain": "SELECT props->>'$.k' AS k, count(*) AS events, round(sum(value), 2) AS value FROM events GROUP BY 1",
    "clean_text": r"""SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS clean_md5,
  md5(replace(replace(replace(trim(text, e' \n\t\r'), '|', chr(92) || '|'), chr(13), ' '), chr(10), ' ')) AS cell_md5,
  len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''))::INT AS tokens, source AS title FROM documents""",
    "strip_citations": r"""SELECT doc_id, md5(trim(regexp_replace(' ' || replace(text, '.', '. [' || doc_id || ']') || ' ', '\s*\[\d+\]', '', 'g'), e' \n\t\r')) AS answer_md5 FROM documents""",
    "uuid5_ids": f"""SELECT doc_id, {sql_uuid5("lang || ':' || source || ':' || text")} AS id,
  {sql_uuid5("lang || ':pdf:' || lower('Data/' || source || '.PDF')")} AS location_id FROM documents""",
    "url_names": r"""SELECT page_id, CASE WHEN stem <> '' AND stem NOT IN ('drugInfo', 'lookup') THEN stem ELSE replace(host, '.', '_') END AS name FROM (
  SELECT page_id, regexp_extract(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '([^/]+?)(?:\.[^./]*)?/*$', 1) AS stem, regexp_extract(url, '^[^:]+://([^/?#]*)', 1) AS host FROM pages)""",
    "discover_files": f"""WITH f AS (SELECT lang, n_chars, 'Doc_' || doc_id || ['.PDF', '.csv', '.txt', '.pdf'][doc_id % 4 + 1] AS file_name,
    ['pdf', 'csv', 'txt', 'pdf'][doc_id % 4 + 1] AS source_type FROM documents)
SELECT {sql_uuid5("lang || ':' || source_type || ':' || lower('data/raw/' || lang || '/' || file_name)")} AS document_id, lang AS domain, file_name, source_type,
  'data/raw/' || lang || '/' || file_name AS file_path, CASE source_type WHEN 'pdf' THEN 'llamaparse' ELSE 'pandas' END AS parser_used,
  '{{"file_size_bytes":' || n_chars || '}}' AS metadata FROM f WHERE source_type <> 'txt'""",
    "discover_sources": f"""SELECT {sql_uuid5("'legal:html:' || lower(url)")} AS document_id, 'legal' AS domain,
  CASE WHEN page_id % 2 = 0 THEN 'page ' || page_id ELSE 'list_' || page_id END AS file_name, url AS file_path, 'firecrawl' AS parser_used
FROM pages WHERE page_id % 5 <> 4 OR page_id % 3 = 0""",
    "image_paths": """
WITH c AS (SELECT conv_id || '-' || turn AS chunk_id, role, 'talk' || (conv_id % 10) AS slug, unnest([turn % 5, conv_id, turn % 5]) AS stem, unnest([0, 1, 2]) AS pos FROM conversations),
f AS (SELECT DISTINCT role, 'talk' || (conv_id % 10) AS slug, turn AS stem FROM conversations)
SELECT c.chunk_id, coalesce(string_agg('images/' || f.role || '/' || f.slug || '/img_' || f.stem || '.jpg', ',' ORDER BY pos) FILTER (f.stem IS NOT NULL), '') AS image_paths
FROM c LEFT JOIN f ON f.role = c.role AND f.slug = c.slug AND f.stem = c.stem GROUP BY 1""",
    "eval_slices": f"""WITH {_SCORES}, x AS (SELECT 'overall' AS slice, * FROM s UNION ALL SELECT 'in_scope', * FROM s WHERE domain <> 'out_of_scope' UNION ALL SELECT 'domain:' || domain, * FROM s)
SELECT slice, {", ".join(_METRIC(m) for m in ev.METRICS)}, count(*) AS "count" FROM x GROUP BY slice""",
    "eval_coverage": f"""WITH {_SCORES} SELECT metric, count(CASE WHEN NOT isnan(value) THEN 1 END) AS scored, count(*) AS total FROM ("""
    + " UNION ALL ".join(f"SELECT '{m}' AS metric, {m} AS value FROM s" for m in ev.METRICS)
    + ") GROUP BY metric",
}
