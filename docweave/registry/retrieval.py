"""Registered queries of the retrieval side: routing, search, fusion, answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators import centroids as ct
from docweave.operators import fuse
from docweave.operators.embedding import embed_sparse
from docweave.operators.topk import is_small, scan_topk
from docweave.plans import answer as an
from docweave.plans.hybrid import SearchParams, attach_units, hybrid_search, routed_queries
from docweave.registry.base import sql_words, table
from docweave.session import cut_lineage
from docweave.settings import DEFAULTS

# Units that stand in for child chunks are texts longer than this many characters.
CHILD_CHARS = 1500


def label_units(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector as a unit whose domain is its label."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("unit_id"), F.col("label").cast("string").alias("domain"), F.col("embedding").alias("vector")
    )


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark text as a query; its vector is the embedding of the same number."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    texts = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return embed_sparse(texts.join(vectors, "query_id", "left"), "query")


def document_units(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a unit; its language is the domain."""
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("unit_id"), F.col("embedding").alias("vector"))
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("unit_id"),
        F.col("doc_id").alias("document_id"),
        F.when(F.col("n_chars") > CHILD_CHARS, "child_chunks").otherwise("category_docs").alias("source_table"),
        F.floor(F.col("doc_id") / 3).alias("parent_id"),
        F.col("lang").alias("domain"),
        "text",
        F.col("source").alias("file_name"),
    )
    return embed_sparse(docs.join(vectors, "unit_id", "left"))


def document_parents(spark: SparkSession, sf: str) -> DataFrame:
    """Three neighbouring documents form one parent section."""
    docs = table(spark, sf, "documents").withColumn("parent_id", F.floor(F.col("doc_id") / 3))
    texts = F.sort_array(F.collect_list(F.struct("doc_id", "text", "source")))
    return docs.groupBy("parent_id").agg(texts.alias("d")).select(
        "parent_id",
        F.array_join("d.text", "\n\n").alias("parent_text"),
        F.concat(F.lit("Section "), F.col("parent_id").cast("string")).alias("section_title"),
        F.col("d.source").alias("section_path"),
    )


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


def domain_centroids(spark: SparkSession, sf: str) -> DataFrame:
    cents = ct.domain_centroids(label_units(spark, sf))
    return cents.select(
        "domain", F.col("source_count").cast("bigint").alias("source_count"), F.posexplode("vector").alias("place", "value")
    ).withColumn("value", F.round("value", 6))


def route_top2(spark: SparkSession, sf: str) -> DataFrame:
    cents = ct.domain_centroids(label_units(spark, sf))
    return _rounded(ct.route(questions(spark, sf), cents, 2), "distance")


def dense_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(scan_topk(label_units(spark, sf), questions(spark, sf), "dense", 20), "score")


def dense_topk_routed(spark: SparkSession, sf: str) -> DataFrame:
    units = label_units(spark, sf)
    scoped = routed_queries(questions(spark, sf), ct.domain_centroids(units), SearchParams())
    return _rounded(scan_topk(units, scoped, "dense", 20), "score")


def sparse_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(scan_topk(document_units(spark, sf), questions(spark, sf), "sparse", 20), "score")


def sparse_embedding(spark: SparkSession, sf: str) -> DataFrame:
    docs = embed_sparse(table(spark, sf, "documents").select("doc_id", "text"))
    return docs.select("doc_id", F.arrays_zip("terms", "weights").alias("z")).select("doc_id", F.inline("z")).select(
        "doc_id", F.col("terms").alias("term"), F.round("weights", 6).alias("weight")
    )


def rrf_fusion(spark: SparkSession, sf: str) -> DataFrame:
    units, queries = document_units(spark, sf), questions(spark, sf)
    fused = fuse.reciprocal_rank_fusion(scan_topk(units, queries, "dense", 20), scan_topk(units, queries, "sparse", 20))
    return _rounded(fused, "dense_score", "sparse_score", "rrf_score")


def _hits(spark: SparkSession, sf: str, k: int = DEFAULTS.rerank_k) -> tuple[DataFrame, DataFrame]:
    units, queries = document_units(spark, sf), questions(spark, sf)
    hits = hybrid_search(
        units, queries, ct.domain_centroids(units), document_parents(spark, sf), SearchParams(rerank_k=k)
    )
    return hits, queries


def hybrid(spark: SparkSession, sf: str) -> DataFrame:
    hits, _ = _hits(spark, sf)
    return _rounded(hits, "rrf_score", "rerank_score").select(
        "query_id", "unit_id", "domain", "source_table", "parent_id", "section_title",
        F.length("text").alias("text_chars"), "rrf_score", "rerank_score", "rank",
    )


def parent_expansion(spark: SparkSession, sf: str) -> DataFrame:
    """Children found by sparse search, replaced by their parents."""
    units, queries = document_units(spark, sf), questions(spark, sf)
    found = cut_lineage(scan_topk(units, queries, "sparse", 20))
    small = is_small(queries, DEFAULTS.query_batch_rows)
    hits = attach_units(found, units, ["source_table", "parent_id", "text"], small)
    return fuse.expand_to_parents(hits, document_parents(spark, sf), small).select(
        "query_id", "rank", "unit_id", "source_table", "parent_id", "section_title",
        F.array_join("section_path", ">").alias("section_path"), F.length("text").alias("text_chars"),
    )


def rerank_topk(spark: SparkSession, sf: str) -> DataFrame:
    units, queries = document_units(spark, sf), questions(spark, sf)
    found = scan_topk(units, queries, "sparse", 20)
    hits = units.select("unit_id", "text").join(found.drop("score"), "unit_id")
    return _rounded(fuse.rerank(hits, queries, DEFAULTS.rerank_k), "rerank_score").select(
        "query_id", "unit_id", "rerank_score", "rank"
    )


def score_floor(spark: SparkSession, sf: str) -> DataFrame:
    """Dense hits reranked; few share words with the query, so the floor decides."""
    units, queries = document_units(spark, sf), questions(spark, sf)
    found = scan_topk(units, queries, "dense", 20)
    hits = units.select("unit_id", "text").join(found.drop("score"), "unit_id")
    ranked = fuse.rerank(hits, queries, DEFAULTS.rerank_k)
    return _rounded(fuse.score_floor(ranked, 0.6), "rerank_score").select("query_id", "unit_id", "rerank_score", "rank")


def citations(spark: SparkSession, sf: str) -> DataFrame:
    hits, _ = _hits(spark, sf)
    held = fuse.score_floor(hits, DEFAULTS.score_floor)
    # Hits of odd documents carry metadata, the others have none.
    held = held.withColumn("metadata", F.when(F.pmod(F.col("document_id").cast("bigint"), F.lit(2)) == 1, F.create_map(F.lit("file_name"), F.col("file_name"))))
    return an.citations(held).select("query_id", "document_id", "chunk_id", "label", "number", F.element_at("metadata", "file_name").alias("file_name"))


def context_blocks(spark: SparkSession, sf: str) -> DataFrame:
    hits, _ = _hits(spark, sf)
    return an.context_blocks(fuse.score_floor(hits, DEFAULTS.score_floor)).select(
        "query_id", F.md5("context").alias("context_md5"), F.length("context").alias("context_chars"),
        F.size("contexts").alias("sources"),
    )


def answers(spark: SparkSession, sf: str) -> DataFrame:
    hits, queries = _hits(spark, sf)
    found = an.answer_queries(hits, queries)
    return found.select(
        "query_id", F.md5(an.prompt(F.col("query"), F.col("context"))).alias("prompt_md5"), F.md5("answer").alias("answer_md5")
    )


QUERIES = {
    "domain_centroids": domain_centroids,
    "route_top2": route_top2,
    "dense_topk": dense_topk,
    "dense_topk_routed": dense_topk_routed,
    "sparse_embedding": sparse_embedding,
    "sparse_topk": sparse_topk,
    "rrf_fusion": rrf_fusion,
    "hybrid_search": hybrid,
    "parent_expansion": parent_expansion,
    "rerank_topk": rerank_topk,
    "score_floor": score_floor,
    "citations": citations,
    "context_blocks": context_blocks,
    "answers": answers,
}

_LABEL_CENTROIDS = """
cent AS (
  SELECT label::VARCHAR AS domain, place, avg(value::DOUBLE) AS value, count(*) AS n FROM (
    SELECT label, unnest(embedding) AS value, generate_subscripts(embedding, 1) - 1 AS place FROM embeddings)
  GROUP BY 1, 2),
centroid AS (SELECT domain, list(value ORDER BY place) AS v FROM cent GROUP BY 1)"""

_QUESTIONS = """
q AS (SELECT item_id AS query_id, text AS query, embedding::DOUBLE[] AS v
      FROM benchmark LEFT JOIN embeddings ON item_id = vec_id)"""

_ROUTES = """
route AS (SELECT * FROM (
  SELECT query_id, domain, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, domain) AS rank FROM (
    SELECT query_id, domain, round(list_cosine_distance(c.v, q.v), 9) AS distance FROM q, centroid c WHERE q.v IS NOT NULL))
  WHERE rank <= 2)"""


def _weights(name: str, relation: str, key: str) -> str:
    return f"""
{name} AS (SELECT {key}, term, ln(1 + tf::DOUBLE) AS w FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY tf DESC, term) AS nth FROM (
    SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest({sql_words('text')}) AS term FROM {relation}) GROUP BY 1, 2))
  WHERE nth <= 512)"""


_UNITS = f"""
u AS (SELECT doc_id AS unit_id, doc_id AS document_id,
        CASE WHEN n_chars > {CHILD_CHARS} THEN 'child_chunks' ELSE 'category_docs' END AS source_table,
        doc_id // 3 AS parent_id, lang AS domain, text, source AS file_name, embedding::DOUBLE[] AS v
      FROM documents LEFT JOIN embeddings ON doc_id = vec_id),
parents AS (SELECT doc_id // 3 AS parent_id, string_agg(text, chr(10) || chr(10) ORDER BY doc_id) AS parent_text,
        'Section ' || (doc_id // 3)::VARCHAR AS section_title, string_agg(source, '>' ORDER BY doc_id) AS section_path
      FROM documents GROUP BY doc_id // 3)"""

_TERMS = ",".join([_weights("qw", "benchmark", "item_id"), _weights("uw", "documents", "doc_id")])


def _dense(name: str, scoped: bool) -> str:
    scope = "AND u.domain IN (SELECT domain FROM route r WHERE r.query_id = q.query_id)" if scoped else ""
    return f"""
{name} AS (SELECT * FROM (
  SELECT query_id, unit_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score, unit_id) AS rank FROM (
    SELECT query_id, unit_id, round(list_cosine_distance(u.v, q.v), 9) AS score FROM q, u
    WHERE u.v IS NOT NULL AND q.v IS NOT NULL {scope})) WHERE rank <= 20)"""


def _sparse(name: str, scoped: bool) -> str:
    scope = "WHERE u.domain IN (SELECT domain FROM route r WHERE r.query_id = q.query_id)" if scoped else ""
    return f"""
ip AS (SELECT item_id AS query_id, doc_id AS unit_id, sum(qw.w * uw.w) AS s FROM qw JOIN uw USING (term) GROUP BY 1, 2),
{name} AS (SELECT * FROM (
  SELECT query_id, unit_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, unit_id) AS rank FROM (
    SELECT q.query_id, u.unit_id, round(coalesce(ip.s, 0), 9) AS score
    FROM q CROSS JOIN u LEFT JOIN ip ON ip.query_id = q.query_id AND ip.unit_id = u.unit_id {scope})) WHERE rank <= 20)"""


_FUSED = """
fused AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, seen) AS rank FROM (
  SELECT coalesce(d.query_id, s.query_id) AS query_id, coalesce(d.unit_id, s.unit_id) AS unit_id,
    d.score AS dense_score, s.score AS sparse_score,
    coalesce(1.0::DOUBLE / (60 + d.rank), 0) + coalesce(1.0::DOUBLE / (60 + s.rank), 0) AS rrf_score,
    coalesce(d.rank, s.rank + 1000000) AS seen
  FROM d FULL JOIN s ON d.query_id = s.query_id AND d.unit_id = s.unit_id))"""

_LANG_CENTROIDS = """
cent AS (
  SELECT domain, place, avg(value) AS value FROM (
    SELECT domain, unnest(v) AS value, generate_subscripts(v, 1) AS place FROM u WHERE v IS NOT NULL)
  GROUP BY 1, 2),
centroid AS (SELECT domain, list(value ORDER BY place) AS v FROM cent GROUP BY 1)"""


def _expanded(hits: str) -> str:
    return f"""
expanded AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, kind, id ORDER BY rank) AS nth FROM (
    SELECT h.*, p.parent_id AS found_parent, p.section_title, p.section_path, u.document_id, u.source_table, u.domain,
      u.file_name, coalesce(p.parent_text, u.text) AS text,
      CASE WHEN p.parent_id IS NOT NULL THEN 'parent' ELSE u.source_table END AS kind,
      coalesce(p.parent_id, h.unit_id) AS id
    FROM {hits} h JOIN u USING (unit_id)
    LEFT JOIN parents p ON u.source_table = 'child_chunks' AND u.parent_id = p.parent_id)) WHERE nth = 1)"""


def _reranked(hits: str) -> str:
    wanted = f"list_distinct({sql_words('query')})"
    return f"""
reranked AS (SELECT * EXCLUDE (rank), new_rank AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rerank_score DESC, rank) AS new_rank FROM (
    SELECT h.*, q.query,
      coalesce(len(list_intersect({wanted}, list_distinct({sql_words('h.text')})))::DOUBLE / nullif(len({wanted}), 0), 0) AS rerank_score
    FROM {hits} h JOIN q USING (query_id))) WHERE new_rank <= 8)"""


def _floored(floor: float) -> str:
    return f"""
kept AS (SELECT * FROM (SELECT *, bool_or(rerank_score >= {floor}) OVER (PARTITION BY query_id) AS any_pass FROM reranked)
  WHERE rerank_score >= {floor} OR (NOT any_pass AND rank = 1)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS number FROM kept)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_HYBRID = _with(
    _QUESTIONS, _UNITS, _LANG_CENTROIDS, _ROUTES, _TERMS, _dense("d", True), _sparse("s", True), _FUSED,
    _expanded("fused"), _reranked("expanded"),
)
_BLOCKS = f"""
blocks AS (SELECT query_id, count(*)::INT AS sources, string_agg(
    '[' || number || ']' || ' ' || concat_ws(' | ', coalesce(nullif(section_title, ''), file_name), 'domain=' || domain)
    || chr(10) || text, chr(10) || chr(10) ORDER BY number) AS context
  FROM numbered GROUP BY 1)"""

ORACLES = {
    "domain_centroids": f"WITH {_LABEL_CENTROIDS} SELECT domain, n AS source_count, place::INT AS place, round(value, 6) AS value FROM cent",
    "route_top2": _with(_QUESTIONS, _LABEL_CENTROIDS, _ROUTES)
    + " SELECT query_id, domain, round(distance, 6) AS distance, rank::INT AS rank FROM route",
    "dense_topk": _with(_QUESTIONS, "u AS (SELECT vec_id AS unit_id, embedding::DOUBLE[] AS v FROM embeddings)", _dense("d", False))
    + " SELECT query_id, unit_id, round(score, 6) AS score, rank::INT AS rank FROM d",
    "dense_topk_routed": _with(
        _QUESTIONS, "u AS (SELECT vec_id AS unit_id, label::VARCHAR AS domain, embedding::DOUBLE[] AS v FROM embeddings)",
        _LABEL_CENTROIDS, _ROUTES, _dense("d", True),
    )
    + " SELECT query_id, unit_id, round(score, 6) AS score, rank::INT AS rank FROM d",
    "sparse_embedding": _with(_weights("uw", "documents", "doc_id")) + " SELECT doc_id, term, round(w, 6) AS weight FROM uw",
    "sparse_topk": _with(_QUESTIONS, _UNITS, _TERMS, _sparse("s", False))
    + " SELECT query_id, unit_id, round(score, 6) AS score, rank::INT AS rank FROM s",
    "rrf_fusion": _with(_QUESTIONS, _UNITS, _TERMS, _dense("d", False), _sparse("s", False), _FUSED)
    + """ SELECT query_id, unit_id, round(dense_score, 6) AS dense_score, round(sparse_score, 6) AS sparse_score,
    round(rrf_score, 6) AS rrf_score, rank::INT AS rank FROM fused""",
    "hybrid_search": _HYBRID
    + """ SELECT query_id, unit_id, domain, source_table, found_parent AS parent_id, section_title,
    length(text)::INT AS text_chars, round(rrf_score, 6) AS rrf_score, round(rerank_score, 6) AS rerank_score,
    rank::INT AS rank FROM reranked""",
    "parent_expansion": _with(_QUESTIONS, _UNITS, _TERMS, _sparse("s", False), _expanded("s"))
    + """ SELECT query_id, rank::INT AS rank, unit_id, source_table, found_parent AS parent_id, section_title, section_path,
    length(text)::INT AS text_chars FROM expanded""",
    "rerank_topk": _with(
        _QUESTIONS, _UNITS, _TERMS, _sparse("s", False), "hits AS (SELECT s.*, u.text FROM s JOIN u USING (unit_id))",
        _reranked("hits"),
    )
    + " SELECT query_id, unit_id, round(rerank_score, 6) AS rerank_score, rank::INT AS rank FROM reranked",
    "score_floor": _with(
        _QUESTIONS, _UNITS, _dense("d", False), "hits AS (SELECT d.*, u.text FROM d JOIN u USING (unit_id))",
        _reranked("hits"), _floored(0.6),
    )
    + " SELECT query_id, unit_id, round(rerank_score, 6) AS rerank_score, rank::INT AS rank FROM kept",
    "citations": _HYBRID + "," + _floored(0.1)
    + """ SELECT query_id, document_id, unit_id AS chunk_id, '[' || number || ']' AS label, number::INT AS number,
    CASE WHEN document_id::BIGINT % 2 = 1 THEN file_name END AS file_name FROM numbered""",
    "context_blocks": _HYBRID + "," + _floored(0.1) + "," + _BLOCKS
    + " SELECT query_id, md5(context) AS context_md5, length(context)::INT AS context_chars, sources FROM blocks",
    "answers": _HYBRID + "," + _floored(0.1) + "," + _BLOCKS
    + r""" SELECT query_id, md5('Context (numbered sources):' || chr(10) || context || chr(10) || chr(10) || 'Question: ' || query
      || chr(10) || chr(10) || 'Give a direct, self-contained answer using only the sources above, '
      || 'citing markers like [1]. Do not add information the question did not ask for.') AS prompt_md5,
    md5(coalesce(nullif(trim(sentence, e' \n\t\r'), ''), trim(body, e' \n\t\r')) || ' [1]') AS answer_md5
  FROM (SELECT *, regexp_extract(body, '^([\s\S]*?[.!?])(?:\s|$)', 1) AS sentence FROM (
    SELECT b.query_id, q.query, b.context,
      regexp_extract(b.context, '^\[1\][^\n]*\n([\s\S]*?)(?:\n\n\[2\]|$)', 1) AS body
    FROM blocks b JOIN q USING (query_id)))""",
}
