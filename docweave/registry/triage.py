"""Registered queries of duplicate, boilerplate and overlap triage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions import vectors as vx
from docweave.operators import components as cc
from docweave.operators import triage as tr
from docweave.registry.base import table

# Two embeddings of a label are near when their sign hashes differ in at most this many bits.
NEAR_BITS = 20


def image_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line as an image; 100 orders form a document, an order is a page."""
    lines = table(spark, sf, "lineitem")
    content = F.col("l_partkey") % 300
    base = F.md5(F.floor(content / 3).cast("string").cast("binary"))
    near = vx.hash_from_hex(F.substring(base, 1, 16)).bitwiseXOR(content % 3)
    page = F.col("l_orderkey") % 100
    idx = (page * 10 + F.col("l_linenumber")) * 1_000_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey")
    return lines.select(
        F.floor(F.col("l_orderkey") / 100).cast("string").alias("document_id"), idx.alias("idx"),
        F.concat(F.lit("img_p"), page.cast("string"), F.lit("_"), idx.cast("string"), F.lit(".png")).alias("filename"),
        page.cast("int").alias("page"),
        (F.floor(F.col("l_quantity") / 25) * 10).cast("double").alias("x"),
        (F.round(F.col("l_tax") * 100) % 3 * 8).cast("double").alias("y"),
        F.when(F.col("l_quantity") == 1, 20.0).otherwise(100 + F.round(F.col("l_discount") * 100) * 5).alias("w"),
        (80 + F.col("l_linenumber") % 3 * 10).cast("double").alias("h"),
        F.when(F.col("l_returnflag") == "R", "layout").otherwise("embedded").alias("category"),
        F.concat(F.lit("s"), content.cast("string")).alias("sha"), near.alias("phash"),
        (F.col("l_quantity") != 2).alias("found"), (content % 23 == 0).alias("photographic"),
    )


def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the same content hash point to the first of them."""
    docs = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    first = docs.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    joined = docs.join(first, "sha")
    return joined.select("doc_id", "sha", F.when(F.col("doc_id") > F.col("first"), F.col("first")).alias("duplicate_of"), "copies")


def boilerplate(spark: SparkSession, sf: str) -> DataFrame:
    """Document lines that occur in at least five sources."""
    docs = table(spark, sf, "documents").select("source", F.explode_outer(F.split("text", "\n")).alias("line"))
    spread = docs.groupBy("line", "source").agg(F.count(F.lit(1)).alias("n")).groupBy("line").agg(
        F.count(F.lit(1)).alias("sources"), F.sum("n").alias("occurrences")
    )
    return spread.filter("sources >= 5").select(F.md5("line").alias("line_md5"), "sources", "occurrences")


def near_dup_groups(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select(
        "vec_id", F.col("label").cast("string").alias("scope"), vx.sign_hash(F.col("embedding")).alias("hash")
    )
    groups = cc.near_groups(rows, NEAR_BITS)
    named = rows.join(groups, ["scope", "hash"])
    first = named.groupBy("scope", "component").agg(F.min("vec_id").alias("keeper"), F.count(F.lit(1)).alias("members"))
    return named.join(first, ["scope", "component"]).select("vec_id", F.col("scope").alias("label"), "keeper", "members")


def overlap_dedup(spark: SparkSession, sf: str) -> DataFrame:
    boxes = image_rows(spark, sf)
    return tr.overlap_drops(boxes, tr.TriageParams()).select("document_id", "idx", "keeper")


def image_triage(spark: SparkSession, sf: str) -> DataFrame:
    return tr.triage(image_rows(spark, sf)).select("document_id", "idx", "reason", "duplicate_of", "group_id")


def flag_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return tr.flag_manifest(tr.triage(image_rows(spark, sf)))


QUERIES = {
    "exact_dedup": exact_dedup,
    "boilerplate_lines": boilerplate,
    "near_dup_groups": near_dup_groups,
    "overlap_dedup": overlap_dedup,
    "image_triage": image_triage,
    "flag_manifest": flag_manifest,
}

_IMAGES = """
img AS (SELECT *, 'img_p' || page || '_' || idx || '.png' AS filename FROM (
  SELECT (l_orderkey // 100)::VARCHAR AS document_id, l_orderkey % 100 AS page,
    ((l_orderkey % 100) * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey AS idx,
    floor(l_quantity / 25) * 10 AS x, (round(l_tax * 100) % 3 * 8)::DOUBLE AS y,
    CASE WHEN l_quantity = 1 THEN 20 ELSE 100 + round(l_discount * 100) * 5 END::DOUBLE AS w,
    (80 + l_linenumber % 3 * 10)::DOUBLE AS h, CASE WHEN l_returnflag = 'R' THEN 'layout' ELSE 'embedded' END AS category,
    l_partkey % 300 AS content, l_quantity <> 2 AS found, l_partkey % 300 % 23 = 0 AS photo FROM lineitem))"""


def _overlap(source: str) -> str:
    return f"""
pairs AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY document_id, page ORDER BY a, b) AS n FROM (
  SELECT a.document_id, a.page, a.idx AS a, b.idx AS b, CASE
      WHEN a.category = 'embedded' AND b.category <> 'embedded' THEN true
      WHEN b.category = 'embedded' AND a.category <> 'embedded' THEN false ELSE a.w * a.h >= b.w * b.h END AS keep_a,
    greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) AS i,
    a.w * a.h + b.w * b.h AS u
  FROM {source} a JOIN {source} b ON a.document_id = b.document_id AND a.page = b.page AND a.idx < b.idx) WHERE i / (u - i) >= 0.6),
walk AS (SELECT document_id, page, 0::BIGINT AS n, NULL::BIGINT AS a, true AS ok, []::BIGINT[] AS gone, NULL::BIGINT AS lost, NULL::BIGINT AS keeper
    FROM (SELECT DISTINCT document_id, page FROM pairs)
  UNION ALL SELECT document_id, page, n, a, ok, CASE WHEN hit THEN list_append(gone, lost) ELSE gone END, CASE WHEN hit THEN lost END, CASE WHEN hit THEN keeper END
  FROM (SELECT *, ok AND NOT list_contains(gone, b) AS hit FROM (
    SELECT p.document_id, p.page, p.n, p.a, p.b, w.gone, CASE WHEN p.a IS DISTINCT FROM w.a THEN NOT list_contains(w.gone, p.a) ELSE w.ok END AS ok,
      CASE WHEN p.keep_a THEN p.b ELSE p.a END AS lost, CASE WHEN p.keep_a THEN p.a ELSE p.b END AS keeper
    FROM walk w JOIN pairs p ON p.document_id = w.document_id AND p.page = w.page AND p.n = w.n + 1))),
drops AS (SELECT document_id, lost AS idx, arg_min(keeper, n) AS keeper FROM walk WHERE lost IS NOT NULL GROUP BY 1, 2)"""


_TRIAGE = f"""
WITH RECURSIVE {_IMAGES},
spread AS (SELECT document_id, content, count(DISTINCT page) AS pages FROM img WHERE found GROUP BY 1, 2),
stage AS (SELECT img.*, CASE WHEN NOT found THEN 'missing_on_disk' WHEN pages >= 5 THEN 'boilerplate_repeated'
    WHEN least(w, h) < 28 OR greatest(w, h) / least(w, h) > 7 THEN 'decorative_dimensions' WHEN photo THEN 'photographic_content' END AS r1
  FROM img LEFT JOIN spread USING (document_id, content)),
copies AS (SELECT document_id, content, min(idx) AS first, arg_min(filename, idx) AS first_name FROM stage WHERE r1 IS NULL GROUP BY 1, 2),
stage2 AS (SELECT s.*, CASE WHEN r1 IS NULL AND idx > first THEN 'exact_duplicate' END AS r2, first_name FROM stage s LEFT JOIN copies USING (document_id, content)),
left1 AS (SELECT * FROM stage2 WHERE r1 IS NULL AND r2 IS NULL),
{_overlap("left1")},
left2 AS (SELECT l.* FROM left1 l ANTI JOIN drops USING (document_id, idx)),
near AS (SELECT document_id, content // 3 AS g, min(idx) AS first, arg_min(filename, idx) AS near_name FROM left2 GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY first) - 1 AS group_id FROM near),
final AS (SELECT s.document_id, s.idx,
    coalesce(s.r1, s.r2, CASE WHEN d.idx IS NOT NULL THEN 'overlap_duplicate' END, CASE WHEN l.idx > k.first THEN 'near_duplicate' END) AS reason,
    coalesce(CASE WHEN s.r2 IS NOT NULL THEN s.first_name END, o.filename, CASE WHEN l.idx > k.first THEN k.near_name END) AS duplicate_of, k.group_id
  FROM stage2 s LEFT JOIN drops d ON d.document_id = s.document_id AND d.idx = s.idx
  LEFT JOIN img o ON o.document_id = d.document_id AND o.idx = d.keeper
  LEFT JOIN left2 l ON l.document_id = s.document_id AND l.idx = s.idx
  LEFT JOIN ranked k ON k.document_id = l.document_id AND k.g = l.content // 3)"""

ORACLES = {
    "exact_dedup": """WITH d AS (SELECT doc_id, sha256(text) AS sha FROM documents)
SELECT doc_id, sha, CASE WHEN doc_id > first THEN first END AS duplicate_of, copies
FROM d JOIN (SELECT sha, min(doc_id) AS first, count(*) AS copies FROM d GROUP BY 1) USING (sha)""",
    "boilerplate_lines": """SELECT md5(line) AS line_md5, count(DISTINCT source) AS sources, count(*) AS occurrences
FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line HAVING count(DISTINCT source) >= 5""",
    "near_dup_groups": f"""
WITH RECURSIVE h AS (SELECT vec_id, label::VARCHAR AS label, list_sum(list_transform(embedding, lambda v, i: CASE WHEN v > 0 THEN (1::UBIGINT << (i - 1)::UBIGINT)::HUGEINT ELSE 0::HUGEINT END))::UBIGINT AS b FROM embeddings),
e AS (SELECT a.label, a.vec_id AS s, b.vec_id AS t FROM h a JOIN h b ON a.label = b.label AND a.vec_id <> b.vec_id AND bit_count(xor(a.b, b.b)) <= {NEAR_BITS}),
reach AS (SELECT label, vec_id, vec_id AS other FROM h UNION SELECT r.label, r.vec_id, e.t FROM reach r JOIN e ON e.s = r.other),
least AS (SELECT label, vec_id, min(other) AS keeper, count(*) AS members FROM reach GROUP BY 1, 2)
SELECT vec_id, label, keeper, members FROM least""",
    "overlap_dedup": f"WITH RECURSIVE {_IMAGES}, {_overlap('img')} SELECT document_id, idx, keeper FROM drops",
    "image_triage": _TRIAGE + " SELECT document_id, idx, reason, duplicate_of, group_id FROM final",
    "flag_manifest": _TRIAGE
    + """ SELECT document_id, count(*) FILTER (reason IS NULL) AS kept_count, count(*) FILTER (reason IS NOT NULL) AS flagged_count,
    count(DISTINCT group_id) FILTER (reason IS NULL) AS caption_group_count FROM final GROUP BY 1""",
}
