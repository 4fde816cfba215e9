"""Registered queries of the fact rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.operators import rollup as ru
from docweave.operators.ordered import running
from docweave.registry.base import sql_uuid5, table
from docweave.sources import facts as fa

MEASURES = [
    "H_COMP_1_A", "H_NURSE_RESPECT", "H_COMP_2_A", "H_DOCTOR_LISTEN", "H_COMP_5_A", "H_MED_FOR", "H_SIDE_EFFECTS_A", "H_COMP_6_Y",
    "H_DISCH_HELP", "H_SYMPTOMS", "H_CLEAN_HSP", "H_QUIET_HSP", "H_HSP_RATING", "H_RECMND_DY", "H_STAR_RATING",
]


def survey_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a fact row of its customer; a nation is a source document."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, customers.c_nationkey == nations.n_nationkey)
        .join(regions, nations.n_regionkey == regions.r_regionkey)
        .withColumn("document_id", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))
    )
    numbered = running(
        joined, ["document_id"], F.floor(F.col("c_custkey") / 64), ["c_custkey", "o_orderkey"], {"at": ("sum", F.lit(1).cast("bigint"))}
    )
    text = lambda c: F.col(c).cast("string")
    status = F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "M/d/yyyy")
    return numbered.select(
        "document_id", F.lit("medical").alias("domain"), F.concat(text("n_name"), F.lit(".csv")).alias("file_name"),
        F.concat(F.lit(" "), text("c_custkey"), F.lit(" ")).alias("facility_id"), F.col("c_name").alias("facility_name"),
        F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("Street "), text("c_custkey"))).alias("address"),
        F.col("n_name").alias("city"), F.col("r_name").alias("state"), text("c_nationkey").alias("zip_code"),
        F.lit(None).cast("string").alias("county"), F.lit("N/A").alias("telephone"),
        F.get(F.lit(MEASURES), (F.col("o_orderkey") % len(MEASURES)).cast("int")).alias("measure_id"),
        F.when(F.col("o_orderkey") % 4 != 0, F.concat(F.col("o_orderpriority"), F.lit(" | "), F.col("c_mktsegment"))).alias("question"),
        F.lit("").alias("answer_description"),
        F.when(status == "F", "Not Applicable").when(status == "P", (F.col("o_orderkey") % 5 + 1).cast("string")).alias("star_rating"),
        F.lit(None).cast("string").alias("star_rating_footnote"),
        F.when(F.col("o_orderkey") % 3 == 0, "N/A").when(F.col("o_orderkey") % 3 == 1, (F.col("o_orderkey") % 100).cast("string")).alias("answer_percent"),
        F.lit(None).cast("string").alias("answer_percent_footnote"),
        F.when(F.col("o_orderkey") % 7 != 0, (F.col("o_orderkey") % 90).cast("string")).alias("linear_mean_value"),
        F.when(F.col("c_acctbal") > 0, F.floor("c_acctbal").cast("string")).alias("completed_surveys"),
        F.lit(None).cast("string").alias("completed_surveys_footnote"),
        F.when(F.col("c_custkey") % 3 != 0, text("c_nationkey")).alias("response_rate_percent"),
        F.lit(None).cast("string").alias("response_rate_footnote"),
        day.alias("survey_start_date"), day.alias("survey_end_date"), (F.col("at") + 1).alias("source_row_number"),
    )


def _joined(column: str) -> F.Column:
    return F.array_join(F.transform(column, lambda v: v.cast("string")), ",")


def fact_table(spark: SparkSession, sf: str) -> DataFrame:
    return fa.facts(survey_rows(spark, sf)).select(
        "document_id", "source_row_number", "facility_id", "telephone", "measure_id", "star_rating", "answer_percent",
        "completed_surveys", F.col("survey_start_date").cast("string").alias("survey_start_date"),
    )


def category_docs(spark: SparkSession, sf: str) -> DataFrame:
    return ru.category_docs(survey_rows(spark, sf)).select(
        "category_doc_id", "profile_id", "document_id", "facility_id", "category", "retrieval_text", "table_markdown",
        F.array_join("measure_ids", ",").alias("measure_ids"), _joined("source_row_numbers").alias("source_row_numbers"),
        F.array_join(F.transform(F.map_entries("summary"), lambda e: F.concat(e["key"], F.lit("="), e["value"]["result"])), ";").alias("summary"),
        F.col("metadata.hospital_name").alias("hospital_name"),
    )


def facility_profile(spark: SparkSession, sf: str) -> DataFrame:
    return ru.facility_profiles(survey_rows(spark, sf)).select(
        "profile_id", "document_id", "facility_id", "hospital_name", "retrieval_text",
        F.col("survey_start_date").cast("string").alias("survey_start_date"), "completed_surveys",
        F.size("category_summaries").alias("categories"), _joined("metadata.source_row_numbers").alias("source_row_numbers"),
        F.col("metadata.measure_count").alias("measure_count"),
    )


def result_choice(spark: SparkSession, sf: str) -> DataFrame:
    rows = survey_rows(spark, sf)
    r = ru.row_result(F.col("star_rating"), F.col("answer_percent"), F.col("linear_mean_value"))
    return rows.select("document_id", "source_row_number", r.alias("r")).select("document_id", "source_row_number", "r.result_type", "r.result")


def category_prefix(spark: SparkSession, sf: str) -> DataFrame:
    rows = survey_rows(spark, sf).withColumn("category", ru.category_of(F.col("measure_id")))
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("measure_id").alias("measures")).withColumn(
        "label", ru.category_label(F.col("category"))
    )


def contiguity_check(spark: SparkSession, sf: str) -> DataFrame:
    """Part lines numbered by order: an order is contiguous when no other order lies between its lines."""
    lines = table(spark, sf, "lineitem")
    numbered = running(
        lines.withColumn("document_id", F.col("l_returnflag")), ["document_id"], F.floor(F.col("l_suppkey") / 2),
        ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"], {"source_row_number": ("sum", F.lit(1).cast("bigint"))},
    )
    rows = numbered.withColumn("facility_id", F.col("l_orderkey").cast("string"))
    return ru.facility_runs(rows)


QUERIES = {
    "fact_table": fact_table,
    "category_docs": category_docs,
    "facility_profile": facility_profile,
    "result_choice": result_choice,
    "category_prefix": category_prefix,
    "contiguity_check": contiguity_check,
}

_LIST = "[" + ", ".join(f"'{m}'" for m in MEASURES) + "]"
_CATEGORY = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"starts_with(measure_id, '{p}')" for p in prefixes) + f" THEN '{c}'" for c, prefixes in ru.CATEGORY_PREFIXES.items()
) + " END"
_LABEL = "CASE category " + " ".join(f"WHEN '{c}' THEN '{label}'" for c, label in ru.CATEGORY_LABELS.items()) + " END"
_RANK = "CASE category " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(ru.CATEGORY_LABELS)) + " END"

_ROWS = f"""
rows0 AS (SELECT 'n' || c_nationkey AS document_id, c_custkey, o_orderkey, c_custkey::VARCHAR AS facility_id, c_name, n_name, r_name, c_nationkey,
    {_LIST}[o_orderkey % {len(MEASURES)} + 1] AS measure_id,
    CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority || ' | ' || c_mktsegment END AS q0,
    CASE o_orderstatus WHEN 'F' THEN 'Not Applicable' WHEN 'P' THEN (o_orderkey % 5 + 1)::VARCHAR END AS star,
    CASE o_orderkey % 3 WHEN 0 THEN 'N/A' WHEN 1 THEN (o_orderkey % 100)::VARCHAR END AS pct,
    CASE WHEN o_orderkey % 7 <> 0 THEN (o_orderkey % 90)::VARCHAR END AS mean,
    CASE WHEN c_acctbal > 0 THEN floor(c_acctbal)::BIGINT::VARCHAR END AS surveys,
    CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey::VARCHAR END AS rate,
    CASE WHEN c_custkey % 10 <> 0 THEN 'Street ' || c_custkey END AS address,
    strftime(o_orderdate, '%-m/%-d/%Y') AS day, o_orderdate::DATE::VARCHAR AS iso,
    row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey, o_orderkey) + 1 AS rn
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
rows1 AS (SELECT *, coalesce(q0, measure_id) AS question, {_CATEGORY} AS category,
    CASE WHEN star IS NOT NULL AND lower(star) NOT IN ('not applicable', 'not available', 'n/a') THEN 'star rating'
         WHEN pct IS NOT NULL AND lower(pct) <> 'n/a' THEN 'answer percent' WHEN mean IS NOT NULL THEN 'linear mean' ELSE 'result' END AS result_type,
    CASE WHEN star IS NOT NULL AND lower(star) NOT IN ('not applicable', 'not available', 'n/a') THEN star
         WHEN pct IS NOT NULL AND lower(pct) <> 'n/a' THEN pct || '%' WHEN mean IS NOT NULL THEN mean ELSE 'Not available' END AS result
  FROM rows0),
firsts AS (SELECT document_id, facility_id, arg_min(struct_pack(name := c_name, address := coalesce(address, 'None'), city := n_name, state := r_name,
    zip := c_nationkey::VARCHAR, day := day, iso := iso, surveys := surveys, rate := rate), rn) AS f, count(*) AS n,
    string_agg(rn::VARCHAR, ',' ORDER BY rn) AS numbers FROM rows1 GROUP BY 1, 2)"""
_PERIOD = """'Survey period: ' || f.day || ' to ' || f.day || chr(10) || 'Completed surveys: ' || coalesce(f.surveys, 'Not available') || chr(10)
  || 'Survey response rate: ' || coalesce(f.rate, 'Not available') || '%' || chr(10) || chr(10)"""

ORACLES = {
    "fact_table": f"""WITH {_ROWS} SELECT document_id, rn AS source_row_number, facility_id, NULL::VARCHAR AS telephone, measure_id,
    star AS star_rating, CASE WHEN pct <> 'N/A' THEN pct END AS answer_percent, surveys AS completed_surveys, iso AS survey_start_date FROM rows1""",
    "category_docs": f"""WITH {_ROWS},
docs AS (SELECT document_id, facility_id, category, string_agg('- ' || question || ': ' || result, chr(10) ORDER BY rn) AS bullets,
    string_agg('| ' || measure_id || ' | ' || replace(question, '|', chr(92) || '|') || ' | ' || result_type || ' | ' || result || ' |', chr(10) ORDER BY rn) AS cells,
    string_agg(measure_id, ',' ORDER BY rn) AS measure_ids, string_agg(rn::VARCHAR, ',' ORDER BY rn) AS source_row_numbers
  FROM rows1 GROUP BY 1, 2, 3),
last AS (SELECT document_id, facility_id, category, measure_id, min(rn) AS seen, arg_max(result, rn) AS result FROM rows1 GROUP BY 1, 2, 3, 4),
summ AS (SELECT document_id, facility_id, category, string_agg(measure_id || '=' || result, ';' ORDER BY seen) AS summary FROM last GROUP BY 1, 2, 3)
SELECT {sql_uuid5("document_id || ':' || facility_id || ':' || category")} AS category_doc_id,
  {sql_uuid5("document_id || ':' || facility_id || ':profile'")} AS profile_id, document_id, facility_id, category,
  'Hospital: ' || f.name || chr(10) || 'Facility ID: ' || facility_id || chr(10) || 'Location: ' || f.city || ', ' || f.state || chr(10)
  || 'Category: ' || {_LABEL} || chr(10) || {_PERIOD} || bullets AS retrieval_text,
  '| Measure ID | Measure | Result type | Result |' || chr(10) || '|---|---|---|---:|' || chr(10) || cells AS table_markdown,
  measure_ids, source_row_numbers, summary, f.name AS hospital_name
FROM docs JOIN summ USING (document_id, facility_id, category) JOIN firsts USING (document_id, facility_id)""",
    "facility_profile": f"""WITH {_ROWS},
cats AS (SELECT document_id, facility_id, count(*)::INT AS categories, string_agg('- ' || {_LABEL} || ': ' || m || ' measures', chr(10) ORDER BY {_RANK}) AS overview
  FROM (SELECT document_id, facility_id, category, count(DISTINCT measure_id) AS m FROM rows1 GROUP BY 1, 2, 3) GROUP BY 1, 2)
SELECT {sql_uuid5("document_id || ':' || facility_id || ':profile'")} AS profile_id, document_id, facility_id, f.name AS hospital_name,
  'Hospital: ' || f.name || chr(10) || 'Facility ID: ' || facility_id || chr(10) || 'Address: ' || f.address || ', ' || f.city || ', ' || f.state || ' ' || f.zip
  || chr(10) || {_PERIOD} || 'Available HCAHPS categories:' || chr(10) || overview AS retrieval_text,
  f.iso AS survey_start_date, f.surveys AS completed_surveys, categories, numbers AS source_row_numbers, n AS measure_count
FROM firsts JOIN cats USING (document_id, facility_id)""",
    "result_choice": f"WITH {_ROWS} SELECT document_id, rn AS source_row_number, result_type, result FROM rows1",
    "category_prefix": f"WITH {_ROWS} SELECT category, count(*) AS rows, count(DISTINCT measure_id) AS measures, {_LABEL} AS label FROM rows1 GROUP BY category",
    "contiguity_check": """
WITH r AS (SELECT l_returnflag AS document_id, l_orderkey::VARCHAR AS facility_id,
    row_number() OVER (PARTITION BY l_returnflag ORDER BY l_suppkey, l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem),
runs AS (SELECT *, CASE WHEN facility_id = lag(facility_id) OVER (PARTITION BY document_id ORDER BY rn) THEN 0 ELSE 1 END AS opens FROM r)
SELECT document_id, facility_id, min(rn) AS first_row, max(rn) AS last_row, count(*) AS rows, sum(opens) = 1 AS contiguous FROM runs GROUP BY 1, 2""",
}
