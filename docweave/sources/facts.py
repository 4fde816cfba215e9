"""Survey facts: the CSV scan with row numbers and typed, cleaned records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators.topk import is_small

# Above this many file splits the offsets are joined without a broadcast.
BROADCAST_SPLITS = 50_000

# CSV headers and the column names they get, in file order.
COLUMNS = {
    "Facility ID": "facility_id",
    "Facility Name": "facility_name",
    "Address": "address",
    "City/Town": "city",
    "State": "state",
    "ZIP Code": "zip_code",
    "County/Parish": "county",
    "Telephone Number": "telephone",
    "HCAHPS Measure ID": "measure_id",
    "HCAHPS Question": "question",
    "HCAHPS Answer Description": "answer_description",
    "Patient Survey Star Rating": "star_rating",
    "Patient Survey Star Rating Footnote": "star_rating_footnote",
    "HCAHPS Answer Percent": "answer_percent",
    "HCAHPS Answer Percent Footnote": "answer_percent_footnote",
    "HCAHPS Linear Mean Value": "linear_mean_value",
    "Number of Completed Surveys": "completed_surveys",
    "Number of Completed Surveys Footnote": "completed_surveys_footnote",
    "Survey Response Rate Percent": "response_rate_percent",
    "Survey Response Rate Percent Footnote": "response_rate_footnote",
    "Start Date": "survey_start_date",
    "End Date": "survey_end_date",
}

# Texts that read as missing in the facts (but not in the rollups).
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

def _has_open_quotes(spark: SparkSession, path: str) -> bool:
    """Does some line end inside quotes? Then records span lines, and a scan cut at lines would tear them."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def read_rows(spark: SparkSession, path: str, document_id: str, domain: str, multiline: bool | None = None) -> DataFrame:
    """Every data row as strings, with ``source_row_number`` = position in the file + 1 for the header.

    Columns go by the names in the header, whatever their order; other columns are left out and a missing one raises.
    Rows of one file split are consecutive, so a row's number is its offset in the split
    plus the rows of the splits before it; no file passes through one task.
    ``multiline`` reads quoted line breaks, at the price of one split per file; None looks whether there are any.
    """
    if multiline is None:
        multiline = _has_open_quotes(spark, path)
    scan = (
        spark.read.option("header", True).option("enforceSchema", False).option("multiLine", multiline)
        .option("escape", '"').option("mode", "PERMISSIVE").csv(path)
    )
    named = {name.lstrip("\ufeff").strip(): name for name in scan.columns}
    if missing := [header for header in COLUMNS if header not in named]:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    quoted = lambda name: F.col("`" + name.replace("`", "``") + "`")
    rows = scan.select(
        *[quoted(named[header]).alias(name) for header, name in COLUMNS.items()],
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split"),
    ).withColumn("_seq", F.monotonically_increasing_id())
    splits = rows.groupBy("_file", "_split").agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("_file", "_split", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    if is_small(splits, BROADCAST_SPLITS):
        offsets = F.broadcast(offsets)
    numbered = rows.join(offsets, ["_file", "_split"]).withColumn(
        "source_row_number", F.col("_before") + F.col("_seq") - F.col("_first") + 2
    )
    return numbered.select(
        F.lit(document_id).alias("document_id"), F.lit(domain).alias("domain"),
        F.regexp_extract("_file", r"([^/]*)$", 1).alias("file_name"), *COLUMNS.values(), "source_row_number",
    )


def parse_date(col: Column) -> Column:
    """Month/day/year; a malformed date raises."""
    return F.to_date(tx.clean_value(col), "M/d/yyyy")


def facts(rows: DataFrame) -> DataFrame:
    """The typed fact table: cleaned texts, NULL for missing-value texts, two dates."""
    present = {c: F.when(~F.col(c).isin(*NULL_TEXTS), F.col(c)) for c in COLUMNS.values()}
    cleaned = [tx.clean_value(e).alias(c) for c, e in present.items() if not c.endswith("_date")]
    dates = [parse_date(present[c]).alias(c) for c in ("survey_start_date", "survey_end_date")]
    return rows.select("document_id", "source_row_number", *cleaned, *dates)
