"""Grouped rollup of survey facts to profile and category documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.functions.ids import uuid5
from docweave.settings import DEFAULTS
from docweave.sources.facts import parse_date

# Measure prefixes of each category, categories in output order.
CATEGORY_PREFIXES = {
    "nurse_communication": ("H_COMP_1", "H_NURSE"),
    "doctor_communication": ("H_COMP_2", "H_DOCTOR"),
    "medication_communication": ("H_COMP_5", "H_MED", "H_SIDE_EFFECTS"),
    "discharge_information": ("H_COMP_6", "H_DISCH", "H_SYMPTOMS"),
    "hospital_environment": ("H_CLEAN", "H_QUIET"),
    "overall_rating_and_recommendation": ("H_HSP", "H_RECMND", "H_STAR_RATING"),
}
# Labels of the categories.
CATEGORY_LABELS = {
    "nurse_communication": "Nurse communication",
    "doctor_communication": "Doctor communication",
    "medication_communication": "Medication communication",
    "discharge_information": "Discharge information",
    "hospital_environment": "Hospital environment",
    "overall_rating_and_recommendation": "Overall rating and recommendation",
}
# Answers that carry no result, and the text written instead.
NO_RESULT = ("not applicable", "not available", "n/a")
MISSING = "Not available"
TABLE_HEAD = "| Measure ID | Measure | Result type | Result |\n|---|---|---|---:|"


def category_of(measure_id: Column) -> Column:
    """Category of a measure by its first matching prefix; an unmapped measure raises."""
    found = F.lit(None).cast("string")
    for category, prefixes in reversed(CATEGORY_PREFIXES.items()):
        match = F.lit(False)
        for prefix in prefixes:
            match = match | F.startswith(measure_id, F.lit(prefix))
        found = F.when(match, F.lit(category)).otherwise(found)
    unknown = F.raise_error(F.concat(F.lit("Unmapped measure: "), F.coalesce(measure_id, F.lit("NULL")))).cast("string")
    return F.coalesce(found, unknown)


def category_label(category: Column) -> Column:
    pairs = [F.lit(v) for item in CATEGORY_LABELS.items() for v in item]
    return F.element_at(F.create_map(*pairs), category)


def category_rank(category: Column) -> Column:
    return F.array_position(F.lit(list(CATEGORY_PREFIXES)), category)


def row_result(star: Column, percent: Column, mean: Column) -> Column:
    """``(result_type, result)``: the first usable of star rating, percent and linear mean."""

    def usable(label: str, value: Column, suffix: str = "") -> Column:
        cleaned = tx.clean_value(value)
        shown = F.struct(F.lit(label).alias("result_type"), F.concat(cleaned, F.lit(suffix)).alias("result"))
        return F.when(cleaned.isNotNull() & ~F.lower(cleaned).isin(*NO_RESULT), shown)

    return F.coalesce(
        usable("star rating", star),
        usable("answer percent", percent, "%"),
        usable("linear mean", mean),
        F.struct(F.lit("result").alias("result_type"), F.lit(MISSING).alias("result")),
    )


# Texts of the attributes every document prints; a missing one prints as None.
def _printed(col: Column) -> Column:
    return F.coalesce(col, F.lit("None"))


ATTRIBUTES = (
    "facility_name", "address", "city", "state", "zip_code", "county", "telephone",
    "survey_start_date", "survey_end_date", "completed_surveys", "response_rate_percent",
)


def facility_runs(rows: DataFrame) -> DataFrame:
    """Per facility its rows, first and last row, and whether they lie next to each other.

    Row numbers have no gaps, so a facility is contiguous when its span equals its count;
    no window over the whole file is needed.
    """
    runs = rows.groupBy("document_id", tx.clean_value(F.col("facility_id")).alias("facility_id")).agg(
        F.min("source_row_number").alias("first_row"), F.max("source_row_number").alias("last_row"),
        F.count(F.lit(1)).alias("rows"),
    )
    return runs.withColumn("contiguous", F.col("last_row") - F.col("first_row") + 1 == F.col("rows"))


def _facilities(rows: DataFrame) -> DataFrame:
    """Attributes of each facility's first row and its row count; a split facility raises."""
    first = F.struct(*[tx.clean_value(F.col(c)).alias(c) for c in ATTRIBUTES], "domain", "file_name")
    found = rows.groupBy("document_id", tx.clean_value(F.col("facility_id")).alias("facility_id")).agg(
        F.min_by(first, "source_row_number").alias("first"), F.count(F.lit(1)).alias("rows"),
        F.min("source_row_number").alias("first_row"), F.max("source_row_number").alias("last_row"),
    )
    whole = F.col("last_row") - F.col("first_row") + 1 == F.col("rows")
    message = F.raise_error(F.lit("rows are not grouped by facility"))
    return found.withColumn("rows", F.when(whole, F.col("rows")).otherwise(message.cast("bigint")))


def _measures(rows: DataFrame) -> DataFrame:
    measure = tx.clean_value(F.col("measure_id"))
    question = F.coalesce(tx.clean_value(F.col("question")), measure)
    return rows.select(
        "document_id", tx.clean_value(F.col("facility_id")).alias("facility_id"), "source_row_number",
        category_of(F.col("measure_id")).alias("category"), measure.alias("measure_id"), question.alias("question"),
        row_result(F.col("star_rating"), F.col("answer_percent"), F.col("linear_mean_value")).alias("r"),
    ).select("*", "r.result_type", "r.result").drop("r")


def _listed(measures: DataFrame, keys: list[str], block_rows: int) -> DataFrame:
    """Lines and lists of every group in row order, joined first per block of rows, then whole.

    A facility that holds most rows is aggregated by many tasks; the last step only
    concatenates one finished text per block.
    """
    cells = tx.markdown_row(*[tx.markdown_cell(F.col(c)) for c in ("measure_id", "question", "result_type", "result")])
    bullet = F.concat(F.lit("- "), F.col("question"), F.lit(": "), F.col("result"))
    item = F.struct(
        F.col("source_row_number").alias("row"), cells.alias("cells"), bullet.alias("bullet"), "measure_id"
    )
    block = F.floor(F.col("source_row_number") / block_rows)
    parts = measures.groupBy(*keys, block.alias("block")).agg(F.sort_array(F.collect_list(item)).alias("i")).select(
        *keys, "block", F.array_join("i.cells", "\n").alias("cells"), F.array_join("i.bullet", "\n").alias("bullets"),
        F.col("i.measure_id").alias("measure_ids"), F.col("i.row").alias("source_row_numbers"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("block", "cells", "bullets", "measure_ids", "source_row_numbers")))
    return parts.groupBy(*keys).agg(ordered.alias("p")).select(
        *keys, F.array_join("p.cells", "\n").alias("cells"), F.array_join("p.bullets", "\n").alias("bullets"),
        F.flatten("p.measure_ids").alias("measure_ids"), F.flatten("p.source_row_numbers").alias("source_row_numbers"),
    )


def _summaries(measures: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the last result of every measure, measures in order of first appearance."""
    last = F.max_by(F.struct("question", "result_type", "result"), "source_row_number").alias("last")
    per_measure = measures.groupBy(*keys, "measure_id").agg(F.min("source_row_number").alias("seen"), last)
    entry = F.sort_array(F.collect_list(F.struct("seen", "measure_id", "last")))
    return per_measure.groupBy(*keys).agg(entry.alias("e")).select(
        *keys, F.expr("map_from_entries(transform(e, x -> struct(x.measure_id, x.last)))").alias("summary"),
        F.size("e").alias("measures"),
    )


def _survey_lines() -> list[Column]:
    return [
        F.concat(F.lit("Survey period: "), _printed(F.col("first.survey_start_date")), F.lit(" to "), _printed(F.col("first.survey_end_date"))),
        F.concat(F.lit("Completed surveys: "), F.coalesce(F.col("first.completed_surveys"), F.lit(MISSING))),
        F.concat(F.lit("Survey response rate: "), F.coalesce(F.col("first.response_rate_percent"), F.lit(MISSING)), F.lit("%")),
        F.lit(""),
    ]


def category_docs(rows: DataFrame, block_rows: int = DEFAULTS.block_rows) -> DataFrame:
    """One document per facility and category."""
    keys = ["document_id", "facility_id", "category"]
    measures = _measures(rows)
    joined = _listed(measures, keys, block_rows).join(_summaries(measures, keys), keys).join(
        _facilities(rows), ["document_id", "facility_id"]
    )
    text = F.array_join(
        F.array(
            F.concat(F.lit("Hospital: "), _printed(F.col("first.facility_name"))),
            F.concat(F.lit("Facility ID: "), "facility_id"),
            F.concat(F.lit("Location: "), F.concat_ws(", ", "first.city", "first.state")),
            F.concat(F.lit("Category: "), category_label(F.col("category"))),
            *_survey_lines(),
            F.col("bullets"),
        ),
        "\n",
    )
    return joined.select(
        uuid5(F.col("document_id"), F.col("facility_id"), F.col("category")).alias("category_doc_id"),
        uuid5(F.col("document_id"), F.col("facility_id"), F.lit("profile")).alias("profile_id"),
        "document_id", "facility_id", "category", text.alias("retrieval_text"),
        F.concat(F.lit(TABLE_HEAD + "\n"), "cells").alias("table_markdown"), "measure_ids", "source_row_numbers", "summary",
        F.struct(
            F.col("first.domain").alias("domain"), F.lit("csv").alias("source_type"), F.col("first.file_name").alias("file_name"),
            F.col("first.facility_name").alias("hospital_name"), F.col("first.state").alias("state"),
            F.col("first.survey_start_date").alias("survey_start_date"), F.col("first.survey_end_date").alias("survey_end_date"),
        ).alias("metadata"),
    )


def facility_profiles(rows: DataFrame, block_rows: int = DEFAULTS.block_rows) -> DataFrame:
    """One profile document per facility, with the summaries of its categories."""
    keys = ["document_id", "facility_id"]
    measures = _measures(rows)
    entry = F.sort_array(F.collect_list(F.struct(category_rank(F.col("category")).alias("at"), "category", "measures")))
    found = _summaries(measures, [*keys, "category"])
    overview = found.groupBy(*keys).agg(
        entry.alias("c"), F.map_from_entries(F.collect_list(F.struct("category", "summary"))).alias("category_summaries")
    )
    numbers = _listed(measures, keys, block_rows).select(*keys, "source_row_numbers")
    joined = _facilities(rows).join(overview, keys).join(numbers, keys)
    line = lambda c: F.concat(F.lit("- "), category_label(c["category"]), F.lit(": "), c["measures"].cast("string"), F.lit(" measures"))
    address = F.concat(
        F.lit("Address: "), _printed(F.col("first.address")), F.lit(", "), _printed(F.col("first.city")), F.lit(", "),
        _printed(F.col("first.state")), F.lit(" "), _printed(F.col("first.zip_code")),
    )
    text = F.array_join(
        F.array(
            F.concat(F.lit("Hospital: "), _printed(F.col("first.facility_name"))),
            F.concat(F.lit("Facility ID: "), "facility_id"),
            address,
            *_survey_lines(),
            F.lit("Available HCAHPS categories:"),
            F.array_join(F.transform("c", line), "\n"),
        ),
        "\n",
    )
    return joined.select(
        uuid5(F.col("document_id"), F.col("facility_id"), F.lit("profile")).alias("profile_id"),
        "document_id", "facility_id", F.col("first.facility_name").alias("hospital_name"),
        *[F.col(f"first.{c}").alias(c) for c in ("address", "city", "state", "zip_code", "county", "telephone")],
        parse_date(F.col("first.survey_start_date")).alias("survey_start_date"),
        parse_date(F.col("first.survey_end_date")).alias("survey_end_date"),
        F.col("first.completed_surveys").alias("completed_surveys"), F.col("first.response_rate_percent").alias("response_rate_percent"),
        "category_summaries", text.alias("retrieval_text"),
        F.struct(
            F.col("first.domain").alias("domain"), F.lit("csv").alias("source_type"), F.col("first.file_name").alias("file_name"),
            "source_row_numbers", F.size("c").alias("category_count"), F.col("rows").alias("measure_count"),
        ).alias("metadata"),
    )


def rollup_counts(rows: DataFrame, profiles: DataFrame, docs: DataFrame) -> DataFrame:
    """Row, profile and category document counts per source document."""
    count = lambda df, name: df.groupBy("document_id").agg(F.count(F.lit(1)).alias(name))
    joined = count(rows, "row_count").join(count(profiles, "hospital_profile_count"), "document_id", "left")
    return joined.join(count(docs, "hospital_category_doc_count"), "document_id", "left").na.fill(0)
