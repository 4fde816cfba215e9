"""Context, citations and answers for a batch of questions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.operators.fuse import score_floor
from docweave.settings import DEFAULTS

# The refusal sentence and the wording around context and question.
REFUSAL = "I don't have enough information in the retrieved context to answer that."
PROMPT_HEAD = "Context (numbered sources):\n"
PROMPT_QUESTION = "\n\nQuestion: "
PROMPT_TAIL = (
    "\n\nGive a direct, self-contained answer using only the sources above, "
    "citing markers like [1]. Do not add information the question did not ask for."
)

Generator = Callable[[Column, Column], Column]


def numbered(hits: DataFrame) -> DataFrame:
    """Adds ``number``, the 1-based position of a hit among its query's remaining hits.

    A query holds at most the rerank depth of hits, so its hits fit one array.
    """
    ordered = F.sort_array(F.collect_list(F.struct("rank", *[c for c in hits.columns if c not in ("query_id", "rank")])))
    rows = hits.groupBy("query_id").agg(ordered.alias("_hits")).select("query_id", F.posexplode("_hits").alias("_at", "_hit"))
    return rows.select("query_id", (F.col("_at") + 1).alias("number"), "_hit.*")


def citations(hits: DataFrame) -> DataFrame:
    """One row per hit with its label and ``metadata``: the hit's own, else an empty map."""
    label = F.concat(F.lit("["), F.col("number").cast("string"), F.lit("]"))
    own = F.col("metadata").cast("map<string,string>") if "metadata" in hits.columns else F.lit(None).cast("map<string,string>")
    # Hits are sorted as a list, and maps have no order.
    listed = hits.withColumn("metadata", F.map_entries(F.coalesce(own, F.create_map().cast("map<string,string>"))))
    return numbered(listed).select(
        "query_id", "document_id", F.col("unit_id").alias("chunk_id"), label.alias("label"), "number", F.map_from_entries("metadata").alias("metadata")
    )


def context_blocks(hits: DataFrame) -> DataFrame:
    """One numbered source block per hit, in rank order, joined by blank lines."""
    header = tx.source_label(F.col("section_title"), F.col("file_name"), F.col("domain"))
    block = F.concat(
        F.lit("["), F.col("number").cast("string"), F.lit("]"),
        F.when(header != "", F.concat(F.lit(" "), header)).otherwise(F.lit("")),
        F.lit("\n"), F.coalesce(F.col("text"), F.lit("")),
    )
    rows = numbered(hits).select("query_id", "number", block.alias("block"), F.coalesce("text", F.lit("")).alias("text"))
    listed = F.sort_array(F.collect_list(F.struct("number", "block", "text")))
    return rows.groupBy("query_id").agg(listed.alias("_b")).select(
        "query_id",
        F.array_join("_b.block", "\n\n").alias("context"),
        F.col("_b.text").alias("contexts"),
    )


def prompt(question: Column, context: Column) -> Column:
    return F.concat(F.lit(PROMPT_HEAD), context, F.lit(PROMPT_QUESTION), question, F.lit(PROMPT_TAIL))


def extractive_generator(question: Column, context: Column) -> Column:
    """Offline generator: the first sentence of source 1 with its marker."""
    body = F.regexp_extract(context, r"^\[1\][^\n]*\n([\s\S]*?)(?:\n\n\[2\]|$)", 1)
    sentence = tx.strip(F.regexp_extract(body, r"^([\s\S]*?[.!?])(?:\s|$)", 1))
    return F.concat(F.coalesce(F.nullif(sentence, F.lit("")), tx.strip(body)), F.lit(" [1]"))


def answer_queries(
    hits: DataFrame,
    queries: DataFrame,
    floor: float = DEFAULTS.score_floor,
    generator: Generator = extractive_generator,
) -> DataFrame:
    """``query_id, query, context, contexts, answer`` for every query, also those without hits."""
    blocks = context_blocks(score_floor(hits, floor))
    joined = queries.select("query_id", "query").join(blocks, "query_id", "left")
    context = F.coalesce("context", F.lit(""))
    answer = F.when(tx.strip(context) == "", F.lit(REFUSAL)).otherwise(generator(F.col("query"), context))
    return joined.select("query_id", "query", context.alias("context"), "contexts", answer.alias("answer"))
