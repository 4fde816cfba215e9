"""Cleaning pipeline of a training corpus: five stages, each on all that the one before kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import chunk_bpe, language, line_dedup, queries, simhash, template_leaks
from docweave.session import cut_lineage, ship_package

# Posterior probability of the predicted language below which a document is rejected.
LEAST_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language: not ``und``, and predicted with ``LEAST_SCORE`` or more. Without any label to
    learn from, documents with a letter stay."""
    ship_package(spark)
    model = language.learn(docs.filter(~language.held_out("doc_id") & F.col("doc_id").isNotNull()))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    told = language.identify(docs, model)
    return told.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; ``n_chars`` follows the text."""
    ship_package(spark)
    left = line_dedup.drop_repeated_lines(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each SimHash group; a null id stays only where its group has no other."""
    ship_package(spark)
    grouped = simhash.near_duplicates(docs)
    gone = grouped.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_gone"))
    return template_leaks.without_ids(docs, gone)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    return template_leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them: ``(doc_id, lang, source, n_tokens, ids, round_trip)``."""
    ship_package(spark)
    rows = docs.select("doc_id", "lang", "source", "text")
    decoded = chunk_bpe.encode_texts(rows, queries.vocabulary("byte_bpe_50k.json"), decode=True)
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return decoded.select("doc_id", "lang", "source", "n_tokens", "ids", same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", leak_stage),
    ("bpe_codec", encode_stage),
]

# Models and encodings have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    if spark.sparkContext.getCheckpointDir() is None:
        cut_lineage(spark.range(0))  # names the folder
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
