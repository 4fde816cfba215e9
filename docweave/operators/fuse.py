"""Rank fusion, parent expansion, reranking and the score floor."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.settings import DEFAULTS


def reciprocal_rank_fusion(dense: DataFrame, sparse: DataFrame, k: int = DEFAULTS.rrf_k) -> DataFrame:
    """Sum of ``1 / (k + rank)`` over both lists; equal sums keep first-seen order.

    Gives ``query_id, unit_id, dense_score, sparse_score, rrf_score, rank``. One grouping,
    over at most two lists of hits per query.
    """
    empty = F.lit(None)
    both = dense.select(
        "query_id", "unit_id", F.col("rank").alias("dense_rank"), F.col("score").alias("dense_score"),
        empty.cast("int").alias("sparse_rank"), empty.cast("double").alias("sparse_score"),
    ).unionByName(
        sparse.select(
            "query_id", "unit_id", empty.cast("int").alias("dense_rank"), empty.cast("double").alias("dense_score"),
            F.col("rank").alias("sparse_rank"), F.col("score").alias("sparse_score"),
        )
    )
    merged = both.groupBy("query_id", "unit_id").agg(
        *[F.max(c).alias(c) for c in ("dense_rank", "dense_score", "sparse_rank", "sparse_score")]
    )
    share = lambda rank: F.coalesce(F.lit(1.0) / (F.lit(k) + F.col(rank)), F.lit(0.0))
    scored = merged.withColumn("rrf_score", share("dense_rank") + share("sparse_rank"))
    # A hit that only the second list found was seen after every hit of the first.
    seen = (F.col("dense_rank").isNull(), F.coalesce("dense_rank", "sparse_rank"))
    order = Window.partitionBy("query_id").orderBy(F.col("rrf_score").desc(), *seen)
    return scored.withColumn("rank", F.row_number().over(order)).drop("dense_rank", "sparse_rank")


def fuse_lists(hits: DataFrame, k: int = DEFAULTS.rrf_k) -> DataFrame:
    """Fusion of any number of ranked lists ``(query_id, list_no, rank, unit_id)``."""
    seen = F.min(F.struct("list_no", "rank")).alias("seen")
    scored = hits.groupBy("query_id", "unit_id").agg(F.sum(F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("rrf_score"), seen)
    order = Window.partitionBy("query_id").orderBy(F.col("rrf_score").desc(), "seen")
    return scored.withColumn("rank", F.row_number().over(order)).drop("seen")


def expand_to_parents(hits: DataFrame, parents: DataFrame, small: bool = False) -> DataFrame:
    """Swap child hits for their parent sections and keep each parent's best hit.

    ``hits``: ``query_id, unit_id, source_table, parent_id, text, rank``. ``parents``:
    ``parent_id, parent_text, section_title, section_path``. Hits that are no child, or
    whose parent is missing, pass through and are deduplicated by (table, id).
    ``small``: the hits are those of a checked query batch; then only parents with a hit leave their scan.
    """
    children = F.when(F.col("source_table") == "child_chunks", F.col("parent_id"))
    found = parents.select(
        F.col("parent_id").alias("_parent"), "parent_text", "section_title", "section_path"
    )
    wanted = hits.select(children.alias("_parent")).filter("_parent IS NOT NULL").distinct()
    found = found.join(F.broadcast(wanted) if small else wanted, "_parent", "left_semi")
    joined = hits.withColumn("_child_of", children).join(found, F.col("_child_of") == F.col("_parent"), "left")
    key = F.when(
        F.col("_parent").isNotNull(), F.struct(F.lit("parent").alias("kind"), F.col("_parent").cast("string").alias("id"))
    ).otherwise(F.struct(F.col("source_table").alias("kind"), F.col("unit_id").cast("string").alias("id")))
    order = Window.partitionBy("query_id", "_key").orderBy("rank")
    kept = (
        joined.withColumn("_key", key)
        .withColumn("_nth", F.row_number().over(order))
        .filter("_nth = 1")
        .withColumn("text", F.when(F.col("_parent").isNotNull(), F.col("parent_text")).otherwise(F.col("text")))
        .withColumn("parent_id", F.col("_parent"))
    )
    return kept.drop("_parent", "_child_of", "_key", "_nth", "parent_text")


Scorer = Callable[[Column, Column], Column]


def term_coverage(query: Column, text: Column) -> Column:
    """Offline reranker: share of the query's distinct words that occur in the text."""
    wanted = F.array_distinct(tx.words(F.lower(query)))
    shared = F.array_intersect(wanted, tx.words(F.lower(text)))
    return F.coalesce(F.try_divide(F.size(shared).cast("double"), F.size(wanted).cast("double")), F.lit(0.0))


def rerank(hits: DataFrame, queries: DataFrame, k: int | None, scorer: Scorer = term_coverage) -> DataFrame:
    """Adds ``rerank_score``, reorders every query's hits by it and keeps the best k.

    ``hits`` hold ``query_id, rank, text``; ``queries`` hold ``query_id, query``.
    Equal scores keep the order the hits came in.
    """
    scored = hits.join(queries.select("query_id", "query"), "query_id").withColumn(
        "rerank_score", scorer(F.col("query"), F.coalesce(F.col("text"), F.lit("")))
    )
    order = Window.partitionBy("query_id").orderBy(F.col("rerank_score").desc(), F.col("rank"))
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def score_floor(hits: DataFrame, floor: float) -> DataFrame:
    """Hits scoring at least ``floor``; when none does, the query's first hit stays."""
    if floor <= 0:
        return hits
    passes = F.coalesce(F.col("rerank_score"), F.lit(1.0)) >= floor
    every = Window.partitionBy("query_id")
    kept = hits.withColumn("_any", F.max(passes).over(every)).withColumn("_first", F.min("rank").over(every))
    return kept.filter(passes | (~F.col("_any") & (F.col("rank") == F.col("_first")))).drop("_any", "_first")
