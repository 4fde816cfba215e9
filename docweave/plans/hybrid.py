"""Hybrid retrieval of a whole batch of questions as one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators.centroids import route, with_routes
from docweave.operators.fuse import (
    Scorer,
    expand_to_parents,
    reciprocal_rank_fusion,
    rerank,
    term_coverage,
)
from docweave.operators.topk import is_small, pinned, scan_topk
from docweave.session import cut_lineage
from docweave.settings import DEFAULTS


@dataclass(frozen=True)
class SearchParams:
    candidate_limit: int = DEFAULTS.candidate_limit
    rerank_k: int = DEFAULTS.rerank_k
    route_k: int = DEFAULTS.route_k
    expand_parents: bool = True
    query_batch_rows: int = DEFAULTS.query_batch_rows


def routed_queries(queries: DataFrame, centroids: DataFrame, params: SearchParams) -> DataFrame:
    """Queries with their ``domains``; ``route_k <= 0`` or no centroids means no scope."""
    if params.route_k <= 0:
        return queries.withColumn("domains", F.lit(None).cast("array<string>"))
    routed = with_routes(queries, route(queries, centroids, params.route_k))
    return pinned(routed, params.query_batch_rows)


def attach_units(hits: DataFrame, units: DataFrame, columns: list[str], small: bool) -> DataFrame:
    """Hits with columns of their unit; hits are broadcast only when the query batch was small."""
    side = F.broadcast(hits) if small else hits
    return units.select("unit_id", *columns).join(side, "unit_id")


def fused_candidates(units: DataFrame, queries: DataFrame, params: SearchParams) -> DataFrame:
    depth, rows = params.candidate_limit, params.query_batch_rows
    return reciprocal_rank_fusion(
        scan_topk(units, queries, "dense", depth, rows),
        scan_topk(units, queries, "sparse", depth, rows),
    )


def hybrid_search(
    units: DataFrame,
    queries: DataFrame,
    centroids: DataFrame,
    parents: DataFrame,
    params: SearchParams = SearchParams(),
    scorer: Scorer = term_coverage,
) -> DataFrame:
    """Route, search dense and sparse, fuse, expand to parents, rerank.

    ``units``: ``unit_id, document_id, source_table, parent_id, domain, text, file_name,
    vector, terms, weights``; ``queries``: ``query_id, query, vector, terms, weights``.
    """
    scoped = routed_queries(queries, centroids, params)
    small = is_small(scoped, params.query_batch_rows)
    # The hits are read twice below: for the parents they need and for themselves.
    fused = cut_lineage(fused_candidates(units, scoped, params))
    columns = ["document_id", "source_table", "parent_id", "domain", "text", "file_name"]
    hits = attach_units(fused, units, columns, small)
    if params.expand_parents:
        hits = expand_to_parents(hits, parents, small)
    else:
        hits = hits.withColumn("section_title", F.lit(None).cast("string")).withColumn(
            "section_path", F.lit(None).cast("array<string>")
        )
    return rerank(hits, scoped, params.rerank_k, scorer)
