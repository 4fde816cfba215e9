"""Default parameters of the corpus and question-answering jobs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # Vector shapes.
    dense_dim: int = 1024
    sparse_max_terms: int = 512
    # Chunk sizes in tokens.
    chunk_target: int = 512
    chunk_overlap: int = 64
    chunk_max: int = 800
    parent_max: int = 2000
    # Retrieval depths, fusion constant and score floor.
    candidate_limit: int = 20
    rerank_k: int = 8
    route_k: int = 2
    rrf_k: int = 60
    score_floor: float = 0.1
    # Image triage thresholds.
    boilerplate_pages: int = 5
    min_dimension: float = 28.0
    max_aspect: float = 7.0
    phash_bits: int = 6
    overlap_iou: float = 0.6
    # Physical sizing, not semantics: results do not depend on these.
    block_rows: int = 8192
    query_batch_rows: int = 4096
    unit_shard_rows: int = 50_000
    bucket_rows: int = 256


DEFAULTS = Settings()
