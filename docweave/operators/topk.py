"""Exact top-k scoring of a batch of queries against all retrieval units.

The unit table is read once. Each task scores its Arrow batches against the query
batch with numpy and keeps only the k best units per query, so what is shuffled is
k rows per query and task, never the query-unit pairs.

The query batch is broadcast only after its row count was checked. A larger batch
is cut into blocks, and units are cut into shards; every (shard, block) pair is one
bounded group of a cogrouped job.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.settings import DEFAULTS

# Scores are compared after rounding, so that the order in which a sum was taken
# never decides a rank.
DIGITS = 9
# Query columns scored at a time; bounds the score matrix of one batch.
SLICE = 256
# Units scored at a time, whatever the size of an Arrow batch; bounds the score matrix as well.
UNIT_ROWS = 1024


@dataclass
class DenseQueries:
    """Cosine distance, smaller is better; a zero vector has distance NaN and comes last."""

    ids: np.ndarray
    scopes: list
    matrix: np.ndarray

    columns = ("vector",)

    @classmethod
    def build(cls, frame: pd.DataFrame) -> "DenseQueries":
        matrix = np.array([np.asarray(v, dtype=np.float64) for v in frame["vector"]])
        return cls(frame["query_id"].to_numpy(), list(frame["domains"]), matrix)

    def keys(self, batch: pa.RecordBatch, lo: int, hi: int) -> np.ndarray:
        vectors = batch.column("vector")
        rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
        queries = self.matrix[lo:hi]
        norms = np.linalg.norm(rows, axis=1)[:, None] * np.linalg.norm(queries, axis=1)[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            distance = 1.0 - (rows @ queries.T) / norms
        return np.where(norms > 0, np.round(distance, DIGITS), np.inf)

    @staticmethod
    def score(keys: np.ndarray) -> np.ndarray:
        return np.where(np.isinf(keys), np.nan, keys)


@dataclass
class SparseQueries:
    """Inner product of term weights, larger is better; no shared term scores 0."""

    ids: np.ndarray
    scopes: list
    terms: list
    weights: list

    columns = ("terms", "weights")

    @classmethod
    def build(cls, frame: pd.DataFrame) -> "SparseQueries":
        return cls(frame["query_id"].to_numpy(), list(frame["domains"]), list(frame["terms"]), list(frame["weights"]))

    def keys(self, batch: pa.RecordBatch, lo: int, hi: int) -> np.ndarray:
        vocabulary = sorted({t for terms in self.terms[lo:hi] for t in terms})
        place = {t: i for i, t in enumerate(vocabulary)}
        table = np.zeros((len(vocabulary), hi - lo))
        for q in range(lo, hi):
            table[[place[t] for t in self.terms[q]], q - lo] = self.weights[q]
        units = batch.column("terms")
        found = pc.index_in(units.flatten(), value_set=pa.array(vocabulary, pa.string()))
        term = pc.fill_null(found, -1).to_numpy(zero_copy_only=False)
        weight = batch.column("weights").flatten().to_numpy(zero_copy_only=False)
        lengths = pc.fill_null(pc.list_value_length(units), 0).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(units)), lengths)
        known = term >= 0
        row, term, weight = row[known], term[known], weight[known]
        total = np.zeros((len(units), hi - lo))
        step = max(1_000_000 // (hi - lo), 1)
        for at in range(0, len(row), step):
            part = slice(at, at + step)
            first = np.flatnonzero(np.r_[True, np.diff(row[part]) > 0])
            total[row[part][first]] += np.add.reduceat(weight[part][:, None] * table[term[part]], first, axis=0)
        return -np.round(total, DIGITS)

    @staticmethod
    def score(keys: np.ndarray) -> np.ndarray:
        return -keys + 0.0


KINDS = {"dense": DenseQueries, "sparse": SparseQueries}


def _allowed(scopes: list, domains: list) -> np.ndarray:
    """Which query may see a unit of which domain; a query without scope sees all."""
    codes, names = pd.factorize(np.array(domains, dtype=object), use_na_sentinel=True)
    per_name = np.array(
        [[s is None or len(s) == 0 or name in s for s in scopes] for name in [*names, None]], dtype=bool
    )
    return per_name[codes]


def _candidates(keys: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells that can be among the k best of their column; rows must be in id order."""
    masked = np.where(allowed, keys, np.nan)
    if len(keys) <= k:
        return np.nonzero(allowed)
    edge = np.partition(masked, k - 1, axis=0)[k - 1]
    edge = np.where(np.isnan(edge), np.inf, edge)
    tied = allowed & (masked == edge)
    chosen = (allowed & (masked < edge)) | (tied & (np.cumsum(tied, axis=0) <= k))
    return np.nonzero(chosen)


def _trim(frame: pd.DataFrame, k: int) -> pd.DataFrame:
    frame = frame.sort_values(["q", "key", "unit_id"], kind="stable")
    return frame[frame.groupby("q").cumcount() < k]


def best_of(queries, batches: Iterator[pa.RecordBatch], k: int) -> pd.DataFrame:
    """The k best units of every query over a stream of unit batches."""
    best = None
    for batch in (b.slice(at, UNIT_ROWS) for b in batches for at in range(0, b.num_rows, UNIT_ROWS)):
        if len(queries.ids) == 0:
            continue
        batch = batch.take(pc.sort_indices(batch.column("unit_id")))
        ids = batch.column("unit_id").to_pandas().to_numpy()
        domains = batch.column("domain").to_pylist()
        parts = [] if best is None else [best]
        for lo in range(0, len(queries.ids), SLICE):
            hi = min(lo + SLICE, len(queries.ids))
            keys = queries.keys(batch, lo, hi)
            rows, cols = _candidates(keys, _allowed(queries.scopes[lo:hi], domains), k)
            parts.append(pd.DataFrame({"q": cols + lo, "key": keys[rows, cols], "unit_id": ids[rows]}))
        best = _trim(pd.concat(parts, ignore_index=True), k)
    if best is None:
        best = pd.DataFrame({"q": np.array([], int), "key": np.array([], float), "unit_id": np.array([], object)})
    return pd.DataFrame(
        {
            "query_id": queries.ids[best["q"].to_numpy(dtype=int)],
            "unit_id": best["unit_id"].to_numpy(),
            "score": queries.score(best["key"].to_numpy(dtype=float)),
        }
    )


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than needed to tell."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def pinned(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as a local relation when it is small, so later reads cost nothing."""
    head = df.limit(rows + 1).toArrow()
    if head.num_rows > rows:
        return df
    return df.sparkSession.createDataFrame(head, df.schema)


def _broadcast_scan(units: DataFrame, queries: pd.DataFrame, kind: type, k: int, schema: T.StructType) -> DataFrame:
    batch = units.sparkSession.sparkContext.broadcast(kind.build(queries))
    fields = _arrow_fields(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _to_arrow(best_of(batch.value, batches, k), fields).to_batches()

    return units.mapInArrow(scan, schema)


def _blocked_scan(
    units: DataFrame, queries: DataFrame, kind: type, k: int, schema: T.StructType, shard_rows: int, block_rows: int
) -> DataFrame:
    shards = max(1, -(-units.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_rows))
    left = units.withColumn("_shard", F.pmod(F.xxhash64("unit_id"), F.lit(shards))).withColumn(
        "_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    )
    right = queries.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn(
        "_shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint")))
    )

    fields = _arrow_fields(schema)

    def score(unit_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        found = best_of(kind.build(query_rows.to_pandas()), iter(unit_rows.combine_chunks().to_batches(10_000)), k)
        return _to_arrow(found, fields)

    return left.groupBy("_shard", "_block").cogroup(right.groupBy("_shard", "_block")).applyInArrow(score, schema)


def _arrow_fields(schema: T.StructType) -> list[tuple[str, pa.DataType]]:
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
    return [(f.name, types[f.dataType.simpleString()]) for f in schema]


def _to_arrow(frame: pd.DataFrame, fields: list[tuple[str, pa.DataType]]) -> pa.Table:
    # Column by column, because the pandas conversion would turn NaN into NULL.
    return pa.table({name: pa.array(frame[name].tolist(), kind) for name, kind in fields})


def scan_topk(
    units: DataFrame,
    queries: DataFrame,
    kind: str,
    k: int,
    batch_rows: int = DEFAULTS.query_batch_rows,
    shard_rows: int = DEFAULTS.unit_shard_rows,
) -> DataFrame:
    """``(query_id, unit_id, score, rank)`` of the k best units per query.

    ``units``: ``unit_id, domain`` and ``vector`` (dense) or ``terms, weights`` (sparse).
    ``queries``: ``query_id``, the same payload, and optionally ``domains`` (array; NULL
    or empty searches everything). Units without payload are left out.
    """
    scorer = KINDS[kind]
    if "domains" not in queries.columns:
        queries = queries.withColumn("domains", F.lit(None).cast("array<string>"))
    queries = queries.select("query_id", "domains", *scorer.columns).filter(F.col(scorer.columns[0]).isNotNull())
    units = units.select("unit_id", F.col("domain").cast("string"), *scorer.columns).filter(
        F.col(scorer.columns[0]).isNotNull()
    )
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("unit_id", units.schema["unit_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    head = queries.limit(batch_rows + 1).toArrow()
    if head.num_rows <= batch_rows:
        local = head.to_pandas()
        scopes = [None if s is None or len(s) == 0 else set(s) for s in local["domains"]]
        if scopes and None not in scopes:
            units = units.filter(F.col("domain").isin(sorted(set().union(*scopes))))
        found = _broadcast_scan(units, local, scorer, k, schema)
    else:
        found = _blocked_scan(units, queries, scorer, k, schema, shard_rows, batch_rows)
    return _rank(found, k, ascending=kind == "dense")


def _rank(found: DataFrame, k: int, ascending: bool) -> DataFrame:
    # NaN sorts after every number in ascending order, as a zero vector should.
    best_first = F.col("score").asc() if ascending else F.col("score").desc()
    order = Window.partitionBy("query_id").orderBy(best_first, F.col("unit_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
