"""Domain centroids and centroid routing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators.topk import scan_topk


def domain_centroids(units: DataFrame) -> DataFrame:
    """``(domain, vector, source_count)``: mean vector of every domain's embedded units.

    A task adds up whole vectors and hands over one row per domain, so what is shuffled depends on tasks and domains,
    not on units or places. The sums of a domain are added in a fixed order of tasks.
    """
    embedded = units.filter(F.col("vector").isNotNull()).select("domain", F.col("vector").cast("array<double>").alias("vector"))
    partial = embedded.mapInArrow(_partial_sums, SUMS)
    return partial.groupBy("domain").applyInArrow(_mean, "domain string, vector array<double>, source_count bigint")


SUMS = "domain string, part int, total array<double>, n bigint"


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str | None, np.ndarray] = {}
    counts: dict[str | None, int] = {}
    for batch in batches:
        names, vectors = batch.column(0).dictionary_encode(), batch.column(1)
        if not batch.num_rows:
            continue
        width = len(vectors[0])
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        if len(flat) != width * batch.num_rows:
            raise ValueError("vectors of different lengths")
        codes = pc.fill_null(names.indices, len(names.dictionary)).to_numpy(zero_copy_only=False)
        for code in np.unique(codes).tolist():
            name = names.dictionary[code].as_py() if code < len(names.dictionary) else None
            rows = flat.reshape(-1, width)[codes == code]
            sums[name] = sums.get(name, 0.0) + rows.sum(axis=0)
            counts[name] = counts.get(name, 0) + len(rows)
    part = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.string()), pa.array([part] * len(sums), pa.int32()), pa.array(list(sums.values()), pa.list_(pa.float64())), pa.array(list(counts.values()), pa.int64())],
        names=["domain", "part", "total", "n"],
    )


def _mean(table: pa.Table) -> pa.Table:
    table = table.sort_by("part")
    rows = [np.array(x) for x in table["total"].to_pylist()]
    if len({len(x) for x in rows}) > 1:
        raise ValueError("vectors of different lengths")
    n = pc.sum(table["n"]).as_py()
    return pa.table({"domain": table["domain"][:1], "vector": pa.array([np.sum(rows, axis=0) / n], pa.list_(pa.float64())), "source_count": pa.array([n], pa.int64())})


def route(queries: DataFrame, centroids: DataFrame, k: int) -> DataFrame:
    """``(query_id, domain, distance, rank)``: the k nearest domains of every query."""
    points = centroids.select(F.col("domain").cast("string").alias("unit_id"), "domain", "vector")
    found = scan_topk(points, queries.drop("domains"), "dense", k)
    return found.select("query_id", F.col("unit_id").alias("domain"), F.col("score").alias("distance"), "rank")


def with_routes(queries: DataFrame, routes: DataFrame) -> DataFrame:
    """Adds ``domains``; a query without a route keeps NULL and searches everything."""
    scoped = routes.groupBy("query_id").agg(F.collect_set("domain").alias("domains"))
    return queries.join(scoped, "query_id", "left")
