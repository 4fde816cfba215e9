"""Incremental indexing: new parsed elements are picked up where the last run stopped.

The batch jobs resume by anti-joins on finished ids. Here a file stream with
``availableNow`` keeps that position in its checkpoint and feeds the same batch functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from docweave.operators import chunking as ch
from docweave.sources.store import Store


def index_arrivals(
    store: Store,
    folder: str,
    schema: str,
    checkpoint: str,
    embed: Callable[[DataFrame], DataFrame],
    params: ch.ChunkParams = ch.ChunkParams(),
) -> StreamingQuery:
    """Chunks and embeds whole documents that arrived in ``folder`` since the last call.

    A document's elements arrive in one file. A repeated batch replaces nothing and adds
    nothing: children already stored are left out by id.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        made = ch.child_chunks(ch.assign_parents(batch, params), ch.headings(batch, params), params)
        if store.exists("arrived_chunks"):
            made = made.join(store.read("arrived_chunks").select("chunk_id"), "chunk_id", "left_anti")
        store.append("arrived_chunks", embed(made))

    arrivals = store.spark.readStream.schema(schema).parquet(folder)
    return (
        arrivals.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
