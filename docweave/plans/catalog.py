"""The document table: upserts, status changes and work lists.

Tables are Parquet folders; a change is a new DataFrame to be written in place of the old one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States from which a document is (re)parsed.
PENDING = ("discovered", "parsing", "failed")
# Fixed value: length to which an error text is cut.
ERROR_CHARS = 2000


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of both sides by key; a row of ``incoming`` replaces all columns but ``keep``.

    Both sides hold a key once (see :func:`latest`), so the full join neither multiplies
    rows nor meets a hot key.
    """
    others = [c for c in existing.columns if c not in keys]
    new = incoming.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in others], F.lit(True).alias("_new"))
    old = existing.withColumn("_old", F.lit(True))
    is_new, is_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    pick = lambda c: F.when(is_new & ~(is_old & F.lit(c in keep)), F.col(f"_n_{c}")).otherwise(F.col(c))
    return old.join(new, keys, "full").select(*keys, *[pick(c).alias(c) for c in others]).select(*existing.columns)


def latest(rows: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """The last row of every key, as if rows had been upserted one by one."""
    others = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), order).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def upsert_documents(existing: DataFrame, discovered: DataFrame) -> DataFrame:
    """New documents start as discovered; known ones take every new value but keep their status."""
    return upsert(existing, discovered.withColumn("status", F.lit("discovered")), ["document_id"], keep=("status",))


def replace_documents(existing: DataFrame, rows: DataFrame, key: str = "document_id") -> DataFrame:
    """Drop all rows of the documents in ``rows`` and add ``rows``: delete and insert in one step."""
    return existing.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows)


def set_status(documents: DataFrame, changes: DataFrame) -> DataFrame:
    """``changes``: ``document_id, status``."""
    new = changes.select("document_id", F.col("status").alias("_status"))
    return documents.join(new, "document_id", "left").withColumn("status", F.coalesce("_status", "status")).drop("_status")


def _with_metadata(documents: DataFrame, changes: DataFrame, field: str, value: Column, status: str | None) -> DataFrame:
    new = changes.select("document_id", value.alias("_value"), F.lit(True).alias("_hit"))
    joined = documents.join(new, "document_id", "left")
    hit = F.col("_hit").isNotNull()
    joined = joined.withColumn("metadata", F.when(hit, F.col("metadata").withField(field, F.col("_value"))).otherwise(F.col("metadata")))
    if status:
        joined = joined.withColumn("status", F.when(hit, F.lit(status)).otherwise(F.col("status")))
    return joined.select(*documents.columns)


def save_jobs(documents: DataFrame, jobs: DataFrame) -> DataFrame:
    """``jobs``: ``document_id, job_id, api_key_alias``. The job settings are fixed values."""
    job = F.struct("job_id", "api_key_alias", F.lit("agentic").alias("tier"), F.lit("latest").alias("version"))
    return _with_metadata(documents, jobs, "job", job, None)


def mark_parsed(documents: DataFrame, outputs: DataFrame) -> DataFrame:
    """``outputs``: ``document_id, outputs`` (map of output names to paths)."""
    return _with_metadata(documents, outputs, "parse_outputs", F.col("outputs"), "parsed")


def mark_failed(documents: DataFrame, errors: DataFrame) -> DataFrame:
    """``errors``: ``document_id, error``."""
    return _with_metadata(documents, errors, "parse_error", F.substring("error", 1, ERROR_CHARS), "failed")


def pending_documents(documents: DataFrame, source_type: str | None = None) -> DataFrame:
    found = documents.filter(F.col("status").isin(*PENDING))
    if source_type:
        found = found.filter(F.col("source_type") == source_type)
    return found.orderBy("domain", "file_name", "document_id")


def chunkable_documents(documents: DataFrame) -> DataFrame:
    return documents.filter(F.col("source_type").isin("pdf", "html")).orderBy("domain", "file_name", "document_id")


def recoverable_documents(documents: DataFrame) -> DataFrame:
    return documents.filter((F.col("status") == "parsed") & F.col("metadata.parse_outputs").isNotNull()).orderBy(
        F.col("updated_at").desc_nulls_last(), "document_id"
    )


def without_outputs(documents: DataFrame, files: DataFrame, required: list[str]) -> DataFrame:
    """Documents for which not every required output exists and is non-empty.

    ``files``: ``document_id, output, size``.
    """
    present = files.filter((F.col("size") > 0) & F.col("output").isin(*required)).groupBy("document_id").agg(
        F.count_distinct("output").alias("n")
    )
    return documents.join(present.filter(F.col("n") == len(required)).select("document_id"), "document_id", "left_anti")


def assign_workers(documents: DataFrame, workers: list[str]) -> DataFrame:
    """Adds ``worker``: the one stored with the document's job, else one by the document's id.

    The hash of the id spreads documents evenly without numbering them all in one task, and
    a document gets the same worker again after others were added. An unknown stored worker raises.
    """
    names = F.lit(workers)
    stored = F.col("metadata.job.api_key_alias")
    unknown = F.raise_error(F.concat(F.lit("unknown worker: "), stored)).cast("string")
    by_id = F.get(names, F.pmod(F.xxhash64("document_id"), F.lit(len(workers))).cast("int"))
    return documents.withColumn(
        "worker", F.when(stored.isNull(), by_id).when(F.array_contains(names, stored), stored).otherwise(unknown)
    )
