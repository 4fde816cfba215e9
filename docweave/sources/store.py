"""Parquet tables of a corpus, one folder per table and version."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.session import cut_lineage

# Buckets of a new table whose rows are replaced document by document.
BUCKETS = 256


class Store:
    """``root/<table>/v<N>``: a change writes the next version, readers take the newest complete one.

    A version counts once its ``_SUCCESS`` marker exists, so a job that dies leaves the
    previous version in use and can simply run again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self, table: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        found = []
        for status in files.listStatus(path):
            name = status.getPath().getName()
            done = self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if name.startswith("v") and name[1:].isdigit() and files.exists(done):
                found.append(int(name[1:]))
        return sorted(found)

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def _newest(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}/v{self._versions(table)[-1]}")

    def read(self, table: str) -> DataFrame:
        rows = self._newest(table)
        return rows.drop(*(c for c in rows.columns if re.fullmatch(r"_bucket\d+", c)))

    def replace(self, table: str, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        version = ([0] + self._versions(table))[-1] + 1
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.root}/{table}/v{version}")
        return self.read(table)

    def append(self, table: str, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        if not self.exists(table):
            return self.replace(table, rows, partition_by)
        version = self._versions(table)[-1]
        rows.write.mode("append").partitionBy(*partition_by).parquet(f"{self.root}/{table}/v{version}")
        return self.read(table)

    def merge(
        self, table: str, rows: DataFrame, key: str = "document_id", gone: DataFrame | None = None, partition_by: tuple[str, ...] = (), buckets: int = BUCKETS
    ) -> DataFrame:
        """Put ``rows`` in place of all stored rows with their keys, and drop those with the keys in ``gone``.

        The table is partitioned by buckets of the key, and only partitions that hold a changed key are written again;
        all others keep their files. The number of buckets is part of the column's name, so it stays what it was when
        the table was made. Columns that only the table or only ``rows`` has are NULL where they are missing. Repeating
        a call changes nothing.
        """
        rows = cut_lineage(rows)
        keys = rows.select(key) if gone is None else rows.select(key).unionByName(gone.select(key))
        keys = cut_lineage(keys.distinct())
        made = f"_bucket{buckets}"
        if not self.exists(table):
            return self.replace(table, _dealt(rows, key, made), (*partition_by, made))
        old = self._newest(table)
        name = next((c for c in old.columns if re.fullmatch(r"_bucket\d+", c)), None)
        if name is None:
            # Written as a whole before: once more as a whole, into buckets.
            kept = old.join(keys, key, "left_anti").unionByName(rows, allowMissingColumns=True)
            return self.replace(table, _dealt(kept, key, made), (*partition_by, made))
        touched = [r[0] for r in keys.select(_bucket(F.col(key), name)).distinct().collect()]  # at most one per bucket
        if not touched:
            return self.read(table)
        parts = [*partition_by, name]
        old = old.filter(F.col(name).isin(touched))
        before = {tuple(r) for r in old.select(*parts).distinct().collect()}
        kept = old.join(keys, key, "left_anti").unionByName(_dealt(rows, key, name), allowMissingColumns=True)
        kept = cut_lineage(kept)
        after = {tuple(r) for r in kept.select(*parts).distinct().collect()}
        path = f"{self.root}/{table}/v{self._versions(table)[-1]}"
        (
            kept.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*parts).parquet(path)
        )
        if not after and self._newest(table).filter(~F.col(name).isin(touched)).isEmpty():
            # A folder without a file has no schema.
            return self.replace(table, kept.drop(name))
        self._drop(path, parts, before - after)
        return self.read(table)

    def _drop(self, path: str, parts: list[str], values: set[tuple]) -> None:
        """Remove partitions that have lost their last row; an overwrite leaves them as they are."""
        if not values:
            return
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        escape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        empty = "__HIVE_DEFAULT_PARTITION__"
        for row in values:
            folder = "/".join(f"{escape(c)}={empty if v in (None, '') else escape(str(v))}" for c, v in zip(parts, row))
            target = hadoop.Path(f"{path}/{folder}")
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def _bucket(key: Column, name: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(int(re.sub(r"\D", "", name)))).cast("int").alias(name)


def _dealt(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.withColumn(name, _bucket(F.col(key), name))
