"""Tables and SQL fragments the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# SQL list of the whitespace-separated lower-case words of a text.
def sql_words(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '\\s+'), lambda w: w <> '')"


def sql_uuid5(key: str) -> str:
    """UUIDv5 in the URL namespace of an SQL string expression."""
    x = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({key}))"
    variant = f"substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr({x}, 17, 1))::INT, 1)"
    return (
        f"(substr({x}, 1, 8) || '-' || substr({x}, 9, 4) || '-5' || substr({x}, 14, 3) || '-' || "
        f"{variant} || substr({x}, 18, 3) || '-' || substr({x}, 21, 12))"
    )
