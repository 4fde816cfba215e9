"""Discovery of source files and crawl manifests."""

from __future__ import annotations

from importlib.metadata import PackageNotFoundError, version

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.functions.ids import document_id

# Local file types with their parsers; html comes from manifests.
LOCAL_PARSERS = {"pdf": "llamaparse", "csv": "pandas"}
SUPPORTED_SUFFIXES = (".csv", ".html", ".pdf")

def local_files(spark: SparkSession, input_dir: str, root: str) -> DataFrame:
    """Files one level below ``input_dir/<domain>/``; only names and sizes are read."""
    pattern = f"{input_dir}/*/*"
    if not files_match(spark, pattern):
        return describe_files(spark.createDataFrame([], "path string, length long"), root)
    listed = spark.read.format("binaryFile").load(pattern).select("path", "length")
    # The pattern also lists folders; what lies deeper is not part of the corpus.
    listed = listed.filter(F.col("path").rlike(_quoted(input_dir.strip("/")) + "/[^/]+/[^/]+$"))
    return describe_files(listed, root)


def describe_files(listed: DataFrame, root: str) -> DataFrame:
    """``path, length`` of files -> discovered documents of the supported types."""
    relative = F.regexp_replace("path", r"^(?:file:)?/*" + _quoted(root.strip("/")) + "/", "")
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    named = listed.select(
        relative.alias("file_path"), suffix.alias("source_type"), "length",
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("domain"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
    ).filter(F.col("source_type").isin(*LOCAL_PARSERS))
    parser = F.element_at(F.create_map(*[F.lit(v) for kv in LOCAL_PARSERS.items() for v in kv]), F.col("source_type"))
    return named.select(
        document_id(F.col("domain"), F.col("source_type"), F.col("file_path")).alias("document_id"), "domain", "file_name",
        "source_type", "file_path", parser.alias("parser_used"),
        F.to_json(F.struct(F.col("length").alias("file_size_bytes"))).alias("metadata"),
    )


# The package that provides each parser.
PARSER_PACKAGES = {"llamaparse": "llama-cloud", "firecrawl": "firecrawl-py", "pandas": "pandas"}


def with_parser_version(documents: DataFrame) -> DataFrame:
    """Adds ``parser_version``: the installed version of the parser's package, else NULL."""
    found = F.lit(None).cast("string")
    for parser, package in PARSER_PACKAGES.items():
        try:
            found = F.when(F.col("parser_used") == parser, F.lit(version(package))).otherwise(found)
        except PackageNotFoundError:
            continue
    return documents.withColumn("parser_version", found)


def _quoted(text: str) -> str:
    import re

    return re.escape(text)


def files_match(spark: SparkSession, pattern: str) -> bool:
    """Is there a file of this pattern? Reading a pattern without one raises."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def crawl_sources(spark: SparkSession, input_dir: str, root: str) -> DataFrame:
    """Entries of the JSON manifests ``input_dir/<domain>/*.json``; a file holds a list or one object.

    Entries stay JSON texts, so that every setting of a crawl is kept. No manifest: no rows.
    """
    pattern = f"{input_dir}/*/*.json"
    if not files_match(spark, pattern):
        return describe_sources(spark.createDataFrame([], "path string, entry string, position int"), root)
    files = spark.read.option("wholetext", True).text(pattern).select(F.col("_metadata.file_path").alias("path"), "value")
    whole = F.regexp_replace("value", "^\ufeff", "")
    entries = F.when(whole.rlike(r"^\s*\["), F.from_json(whole, "array<string>")).otherwise(F.array(whole))
    return describe_sources(files.select("path", F.posexplode(entries).alias("position", "entry")), root)


def describe_sources(rows: DataFrame, root: str) -> DataFrame:
    """Manifest entries (``path, entry`` as JSON text, ``position``) with a url -> discovered html documents, one per entry, with
    ``listed_in`` and ``position``: of two entries with one url the later one holds."""
    value = lambda name, of="entry": F.get_json_object(of, f"$.{name}")
    stem = F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    relative = F.regexp_replace("path", r"^(?:file:)?/*" + _quoted(root.strip("/")) + "/", "")
    # An entry without a nested configuration is the configuration itself.
    found = rows.withColumn("config", F.coalesce(value("firecrawl_config"), F.col("entry"))).withColumn("at", value("url", "config"))
    found = found.filter("at IS NOT NULL AND at <> ''")
    domain = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    head = F.to_json(F.struct(relative.alias("manifest_path"), F.coalesce(value("firecrawl_mode"), F.lit("crawl")).alias("firecrawl_mode")))
    meta = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"firecrawl_config":'), F.col("config"), F.lit("}"))
    return found.select(
        document_id(domain, F.lit("html"), F.col("at")).alias("document_id"), domain.alias("domain"),
        F.coalesce(F.nullif(value("name"), F.lit("")), stem).alias("file_name"), F.lit("html").alias("source_type"),
        F.col("at").alias("file_path"), F.lit("firecrawl").alias("parser_used"), meta.alias("metadata"), F.col("path").alias("listed_in"), "position",
    )
