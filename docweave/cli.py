"""Command line: ``python -m docweave.cli <command> --store <folder> ...``; run it with spark-submit on a cluster."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.text import token_count
from docweave.operators.embedding import embed_sparse
from docweave.plans import answer as an
from docweave.plans import corpus
from docweave.plans import evaluation as ev
from docweave.plans.catalog import pending_documents, recoverable_documents
from docweave.plans.hybrid import SearchParams, hybrid_search
from docweave.session import build_session
from docweave.settings import DEFAULTS
from docweave.sources.html import crawl_counts
from docweave.sources.store import Store


def hashed_vector(text):
    """Offline dense model: word counts folded into 64 places by hash."""

    @F.pandas_udf("array<float>")
    def run(texts):
        import zlib

        def fold(text):
            vector = [0.0] * 64
            for word in (text or "").lower().split():
                vector[zlib.crc32(word.encode()) % 64] += 1.0
            return vector

        return texts.map(fold)

    return run(text)


def answered(store: Store, asked: DataFrame, params: SearchParams, floor: float) -> DataFrame:
    """Answers to ``query_id, query`` from everything that is indexed."""
    queries = embed_sparse(asked.withColumn("vector", hashed_vector(F.col("query"))), "query")
    hits = hybrid_search(corpus.searchable_units(store), queries, store.read("domain_centroids"), store.read("parent_sections"), params)
    return an.answer_queries(hits, queries, floor)


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="docweave")
    parser.add_argument("--store", required=True)
    commands = parser.add_subparsers(dest="command", required=True)
    found = commands.add_parser("discover")
    found.add_argument("--input", required=True)
    found.add_argument("--root", required=True)
    commands.add_parser("pending").add_argument("--source-type")
    facts = commands.add_parser("parse-facts")
    for name in ("--path", "--document-id", "--domain"):
        facts.add_argument(name, required=True)
    commands.add_parser("parse-pages").add_argument("--pages", required=True)
    commands.add_parser("parse-crawl").add_argument("--parsed", required=True, help="folder with <domain>/html/<name>.raw.json")
    pdf = commands.add_parser("parse-pdf")
    pdf.add_argument("--parsed", required=True, help="folder with <domain>/pdf/<name>.structured.json and .images.json")
    pdf.add_argument("--images", required=True, help="folder with <domain>/<name>/<image files>")
    commands.add_parser("recover").add_argument("--limit", type=int, default=20)
    for name in ("normalize", "chunk", "index", "centroids", "stats"):
        commands.add_parser(name)
    ask = commands.add_parser("query")
    ask.add_argument("--questions", required=True, help="parquet folder with query_id, query")
    ask.add_argument("--top-k", type=int, default=DEFAULTS.rerank_k)
    ask.add_argument("--route-k", type=int, default=DEFAULTS.route_k)
    ask.add_argument("--no-parents", action="store_true")
    ask.add_argument("--context-min-score", type=float, default=DEFAULTS.score_floor)
    run = commands.add_parser("evaluation-run")
    run.add_argument("--questions", required=True, help="parquet folder with item_id, question, ground_truth, domain")
    run.add_argument("--limit", type=int)
    commands.add_parser("evaluate").add_argument("--scores", required=True, help="CSV with domain and metric columns")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = build_session()
    store = Store(spark, args.store)
    if args.command == "discover":
        corpus.discover(store, args.input, args.root).groupBy("domain", "source_type", "status").count().show()
    elif args.command == "pending":
        pending_documents(store.read("documents"), args.source_type).show(truncate=False)
    elif args.command == "parse-facts":
        corpus.parse_facts(store, args.path, args.document_id, args.domain).show()
    elif args.command == "parse-pages":
        crawl_counts(corpus.parse_pages(store, spark.read.parquet(args.pages))[0]).show()
    elif args.command == "parse-crawl":
        print(corpus.parse_crawl(store, args.parsed))
    elif args.command == "parse-pdf":
        print(corpus.parse_pdf(store, args.parsed, args.images))
    elif args.command == "recover":
        recoverable_documents(store.read("documents")).select("document_id", "file_name", "metadata.parse_outputs").show(args.limit, truncate=False)
    elif args.command == "normalize":
        corpus.normalize(store).groupBy("domain", "source_type").count().show()
    elif args.command == "chunk":
        corpus.chunk(store).groupBy("domain").agg(F.count("*").alias("children"), F.avg(token_count(F.col("text_content"))).alias("tokens")).show()
    elif args.command == "index":
        corpus.index(store, hashed_vector).groupBy("domain").count().show()
    elif args.command == "centroids":
        corpus.centroids(store).select("domain", "source_count").show()
    elif args.command == "stats":
        corpus.retrieval_units(store).groupBy("source_table", "domain").count().show()
    elif args.command == "query":
        params = SearchParams(rerank_k=args.top_k, route_k=args.route_k, expand_parents=not args.no_parents)
        told = answered(store, spark.read.parquet(args.questions), params, args.context_min_score)
        store.replace("answers", told).select("query", "answer").show(truncate=False)
    elif args.command == "evaluation-run":
        answer = lambda asked: answered(store, asked, SearchParams(), DEFAULTS.score_floor)
        rows = ev.evaluation_run(store, spark.read.parquet(args.questions), answer, limit=args.limit)
        ev.slice_scores(rows).orderBy("slice").show(truncate=False)
        ev.coverage(rows).show()
    elif args.command == "evaluate":
        scores = spark.read.option("header", True).csv(args.scores)
        metrics = [F.col(m).cast("double").alias(m) for m in ev.METRICS if m in scores.columns]
        typed = scores.select("domain", *metrics)
        ev.slice_scores(typed).orderBy("slice").show(truncate=False)
        ev.coverage(typed).show()


if __name__ == "__main__":
    main()
