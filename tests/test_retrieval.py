import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.operators import fuse
from docweave.operators.centroids import domain_centroids, route
from docweave.operators.embedding import embed_dense, embed_sparse, unembedded
from docweave.operators.topk import scan_topk
from docweave.plans.answer import REFUSAL, answer_queries, citations, context_blocks
from docweave.plans.hybrid import SearchParams, hybrid_search


@pytest.fixture(scope="module")
def units(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "abc"[i % 3], rng.normal(size=4).round(1).tolist(), f"word{i % 7} word{i % 5} common") for i in range(60)]
    rows[5] = (5, "a", [0.0] * 4, "word1")
    rows[6] = (6, "b", None, "word2 word2")
    return embed_sparse(spark.createDataFrame(rows, "unit_id bigint, domain string, vector array<float>, text string"))


@pytest.fixture(scope="module")
def queries(spark):
    rows = [
        (1, [1.0, 0.0, 0.0, 0.0], "word1 common", None), (2, [0.0, 1.0, 0.5, 0.0], "word4 word4", ["a"]),
        (3, [0.3, 0.3, -1.0, 0.2], "unknown", ["b", "c"]), (4, [1.0, 1.0, 1.0, 1.0], "word2", []),
    ]
    return embed_sparse(spark.createDataFrame(rows, "query_id bigint, vector array<float>, query string, domains array<string>"), "query")


def brute(units, queries, kind, k):
    out = set()
    us, qs = units.collect(), queries.collect()
    for q in qs:
        scored = []
        for u in us:
            if q.domains and u.domain not in q.domains:
                continue
            if kind == "dense":
                if u.vector is None:
                    continue
                a, b = np.array(q.vector, dtype=float), np.array(u.vector, dtype=float)
                n = np.linalg.norm(a) * np.linalg.norm(b)
                scored.append((round(1 - a @ b / n, 9) if n else math.inf, u.unit_id))
            else:
                w = dict(zip(u.terms, u.weights))
                scored.append((-round(sum(x * w.get(t, 0) for t, x in zip(q.terms, q.weights)), 9), u.unit_id))
        out |= {(q.query_id, u, r) for r, (_, u) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("kind", ["dense", "sparse"])
@pytest.mark.parametrize("k", [1, 7, 100])
def test_topk_is_exact_on_both_paths(units, queries, kind, k):
    want = brute(units, queries, kind, k)
    for sizes in ({}, {"batch_rows": 1, "shard_rows": 13}):
        got = scan_topk(units, queries, kind, k, **sizes)
        assert {(r.query_id, r.unit_id, r["rank"]) for r in got.collect()} == want


def test_topk_prefix_and_partitioning(units, queries):
    rows = lambda df: {tuple(r) for r in df.filter("rank <= 3").collect()}
    assert rows(scan_topk(units, queries, "sparse", 3)) == rows(scan_topk(units.repartition(9), queries, "sparse", 10))


def test_centroids_and_routes(spark, units, queries):
    cents = domain_centroids(units)
    found = {r.domain: r for r in cents.collect()}
    vectors = [u.vector for u in units.collect() if u.domain == "a" and u.vector]
    assert found["a"].source_count == len(vectors)
    assert np.allclose(found["a"].vector, np.mean(np.array(vectors, dtype=np.float32).astype(float), axis=0))
    assert route(queries, cents, 2).count() == 8
    assert route(queries, cents.limit(0), 2).count() == 0


def test_rrf_scores_and_stable_order(spark):
    lists = [(1, 1, 1, "a"), (1, 1, 2, "b"), (1, 2, 1, "b"), (1, 2, 2, "a"), (1, 2, 3, "c")]
    got = fuse.fuse_lists(spark.createDataFrame(lists, "query_id int, list_no int, rank int, unit_id string")).orderBy("rank").collect()
    assert [r.unit_id for r in got] == ["a", "b", "c"]
    assert got[0].rrf_score == pytest.approx(1 / 61 + 1 / 62)
    side = lambda n: spark.createDataFrame([(q, u, 0.5, r) for q, l, r, u in lists if l == n], "query_id int, unit_id string, score double, rank int")
    both = fuse.reciprocal_rank_fusion(side(1), side(2)).orderBy("rank").collect()
    assert [(r.unit_id, r.rrf_score) for r in both] == [(r.unit_id, r.rrf_score) for r in got]
    assert both[2].dense_score is None and both[2].sparse_score == 0.5


def test_expansion_keeps_best_hit_per_parent(spark):
    hits = spark.createDataFrame(
        [(1, "x", "child_chunks", "p", "t1", 2), (1, "y", "child_chunks", "p", "t2", 1), (1, "z", "child_chunks", "gone", "t3", 3), (1, "p", "other", None, "t4", 4)],
        "query_id int, unit_id string, source_table string, parent_id string, text string, rank int",
    )
    parents = spark.createDataFrame([("p", "whole", "T", ["A", "T"])], "parent_id string, parent_text string, section_title string, section_path array<string>")
    got = fuse.expand_to_parents(hits, parents).orderBy("rank").collect()
    assert [(r.unit_id, r.text, r.parent_id) for r in got] == [("y", "whole", "p"), ("z", "t3", None), ("p", "t4", None)]


def test_score_floor(spark):
    hits = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.05), (2, 1, 0.01), (2, 2, 0.0), (3, 1, None)], "query_id int, rank int, rerank_score double")
    rows = lambda f: {(r.query_id, r["rank"]) for r in fuse.score_floor(hits, f).collect()}
    assert rows(0.1) == {(1, 1), (2, 1), (3, 1)}
    assert len(rows(0)) == 5


def test_hybrid_and_answers(spark, units, queries):
    docs = units.select(
        "*", F.col("unit_id").alias("document_id"), F.lit("child_chunks").alias("source_table"), (F.col("unit_id") % 9).alias("parent_id"), F.lit("f").alias("file_name")
    )
    parents = spark.createDataFrame([(i, f"parent {i} common.", None, ["A"]) for i in range(9)], "parent_id bigint, parent_text string, section_title string, section_path array<string>")
    plain = queries.drop("domains")
    hits = hybrid_search(docs, plain, domain_centroids(units), parents, SearchParams(rerank_k=3))
    counts = {r.query_id: r["count"] for r in hits.groupBy("query_id").count().collect()}
    assert counts == {1: 3, 2: 3, 3: 3, 4: 3}
    # A batch above the broadcast bound takes the distributed path and agrees.
    blocked = hybrid_search(docs, plain, domain_centroids(units), parents, SearchParams(rerank_k=3, query_batch_rows=2))
    key = lambda df: {(r.query_id, r["rank"], r.unit_id, r.rrf_score) for r in df.collect()}
    assert key(hits) == key(blocked)
    labels = {(r.query_id, r.label) for r in citations(hits).collect()}
    assert (1, "[1]") in labels and (1, "[3]") in labels and len(labels) == 12
    block = context_blocks(hits).filter("query_id = 1").first()
    assert block.context.startswith("[1] f | domain=") and "\n\n[2] " in block.context and len(block.contexts) == 3
    asked = plain.select("query_id", "query").unionByName(spark.createDataFrame([(9, "nothing")], "query_id bigint, query string"))
    answers = {r.query_id: r.answer for r in answer_queries(hits, asked).collect()}
    assert answers[9] == REFUSAL and answers[1].endswith(". [1]")


def test_models_are_pluggable(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, " ")], "unit_id int, text string")
    model = embed_dense(lambda texts: [[float(len(t)), 1.0] for t in texts], batch=2)
    assert [r.v for r in df.select(model("text").alias("v")).collect()] == [[2.0, 1.0], [0.0, 1.0], [1.0, 1.0]]
    assert unembedded(df, df.filter("unit_id = 9")).count() == 1
    sparse = embed_sparse(df.selectExpr("'b a b' AS text")).first()
    assert sparse.terms == ["b", "a"] and sparse.weights[0] == pytest.approx(math.log(3))
    assert embed_sparse(df.selectExpr("'b a b' AS text"), max_terms=1).first().terms == ["b"]


def test_fusion_order_holds_for_deep_lists(spark):
    dense = spark.createDataFrame([(1, "d", 2_000_000, 0.5)], "query_id int, unit_id string, rank int, score double")
    sparse = spark.createDataFrame([(1, "s", 2_000_000, 0.5)], "query_id int, unit_id string, rank int, score double")
    got = fuse.reciprocal_rank_fusion(dense, sparse).orderBy("rank").collect()
    assert [r.unit_id for r in got] == ["d", "s"]
