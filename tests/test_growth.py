"""What large inputs cost: shuffles, links and batches that must not grow faster than the input."""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from docweave.operators import components as cc
from docweave.operators import embedding as em
from docweave.operators import normalize as nm
from docweave.operators import topk as tk
from docweave.sources import html as ht


def exchanges(df):
    """Hash exchanges of the plan before it is run."""
    return len(re.findall(r"Exchange hashpartitioning", df._jdf.queryExecution().executedPlan().toString()))


def test_image_context_shuffles_its_rows_once(spark):
    content = spark.createDataFrame(
        [("d", "x", 0, 1, 0, "heading", "T", 1.0), ("d", "x", 0, 1, 1, "table", "| a |", 5.0), ("d", "x", 0, 1, 2, "text", "after", 9.0)],
        "document_id string, domain string, page int, page_number int, idx int, element_type string, text string, y double",
    )
    images = spark.createDataFrame(
        [("d", 0, 1, "a.png", 5.0), ("d", 0, 2, "b.png", 0.5), ("d", 0, 3, "c.png", None), (None, 0, 4, "d.png", 7.0), ("d", 7, 5, "e.png", 7.0)],
        "document_id string, page int, idx int, filename string, y double",
    )
    found = nm.image_context(content, images)
    assert exchanges(found) == 1
    got = {r.filename: (r.below, r.section_title, r.nearby_text_before, r.nearby_text_after, r.nearby_table_markdown) for r in found.collect()}
    none = (0, "", "", "", None)
    assert got == {"a.png": (1, "T", "", "after", "| a |"), "b.png": (0, "", "", "after", None), "c.png": none, "d.png": none, "e.png": none}


def test_a_sparse_model_gets_few_texts_at_a_time(spark):
    def model(texts, max_terms):
        assert len(texts) <= em.MODEL_ROWS
        return em.log_count_model(texts, max_terms)

    docs = spark.range(0, 3000, 1, 1).select("id", F.when(F.col("id") % 7 != 0, F.concat(F.lit("a b"), "id", F.lit(" a"))).alias("text"))
    got = {r.id: dict(zip(r.terms, r.weights)) for r in em.embed_sparse(docs, model=model).collect()}
    assert got[7] == {} and set(got[2999]) == {"a", "b2999"} and got[2999]["a"] > got[2999]["b2999"] and len(got) == 3000


def test_few_units_are_scored_at_a_time(monkeypatch):
    seen = []
    keys = tk.SparseQueries.keys
    monkeypatch.setattr(tk.SparseQueries, "keys", lambda self, batch, lo, hi: seen.append(len(batch)) or keys(self, batch, lo, hi))
    n = 2 * tk.UNIT_ROWS + 5
    batch = pa.RecordBatch.from_pydict({"unit_id": list(range(n)), "domain": ["d"] * n, "terms": [["a"]] * n, "weights": [[float(i)] for i in range(n)]})
    queries = tk.SparseQueries.build(pd.DataFrame({"query_id": [1], "domains": [None], "terms": [["a"]], "weights": [[1.0]]}))
    found = tk.best_of(queries, iter([batch]), 3)
    assert found["unit_id"].tolist() == [n - 1, n - 2, n - 3] and max(seen) <= tk.UNIT_ROWS


def test_wide_links_are_few_and_connect_the_same(spark):
    rng = np.random.default_rng(3)
    hashes = {s: rng.integers(-(2**63), 2**63 - 1, 300, dtype=np.int64) for s in ("a", "b")}
    hashes["b"][:200] = hashes["b"][0] ^ (np.int64(1) << rng.integers(0, 62, 200))
    rows = [(s, int(h)) for s, v in hashes.items() for h in v] + [("a", None), (None, 5)]
    df = spark.createDataFrame(rows, "scope string, hash bigint")
    links = cc.block_links(df, 20, 50).cache()
    assert links.count() <= 4 * len(rows)
    got = {(r.scope, r.node): r.component for r in cc.connected_components(links).collect()}
    for s, v in hashes.items():
        left = {int(h) for h in v}
        while left:
            group, todo = set(), [left.pop()]
            while todo:
                h = todo.pop()
                group.add(h)
                close = {o for o in left if bin((h ^ o) & (2**64 - 1)).count("1") <= 20}
                left -= close
                todo += close
            assert {got.get((s, h), h) for h in group} == {min(group)}


def test_few_parsed_pages_are_objects_at_a_time(spark, monkeypatch):
    seen = []
    kept = pa.array
    monkeypatch.setattr(pa, "array", lambda values, *more, **named: seen.append(len(values)) or kept(values, *more, **named))
    texts = kept([f"<h1>T {i}</h1><p>x</p>" if i % 3 else None for i in range(3 * ht.PARSE_PAGES + 1)], pa.string())
    found = ht._parse().func(texts, kept([None] * len(texts), pa.string())).to_pylist()
    assert max(seen) <= ht.PARSE_PAGES and [len(r["found"]) for r in found[:4]] == [0, 2, 2, 0] and found[1]["found"][0]["text"] == "T 1"
