import random

import numpy as np
from pyspark.sql import functions as F

from docweave.operators import triage as tr

BOX = "document_id string, page int, idx bigint, x double, y double, w double, h double, category string"


def boxes(rng, documents=6, pages=5, most=12):
    rows = []
    for d in range(documents):
        for page in range(pages):
            for i in range(rng.randrange(most)):
                size = rng.choice([10.0, 12.0, 30.0])
                rows.append((f"d{d}", page, page * 1000 + i, rng.choice([0.0, 2.0, 3.5, 50.0]), rng.choice([0.0, 1.0, -0.0]), size * rng.choice([1, 1.1, 1.3]), size, rng.choice(["embedded", "layout", None])))
    return rows


def drops(df, bucket_rows, **params):
    return sorted(map(tuple, tr.overlap_drops(df, tr.TriageParams(bucket_rows=bucket_rows, **params)).collect()))


def test_small_documents_take_one_shuffle_and_no_joins(spark):
    df = spark.createDataFrame(boxes(random.Random(1)), BOX)
    plan = tr.overlap_drops(df, tr.TriageParams())._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") + plan.count("Repartition") == 1 and "Join" not in plan and "Aggregate" not in plan


def test_whole_documents_equal_joins(spark):
    rng = random.Random(2)
    rows = boxes(rng) + boxes(rng, 1, 1, 400)
    # Copies, an idx on two pages, rows that no page has, and boxes without an extent or with an odd one.
    rows += rng.choices(rows, k=60)
    rows += [(r[0], r[1] + 1, *r[2:]) for r in rng.choices(rows, k=20)]
    for i in range(8):
        rows += [tuple(None if i == at else v for at, v in enumerate(r)) for r in rng.choices(rows, k=5) if None not in r]
    odd = [float("nan"), float("inf"), 0.0, -1.0]
    rows += [("odd", 1, i, *rng.choices([1.0, 2.0, 30.0, *odd], k=2), *rng.choices([20.0, 21.0, *odd], k=2), "layout") for i in range(30)]
    df = spark.createDataFrame(rows, BOX)
    named = df.withColumn("category", F.coalesce("category", F.lit("embedded")))
    want = sorted(map(tuple, tr._spread_drops(named, tr.TriageParams(bucket_rows=1000)).collect()))
    assert len(want) > 100 and drops(df, 1000) == want


def test_some_documents_are_large(spark):
    rows = boxes(random.Random(3)) + [("long", 1, i, 30.0 * i, 0.0, 100.0, 100.0, "embedded") for i in range(200)]
    df = spark.createDataFrame(rows, BOX)
    assert drops(df, 8, overlap_iou=0.5) == drops(df, 10_000, overlap_iou=0.5) != []


def test_documents_cross_batches(spark):
    df = spark.createDataFrame(boxes(random.Random(4), 30), BOX)
    want = drops(df, 256)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert drops(df, 256) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)


def test_page_pairs_are_cut_but_whole():
    rng = np.random.default_rng(5)
    page = np.repeat([0, 1, 2], [300, 3, 100])
    x, w = rng.uniform(0, 1000, 403), rng.uniform(5, 20, 403)
    order = np.lexsort((x, page))
    page, x, w = page[order], x[order], w[order]
    found = [np.stack(pairs) for pairs in tr._page_pairs(page, x, w, 0.6)]
    got = set(zip(*np.concatenate(found, axis=1).tolist()))
    for p in range(403):
        for q in range(p + 1, 403):
            wide = min(x[p] + w[p], x[q] + w[q]) - max(x[p], x[q])
            if page[p] == page[q] and wide >= 0.6 * max(w[p], w[q]):
                assert (p, q) in got
    assert len(got) < 3000
