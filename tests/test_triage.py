import random

import pytest
from pyspark.sql import functions as F

from docweave.operators import components as cc
from docweave.operators import triage as tr
from docweave.operators.ordered import running

BOX = "document_id string, page int, idx bigint, x double, y double, w double, h double, category string"


def overlap(a, b):
    w = max(0.0, min(a[3] + a[5], b[3] + b[5]) - max(a[3], b[3]))
    h = max(0.0, min(a[4] + a[6], b[4] + b[6]) - max(a[4], b[4]))
    union = a[5] * a[6] + b[5] * b[6] - w * h
    return w * h / union if union > 0 else 0.0


def greedy(rows, threshold):
    """Which box of a page falls to which, visiting boxes in order."""
    lost = {}
    for i, a in enumerate(rows):
        if a[2] in lost:
            continue
        for b in rows[i + 1 :]:
            if b[2] in lost or overlap(a, b) < threshold:
                continue
            better = (a[7] == "embedded") - (b[7] == "embedded") or (1 if a[5] * a[6] >= b[5] * b[6] else -1)
            loser, keeper = (b, a) if better > 0 else (a, b)
            lost.setdefault(loser[2], keeper[2])
    return lost


@pytest.mark.parametrize("bucket_rows", [1, 1000])
def test_overlap_equals_greedy(spark, bucket_rows):
    rng = random.Random(5)
    rows = []
    for page in range(4):
        for i in range(40):
            size = rng.choice([10.0, 12.0, 30.0, 100.0])
            rows.append(("d", page, page * 100 + i, rng.choice([0.0, 2.0, 3.5, 50.0, -4.0]), rng.choice([0.0, 1.0, 60.0]), size * rng.choice([1, 1.1, 1.3]), size, rng.choice(["embedded", "layout"])))
    rows.append(("d", 0, 99, 0.0, 0.0, 0.0, 5.0, "embedded"))
    want = {}
    for page in range(4):
        want |= greedy(sorted(r for r in rows if r[1] == page), 0.6)
    params = tr.TriageParams(bucket_rows=bucket_rows)
    got = {r.idx: r.keeper for r in tr.overlap_drops(spark.createDataFrame(rows, BOX), params).collect()}
    assert got == want


@pytest.mark.parametrize("bucket_rows", [24, 10_000])
def test_near_groups_equal_union_find(spark, bucket_rows):
    rng = random.Random(2)
    signed = lambda v: v - (1 << 64) if v >= 1 << 63 else v
    rows = []
    for scope in ("a", "b"):
        seeds = [rng.getrandbits(64) for _ in range(12)]
        for s in seeds:
            h = s
            for _ in range(6):
                rows.append((scope, signed(h)))
                for _ in range(rng.choice([1, 3, 6, 7])):
                    h ^= 1 << rng.randrange(64)
        # Hashes that share most bits, so that one band never separates them.
        rows += [(scope, signed(rng.getrandbits(14))) for _ in range(60)]
    rows += [("a", None), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "scope string, hash bigint")
    got = {}
    for r in cc.near_groups(df, 6, bucket_rows).collect():
        got.setdefault((r.scope, r.component), set()).add(r.hash)
    want = []
    for scope in ("a", "b"):
        left = {h for s, h in rows if s == scope and h is not None}
        while left:
            group, todo = set(), [left.pop()]
            while todo:
                h = todo.pop()
                group.add(h)
                close = {o for o in left if bin((h ^ o) & (2**64 - 1)).count("1") <= 6}
                left -= close
                todo += close
            want.append((scope, frozenset(group)))
    assert {(k[0], frozenset(v)) for k, v in got.items()} == set(want)


def test_components_of_a_long_chain(spark):
    edges = spark.range(60).selectExpr("'s' AS scope", "id AS a", "id + 1 AS b").union(spark.createDataFrame([("s", 500, 501), ("t", 1, 2)], "scope string, a bigint, b bigint"))
    got = {(r.scope, r.node): r.component for r in cc.connected_components(edges).collect()}
    assert all(got["s", n] == 0 for n in range(61)) and got["s", 501] == 500 and got["t", 2] == 1


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_equals_cumulation(spark, inclusive):
    rng = random.Random(4)
    rows = [(k, i, rng.randrange(9)) for k in ("a", None) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    got = running(df, ["k"], F.floor(F.col("i") / 7), ["i"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, inclusive=inclusive)
    for r in got.collect():
        upto = [v for k, i, v in rows if k == r.k and (i < r.i or (inclusive and i == r.i))]
        assert r.s == sum(upto) and r.m == (max(upto) if upto else None)
    down = running(df, ["k"], F.floor(F.col("i") / 7), [F.col("i").desc()], {"s": ("sum", F.col("v"))}, descending_blocks=True)
    assert all(r.s == sum(v for k, i, v in rows if k == r.k and i >= r.i) for r in down.collect())


IMAGE = BOX.replace("idx", "idx") + ", filename string, sha string, phash bigint, found boolean, photographic boolean"


def image(idx, page=1, x=0.0, y=0.0, w=100.0, h=100.0, category="embedded", sha=None, phash=None, found=True, photo=False):
    return ("d", page, idx, x, y, w, h, category, f"f{idx}", sha or f"s{idx}", phash, found, photo)


def test_every_reason(spark):
    rows = [
        image(0, found=False), *[image(i, page=i, sha="logo") for i in range(1, 6)], image(6, w=20.0), image(7, w=900.0), image(8, w=0.0, x=999.0),
        image(9, photo=True), image(10, page=20), image(11, page=21, sha="s10"), image(12, page=20, x=5.0, category="layout"),
        image(13, page=22, phash=0), image(14, page=23, phash=0b111111), image(15, page=24, phash=0b111111111111), image(16, page=25, phash=-1),
    ]
    got = {r.idx: (r.reason, r.duplicate_of) for r in tr.triage(spark.createDataFrame(rows, IMAGE)).collect()}
    assert got[0] == ("missing_on_disk", None)
    assert all(got[i] == ("boilerplate_repeated", None) for i in range(1, 6))
    assert got[6][0] == got[7][0] == "decorative_dimensions"
    assert got[9] == ("photographic_content", None)
    assert got[11] == ("exact_duplicate", "f10") and got[12] == ("overlap_duplicate", "f10")
    # 13 ~ 14 ~ 15 is one group although 13 and 15 differ in 12 bits.
    assert got[14] == got[15] == ("near_duplicate", "f13")
    assert all(got[i] == (None, None) for i in (8, 10, 13, 16))


def test_photographic(spark):
    pixel = "array<struct<r:int,g:int,b:int>>"
    rng = random.Random(1)
    photo = [(rng.randrange(200), rng.randrange(200), rng.randrange(200)) for _ in range(4096)]
    chart = [(255, 255, 255)] * 4000 + [(200, 0, 0)] * 96
    df = spark.createDataFrame([(1, photo), (2, chart), (3, None)], f"i int, p {pixel}")
    assert [r[0] for r in df.orderBy("i").select(tr.is_photographic(F.col("p"))).collect()] == [True, False, False]


def test_a_long_chain_of_overlaps_takes_few_rounds(spark, monkeypatch):
    # Each box overlaps the next one only, so every second one is dropped.
    rows = [("d", 1, i, 30.0 * i, 0.0, 100.0, 100.0, "embedded") for i in range(3000)]
    rounds = []
    kept = tr.cut_lineage
    monkeypatch.setattr(tr, "cut_lineage", lambda df: rounds.append(1) or kept(df))
    got = {r.idx: r.keeper for r in tr.overlap_drops(spark.createDataFrame(rows, BOX), tr.TriageParams(overlap_iou=0.5, bucket_rows=64)).collect()}
    assert got == {i: i - 1 for i in range(1, 3000, 2)}
    assert len(rounds) < 40
