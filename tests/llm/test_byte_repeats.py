import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

from docweave.llm import byte_repeats as R


def slow(rows, width, keep_first):
    key = lambda i: -1 if i is None else i
    at = defaultdict(set)
    for i, t in set(rows):
        raw = (t or "").encode()
        for s in range(len(raw) - width + 1):
            at[raw[s : s + width]].add((key(i), s, t))
    out = []
    for i, t in rows:
        raw, gone = (t or "").encode(), set()
        for s in range(len(raw) - width + 1):
            places = at[raw[s : s + width]]
            hit = min(p[:2] for p in places) < (key(i), s) if keep_first else len(places) > 1
            if hit:
                gone.update(range(s, s + width))
        spans = sum(1 for g in gone if g - 1 not in gone)
        out.append((str(i), len(raw), len(gone), spans, bytes(b for k, b in enumerate(raw) if k not in gone)))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    letters = "abcdefgh é"
    make = lambda n: "".join(rng.choices(letters, k=n))
    shared = [make(rng.randint(30, 160)) for _ in range(6)]
    rows = [(None, shared[0] * 2), (0, None), (1, ""), (2, "short"), (3, "ab" * 200), (4, "ab" * 150 + make(30))]
    for i in range(5, 40):
        rows.append((i, "".join(make(rng.randint(0, 60)) + rng.choice([*shared, ""]) for _ in range(rng.randint(0, 4)))))
    rows += [rows[10], rows[10], (10, rows[12][1]), (41, rows[13][1]), (42, rows[13][1])]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("sizes", [{}, {"bucket_bytes": 500}, {"hot_passages": 1}])
def test_matches_brute_force(spark, rows, keep_first, sizes):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, runs string")
    got = R.remove_repeats(docs.repartition(3), width=40, keep_first=keep_first, gram=12, **sizes).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == slow(rows, 40, keep_first)


def test_empty_table(spark):
    assert R.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("sizes", [{}, {"bucket_bytes": 500}, {"hot_passages": 1}])
def test_repeats_inside_one_passage(spark, keep_first, sizes):
    rng = random.Random(5)
    make = lambda n: "".join(rng.choices("abcdefgh é", k=n))
    line, block = make(25), make(33)
    rows = [(1, line * 9), (2, make(50) + block * 4 + make(50)), (3, make(60) + "-" * 1000 + make(9)), (4, make(300))]
    # An own period per text, and one periodic text in two documents.
    rows += [(5, make(7) + "xyz" * 60), (6, make(41) + make(2) * 300), (7, "pqr" * 60), (8, "pqr" * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = R.remove_repeats(docs.repartition(3), width=40, keep_first=keep_first, gram=12, **sizes).collect()
    expected = slow(rows, 40, keep_first)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == expected
    assert sum(e[2] > 0 for e in expected) >= 6


def test_passages_with_a_gram_at_two_places_are_inner():
    inner = lambda text: bool(R.passages(R._Hasher(), [text.encode()], 40, 12)[6].any())
    once = "".join(chr(97 + (i * i + 3 * i) % 26) + str(i) for i in range(100))
    assert inner("-" * 60) and inner("The same line\n" * 5) and not inner(once) and not inner("-" * 40)


@pytest.mark.parametrize("keep_first", [True, False])
def test_grams_of_a_bucket_are_sorted_in_parts(spark, rows, keep_first):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = R.remove_repeats(docs.repartition(3), width=40, keep_first=keep_first, gram=12, sort_bytes=300).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == slow(rows, 40, keep_first)


def test_a_suffix_array_takes_few_bytes_per_byte():
    size, passage = 1 << 20, 512
    raw = np.random.default_rng(1).integers(97, 123, size, dtype=np.uint8)
    raw[size // 2 :] = raw[: size // 2]
    room = (passage - np.arange(size) % passage).astype(np.int32)
    starts = np.flatnonzero(room >= 400).astype(np.int32)
    tracemalloc.start()
    order, tied = R.suffix_order(raw, starts, room, 400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert tied.sum() == len(starts) // 2 and sorted(order) == starts.tolist()
    assert peak < 60 * size, peak / size
