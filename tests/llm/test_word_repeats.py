import random
from collections import defaultdict

import numpy as np

from docweave.llm import word_repeats as R


def slow(rows, width):
    """Brute force over (doc_id, text): kept words per row."""
    first = defaultdict(lambda: (float("inf"), 0))
    key = lambda i: -float("inf") if i is None else i
    split = [(key(i), (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        for s in range(len(words) - width + 1):
            w = tuple(words[s : s + width])
            first[w] = min(first[w], (i, s))
    out = []
    for i, words in split:
        gone = set()
        for s in range(len(words) - width + 1):
            if first[tuple(words[s : s + width])] < (i, s):
                gone.update(range(s, s + width))
        out.append((len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return out


def check(spark, rows, width, **more):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, runs string")
    got = R.remove_repeats(docs.repartition(5), width=width, **more).collect()
    expected = sorted((str(i), *x) for (i, _), x in zip(rows, slow(rows, width)))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in got) == expected


def test_matches_brute_force(spark):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(50)] + ["é", "a.b"]
    passages = [rng.choices(vocabulary, k=rng.randint(18, 70)) for _ in range(6)]
    rows = [(None, " ".join(passages[0])), (0, None), (1, ""), (2, "short"), (3, "same " * 300), (4, " \n\t".join(passages[1]))]
    for i in range(5, 60):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += rng.choices(vocabulary, k=rng.randint(0, 40)) + (rng.choice(passages) if rng.random() < 0.6 else [])
        rows.append((i, " ".join(words)))
    rows += [rows[10], rows[10], (10, rows[12][1]), (61, " ".join(passages[0])), (62, rows[3][1])]
    rng.shuffle(rows)
    check(spark, rows, 20)
    check(spark, rows, 20, bucket_bytes=2000)
    check(spark, [], 20)


def test_equal_keys_are_compared_by_words():
    words = np.arange(60) % 30
    words[35] = 31
    ids, starts, counts = np.array([1, 2]), np.array([0, 0]), np.array([30, 30])
    got = R.later_windows(ids, starts, counts, words, np.zeros(40, np.uint64), 5)
    expected = [False] * 26 + [not (5 in range(s, s + 5)) for s in range(26)]
    assert got.tolist() == expected


def test_a_pair_in_all_rows_is_dealt_to_many_buckets(spark):
    rng = random.Random(2)
    # The pair of words whose hash is less than that of all others.
    pairs = [(f"p{i}", f"q{i}") for i in range(20_000)]
    words = np.array([[R.xxhash.xxh64_intdigest(w) for w in pair] for pair in pairs], np.uint64)
    low = [R._window_keys(pair, 2)[0] for pair in words]
    pair = " ".join(pairs[int(np.argmin(low))])
    make = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    shared = f"{make(9)} {pair} {make(14)}"
    rows = [(i, " ".join([f"{make(8)} {pair} {make(9)}" for _ in range(3)] + ([shared] if i % 3 == 0 else []))) for i in range(60)]
    check(spark, rows, 20, bucket_bytes=4000)
    docs = R.keyed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    total = sum(len(t) for _, t in rows)
    large = R.large_keys(docs, 20, total, 4000)
    assert min(low) in large[0]

    def most(large):
        _, _, _, key, strings = R.super_kmers(R.pa.array([t for _, t in rows]), 20, large)
        size = defaultdict(int)
        for k, string in {(int(k), s) for k, s in zip(key, strings)}:
            size[k] += len(string)
        return max(size.values())

    assert most(large) <= 4000 < most(R.NONE_LARGE)
