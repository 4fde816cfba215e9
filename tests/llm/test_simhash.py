import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from docweave.llm import simhash


def slow(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def components(values, radius):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in values:
        for b in values:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_fingerprint_matches_definition():
    for text in (None, "", " \n", "One", "A b c", "A b c d", "x " * 50, "Été À la one two three four five É", "a\x0bb\x0cc\x85d e f g"):
        assert simhash.fingerprint(text, 4, 42) == slow(text)


def test_forest_connects_like_all_pairs():
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    values = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for s in seeds for _ in range(8)}
    values = list(values | {0, 1, 2**64 - 1, 2**64 - 2})
    expected = components(values, 4)
    array = np.array(values, np.uint64)
    for cut in (None, len(values) // 2):
        if cut is None:
            a, b = simhash.close_forest(array, None, 4)
            got = list(zip(a.tolist(), b.tolist()))
        else:
            parts = [simhash.close_forest(*x, 4) for x in ((array[:cut], None), (array[cut:], None), (array[:cut], array[cut:]))]
            got = [p for a, b in parts for p in zip(a.tolist(), b.tolist())]
        root = {v: v for v in values}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in got:
            assert expected[a] == expected[b]
            root[find(a)] = find(b)
        assert all(find(a) == find(b) for a in values for b in values if expected[a] == expected[b])


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    texts = [None, "", "  ", "Same", "same", *base]
    for text in base[:6]:
        for _ in range(4):
            w = text.split()
            w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
    texts += [base[0]] * 40
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows + [(None, base[1], "y"), (7, texts[7], "z")], "doc_id long, text string, fingerprint string")
    got = simhash.near_duplicates(docs, group_rows=8).collect()
    assert len(got) == len(rows) + 2
    expected = components(sorted({slow(t) for t in texts}), 4)
    least = {}
    for i, t in enumerate(texts):
        least.setdefault(expected[slow(t)], i)
    for row in got:
        text = base[1] if row.doc_id is None else texts[row.doc_id]
        assert row.fingerprint % 2**64 == slow(text)
        assert row.component_id == least[expected[slow(text)]]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).withColumn("h", simhash.as_hex()).count() == 0
    assert spark.range(1).select(F.lit(-1).cast("long").alias("fingerprint")).select(simhash.as_hex()).first()[0] == "f" * 16
