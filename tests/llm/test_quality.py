import random
import re
from collections import Counter

from pyspark.sql import functions as F

from docweave.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), len(lines)


def test_counts_match_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " \n\t\n", "one", "a b c a b c", "a b\na b\n\na b", "é|ü #\x0b$ x\x85y z", "ab " * 20_000]
    texts += ["".join(rng.choices("ab c\n#|é", k=rng.randint(0, 200))) for _ in range(60)]
    frame = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "id int, text string, n_words string")
    got = {r.id: tuple(r[c] for c in Q.COUNTS) for r in Q.text_counts(frame).collect()}
    assert got == {i: slow_counts(t) for i, t in enumerate(texts)}


def test_buckets_keep_order_and_error(spark):
    values = [*range(300), 999, 10_000, 123_456_789, 2**40 + 5]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select("v", Q.bucket(F.col("v"), 6).alias("b")).orderBy("v").collect()
    assert all(r.b <= r.v <= r.b * (1 + 1 / 64) for r in rows)
    assert [r.b for r in rows] == sorted(r.b for r in rows) and all(r.b == r.v for r in rows if r.v < 128)


def test_verdicts_and_odd_rows(spark):
    rng = random.Random(2)
    clean = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(80))
    noisy = lambda: " ".join(w + "***$$$" for w in clean().split())
    rows = [(i, clean(), "en", "s1" if i % 3 else None) for i in range(400)]
    rows += [(500 + i, noisy(), "en", "s1") for i in range(20)]
    rows += [(600, None, None, None), (601, "", "en", "s1"), (602, "short text", "xx", "s9"), (603, "same word now " * 60, "en", "s1"), (603, clean(), None, "s1"), (None, clean(), "en", "s1")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, lang string, source string, kept int")
    got = Q.quality_verdicts(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.base_failed, r.kept))
    assert all(by[i] == [(False, True)] for i in range(400))
    assert all(by[500 + i] == [(False, False)] for i in range(20))
    assert by[600] == by[601] == by[602] == [(True, False)]
    assert sorted(by[603]) == [(False, True), (True, False)] and by[None] == [(False, True)]
    assert Q.quality_verdicts(docs.limit(0)).count() == 0
