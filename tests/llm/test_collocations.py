import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from docweave.llm import collocations as C


def slow_collocations(rows, least, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        counts[lang, tuple(words[i : i + k])] += 1
    candidates = {x: a for x, a in counts.items() if len(x[1]) > 1 and a >= least}
    needless = set()
    for (lang, p), a in candidates.items():
        for k in range(2, len(p)):
            for s in range(len(p) - k + 1):
                if a >= counts[lang, p[s : s + k]]:
                    needless.add((lang, p[s : s + k]))
    out = {}
    for (lang, p), a in candidates.items():
        if (lang, p) in needless:
            continue
        n = totals[lang]
        best = min((1000 * a * n // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-best[0], -a, " ".join(p).encode(), counts[lang, p[: best[1]]], counts[lang, p[best[1] :]], n))
    return {(g, i + 1, p.decode(), -a, left, right, n, -s) for g, found in out.items() for i, (s, a, p, left, right, n) in enumerate(sorted(found)[:top])}


def found(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "text string, lang string, n int")
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in C.collocations(docs, **options).collect()}


def random_rows(rng, number, words):
    # Phrases of several words come again and again between single words.
    phrases = [" ".join(rng.choices(words, k=rng.randint(2, 6))) for _ in range(12)]
    rows = []
    for _ in range(number):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        rows.append(("".join(p + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "?! ", "\x0b"]) for p in parts), rng.choice(["en", "de", None, "und"])))
    return rows


def test_collocations_match_brute_force(spark):
    rng = random.Random(4)
    words = ["a", "B", "b", "ÉÉ", "éé", "İx", "x\x85y", "#", "it's", "語", "of", "The", "z" * 40]
    rows = random_rows(rng, 200, words) + [(None, "en"), ("", None), (" \t.,", "en"), ("Of The", "fr")] + [("same text again. Of the day", "de")] * 30
    for least in (1, 3, 20):
        expected = slow_collocations(rows, least, 10**6)
        assert expected and found(spark, rows, least=least, top=10**6) == expected
    assert found(spark, rows, least=2, top=7) == slow_collocations(rows, 2, 7)
    # A full or a tiny table only rules out less.
    assert found(spark, rows, least=4, table_bits=13) == slow_collocations(rows, 4, 2000)


def test_long_texts_are_cut_between_pieces():
    rng = random.Random(9)
    text = "".join(rng.choices(["ab", " ", " cd", ". ", "é,"], k=4000))
    texts, langs = pa.array([text, None, "x" * 900, text]), pa.array(["en", "en", None, "de"])
    def listed(limit):
        out = []
        for data, begin, names, numbers in C.parts_of(texts, langs, limit):
            words = C.Words(data, begin, numbers)
            spelled = words.vocabulary.to_pylist()
            out += [(names[g], spelled[i], bool(n)) for g, i, n in zip(words.lang, words.number, words.next)]
        return out

    whole = listed(1 << 20)
    assert whole == listed(50) == listed(333)
    assert {x[0] for x in whole} == {"en", "de", "und"}


def test_exact_products_and_empty_tables(spark):
    big = 10**16 + 3
    counts = spark.createDataFrame([("en", 0, None, 9 * 10**17 + 7), ("en", 1, "a", big), ("en", 1, "b", 3 * big + 1), ("en", 2, "a b", big - 5)], "lang string, size int, phrase string, n long")
    row = C.scored_phrases(counts).collect()[0]
    assert row.score == 1000 * (big - 5) * (9 * 10**17 + 7) // (big * (3 * big + 1))
    assert found(spark, []) == set() == found(spark, [("a b", "en")])


def test_counts_of_hashes():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 50, 3000).astype(np.uint64)
    hashes, counts = C._hash_counts(values, None)
    assert dict(zip(hashes.tolist(), counts.tolist())) == {k: min(255, v) for k, v in Counter(values.tolist()).items()}
