import random

import pytest

from docweave.llm import line_dedup as D


def slow(rows):
    key = lambda i: -1 if i is None else i
    lines = [((key(i), n), frozenset(l.encode().split())) for i, t in rows if t is not None for n, l in enumerate(t.split("\n"))]
    out = []
    for place, words in lines:
        if not words:
            continue
        earlier = [w for p, w in lines if p < place and w and 5 * len(w & words) >= 4 * len(w | words)]
        if earlier:
            out.append((*place, words in earlier))
    return sorted(out)


def made_rows():
    rng = random.Random(8)
    words = [f"w{rng.randint(0, 30) if rng.random() < 0.5 else rng.randint(0, 4000)}" for _ in range(400)]
    base = [rng.choices(words, k=rng.randint(1, 40)) for _ in range(25)]

    def line():
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        return " ".join(w)

    rows = [(None, line() + "\n" + line()), (0, None), (1, ""), (2, " \n\t\n"), (3, "one\none\nthe One"), (4, "x " * 5000)]
    rows += [(i, "\n".join(rng.choice(["", "é \x0b é"]) if rng.random() < 0.1 else line() for _ in range(rng.randint(1, 6)))) for i in range(5, 70)]
    return rows


@pytest.mark.parametrize("limit", [D.BROADCAST_LINES, 0])
def test_matches_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "BROADCAST_LINES", limit)
    rows = made_rows()
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int").repartition(3)
    got = D.repeated_lines(docs).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.line_no, r.copy) for r in got) == slow(rows)


def test_lines_are_dropped(spark):
    rows = [(1, "a b c d e\nunique here\n", "s"), (2, "a b c d e\nother words", "t"), (2, "a b c d e\nother words", "t"), (3, "e d c b a", "u"), (4, "", "v"), (5, None, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone string")
    got = sorted(map(tuple, D.drop_repeated_lines(docs).collect()))
    assert got == [(1, "a b c d e\nunique here\n", "s"), (2, "other words", "t"), (2, "other words", "t"), (4, "", "v"), (5, None, "w")]
    assert D.drop_repeated_lines(docs.limit(0)).count() == 0


def test_plan_has_no_python(spark):
    plan = D.repeated_lines(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_long_lines_match_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{rng.randint(0, 60) if rng.random() < 0.4 else rng.randint(0, 900)}" for _ in range(1200)]
    base = [rng.choices(words, k=n) for n in (*range(D.NARROW - 8, D.NARROW + 14, 3), 90, 140, 200)]

    def line():
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, len(w) // 6)):
            w[rng.randrange(len(w))] = rng.choice(words)
        return " ".join(w[rng.randint(0, len(w) // 10) :])

    rows = [(i, "\n".join(line() for _ in range(3))) for i in range(60)]
    got = D.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(map(tuple, got)) == slow(rows) and 50 < len(got) < 170


def test_unlike_long_lines_make_no_candidates(spark, monkeypatch):
    rng = random.Random(6)
    words = [f"w{n}" for n in range(600)]
    rows = [(i, " ".join(rng.sample(words, 140))) for i in range(200)]
    made, pairs = [], D._pairs

    def counted(shared, leads=False):
        made.append(shared.count())
        return pairs(shared, leads)

    monkeypatch.setattr(D, "_pairs", counted)
    assert D.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
    assert made[-1] < 20, made


def test_lines_are_split_once_a_pass(spark, monkeypatch):
    plans, stored = [], D.stored

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df)

    monkeypatch.setattr(D, "stored", seen)
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i k"), (3, "a b c d e f g h i j")]
    assert D.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).count() == 2
    counts = [plan.count("transform(split(line") for plan in plans]
    assert max(counts) == 1 and sum(counts) == 3, counts


def test_ranks_are_looked_up_in_one_pass(spark, monkeypatch):
    plans, stored = [], D.stored

    def seen(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df)

    monkeypatch.setattr(D, "stored", seen)
    rows = [(1, "a\tb c  d e f\x0bg h i j\r"), (2, "a b\x0cc d e f g h i k"), (3, "a b c d e f g h i j"), (4, "a\tb"), (5, "b a ")]
    got = D.repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == slow(rows) and len(got) == 3
    looked = [plan for plan in plans if "scalar-subquery" in plan]
    # Lines to verify need no ranks; the table isn't a column, which would be copied for each line.
    assert len(looked) == 1 and looked[0].count("scalar-subquery") == 1 and "AS ranks" not in looked[0]
    # What is interpreted with the lookup starts from a column of sorted hashes.
    assert "sort_array(transform(transform(hashes" in looked[0]
    assert all("regexp_replace" not in plan or "CASE WHEN" in plan.split("regexp_replace")[0] for plan in plans)
