import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np

from docweave.llm import filter_audit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_audit(rows, labels):
    """Applies the filters document by document, order by order."""
    quality, toxic = defaultdict(int), defaultdict(int)
    for i, q, t in labels:
        quality[i] |= q == 1
        toxic[i] |= t == 1
    parts = defaultdict(list)
    for i, text, source in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows),
        }
        good, bad = (False, False) if i is None else (quality[i], toxic[i])
        parts[source or ""].append((fails, good, bad))
    out = {}
    for part, docs in parts.items():
        shapley = defaultdict(int)
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[0][f]]
                left = [d for d in left if not d[0][f]]
                failing = [d for d in docs if d[0][f]]
                unique = [d for d in failing if sum(d[0].values()) == 1]
                shapley[f] += len(gone)
                counts = (len(left), len(gone), len(failing) - len(gone), len(unique), sum(d[1] for d in gone), sum(d[2] for d in gone))
                out[part, "".join(order), step] = counts
        for (p, order, step), counts in list(out.items()):
            if p == part:
                out[p, order, step] = (*counts, shapley[order[step - 1]])
    return out


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, mask string, n int")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return A.audit_filters(docs, marks)


def test_audit_matches_brute_force(spark):
    rng = random.Random(11)
    texts = [None, "", " \n\x0b", "A" * 50, "a b " * 300, " ".join(f"w{i}" for i in range(250)), " ".join(f"w{i}" for i in range(250)) + " #", "é|" * 9, "x\x85y " * 200]
    texts += [" ".join(rng.choices(["aa", "B", "c#", "dd", "é", "Ff"] + [f"w{k}" for k in range(400)], k=rng.randint(150, 260))) for _ in range(15)]
    rows = [(rng.randint(0, 60), rng.choice(texts), rng.choice(["s1", "s2", None, ""])) for _ in range(150)]
    rows += [(None, rng.choice(texts), "s1") for _ in range(5)] + [(7, "", "s3")] * 3
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(4, 1, None), (None, 1, 1), (999, 1, 1)]
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audited(spark, rows, labels).collect()}
    assert got == slow_audit(rows, labels)


def test_walk_gives_every_subset():
    rng = np.random.default_rng(2)
    cells = rng.integers(0, 50, (16, 2))
    states = A.walk(cells, 4)
    for active in range(16):
        assert (states[active] == cells[[m for m in range(16) if not m & active]].sum(axis=0)).all()


def test_empty_tables(spark):
    assert audited(spark, [], []).count() == 0
    rows = audited(spark, [(1, "x", "s")], []).collect()
    assert len(rows) == 600 and all(r.kept == 0 and r.good_lost == 0 for r in rows if r.filter_order[: r.step].find("A") >= 0)
