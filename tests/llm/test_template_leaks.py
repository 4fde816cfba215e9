import random

from docweave.llm import template_leaks as L

ITEMS = [
    (1, "Anna has 12 apples and gives 5 apples to Peter, who sells them for 3 dollars in the market of the old town."),
    (2, "How far does a train travel in 3 hours when Maria drives it at 80 km per hour along the coast?"),
    (3, "too short item"),
    (4, None),
    (5, "Anna has 12 apples and gives 5 apples to Peter, who sells them for 3 dollars in the market of the old town."),
]


def run(spark, rows, **more):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, item_id string, template string").repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    return sorted(map(tuple, L.leaks(docs, items, **more).collect()), key=str)


def found(spark, rows, **more):
    return sorted(((r[0], r[1], r[5]) for r in run(spark, rows, **more)), key=str)


def test_leaks_exact_and_reparameterised(spark):
    lead, tail = "Some words before it. ", " And some words behind it."
    anna = ITEMS[0][1]
    other = anna.replace("12", "40").replace("5", "7").replace("Peter", "Oskar").replace("3", "9")
    rows = [
        (10, lead + anna + tail),
        (11, lead + "the clever " + other + tail),
        (12, lead + ITEMS[1][1].lower() + tail),
        (13, "Nothing of the kind is in here, only 12 apples and 5 pears of the old town."),
        (14, None),
        (15, ""),
        (16, anna + " " + ITEMS[1][1]),
        (17, lead + anna + tail),
        (17, lead + anna + tail),
        (18, "1 2 3 4 5 6 7 8 9 10 " * 50),
        (None, anna),
    ]
    expected = [(10, 1, False), (11, 1, True), (12, 2, False), (16, 1, False), (16, 2, False), (17, 1, False), (None, 1, False)]
    got = found(spark, rows)
    assert got == sorted(expected, key=str)
    assert found(spark, rows, block_windows=3) == got
    assert run(spark, rows[:0]) == []


def test_inconsistent_slots_do_not_count(spark):
    item = "Take 4 cups of flour then mix 4 cups of water then heat 4 cups of milk before the bread is baked well"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = item.replace("4", "6")
    mixed = item.replace("4", "6", 1)
    docs = spark.createDataFrame([(1, same), (2, mixed)], "doc_id long, text string")
    assert [(r.doc_id, r.reparameterised) for r in L.leaks(docs, items).collect()] == [(1, True)]


def test_random_passages(spark):
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "bdfgk" for b in ("a", "ena", "orin", "ul")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(15, 50)))) for i in range(30)]
    docs, expected = [], []
    for i in range(120):
        text = [" ".join(rng.choices(words, k=rng.randint(5, 60)))]
        if i % 3 == 0:
            k = rng.randrange(30)
            text.append(items[k][1])
            expected.append((i, k))
        docs.append((i, " ".join(text + [" ".join(rng.choices(words, k=20))])))
    got = L.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == sorted(expected)


def test_documents_are_dropped_without_python(spark):
    docs = spark.createDataFrame([(1, ITEMS[0][1], "a"), (2, "clean", "b"), (None, None, "c")], "doc_id long, text string, _x string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    left = L.without_leaks(docs, items)
    assert left.columns == docs.columns and sorted(map(tuple, left.collect()), key=str) == [(2, "clean", "b"), (None, None, "c")]
    plan = L.leaks(docs, items)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert L.leaks(docs, items.limit(0)).count() == 0


GERMAN = "Am Montag kauft Frau Schneider 12 Brote und bringt danach 3 kg Mehl zu Peter, der in Hamburg 80 km weiter mit Anna wohnt und arbeitet."


def test_values_of_other_lengths_and_other_cases(spark):
    items = spark.createDataFrame([(1, GERMAN), ITEMS[1]], "item_id long, text string")
    train = ITEMS[1][1]
    texts = [
        (GERMAN.lower(), 1, False),
        (GERMAN.upper(), 1, False),
        (train.replace("80 km", "80km"), 2, False),
        (train.replace("80 km", "95km"), 2, True),
        (train.replace("Maria", "Anna Maria Lopez"), 2, True),
        (GERMAN.replace("Peter", "Hans Meier").replace("3 kg", "25kg"), 1, True),
    ]
    docs = spark.createDataFrame([(i, f"some words before it. {t} and some behind") for i, (t, _, _) in enumerate(texts)], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.reparameterised) for r in L.leaks(docs, items).collect())
    assert got == [(i, item, other) for i, (_, item, other) in enumerate(texts)]


def test_recall_of_reparameterised_items(spark):
    """Five kinds of change, at random; the rest of the items must not be reported."""
    rng = random.Random(11)
    words = [a + b for a in ("bl", "dr", "fl", "kr", "pl", "st") for b in ("ona", "eki", "urt", "amo", "ilde")]
    names = ["Anna", "Peter", "Maria Lopez", "Hans Meier", "Olga", "Jan van Dyk"]
    units = ["km", "kg", "minutes", "euro"]

    def item():
        k = rng.randint(18, 45)
        parts = [("w", w) for w in rng.choices(words, k=k)]
        for _ in range(k // 6):
            parts[rng.randrange(1, k)] = rng.choice([("name", rng.choice(names)), ("number", str(rng.randint(2, 99))), ("unit", f"{rng.randint(2, 99)} {rng.choice(units)}")])
        return parts

    def changed(parts, kind):
        swap = {}
        out = []
        for what, w in parts:
            if what == "name" and kind in ("names", "all"):
                w = swap.setdefault(w, f"Zed{len(swap)} Quinn{len(swap)}" if len(swap) % 2 else f"Zed{len(swap)}")
            if what in ("number", "unit") and kind in ("numbers", "all"):
                number, *unit = w.split()
                w = " ".join([swap.setdefault(number, str(100 + len(swap))), *unit])
            if what == "unit" and kind in ("glued", "all"):
                w = w.replace(" ", "")
            out.append(w)
        text = " ".join(out)
        return text.lower() if kind == "lower" else text

    items = [item() for _ in range(100)]
    kinds = ("numbers", "names", "glued", "lower", "all")
    docs = []
    for i, parts in enumerate(items):
        for k, kind in enumerate(kinds):
            around = [" ".join(rng.choices(words, k=rng.randint(5, 40))) for _ in range(2)]
            docs.append((i * 5 + k, f"{around[0]} {changed(parts, kind)} {around[1]}"))
    table = spark.createDataFrame([(i, " ".join(w for _, w in parts)) for i, parts in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in L.leaks(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()}
    assert all(d // 5 == i for d, i in got)
    for k in range(5):
        assert sum((i * 5 + k, i) in got for i in range(100)) >= 90, kinds[k]
