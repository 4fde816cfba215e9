import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as P

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names, columns = [], docs.columns
    for number, (name, stage) in enumerate(P.STAGES):
        names.append(name)
        before = docs.count()
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        assert docs.count() <= before
        if number < len(P.STAGES) - 1:
            assert docs.columns == columns
    assert names == ["language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe_codec"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    rows = docs.collect()
    assert len(rows) == len(texts) > 100
    for row in rows:
        assert row.round_trip and row.n_tokens == len(library.encode(texts[row.doc_id], add_special_tokens=False).ids)


def brute_force(rows, items):
    """Language-independent stages on (doc_id, text) rows in order of id: lines, near duplicates, leaks."""
    from test_line_dedup import slow as repeated
    from test_simhash import components
    from test_simhash import slow as fingerprint

    gone = {(i, n) for i, n, _ in repeated(rows)}
    cut = []
    for i, text in rows:
        lines = [(n, line) for n, line in enumerate(text.split("\n"))]
        left = "\n".join(line for n, line in lines if (i, n) not in gone)
        if not any((i, n) in gone for n, _ in lines) or left.split():
            cut.append((i, left))
    group = components(sorted({fingerprint(t) for _, t in cut}), 4)
    seen, kept = set(), []
    for i, text in cut:
        if group[fingerprint(text)] not in seen:
            seen.add(group[fingerprint(text)])
            kept.append((i, text))
    return [(i, t) for i, t in kept if not any(item in t for item in items)]


def test_run_equals_brute_force(spark, tmp_path):
    rng = random.Random(12)
    words = [a + b + c for a in ("ka", "to", "mi", "ste", "lor") for b in ("na", "ri", "", "sum", "dor") for c in ("", "len", "vok", "a")]
    line = lambda n: " ".join(rng.choices(words, k=n))
    items = [line(30) for _ in range(4)]
    shared = [line(12) for _ in range(3)]
    rows = []
    for i in range(60):
        lines = [line(rng.randint(25, 60)) for _ in range(rng.randint(1, 4))]
        if i % 7 == 0:
            lines.append(rng.choice(shared))
        if i % 10 == 3:
            lines.insert(0, line(8) + " " + items[i // 10 % 4] + " " + line(9))
        rows.append((i, "\n".join(lines)))
    rows += [(60, rows[5][1]), (61, rows[6][1] + " end"), (62, "12 34"), (63, "...")]
    docs = spark.createDataFrame([(i, t, "aa", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r.n_tokens for r in P.run(spark, str(tmp_path)).collect()}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = brute_force(rows[:62], items)
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in expected}
    assert 30 < len(got) < 60


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None), (1, None, None, None, 0), (1, "", "en", "s", 0)]])
def test_odd_tables(spark, tmp_path, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_registered():
    assert "pipeline" in __spark_entry__.queries()
    numbers = sorted(int(n[2:].split("_")[0]) for n in __spark_entry__.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14))
