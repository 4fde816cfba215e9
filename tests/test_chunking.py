"""Chunking against a plain-Python model, with blocks small enough to be crossed."""

import random
import re
import uuid

import numpy as np
import pytest

from pyspark.sql import functions as F

from docweave.operators import chunking as ch

SCHEMA = (
    "document_id string, element_id string, element_type string, text string, page_number int, `order` bigint, "
    "domain string, source_type string, file_name string"
)


def make_stream(rng, document, size):
    rows = []
    for i in range(size):
        kind = rng.choices(["heading", "text", "table", "image", "text"], [2, 5, 1, 1, 3])[0]
        n = rng.choice([0, 1, 2, 3, 5, 8, 13, 40])
        text = " ".join(f"w{rng.randrange(99)}" for _ in range(n))
        if kind == "heading":
            text = "#" * rng.randrange(1, 5) + " " + (text or "title")
        rows.append((document, f"{document}:{i}", kind, text, rng.choice([None, 1, 2, 3]), i, "legal", "pdf", "f.pdf"))
    return rows


def uid(*parts):
    return str(uuid.uuid5(uuid.NAMESPACE_URL, ":".join(parts)))


def windows(text, size, overlap):
    words = text.split()
    if len(words) <= size:
        return [text]
    step = max(size - overlap, 1)
    return [" ".join(words[s : s + size]) for s in range(0, len(words), step)]


def model(rows, p):
    """Parents and children of one document, written from the description of the operators."""
    expanded = []
    for r in rows:
        pieces = windows(r[3], p.parent_max, p.overlap)
        for n, piece in enumerate(pieces):
            expanded.append((r[2], piece, r[4], r[1] + (f"#p{n}" if len(pieces) > 1 else "")))
    parts, stack, title, path, fresh, total = [], [], None, [], True, 0
    for kind, text, page, ref in expanded:
        if kind == "heading":
            level = max(len(re.match(r"#*", text).group()), 1)
            title = text.lstrip("#").strip()
            stack = [s for s in stack if s[0] < level] + [(level, title)]
            path, fresh = [t for _, t in stack], True
            continue
        n = len(text.split())
        if fresh or total + n > p.parent_max:
            parts.append((title, path, []))
            fresh, total = False, 0
        parts[-1][2].append((kind, text, page, ref))
        total += n
    parents, children = [], []
    for number, (title, path, content) in enumerate(parts):
        pid = uid(rows[0][0], "parent", str(number))
        pages = sorted({c[2] for c in content if c[2] is not None})
        parents.append((pid, title, path, pages, "\n\n".join(c[1] for c in content if c[1])))
        made, buffer = [], []

        def flush():
            if buffer:
                made.append(list(buffer))

        for kind, text, page, ref in content:
            if kind == "table":
                flush()
                buffer = []
                made += [[(w, page, "table", None)] for w in windows(text, p.max_tokens, p.overlap) if text.strip()]
            elif text.strip():
                for w in windows(text, p.max_tokens, p.overlap):
                    if buffer and sum(len(b[0].split()) for b in buffer) + len(w.split()) > p.target:
                        made.append(list(buffer))
                        tail = []
                        while buffer and p.overlap > 0 and (not tail or sum(len(b[0].split()) for b in tail) < p.overlap):
                            tail.insert(0, buffer.pop())
                        buffer = tail
                    image = kind == "image"
                    buffer.append((w, page, "image" if image else "text", ref if image else None))
        flush()
        for i, units in enumerate(made):
            children.append(
                (
                    uid(pid, "child", str(i)), pid, title, "\n\n".join(u[0] for u in units).strip(),
                    sorted({u[1] for u in units if u[1] is not None}), sorted({u[2] for u in units}), [u[3] for u in units if u[3]],
                )
            )
    return parents, children


@pytest.mark.parametrize("block_rows", [3, 1000])
def test_matches_model(spark, block_rows):
    rng = random.Random(7)
    params = ch.ChunkParams(target=12, overlap=4, max_tokens=15, parent_max=25, block_rows=block_rows)
    streams = [make_stream(rng, f"d{d}", rng.choice([1, 4, 30, 80])) for d in range(12)]
    # A document without headings: one section over many blocks.
    streams.append([r for r in make_stream(rng, "plain", 90) if r[2] != "heading"])
    streams[-1] = [(*r[:5], i, *r[6:]) for i, r in enumerate(streams[-1])]
    df = spark.createDataFrame([r for s in streams for r in s], SCHEMA)
    assigned, heads = ch.assign_parents(df, params), ch.headings(df, params)
    want = [model(s, params) for s in streams]
    got = ch.parent_sections(assigned, heads).select("parent_id", "section_title", "section_path", "page_numbers", "parent_text").collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(repr(p) for ps, _ in want for p in ps)
    kids = ch.child_chunks(assigned, heads, params).select(
        "chunk_id", "parent_id", "section_title", "text_content", "page_numbers", "modalities", "image_refs"
    ).collect()
    assert sorted(map(repr, (tuple(r) for r in kids))) == sorted(repr(c) for _, cs in want for c in cs)


def test_exit_table_equals_fold():
    rng = np.random.default_rng(3)
    for _ in range(300):
        budget = int(rng.integers(0, 12))
        counts = rng.integers(-1 if rng.random() < 0.3 else 0, 9, size=int(rng.integers(1, 15)))
        table = ch.exit_table(counts, budget)
        for state in range(-1, budget + 2):
            want = min(ch.fold(counts, state, budget)[1], budget + 1)
            assert (table[0] if len(table) == 1 else table[state + 1]) == want


def test_table_rows_keep_header(spark):
    table = "| a | b |\n|---|---|\n" + "\n".join(f"| {i} | x |" for i in range(6))
    texts = [table, "| only header |", "no table\nat all", None, "", "|h|\r\n| long row of words |\r\n| b |\r\n"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    split = lambda size: [r.p for r in ch.with_table_pieces(rows, F.col("text"), size, "p").sort("id").collect()]
    got = split(16)
    assert all(w.startswith("| a | b |\n|---|---|\n| ") for w in got[0]) and len(got[0]) > 1
    assert [r for w in got[0] for r in w.split("\n")[2:]] == table.split("\n")[2:]
    assert got[1:5] == [None] * 4
    # A row above the size is a piece of its own.
    assert split(1)[5] == ["|h|\n| long row of words |", "|h|\n| b |"]


def test_image_paths_take_first_file_per_reference(spark):
    kids = spark.createDataFrame([("c", "law", "a.pdf", ["a:p1:i2", "a:p1:i9", "a:p1:i1", "a:p1:i2"])], "chunk_id string, domain string, file_name string, image_refs array<string>")
    files = spark.createDataFrame([("law", "a", f"img/law/a/{n}") for n in ("i1.png", "i2.png", "i2.jpg")], "domain string, slug string, path string")
    row = ch.resolve_images(kids, files).first()
    assert row.image_paths == ["img/law/a/i2.jpg", "img/law/a/i1.png", "img/law/a/i2.jpg"]


def test_entries_from_a_tree_of_tables(spark):
    rng = np.random.default_rng(8)
    budget = 30
    rows, expected = [], {}
    for doc, blocks in (("a", 23), ("b", 1), ("c", 7)):
        state = ch.CLOSED
        for block in range(blocks):
            counts = rng.integers(1, 25, rng.integers(1, 6))
            if rng.random() < 0.1:
                counts[0] = ch.HEADING
            expected[doc, block] = state
            state = min(ch.fold(counts, state, budget)[1], budget + 1)
            rows.append((doc, block, ch.exit_table(counts, budget)))
    tables = spark.createDataFrame(rows, "document_id string, block bigint, exits array<int>")
    for fan in (2, 3, 1000):
        found = ch.block_entries(tables, budget, fan)
        assert {(r.document_id, r.block): r.entry for r in found.collect()} == expected


def test_texts_are_cleaned_once_for_all_steps_of_a_fold(spark):
    """Steps of ``assign_parents`` read the pieces back instead of splitting every text again."""
    rows = [(f"d{d}", f"{d}:{i}", "heading" if i % 4 == 0 else "text", f"w{i} " * (i + 1), 1, i, "x", "pdf", "f") for d in range(2) for i in range(9)]
    elements = spark.createDataFrame(rows, "document_id string, element_id string, element_type string, text string, page_number int, order int, domain string, source_type string, file_name string")
    reads = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    counted = elements.mapInArrow(seen, elements.schema)
    placed = ch.assign_parents(counted, ch.ChunkParams(target=8, overlap=2, max_tokens=10, parent_max=12, block_rows=4)).collect()
    assert {r.element_id.split("#")[0] for r in placed} == {r[1] for r in rows if r[2] == "text"}
    assert reads.value == len(rows)
