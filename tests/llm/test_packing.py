import random
import struct
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from docweave.llm import packing as P
from docweave.llm.queries import vocabulary

CONTENT = vocabulary("word_bpe_49k.json")


def slow_squares(sizes, capacity):
    """Sums of squares with every possible placing tried out."""
    bins = []
    for size in sizes:
        def total(gaps):
            return sum(gaps.count(g) ** 2 for g in set(gaps) if 0 < g < capacity)

        gaps = [capacity - sum(b) for b in bins]
        choices = [(total(gaps[:i] + [g - size] + gaps[i + 1 :]), 0, g) for i, g in enumerate(gaps) if 0 < g < capacity and g >= size]
        choices.append((total([*gaps, capacity - size]), 1, capacity))
        _, new, gap = min(choices)
        if new:
            bins.append([size])
        else:
            bins[max(i for i, g in enumerate(gaps) if g == gap)].append(size)
    return sorted(map(sorted, bins))


def test_every_item_goes_where_the_squares_are_least():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([7, 12, 30])
        sizes = [rng.randint(1, capacity) for _ in range(rng.randint(0, 40))]
        packer = P.SquareSums(capacity)
        for i, size in enumerate(sizes):
            packer.place(i, size)
        got = sorted(sorted(sizes[i] for i in held) for held in packer.held)
        # Which of several bins with one gap takes the item doesn't matter to the counts.
        expected = slow_squares(sizes, capacity)
        gaps = lambda bins: sorted(capacity - sum(b) for b in bins)
        assert gaps(got) == gaps(expected)


def test_bins_are_near_the_least_number():
    rng = np.random.default_rng(3)
    for sizes in (rng.integers(1, 2049, 6000), np.minimum(2048, rng.lognormal(6, 1, 6000).astype(int) + 1), np.full(500, 683), np.full(9, 2048)):
        bins = P.pack(sizes.tolist(), 2048)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(int(sizes[i]) for i in b) <= 2048 for b in bins)
        least = max(-(-int(sizes.sum()) // 2048), int((sizes > 1024).sum()), -(-int((sizes > 682).sum()) // 2))
        assert len(bins) <= least * 1.02 + 2
    assert P.pack([], 2048) == []


def test_documents_against_the_library(spark):
    rng = random.Random(7)
    letters = "ab éßΣİ'\n\t,.<|>12 ́語"
    texts = [None, "", " \n", "<|endoftext|>a <|startoftext|>", "ΟΔΟΣ it's we'LL", "é ́e", "many words " * 3000, "x" * 5000, "語" * 4096, "<|STARTOFTEXT|> A,b", "É,é.×,a÷.b", ", starts", "ends a", "E\u0301,e\u0301. A\u030a", "it's,'s we'll.I'M", "a,\u0301b"]
    texts += ["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(150)]
    rows = [(i, t, "old", 1) for i, t in enumerate(texts)] + [(3, texts[3], "old", 1)] * 2 + [(None, "null id", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, offset int")
    coder = Tokenizer.from_str(CONTENT)
    packed = P.pack_documents(docs, CONTENT, keep_ids=True, shard_pieces=40).cache()
    got, whole = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)))
        whole[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    assert set(got) == {i for i, *_ in rows}
    for i, t, *_ in rows:
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, 0]
        pieces = [struct.pack(f"<{len(x)}I", *x) for k in range(0, len(ids), 2048) for x in [ids[k : k + 2048]]]
        times = sum(r[0] == i for r in rows)
        expected = [(k, 2048 * k, len(p) // 4, zlib.crc32(p), p) for k, p in enumerate(pieces)]
        assert sorted(got[i]) == sorted(expected * times)
    for pieces in whole.values():
        upto = 0
        for offset, length, _ in sorted(pieces):
            assert offset == upto
            upto += length
        assert upto <= 2048
    made = {r.sequence_id: (r.n_tokens, bytes(r.ids)) for r in P.sequences(packed).collect()}
    assert made == {s: (sum(x[1] for x in p), b"".join(x[2] for x in sorted(p))) for s, p in whole.items()}
    packed.unpersist()


def test_empty_table_and_other_names(spark):
    docs = spark.createDataFrame([("a", "one two")], "name string, body string")
    rows = P.pack_documents(docs, CONTENT, doc_id="name", text="body").collect()
    assert [(r.doc_id, r.piece, r.start, r.length, r.offset) for r in rows] == [("a", 0, 0, 3, 0)]
    assert P.pack_documents(docs.limit(0), CONTENT, doc_id="name", text="body").count() == 0
