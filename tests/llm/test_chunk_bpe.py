import random
import struct

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docweave.llm import chunk_bpe as B

PATH = public_tokenizers.path("byte_bpe_50k.json")
CONTENT = open(PATH, encoding="utf-8").read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return B.ChunkCoder(B.Vocabulary(CONTENT))


def ids(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z'sre1.\n\t é中<|>\U0001f600́"), max_size=200), max_size=5))
def test_any_texts(coder, library, texts):
    assert [ids(x) for x in coder.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_shared_and_unspaced_texts(coder, library):
    rng = random.Random(4)
    words = ["the", "of", "Ndonre", "théé", "a1b2", "x's", "...", "\n\n", "  ", "中文", "<|endoftext|>"]
    shared = " ".join(rng.choices(words, k=2000))
    texts = [None, "", shared, "lead " + shared, shared[500:] + shared[:700], "z" * 20_000, "".join(rng.choices("abcdef \n", k=20_000))]
    before = coder.reused
    got = coder.encode_all(texts)
    assert [ids(x) for x in got] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert coder.reused > before


def test_small_cache_gives_the_same(library):
    coder = B.ChunkCoder(B.Vocabulary(CONTENT), room=3000)
    text = " ".join(f"word{i} and more" for i in range(3000))
    assert ids(coder.encode_all([text])[0]) == library.encode(text, add_special_tokens=False).ids


def test_table(spark, library):
    rows = [(1, None, "a"), (2, "", "b"), (3, "Plain text <|endoftext|> é.", "c"), (3, "Plain text", "c"), (None, "n" * 100_000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = B.encode_texts(docs, CONTENT)
    got = B.decode_ids(encoded, CONTENT).collect()
    assert got == B.encode_texts(docs, CONTENT, decode=True).collect()
    for (i, text, _), row in zip(rows, got):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert (row.doc_id, ids(bytes(row.ids)), row.n_tokens) == (i, expected, len(expected))
        assert row.decoded == library.decode(expected, skip_special_tokens=False)
    assert B.decode_ids(B.encode_texts(docs.limit(0), CONTENT), CONTENT).count() == 0
    odd = [[447], [447, 247], [50256, 5, 447], list(range(0, 50257, 97))]
    frame = spark.createDataFrame([(bytearray(struct.pack(f"<{len(x)}I", *x)),) for x in odd], "ids binary")
    assert [r.decoded for r in B.decode_ids(frame, CONTENT).collect()] == [library.decode(x, skip_special_tokens=False) for x in odd]
    frame = spark.createDataFrame([(bytearray(struct.pack("<2I", 5, 99_999_999)),), (None,)], "ids binary")
    assert [r.decoded for r in B.decode_ids(frame, CONTENT).collect()] == [library.decode([5]), ""]
