import sys
import unicodedata

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from docweave.llm import token_count as C

PATH = public_tokenizers.path("word_bpe_49k.json")
CONTENT = open(PATH, encoding="utf-8").read()
COUNTER = C.MergeCounter(CONTENT)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def count(text):
    return sum(COUNTER.word(w) for w in regex_words(text))


def regex_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abEzΣİſ'sret1.\n\t é中<|>\U0001f600́  \x1c\x85"), max_size=80))
def test_any_text(library, text):
    assert count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_every_character(library):
    cases = []
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(chr(c)) in ("Cs", "Co", "Cn"):
            continue
        if c < 0x3000 or c % 7 == 0:
            cases.append(f"a{chr(c)}b {chr(c)} {chr(c)}1{chr(c)}.")
    got = library.encode_batch(cases, add_special_tokens=False)
    bad = [c for c, e in zip(cases, got) if count(c) != len(e.ids)]
    assert not bad, bad[:20]


def test_special_strings_and_long_words(library):
    for text in ("<|endoftext|>", "x<|startoftext|>y <|endoftext|><|endoftext|>", "<|ENDOFTEXT|>", "ab" * 5000, "aaaaaaa" * 99, "don't we'll"):
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_small_memory_gives_the_same(library):
    counter = C.MergeCounter(CONTENT, room=3)
    words = [f"word{i % 9}" for i in range(50)]
    assert sum(map(counter.word, words)) == len(library.encode(" ".join(words), add_special_tokens=False).ids)


def test_table(spark, library):
    rows = [(1, None, "a"), (2, "", "b"), (3, "Été <|endoftext|> isn't", "c"), (3, "Plain", "c"), (None, "n " * 3000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = C.count_tokens(docs, CONTENT).collect()
    for (i, text, _), row in zip(rows, got):
        tokens = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (row.doc_id, row.n_bytes, row.n_tokens, row.over_limit) == (i, len((text or "").encode()), tokens, tokens > 2048)
    assert C.count_tokens(docs.limit(0), CONTENT).count() == 0
