"""Token counts by byte-pair merging on a heap and a linked list; no ids are made."""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docweave.llm.chunk_bpe import byte_letters
from docweave.llm.common import longs, with_text_columns, words_of

# The split of the word-end vocabulary and the mark of a word's last symbol.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WORD_END = "</w>"

# Distinct words whose counts a worker remembers before it starts over; longer words aren't remembered.
CACHE_WORDS, CACHE_LENGTH = 1_000_000, 64


class MergeCounter:
    """Counts the tokens of the word-end vocabulary ``content`` (a JSON file as a string)."""

    def __init__(self, content: str, room: int = CACHE_WORDS) -> None:
        loaded = json.loads(content)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in loaded["model"]["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        self.special = sorted((t["content"] for t in loaded["added_tokens"]), key=len, reverse=True)
        self.any_special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.letters = byte_letters()
        self.room = room
        self.known: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Symbols of one piece minus its merges. The heap holds (rank, place) of adjacent pairs; entries whose
        symbols have changed since are passed over."""
        symbols = [self.letters[b] for b in piece.encode()]
        symbols[-1] += WORD_END
        count = len(symbols)
        ranks = self.ranks
        after = [*range(1, count), -1]
        before = [*range(-1, count - 1)]
        heap = [(ranks[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:])) if pair in ranks]
        heapq.heapify(heap)
        left = count
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if j < 0 or not symbols[i] or ranks.get((symbols[i], symbols[j])) != rank:
                continue
            symbols[i] += symbols[j]
            symbols[j] = ""
            left -= 1
            k = after[i] = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (new := ranks.get((symbols[i], symbols[k]))) is not None:
                    heapq.heappush(heap, (new, i))
            if (h := before[i]) >= 0 and (new := ranks.get((symbols[h], symbols[i]))) is not None:
                heapq.heappush(heap, (new, h))
        return left

    def _plain(self, text: str) -> int:
        # Lower case is taken letter by letter, so a final sigma is no exception.
        lower = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return sum(map(self.merged, SPLIT.findall(lower)))

    def word(self, word: str) -> int:
        """Tokens of a word without ASCII white space; special strings inside it are one token each."""
        if (known := self.known.get(word)) is not None:
            return known
        if self.any_special is not None and "<" in word and (marks := self.any_special.findall(word)):
            count = len(marks) + sum(self._plain(part) for part in self.any_special.split(word) if part)
        else:
            count = self._plain(word)
        if len(word) <= CACHE_LENGTH:
            if len(self.known) >= self.room:
                self.known.clear()
            self.known[word] = count
        return count


_LOADED: dict[int, MergeCounter] = {}


def _counter(content: str) -> MergeCounter:
    key = hash(content)
    if key not in _LOADED:
        _LOADED[key] = MergeCounter(content)
    return _LOADED[key]


def count_tokens(docs: DataFrame, content: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    One pass without a shuffle. No merge crosses white space, so each distinct word of a step is counted once and a
    worker remembers a bounded number of words. Null or empty text: zero bytes and tokens. Repeated rows: one
    result each. Empty table: no rows. Columns of ``docs`` with these names are replaced.
    """

    def make() -> Callable:
        counter = _counter(content)

        def compute(texts: pa.Array) -> list[pa.Array]:
            words, vocabulary, first = words_of(texts)
            distinct = vocabulary.to_pylist()
            counts = np.fromiter(map(counter.word, distinct), np.int64, len(distinct))
            sums = np.concatenate([[0], np.cumsum(counts[words])]) if len(words) else np.zeros(1, np.int64)
            tokens = np.diff(sums[first])
            sizes = np.array([len(t.encode()) if t else 0 for t in texts.to_pylist()], np.int64)
            return [longs(sizes), longs(tokens), pa.array(tokens > limit)]

        return compute

    fields = {"n_bytes": T.LongType(), "n_tokens": T.LongType(), "over_limit": T.BooleanType()}
    return with_text_columns(docs, text, fields, make)
