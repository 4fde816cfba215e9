"""Embeddings of retrieval units: pluggable models and offline stand-ins."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.settings import DEFAULTS

TextModel = Callable[[list[str]], list[list[float]]]
SparseModel = Callable[[list[str], int], list[tuple[list[str], list[float]]]]

# Texts that a sparse model gets at a time.
MODEL_ROWS = 256


def log_count_model(texts: list[str], max_terms: int) -> list[tuple[list[str], list[float]]]:
    """Offline sparse model: log(1 + count) per lower-case word, the heaviest ``max_terms``."""
    found = []
    for text in texts:
        ranked = sorted(Counter(text.lower().split()).items(), key=lambda kv: (-kv[1], kv[0]))[:max_terms]
        found.append(([t for t, _ in ranked], [math.log1p(n) for _, n in ranked]))
    return found


def embed_sparse(
    df: DataFrame, text: str = "text", max_terms: int = DEFAULTS.sparse_max_terms, model: SparseModel = log_count_model
) -> DataFrame:
    """Adds ``terms`` and ``weights``. The model sees ``MODEL_ROWS`` texts of an Arrow batch at a time, so Python objects
    never stand for a whole batch; nothing is shuffled."""

    def embedded(texts: pa.Array) -> pa.Array:
        found = model([t or "" for t in texts.to_pylist()], max_terms)
        ends = np.cumsum([0] + [len(terms) for terms, _ in found])
        offsets = pa.array(ends, pa.int32())
        terms = pa.array(chain.from_iterable(t for t, _ in found), pa.string())
        weights = pa.array(chain.from_iterable(w for _, w in found), pa.float64())
        lists = [pa.ListArray.from_arrays(offsets, terms), pa.ListArray.from_arrays(offsets, weights)]
        return pa.StructArray.from_arrays(lists, ["terms", "weights"])

    @F.arrow_udf("terms array<string>, weights array<double>")
    def run(chunks: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for chunk in chunks:
            parts = [embedded(chunk.slice(at, MODEL_ROWS)) for at in range(0, len(chunk), MODEL_ROWS)]
            yield pa.concat_arrays(parts) if parts else embedded(chunk)

    # Marked non-deterministic so that no filter pulls a second call of the model below.
    return df.withColumn("_sparse", run.asNondeterministic()(F.col(text))).select(
        *df.columns, "_sparse.terms", "_sparse.weights"
    )


def embed_dense(model: TextModel, batch: int = 64) -> Callable[[Column], Column]:
    """A model as an Arrow-batched column function; the model gets ``batch`` texts a call."""

    @F.pandas_udf("array<float>")
    def run(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for chunk in chunks:
            texts = chunk.fillna("").tolist()
            vectors: list = []
            for at in range(0, len(texts), batch):
                vectors.extend(model(texts[at : at + batch]))
            yield pd.Series(vectors)

    return run


def text_hash(text: str = "text") -> Column:
    """What an embedding was made of; it is stored with the vector."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def unembedded(units: DataFrame, done: DataFrame, key: str = "unit_id", text: str = "text") -> DataFrame:
    """Units with text that have no embedding of this text yet; without ``text_hash`` in ``done`` any embedding will do."""
    todo = units.filter(F.col(text).isNotNull() & (F.length(F.trim(text)) > 0))
    if "text_hash" not in done.columns:
        return todo.join(done.select(key), key, "left_anti")
    hashed = todo.withColumn("_hash", text_hash(text))
    known = done.select(key, F.col("text_hash").alias("_hash"))
    return hashed.join(known, [key, "_hash"], "left_anti").select(*units.columns)


def still_valid(done: DataFrame, units: DataFrame, key: str = "unit_id", text: str = "text") -> DataFrame:
    """Embeddings whose unit still exists with the text that they were made of."""
    current = units.select(key, text_hash(text).alias("text_hash"))
    return done.join(current, [key, "text_hash"], "left_semi").select(*done.columns)
