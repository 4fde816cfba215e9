"""Arrow and numpy helpers that the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.session import cut_lineage

# ASCII white space, the separators of words in every contract: space and 0x09 to 0x0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Stands for a null doc_id where ids are compared; a null id is the smallest one.
NULL_ID = np.iinfo(np.int64).min

# Bytes of text that one step of a task works on.
SLICE_BYTES = 4 << 20


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(offset, length) of runs of rows with about ``limit`` bytes of text; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, total = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and total + size > limit:
            yield start, row - start
            start, total = row, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes) - start


def with_text_columns(docs: DataFrame, text: str, fields: dict[str, T.DataType], make: Callable) -> DataFrame:
    """``docs`` with columns computed from its texts, in one pass without a shuffle.

    ``make()`` runs once per task and returns a function from a string array (nulls kept) to one
    array per field. A column of ``docs`` with the name of a field is replaced.
    """
    kept = [f for f in docs.schema.fields if f.name not in fields or f.name == text]
    schema = T.StructType([*kept, *(T.StructField(n, t) for n, t in fields.items() if n != text)])
    place = [f.name for f in kept].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for offset, length in slices(batch.column(place)):
                part = batch.slice(offset, length)
                columns = [*part.columns, *compute(part.column(place))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*(F.col(f"`{f.name}`") for f in kept)).mapInArrow(run, schema)


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(word numbers of all rows, the distinct words, first word of each row and the end); a null text has no word."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    encoded = flat.filter(pa.array(real)).dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary, before[offsets]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours; empty when there are fewer values."""
    if len(values) < width:
        return values[:0]
    low, size = values, 1
    while 2 * size <= width:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    rest = width - size
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64, copy=False), pa.int64())


def ids_of(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), int(NULL_ID)).to_numpy(zero_copy_only=False)


def ids_back(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == NULL_ID)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: cuts the lineage like a checkpoint, and later steps
    read only the columns they use."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        cut_lineage(spark.range(0))  # names the folder
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` whose last reader has finished; what was made of them must be stored itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
