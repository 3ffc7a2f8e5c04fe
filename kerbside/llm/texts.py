"""Arrow batches of texts, cut to a bounded size, and the words in them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

#: Text bytes worked on at once; one longer text makes a block of its own.
BLOCK_BYTES = 4 << 20
#: Entries kept in a per-task table of results before it is emptied.
CACHE_ENTRIES = 300_000
#: A word is a run of bytes other than these.
ASCII_SPACE = " \t\n\r\x0b\x0c"

Block = tuple[pa.Array, list[str]]

#: Tables that a worker process keeps from task to task, of the operator that it works for.
_tables: dict[str, dict] = {}


def tables_of(operator: str) -> dict:
    """The worker's tables of this operator; those of any other are let go, as workers go on from one stage to the next."""
    if operator not in _tables:
        _tables.clear()
        pa.default_memory_pool().release_unused()
        _tables[operator] = {}
    return _tables[operator]


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key and text under fixed names, so other columns of the table cannot clash. A key may be a struct."""
    return df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))


def blocks(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Keys and texts in blocks of about ``limit`` bytes; a null text counts as empty."""
    for batch in batches:
        keys, texts, size, first = batch.column(0), [], 0, 0
        for at, value in enumerate(batch.column(1)):
            text = value.as_py() or ""
            if texts and size + len(text) > limit:
                yield keys.slice(first, len(texts)), texts
                texts, size, first = [], 0, at
            texts.append(text)
            size += len(text)
        if texts:
            yield keys.slice(first, len(texts)), texts


def map_blocks(
    df: DataFrame, work: Callable[[Block], dict[str, list]], schema: str, limit: int = BLOCK_BYTES, with_key: bool = True,
) -> DataFrame:
    """``work`` over each block of a ``keyed`` frame; it returns columns by name, one row a text unless ``with_key`` is off."""
    shape = StructType.fromDDL(schema)
    if with_key:
        shape = StructType([StructField("key", df.schema["key"].dataType), *shape.fields])
    arrow = to_arrow_schema(shape)

    def run(batches):
        tables_of(work.__module__)
        for block in blocks(batches, limit):
            columns = work(block)
            if with_key:
                columns["key"] = block[0].cast(arrow.field("key").type)
            yield pa.RecordBatch.from_arrays([
                c if isinstance(c := columns[field.name], pa.Array) else pa.array(c, type=field.type) for field in arrow
            ], schema=arrow)

    return df.mapInArrow(run, shape)


def split_words(text: str) -> list[bytes]:
    """Runs of characters other than ASCII white space, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


class Numbers(dict):
    """Numbers words in order of first sight."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Hashes(dict):
    """64-bit hashes of words, kept for the words seen last."""

    def __missing__(self, word):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def offsets(lengths: list[int]) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.asarray(lengths, dtype=np.int64)))).astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def runs_hashed(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + mixed(values[i:i + n] + np.uint64(i + 1))
    return mixed(out)
