"""Helpers the corpus operators share: tables, bounded Arrow batches, text buffers, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cdcspark import files
from cdcspark.session import fresh_dir, written

#: Most bytes of one Arrow batch that goes to a Python task; a single row may be longer.
BATCH_BYTES = 4 << 20

#: Rows a broadcast table may hold; what is not proven to be smaller is joined by a shuffle.
BROADCAST_ROWS = 200_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Arrow batches are bounded in bytes, so long texts cannot pile up in one."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")


class Workspace:
    """Written intermediates of one operator, removed together once its result no longer needs them."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark, self.path = spark, fresh_dir(spark, purpose)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, name, path=f"{self.path}/{name}")

    def remove(self) -> None:
        files.remove(self.spark, self.path)


def bitmap(places: DataFrame, bits: int) -> np.ndarray:
    """A bit set for each number in the column ``place`` (0 to ``bits`` - 1), as 64-bit words.

    Its size is fixed whatever the number of rows: a filter made of it lets more through when it fills up, and what it lets
    through is always checked by a join.
    """
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("set")
    )
    out = np.zeros(bits // 64, np.int64)
    for word, value in words.collect():
        out[word] = value
    return out.view(np.uint64)


def in_bitmap(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) > 0


def arrow_folder(address: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder for tasks that read it through Arrow.

    The address is one that ``files.qualified`` gave on the driver: Spark and Arrow then mean the same place.
    """
    scheme, colon, rest = address.partition(":/")
    if not colon:
        raise ValueError(f"{address} is no full address")
    return pafs.FileSystem.from_uri(address if rest.startswith("/") else f"{scheme}:///{rest}")


def text_bytes(column: str = "text") -> Column:
    """The text's UTF-8 bytes; null is empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a binary column without nulls, not copied."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    kind = np.int64 if wide else np.int32
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind, len(column) + 1, column.offset * kind().itemsize)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    offsets = offsets.astype(np.int64)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes; a longer row is a range of its own."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (SplitMix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
