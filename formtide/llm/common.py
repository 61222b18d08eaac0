"""Helpers of the operators: shared tables, text as byte arrays, substring hashes, packed rows.

Packed rows: a task gathers many small integers of one bucket into one binary value, so that a
shuffle moves one row per task and bucket instead of one row per integer.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.session import ensure_checkpoint_dir

# Bytes of text that a task turns into arrays at once; a longer document is a block of its own.
BLOCK_BYTES = 1 << 19

BASE = np.uint64(0x9E3779B97F4A7C13)  # odd and 3 mod 4
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BYTE_VALUES = np.random.RandomState(20240131).randint(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(
    2
) + np.uint64(1)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def shared_path(spark: SparkSession, name: str) -> str:
    """A new location in the folder that the driver and all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``materialise`` that drops the shuffle files of the frame, which nothing reads again."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        # the setting is read when a frame is made
        return materialise(df.select("*"), name)
    finally:
        conf.set(key, before)


def settled_by(df: DataFrame, name: str, column: str) -> DataFrame:
    """``settled`` with the files laid out by a column: grouping by it reads them without a shuffle.

    The table is only a name for the layout; it leaves the catalogue at once and its files stay.
    """
    spark, table = df.sparkSession, f"llm_{uuid.uuid4().hex}"
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in df.schema)
    layout = f"CLUSTERED BY ({column}) INTO {partitions_of(spark)} BUCKETS LOCATION '{shared_path(spark, name)}'"
    conf, key = spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {layout}")
    conf.set(key, "true")
    try:
        df.select("*").write.insertInto(table)
        return spark.table(table)
    finally:
        conf.set(key, before)
        spark.sql(f"DROP TABLE {table}")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Hash of any substring of a byte array in two look-ups: prefix sums of byte value x power."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(self.up) < n:
            self.up, self.down = powers(BASE, n), powers(BASE_INVERSE, n)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(BYTE_VALUES[data] * self.up[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + length)


def chain_hash(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive values (empty if there are fewer)."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(values) - n + 1, np.uint64)
    for i in range(n):
        out = out * BASE + values[i : len(values) - n + 1 + i]
    return mix(out)


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow text column as one byte array and the n + 1 offsets of its rows; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(column) else data[:0], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, size: int = BLOCK_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each, one row at least."""
    lengths = batch.column(text).cast(pa.large_string()).fill_null("")
    ends = np.cumsum(np.asarray(pa.compute.binary_length(lengths), dtype=np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; words end at row borders."""
    word = ~SPACES[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], word[:-1])) if len(word) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate((word[1:], [False])) if len(word) else word
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def spans(counts: np.ndarray) -> np.ndarray:
    """``0..c-1`` for every count, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def one_row_per_id(df: DataFrame, id_column: str) -> DataFrame:
    """A row key for joins back to the input: rows that share an id, or have none, stay apart."""
    return df.withColumn("_row", F.struct(F.col(id_column), F.monotonically_increasing_id()))
