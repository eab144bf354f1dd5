"""Helpers shared by the corpus operators: tables, hash draws, and vectorised work on UTF-8 buffers."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHUNK = 1 << 20
"""Bytes of text that one numpy step takes; a longer text is a step of its own."""

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20
"""Bytes of rows that go to a Python worker at a time; a longer row is a batch of its own."""

SPACE_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def in_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over batches of bounded bytes. Sets Spark's bound to ``BATCH_BYTES`` where the session has a larger one.

    A worker gives its free memory back after every batch and at the end of its task, so that it holds what one batch needs at most.
    """
    conf = df.sparkSession.conf
    digits, unit = re.fullmatch(r"(\d+)([kmg]?)b?", conf.get(BATCH).lower()).groups()
    if int(digits) << {"": 0, "k": 10, "m": 20, "g": 30}[unit] > BATCH_BYTES:
        conf.set(BATCH, str(BATCH_BYTES))

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                give_back()

        yield from run(each())
        give_back()

    return df.mapInArrow(tidy, schema)


def give_back() -> None:
    """Return free memory of this process to the system: Arrow's, and the C library's where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def uniform(*parts: Column | str) -> Column:
    """A draw in (0, 1) that depends on the parts alone: 52 bits of an MD5 digest. Null parts count as ``-``."""
    text = F.concat_ws("|", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("-")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def sampled(rows: DataFrame, key: str, size: int) -> DataFrame:
    """About ``size`` of the rows, all if there are no more: those whose key draws below ``size`` over their number."""
    n = rows.count()
    return rows if n <= size else rows.filter(uniform(F.lit("sample"), F.col(key)) < size / n)


def unused(name: str, df: DataFrame) -> str:
    """The name, with underscores before it until no column of the table has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; none in a null text."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def pieces(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets in them) of a string column, about ``limit`` bytes at a time. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true bytes; no run crosses the start of a row."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.empty_like(mask), np.empty_like(mask)
    before[0], before[1:] = False, mask[:-1]
    after[-1], after[:-1] = False, mask[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(mask))]
    before[inner], after[inner - 1] = False, False
    return np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1


class Rolling:
    """Hashes of substrings by polynomials modulo 2**64: ``of(start, end)`` after ``over(bytes)``."""

    def __init__(self, seed: int):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.values = draw.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(draw.integers(1 << 61, 1 << 62)) * 2 + 1 | 4
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.powers):
            size = max(n, CHUNK + 1)
            for name, factor in (("powers", self.base), ("inverses", self.inverse)):
                x = np.full(size, factor, np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x, dtype=np.uint64))

    def over(self, data: np.ndarray, table: np.ndarray | None = None) -> "Rolling":
        self._grow(len(data) + 1)
        values = self.values if table is None else self.values[table]
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(values[data] * self.powers[:len(data)], out=self.sums[1:])
        return self

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverses[start])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (one to one)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def chain(*hashes: np.ndarray) -> np.ndarray:
    """One hash of several in order."""
    out = hashes[0]
    for x in hashes[1:]:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + x)
    return out


def ragged(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices of all elements of ranges: ``starts[i] … starts[i] + lengths[i] - 1`` one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
