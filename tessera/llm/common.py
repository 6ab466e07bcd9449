"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

__all__ = ["table", "cut", "doc_bytes", "byte_chunks", "mix64", "word_spans", "free_name", "release", "LOWER"]

#: byte -> byte, A-Z to a-z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names (``spark.checkpoint.dir``):
    ends the lineage in files every executor can read, so a lost executor costs
    no recomputation of what came before. Shuffle files are only removed when the
    driver's JVM collects the frames they belong to; that is asked for here, or
    a loop's earlier rounds would stay on the executors' disks."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    out = df.checkpoint(eager=True)
    del df
    spark.sparkContext._jvm.System.gc()
    return out


def release() -> None:
    """Gives memory that a task has freed back to the system: a Python worker lives on
    for the tasks of other operators, and what it keeps counts against its executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library: it does this by itself or not at all
        pass


def doc_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string or binary Arrow column; null is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:]
    if data is None or not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    flat = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return flat, offsets - offsets[0]


def byte_chunks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of about ``most`` bytes each (one longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit values (multiply and xor-shift), not in place."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word ``[^\\x20\\x09-\\x0D]+``; words end with their document."""
    if not len(flat):
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~_SPACE[flat]
    cut_at = np.zeros(len(flat) + 1, bool)
    cut_at[offsets] = True
    start = np.flatnonzero(ink & (np.concatenate(([True], ~ink[:-1])) | cut_at[:-1]))
    end = np.flatnonzero(ink & (np.concatenate((~ink[1:], [True])) | cut_at[1:])) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


_POWERS: dict[str, np.ndarray] = {}


def span_hash(flat: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte string flat[start:end], equal for equal strings wherever they stand."""
    n = len(flat)
    if len(_POWERS.get("p", ())) <= n:
        base = np.uint64(0x9E3779B97F4A7C15)
        back = np.uint64(pow(int(base), -1, 1 << 64))
        with np.errstate(over="ignore"):
            _POWERS["p"] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n + 1, base))), dtype=np.uint64)
            _POWERS["i"] = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n + 1, back))), dtype=np.uint64)
    p, i = _POWERS["p"], _POWERS["i"]
    with np.errstate(over="ignore"):
        h = np.concatenate(([np.uint64(0)], np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * p[:n], dtype=np.uint64)))
        out = mix64((h[end] - h[start]) * i[start])
    if n > 1 << 21:
        _POWERS.clear()
    return out


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings flat[start:start+size] one behind the other, and which string each byte is of."""
    who = np.repeat(np.arange(len(start)), size)
    at = np.arange(len(who)) - np.repeat(np.cumsum(size) - size, size)
    return flat[start[who] + at], who
