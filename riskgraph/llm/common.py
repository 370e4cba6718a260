"""Helpers shared by the operators: table access, word hashing in numpy, and
small Arrow conversions. Nothing here collects data."""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.session import cut_lineage

#: A word of the contracts: a run of anything but space, tab, line feed,
#: vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

__all__ = ["LOWER", "UPPER", "WORD", "ascii_lower", "cut_lineage", "mix64", "release", "releasing", "segments", "strings", "table",
           "word_hashes"]


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import this package from where the
    driver has it (on a cluster it is shipped with --py-files), and keeps the
    batches that they get small, as texts can be long."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (root, env.get("PYTHONPATH"))))
    if spark.conf.get(_BATCH) == "67108864b":       # Spark's own default
        spark.conf.set(_BATCH, "16m")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError, TypeError):    # another C library
    def _trim(_: int) -> int:
        return 0


def release() -> None:
    """Gives back to the system what Arrow and the C library keep of memory that is free."""
    pa.default_memory_pool().release_unused()
    _trim(0)


def releasing(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task for ``mapInArrow`` that at its end gives back what it no longer
    holds. A worker outlives its tasks, and Arrow keeps the memory of batches that
    are done, while the executor goes on with stages that need it elsewhere."""
    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            gc.collect()
            release()
    return run


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would also fold other letters)."""
    return F.translate(c, UPPER, LOWER)


def strings(column: pa.Array) -> list[str]:
    """Column values as ``str``, null as the empty string."""
    return [x or "" for x in column.to_pylist()]


_WS = np.zeros(256, bool)
_WS[[0x20, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (xor-shift and multiply, wrapping)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _hash_chunk(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start offset of each word of ``blob`` (already lower-cased)."""
    buf = np.frombuffer(blob, np.uint8)
    at = np.flatnonzero(~_WS[buf])
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
    length = np.diff(np.append(first, len(at)))
    pos = np.arange(len(at)) - np.repeat(first, length)
    power = np.multiply.accumulate(np.full(int(length.max()), _BASE, np.uint64))
    return mix64(np.add.reduceat(_BYTE[buf[at]] * power[pos], first)), at[first]


def word_hashes(texts: list[str], chunk_bytes: int = 1 << 18):
    """64-bit hashes of the words (A-Z lower-cased) of every text, as one
    array in order, and the number of words of each text. Works through
    about ``chunk_bytes`` at a time, so temporary arrays stay small."""
    hashes, counts, part, size = [], [], [], 0

    def flush() -> None:
        h, start = _hash_chunk(b" ".join(part))
        ends = np.cumsum([len(p) + 1 for p in part])
        at = np.searchsorted(start, ends)
        hashes.append(h)
        counts.append(np.diff(np.concatenate(([0], at))))

    for t in texts:
        raw = t.encode("utf-8", "surrogatepass").lower()    # bytes.lower folds A-Z alone
        part.append(raw)
        size += len(raw)
        if size >= chunk_bytes:
            flush()
            part, size = [], 0
    if part:
        flush()
    if not counts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def segments(counts: np.ndarray):
    """(start, end) of each text's words in the array of ``word_hashes``."""
    ends = np.cumsum(counts)
    return zip((ends - counts).tolist(), ends.tolist(), strict=True)
