"""Helpers shared by the operators: written cut points, Arrow text buffers, rolling hashes."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ridgeline.session import scratch_path

#: Odd base of the polynomial byte hash (mod 2**64) and its inverse.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


#: Bytes of an Arrow batch that a Python worker gets at once.
BATCH_BYTES = 8 << 20
#: Lets Spark remove the shuffle files of a query when the query ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if it is not installed
    there, and bound their batches by bytes, so that long texts do not fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    have = environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, have)))


#: Memory of 256 KB or more is mapped and goes back to the system when it is freed, in Arrow's pool, too.
LEAN = {"MALLOC_MMAP_THRESHOLD_": "262144", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def lean_workers(spark: SparkSession) -> None:
    """Let Python workers that start from now on give freed memory back.

    For jobs of many stages: a worker is reused by later stages, and would otherwise hold on to the most
    that any stage before needed."""
    spark.sparkContext.environment.update(LEAN)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet in the shared folder and read it back; the path is for ``drop_path``
    once nothing reads it any more.

    This cuts the lineage with files that outlive any executor; the folder is the one that
    ``spark.checkpoint.dir`` names.  The shuffle files of the write go when it ends, not when the
    driver happens to collect its garbage.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as :func:`stored` reads it back."""
    return stored(df, name)[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` (mod 2**64) for i < n; kept per worker process."""
    have = _POWERS.get("p")
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 2 * (0 if have is None else len(have)))
        for key, base in (("p", BASE), ("q", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[key] = np.cumprod(p)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of ``(byte + 1) * BASE**i``; see :func:`segment_hash`."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=out[1:])
    return out


def segment_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each ``[start, end)``: equal bytes give equal values anywhere."""
    inverse = powers(len(prefix))[1]
    return mix((prefix[end] - prefix[start]) * inverse[start])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 row offsets (a null row is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def row_blocks(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; one longer row is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit multipliers."""
    i = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BASE) + np.uint64(seed)
    return mix(i) | np.uint64(1)
